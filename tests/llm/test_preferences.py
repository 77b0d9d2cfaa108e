import re

import pytest

from recmill.llm import preferences as P

CHOSEN = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "héllo"), (1, 3, "user", "bye"), (1, 4, "assistant", ""),
    (2, 0, "user", "only here"),
    (4, 0, "user", "same"), (4, 1, "assistant", "same"),
    (5, None, None, None), (5, 1, "assistant", "b"), (5, 1, "assistant", "a"),
    (6, 0, "user", "x"),
    (None, 0, "user", "no conversation"),
    (7, 0, "user", "word " * 50_000), (7, 1, "assistant", "ok"),
]
REJECTED = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "no"), (1, 5, "assistant", "🙂"),
    (3, 0, "assistant", "only there"),
    (4, 0, "user", "same"), (4, 1, "assistant", "same"),
    (5, None, None, None), (5, 1, "assistant", "a"),
    (6, 0, "user", None),
    (7, 0, "user", "word " * 50_000), (7, 1, "assistant", "no"),
]


def brute(chosen, rejected):
    say = lambda t: f"<|im_start|>{t[2] or ''}\n{t[3] or ''}<|im_end|>\n"
    order = lambda t: [(x is not None, x or 0 if i == 1 else x or "") for i, x in enumerate(t) if i]

    def completion(turns):
        text, spans = "", []
        for t in turns:
            if t[2] == "assistant":
                spans.append((len(text) + len(f"<|im_start|>{t[2]}\n"), len(text) + len(say(t)) - 1))
            text += say(t)
        return text, spans

    out = {}
    for conv in {t[0] for t in chosen + rejected} - {None}:
        c, r = (sorted([t for t in side if t[0] == conv], key=order) for side in (chosen, rejected))
        n = 0
        while n < min(len(c), len(r)) and c[n][2:] == r[n][2:]:
            n += 1
        out[conv] = ("".join(map(say, c[:n])), n, completion(c[n:]), completion(r[n:]))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    schema = "conv_id long, turn long, role string, text string, side string"
    return [spark.createDataFrame([(*t, "x") for t in side], schema) for side in (CHOSEN, REJECTED)]


def found(df):
    spans = lambda s: [(x.start, x.end) for x in s]
    return {
        r.conv_id: (r.prompt, r.n_prompt_turns, (r.chosen, spans(r.chosen_spans)), (r.rejected, spans(r.rejected_spans))) for r in df.collect()
    }


def test_matches_brute_force(tables):
    assert found(P.format_preferences(*tables)) == brute(CHOSEN, REJECTED)


def test_spans_hold_the_answers(tables):
    row = {r.conv_id: r for r in P.format_preferences(*tables).collect()}[1]
    assert [row.chosen[s.start : s.end] for s in row.chosen_spans] == ["héllo<|im_end|>", "<|im_end|>"]
    assert [row.rejected[s.start : s.end] for s in row.rejected_spans] == ["no<|im_end|>", "🙂<|im_end|>"]


def test_empty_tables_and_native_plan(tables):
    chosen, rejected = tables
    assert P.format_preferences(chosen.limit(0), rejected.limit(0)).count() == 0
    assert P.format_preferences(chosen, rejected.limit(0)).filter("prompt <> ''").count() == 0
    assert P.rejected_from(chosen.limit(0)).count() == 0
    plan = P.format_preferences(chosen, P.rejected_from(chosen))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_stale_answers(spark):
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2"), (1, 4, "user", "q3"),
            (2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "user", "q"), (4, 0, "assistant", "first"), (None, 0, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in P.rejected_from(turns).fillna("-").collect())
    assert got == [
        (1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a1"),
        (2, 0, "user", "q"), (2, 1, "assistant", "q"), (4, 0, "assistant", "-"),
    ]
