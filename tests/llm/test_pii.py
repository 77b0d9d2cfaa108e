import re

import pytest
from pyspark.sql import functions as F

from recmill.llm import pii

TEXTS = [
    (1, "Write to anna.B7@mail7.example.com or ANNA.B7@MAIL7.EXAMPLE.COM, call +1 (017) 555-7713!"),
    (2, "anna.b7@mail7.example.com again; +1 017 555 7713. Host 97.51.17.173, not 1.2.3.4.5 nor 300.1.1.1 nor v1.2.3"),
    (3, "card 4111 1111 1111 1111 and 4111111111111111, no card: 4111111111111112 1234567890123456"),
    (4, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and api_key: ABCD1234efgh5678; plain 04dbebab91ab85687d33eeaaf9ac699e1188f962'),
    (5, "Mr. John Smith met Mrs Smith; Mr Smith left. Señora Ana Muñoz and г-н, господин Иван Петров, госпожа Петрова. Dr. Smith"),
    (6, "nothing here, 2024 and 12.5 or a@b"),
    (7, ""),
    (8, None),
    (9, "ssn 123-45-6789."),
    (None, "x@y.org x@y.org z@y.org"),
    (9, "ssn 123-45-6789."),
    (10, "ñandú.34@mail1.example.com### 4111111111111111$$$"),
    (11, "a" * 20_000 + " q.q@r.st " + "b " * 20_000),
    (12, "12-34-5678-1234-567-890 10.0.0.1"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in TEXTS], "doc_id long, text string, _map string, kind int")


@pytest.fixture(scope="module")
def replaced(docs):
    rows = pii.pseudonymise(docs, "k", count_col="n").collect()
    return {(r.doc_id, i): r for i, r in enumerate(rows)}


def text(replaced, doc_id):
    return next(r.text for r in replaced.values() if r.doc_id == doc_id)


def test_rows_and_columns_stay(docs, replaced):
    assert pii.pseudonymise(docs, "k").columns == docs.columns
    assert sorted(str(r.doc_id) for r in replaced.values()) == sorted(str(i) for i, _ in TEXTS)


def test_texts_without_mention_stay(replaced):
    for doc_id in (6, 7, 8):
        row = next(r for r in replaced.values() if r.doc_id == doc_id)
        assert row.text == dict((i, t) for i, t in TEXTS if i == doc_id)[doc_id] and row.n == 0


def test_addresses_and_numbers(replaced):
    one, two = text(replaced, 1), text(replaced, 2)
    mail = re.findall(r"[\w.]+@[\w.]+\w", one + " " + two)
    assert len({m.lower() for m in mail}) == 1 and mail[0].lower() != "anna.b7@mail7.example.com"
    assert re.fullmatch(r"[a-z]{4}\.[a-z]\d@[a-z]+\d\d\.example\.org", mail[0]) and mail[1].isupper()
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\+1 \d{3} \d{3} \d{4}", one + " " + two)
    assert len(phones) == 2 and len({re.sub(r"\D", "", p) for p in phones}) == 1 and "0175557713" not in re.sub(r"\D", "", one)
    assert "97.51.17.173" not in two and "1.2.3.4.5" in two and "300.1.1.1" in two and "v1.2.3" in two


def luhn(n):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(n))) % 10 == 0


def test_cards_keep_issuer_format_and_check_digit(replaced):
    spaced, plain = re.match(r"card (\d{4} \d{4} \d{4} \d{4}) and (\d{16}), no card: 4111111111111112 1234567890123456$", text(replaced, 3)).groups()
    assert spaced.replace(" ", "") == plain != "4111111111111111"
    assert plain.startswith("41") and luhn(plain)
    assert plain in text(replaced, 10)


def test_secrets(replaced):
    found = re.match(r'token = "([0-9a-z]{40})" and api_key: ([A-Z]{4}\d{4}[a-z]{4}\d{4}); plain ([0-9a-z]{40})$', text(replaced, 4))
    assert found and found[1] == found[3] != "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def test_repeated_secrets_and_greek_names(spark):
    rows = [
        (1, "password: correct+horse/battery+staple and again correct+horse/battery+staple, not xcorrect+horse/battery+staple"),
        (2, "elsewhere correct+horse/battery+staple stays, it has no label here"),
        (3, "Dr Παπαδόπουλος met Mrs Μαρία Νικολάου. Παπαδόπουλος left."),
    ]
    done = {r.doc_id: r.text for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    found = re.fullmatch(r"password: (\S+) and again (\S+), not xcorrect\+horse/battery\+staple", done[1])
    assert found[1] == found[2] != "correct+horse/battery+staple" and re.fullmatch(r"[a-z]+\+[a-z]+/[a-z]+\+[a-z]+", found[1])
    assert done[2] == rows[1][1]
    greek = re.fullmatch("Dr ([Α-Ωα-ωά-ώ]+) met Mrs ([Α-Ωα-ωά-ώΆ-Ώ]+) ([Α-Ωα-ωά-ώ]+)\\. ([Α-Ωα-ωά-ώ]+) left\\.", done[3])
    assert greek[1] == greek[4] != "Παπαδόπουλος" and greek[2] in pii.GIVEN["female greek"] and greek[3] != greek[1]


def test_names_match_gender_and_script_and_agree(replaced):
    found = re.match(
        r"Mr\. (\w+) (\w+) met Mrs (\w+); Mr (\w+) left\. Señora (\w+) (\w+) and г-н, господин (\w+) (\w+), госпожа (\w+)\. Dr\. (\w+)$", text(replaced, 5)
    )
    given, family, *rest = found.groups()
    assert given in pii.GIVEN["male latin"] and rest[0] == rest[1] == rest[7] == family != "Smith"
    assert rest[2] in pii.GIVEN["female latin"]
    assert rest[4] in pii.GIVEN["male cyrillic"] and re.fullmatch("[А-Яа-я]+", rest[5]) and rest[5] != rest[6]


def test_repeats_agree_and_differ_by_key(docs, replaced):
    x, again, z = text(replaced, None).split()
    assert x == again != z
    nines = [r.text for r in replaced.values() if r.doc_id == 9]
    assert nines[0] == nines[1] and re.fullmatch(r"ssn 9\d\d-\d\d-\d{4}\.", nines[0])
    other = {r.doc_id: r.text for r in pii.pseudonymise(docs, "other").collect()}
    assert other[1] != text(replaced, 1)


def test_long_text(replaced):
    long = text(replaced, 11)
    assert long.startswith("a" * 20_000 + " ") and long.endswith(" " + "b " * 20_000) and "q.q@r.st" not in long


def test_collisions_are_drawn_again(spark):
    entities = spark.createDataFrame([("n", str(i)) for i in range(40)] + [("m", "1")], "kind string, entity string")

    def narrow(key):
        return F.pmod(F.xxhash64(F.lit(key), "entity", "attempt"), F.lit(60) + 40 * F.col("attempt")).cast("string")

    rows = pii.surrogates(entities, "k", narrow).collect()
    assert len(rows) == 41
    drawn = [r.surrogate for r in rows if r.kind == "n"]
    assert len(set(drawn)) == 40 and not set(drawn) & {str(i) for i in range(40)}


def test_no_free_surrogate_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(pii, "ROUNDS", 2)
    entities = spark.createDataFrame([("n", "a"), ("n", "b")], "kind string, entity string")
    with pytest.raises(RuntimeError):
        pii.surrogates(entities, "k", lambda key: F.lit("same"))


def test_native_and_empty(docs, spark, monkeypatch):
    assert pii.pseudonymise(docs.limit(0), "k").count() == 0
    monkeypatch.setattr(pii, "BROADCAST_ENTRIES", 0)
    frame = pii.pseudonymise(docs, "k")
    assert frame.count() == len(TEXTS)
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", frame._jdf.queryExecution().toString())


def test_whole_table_has_no_personal_data_left(spark):
    before = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    after = {r.doc_id: r for r in pii.pseudonymise(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "k", count_col="n").collect()}
    simple = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|\+\d \(\d{3}\) \d{3}-\d{4}|(?<=oken = \")[0-9a-f]{40}")
    real = {i: simple.findall(t) + [c for c in re.findall(r"(?<!\d)4\d{15}(?!\d)", t) if luhn(c)] for i, t in before.items()}
    assert sum(map(len, real.values())) > 50
    for doc_id, found in real.items():
        assert not any(m in after[doc_id].text for m in found)
        if not found and after[doc_id].n == 0:
            assert after[doc_id].text == before[doc_id]
        assert after[doc_id].n >= len(found)
