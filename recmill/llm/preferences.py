"""Preference pairs for training, from chosen and rejected conversations, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a turn is written.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNT_ROLE = "assistant"

TURN = "struct<turn:bigint,role:string,text:string>"


def _turns(side: str) -> Column:
    """One side's turns in order; turns without a number come first, ties by role and text."""
    turn = F.struct("turn", "role", "text")
    return F.array_sort(F.collect_list(F.when(F.col("side") == side, turn)))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(MIDDLE), F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _learnt(turns: Column, role: str) -> Column:
    """Spans (start, end), in characters of the joined turns, of what ``role`` says, end mark included."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, turn: Column) -> Column:
        head = F.length(F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit(MIDDLE)))
        end = acc["at"] + F.length(_rendered(turn))
        own = F.array(F.struct((acc["at"] + head).alias("start"), (end - 1).alias("end")))
        spans = F.when(turn["role"] == role, F.concat(acc["spans"], own)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def format_preferences(
    chosen: DataFrame,
    rejected: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learnt_role: str = LEARNT_ROLE,
) -> DataFrame:
    """(conv_id, prompt, chosen, rejected, n_prompt_turns, chosen_spans, rejected_spans) of each pair.

    Both sides have one row per turn. The prompt is the longest prefix of turns, by role
    and text, that both conversations share, rendered once; the completions are what
    follows on either side. The spans mark the characters of a completion that bear loss:
    what ``learnt_role`` says, with the end mark; all else is masked. Null roles and texts
    are empty when rendered, and equal each other only. A conversation that only one side
    has is paired with an empty one; equal conversations have empty completions. Turns
    that repeat a number stay, ordered by role and text. Rows of null id belong to no
    conversation and are left out. Other columns are not read; empty tables give no rows.
    """

    def side(turns: DataFrame, name: str) -> DataFrame:
        return turns.select(
            F.col(id_col).alias("conv_id"),
            F.lit(name).alias("side"),
            F.col(turn_col).cast("long").alias("turn"),
            F.col(role_col).cast("string").alias("role"),
            F.col(text_col).cast("string").alias("text"),
        ).filter(F.col("conv_id").isNotNull())

    both = side(chosen, "chosen").unionByName(side(rejected, "rejected"))
    pairs = both.groupBy("conv_id").agg(_turns("chosen").alias("c"), _turns("rejected").alias("r"))

    def agree(x: Column, y: Column) -> Column:
        same = x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])
        return x.isNotNull() & y.isNotNull() & same

    miss = F.array_position(F.zip_with("c", "r", agree), False).cast("int")
    pairs = pairs.withColumn("n", F.when(miss == 0, F.size("c")).otherwise(miss - 1))
    rest = lambda name: F.slice(F.col(name), F.col("n") + 1, F.greatest(F.size(name) - F.col("n"), F.lit(0)))
    pairs = pairs.withColumns({"c_rest": rest("c"), "r_rest": rest("r")})
    return pairs.select(
        "conv_id",
        _joined(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _joined(F.col("c_rest")).alias("chosen"),
        _joined(F.col("r_rest")).alias("rejected"),
        F.col("n").alias("n_prompt_turns"),
        _learnt(F.col("c_rest"), learnt_role).alias("chosen_spans"),
        _learnt(F.col("r_rest"), learnt_role).alias("rejected_spans"),
    )


def rejected_from(
    chosen: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learnt_role: str = LEARNT_ROLE,
) -> DataFrame:
    """Rejected counterparts for conversations that come without: the last answer is a stale one.

    The last answer's text is replaced by the answer before it, and by the turn before it
    where there is none; the turns after it are left out. A conversation without an answer
    has no counterpart. ``chosen`` needs one row per conversation and turn number.
    """
    rows = chosen.select(
        F.col(id_col).alias(id_col),
        F.col(turn_col).alias(turn_col),
        F.col(role_col).alias(role_col),
        F.col(text_col).alias(text_col),
    ).filter(F.col(id_col).isNotNull())
    turn, answer = F.col(turn_col), F.col(role_col) == learnt_role
    turns = F.array_sort(F.collect_list(F.struct(turn.alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))))
    whole = rows.groupBy(id_col).agg(turns.alias("t"), F.max(F.when(answer, turn)).alias("last"))
    before = F.filter("t", lambda x: x["turn"] < F.col("last"))
    answers = F.filter(before, lambda x: x["role"] == learnt_role)
    pick = lambda a: F.try_element_at(a, F.lit(-1))
    stale = F.when(F.size(answers) > 0, pick(answers)["text"]).otherwise(pick(before)["text"])
    last = F.filter("t", lambda x: (x["turn"] == F.col("last")) & (x["role"] == learnt_role))
    changed = F.transform(last, lambda x: F.struct(x["turn"].alias("turn"), x["role"].alias("role"), stale.alias("text")))
    kept = whole.filter(F.col("last").isNotNull()).select(id_col, F.explode(F.concat(before, changed)).alias("_t"))
    return kept.select(id_col, F.col("_t.turn").alias(turn_col), F.col("_t.role").alias(role_col), F.col("_t.text").alias(text_col))
