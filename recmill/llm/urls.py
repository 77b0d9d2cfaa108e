"""URL rules found by their rarest literal token, in built-in functions only.

A rule is a host and the beginning of a path. Its literal tokens are the labels of the
host and the whole segments of the path; every URL that fits the rule has them all. The
rule is indexed by the one of them that fewest distinct URLs have. A URL's tokens fetch
the rules indexed by them, and only those run their regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recmill.llm.text import ascii_lower
from recmill.sources.scratch import materialise

DEFAULT = "allow"
BROADCAST_ROWS = 200_000  # most rules sent to every executor
BROADCAST_VERDICTS = 20_000  # most judged URLs sent to every executor
# Fixed value: scheme, host, path.
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ANY = ""  # the token that every URL has, for rules without one of their own


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path; both empty for null and where there is no ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    return ascii_lower(F.regexp_extract(text, URL, 1)), F.regexp_extract(text, URL, 2)


def _tokens(host: Column, path: Column) -> Column:
    """Host labels, and path segments that a slash ends; marked, so that the two never meet."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x))
    parts = F.split(path, "/")
    closed = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    segments = F.transform(F.filter(closed, lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, segments))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _compiled(rules: DataFrame, host_col: str, path_col: str, action_col: str) -> DataFrame:
    """(rule, action, pattern, size, tokens) of each distinct usable rule."""
    host, path = ascii_lower(F.col(host_col).cast("string")), F.col(path_col).cast("string")
    parts = rules.select(host.alias("h"), path.alias("p"), F.col(action_col).cast("string").alias("action"))
    before = F.when(F.col("h") == "", r"^[^/]*").otherwise(F.concat(F.lit(r"^(?:[^/]*\.)?"), _quoted(F.col("h"))))
    after = F.when(F.col("p") == "", r"(?:/[\s\S]*)?\z").otherwise(_quoted(F.col("p")))
    return parts.filter("h IS NOT NULL AND p IS NOT NULL AND action IS NOT NULL").distinct().select(
        F.concat("h", "p").alias("rule"),
        "action",
        F.concat(before, after).alias("pattern"),
        (F.length("h") + F.length("p")).alias("size"),
        _tokens(F.col("h"), F.col("p")).alias("tokens"),
    )


def _sized(table: DataFrame) -> DataFrame:
    """The stored table, marked for broadcasting where it is small."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    host_col: str = "host",
    path_col: str = "path",
    action_col: str = "action",
    default: str = DEFAULT,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    A rule fits its host and all subdomains, for URLs whose path starts with the rule's.
    The longest fitting rule gives the verdict; of equally long ones the first by text,
    then by action. Without one, rule is null and the verdict is ``default``. A rule of
    empty host fits every host; rules with a null part are left out. Null urls and those
    without ``://`` have empty host and path, and are judged like any other. Rows that
    repeat an id are judged each; other columns of ``pages`` are not read.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    subjects = rows.select(F.col("host").alias("_host"), F.col("path").alias("_path")).distinct()
    spread = subjects.select(
        "_host", "_path", F.explode(F.concat(F.array(F.lit(ANY)), _tokens(F.col("_host"), F.col("_path")))).alias("token")
    )
    spread = materialise(spread, "url_tokens")

    compiled = materialise(_compiled(rules, host_col, path_col, action_col), "rules")
    literal = compiled.select("rule", "action", F.explode("tokens").alias("_t"))
    wanted = materialise(literal.select("_t").distinct(), "rule_tokens")
    seen = spread.join(_sized(wanted), F.col("token") == F.col("_t")).groupBy("_t").agg(F.count(F.lit(1)).alias("n"))
    counted = literal.join(seen, "_t", "left").groupBy("rule", "action").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)), "_t"))["_t"].alias("_token")
    )
    indexed = compiled.join(counted, ["rule", "action"], "left")
    index = materialise(
        indexed.select(F.coalesce("_token", F.lit(ANY)).alias("_token"), "rule", "action", "pattern", "size"), "rule_index"
    )
    fetched = spread.join(_sized(index), F.col("token") == F.col("_token"))
    fits = fetched.filter(F.expr("regexp_like(concat(_host, _path), pattern)"))
    longest = F.min(F.struct((-F.col("size")).alias("size"), "rule", "action")).alias("_best")
    best = materialise(fits.groupBy("_host", "_path").agg(longest), "verdicts")
    same = (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path"))
    # the stored verdicts compress so well that Spark would take a large table for a small one
    few = best.limit(BROADCAST_VERDICTS + 1).count() <= BROADCAST_VERDICTS
    return rows.join(F.broadcast(best) if few else best.hint("merge"), same, "left").select(
        "page_id", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.action", F.lit(default)).alias("verdict")
    )
