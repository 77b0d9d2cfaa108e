"""The queries of this package over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from recmill.llm import collocations, decontaminate, edits, knn, mixing, packing, pii, preferences, quality, simhash, spelling, urls, warc
from recmill.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SPEAKS_SQL = "('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10))"


@_register(
    "op1_preference_pairs",
    f"""WITH t AS (SELECT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
    la AS (SELECT conv_id, max(turn) AS last FROM t WHERE role = 'assistant' GROUP BY conv_id),
    stale AS (SELECT conv_id, any_value(last) AS last, CASE WHEN count(*) FILTER (role = 'assistant' AND turn < last) > 0
        THEN arg_max(text, turn) FILTER (role = 'assistant' AND turn < last) ELSE arg_max(text, turn) FILTER (turn < last) END AS text
      FROM t JOIN la USING (conv_id) GROUP BY conv_id),
    rej AS (SELECT t.* FROM t JOIN la USING (conv_id) WHERE turn < last
      UNION ALL SELECT conv_id, last, 'assistant', text FROM stale),
    s AS (SELECT 'c' AS side, * FROM t UNION ALL SELECT 'r', * FROM rej),
    p AS (SELECT *, row_number() OVER (PARTITION BY side, conv_id ORDER BY turn, role, text) AS pos FROM s),
    miss AS (SELECT conv_id, min(pos) AS pos FROM (SELECT conv_id, pos FROM p GROUP BY conv_id, pos
      HAVING count(*) < 2 OR min(coalesce(role, '')) <> max(coalesce(role, '')) OR min(coalesce(text, '')) <> max(coalesce(text, ''))) GROUP BY conv_id),
    n AS (SELECT conv_id, coalesce(any_value(miss.pos) - 1, count(*) FILTER (side = 'c')) AS n FROM p LEFT JOIN miss USING (conv_id) GROUP BY conv_id),
    w AS (SELECT p.*, n, {_SPEAKS_SQL} AS r, sum(length({_SPEAKS_SQL})) OVER (PARTITION BY side, conv_id, p.pos > n ORDER BY pos) AS upto
      FROM p JOIN n USING (conv_id))
    SELECT conv_id, coalesce(string_agg(r, '' ORDER BY pos) FILTER (side = 'c' AND pos <= n), '') AS prompt,
      coalesce(string_agg(r, '' ORDER BY pos) FILTER (side = 'c' AND pos > n), '') AS chosen,
      coalesce(string_agg(r, '' ORDER BY pos) FILTER (side = 'r' AND pos > n), '') AS rejected,
      any_value(n)::INT AS n_prompt_turns,
      coalesce(string_agg((upto - length(r) + 22)::BIGINT || ':' || (upto - 1)::BIGINT, ',' ORDER BY pos) FILTER (side = 'c' AND pos > n AND role = 'assistant'), '') AS chosen_mask,
      coalesce(string_agg((upto - length(r) + 22)::BIGINT || ':' || (upto - 1)::BIGINT, ',' ORDER BY pos) FILTER (side = 'r' AND pos > n AND role = 'assistant'), '') AS rejected_mask
    FROM w GROUP BY conv_id""",
)
def op1_preference_pairs(spark, sf_dir):
    chosen = _table(spark, sf_dir, "conversations")
    found = preferences.format_preferences(chosen, preferences.rejected_from(chosen))
    mask = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select(
        "conv_id",
        "prompt",
        "chosen",
        "rejected",
        "n_prompt_turns",
        mask("chosen_spans").alias("chosen_mask"),
        mask("rejected_spans").alias("rejected_mask"),
    )


@_register("op2_quality_classifier")
def op2_quality_classifier(spark, sf_dir):
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register("op3_best_fit_packing")
def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_register("op4_voronoi_top_k")
def op4_voronoi_top_k(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    return knn.top_k(rows, rows.filter("vec_id % 20 = 0"), k=20)


def three_edits(text: str = "text", key: str = "doc_id"):
    """A replacement a third into the text, an insertion anywhere, and a cut at the end, made from each row."""
    n = F.char_length(text).cast("long")

    def one(pos, delete: int, insert):
        return F.struct(F.floor(pos).alias("pos"), F.lit(delete).cast("long").alias("delete"), insert.alias("insert"))

    anywhere = F.pmod(F.xxhash64(key), n + 1)
    return F.array(
        one(n / 3, 7, F.lit("edited in 2024, isn't it")),
        one(anywhere, 0, F.substring(text, 1, 40)),
        one(n - 5, 50, F.lit("")),
    )


@_register("op5_edit_aware_counts")
def op5_edit_aware_counts(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = edits.count_edits(docs.withColumn("edits", three_edits()), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_before", "n_after", "n_pretokens", "n_encoded")


# The rules, as (action, host, path).
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
_RULES_SQL = ", ".join(str(rule) for rule in URL_RULES)
_URL_RX = "(?s)^.*?://([^/?#]*)([^?#]*)"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@_register(
    "op6_url_rules",
    f"""WITH u AS (SELECT row_number() OVER () AS r, page_id,
      translate(regexp_extract(coalesce(url, ''), '{_URL_RX}', 1), '{_UP}', '{_LOW}') AS host,
      regexp_extract(coalesce(url, ''), '{_URL_RX}', 2) AS path FROM pages),
    rules(action, h, p) AS (VALUES {_RULES_SQL}),
    fit AS (SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
      FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r)
    SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM u LEFT JOIN fit USING (r)""",
)
def op6_url_rules(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return urls.judge(_table(spark, sf_dir, "pages"), rules)


@_register(
    "op7_warc_revisits",
    """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
    d AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1), '' ORDER BY i) AS payload_digest
      FROM (SELECT DISTINCT hex FROM p), range(32) AS g(i) GROUP BY hex),
    f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM p JOIN d USING (hex) JOIN f USING (hex)""",
)
def op7_warc_revisits(spark, sf_dir):
    archive = scratch_path(spark, "warc")
    warc.write_archive(warc.resolve(warc.records_of(_table(spark, sf_dir, "pages")), min_bytes=0), archive)
    found = warc.join_revisits(warc.read_archive(spark, archive, with_payload=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_WORDS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{decontaminate.WORD}')"


@_register(
    "op8_decontamination",
    f"""WITH i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
    iw AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p+m-1], ' ') AS g
      FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
    d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
    dw AS (SELECT r, p, m, array_to_string(w[p:p+m-1], ' ') AS g
      FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
    hit AS (SELECT r, p, m, item_id FROM dw JOIN iw USING (m, g)),
    hw AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(p, p + m)) AS x FROM hit) GROUP BY r),
    hi AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM hit) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)""",
)
def op8_decontamination(spark, sf_dir):
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_register("op9_simhash_near_duplicates")
def op9_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


PII_KEY = "recmill surrogates"


@_register("op10_pii_surrogates")
def op10_pii_surrogates(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, count_col="n_mentions")


@_register("op11_mixed_sources")
def op11_mixed_sources(spark, sf_dir):
    _, documents = mixing.mix(_table(spark, sf_dir, "documents"), weights=[3, 1, 2], share=(3, 2), most=2)
    return documents.select("doc_id", "size", "source_size", "target", "taken")


_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"


@_register(
    "op12_spelling_variants",
    f"""WITH RECURSIVE r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')),
        '{_UP}', '{_LOW}') AS run FROM documents),
    u AS (SELECT run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x, count(*) AS c FROM r WHERE length(run) >= 7 GROUP BY ALL),
    t AS (SELECT list_transform(range(16), lambda i: list_reduce(range(4)::UBIGINT[], lambda c, k: {_CRC_STEP}, i::UBIGINT)) AS t),
    h AS (SELECT run, c, xor(4294967295, list_reduce(
        list_transform(range(length(x)), lambda i: instr('123456789ABCDEF', substr(x, (i + 2 - 2 * (i % 2))::INT, 1)))::UBIGINT[],
        lambda c, b: xor(t[(xor(c, b) & 15)::INT + 1], c >> 4), 4294967295::UBIGINT)) AS h FROM u, t),
    w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
        sum(c)::BIGINT AS n FROM h GROUP BY 1 HAVING length(word) >= 7 AND sum(c) >= 2),
    k AS (SELECT word, n, left(word, i::INT) || substr(word, i::INT + 2) AS d, left(word, i::INT) || '*' || substr(word, i::INT + 2) AS s
      FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
    less AS (SELECT DISTINCT k.word AS longer, w.word AS shorter FROM k JOIN w ON w.word = k.d),
    pairs AS (SELECT a.word, b.word AS other FROM k a JOIN k b ON a.s = b.s AND a.word <> b.word
      UNION ALL SELECT longer, shorter FROM less UNION ALL SELECT shorter, longer FROM less),
    near AS (SELECT pairs.word, count(*) AS n_near, min(struct_pack(m := -w.n, o := other)) AS best FROM pairs JOIN w ON w.word = other GROUP BY 1),
    f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 10 * n THEN best.o END AS form,
        CASE WHEN -best.m >= 10 * n THEN -best.m END AS form_n FROM w LEFT JOIN near USING (word)),
    up(word, here, step) AS (SELECT word, word, 0 FROM f UNION ALL SELECT up.word, f.form, step + 1 FROM up JOIN f ON f.word = up.here WHERE f.form IS NOT NULL),
    root AS (SELECT word, arg_max(here, step) AS root FROM up GROUP BY word)
    SELECT word, form, root, n, n_near, form_n FROM f JOIN root USING (word)""",
)
def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"), shortest=7, least=2, times=10, misspell_every=31)


@_register(
    "op13_collocations",
    f"""WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
    c AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 6) AS g(k) WHERE len(w) >= k) GROUP BY ALL),
    n AS (SELECT lang, sum(f)::HUGEINT AS n FROM c WHERE k = 1 GROUP BY lang),
    a AS (SELECT *, string_split(phrase, ' ') AS w FROM c WHERE f >= 100),
    cuts AS (SELECT a.lang, a.phrase, a.k, a.f AS a, j, x.f AS l, y.f AS r, n, (1000 * a.f::HUGEINT * n) // (x.f::HUGEINT * y.f) AS score
      FROM (SELECT *, unnest(range(1, k)) AS j FROM a WHERE k > 1) a JOIN n USING (lang)
      JOIN a x ON x.lang = a.lang AND x.phrase = array_to_string(a.w[:j], ' ') JOIN a y ON y.lang = a.lang AND y.phrase = array_to_string(a.w[j + 1:], ' ')),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    inside AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, f, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase
      FROM a, range(2, 5) AS g(m) WHERE m < k) GROUP BY ALL),
    kept AS (SELECT best.* FROM best LEFT JOIN inside i ON i.lang = best.lang AND i.phrase = best.phrase WHERE i.f IS NULL OR i.f < best.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept QUALIFY rank <= 2000""",
)
def op13_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)
