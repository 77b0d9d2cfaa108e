import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import test_decontamination
import test_near_duplicates
import test_packing
from recmill.llm import pii, quality
from recmill.llm.queries import PII_KEY
from recmill.sources.scratch import materialise

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents each stage was given and gave."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        given = docs
        docs = materialise(stage(spark, docs, SF_DIR), "stage")
        out.append((given, docs))
    return out


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").dtypes
    assert all(df.dtypes == columns for _, df in stages[:-1])


def test_each_stage_by_brute_force(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    (docs, good), (_, first), (_, clean), (_, safe), (_, packed) = stages

    model = quality.fit(docs, labels)
    want = {i: t for i, t in rows(docs).items() if model.score(quality.features(t)[None])[0] >= 0.7}
    assert rows(good) == want

    groups = test_near_duplicates.brute(list(rows(good).items()))
    keep = {int(i) for i, _, component in groups if i == component}
    assert rows(first) == {i: t for i, t in rows(good).items() if i in keep}

    hit = {int(i) for i, _, n, _ in test_decontamination.brute(list(rows(first).items()), items) if n}
    assert rows(clean) == {i: t for i, t in rows(first).items() if i not in hit}

    assert rows(safe) == {r.doc_id: r.text for r in pii.pseudonymise(clean, PII_KEY).collect()}
    assert all(r.n_chars == len(r.text) for r in safe.collect())

    test_packing.check(list(rows(safe).items()), packed.collect(), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(key, stages[-1][1].collect()))


def test_stages_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
