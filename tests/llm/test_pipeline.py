"""The pipeline's stages on the smallest tables, each against its own input."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from salescube.llm import minhash_dedup
from salescube.llm.common import stored, table, word_count

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_stages_in_order(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        seen[name] = docs
        assert name == "bpe" or docs.columns == columns
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "minhash_near_dedup", "mixing", "bpe"]
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    with_letters = {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    kept = {r.doc_id for r in seen["language_id"].collect()}
    assert kept <= with_letters and len(kept) >= 0.99 * len(with_letters)
    assert seen["line_dedup"].count() == seen["language_id"].count()
    groups = minhash_dedup.near_duplicates(seen["line_dedup"], P.NEAR).collect()
    assert {r.doc_id for r in seen["minhash_near_dedup"].collect()} == {r.doc_id for r in groups if r.kept}
    words = [seen[n].agg(F.sum(word_count(F.col("text")))).first()[0] for n in ("minhash_near_dedup", "mixing")]
    assert words[1] == pytest.approx(1.5 * words[0], rel=0.01)
    mixed = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in seen["mixing"].collect())
    assert mixed == sorted(r.decoded_sha256 for r in seen["bpe"].collect())
    assert seen["bpe"].where("n_tokens <> size(ids)").isEmpty()


def test_near_dedup_stage_drops_copies_and_not_their_ids(spark):
    t = " ".join(f"t{i}" for i in range(60))
    u = " ".join(f"u{i}" for i in range(60))
    rows = [(1, t, 0), (5, t + " x", 1), (5, u, 2), (8, u + " y", 3), (None, t, 4), (9, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, nr int")
    out = P.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.nr for r in out.collect()) == [0, 2, 4, 5]


def test_tokenizing_is_one_python_pass_equal_to_encode_then_digest(spark):
    from salescube.llm import bpe
    rows = [(1, "two words, it's\n  Grüße", "x"), (2, None, "y"), (3, "", None), (3, "again " * 50, "z"), (None, "</s> 12", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = bpe.encode_and_digest(docs, keep_ids=True)
    want = bpe.digest(bpe.encode(docs), keep_ids=True)
    assert got.schema == want.schema and got.count() == 5
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    short = bpe.token_digest(docs)
    assert short.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert short._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
