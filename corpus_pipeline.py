"""The corpus pipeline: five stages from raw documents to token ids.

``STAGES`` lists (name, function); each takes (spark, docs, sf_dir) and returns a
DataFrame, all but the last with the columns of ``documents``. ``run`` writes
each stage's rows to the shared folder and reads them back as the next one's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescube.llm import bpe, language_id, line_dedup, minhash_dedup, mixing
from salescube.llm.common import stored, table

MIN_LANGUAGE_SCORE = 0.5
# Stages on word shingles take five words and a similarity of 0.8 or more.
NEAR = minhash_dedup.Plan(words=5, percent=80)

# A trained model, a calibrated search and a vocabulary are among the stages.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language is less likely than not, go."""
    model = language_id.train(docs.where(~language_id.held_out()))
    judged = language_id.predict(docs, model, pred_col="__lang", score_col="__score")
    return (judged.where((F.col("__lang") != language_id.UNDETERMINED) & (F.col("__score") >= MIN_LANGUAGE_SCORE))
            .select(*docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five or more documents hold stay in the last of them; every document stays."""
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    A row goes by its id and 128 bits of hash of its text: another text under the same id is no copy.
    """
    key = ["__t1", "__t2"]
    marked = docs.withColumn("__t1", F.xxhash64("text")).withColumn("__t2", F.xxhash64(F.lit(1), F.col("text")))
    copies = (minhash_dedup.near_duplicates(marked, NEAR, carry=key).where(~F.col("kept"))
              .select("doc_id", *key).distinct())
    return marked.join(copies, ["doc_id", *key], "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes; the document at a source's cut is shortened to its budget."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of whole texts, their number, and digests of ids and of the text decoded from them."""
    return bpe.encode_and_digest(docs, keep_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
