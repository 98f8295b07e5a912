"""Filter interaction audit: what each filter removes in every order of all filters.

Filters that look at one text are flags of a row. The duplicate filter looks at
the whole table, and a counting Bloom sketch goes before it: each task counts its
texts' slots, the counts are merged, and a text of which some slot was counted
once is certainly the only one of its kind. Only the other texts, possible
repeats, are shuffled for the exact smallest id of each full text.

With the flags as bits of a mask, the documents are counted by part and mask.
These counts add up to every step of every order: a document with mask m leaves
at the first filter of the order that is in m. So the table is read once for the
sketch and once for the flags, however many orders there are.

The sketch has twelve counters a document up to ``max_sketch_bytes`` of two bits
each, and is broadcast. In larger tables it clears fewer texts, more of them
are shuffled, and the result is the same.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescube.llm.common import WORD, settled
from salescube.llm.sketch import MAX_SKETCH_BYTES, counters_for, merged_sketch, possible_repeats

DUPLICATE = "E"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def production_filters(text: Column, words: Column) -> dict[str, Column]:
    """The failure condition of each filter that looks at one text."""
    n = F.size(words).cast("long")
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.char_length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def filter_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                 filters=production_filters, duplicate: str = DUPLICATE,
                 max_sketch_bytes: int = MAX_SKETCH_BYTES) -> tuple[DataFrame, list[str]]:
    """((doc_id, part, mask) of every row, names of the filters in the order of their bits).

    A null text is an empty one and a null part the empty string. The duplicate
    filter fails a row if a smaller id has an identical text anywhere; a row
    with a null id never fails it and fails no other; rows that repeat an id
    don't fail each other.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    hashed = (rows.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), F.col("text"))))
    known = hashed.where(F.col("doc_id").isNotNull())
    sketch = merged_sketch(known, counters_for(docs.count(), max_sketch_bytes))

    named = filters(F.col("text"), F.col("words"))
    names = [*named, duplicate]
    mask = sum((F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(named.values())),
               F.lit(0))
    judged = (hashed.withColumn("words", words_of(F.col("text")))
              .select("doc_id", "part", mask.alias("mask"), "h1", "h2", "text"))
    probed = possible_repeats(judged, sketch)  # texts of unique rows end here
    repeat = F.col("possible") & F.col("doc_id").isNotNull()
    kept = settled(probed.select("doc_id", "part", "mask", F.when(repeat, F.col("text")).alias("text"),
                                F.when(repeat, F.unhex(F.sha2("text", 256))).alias("key")), "audit-flags")
    # Partial minima meet before the shuffle, so a text of a third of all rows is one row of each task.
    firsts = (kept.where(F.col("key").isNotNull()).groupBy("text").agg(F.min("doc_id").alias("doc_id"))
              .select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"), F.lit(True).alias("first")))
    fails = F.col("key").isNotNull() & F.col("first").isNull()
    return (kept.drop("text").join(firsts, ["doc_id", "key"], "left")
            .select("doc_id", "part",
                    (F.col("mask") + F.when(fails, F.lit(1 << len(named))).otherwise(F.lit(0))).alias("mask")), names)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality",
          toxic_col: str = "toxic", **options) -> DataFrame:
    """One row for each part, order of all filters (``filter_order``) and ``step`` from 1.

    Counts of documents in the part: ``kept`` after the step, ``removed`` by it,
    ``redundant`` (fail its filter but were removed before), ``unique_fails``
    (fail its filter only), ``good_lost`` and ``toxic_lost`` (removed here with
    that label 1); ``shapley`` is what its filter removes summed over all orders.

    Every part of the table has all its rows, zeros included; an empty table has
    none. A document with several label rows is good or toxic if one says so;
    null labels and labels of null ids say nothing. Rows that repeat an id each
    count. Other columns are not read.
    """
    masks, names = filter_masks(docs, id_col, **options)
    said = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
            .agg(F.coalesce(F.max(F.when(F.col(good_col) == 1, 1)), F.lit(0)).alias("good"),
                 F.coalesce(F.max(F.when(F.col(toxic_col) == 1, 1)), F.lit(0)).alias("toxic")))
    counts = (masks.join(said, "doc_id", "left").groupBy("part", "mask")
              .agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                   F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))

    bit = {name: 1 << i for i, name in enumerate(names)}
    steps = [{"filter_order": "".join(order), "step": i + 1, "own": bit[name], "before": sum(bit[x] for x in order[:i])}
             for order in itertools.permutations(names) for i, name in enumerate(order)]
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, own int, before int>>")
    at = counts.withColumn("s", F.explode(table)).select("*", "s.*")
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    here = fails & ~gone

    def total(condition: Column, value: str) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0))).cast("long")

    out = at.groupBy("part", "filter_order", "step", "own").agg(
        total(~fails & ~gone, "n").alias("kept"), total(here, "n").alias("removed"),
        total(fails & gone, "n").alias("redundant"),
        total(F.col("mask") == F.col("own"), "n").alias("unique_fails"),
        total(here, "good").alias("good_lost"), total(here, "toxic").alias("toxic_lost"))
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")
