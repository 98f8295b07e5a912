"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the documents are
range-sorted by key, a distributed prefix sum of token counts places each one
on the source's line of tokens, and the mix takes the line up to the source's
exact budget, going round again for further epochs. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescube.llm.common import WORD, prefix_sums, stored, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2.0


def weigh_sources(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                  max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with weight and target.

    Sources in code point order, null last, take the weights in turn. Together
    they get ``share`` of all sizes; a target stops at ``max_epochs`` times its
    source's size and the excess is shared again by weight until none is above.
    The end of that resharing is the level at which sum(min(cap, level * weight))
    equals the total, found from running sums over sources by cap / weight.

    One row for each source; runs over them sort those aggregated rows only.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    total = sizes.agg(F.sum("source_size").cast("double") * F.lit(float(share))).scalar()
    caps = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    # Sources by the level at which they reach their cap. The capped ones are a prefix.
    by_level = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    levels = caps.withColumn("level", level)
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    final = F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), "level"))).over(Window.partitionBy())
    return (levels.withColumn("_final", final["level"])
            .withColumn("target", F.when(F.col("_final").isNull(), F.col("cap"))
                        .otherwise(F.least(F.col("cap"), F.col("_final") * F.col("weight"))))
            .select("source", "source_size", "weight", "target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = 7,
        size: Column | None = None) -> DataFrame:
    """One row per input row: (doc_id, size, source_size, target, taken, source).

    ``taken`` counts the words that the mix takes, repeats included: the whole
    document once for each full epoch, and once more as far as it lies before
    the cut of the last one, so a source's taken words are its target rounded
    down. The order depends on id, size and text alone, so reruns agree.

    Null source is a source of its own; null and empty texts have size 0 and
    nothing is taken of them; rows that repeat an id are separate documents;
    other columns are not read; an empty table gives an empty result.
    """
    size = word_count(F.col(text_col)) if size is None else size
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
        F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary")).alias("key"),
        F.xxhash64(id_col, source_col, text_col).alias("row_key"))
    placed = stored(prefix_sums(rows, ["source"], ["key", "doc_id", "size", "row_key"], "size", "mix"), "mix-placed")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(weigh_sources(sizes, weights, share, max_epochs), "mix-targets")
    # A row for each source against all documents: null-safe on the source.
    joined = placed.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    left = budget - F.col("epochs") * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("before")))
    return (joined.withColumn("epochs", epochs.cast("long"))
            .withColumn("taken", (F.col("epochs") * F.col("size") + extra).cast("long"))
            .select("doc_id", "size", "source_size", "target", "taken", "source", "row_key"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a row for each copy taken.

    The document at the cut gives its first words up to the budget; copies of
    documents that repeat keep their id. ``n_chars`` follows the text if there.
    """
    id_col, text_col, source_col = (options.get(k, v) for k, v in (
        ("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    # Rows that repeat id, source and text share a key; each takes one of its amounts.
    plan = (mix(docs, **options).groupBy("row_key")
            .agg(F.sort_array(F.collect_list("taken")).alias("takes"), F.first("size").alias("size")))
    turn = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    # The row as one struct: no column of the input can clash with those added here.
    rows = docs.select(F.xxhash64(id_col, source_col, text_col).alias("row_key"),
                       F.struct(*docs.columns).alias("row"))
    joined = rows.join(plan, "row_key").withColumn("taken", F.element_at("takes", turn)).where("taken > 0")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    part = F.col("taken") % F.col("size")
    copies = F.concat(F.array_repeat(F.col("size"), whole),
                      F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    # Only the document at a source's cut has part > 0, so few texts are taken apart.
    text = F.col("row").getField(text_col)
    words = F.regexp_extract_all(text, F.lit(f"[\\x20\\x09-\\x0D]*({WORD})"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("n").cast("int")), "")
    out = (joined.withColumn("n", F.explode(copies))
           .withColumn("new_text", F.when(F.col("n") == F.col("size"), text).otherwise(cut)))

    def column(c):
        if c == text_col:
            return F.col("new_text").alias(c)
        if c == "n_chars":
            return F.length("new_text").cast(docs.schema[c].dataType).alias(c)
        return F.col("row").getField(c).alias(c)

    return out.select(*[column(c) for c in docs.columns])
