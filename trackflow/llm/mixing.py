"""Mix sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies (target words / source words).
The expected copies are summed up along the documents, a random offset of the source is added, and
a document is emitted once per integer crossed. Documents are taken in the order of their sizes, so
the sample is spread over all sizes and the words taken come near the target.

The sum is rate x rank, and ranks come from counts in three levels: words per document within the
source, 256 parts by hash within a size, order within a part. So no source is ever sorted as a whole.
Identical rows are counted first and expanded last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.llm.shared import stored

WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), limit: float = 3.0) -> DataFrame:
    """Add target to (source, source_size): shares of all sizes by weight, at most limit x the size.

    Weights repeat along the sources in code point order, null last. What a source cannot take is
    shared by the others by weight, until none is above its limit: the sources with the smallest
    size to weight ratios are capped, one after another, until the share that the rest leaves the next
    one is within its limit; this is the largest share that any such split gives.
    The windows run over one row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("_w", F.element_at(table, (place % len(weights) + 1).cast("int")))
    size = F.col("source_size").cast("double")
    order = Window.orderBy((size / F.col("_w")), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    rows = rows.select(
        "*",
        F.sum(size).over(whole).alias("_all"),
        F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_capped"),
        F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("_rest"),
    )
    level = (F.col("_all") - limit * F.col("_capped")) / F.col("_rest")
    rows = rows.withColumn("_level", F.when(level * F.col("_w") <= limit * size, level))
    rows = rows.withColumn("_level", F.max("_level").over(whole))
    target = F.least(F.coalesce(F.col("_level") * F.col("_w"), limit * size), limit * size)
    return rows.select("source", "source_size", target.alias("target"))


def offset(seed: str, source: Column) -> Column:
    """A number in [0, 1) that the seed and the source decide; null is a source of its own."""
    named = F.coalesce(F.concat(F.lit("="), source), F.lit("null"))
    digits = F.substring(F.md5(F.concat(F.lit(seed), named).cast("binary")), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 48)


def row_hash() -> Column:
    """Tells rows apart by id and text; a null id is `null`."""
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", named, F.coalesce(F.col("text"), F.lit(""))).cast("binary"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    limit: float = 3.0,
    seed: str = "mix",
    identity: Column | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, identity; a row per document.

    A null text has size 0. Sources without words have target 0 and no copies. Repeated rows stay
    and are sampled one by one; which of several identical rows is emitted makes no difference.
    identity: a hex text that tells rows apart and orders documents of one size, by default an md5 of
    id and text. Other columns of the input are not carried."""
    rows = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        n_words(F.col("text")).alias("size"),
        (row_hash() if identity is None else identity).alias("_hash"),
    )
    named = ["doc_id", "source", "size", "_hash"]
    rows = stored(rows.groupBy(*named).agg(F.count(F.lit(1)).alias("_rows")), "mix-rows")
    rows = rows.withColumn("_cell", F.substring("_hash", 1, 2))
    # Null sources join like any other.
    rows = rows.withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))

    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("_rows")).alias("source_size"))
    aims = targets(sizes, weights, limit).withColumn(
        "_source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    ).drop("source")

    cells = rows.groupBy("_source", "size", "_cell").agg(F.sum("_rows").alias("_n"))
    cells = stored(cells, "mix-cells")
    before = (Window.unboundedPreceding, -1)
    by_size = Window.partitionBy("_source").orderBy("size").rowsBetween(*before)
    by_cell = Window.partitionBy("_source", "size").orderBy("_cell").rowsBetween(*before)
    steps = cells.groupBy("_source", "size").agg(F.sum("_n").alias("_n")).select(
        "_source", "size", F.coalesce(F.sum("_n").over(by_size), F.lit(0)).alias("_below")
    )
    starts = cells.select(
        "_source", "size", "_cell", F.coalesce(F.sum("_n").over(by_cell), F.lit(0)).alias("_within")
    ).join(steps, ["_source", "size"])

    inside = Window.partitionBy("_source", "size", "_cell").orderBy("_hash", "doc_id").rowsBetween(*before)
    ranked = rows.join(starts, ["_source", "size", "_cell"]).withColumn(
        "_rank", F.col("_below") + F.col("_within") + F.coalesce(F.sum("_rows").over(inside), F.lit(0))
    )
    one = ranked.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_rows").cast("int") - 1)))
    joined = one.join(aims, "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = (F.col("_rank") + F.col("_i")).cast("double")
    start = offset(seed, F.col("source"))
    copies = F.floor((rank + 1.0) * rate + start) - F.floor(rank * rate + start)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"), F.col("_hash").alias("identity")
    )


def sample(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), limit: float = 3.0, seed: str = "mix") -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with all their columns."""
    # The input's columns stay in a struct, so that no name can clash.
    row = F.struct(*docs.columns)
    named = docs.select("doc_id", "source", "text", row.alias("row"), F.md5(F.to_json(row).cast("binary")).alias("identity"))
    taken = mix(named, weights, limit, seed, F.col("identity"))
    taken = taken.groupBy("identity").agg(F.sum("copies").alias("copies")).where("copies > 0")
    # Identical rows are one here, with the copies of all of them.
    once = named.select("row", "identity").join(taken, "identity").dropDuplicates(["identity"])
    return once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
