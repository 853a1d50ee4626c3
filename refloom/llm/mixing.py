"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

The rates r of the documents minimise the entropy sum(r log r - r + 1) under one token constraint a source, sum(size * r) =
target, and r <= limit. The minimiser is tilted exponentially, document by document: r = min(limit, exp(tilt * size)), with
one tilt a source, which maximises the concave dual. Newton's method finds the tilts of all sources at once: each step is a
distributed aggregation over the documents (counted by source and size, all that the dual depends on). Steps are taken on the
logarithm of the words, where a source of one size needs a single step, and damped: what leaves the bracket of tilts known
to be too low and too high halves the bracket instead. It ends when each source's words agree with its target to 12 digits.

Sums are of decimals, so they don't depend on the order of rows and reruns agree to the last bit.

Rates are rounded into copies by systematic rounding along the documents of a source in descending order of size: a
document gets floor(R + 1/2) - floor(R' + 1/2) copies, R being the sum of the rates up to it and R' before it. It gets the
floor or the ceiling of its rate, and as sizes descend the words taken differ from the target by at most half the largest
size (the sum of the steps down, each times at most 1/2).
The running sums come from three levels of counts (source and size; bucket of ids; row), so no task orders a source:
a window holds at most the different sizes of one source, `BUCKETS` counts, or one bucket of one size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
LIMIT = 2.0
BUCKETS = 256
NEWTON_STEPS = 4  # between two looks at the residual
ROUNDS = 60
EXACT = 1e-12


def word_count(text: Column) -> Column:
    """Runs of other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares of all words by weight, none above limit times its source.

    Sources are weighted by code point (Spark orders strings by UTF-8 bytes, which is the same), null last. A source at
    its limit leaves the excess to the others by weight; the level at which that ends is found by ordering sources by
    limit per weight, so one pass over the table of sources is enough.
    """
    total = Window.partitionBy()
    ordered = sizes.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ordered.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int"))).withColumn("cap", F.col("source_size") * limit)
    up = Window.orderBy(F.col("cap") / F.col("w"), "k").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy(F.col("cap") / F.col("w"), "k").rowsBetween(0, Window.unboundedFollowing)
    levels = weighed.select("*", (F.sum("source_size").over(total) * share - F.coalesce(F.sum("cap").over(up), F.lit(0.0))).alias("left"), F.sum("w").over(down).alias("open"), F.row_number().over(Window.orderBy(F.col("cap") / F.col("w"), "k")).alias("nth"))
    # the first source, in that order, that stays below its limit sets the level for itself and all after it
    level = F.col("left") / F.col("open")
    reached = levels.withColumn("level", F.min_by(level, F.when(level * F.col("w") <= F.col("cap"), F.col("nth"))).over(total))
    return reached.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def rate(tilt: Column, size: Column, limit: float) -> Column:
    """The rate of a document, rounded to 12 decimals; no tilt (a source without words, or whose target is 0): 0."""
    return F.when(tilt.isNull(), 0.0).otherwise(F.round(F.least(F.lit(limit), F.exp(tilt * size)), 12)).cast("decimal(18,12)")


def _newton_step(state: DataFrame, sizes: DataFrame, limit: float) -> DataFrame:
    """state with new tilts: one aggregation over the sizes of each open source, one damped step each."""
    r = F.exp(F.col("tilt") * F.col("size"))
    words = F.col("size") * F.col("n_size")
    sums = sizes.withColumnRenamed("source", "of").join(state, F.col("of").eqNullSafe(F.col("source"))).groupBy("source", "source_size", "target", "tilt", "low", "high", "open")
    sums = sums.agg(F.sum((words * F.least(F.lit(limit), r)).cast("decimal(38,10)")).cast("double").alias("took"), F.sum(F.when(r < limit, words * F.col("size") * r).otherwise(0.0).cast("decimal(38,10)")).cast("double").alias("slope"))
    moving = F.col("open") & (F.abs(F.col("took") - F.col("target")) > F.col("target") * EXACT)
    sums = sums.withColumn("low", F.when(F.col("took") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))).withColumn("high", F.when(F.col("took") > F.col("target"), F.col("tilt")).otherwise(F.col("high")))
    newton = F.col("tilt") - F.log(F.col("took") / F.col("target")) * F.try_divide("took", "slope")
    middle = (F.col("low") + F.col("high")) / 2
    step = F.when((newton > F.col("low")) & (newton < F.col("high")), newton).otherwise(middle)
    still = moving & (step != F.col("tilt"))
    return sums.withColumn("next", F.when(still, step).otherwise(F.col("tilt"))).withColumn("open", still).drop("took", "slope", "tilt").withColumnRenamed("next", "tilt").select(*state.columns)


def balanced_tilts(targets: DataFrame, sizes: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target, tilt) from (source, source_size, target) and (source, size, n_size).

    The tilt is null where a source has no words or no target. Sources at their limit need no step: all their documents are at the limit.
    """
    least = sizes.where("size > 0").groupBy(F.col("source").alias("of")).agg(F.min("size").alias("least"))
    known = targets.join(least, F.col("of").eqNullSafe(F.col("source")), "left")
    ratio = F.when((F.col("source_size") > 0) & (F.col("target") > 0), F.col("target") / F.col("source_size"))
    full = ratio >= limit * (1 - EXACT)
    state = known.select(
        "source", "source_size", "target",
        F.when(full, F.lit(math.log(limit) + 1e-9) / F.col("least")).when(ratio > 0, 0.0).alias("tilt"),
        F.when(ratio >= 1, -1e-9).otherwise(F.log(ratio) / F.col("least") - 1e-9).alias("low"),
        F.when(ratio <= 1, 1e-9).otherwise(F.lit(math.log(limit) + 1e-9) / F.col("least")).alias("high"),
        F.coalesce(~full, F.lit(False)).alias("open"),
    )
    state = stored(state, "tilts")
    for _ in range(ROUNDS):
        moving = state.where("open")
        if moving.isEmpty():
            break
        for _ in range(NEWTON_STEPS):
            moving = _newton_step(moving, sizes, limit)
        state = stored(state.where("not open").unionByName(moving), "tilts")
    return state.select("source", "source_size", "target", "tilt")


def _bucket(docs: DataFrame) -> Column:
    """Ranges of integer ids, so that order by bucket and id is order by id; hashes of other ids, or of ids too far apart. Null ids are in bucket -1."""
    if docs.schema["id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        low, high = docs.agg(F.min("id"), F.max("id")).first()
        if low is None:
            return F.lit(-1)
        if high - low < 1 << 62:
            return F.coalesce(F.expr(f"(id - {low}L) div {(high - low) // BUCKETS + 1}L"), F.lit(-1))
    return F.coalesce(F.when(F.col("id").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(BUCKETS))), F.lit(-1))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT, carry: bool = False) -> DataFrame:
    """(id_col, size, source_size, target, copies, taken) for each row of df.

    size counts words; taken = copies * size. Null and empty texts have size 0 and take nothing. Null sources are one
    source, the last. Rows that repeat are mixed as different rows; which of rows with equal id, size and source gets
    a further copy is all the same, as they are equal. No rows: no rows. carry: (row struct of df's columns, copies) instead.
    """
    whole = [F.struct(*df.columns).alias("row")] if carry else []
    docs = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), *whole)
    docs = docs.withColumn("bucket", _bucket(docs))
    cells = docs.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    sizes = stored(cells.groupBy("source", "size").agg(F.sum("n").alias("n_size")), "sizes")
    targets = source_targets(sizes.groupBy("source").agg(F.sum(F.col("n_size") * F.col("size")).alias("source_size")), weights, share, limit)
    tilts = balanced_tilts(targets, sizes, limit).withColumnRenamed("source", "s")
    before = Window.unboundedPreceding
    sizes = sizes.join(tilts, F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", rate(F.col("tilt"), F.col("size"), limit))
    count = lambda c: F.col(c).cast("decimal(18,0)")
    sizes = sizes.withColumn("skip", F.coalesce(F.sum(count("n_size") * F.col("rate")).over(Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(before, -1)), F.lit(0)))
    cells = cells.withColumn("skip_cell", F.coalesce(F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(before, -1)), F.lit(0)))
    plan = (
        cells.select(F.col("source").alias("cs"), F.col("size").alias("cz"), "bucket", "skip_cell")
        .join(sizes, F.col("cs").eqNullSafe(F.col("source")) & (F.col("cz") == F.col("size")))
        .select("cs", "cz", F.col("bucket").alias("cb"), "skip", "skip_cell", "rate", "source_size", "target")
    )
    placed = docs.withColumn("nth", F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("id")))
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("cs")) & (F.col("size") == F.col("cz")) & (F.col("bucket") == F.col("cb")))
    joined = joined.withColumn("at", F.col("skip") + (F.col("skip_cell") + F.col("nth")).cast("decimal(18,0)") * F.col("rate") + F.lit("0.5").cast("decimal(2,1)"))
    out = joined.withColumn("copies", F.floor("at").cast("long") - F.floor(F.col("at") - F.col("rate")).cast("long"))
    if carry:
        return out.select("row", "copies")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(df: DataFrame, **options) -> DataFrame:
    """The mix: each row of df as often as it has copies."""
    mixed = mix_sources(df, carry=True, **options)
    return mixed.where("copies > 0").withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, 2 * source_size AS cap FROM s),
l AS (SELECT *, sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS nth FROM w),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(rest / open_w, nth) FROM l WHERE rest / open_w * w <= cap) * w, cap)) AS target FROM l),
h AS (SELECT source, size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL),
b AS (SELECT 0 AS k, t.source, t.target, CASE WHEN target >= source_size THEN 0 ELSE ln(target / source_size) END - 1e-9::DOUBLE AS low, CASE WHEN target > source_size THEN ln(2::DOUBLE) ELSE 0 END + 1e-9::DOUBLE AS high FROM t WHERE target > 0
  UNION ALL SELECT k + 1, b.source, b.target, CASE WHEN sum(n * size * least(2, exp((low + high) / 2 * size))) < b.target THEN (low + high) / 2 ELSE low END, CASE WHEN sum(n * size * least(2, exp((low + high) / 2 * size))) < b.target THEN high ELSE (low + high) / 2 END
  FROM b JOIN h ON b.source IS NOT DISTINCT FROM h.source WHERE k < 100 GROUP BY k, b.source, b.target, low, high),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(CASE WHEN NOT t.target > 0 THEN 0 WHEN t.target >= 2 * t.source_size THEN 2 ELSE least(2, exp(high * d.size)) END, 12) AS DECIMAL(18, 12)) AS rate, d.source
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN b ON b.source IS NOT DISTINCT FROM d.source AND b.k = 100),
c AS (SELECT *, 0.5 + sum(rate) OVER (PARTITION BY source ORDER BY size DESC, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS up FROM r)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST((floor(up) - floor(up - rate)) * size AS BIGINT) AS taken FROM c
"""
