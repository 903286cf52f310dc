"""Mixing sources to target weights along a time-varying curriculum.

1. Sizes and targets.  Each source has a weight; together they share all
   words; a source's target stops at ``max_repeat`` times its size and the
   excess goes to the others by weight until none is above.
2. Demand.  Source s wants tokens at rate ``target * (1 + slope*(2t-1))`` at
   training time t in [0, 1]; integrated, the cumulative demand is
   ``target * (t + slope*(t*t - t))``.
3. Supply.  The documents of a source stand in a fixed random order (md5 of
   the id); with r = target/size, document words at cumulative offset c are
   handed out floor(r) times, and the first ``(r - floor(r)) * size`` words of
   the order once more.  The last document of that extra round gives only the
   words still missing, so a source meets its target to the word.
4. Positions.  Each copy stands where the inverse of the cumulative demand
   puts the middle of its words; ``curriculum`` range-sorts copies by it.

The running sum over a source is taken in two levels: sums of 4096 hash
buckets, then a running sum inside each bucket, so that a source with a third
of all rows is spread over the buckets and not gathered in one task.  Only
built-in functions are used.

Null texts have size 0, are taken 0 times and get no copy.  A null source is a
source of its own, last in order.  Rows that share id and source are ordered
by size, so repeated rows are interchangeable.  Other columns are kept; names
starting with ``_mix_`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_REPEAT = 3
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: Slopes of the weight schedules, repeating: rising, level, falling.
SLOPES = (0.5, 0.0, -0.5)


def n_words(text: str = "text") -> Column:
    """Words of a text: white space squeezed to single blanks, then blanks counted."""
    t = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(t == "", 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1) \
        .cast("bigint")


def _cycle(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """sizes (_mix_source, source_size) → with target, slope.  One row per source.

    Sources fill up in the order of max_repeat*size/weight: a source is capped
    exactly if its cap is below its share of what those before it left.
    """
    order = Window.orderBy(F.col("_mix_source").asc_nulls_last())
    s = sizes.withColumn("_i", F.row_number().over(order) - 1)
    s = s.withColumn("_w", _cycle(weights, F.col("_i")).cast("double")) \
        .withColumn("slope", _cycle(slopes, F.col("_i")).cast("double")) \
        .withColumn("_cap", F.col("source_size") * max_repeat)
    fill = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_i").asc())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("_total", F.sum("source_size").over(whole)) \
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))) \
        .withColumn("_level", F.col("_left") / F.sum("_w").over(after))
    s = s.withColumn("_capped", F.col("_cap") < F.col("_level") * F.col("_w"))
    # the level of the first source that is not capped holds for all after it
    s = s.withColumn("_rank", F.row_number().over(fill)) \
        .withColumn("_first", F.min(F.when(~F.col("_capped"), F.col("_rank"))).over(whole)) \
        .withColumn("_open", F.max(F.when(F.col("_rank") == F.col("_first"), F.col("_level"))).over(whole))
    target = F.when(F.col("_rank") < F.coalesce("_first", F.lit(1 << 30)), F.col("_cap").cast("double")) \
        .otherwise(F.least(F.col("_cap").cast("double"), F.col("_open") * F.col("_w")))
    return s.select("_mix_source", "source_size", target.alias("target"), "slope")


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
         weights=WEIGHTS, slopes=SLOPES, max_repeat: int = MAX_REPEAT, buckets: int = 4096) -> DataFrame:
    """Every column of ``docs`` with size, source_size, target, slope, taken, and the copies'
    arithmetic: _mix_before (words of the source before it), _mix_whole (full rounds)."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    d = docs.withColumn("size", n_words(text)).withColumn("_mix_source", F.col(source)) \
        .withColumn("_mix_hash", digest) \
        .withColumn("_mix_bucket", (F.conv(F.substring("_mix_hash", 1, 8), 16, 10).cast("bigint") % buckets).cast("int"))
    part = d.groupBy("_mix_source", "_mix_bucket").agg(F.sum("size").alias("_mix_sum"))
    by_bucket = Window.partitionBy("_mix_source").orderBy("_mix_bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.withColumn("_mix_offset", F.coalesce(F.sum("_mix_sum").over(by_bucket), F.lit(0).cast("bigint")))
    goal = targets(part.groupBy("_mix_source").agg(F.sum("_mix_sum").alias("source_size")), weights, slopes, max_repeat)
    known = offsets.alias("o").join(goal.alias("g"), F.expr("o._mix_source <=> g._mix_source")).select(
        F.col("o._mix_source").alias("_mix_s"), F.col("o._mix_bucket").alias("_mix_b"),
        "_mix_offset", "source_size", "target", "slope")
    d = d.join(known, F.expr("_mix_source <=> _mix_s and _mix_bucket = _mix_b")).drop("_mix_s", "_mix_b")
    inside = Window.partitionBy("_mix_source", "_mix_bucket").orderBy("_mix_hash", F.col(key), "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_mix_before", F.col("_mix_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    goal_words = F.round(F.col("target")).cast("bigint")
    d = d.withColumn("_mix_whole", F.when(F.col("source_size") > 0, F.floor(goal_words / F.col("source_size")))
                     .otherwise(0).cast("bigint"))
    extra = F.least(F.greatest(goal_words - F.col("_mix_whole") * F.col("source_size") - F.col("_mix_before"),
                               F.lit(0)), F.col("size"))
    return d.withColumn("taken", (F.col("_mix_whole") * F.col("size") + extra).cast("bigint"))


def position(cumulative: Column, target: Column, slope: Column) -> Column:
    """Invert the cumulative demand: t with t + slope*(t*t - t) = cumulative/target."""
    u = F.when(target > 0, F.least(cumulative / target, F.lit(1.0))).otherwise(F.lit(0.0))
    b = 1 - slope
    return F.when(F.abs(slope) < 1e-9, u).otherwise(2 * u / (b + F.sqrt(b * b + 4 * slope * u)))


def copies(planned: DataFrame) -> DataFrame:
    """One row for each copy of a document, with copy, copy_words and position; not sorted."""
    n = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    d = planned.withColumn("copy", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))))
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    middle = F.col("copy") * F.col("source_size") + F.col("_mix_before") + words / 2
    return d.withColumn("copy_words", words.cast("bigint")) \
        .withColumn("position", position(middle, F.col("target"), F.col("slope")))


def curriculum(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The training order: every copy of every document, range-sorted by position."""
    out = copies(plan(docs, key=key, **options))
    out = out.drop(*[c for c in out.columns if c.startswith("_mix_")])
    return out.repartitionByRange("position", key, "copy").sortWithinPartitions("position", key, "copy")
