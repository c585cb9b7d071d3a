"""Aggregations of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable


def ratio(a: Column, b: Column, digits: int = 4) -> Column:
    """a / b, half-even at so many digits; 0 where b is 0 or NULL."""
    return F.when(F.coalesce(b, F.lit(0)) == 0, F.lit(0.0)).otherwise(F.bround(a.cast("double") / b, digits))


def top_counts(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values with their counts; ties by value, NULL counts as a value."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(key)).limit(k)


def nearest_rank(df: DataFrame, value: str, quantiles: dict[str, float], method: str = "half_even") -> DataFrame:
    """One row of percentiles that are values of the column, 0 where there is none.

    ``half_even`` takes index round((n - 1) q), ``floor`` takes index int(n q).
    Values are counted first; the counts are range-partitioned, summed range by
    range, and each range adds the sum of those before it, so no task orders all
    values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_c"))
    ranged = durable(counts.repartitionByRange(value).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.sum("_c").alias("_s"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("_p", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    total = sizes.agg(F.coalesce(F.sum("_s"), F.lit(0)).alias("_n"))
    up_to = Window.partitionBy("_p").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = ranged.withColumn("_to", F.sum("_c").over(up_to)).join(F.broadcast(offsets), "_p").withColumn("_to", F.col("_to") + F.col("_off")).crossJoin(F.broadcast(total))

    def at(q: float) -> Column:
        if method == "floor":
            return F.least(F.floor(F.col("_n") * q), F.col("_n") - 1)
        return F.least(F.greatest(F.bround((F.col("_n") - 1) * F.lit(q)), F.lit(0)), F.col("_n") - 1)

    return cum.agg(*[F.coalesce(F.min(F.when(F.col("_to") > at(q), F.col(value))), F.lit(0)).cast("long").alias(name) for name, q in quantiles.items()])


def length_stats(df: DataFrame, value: str) -> DataFrame:
    """min, percentiles, max, mean and counts of thin, good and long texts; NULL lengths count as 0."""
    v = F.coalesce(F.col(value), F.lit(0))
    x = df.select(v.cast("long").alias("v"))
    plain = x.agg(
        F.coalesce(F.min("v"), F.lit(0)).alias("min_len"), F.coalesce(F.max("v"), F.lit(0)).alias("max_len"), F.coalesce(F.bround(F.avg("v"), 2), F.lit(0.0)).alias("avg_len"),
        F.count_if(F.col("v") < 200).alias("thin"), F.count_if(F.col("v") >= 500).alias("good"), F.count_if(F.col("v") >= 2000).alias("long_text"),
    )
    return plain.crossJoin(nearest_rank(x, "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}))  # two single rows


def histograms(df: DataFrame, columns: list[str], k: int = 20) -> DataFrame:
    """(dimension, value, n): the k most frequent values of each column, in one pass by grouping sets."""
    sets = df.groupingSets([[c] for c in columns], *columns).agg(F.count("*").alias("n"), F.grouping_id(*columns).alias("_g"))
    full = (1 << len(columns)) - 1
    dim, val = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, c in enumerate(columns):
        mine = F.col("_g") == full - (1 << (len(columns) - 1 - i))
        dim, val = F.when(mine, F.lit(c)).otherwise(dim), F.when(mine, F.col(c).cast("string")).otherwise(val)
    rows = sets.select(dim.alias("dimension"), F.coalesce(val, F.lit("")).alias("value"), "n").groupBy("dimension", "value").agg(F.sum("n").alias("n"))
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("n"), "value"))).where(F.col("_r") <= k).drop("_r")


def duplicates_left(df: DataFrame, key: str) -> Column:
    """Rows with a key less different keys."""
    return F.count(F.nullif(F.col(key), F.lit(""))) - F.count_distinct(F.nullif(F.col(key), F.lit("")))


def first_numeric(*columns: Column) -> Column:
    """The first that is no NULL, else 0."""
    return F.coalesce(*columns, F.lit(0))


def first_truthy(*columns: Column) -> Column:
    """The first that is neither NULL nor 0, else 0."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in columns], F.lit(0))


def rates(df: DataFrame, ts: str, value: str, target: float) -> DataFrame:
    """Adds delta, per_minute and target_ratio against the previous snapshot; the first has none.

    Snapshots are a short series: one row for each report.
    """
    w = Window.orderBy(ts)
    seconds = F.greatest(F.lit(0.001), F.unix_micros(ts) / 1e6 - F.unix_micros(F.lag(ts).over(w)) / 1e6)
    delta = F.coalesce(F.col(value) - F.lag(value).over(w), F.lit(0))
    per_minute = F.coalesce(F.bround(delta * 60.0 / seconds, 2), F.lit(0.0))
    x = df.withColumn("delta", delta).withColumn("per_minute", per_minute)
    return x.withColumn("target_ratio", F.bround(F.col("per_minute") / F.lit(float(target)), 4))


def latest_then_sum(df: DataFrame, worker: str, ts: list[str], values: list[str]) -> DataFrame:
    """Sums of the latest row of each worker."""
    last = df.groupBy(worker).agg(*[F.max_by(v, F.struct(*ts)).alias(v) for v in values])
    return last.agg(F.count("*").alias("workers"), *[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values])


def scale_estimate(counts: DataFrame, files: int = 90_000, per_file: int = 30_000) -> DataFrame:
    """Extrapolates a sample to all files.

    ``counts`` has one row: records, candidates, duplicates, ok_files, sites,
    nonzero_sites, pages, rate (pages a second).  Duplicates grow by 0.12 for
    each tenfold of files, to 0.95 at most.
    """
    c = F.col
    cand = ratio(c("candidates"), c("records"), 12)
    sites = F.floor(F.lit(files * per_file) * cand)
    grow = F.log10(F.greatest(F.lit(1.0), F.lit(float(files)) / F.greatest(F.lit(1), c("ok_files"))))
    dup = F.least(F.lit(0.95), ratio(c("duplicates"), c("candidates"), 12) + 0.12 * grow)
    unique = F.floor(sites * (1 - dup))
    each, nonzero = ratio(c("pages"), c("sites"), 12), ratio(c("pages"), c("nonzero_sites"), 12)
    moderate = unique * ratio(c("nonzero_sites"), c("sites"), 12) * nonzero
    return counts.select(
        F.bround(cand, 6).alias("candidate_rate"), F.bround(dup, 6).alias("duplicate_rate"), unique.cast("long").alias("unique_sites"),
        F.bround(unique * each, 0).alias("pages_conservative"), F.bround(moderate, 0).alias("pages_moderate"), F.bround(moderate / F.greatest(F.lit(1.0), c("rate") * 3600), 2).alias("hours"),
    )
