"""Analytics of an annotation log: attempts, quota, cooldown, pending work.  Order is the log's own sequence number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def failed_attempts(log: DataFrame, page: str, attempts: Column, counts: Column) -> DataFrame:
    """Sum of attempts by page over rows for which `counts` holds (not accepted, not quota, not transient)."""
    return log.where(counts).groupBy(page).agg(F.sum(attempts).cast("bigint").alias("failed_attempts"))


def latest(log: DataFrame, page: str, seq: str, *columns: str) -> DataFrame:
    return log.groupBy(page).agg(F.max_by(F.struct(seq, *columns), seq).alias("x")).select(page, "x.*")


def streaks(log: DataFrame, seq: str, flag: Column, *by: str) -> DataFrame:
    """Runs of consecutive flagged rows within `by`, or over the whole log: first, last and length.

    Over the whole log no task gets all rows: rows are numbered by ranges of seq, each range's flagged and other rows are counted, and the counts of earlier ranges,
    one for each range, are added.
    """
    if by:
        order = W.partitionBy(*by).orderBy(seq)
        d = log.select(*by, seq, flag.alias("f"), F.sum((~flag).cast("bigint")).over(order.rowsBetween(W.unboundedPreceding, 0)).alias("island"))
    else:
        d = log.select(seq, flag.alias("f")).repartitionByRange(F.col(seq)).withColumn("_p", F.spark_partition_id())
        d = d.withColumn("_own", F.sum((~F.col("f")).cast("bigint")).over(W.partitionBy("_p").orderBy(seq).rowsBetween(W.unboundedPreceding, 0)))
        before = d.groupBy("_p").agg(F.count_if(~F.col("f")).alias("_n")).select("_p", F.coalesce(F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
        d = d.join(F.broadcast(before), "_p").select(seq, "f", (F.col("_own") + F.col("_before")).alias("island"))
    return d.where("f").groupBy(*by, "island").agg(F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), F.count("*").alias("length")).drop("island")


def pending(pages: DataFrame, accepted: DataFrame, failed: DataFrame, page: str, cost: str, most: int, limit: int) -> DataFrame:
    """Pages neither accepted nor exhausted, fewest failures first, then cheapest: a top-k without a full sort."""
    d = pages.join(accepted, page, "left_anti").join(failed, page, "left").withColumn("failed_attempts", F.coalesce("failed_attempts", F.lit(0)))
    return d.where(F.col("failed_attempts") < most).orderBy("failed_attempts", cost, page).limit(limit)


def status_of_last(log: DataFrame, seq: str, status: str, n: int) -> DataFrame:
    return log.orderBy(F.desc(seq)).limit(n).groupBy(F.coalesce(status, F.lit("missing")).alias("status")).agg(F.count("*").alias("n"))


def cooldown(age_seconds: Column, quota_limit: Column, wait: Column, base: float = 0.0) -> Column:
    """Seconds left before the next try; where a quota's limit is short, the wait that its error names."""
    return F.greatest(F.lit(0.0), F.round(F.when(quota_limit <= 100, wait).otherwise(F.lit(base)) - age_seconds, 1))
