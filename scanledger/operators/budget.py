"""A review pass within a budget: the best accounts whose calls fit under a ceiling."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.config import CostRules
from scanledger.operators.accounts import filter_band
from scanledger.schemas import COMPANY_KEY
from scanledger.session import scratch_dir
from scanledger.sources.writers import write_parquet_zstd

MONEY = "decimal(18,6)"


def with_running_total(table: DataFrame, amount: str, order: list[Column], partitions: int | None = None) -> DataFrame:
    """The rows with ``running_total`` of an amount in a total order, without one task that sees them all.

    Rows are dealt by ranges of the order and written, so that every later step
    sees the same ranges; then each range is summed, the sums of the ranges
    before it are added up from one row per range, and the total runs on inside
    each range. ``order`` must be total, or ties may be dealt either way.
    """
    spark = table.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = table.repartitionByRange(count, *order).withColumn("_range", F.spark_partition_id())
    dealt = write_parquet_zstd(dealt, f"{scratch_dir(spark, 'ranges')}/ranges")
    sums = sorted(dealt.groupBy("_range").agg(F.sum(amount).cast(MONEY).alias("total")).collect())
    before, rows = Decimal(0), []
    for number, total in sums:
        rows.append((number, before))
        before += total or Decimal(0)
    offsets = spark.createDataFrame(rows, f"_range INT, _before {MONEY}")
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = (F.sum(amount).over(inside) + F.col("_before")).cast(MONEY)
    # one row per range
    summed = dealt.join(F.broadcast(offsets), "_range").withColumn("running_total", running)
    return summed.drop("_range", "_before")


def review_within_budget(
    accounts: DataFrame, cost: Column | None = None, rules: CostRules = CostRules(), partitions: int | None = None
) -> DataFrame:
    """The review accounts to send to a model, best first, until the ceiling is reached.

    ``cost`` is the price of an account's call, by default that of the rules.
    Adds ``call_cost`` and ``running_total``; equal scores go by key.
    """
    price = F.lit(rules.cost_per_call) if cost is None else cost
    review = filter_band(accounts, "review").withColumn("call_cost", price.cast(MONEY))
    order = [F.desc("contact_score"), *[F.asc(c) for c in COMPANY_KEY]]
    summed = with_running_total(review, "call_cost", order, partitions)
    return summed.filter(F.col("running_total") <= F.lit(str(rules.ceiling)).cast(MONEY))
