"""Reports over facts: spend alert and revenue by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.joins import join_on_hot_key


def rolling_spend_alert(
    df: DataFrame, day: str, amount: str, days: int = 7, percent: int = 150
) -> DataFrame:
    """Daily totals against the average of the days with spend among the ``days`` before.

    Each daily total is handed on to the following days and grouped by day again, so no window over
    the whole calendar is needed. ``is_alert`` is true above ``percent`` of that average, false when
    there is no earlier day to compare with.
    """
    daily = df.filter(F.col(day).isNotNull()).groupBy(day).agg(F.sum(amount).alias("spend"))
    shares = daily.select(
        F.explode(F.sequence(F.lit(0), F.lit(days))).alias("ahead"), day, "spend"
    )
    own = F.col("ahead") == 0
    grouped = shares.groupBy(F.date_add(day, F.col("ahead")).alias(day)).agg(
        F.max(F.when(own, F.col("spend"))).alias("spend"),
        F.sum(F.when(~own, F.col("spend"))).alias("earlier_spend"),
        F.count_if(~own).alias("earlier_days"),
    )
    above = F.col("spend") * F.col("earlier_days") * 100 > F.col("earlier_spend") * percent
    return grouped.filter(F.col("spend").isNotNull()).withColumn(
        "is_alert", F.coalesce(above, F.lit(False))
    )


def revenue_by_region_month(facts: DataFrame, countries: DataFrame, country: str) -> DataFrame:
    """Revenue per region and order month; countries outside the lookup count as Unknown.

    Facts are summed per country and month before the lookup joins in.
    """
    totals = facts.groupBy(country, "order_month").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("revenue_usd").alias("revenue_usd")
    )
    lookup = countries.select(F.col("country_code").alias(country), "region")
    named = join_on_hot_key(totals, lookup, country, spread_by=[country, "order_month"])
    region = F.coalesce("region", F.lit("Unknown")).alias("region")
    return named.groupBy(region, "order_month").agg(
        F.sum("order_count").alias("order_count"), F.sum("revenue_usd").alias("revenue_usd")
    )
