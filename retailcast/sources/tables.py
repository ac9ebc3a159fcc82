"""Driver tables and the retail daily-sales view derived from them.

The retail view is one row per (ship date, store). ``store`` is the
supplier (``stores=None``, rows grow with the data) or the supplier folded
into ``stores`` buckets (``stores=5`` reproduces the five-store sample).
Weather, holidays and promo type have no source in the driver tables and
are deterministic arithmetic of day-of-year and store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.contract import RAW_COLUMNS, WEEKDAY_NAMES

# ---- fixed values: calendar holidays of the sample (MM-dd -> name) ----
HOLIDAYS = {"01-01": "New Year", "07-04": "Holiday_A", "12-25": "Holiday_B"}
EPOCH = "1995-01-01"
# Weekday bucket (Monday=0) -> name, and the weekend starts at Saturday.
WEEKEND_FROM = 5


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def weekday_name(wd: Column) -> Column:
    expr = None
    for i, name in enumerate(WEEKDAY_NAMES):
        expr = F.when(wd == i, F.lit(name)) if expr is None else expr.when(wd == i, F.lit(name))
    return expr


def retail_daily(spark: SparkSession, sf_dir: str, stores: int | None = None) -> DataFrame:
    """Raw 17-column daily sales rows (see ``contract.RAW_FIELDS``)."""
    li = read_table(spark, sf_dir, "lineitem",
                    "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_shipdate")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_retailprice")
    store = F.col("l_suppkey") if stores is None else (F.col("l_suppkey") % stores) + 1
    # Join then aggregate: partial (map-side) aggregation collapses every map
    # task to at most (days x stores) groups before the shuffle, so a hot
    # store cannot overload one reducer. The join strategy is left to
    # Catalyst/AQE (broadcast only under the size threshold).
    daily = (
        li.join(part, li.l_partkey == part.p_partkey)
        .groupBy(F.to_date("l_shipdate").alias("d"), store.cast("bigint").alias("store_id"))
        .agg(F.sum("l_quantity").cast("bigint").alias("units_sold"),
             F.min("p_retailprice").alias("base_price"),
             F.max("l_discount").alias("discount_pct"))
    )
    return describe(daily)


#: The stored facts of a daily row; ``describe`` derives all other columns from them.
FACTS = ["d", "store_id", "units_sold", "base_price", "discount_pct"]


def describe(daily: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 17 columns of each row of ``FACTS``, and the columns ``keep`` as they are."""
    wd = F.weekday("d")
    doy = F.dayofyear("d").cast("bigint")
    md = F.date_format("d", "MM-dd")
    sid = F.col("store_id")
    temp = (F.lit(250) + (doy * 37 + sid * 11) % 120) / F.lit(10.0)
    rain = ((doy * 53 + sid * 29) % 130) / F.lit(10.0)
    holiday_name = F.coalesce(
        F.element_at(F.create_map(*[x for k, v in HOLIDAYS.items() for x in (F.lit(k), F.lit(v))]), md),
        F.lit("None"))
    flag = lambda c: F.when(c, 1).otherwise(0).cast("int")
    out = (
        daily.select(
            "d", "store_id", "units_sold", "base_price", "discount_pct",
            wd.alias("_wd"), md.alias("_md"),
            temp.alias("max_temp_c"), rain.alias("rainfall_mm"), *keep)
        .select(
            (F.datediff("d", F.lit(EPOCH)).cast("bigint") * 100000000 + sid).alias("record_id"),
            F.date_format("d", "yyyy-MM-dd").alias("date"),
            sid.alias("store_id"),
            weekday_name(F.col("_wd")).alias("day_of_week"),
            flag(F.col("_wd") >= WEEKEND_FROM).alias("is_weekend"),
            flag(F.col("_md").isin(*HOLIDAYS)).alias("is_holiday"),
            holiday_name.alias("holiday_name"),
            "max_temp_c", "rainfall_mm",
            flag(F.col("max_temp_c") >= 32).alias("is_hot_day"),
            flag(F.col("rainfall_mm") >= 5).alias("is_rainy_day"),
            "base_price", "discount_pct",
            flag(F.col("discount_pct") >= 0.08).alias("is_promo"),
            F.when(F.col("discount_pct") >= 0.1, "bundle")
             .when(F.col("discount_pct") >= 0.08, "flyer").otherwise("none").alias("promo_type"),
            (F.col("base_price") * (F.lit(1.0) - F.col("discount_pct"))).alias("final_price"),
            "units_sold", *keep)
    )
    return out.select(*RAW_COLUMNS, *keep)
