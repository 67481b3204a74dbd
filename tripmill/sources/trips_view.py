"""Trip-shaped view over the star-schema test tables (see FIXTURES.md, section 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Source columns that end the order of copies of one trip.
TIE_BREAK = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trips(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    customers = _table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    suppliers = _table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers first, so that the many line items are shuffled once, by order.
    rows = (
        _table(spark, folder, "lineitem")
        .join(orders.join(customers, F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    seconds = (F.col("l_partkey") * 131 + F.col("l_orderkey") * 17) % 23000 - 200
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    ends = F.timestamp_add("SECOND", seconds.cast("int"), F.col("l_shipdate"))
    return rows.select(
        F.when(F.col("l_partkey") % 97 != 0, (F.col("l_orderkey") * 10 + line).cast("string")).alias("trip_id"),
        F.col("l_shipdate").alias("trip_start_timestamp"),
        F.when(~((F.col("l_suppkey") % 50 == 3) & (line == 1)), ends).alias("trip_end_timestamp"),
        seconds.alias("trip_seconds"),
        (quantity * F.when(line == 7, 2.5).otherwise(0.5)).alias("trip_miles"),
        F.col("l_extendedprice").alias("fare"),
        F.col("l_discount").alias("tips"),
        F.col("l_tax").alias("tolls"),
        F.col("c_acctbal").alias("extras"),
        F.when(~((line == 5) & (quantity == 13)), F.col("o_totalprice")).alias("trip_total"),
        F.when(
            ~((F.col("o_orderpriority") == "5-LOW") & (F.col("l_returnflag") == "A")), F.col("c_nationkey")
        ).alias("pickup_community_area"),
        F.when(F.col("s_nationkey") != 7, F.col("s_nationkey")).alias("dropoff_community_area"),
        F.col("l_shipdate").cast("date").alias("trip_date"),
        *TIE_BREAK,
    )


def areas(spark: SparkSession, folder: str) -> DataFrame:
    """Zone dimension: nations as areas, with a stand-in outline."""
    nation = _table(spark, folder, "nation")
    number = F.col("n_nationkey").cast("string")
    return nation.select(
        number.alias("area_num_1"),
        F.col("n_name").alias("community"),
        F.format_string("POINT (%s 0)", number).alias("geometry"),
    )
