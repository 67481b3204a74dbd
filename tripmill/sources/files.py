"""Readers for landed files and the export of served tables. Any URI Spark can open works."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Only the parts of an area file that are used; the outline stays JSON text.
AREA_FILE = T.StructType().add(
    "features",
    T.ArrayType(
        T.StructType()
        .add("properties", T.StructType().add("area_num_1", "string").add("community", "string"))
        .add("geometry", T.StringType())
    ),
)


def read_raw_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Raw trips with every column as text: no inference pass over the data.

    Column names come from the header unless ``schema`` names them; files whose header
    differs are refused instead of being read in the wrong order.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """Zone dimension (area_num_1, community, geometry) from a GeoJSON file."""
    file = spark.read.schema(AREA_FILE).option("multiLine", True).json(path)
    return file.select(F.explode("features").alias("f")).select(
        "f.properties.area_num_1", "f.properties.community", "f.geometry"
    )


def write_csv(df: DataFrame, path: str, order_by: str = "trip_date") -> None:
    """One CSV file with a header, for a served table (one row per day or zone)."""
    df.orderBy(order_by).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
