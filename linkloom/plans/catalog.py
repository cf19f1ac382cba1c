"""Category and product tables derived from the ``part`` table, with the flaws that real ones have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2025-06-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("p_partkey") % n == 0


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw categories of the sources left and right: nulls, blanks, plurals, capitals, swapped levels."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    right = F.col("p_partkey") % 2 == 1
    swapped = right & _every(11)
    one = F.when(swapped, F.col("p_brand")).otherwise(F.col("p_type"))
    one = F.when(_every(7), F.upper(one)).when(_every(5), F.concat(one, F.lit("s"))).when(_every(19), F.concat(F.lit("Infused "), one)).otherwise(one)
    two = F.when(swapped, F.col("p_type")).when(~right & _every(23), F.col("p_name")).otherwise(F.col("p_brand"))
    three = F.when(_every(13), F.lit(None)).when(_every(17), "").otherwise(F.col("p_name"))
    return p.select(
        F.col("p_partkey").cast("string").alias("category_id"),
        F.when(right, "right").otherwise("left").alias("source"),
        one.alias("level_one"),
        two.alias("level_two"),
        three.alias("level_three"),
        F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), F.col("p_size").cast("int")), "yyyy-MM-dd").alias("updated_at"),
    )


def _any_of(column: Column, *values: str | None) -> Column:
    out = F.when(column == 0, F.lit(values[0]))
    for k, v in enumerate(values[1:], 1):
        out = out.when(column == k, F.lit(v))
    return out


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_size",
        F.col("p_partkey").cast("string").alias("product_key"),
        F.concat_ws(" ", "p_name", F.concat(size.cast("string"), _any_of(size % 3, "g", " mg", " fl oz"))).alias("product_name"),
        F.when(size % 4 == 0, "short").otherwise(F.concat_ws(" ", "p_type", "p_name")).alias("description"),
        F.concat(F.lit("b"), F.substring("p_brand", 7, 4)).alias("brand_id"),
        _any_of(size % 4, "Indica dominant", "Hybrid", "unknown", None).alias("strain_type"),
        _any_of(size % 3, "ca, NY;tx", "wa", "").alias("states"),
        _any_of(size % 4, "USA", "Canada", "mexico", "").alias("country"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _products(spark, sf_dir).where(F.col("p_partkey") % 2 == 0)
    return p.select(
        "product_key", F.lit("feed").alias("source"), "product_name", "description", "brand_id", "strain_type", "states", "country",
        F.when(~_every(3), F.col("p_size").cast("string")).alias("measure"),
        _any_of(F.col("p_size") % 5, "g", "mg", "Ounces", "ml", "each").alias("uom"),
        F.concat(F.col("p_brand"), F.lit(" Inc")).alias("brand_name"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _products(spark, sf_dir).where(F.col("p_partkey") % 2 == 1)
    return p.select(
        "product_key", F.lit("listing").alias("source"), "product_name", "description", "brand_id", "strain_type", "states", "country",
        F.lit(None).cast("string").alias("measure"), F.lit(None).cast("string").alias("uom"),
        F.when(~_every(5), F.col("p_brand")).alias("brand_name"),
        (F.col("p_size") * 1000).cast("string").alias("product_variant_weight_converted_mg"),
        F.lit("g").alias("product_variant_weight_unit"),
        F.col("p_size").cast("string").alias("product_variant_weight_value"),
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.concat(F.lit("b"), F.substring("p_brand", 7, 4)).alias("external_id"), F.col("p_brand").alias("name")).distinct()
