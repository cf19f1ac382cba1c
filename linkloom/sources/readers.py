"""Reading: CSV and Parquet, dated folders of an object store, databases, snapshots."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATEGORY_SQL = "category_id string, level_one string, level_two string, level_three string, source string, updated_at string"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def union(*frames: DataFrame) -> DataFrame:
    """All rows, columns by name; missing ones are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def date_prefix(text: str) -> str:
    """YYYYMMDD from a date with any separators; an error if it isn't a date."""
    digits = re.sub(r"\D", "", text)
    if len(digits) != 8:
        raise ValueError(f"not a date: {text}")
    datetime.strptime(digits, "%Y%m%d")
    return digits


def csv_strings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A CSV with a header, every column a string and blanks kept as empty strings. Only the header is read beforehand."""
    read = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", False)
    df = read.csv(path)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def csv(spark: SparkSession, path: str | list[str], schema: str | None = CATEGORY_SQL) -> DataFrame:
    """A CSV with a header and known columns, in the header's order."""
    df = spark.read.option("header", True).option("escape", '"').csv(path)
    if schema is None:
        return df
    types = dict(x.split() for x in schema.split(", "))
    return df.select(*[F.col(f"`{c}`").cast(types.get(c, "string")).alias(c) for c in df.columns])


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def category_folder(root: str, source: str, date: str) -> str:
    return f"{root.rstrip('/')}/{source}/raw/{date_prefix(date)}/categories.csv"


def dated_categories(spark: SparkSession, root: str, sources: list[str], date: str, *, renamed: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """The categories of several sources on a day; a source without a source column gets its name. ``renamed`` gives, by source, columns under other names."""
    frames = []
    for s in sources:
        df = csv_strings(spark, category_folder(root, s, date)).withColumnsRenamed((renamed or {}).get(s, {}))
        frames.append(df if "source" in df.columns else df.withColumn("source", F.lit(s)))
    return union(*frames)


def query(spark: SparkSession, sql: str, *, url: str | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """Rows of a query: over JDBC with a URL, else over the session's tables."""
    if not sql.strip():
        raise ValueError("the query is empty")
    if url is None:
        return spark.sql(sql)
    return spark.read.format("jdbc").options(url=url, query=sql, **(properties or {})).load()


def table(spark: SparkSession, name: str, columns: list[str] | None = None, where: str | None = None, *, url: str | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """Columns and rows of a table; both are pushed down to the source."""
    df = spark.table(name) if url is None else spark.read.format("jdbc").options(url=url, dbtable=name, **(properties or {})).load()
    df = df.where(where) if where else df
    return df.select(*columns) if columns else df


def snapshot(spark: SparkSession, path: str | None, make, *, use: bool = True, save: bool = True) -> DataFrame:
    """What was saved at the path, if it is there and wanted; else the result of ``make()``, saved there if wanted."""
    if path and use and exists(spark, path):
        return spark.read.parquet(path)
    df = make()
    if path and save:
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    return df


def left_right(left: DataFrame, rights: list[DataFrame]) -> DataFrame:
    """One left table and several right ones, tagged in match_side."""
    if not rights:
        raise ValueError("there must be a right table")
    return union(left.withColumn("match_side", F.lit("left")), *[r.withColumn("match_side", F.lit("right")) for r in rights])


def with_global_ids(categories: DataFrame, mapping: DataFrame) -> DataFrame:
    """Categories with the global ids that a mapping gives their category_id. An id that the mapping has several times gives several rows."""
    return categories.join(mapping.select("category_id", "global_id"), "category_id", "left")
