"""Batch runs fed by a stream of dated folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from linkloom.sources.readers import CATEGORY_SQL


def category_stream(spark: SparkSession, pattern: str) -> DataFrame:
    """New category files (CSV with a header) under a path pattern."""
    return spark.readStream.schema(CATEGORY_SQL).option("header", True).option("enforceSchema", False).csv(pattern)


def for_each_day(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Does ``work`` on each batch of what is there, then stops; a later call goes on where this one ended."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(work).start()
