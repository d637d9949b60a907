"""New documents as a stream: cleaning and chunking are row by row, so a stream needs no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import chunk, clean


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) of Parquet files as they come."""
    return spark.readStream.schema("doc_id long, text string").parquet(folder)


def cleaned_chunks(stream: DataFrame) -> DataFrame:
    return chunk.chunks(clean.clean(stream, "doc_id"), "doc_id")
