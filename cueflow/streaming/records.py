"""Records as a stream: files of JSON lines come in, and each micro-batch goes out by disposition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cueflow.operators.quality import disposed
from cueflow.sources.tables import RECORD


def read_records(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def write_disposed(records: DataFrame, out: str, checkpoint: str, forbidden: Sequence[str] = (), language: Column | None = None) -> StreamingQuery:
    """Parquet files in a folder for each disposition, exactly once; stops when the files at hand are done."""
    marked = disposed(records, forbidden, language)
    return marked.writeStream.format("parquet").partitionBy("disposition").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
