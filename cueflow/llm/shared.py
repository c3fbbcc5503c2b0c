"""Where operators keep what more than one step reads."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; in local mode, as in tests, a temporary one becomes it where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cueflow-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it: cuts lineage, and survives lost executors.

    The table goes when the application ends, or when :func:`release` is called.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(hadoop).deleteOnExit(target)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def tables_written(spark: SparkSession) -> list[str]:
    """The tables that :func:`materialise` has written and nobody has released."""
    return list(_written.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, paths: Sequence[str] | None = None) -> None:
    """Deletes tables, all unless told which; only for callers that have stored every result read from them."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    own = _written.get(spark.sparkContext.applicationId, [])
    for path in list(own) if paths is None else paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop).delete(target, True)
        own.remove(path)


def ranked(rows: DataFrame, by: str) -> DataFrame:
    """Adds ``rank``, from 0, in the order of a column with null last, without bringing all rows together."""
    placed = materialise(rows.orderBy(F.asc_nulls_last(by)).withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))  # a row for each partition
    before = sizes.agg(F.array_sort(F.collect_list(F.struct("part", "rows"))).alias("all")).select(
        F.explode(F.transform("all", lambda x: F.struct(x["part"].alias("part"), F.aggregate(F.filter("all", lambda y: y["part"] < x["part"]), F.lit(0).cast("long"), lambda s, y: s + y["rows"]).alias("before")))).alias("x")
    )
    joined = placed.withColumn("part", part).join(before.select("x.part", "x.before"), "part")
    return joined.withColumn("rank", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "place", "before")


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
