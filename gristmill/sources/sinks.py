"""Writers of JSON lines, rolled, merged or split by a column."""

from __future__ import annotations

import heapq
import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import running_sum


def scratch(spark: SparkSession) -> str:
    """A fresh folder in the one that a cluster shares; a temporary one only for a local session without it."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return f"{conf.rstrip('/')}/q-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{tempfile.mkdtemp(prefix='gristmill-')}/q"


def stored(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: computed once, and of a size that Spark knows when it plans joins."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_json_lines(df: DataFrame) -> DataFrame:
    """K1: one compact JSON object for each row; null fields are left out, VARIANTs are written as they are."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def write_jsonl(df: DataFrame, path: str, files: int = 0, mode: str = "overwrite") -> None:
    """K1, K3, K4, K6: df as JSON lines below path, in about that many files (0: as Spark has it)."""
    lines = as_json_lines(df)
    if files > 0:
        lines = lines.repartition(files)
    lines.write.mode(mode).text(path)


def with_shard(df: DataFrame, size: Column, target: int, order: list[Column]) -> DataFrame:
    """K2: df with shard: rows in order fill shards of target bytes, each row going where its first byte falls."""
    sized = running_sum(df.withColumn("__size", size.cast("long")), "__size", order, "__end")
    return sized.withColumn("shard", F.floor((F.col("__end") - F.col("__size")) / F.lit(int(target))).cast("long")).drop("__size", "__end")


def write_rolled(df: DataFrame, path: str, target: int, order: list[Column]) -> None:
    """K2: JSON lines in one folder for each shard of about target bytes, rows in order."""
    rows = df.select(*order_columns(order), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
    keys = [F.col(c) for c in rows.columns if c != "value"]
    shards = with_shard(rows, F.octet_length("value") + 1, target, keys)
    shards.repartition("shard").sortWithinPartitions("shard", *keys).select("value", "shard").write.mode("overwrite").partitionBy("shard").text(path)


def order_columns(order: list[Column]) -> list[Column]:
    return [c.alias(f"__order{i}") for i, c in enumerate(order)]


def lpt_bins(sizes: dict[str, int], n: int) -> dict[str, int]:
    """A bin for each file: the largest first, always into the emptiest bin; ties by name and number."""
    heap = [(0, b) for b in range(n)]
    bins = {}
    for name, size in sorted(sizes.items(), key=lambda kv: (-kv[1], kv[0])):
        total, b = heapq.heappop(heap)
        bins[name] = b
        heapq.heappush(heap, (total + size, b))
    return bins


def file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files below a folder; their contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")


def merge_files(spark: SparkSession, source: str, target: str, n: int) -> None:
    """The lines of all files below source in n files of about equal size, target/merged=<bin>; source stays.

    Whole files go to bins by size. Only their names and sizes reach the driver.
    """
    sizes = {r["path"]: r["length"] for r in file_sizes(spark, source).collect()}
    bins = spark.createDataFrame(list(lpt_bins(sizes, max(1, n)).items()), "__file string, merged int")
    lines = spark.read.option("recursiveFileLookup", "true").text(source).select("value", F.col("_metadata.file_path").alias("__file"))
    lines.join(bins, "__file").select("value", "merged").repartition("merged").write.mode("overwrite").partitionBy("merged").text(target)


def write_split(df: DataFrame, path: str, column: str = "bucket") -> None:
    """M9: JSON lines in one folder for each value of a column."""
    lines = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns if c != column])).alias("value"), column)
    lines.write.mode("overwrite").partitionBy(column).text(path)


def files_for(total_bytes: int, shard_mb: float) -> int:
    return max(1, math.ceil(total_bytes / (shard_mb * 1e6))) if shard_mb > 0 else 0
