"""What the operators share: cut lineage, skew-proof joins, folds, connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 16
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a temporary one only where none is set."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _own:
        _own[key] = tempfile.mkdtemp(prefix="gristmill-")
        atexit.register(shutil.rmtree, _own[key], True)
    return f"file://{_own[key]}"


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "part") -> DataFrame:
    """df as a table written to the shared folder: lost executors lose none of it."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Keep Arrow batches of whole texts small; long texts come many to a batch otherwise."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], salts: int = SALTS, hint: str | None = None) -> DataFrame:
    """left join right, where right has each key once and one key may hold a large share of left.

    Left rows go to one of `salts` parts by the columns of spread, and right's
    rows are sent to all of these parts. hint "merge" keeps right from being
    broadcast where it happens to be small.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.hint(hint) if hint else copies
    return left.withColumn("__salt", salt).join(copies, [*keys, "__salt"], "left").drop("__salt")


def key128(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes, as columns k1 and k2."""
    return [F.xxhash64(*columns).alias("k1"), F.xxhash64(F.lit("b"), *columns).alias("k2")]


def held_out(doc_id: Column) -> Column:
    """Is the document in the fold that labels are never learnt from?"""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """edges (a, b), both long -> (id, root): the smallest id of each connected component.

    Each round lowers a node's root to the smallest root beside it, then jumps
    to that root's root, so rounds grow with the logarithm of the diameter.
    Nothing but a count reaches the driver. Empty edges give no rows.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), name)
    roots = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("root")), name)
    while True:
        beside = both.join(roots, both.a == roots.id).groupBy(F.col("b").alias("id")).agg(F.min("root").alias("low"))
        # the ids whose root is r, and r's own root, without a hot join: r's root goes to the ids through salted copies
        lower = roots.join(beside, "id", "left").select("id", "root", F.least("root", "low").alias("next"))
        lower = cut(lower, name)
        up = lower.select(F.col("id").alias("next"), F.col("next").alias("up"))
        heads = up.join(lower.select("next").distinct(), "next", "left_semi")
        jumped = salted_left_join(lower, heads, ["next"], ["id"], hint="merge").select("id", "root", F.coalesce(F.least("next", "up"), "next").alias("next"))
        jumped = cut(jumped, name)
        moved = jumped.where("next <> root").limit(1).count()
        roots = jumped.select("id", F.col("next").alias("root"))
        if not moved:
            return roots
