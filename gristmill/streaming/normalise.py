"""Incremental normalisation: new JSON-lines files become prepare records once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.variant import parse_json
from ..operators.adapters import adapt, prepare
from ..operators.filters import exclude_ids
from ..sources.readers import wrapped


def stream_records(spark: SparkSession, folder: str) -> DataFrame:
    """(file, pos, raw) of lines that arrive; pos is a hash of the line, since a stream has no line numbers."""
    lines = spark.readStream.text(folder).select("value", F.col("_metadata.file_path").alias("file"))
    v = parse_json(F.col("value"))
    return lines.where(v.isNotNull() & ~F.is_variant_null(v)).select("file", F.abs(F.xxhash64("value")).alias("pos"), wrapped(v).alias("raw"))


def normalise_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, kind: str, dataset: str, blacklist: DataFrame | None = None) -> StreamingQuery:
    """Start a query that takes all files not yet seen and stops; call it again for the next ones."""
    docs = adapt(stream_records(spark, folder), kind, dataset)
    if blacklist is not None:
        docs = exclude_ids(docs, blacklist)
    writer = prepare(docs).writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
