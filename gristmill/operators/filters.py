"""Row filters, and the exclusion of ids that were used before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let, strip
from ..functions.variant import as_string, is_object, kind, member, parse_json

ID_KEYS = ("uuid", "id", "doc_id")
HEAD = 16384


def non_empty(docs: DataFrame, text: str = "text") -> DataFrame:
    """F2."""
    return docs.where(F.coalesce(F.col(text) != "", F.lit(False)))


def every_n(rows: DataFrame, n: int, position: Column, first: int = 0) -> DataFrame:
    """Rows whose physical position, counted from `first` in their file, is a multiple of n."""
    return rows.where((position - first) % n == 0)


def _head_id(line: Column) -> Column:
    """The first id field in a line's head, wherever it is nested, with escapes decoded."""
    head = F.substring(line, 1, HEAD)
    found = [F.regexp_extract(head, rf'"{k}"\s*:\s*"((?:[^"\\]|\\.)*)"', 1) for k in ID_KEYS]
    decoded = [as_string(parse_json(F.concat(F.lit('"'), x, F.lit('"')))) for x in found]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in decoded])


def line_id(line: Column, compat: bool = False) -> Column:
    """The id that a line of an earlier output, or of a plain list, stands for.

    A record's top-level uuid, id or doc_id, strings or numbers; a JSON string without
    its quotes; any other line as it is. compat looks for the first such key at
    any depth of the line's first 16 KiB instead, and keeps bare lines' quotes.
    """
    if compat:
        return let(strip(line), lambda s: F.when(F.startswith(s, F.lit("{")), _head_id(s)).otherwise(F.nullif(s, F.lit(""))))

    def scalar(v: Column) -> Column:
        return F.nullif(F.coalesce(as_string(v), F.when(kind(v) == "BIGINT", F.to_json(v))), F.lit(""))

    def named(s: Column, v: Column) -> Column:
        ids = F.coalesce(*[let(member(v, k), scalar) for k in ID_KEYS])
        return F.when(is_object(v), ids).when(F.startswith(s, F.lit("{")), _head_id(s)).otherwise(F.nullif(F.coalesce(as_string(v), s), F.lit("")))

    return let(strip(line), lambda s: let(parse_json(s), lambda v: named(s, v)))


def load_blacklist(spark: SparkSession, folder: str, compat: bool = False) -> DataFrame:
    """The distinct ids of all files below a folder, gzipped ones too.

    Files that aren't *.jsonl or *.jsonl.gz are plain lists of ids.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(folder).select("value", F.col("_metadata.file_path").alias("file"))
    plain = F.nullif(strip(F.col("value")), F.lit(""))
    ids = F.when(F.col("file").rlike(r"\.jsonl(\.gz)?$"), line_id(F.col("value"), compat)).otherwise(plain)
    return lines.select(ids.alias("id")).where("id is not null").distinct()


def exclude_ids(docs: DataFrame, blacklist: DataFrame, mixed: bool = False) -> DataFrame:
    """Docs whose id isn't listed; documents with an empty id always stay, and so do repeats.

    In mixed mode a listed "<dataset>::<id>" excludes that dataset's document too.
    The join is left to Spark, which broadcasts the list only if it is small.
    """
    listed = blacklist.select(F.col("id").alias("__id")).distinct()
    same = F.col("id") == F.col("__id")
    kept = docs.join(listed, same & (F.col("id") != ""), "left_anti")
    if mixed:
        kept = kept.join(listed, (F.concat(F.col("metadata.dataset"), F.lit("::"), "id") == F.col("__id")) & (F.col("id") != ""), "left_anti")
    return kept
