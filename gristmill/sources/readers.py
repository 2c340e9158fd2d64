"""Readers: files to (file, pos, raw), one row for each record, raw a VARIANT that holds an object."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.variant import is_object, parse_json

BLANK_LINE = r"^[\s\x1c-\x1f\x85\xa0]*\z"


def wrapped(v: Column) -> Column:
    """An object as it is, anything else as the member `value` of one."""
    return F.when(is_object(v), v).otherwise(F.to_variant_object(F.struct(v.alias("value"))))


def numbered_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, pos, value): every physical line with its index in its file.

    Blocks of a file are read by different tasks. A line's index is its place in
    its block plus the lines of the file's earlier blocks, which is a sum over one
    row a block: no file goes through a single task.
    """
    lines = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = W.Window.partitionBy("file").orderBy("block").rowsBetween(W.Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("id") - F.col("first") + F.col("before")).alias("pos"), "value")


def parsed(lines: DataFrame) -> DataFrame:
    """numbered lines with v (null if the line isn't JSON) and status: blank, null, bad or ok."""
    v = parse_json(F.col("value"))
    status = F.when(F.col("value").rlike(BLANK_LINE), "blank").when(F.col("v").isNull(), "bad").when(F.is_variant_null("v"), "null").otherwise("ok")
    return lines.withColumn("v", v).withColumn("status", status)


def read_jsonl(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines of JSON; blank, null and invalid ones are dropped, but count in the positions."""
    return parsed(numbered_lines(spark, files)).where("status = 'ok'").select("file", "pos", wrapped(F.col("v")).alias("raw"))


def line_report(spark: SparkSession, files: list[str]) -> DataFrame:
    """lines of each status in each file."""
    return parsed(numbered_lines(spark, files)).groupBy("file", "status").count()


def array_items(chunks: Iterable[str]) -> Iterator[object]:
    """The items of a top-level JSON array that comes in pieces.

    Surplus commas and white space are passed over, what follows the closing
    bracket is ignored, nothing comes of an empty text. ValueError if the text
    doesn't open an array or ends before it is closed.
    """
    decoder, source = json.JSONDecoder(), iter(chunks)
    buf, done, opened = "", False, False

    def more() -> bool:
        nonlocal buf, done
        piece = next(source, None)
        if piece is None:
            done = True
            return False
        buf += piece
        return True

    while True:
        buf = buf.lstrip(" \t\r\n," if opened else " \t\r\n﻿")
        if not buf:
            if more():
                continue
            if opened:
                raise ValueError("the array isn't closed")
            return
        if not opened:
            if buf[0] != "[":
                raise ValueError("not an array")
            opened, buf = True, buf[1:]
            continue
        if buf[0] == "]":
            return
        try:
            item, end = decoder.raw_decode(buf)
        except ValueError:
            if more():
                continue
            raise ValueError("the array isn't closed") from None
        is_number = isinstance(item, int | float) and not isinstance(item, bool)
        if is_number and (end == len(buf) or buf[end] not in " \t\r\n,]") and not done and more():  # it may go on
            continue
        buf = buf[end:]
        yield item


def _pieces(data: bytes, size: int = 1 << 20) -> Iterator[str]:
    import codecs

    decoder = codecs.getincrementaldecoder("utf-8")()
    for at in range(0, len(data), size):
        yield decoder.decode(data[at : at + size], at + size >= len(data))


def _decoded(parts):
    names, places, texts = [], [], []
    for part in parts:
        for name, data in zip(part.column(0), part.column(1), strict=True):
            try:
                for n, item in enumerate(array_items(_pieces(data.as_py()))):
                    names.append(name.as_py())
                    places.append(n)
                    texts.append(json.dumps(item, ensure_ascii=False))
                    if len(texts) == 1000:
                        yield pa.RecordBatch.from_pydict({"file": names, "pos": pa.array(places, pa.int64()), "json": texts})
                        names, places, texts = [], [], []
            except (ValueError, UnicodeDecodeError):
                pass  # what came before the fault stays
    yield pa.RecordBatch.from_pydict({"file": pa.array(names, pa.string()), "pos": pa.array(places, pa.int64()), "json": pa.array(texts, pa.string())})


def read_json_array(spark: SparkSession, files: list[str]) -> DataFrame:
    """S3: items of top-level arrays. A file that is no array gives none, a truncated one its whole items."""
    items = spark.read.format("binaryFile").load(files).select("path", "content").mapInArrow(_decoded, "file string, pos long, json string")
    return items.select("file", "pos", wrapped(F.try_parse_json(F.col("json"))).alias("raw"))


def _rows(frame: DataFrame, position: Column) -> DataFrame:
    own = [F.col(f"`{c}`") for c in frame.columns]
    return frame.select(F.col("_metadata.file_path").alias("file"), position.alias("pos"), F.to_variant_object(F.struct(*own)).alias("raw"))


def read_parquet(spark: SparkSession, files: list[str]) -> DataFrame:
    """Rows as objects. Values that JSON lacks become strings."""
    return _rows(spark.read.parquet(*files), F.col("_metadata.row_index"))


def read_csv(spark: SparkSession, files: list[str]) -> DataFrame:
    """Rows of strings under the header's names; positions are row numbers inside a file's block."""
    frame = spark.read.csv(files, header=True, inferSchema=False)
    return _rows(frame, F.monotonically_increasing_id())


READERS: dict[str, Callable[[SparkSession, list[str]], DataFrame]] = {"jsonl": read_jsonl, "json_array": read_json_array, "parquet": read_parquet, "csv": read_csv}


def read(spark: SparkSession, kind: str, files: list[str]) -> DataFrame:
    """The reader of a source's type."""
    if kind not in READERS:
        raise ValueError(f"unknown source type: {kind}")
    return READERS[kind](spark, files)
