"""Quality rules with cross-document line frequency.

Base rules look at one text: its number of words, and the share of words inside
8-word windows that come twice or more in it. The method looks across texts:
lines are normalised (stripped, lower case, digits as 0) and hashed, and for each
host the distinct documents that hold a line are counted. A line in more than
MAX_DOCS documents of a host is removed from the host's documents; a document that
is left with under MIN_WORDS words, or under KEEP of its words, is rejected.

Words are maximal runs of anything but ASCII white space.

Defined cases: a null or empty text has no words and fails the base rules; a null
host is a host of its own; rows that repeat a doc_id are judged one by one and count
as one document, and so do all rows without a doc_id; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import cut, salted_left_join, small_batches

MIN_WORDS, MAX_REPEAT, WINDOW = 20, 30, 8
MAX_DOCS, KEEP = 20, 0.3
_SYMBOL = tokens.separators(b"#*$%&|<>")
_BLANK = " \t\n\x0b\x0c\r"
_DIGITS = {ord(c): "0" for c in "123456789"}


def _repeats(h: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each text, the words in WINDOW-word windows that come twice or more in it."""
    n = np.diff(of)
    windows = tokens.shingles(h, WINDOW)
    text = np.repeat(np.arange(len(n)), n)
    place = np.flatnonzero(np.arange(len(windows)) + WINDOW <= of[1:][text[: len(windows)]])
    v, t = windows[place], text[place]
    order = np.lexsort((v, t))
    v, t = v[order], t[order]
    same = np.zeros(len(v), bool)
    equal = (v[1:] == v[:-1]) & (t[1:] == t[:-1])
    same[1:] |= equal
    same[:-1] |= equal
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, place[order][same], 1)
    np.add.at(edge, place[order][same] + WINDOW, -1)
    return tokens.per_text(np.cumsum(edge)[:-1] > 0, of)


def _lines(text: str, n_words: np.ndarray) -> tuple[int, dict[bytes, int]]:
    """Lines with a word that equal an earlier line; and each distinct normal line's hash with its words."""
    seen, repeated, held = set(), 0, {}
    for line, n in zip(text.split("\n"), n_words.tolist(), strict=True):
        if n:
            repeated += line in seen
            seen.add(line)
            key = hashlib.blake2b(line.strip(_BLANK).lower().translate(_DIGITS).encode(), digest_size=16).digest()
            held[key] = held.get(key, 0) + n
    return repeated, held


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measured(parts):
    for part in parts:
        for batch in tokens.batches(part):
            column = batch.column(batch.schema.get_field_index("text"))
            buf, at = tokens.raw(column)
            h, of, starts = tokens.word_hashes(buf, at)
            # words of each line, by where lines and words start
            heads = np.sort(np.concatenate([at[:-1], np.flatnonzero(buf == 10) + 1]), kind="stable")
            per_line = np.diff(np.append(np.searchsorted(starts, heads), len(starts)))
            lines_of = np.append(0, np.cumsum(1 + tokens.per_text(buf == 10, at)))
            found = [_lines(t or "", per_line[lines_of[i] : lines_of[i + 1]]) for i, t in enumerate(column.to_pylist())]
            held = [x for _, x in found]
            keys = np.frombuffer(b"".join(k for x in held for k in x), "<i8").reshape(-1, 2)
            flat = pa.StructArray.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([n for x in held for n in x.values()], pa.int64())], ["k1", "k2", "n"])
            numbers = [
                np.diff(of),
                tokens.per_text(~tokens.WORDS[buf] & ((buf & 0xC0) != 0x80), at),
                tokens.per_text(_SYMBOL[buf], at),
                np.array([n for n, _ in found], np.int64),
                _repeats(h, of),
            ]
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) for x in held])), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *(pa.array(x.astype(np.int64)) for x in numbers), listed], [*(batch.schema.names[i] for i in keep), *NAMES, "lines"])


def measure(docs: DataFrame) -> DataFrame:
    """docs without text, with the five base numbers and the lines (hash and words) of each row."""
    small_batches(docs.sparkSession)
    fields = [*docs.drop("text").schema.fields, *(T.StructField(name, T.LongType()) for name in NAMES)]
    return docs.mapInArrow(_measured, T.StructType([*fields, T.StructField("lines", T.ArrayType(T.StructType([T.StructField(k, T.LongType()) for k in ("k1", "k2", "n")])))]))


def losses(base: DataFrame) -> DataFrame:
    """row and lost, the words in lines above the limit; only rows with such lines.

    base has row, doc_id, host (a hash of it) and lines.
    """
    lines = base.select("row", "doc_id", "host", F.inline("lines"))
    docs = lines.select("host", "k1", "k2", "doc_id").distinct().groupBy("host", "k1", "k2").agg(F.count("*").alias("docs"))
    over = docs.where(F.col("docs") > MAX_DOCS)
    # the lines above the limit grow with the corpus, so they aren't broadcast at any size
    found = salted_left_join(lines.select("row", "host", "k1", "k2", "n"), over, ["host", "k1", "k2"], ["row"], hint="merge")
    return found.where("docs is not null").groupBy("row").agg(F.sum("n").alias("lost"))


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base numbers, base_failed and kept of every row of docs."""
    host = F.xxhash64(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    rows = docs.select("doc_id", host.alias("host"), "text")
    # the written table fixes the numbers of the rows
    base = cut(measure(rows).withColumn("row", F.monotonically_increasing_id()), "measured")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    kept = ~failed & (left >= MIN_WORDS) & (left >= KEEP * F.col("n_words"))
    return base.drop("lines").join(losses(base), "row", "left").select("doc_id", *NAMES, failed.alias("base_failed"), kept.alias("kept"))
