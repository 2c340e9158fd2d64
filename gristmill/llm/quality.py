"""Quality by positive-unlabelled learning.

Trusted positives (labels.quality = 1) and unlabelled web text train a small
perceptron with the non-negative unbiased risk and an estimated class prior.
Its inputs describe how a text is written: shares of ASCII characters, and the
make-up and repetition of words and lines. See toxicity.py for the sample, which
takes one text of each drawn id.

Defined cases: a null or empty text has all-zero inputs and is scored like any
other; a null doc_id isn't held out and never trains; without a trusted positive every score is 0, without unlabelled text 1;
repeated rows are scored one by one. Extra columns of docs are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pu, tokens
from .common import held_out, small_batches
from .toxicity import fitting_sample

MAX_POSITIVE, MAX_UNLABELLED = 8000, 8000
THRESHOLD, HIDDEN, N_SHAPE = 0.7, 24, 14
N_INPUTS = 129 + N_SHAPE
_CLASS = np.minimum(np.arange(256), 128)
_NEWLINE = tokens.separators(b"\n")


def inputs(batch: pa.RecordBatch) -> np.ndarray:
    """One row of numbers for each text of a batch."""
    buf, at = tokens.raw(batch.column(batch.schema.get_field_index("text")))
    n = len(at) - 1
    size = np.diff(at)
    of_byte = np.repeat(np.arange(n, dtype=np.int64), size)
    shares = np.bincount(of_byte * 129 + _CLASS[buf], minlength=n * 129).reshape(n, 129) / np.maximum(size, 1)[:, None]
    words, of, _ = tokens.word_hashes(buf, at)
    plain, of_plain, _ = tokens.word_hashes(buf, at, tokens.PLAIN, tokens.LOWER)
    lines, of_line, _ = tokens.word_hashes(buf, at, _NEWLINE)
    n_words, n_plain, n_lines = np.diff(of), np.diff(of_plain), np.diff(of_line)

    def distinct(h: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values, and the count of the most frequent one, in each text."""
        text = np.repeat(np.arange(n), np.diff(of))
        order = np.lexsort((h, text))
        t, v = text[order], h[order]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1])
        runs = np.diff(np.append(np.flatnonzero(new), len(t)))
        most = np.zeros(n, np.int64)
        np.maximum.at(most, t[new], runs)
        return np.bincount(t[new], minlength=n), most

    d_words, m_words = distinct(plain, of_plain)
    d_lines, m_lines = distinct(lines, of_line)
    triples = tokens.shingles(words, 3)
    valid = np.arange(len(triples)) + 3 <= np.repeat(of[1:], n_words)[: len(triples)]
    d_triples, m_triples = distinct(triples[valid], np.append(0, np.cumsum(np.maximum(n_words - 2, 0))))
    upper = shares[:, 65:91].sum(1)
    letters = upper + shares[:, 97:123].sum(1) + shares[:, 128]
    share = lambda a, b: a / np.maximum(b, 1)
    shape = [np.log1p(size), np.log1p(n_words), np.log1p(n_lines), np.log1p(share(size, n_words)), np.log1p(share(size, n_lines)), np.log1p(share(n_words, n_lines)), share(d_words, n_plain), share(m_words, n_plain), share(d_lines, n_lines), share(m_lines, n_lines), share(d_triples, n_words), share(m_triples, n_words), upper / np.maximum(letters, 1e-9), letters]
    return np.column_stack([np.sqrt(shares), *shape])


@dataclass
class Model:
    """A perceptron and the scaling of its inputs; always: a constant score instead."""

    net: pu.Net | None
    mean: np.ndarray
    scale: np.ndarray
    prior: float
    always: float | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.always is not None:
            return np.full(len(x), self.always)
        return pu.sigmoid(self.net.forward(np.clip((x - self.mean) / self.scale, -6, 6)))


def _featurise(parts):
    for part in parts:
        for batch in tokens.batches(part):
            x = inputs(batch).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("__pos")), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * N_INPUTS, pa.int32()), pa.array(x.ravel()))], ["pos", "x"])


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Train from trusted positives (labels.quality = 1) and unlabelled web text."""
    small_batches(docs.sparkSession)
    sample, prior = fitting_sample(docs, labels, "quality", max_positive, max_unlabelled, seed=12)
    got = sample.mapInArrow(_featurise, "pos boolean, x array<float>").orderBy("x", "pos").toArrow()
    pos = got["pos"].to_numpy()
    if not pos.any() or pos.all():
        return Model(None, np.zeros(1), np.ones(1), prior, 1.0 if pos.any() else 0.0)
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(len(pos), N_INPUTS).astype(float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    x = np.clip((x - mean) / scale, -6, 6)
    return Model(pu.train(x[pos], x[~pos], prior, HIDDEN, epochs=40, rate=0.005, decay=1e-3), mean, scale, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with __score, for every row."""
    small_batches(docs.sparkSession)

    def scored(parts):
        for part in parts:
            for batch in tokens.batches(part):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model(inputs(batch)))], [*batch.schema.names, "__score"])

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with their columns."""
    return score(docs, fit(docs, labels)).where(F.col("__score") >= THRESHOLD).select(*docs.columns)
