"""Toxicity by non-negative positive-unlabelled learning.

The classifier is a small perceptron over the presence of hashed words and word
stems, trained in numpy from confirmed toxic texts and unlabelled texts with the
risk estimator of pu.py. A bounded sample of texts, drawn by hash order over all
ids, is fitted; the class prior comes from all rows, and every whole text is scored.

Defined cases: a null or empty text has no words and gets the score of an
all-zero input; a null doc_id isn't held out and never trains; repeated rows are scored
one by one, and one of an id's texts (the last in order) can be fitted; labels that repeat or clash count as positive if any row is; without
any confirmed positive every score is 0, and where no word tells the texts apart,
the class prior. Extra columns of docs are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pu, tokens
from .common import cut, held_out, small_batches

#: Most confirmed positives and unlabelled texts that are fitted.
MAX_POSITIVE, MAX_UNLABELLED = 4000, 12000
BITS, FEATURES, THRESHOLD = 20, 512, 0.3
#: A word is used if knowing it explains so many nats of the labels at least.
MIN_GAIN = 9.0
#: Bytes of a word that make its stem.
STEM = 4
HIDDEN = 8


@dataclass
class Model:
    """Chosen hashed words and the perceptron over them; always: a constant score instead."""

    words: np.ndarray
    net: pu.Net | None
    prior: float
    always: float | None = None


def fitting_sample(docs: DataFrame, labels: DataFrame, label: str, max_positive: int, max_unlabelled: int, seed: int = 11) -> tuple[DataFrame, float]:
    """The texts to fit, (text, positive), and the class prior of the unlabelled ones.

    Only rows outside the held-out fold take part. Ids are drawn by seeded hash
    order, and of the rows that repeat an id one text is taken, so that there are
    max_positive + max_unlabelled rows at most. Only their ids are broadcast.
    """
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(label).alias("__y"))
    rows = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    rows = rows.join(known, "doc_id", "left").select("doc_id", (F.coalesce("__y", F.lit(0)) == 1).alias("__pos"), F.col("__y").isNotNull().alias("__known"))
    rows = rows.withColumn("__order", F.xxhash64(F.lit(seed), "doc_id")).persist()
    n, n_known, n_pos = rows.agg(F.count("*"), F.sum(F.col("__known").cast("long")), F.sum(F.col("__pos").cast("long"))).first()
    drawn = [rows.where(c).orderBy("__order", "doc_id").limit(k).select("doc_id", "__pos") for c, k in ((F.col("__pos"), max_positive), (~F.col("__pos"), max_unlabelled))]
    ids = docs.sparkSession.createDataFrame(drawn[0].union(drawn[1]).toPandas(), "doc_id long, __pos boolean")
    rows.unpersist()
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "__pos").agg(F.max("text").alias("text"))
    return texts.select("text", "__pos"), pu.class_prior(n or 0, n_known or 0, n_pos or 0)


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct (text, hashed word or stem of a word) of a batch."""
    buf, at = tokens.raw(batch.column(batch.schema.get_field_index("text")))
    h, of, starts = tokens.word_hashes(buf, at, tokens.PLAIN, tokens.LOWER)
    text = np.repeat(np.arange(len(of) - 1), np.diff(of)) << BITS
    stems = tokens.stem_hashes(buf, at, starts, STEM, tokens.PLAIN, tokens.LOWER)
    pairs = np.unique(np.concatenate([text | (x >> np.uint64(64 - BITS)).astype(np.int64) for x in (h, stems)]))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _featurise(parts):
    for part in parts:
        for batch in tokens.batches(part):
            text, word = _words(batch)
            cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
            found = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(word.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("__pos")), found], ["pos", "words"])


def telling(found: DataFrame, n1: int, n0: int, features: int) -> np.ndarray:
    """The hashed words that explain most of the labels of n1 + n0 texts, at most `features` of them.

    Words are counted and ranked in Spark; only the chosen ones reach the driver.
    """
    counts = found.select(F.col("pos").cast("long").alias("pos"), F.explode("words").alias("word")).groupBy("word").agg(F.sum("pos").alias("in_pos"), F.count("*").alias("in_all"))
    a, b, both = (F.col("in_pos") + 0.5) / (n1 + 1), (F.col("in_all") - F.col("in_pos") + 0.5) / (n0 + 1), (F.col("in_all") + 0.5) / (n1 + n0 + 1)
    nats = lambda n, x: n * (x * F.log(x / both) + (1 - x) * F.log((1 - x) / (1 - both)))
    ranked = counts.where("in_all >= 3").withColumn("gain", nats(F.lit(n1), a) + nats(F.lit(n0), b)).where(F.col("gain") >= MIN_GAIN)
    return np.sort(ranked.orderBy(F.col("gain").desc(), "word").limit(features).select("word").toPandas()["word"].to_numpy(np.int64))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, features: int = FEATURES) -> Model:
    """Train from confirmed toxic texts (labels.toxic = 1) and unlabelled ones."""
    small_batches(docs.sparkSession)
    sample, prior = fitting_sample(docs, labels, "toxic", max_positive, max_unlabelled)
    found = cut(sample.mapInArrow(_featurise, "pos boolean, words array<int>"), "words")
    n1, n0 = found.agg(F.count_if("pos"), F.count_if(~F.col("pos"))).first()
    if not n1 or not n0:
        return Model(np.zeros(0, np.int64), None, prior, 1.0 if n1 else 0.0)
    chosen = telling(found, n1, n0, features)
    if not len(chosen):  # nothing tells the texts apart
        return Model(chosen, None, prior, prior)

    def told(parts):
        """A text's chosen words as a row of bits: a bounded row of the matrix, whatever the text's length."""
        place = np.full(1 << BITS, -1)
        place[chosen] = np.arange(len(chosen))
        for part in parts:
            words = part.column(1)
            row, k = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy()), place[words.flatten().to_numpy()]
            x = np.zeros((len(words), len(chosen)), bool)
            x[row[k >= 0], k[k >= 0]] = True
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in np.packbits(x, axis=1)], pa.binary())], ["pos", "bits"])

    got = found.select("pos", "words").mapInArrow(told, "pos boolean, bits binary").orderBy("bits", "pos").toArrow()
    pos = got["pos"].to_numpy()
    x = np.unpackbits(np.frombuffer(b"".join(got["bits"].to_pylist()), np.uint8).reshape(len(pos), -1), axis=1, count=len(chosen)).astype(np.float32)
    return Model(chosen, pu.train(x[pos], x[~pos], prior, HIDDEN, epochs=40, rate=0.01, decay=1e-4), prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs."""
    small_batches(docs.sparkSession)

    def scored(parts):
        place = np.full(1 << BITS, -1)
        place[model.words] = np.arange(len(model.words))
        for part in parts:
            for batch in tokens.batches(part):
                out = np.full(batch.num_rows, model.always or 0.0)
                if model.net is not None:
                    text, word = _words(batch)
                    k = place[word]
                    text, k = text[k >= 0], k[k >= 0]
                    w, b, v, c = model.net.p
                    hidden = np.column_stack([np.bincount(text, w[k, j], batch.num_rows) for j in range(len(b))])
                    out = pu.sigmoid(np.maximum(hidden + b, 0) @ v + c[0])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit, then score every whole text."""
    return score(docs, fit(docs, labels))
