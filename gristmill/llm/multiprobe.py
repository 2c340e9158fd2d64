"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product is nearest Euclidean distance once every vector x gets the
coordinate sqrt(R^2 - |x|^2), R the largest norm of all, and a query gets 0.
Each of TABLES tables hashes with a few p-stable functions floor((a.x + b) / width);
the outermost cells are open, so a table has a fixed number of buckets. A query
visits its tables' buckets in the order of the estimated probability that a
neighbour fell there, until it has made as many probes as the fitted target
recall takes, and never fewer than give it k other vectors.

Probes and vectors meet by bucket, large buckets in blocks of BLOCK vectors and of
as many queries as ASKING, in matrix products that keep the best of each block, scored again in double
precision on the original vectors. The most likely bucket of each table comes
first; its best bound what the other buckets need to send on, so that what is
merged over tables doesn't grow with the number of probes.

Equal vectors are one class that carries its k + 1 smallest ids, which is all
that any query can return of it.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without a vec_id; rows that repeat a vec_id
count once (the first vector in order); with k or fewer candidates all are
returned; an empty table gives no rows. Extra columns are ignored. Vectors that
have another length than most aren't comparable and raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import cut

#: 4 ** 10 buckets a table keep to PER_BUCKET vectors up to 2 * 10 ** 9; their sizes (32 MB) go to all tasks.
K, TABLES, CELLS, MAX_FUNCTIONS = 20, 4, 4, 10
#: Vectors (and as many as a fifth of them as queries) that the numbers of probes are fitted on.
SAMPLE, TARGET, BLOCK, PER_BUCKET = 4096, 0.95, 4096, 2048
#: Queries that meet a block of vectors at once, and probes that a query's order starts with.
ASKING, PROBES = 16384, 64


@dataclass
class Plan:
    """Projections (tables x functions x dimension + 1), shifts, width, radius, spread and probes."""

    a: np.ndarray
    b: np.ndarray
    width: float
    radius: float
    spread: float
    probes: int
    sizes: np.ndarray  # of each table's buckets; its length is fixed by the parameters

    @property
    def buckets(self) -> int:
        return CELLS ** self.a.shape[1]

    def project(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.radius**2 - (x * x).sum(1), 0))
        return np.einsum("nd,tfd->tnf", np.column_stack([x, extra]), self.a) + self.b[:, None, :]

    def cell(self, p: np.ndarray) -> np.ndarray:
        """0 .. CELLS - 1: floor(p / width), with the outermost cells open."""
        return np.clip(np.floor(p / self.width).astype(np.int64) + CELLS // 2, 0, CELLS - 1)

    def bucket(self, x: np.ndarray) -> np.ndarray:
        """tables x n."""
        c = self.cell(self.project(x))
        return (c * CELLS ** np.arange(c.shape[2])).sum(2)

    def order(self, x: np.ndarray, most: int) -> np.ndarray:
        """tables x n x min(most, buckets): the buckets likeliest to hold a neighbour, by falling probability."""
        p = self.project(x, True)
        edges = (np.arange(1, CELLS) - CELLS // 2) * self.width
        below = _phi((edges - p[..., None]) / self.spread)
        below = np.concatenate([np.zeros_like(below[..., :1]), below, np.ones_like(below[..., :1])], -1)
        log = np.log(np.maximum(np.diff(below, axis=-1), 1e-12))
        total, bucket = np.zeros((*p.shape[:2], 1)), np.zeros((*p.shape[:2], 1), np.int64)
        for f in range(p.shape[2]):  # bucket = sum of cell * CELLS ** f
            total = (log[:, :, f, :, None] + total[:, :, None, :]).reshape(*p.shape[:2], -1)
            bucket = (np.arange(CELLS)[:, None] * CELLS**f + bucket[:, :, None, :]).reshape(total.shape)
            # what lies behind `most` better beginnings can't become one of the best
            best = np.argsort(-total, axis=-1, kind="stable")[..., :most]
            total, bucket = np.take_along_axis(total, best, -1), np.take_along_axis(bucket, best, -1)
        return bucket

    def visits(self, x: np.ndarray, k: int):
        """Table, rows of x, the buckets that these visit, and the buckets' places in the rows' orders; in parts."""
        left, most = np.arange(len(x)), max(PROBES, self.probes)
        while len(left):
            again = []
            step = max(1, min(256, (1 << 16) // most))
            for some in (left[i : i + step] for i in range(0, len(left), step)):
                order = self.order(x[some], most)
                seen = np.stack([np.cumsum(self.sizes[t][order[t]], 1) for t in range(TABLES)])
                done = (seen[:, :, -1] > k).all(0) | (order.shape[2] == self.buckets)
                again.append(some[~done])
                for t in range(TABLES):
                    before = np.column_stack([np.zeros(len(some), np.int64), seen[t][:, :-1]])
                    visit = (np.arange(order.shape[2]) < self.probes) | (before <= k)
                    row, nth = np.nonzero(visit & (self.sizes[t][order[t]] > 0) & done[:, None])
                    yield t, some[row], order[t][row, nth], nth
            left, most = np.concatenate(again), 4 * most


def _phi(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, closely enough to order buckets."""
    return 1 / (1 + np.exp(-np.clip(x * (1.5976 + 0.070566 * x * x), -40, 40)))


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), -1)


def plain(vectors: DataFrame):
    """The embedding in its own kind of number, without negative zeros."""
    kind = "array<float>" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "array<double>"
    return F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0).cast(kind)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors that take part, each vec_id once."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", plain(vectors).alias("embedding"))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def clean(vectors: DataFrame, k: int) -> DataFrame:
    """class_id, embedding and ids: distinct usable vectors, each with its k + 1 smallest ids."""
    nth = F.row_number().over(W.Window.partitionBy("embedding").orderBy("vec_id"))
    few = usable(vectors).withColumn("nth", nth).where(F.col("nth") <= k + 1)
    return few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("class_id"), "embedding", "ids")


def fit(index: DataFrame, k: int, seed: int = 5) -> Plan | None:
    """Choose widths and numbers of probes on a bounded sample, bucket sizes over all classes."""
    n, r2, shortest, longest = index.select(F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x).alias("q"), F.size("embedding").alias("d")).agg(F.count("*"), F.max("q"), F.min("d"), F.max("d")).first()
    if not n:
        return None
    if shortest != longest:
        raise ValueError(f"vectors of {shortest} and of {longest} components")
    drawn = index.select("embedding", F.xxhash64(F.lit(seed), "class_id").alias("o")).orderBy("o").limit(SAMPLE).toPandas()
    x = _matrix(drawn["embedding"])
    r = np.random.Generator(np.random.PCG64(seed))
    functions = int(np.clip(round(np.log(max(n, 1) / PER_BUCKET) / np.log(CELLS)), 1, MAX_FUNCTIONS))
    radius = float(np.sqrt(r2))
    q = x[: max(1, len(x) // 5)]
    wanted = min(k + 1, len(x))
    score = q @ x.T
    near = np.argsort(-score, axis=1)[:, :wanted]
    far2 = (q * q).sum(1)[:, None] + radius**2 - 2 * np.take_along_axis(score, near, 1)
    spread = float(np.sqrt(max(np.median(far2), 1e-12)))
    a = r.normal(size=(TABLES, functions, x.shape[1] + 1))
    plan = Plan(a, np.zeros((TABLES, functions)), 1.0, radius, spread, 1, np.zeros(0, np.int64))
    flat = plan.project(x)
    plan.b = -np.median(flat, axis=1) + r.uniform(-0.25, 0.25, (TABLES, functions)) * flat.std()
    plan.width = float(np.percentile(np.abs(flat + plan.b[:, None, :]), 50))
    if wanted > 1:
        bucket, most = plan.bucket(x), PROBES
        while True:
            rank = _first_probes(plan, q, bucket[:, near[:, 1:]], most)
            plan.probes = int(np.quantile(rank, TARGET, method="higher")) + 1
            if plan.probes <= most or most >= plan.buckets:
                break
            most *= 4
    else:
        plan.probes = plan.buckets
    counted = index.select("embedding").mapInPandas(lambda parts: _counted(parts, plan), "t int, bucket int, n long").groupBy("t", "bucket").agg(F.sum("n").alias("n")).toPandas()
    plan.sizes = np.zeros((TABLES, plan.buckets), np.int64)
    plan.sizes[counted["t"], counted["bucket"]] = counted["n"]
    return plan


def _first_probes(plan: Plan, q: np.ndarray, buckets: np.ndarray, most: int) -> np.ndarray:
    """The first probe of q, in any table, of one of each neighbour's buckets (tables x q x neighbours); `most` for none."""
    rank = np.full(buckets.shape[1:], most)
    for i in range(len(q)):
        order = plan.order(q[i : i + 1], most)[:, 0]
        for t in range(TABLES):
            by = np.argsort(order[t])
            at = by[np.minimum(np.searchsorted(order[t], buckets[t, i], sorter=by), len(by) - 1)]
            rank[i] = np.minimum(rank[i], np.where(order[t][at] == buckets[t, i], at, most))
    return rank


def _asked(parts, plan: Plan, k: int):
    for part in parts:
        if len(part):
            for t, _, bucket, _ in plan.visits(_matrix(part["embedding"]), k):
                v, n = np.unique(bucket, return_counts=True)
                yield pd.DataFrame({"t": t, "bucket": v, "n": n})


def _spread(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)


def _copies(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's number as often as it has copies, and the copies' numbers."""
    row = np.repeat(np.arange(len(times)), times)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)


def _counted(parts, plan: Plan):
    for part in parts:
        if len(part):
            b = plan.bucket(_matrix(part["embedding"]))
            for t in range(TABLES):
                v, n = np.unique(b[t], return_counts=True)
                yield pd.DataFrame({"t": t, "bucket": v, "n": n})


def _best(q: np.ndarray, x: np.ndarray, k: int, bound: np.ndarray):
    """Row numbers of the k + 1 best of x for each q that reach its bound, and those as good in other roundings."""
    s = q @ x.T
    if s.shape[1] > k + 1:
        bound = np.maximum(bound, np.partition(s, -(k + 1), axis=1)[:, -(k + 1)])
    return np.nonzero(s >= (bound - 1e-9 * np.maximum(1, np.abs(np.nan_to_num(bound, neginf=0))))[:, None])


def search(vectors: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each query, the ids divisible by `every`."""
    spark = vectors.sparkSession
    index = cut(clean(vectors, k), "vectors")
    empty = "query_id long, rank int, vec_id long, score double"
    plan = fit(index, k)
    if plan is None:
        return spark.createDataFrame([], empty)
    # a query's class is found by its vector: a large class doesn't carry all its ids
    of_query = usable(vectors).where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("e"))
    own = cut(of_query.join(index.select("class_id", "embedding"), F.col("e") == F.col("embedding")).select("query_id", F.col("class_id").alias("query")), "own")
    queries = index.select("class_id", "embedding").join(own.select(F.col("query").alias("class_id")).distinct(), "class_id")
    queries = cut(queries, "queries")
    blocks = np.maximum(1, -(-plan.sizes // BLOCK)).astype(np.int32)
    asked = queries.select("embedding").mapInPandas(lambda parts: _asked(parts, plan, k), "t int, bucket int, n long").groupBy("t", "bucket").agg(F.sum("n").alias("n"))
    asked = asked.where(F.col("n") > ASKING).toPandas()
    turns = np.ones_like(blocks)
    turns[asked["t"], asked["bucket"]] = -(-asked["n"] // ASKING)

    def members(parts):
        for part in parts:
            if not len(part):
                continue
            b = plan.bucket(_matrix(part["embedding"]))
            ids, vectors = part["class_id"].to_numpy(), part["embedding"].to_numpy()
            for t in range(TABLES):
                block = _spread(ids) % blocks[t][b[t]]
                row, turn = _copies(turns[t][b[t]])
                yield pd.DataFrame({"t": t, "bucket": b[t][row], "block": block[row], "turn": turn, "class_id": ids[row], "embedding": vectors[row]})

    def probes(parts, late: bool):
        """A query's most likely bucket of each table, or (late) all others that it visits."""
        for part in parts:
            if not len(part):
                continue
            ids, vectors, bound = (part[c].to_numpy() for c in ("class_id", "embedding", "bound"))
            for t, of, bucket, nth in plan.visits(_matrix(part["embedding"]), k):
                now = (nth > 0) == late
                row, block = _copies(blocks[t][bucket[now]])
                of, bucket = of[now][row], bucket[now][row]
                turn = _spread(ids[of]) % turns[t][bucket]
                yield pd.DataFrame({"t": t, "bucket": bucket, "block": block, "turn": turn, "class_id": ids[of], "embedding": vectors[of], "bound": bound[of]})

    def met(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": pd.Series(dtype="int64"), "class_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        x, ids = _matrix(right["embedding"]), right["class_id"].to_numpy()
        out = []
        for lo in range(0, len(left), 512):
            q = _matrix(left["embedding"].iloc[lo : lo + 512])
            of = left["class_id"].to_numpy()[lo : lo + 512]
            i, j = _best(q, x, k, left["bound"].to_numpy()[lo : lo + 512])
            out.append(pd.DataFrame({"query": of[i], "class_id": ids[j], "score": (q[i] * x[j]).sum(1)}))
        return pd.concat(out)

    schema = f"t int, bucket int, block int, turn int, class_id long, embedding {index.schema['embedding'].dataType.simpleString()}"
    at = ["t", "bucket", "block", "turn"]
    held = index.select("class_id", "embedding").mapInPandas(members, schema).groupBy(*at)

    def meet(asking: DataFrame, late: bool) -> DataFrame:
        sent = asking.mapInPandas(lambda parts: probes(parts, late), f"{schema}, bound double")
        return sent.groupBy(*at).cogroup(held).applyInPandas(met, "query long, class_id long, score double").distinct()

    # each class once; a query's own class counts, so k + 1 classes hold k other ids at least
    nearest = W.Window.partitionBy("query").orderBy(F.col("score").desc(), "class_id")
    top = lambda rows: rows.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k + 1).select("query", "class_id", "score")
    low = F.lit(float("-inf"))
    first = cut(top(meet(queries.withColumn("bound", low), False)), "nearest")
    # what the first probes found is a bound for the others: less than the (k + 1)th best can't be among the best
    reached = first.groupBy(F.col("query").alias("class_id")).agg(F.when(F.count("*") > k, F.min("score")).alias("bound"))
    rest = meet(queries.join(reached, "class_id", "left").withColumn("bound", F.coalesce("bound", low)), True)
    found = top(first.union(rest).distinct())
    named = found.join(index.select("class_id", "ids"), "class_id").select("query", "score", F.explode("ids").alias("vec_id"))
    best = W.Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    out = own.join(named, "query").where("vec_id <> query_id").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
