"""Sampling and budgets. All choices hash ids, so they repeat and don't depend on partitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.text import est_tokens, stable_u


def hash_sample(rows: DataFrame, share: float, key: Column, seed: str = "") -> DataFrame:
    """L1, L2, L4: rows whose key's hash is under share."""
    keyed = F.concat(F.lit(seed), key) if seed else key
    return rows.where(stable_u(keyed) < float(share))


def with_tokens(docs: DataFrame, chars_per_token: float = 4.0, text: str = "text") -> DataFrame:
    return docs.withColumn("tokens", est_tokens(F.col(text), chars_per_token))


def exact_probability(docs: DataFrame, budget: int) -> float:
    """L3 from a sum over all documents' tokens instead of file sizes."""
    total = docs.agg(F.sum("tokens")).first()[0] or 0
    return 1.0 if budget <= 0 else min(1.0, budget / max(1, total))


def running_sum(docs: DataFrame, value: str, order: list[Column], out: str = "running", parts: int | None = None) -> DataFrame:
    """docs with the sum of value over all rows up to each, in one order over everything.

    Rows are dealt by ranges of the order; sums of whole parts, a few numbers on
    the driver, are added to running sums inside each part. Nothing is sorted in
    a single task. Ties must be broken by the order for the result to repeat.
    """
    spark = docs.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()).persist()
    sums = dealt.groupBy("__part").agg(F.sum(value)).collect()
    before, total = {}, 0
    for part, here in sorted(sums):
        before[part] = total
        total += here or 0
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("__part")) if before else F.lit(0)
    local = F.sum(value).over(W.Window.partitionBy("__part").orderBy(*order).rowsBetween(W.Window.unboundedPreceding, 0))
    return dealt.withColumn(out, local + offset).drop("__part")


def token_budget(docs: DataFrame, budget: int, order: list[Column], scope: str = "global", ranks: int = 1) -> DataFrame:
    """The longest prefix of docs (with tokens) that stays in the budget, and always the first one.

    scope "rank" deals rows round-robin to ranks in that order, and gives each an
    equal share of the budget, rounded up.
    """
    if budget <= 0:
        return docs
    if scope == "global":
        summed = running_sum(docs, "tokens", order, "__run")
        return summed.where((F.col("__run") <= budget) | (F.col("__run") == F.col("tokens"))).drop("__run")
    if scope != "rank":
        raise ValueError(f"unknown scope: {scope}")
    ranked = round_robin(docs, ranks, order)
    by_rank = W.Window.partitionBy("rank").orderBy(*order)
    summed = ranked.withColumn("__run", F.sum("tokens").over(by_rank.rowsBetween(W.Window.unboundedPreceding, 0))).withColumn("__n", F.row_number().over(by_rank))
    return summed.where((F.col("__run") <= math.ceil(budget / ranks)) | (F.col("__n") == 1)).drop("__run", "__n")


def round_robin(docs: DataFrame, ranks: int, order: list[Column]) -> DataFrame:
    """Docs with rank, their number in the order modulo ranks."""
    numbered = running_sum(docs.withColumn("__one", F.lit(1).cast("long")), "__one", order, "__nth")
    return numbered.withColumn("rank", F.pmod(F.col("__nth") - 1, F.lit(ranks)).cast("int")).drop("__one", "__nth")


def shuffled_files(files: list[str], seed: str) -> list[str]:
    """Files in a reproducible random order."""
    import hashlib

    return sorted(files, key=lambda f: hashlib.sha1(f"{seed}|{f}".encode()).hexdigest())
