"""One run: each enabled dataset from its files to documents, prepare records and post-processed outputs."""

from __future__ import annotations

import json
import traceback
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import slug
from ..operators import mcq, param_pool, pretty
from ..operators.adapters import adapt, prepare
from ..operators.filters import exclude_ids, load_blacklist
from ..operators.sampling import exact_probability, hash_sample, token_budget, with_tokens
from ..sources.config import Dataset, file_stats, load_configs, pick_source, source_files
from ..sources.readers import read
from ..sources.sinks import files_for, write_jsonl


@dataclass
class Options:
    """What the command line sets for all datasets of a run."""

    system_ratio: float = 0.0
    mixed: str = ""
    disable_pool: bool = False
    limit: int = -1
    documents: bool = True
    seed: str = "pool"


def documents(spark: SparkSession, dataset: Dataset, root: str, options: Options, blacklist: DataFrame | None = None) -> DataFrame | None:
    """The documents of a dataset after exclusion, sampling and budget; None if it has no usable source."""
    source = pick_source(dataset, root)
    files = source_files(source, root) if source else []
    if not files:
        return None
    with_raw = options.documents and not options.mixed
    docs = adapt(read(spark, source["type"], files), dataset.adapter, dataset.name, dataset.path, options.system_ratio, with_raw)
    if options.limit >= 0:
        docs = docs.limit(options.limit)
    if blacklist is not None:
        docs = exclude_ids(docs, blacklist, bool(options.mixed))
    if dataset.token_budget:
        docs = with_tokens(docs, dataset.chars_per_token)
        if not options.disable_pool:  # thin out first, so the prefix spreads over all files
            docs = hash_sample(docs, exact_probability(docs, dataset.token_budget), F.col("id"), options.seed)
        order = [F.sha1(F.concat(F.lit(options.seed), "id").cast("binary")), F.col("id")]
        docs = token_budget(docs, dataset.token_budget, order).drop("tokens")
    return docs


def _augment(records: DataFrame, step: dict, pool: DataFrame | None) -> DataFrame:
    most, n = int(step.get("max_param_values_neg", 3)), int(step.get("mcq_every_n") or 0)
    return mcq.augment_every(records, n, F.col("__pos"), pool=pool, most=most)


#: Steps that change records; param_pool is kept beside them.
STEPS: dict[str, Callable[[DataFrame, dict, DataFrame | None], DataFrame]] = {"tool_mcq": _augment}


def postprocess(records: DataFrame, steps: list[dict], stored_pool: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """M7, M8: records after the chain of steps, and the pool if one was built."""
    pool = None
    if not any(s["kind"] != "param_pool" for s in steps):
        pass
    elif "__pos" not in records.columns:
        # positions are those of the records in the order of their ids
        from ..operators.sampling import running_sum

        one = records.withColumn("__one", F.lit(1).cast("long"))
        records = running_sum(one, "__one", [F.col("uuid")], "__pos").withColumn("__pos", F.col("__pos") - 1).drop("__one")
    for step in steps:
        kind = step["kind"]
        if kind == "param_pool":
            pool = param_pool.pool_from_texts(records, "uuid", int(step.get("max_values", 120)))
        elif kind in STEPS:
            records = STEPS[kind](records, step, pool if pool is not None else (param_pool.from_json(records.sparkSession, stored_pool) if stored_pool else None))
        else:
            raise ValueError(f"unknown postprocess kind: {kind}")
    return records.drop("__pos"), pool


def run_dataset(spark: SparkSession, dataset: Dataset, root: str, out: str, options: Options, blacklist: DataFrame | None = None) -> dict | None:
    """Write one dataset's outputs; returns its counts, or None if it was skipped."""
    if not dataset.enabled:
        return None
    docs = documents(spark, dataset, root, options, blacklist)
    if docs is None:
        return None
    name, seen = slug(dataset.name), Observation()
    docs = with_tokens(docs, dataset.chars_per_token).observe(seen, F.count("*").alias("docs"), F.sum("tokens").alias("tokens")).drop("tokens").persist()
    try:
        source = pick_source(dataset, root)
        files = dataset.merge_to_files or files_for(file_stats(source_files(source, root))[1], dataset.shard_mb)
        records = prepare(docs, bool(options.mixed))
        target = f"{out}/mixed/{slug(options.mixed)}/{name}" if options.mixed else f"{out}/prepare/{name}"
        write_jsonl(records, target, files)
        if options.documents and not options.mixed:
            write_jsonl(docs.select("text", "id", "metadata"), f"{out}/{name}", files)
        if dataset.steps:
            post = f"{target}_{dataset.postprocess.get('output_subdir') or 'post'}"
            done, pool = postprocess(records, dataset.steps)
            write_jsonl(done, post, files)
            if pool is not None:
                pool.write.mode("overwrite").parquet(f"{post}_pool")
            if dataset.postprocess.get("pretty_txt"):
                pretty.pretty_records(done).select("record").write.mode("overwrite").option("lineSep", "\n").text(f"{post}_pretty")
        return {"dataset": dataset.name, **{k: v or 0 for k, v in seen.get.items()}}
    finally:
        docs.unpersist()


def run(spark: SparkSession, config_dir: str, root: str, out: str, options: Options | None = None, exclude_ids_dir: str = "") -> int:
    """All datasets in the order of their files. 0; 1 after the first that fails; 2 without configurations."""
    options = options or Options()
    datasets = load_configs(config_dir)
    if not datasets:
        return 2
    blacklist = load_blacklist(spark, exclude_ids_dir).persist() if exclude_ids_dir else None
    done = []
    for dataset in datasets:
        try:
            done.append(run_dataset(spark, dataset, root, out, options, blacklist))
        except Exception:  # the run stops here, with the reason
            traceback.print_exc()
            return 1
    stats = [json.dumps(d) for d in done if d]
    spark.createDataFrame([(s,) for s in stats], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/_stats")
    return 0
