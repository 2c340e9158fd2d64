"""python -m gristmill.cli COMMAND: normalise, build-param-pool, augment, classify, pretty."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.variant import as_string, member
from .operators import mcq, param_pool, pretty
from .plans.pipeline import Options, run
from .session import session
from .sources.readers import read_jsonl
from .sources.sinks import write_jsonl, write_split


def records(spark: SparkSession, path: str) -> DataFrame:
    """(pos, uuid, text) of prepare records; an id or the line's number stands in for a missing uuid."""
    raw = read_jsonl(spark, [path])
    own = F.coalesce(*[F.nullif(as_string(member(F.col("raw"), k)), F.lit("")) for k in ("uuid", "id")], F.concat(F.lit("line:"), F.col("pos") + 1))
    return raw.select("pos", own.alias("uuid"), F.coalesce(as_string(member(F.col("raw"), "text")), F.lit("")).alias("text"))


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="gristmill", description="Prepare language-model training text")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, what: str, output: bool = True) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=what)
        p.add_argument("-i", "--input", required=True)
        p.add_argument("-o", "--output", required=output, default="")
        return p

    p = commands.add_parser("normalise", help="run all dataset configurations of a folder")
    p.add_argument("--datasets-root", required=True)
    p.add_argument("--config-dir", required=True)
    p.add_argument("--out-root", required=True)
    p.add_argument("--system-ratio", type=float, default=0.0)
    p.add_argument("--mixed", default="")
    p.add_argument("--exclude-ids-dir", default="")
    p.add_argument("--disable-pool", action="store_true")
    p.add_argument("--limit", type=int, default=-1)
    p.add_argument("--shard-jsonl-mb", type=float, default=0, help="no effect: Spark splits files")
    p.add_argument("--workers", type=int, help="no effect: set Spark's cores")
    p = command("build-param-pool", "pool of parameter values of the calls in prepare records")
    p.add_argument("--max-values", type=int, default=120)
    p = command("augment", "questions in front of tool calls")
    p.add_argument("--param-pool", default="", help="a pool as JSON")
    p.add_argument("--max-param-values-neg", type=int, default=3)
    p.add_argument("--every-n", type=int, default=0)
    command("classify", "records split by the tags in their texts")
    p = command("pretty", "records for people to read", output=False)
    p.add_argument("-n", "--num-records", type=int)
    p.add_argument("--plain", action="store_true", help="leave JSON in calls as it is")
    a = top.parse_args(argv)
    spark = session("gristmill")
    if a.command == "normalise":
        return run(spark, a.config_dir, a.datasets_root, a.out_root, Options(a.system_ratio, a.mixed, a.disable_pool, a.limit), a.exclude_ids_dir)
    rows = records(spark, a.input)
    if a.command == "build-param-pool":
        pool = param_pool.pool_from_texts(rows, "uuid", a.max_values)
        if a.output.endswith(".json"):
            with open(a.output, "w", encoding="utf-8") as f:
                f.write(param_pool.to_json(pool) + "\n")
        else:
            pool.write.mode("overwrite").parquet(a.output)
    elif a.command == "augment":
        pool = None
        if a.param_pool:
            with open(a.param_pool, encoding="utf-8") as f:
                pool = param_pool.from_json(spark, f.read())
        write_jsonl(mcq.augment_every(rows, a.every_n, F.col("pos"), pool=pool, most=a.max_param_values_neg).select("uuid", "text"), a.output)
    elif a.command == "classify":
        split = pretty.classify(rows.select("uuid", "text"))
        write_split(split, a.output)
        for r in pretty.bucket_counts(split).collect():
            print(f"{r['bucket']}: {r['n']}")
    else:
        if a.num_records is not None:
            rows = rows.where(F.col("pos") < a.num_records)
        if a.plain:
            shown = pretty.pretty_blocks(rows, "uuid", as_json=False).select(F.col("pretty").alias("record"))
        else:
            shown = pretty.pretty_records(rows, number=F.lit(""))
        if a.output:
            shown.select("record").write.mode("overwrite").text(a.output)
        else:
            for r in shown.toLocalIterator():
                print(r["record"])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
