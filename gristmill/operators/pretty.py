"""Tagged texts as blocks, and as text for people to read."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import BLANK, let, strip
from ..functions.tools import required_params, text_bucket, tool_description, tool_name, tool_specs

#: An unclosed call runs to the end; any other block to the next tag.
_BLOCK = r"(?s)<\|tool_call\|>.*?(?:</\|tool_call\|>|\z)|<\|[^|>]+\|>(?:[^<]++|<(?!\|[^|>]+\|>))*+|(?:[^<]++|<(?!\|[^|>]+\|>))++"


def split_tagged(text: Column) -> Column:
    """An array of (role, content); text outside of blocks has the role "text", if it isn't blank."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_BLOCK), F.lit(0))

    def block(p: Column) -> Column:
        role = F.regexp_extract(p, r"^<\|([^|>]+)\|>", 1)
        body = F.regexp_replace(p, r"^<\|[^|>]+\|>", "")
        body = F.when(role == "tool_call", F.regexp_replace(body, r"</\|tool_call\|>\z", "")).otherwise(body)
        return F.named_struct(F.lit("role"), F.when(role == "", "text").otherwise(role), F.lit("content"), body)

    return F.filter(F.transform(pieces, block), lambda b: (b["role"] != "text") | (strip(b["content"]) != ""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def pretty_json(contents: pd.Series) -> pd.Series:
    """X14, in arrays of texts: JSON with an indent of two, keys in their order; anything else without white space at its ends."""

    def one(s):
        if s is None:
            return None
        try:
            return json.dumps(json.loads(s), ensure_ascii=False, indent=2)
        except ValueError:
            return s.strip()

    return contents.map(lambda items: None if items is None else [one(s) for s in items])


def indented(text: Column, by: str = "  ") -> Column:
    """Every line that isn't blank moved in."""
    return F.regexp_replace(text, rf"(?m)^(?=[^\n]*[^{BLANK}\n])", by)


def with_pretty(rows: DataFrame, as_json: bool = True) -> DataFrame:
    """rows with pretty in place of __t, a text: its blocks, headed and indented. Each row by itself, without a shuffle."""
    block = lambda b: F.named_struct(F.lit("role"), b["role"], F.lit("content"), strip(b["content"]))
    rows = rows.withColumn("__b", F.filter(F.transform(split_tagged(F.col("__t")), block), lambda b: b["content"] != ""))
    shown = lambda role, content: F.concat(F.lit("["), role, F.lit("]\n"), indented(content))
    if as_json:
        rows = rows.withColumn("__j", pretty_json(F.transform("__b", lambda b: F.when(b["role"].isin("tool_call", "tool_output"), b["content"]))))
        parts = F.zip_with("__b", "__j", lambda b, j: shown(b["role"], F.coalesce(j, b["content"])))
    else:
        parts = F.transform("__b", lambda b: shown(b["role"], b["content"]))
    pretty = F.when(F.contains("__t", F.lit("<|")), F.array_join(parts, "\n")).otherwise(indented(strip(F.col("__t"))))
    return rows.withColumn("pretty", pretty).drop("__t", "__b", "__j")


def pretty_blocks(docs: DataFrame, key: str, text: str = "text", as_json: bool = True) -> DataFrame:
    """Key and pretty, the text with one headed and indented block for each tag."""
    return with_pretty(docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("__t")), as_json).select(key, "pretty")


def pretty_records(docs: DataFrame, key: str = "uuid", text: str = "text", number: Column | None = None) -> DataFrame:
    """Key and record: a header, the tools that the text lists, and its messages."""
    t = F.coalesce(F.col(text), F.lit(""))
    tools = F.transform(
        tool_specs(t),
        lambda s: F.concat(
            F.lit("  - "),
            F.coalesce(F.nullif(tool_name(s), F.lit("")), F.lit("unknown")),
            let(tool_description(s), lambda d: F.when(d != "", F.concat(F.lit("\n"), indented(d, "    "))).otherwise("")),
            let(required_params(s), lambda r: F.when(F.size(r) > 0, F.concat(F.lit("\n    required: "), F.array_join(r, ", "))).otherwise("")),
        ),
    )
    n = F.lit("?") if number is None else number.cast("string")
    head = F.concat(F.lit("=== Record "), n, F.lit(" | id="), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(" ==="))
    both = with_pretty(docs.select(key, head.alias("head"), tools.alias("tools"), t.alias("__t")))
    listed = F.when(F.size("tools") > 0, F.concat(F.lit("\nAvailable tools:\n"), F.array_join("tools", "\n"))).otherwise("")
    return both.select(key, F.concat("head", listed, F.lit("\nMessages:\n"), indented(F.col("pretty")), F.lit("\n")).alias("record"))


def classify(docs: DataFrame, text: str = "text") -> DataFrame:
    """Docs with bucket."""
    return docs.withColumn("bucket", text_bucket(F.coalesce(F.col(text), F.lit(""))))


def bucket_counts(docs: DataFrame) -> DataFrame:
    """Documents of each bucket, both of them even if one is empty."""
    is_sft = F.col("bucket") == "cpt_sft"
    one = docs.agg(F.count_if(is_sft).alias("cpt_sft"), F.count_if(~is_sft).alias("other"))
    return one.select(F.explode(F.create_map(F.lit("cpt_sft"), "cpt_sft", F.lit("other"), "other")).alias("bucket", "n"))


__all__ = ["bucket_counts", "classify", "indented", "pretty_blocks", "pretty_json", "pretty_records", "split_tagged", "with_pretty"]
