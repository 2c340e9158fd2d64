"""Tool specifications and tool calls inside tagged texts, and the types of their values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, lines_of, strip, words_of
from .variant import as_array, as_map, as_string, is_array, is_object, kind, member, objects, parse_json

CALL_OPEN, CALL_CLOSE = "<|tool_call|>", "</|tool_call|>"
CALL = r"(?s)<\|tool_call\|>(.*?)</\|tool_call\|>"


def tool_specs(text: Column) -> Column:
    """The tool objects of the first <tools> span: a JSON list, or else one object a line."""
    none = F.array().cast("array<variant>")

    def found(at: Column) -> Column:
        start, end = at["s"], at["e"]
        inside = strip(F.substring(text, start + 7, F.greatest(end - start - 7, F.lit(0))))
        listed = lambda t: F.when(F.startswith(t, F.lit("[")), as_array(parse_json(t)))
        by_line = lambda t: F.transform(lines_of(t), lambda line: parse_json(strip(line)))
        return F.when((start > 0) & (end > start), let(inside, lambda t: objects(F.coalesce(listed(t), by_line(t))))).otherwise(none)

    return let(F.named_struct(F.lit("s"), F.instr(text, F.lit("<tools>")), F.lit("e"), F.instr(text, F.lit("</tools>"))), found)


def tool_name(tool: Column) -> Column:
    """Function.name if it is a string, else name; empty if neither is."""
    return F.coalesce(as_string(member(tool, "function.name")), as_string(member(tool, "name")), F.lit(""))


def _scalars(items: Column) -> Column:
    named = lambda x: F.coalesce(as_string(x), F.when(kind(x).isin("BIGINT", "BOOLEAN"), F.to_json(x)))
    return F.filter(F.transform(F.coalesce(items, F.array().cast("array<variant>")), named), lambda s: s.isNotNull())


def required_params(tool: Column) -> Column:
    """The strings and whole numbers of function.parameters.required."""
    return _scalars(as_array(member(tool, "function.parameters.required")))


def param_schema(tool: Column) -> Column:
    """Function.parameters.properties as a map, empty if there are none."""
    return F.coalesce(as_map(member(tool, "function.parameters.properties")), F.create_map().cast("map<string,variant>"))


def tool_description(tool: Column) -> Column:
    """Function.description without white space at its ends, else description as it is."""
    return F.coalesce(strip(as_string(member(tool, "function.description"))), as_string(member(tool, "description")), F.lit(""))


def parse_call(payload: Column) -> Column:
    """The object in a call's payload; only what isn't JSON is tried with double quotes for single ones."""
    either = lambda p: F.coalesce(parse_json(p), parse_json(F.replace(p, F.lit("'"), F.lit('"'))))
    return let(let(strip(payload), either), lambda v: F.when(is_object(v), v))


def call_args(call: Column) -> Column:
    """The arguments, an object or a string that holds one; else null."""
    return let(member(call, "arguments"), lambda a: F.when(is_object(a), a).otherwise(let(parse_json(as_string(a)), lambda v: F.when(is_object(v), v))))


def call_payloads(text: Column) -> Column:
    """The payloads of all closed call spans; an open one at the end is none."""
    return F.regexp_extract_all(text, F.lit(CALL), F.lit(1))


def call_names(text: Column) -> Column:
    """The distinct names that are called, in order of their first call."""
    names = F.transform(call_payloads(text), lambda p: as_string(member(parse_call(p), "name")))
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull() & (n != "")))


def value_type(v: Column) -> Column:
    """Boolean, integer, number, array, object, string or unknown."""
    return let(kind(v), _named_type)


def _named_type(k: Column) -> Column:
    return (
        F.when(k == "BOOLEAN", "boolean")
        .when(k.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
        .when(k.isin("DOUBLE", "FLOAT") | F.startswith(k, F.lit("DECIMAL")), F.when(k.rlike(r"DECIMAL\(\d+,0\)"), "integer").otherwise("number"))
        .when(F.startswith(k, F.lit("ARRAY")), "array")
        .when(F.startswith(k, F.lit("OBJECT")), "object")
        .when(k == "STRING", "string")
        .otherwise("unknown")
    )


def string_class(s: Column) -> Column:
    """Url, path_or_uri, long_text, numeric, alnum or general, the first that fits."""
    low = F.lower(s)
    digit = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉]"
    return (
        F.when(low.rlike("^https?://"), "string:url")
        .when(low.rlike("^(file|s3)://") | F.contains(s, F.lit("/")) | F.contains(s, F.lit("\\")), "string:path_or_uri")
        .when(F.size(words_of(s)) >= 6, "string:long_text")
        .when(s.rlike(rf"^{digit}+\z"), "string:numeric")
        .when(s.rlike(digit) & s.rlike(r"\p{L}"), "string:alnum")
        .otherwise("string:general")
    )


def int_cluster(n: Column) -> Column:
    digits = F.when(n == 0, F.lit(1)).otherwise(F.length(F.abs(n).cast("string")))
    sign = F.when(n < 0, "number:negative").when(n == 0, "number:zero").otherwise("number:positive")
    size = F.when(digits <= 1, "single_digit").when(digits <= 2, "two_digits").when(digits <= 4, "four_digits").when(digits <= 8, "eight_digits").otherwise("huge")
    return F.concat_ws(":", sign, size)


def float_cluster(x: Column) -> Column:
    a = F.abs(x)
    return F.when(a == 0, "number:zero").when(a < 1, "number:fraction").when(a < 10, "number:small").when(a < 100, "number:medium").when(a < 1000, "number:large").otherwise("number:huge")


def cluster_label(p_type: Column, v: Column) -> Column:
    """X11: the cluster of a value under the type that its schema, or else the value, has."""

    def label(own: Column) -> Column:
        whole = F.when(own == "boolean", F.try_variant_get(v, "$", "boolean").cast("decimal(38,0)")).when(own == "integer", F.try_variant_get(v, "$", "decimal(38,0)"))
        number = F.when(own.isin("boolean", "integer"), let(whole, int_cluster)).when(own == "number", let(F.try_variant_get(v, "$", "double"), float_cluster)).otherwise("number:other")
        text = F.when(own == "string", let(as_string(v), string_class)).otherwise("string:non_str")
        return F.when(p_type.isin("integer", "number"), number).when(p_type.isin("boolean", "array", "object"), p_type).when(p_type == "string", text).otherwise("unknown")

    return let(value_type(v), label)


def text_bucket(text: Column) -> Column:
    """cpt_sft for texts with both a user's and an assistant's tag, else other."""
    return F.when(F.contains(text, F.lit("<|user|>")) & F.contains(text, F.lit("<|assistant|>")), "cpt_sft").otherwise("other")


def role_tags(text: Column) -> Column:
    """H7: the roles of all tags, in order."""
    return F.regexp_extract_all(text, F.lit(r"<\|([^|>]+)\|>"), F.lit(1))

