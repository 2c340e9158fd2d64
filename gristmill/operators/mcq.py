"""Multiple-choice questions in front of tool calls.

A text is cut at its call spans; each parsed call gets its questions, and the pieces
are joined again in their order, all inside the text's row: only questions about
values, which look into the pool, leave it. Every random choice is an order by SHA-1
of a seed and the item, so that runs agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import by_hash, let
from ..functions.tools import CALL, CALL_CLOSE, call_args, call_payloads, parse_call, required_params, tool_name, tool_specs, value_type
from ..functions.variant import as_map, as_string, display, member, quoted
from ..session import tasks_of
from ..sources.sinks import stored
from .filters import every_n
from .param_pool import alternatives, parsed_calls

LETTERS = ("A", "B", "C", "D")
MAX_NEGATIVES = 3


def render(tag: str, instruction: Column, options: Column, answer: Column) -> Column:
    """A question with lettered options; answer is the option that is right."""
    letters = F.array(*[F.lit(x) for x in LETTERS])

    def asked(o: Column) -> Column:
        listed = F.transform(o, lambda x, i: F.concat(F.lit("  "), F.get(letters, i), F.lit(") "), x))
        right = F.get(letters, (F.array_position(o, answer) - 1).cast("int"))
        head = F.array(F.lit(f"<|{tag}|>"), F.concat(F.lit("Instruction: "), instruction), F.lit("Options:"))
        tail = F.array(F.concat(F.lit("Answer: "), right), F.lit(f"</|{tag}|>"))
        return F.array_join(F.concat(head, listed, tail), "\n")

    return let(options, asked)


def tool_options(name: Column, names: Column, seed: Column) -> Column:
    """The called tool and at most three others, shuffled."""
    others = by_hash(F.filter(names, lambda n: n != name), F.concat(seed, F.lit("|d")))
    return by_hash(F.concat(F.array(name), F.slice(others, 1, 3)), F.concat(seed, F.lit("|o")))


def tool_question(name: Column, names: Column, seed: Column) -> Column:
    asked = render("mcq_tool", F.lit("Choose the next tool to call based on the dialogue context."), tool_options(name, names, seed), name)
    return F.when(F.array_contains(names, name) & (F.size(names) >= 2), asked)


def params_options(required: Column, seed: Column) -> Column:
    """All required parameters, all but the last, one too many, and none."""
    right = F.array_join(required, ", ")
    fewer = F.when(F.size(required) > 1, F.array_join(F.slice(required, F.lit(1), F.greatest(F.size(required) - 1, F.lit(0))), ", ")).otherwise("(none)")
    options = F.array(right, fewer, F.array_join(F.concat(required, F.array(F.lit("extra"))), ", "), F.lit("(none)"))
    # two options may be the same text: the place keeps them apart
    keyed = F.transform(options, lambda o, i: F.concat(i.cast("string"), F.lit(":"), o))
    return F.transform(by_hash(keyed, F.concat(seed, F.lit("|p"))), lambda o: F.substring(o, F.lit(3), F.length(o)))


def params_question(required: Column, seed: Column) -> Column:
    right = F.array_join(required, ", ")
    instruction = F.concat(F.lit("Choose the required parameters for the tool call (Required: "), right, F.lit(")."))
    return F.when(F.size(required) > 0, render("mcq_params", instruction, params_options(required, seed), right))


def args_json(args: Column, field: Column | None = None, value: Column | None = None) -> Column:
    """An argument map (of JSON texts) as an object, with one field's value replaced."""
    pair = lambda e: F.concat(quoted(e["key"]), F.lit(": "), e["value"] if field is None else F.when(e["key"] == field, value).otherwise(e["value"]))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_entries(args)), pair), ", "), F.lit("}"))


def value_negatives(called: DataFrame, pool: DataFrame, keys: list[str], most: int = MAX_NEGATIVES) -> DataFrame:
    """Up to `most` wrong argument objects for each call (keys, name, args, schema, seed), none for calls without arguments.

    Each field in turn takes a value that the pool knows for it: of the function's
    parameter, else of any parameter of that name, else of the type, whichever
    level first has one unlike the call's own.
    """
    if not 0 < most <= MAX_NEGATIVES:
        raise ValueError(f"between 1 and {MAX_NEGATIVES} wrong options have letters")
    shown = F.transform_values(as_map(F.col("args")), lambda k, v: display(v))
    fields = called.select(*keys, "name", "schema", "seed", shown.alias("shown"), F.explode_outer(as_map(F.col("args"))).alias("field", "own"))
    declared = as_string(member(F.element_at("schema", F.col("field")), "type"))
    fields = fields.withColumn("t", F.coalesce(F.nullif(declared, F.lit("")), value_type(F.col("own")))).withColumn("own", display(F.col("own")))
    # where the pool is small, Spark knows it and sends it to the calls; else they meet it in shuffled joins
    choices = stored(alternatives(pool))
    level = lambda name, on, out: choices.where(F.col("level") == name).select(*[F.col(a).alias(b) for a, b in on], F.col("choices").alias(out))
    fields = fields.join(level("function", [("func", "name"), ("param", "field")], "c1"), ["name", "field"], "left")
    fields = fields.join(level("param", [("param", "field")], "c2"), "field", "left").join(level("type", [("t", "t")], "c3"), "t", "left")
    # distinct values: more than one, or one unlike the call's own
    some = lambda c: F.when((F.size(c) > 1) | (F.get(F.col(c), 0) != F.col("own")), F.col(c))
    fields = fields.withColumn("picked", F.coalesce(some("c1"), some("c2"), some("c3"), F.array().cast("array<string>")))
    # from a place that the seed gives, the next values of a list in which neighbours are unrelated
    start = F.conv(F.substring(F.sha1(F.concat("seed", F.lit("|"), "field").cast("binary")), 1, 8), 16, 10).cast("long") % F.greatest(F.size("picked"), F.lit(1))
    fields = fields.withColumn("start", start.cast("int"))
    around = F.concat(F.slice("picked", F.col("start") + 1, F.lit(most + 1)), F.slice("picked", F.lit(1), F.least(F.lit(most + 1), F.col("start"))))
    few = F.slice(F.filter(F.slice(around, 1, most + 1), lambda x: x != F.col("own")), 1, most)
    wrong = F.transform(few, lambda v: args_json(F.col("shown"), F.col("field"), v))
    gathered = fields.select(*keys, "seed", wrong.alias("wrong")).groupBy(*keys).agg(F.first("seed").alias("seed"), F.array_distinct(F.flatten(F.collect_list("wrong"))).alias("wrong"))
    return gathered.select(*keys, F.slice(by_hash(F.col("wrong"), F.concat("seed", F.lit("|n"))), 1, most).alias("wrong"))


def values_question(right: Column, wrong: Column, seed: Column) -> Column:
    options = by_hash(F.concat(wrong, F.array(right)), F.concat(seed, F.lit("|v")))
    return F.when(F.size(wrong) > 0, render("mcq_param_values", F.lit("Choose the correct argument object for the tool call."), options, right))


def _questions(t: Column, key: Column, wrong: Column | None, prefer_values: bool) -> Column:
    """An array with the questions of each call of t, empty for calls that can't be parsed."""
    none = F.array().cast("array<string>")

    def of_row(row: Column) -> Column:
        named = F.filter(F.transform(row["specs"], lambda s: s["name"]), lambda n: n != "")
        called = F.array_distinct(F.filter(F.transform(row["calls"], lambda c: as_string(member(c, "name"))), lambda n: n.isNotNull() & (n != "")))
        return let(F.named_struct(F.lit("calls"), row["calls"], F.lit("specs"), row["specs"], F.lit("names"), F.when(F.size(named) >= 2, named).otherwise(called)), of_calls)

    def of_calls(row: Column) -> Column:
        return F.transform(row["calls"], lambda call, i: F.when(call.isNotNull(), of_call(row, call, i)).otherwise(""))

    def of_call(row: Column, call: Column, i: Column) -> Column:
        seed = F.concat(key.cast("string"), F.lit("|"), i.cast("string"))
        seen = F.named_struct(F.lit("name"), F.coalesce(as_string(member(call, "name")), F.lit("")), F.lit("seed"), seed)
        return let(seen, lambda c: asked(row, call, c, i))

    def asked(row: Column, call: Column, c: Column, i: Column) -> Column:
        required = F.coalesce(F.get(F.filter(row["specs"], lambda s: s["name"] == c["name"]), 0)["required"], none)
        ask_tool, ask_params = tool_question(c["name"], row["names"], c["seed"]), let(required, lambda r: params_question(r, c["seed"]))
        ask_values = F.lit(None).cast("string")
        if wrong is not None:
            right = let(call_args(call), lambda a: args_json(F.transform_values(as_map(a), lambda k, v: display(v))))
            ask_values = let(F.coalesce(F.get(wrong, i), none), lambda w: F.when(F.size(w) > 0, let(right, lambda r: values_question(r, w, c["seed"]))))
        parts = (ask_tool, F.coalesce(ask_values, ask_params)) if prefer_values else (ask_tool, ask_params, ask_values)
        return F.concat(*[F.coalesce(q, F.lit("")) for q in parts])

    specs = F.transform(tool_specs(t), lambda s: F.named_struct(F.lit("name"), tool_name(s), F.lit("required"), required_params(s)))
    return let(F.named_struct(F.lit("calls"), F.transform(call_payloads(t), parse_call), F.lit("specs"), specs), of_row)


def augment(docs: DataFrame, key: str = "uuid", text: str = "text", pool: DataFrame | None = None, most: int = MAX_NEGATIVES, prefer_values: bool = False) -> DataFrame:
    """M1, M2, M3: docs with questions in front of each parsed call of text.

    prefer_values asks for required parameters only where the pool gives no
    question about values. Texts without a call, and open calls, stay as they are.
    Rows may repeat a key: the questions of a row follow from its key and its text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows, wrong = docs, None
    if pool is not None:
        own = ["__key", "__text"]
        # a text's calls and fields stay in its task from here on, unless the pool is too large to be sent to them
        keyed = docs.withColumn("__key", F.coalesce(F.col(key).cast("string"), F.lit(""))).withColumn("__text", F.xxhash64(text)).repartition(tasks_of(docs.sparkSession), *own)
        cut = keyed.select(*own, F.col(key).cast("string").alias("__of"), F.posexplode(parsed_calls(t)).alias("call_no", "call"))
        cut = cut.select(*own, "call_no", "call.*", F.concat("__of", F.lit("|"), F.col("call_no").cast("string")).alias("seed"))
        asked = value_negatives(cut, pool, [*own, "call_no"], most)
        # one list for each text: what is wrong for its first call, its second, ...
        each = asked.groupBy(*own).agg(F.transform(F.sort_array(F.collect_list(F.struct("call_no", "wrong"))), lambda e: e["wrong"]).alias("__wrong"))
        rows, wrong = keyed.join(each, own, "left"), F.coalesce("__wrong", F.array().cast("array<array<string>>"))
    pieces = F.named_struct(F.lit("gaps"), F.split(t, CALL, -1), F.lit("spans"), F.regexp_extract_all(t, F.lit(CALL), F.lit(0)), F.lit("asked"), _questions(t, F.col(key), wrong, prefer_values))

    def whole(p: Column) -> Column:
        after = F.slice(p["gaps"], F.lit(2), F.size(p["spans"]))
        both = lambda x, y: F.concat(x, y)
        calls = F.zip_with(F.zip_with(p["asked"], p["spans"], both), after, both)
        return F.concat(p["gaps"][0], F.array_join(calls, ""))

    return rows.select(*[F.when(F.contains(t, F.lit(CALL_CLOSE)), let(pieces, whole)).otherwise(t).alias(c) if c == text else F.col(c) for c in docs.columns])


def augment_every(docs: DataFrame, n: int, position: Column, key: str = "uuid", text: str = "text", pool: DataFrame | None = None, most: int = MAX_NEGATIVES) -> DataFrame:
    """M4: with n > 0 only rows at every n-th position are augmented, with values preferred; else all of them."""
    if n <= 0:
        return augment(docs, key, text, pool, most)
    here = docs.withColumn("__at", position)
    chosen = augment(every_n(here, n, F.col("__at")), key, text, pool, most, prefer_values=True)
    return chosen.unionByName(here.where(F.col("__at") % n != 0)).drop("__at")


def without_questions(text: Column) -> Column:
    """The text that augment() started from."""
    return F.regexp_replace(text, r"(?s)<\|(mcq_tool|mcq_params|mcq_param_values)\|>.*?</\|\1\|>", "")
