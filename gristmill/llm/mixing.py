"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Sources share a budget of words by weight; a target stops at max_epochs times
its source's size and the excess goes to the others by weight until no target is
above its cap. That fixed point has a closed form: with sources in ascending
order of cap / weight, the first k are capped and the others get the rest by
weight, for the smallest k at which the next source is under its cap. A source
then takes every document floor(target / size) times, and the words that are
left over from documents in seeded hash order, the last of them in part.

Where that order ends is found from sums over hash buckets, and then over the rows
of the one bucket of each source in which it does. What a row gives then follows
from its place before, at or after the end, so texts are never shuffled or sorted.

Defined cases: a null or empty text has size 0, is taken 0 times and gets a row
in taken(); a null source is one source, the last; repeated rows each count,
and are ranked by their hash and then their text; an empty table gives no rows.
Extra columns of docs pass through materialise() and are ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import cut, salted_left_join

WEIGHTS, SHARE, MAX_EPOCHS, SEED = (5, 2, 1), 1.5, 2, "mix-1"
WORD = r"[^ \t-\r]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with target, the words that the mix wants of the source.

    One row for each source: this table is as small as the list of sources.
    """
    by_name, by_cap = W.Window.orderBy(F.col("source").asc_nulls_last()), W.Window.orderBy("ratio", F.col("source").asc_nulls_last())
    n = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (n + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(max_epochs))
    ranked = sizes.withColumn("w", w).withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("w"))
    before = by_cap.rowsBetween(W.Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(W.Window.currentRow, W.Window.unboundedFollowing)
    everything = W.Window.partitionBy(F.lit(1))
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    # the water level if all sources before this one are capped; right for the first source that it doesn't cap
    level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source", "level"))).over(everything)["level"]
    ranked = ranked.withColumn("level", (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)).withColumn("level", level)
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w")))
    return ranked.select("source", "source_size", target.alias("target"))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """docs with size and the columns that order its rows: __h and __tie."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    return docs.select("*", size_of(F.col("text")).alias("size"), h.alias("__h"), F.xxhash64("text").alias("__tie"))


def ends(rows: DataFrame, **how) -> DataFrame:
    """For each source of sized rows: source_size, target, __whole repetitions, and where the rest ends.

    Rows before (__end_h, __end_tie) give all their words once more; those at that
    place share __end_rest words, in turn; later ones give none. Without such a
    place (null) the rest is empty, as it is less than the source.
    """
    bucket = F.substring("__h", 1, 3)
    sums = cut(rows.groupBy("source", bucket.alias("__bucket")).agg(F.sum("size").alias("here")), "sums")
    goal = targets(sums.groupBy("source").agg(F.sum("here").alias("source_size")), **how)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = cut(goal.withColumn("__whole", whole).withColumn("__left", F.floor("target").cast("long") - F.col("__whole") * F.col("source_size")), "targets")
    upto = lambda *c: W.Window.partitionBy("source").orderBy(*c).rowsBetween(W.Window.unboundedPreceding, -1)
    at = lambda x, y: F.col(f"{x}.source").eqNullSafe(F.col(f"{y}.source"))
    spans = sums.withColumn("__before", F.coalesce(F.sum("here").over(upto("__bucket")), F.lit(0)))
    last = spans.alias("s").join(goal.alias("g"), at("s", "g")).where("__left > __before and __left <= __before + here")
    last = last.select(F.col("s.source").alias("source"), "__bucket", (F.col("__left") - F.col("__before")).alias("__here_left"))
    # the rows of those buckets, equal ones together
    inside = rows.select("source", "size", "__h", "__tie").alias("r").join(last.alias("l"), at("r", "l") & (F.substring("r.__h", 1, 3) == F.col("l.__bucket"))).select("r.*", "__here_left")
    equal = inside.groupBy("source", "__h", "__tie", "__here_left").agg(F.sum("size").alias("here"))
    equal = equal.withColumn("__before", F.coalesce(F.sum("here").over(upto("__h", "__tie")), F.lit(0)))
    end = equal.where("__here_left > __before and __here_left <= __before + here")
    end = end.select("source", F.col("__h").alias("__end_h"), F.col("__tie").alias("__end_tie"), (F.col("__here_left") - F.col("__before")).alias("__end_rest"))
    out = goal.alias("g").join(end.alias("e"), at("g", "e"), "left")
    return cut(out.select("g.source", "source_size", "target", "__whole", "__end_h", "__end_tie", "__end_rest"), "ends")


def plan(rows: DataFrame, **how) -> DataFrame:
    """sized rows with source_size, target and taken: the words that the mix takes of each row."""
    names = [c for c in rows.columns if c not in ("__h", "__tie")]
    # one row for each source; Spark broadcasts it if it is small, and its hot sources are spread if not
    of = ends(rows, **how).select(F.coalesce("source", F.lit("")).alias("__s"), F.col("source").isNull().alias("__none"), *["source_size", "target", "__whole", "__end_h", "__end_tie", "__end_rest"])
    keyed = rows.withColumn("__s", F.coalesce("source", F.lit(""))).withColumn("__none", F.col("source").isNull())
    rows = salted_left_join(keyed, of, ["__s", "__none"], ["__h"])
    here = (F.col("__h") == F.col("__end_h")) & (F.col("__tie") == F.col("__end_tie"))
    before = (F.col("__h") < F.col("__end_h")) | ((F.col("__h") == F.col("__end_h")) & (F.col("__tie") < F.col("__end_tie")))
    rows = rows.withColumn("__here", F.coalesce(here, F.lit(False)))
    most = rows.where("not __here").withColumn("__extra", F.when(before, F.col("size")).otherwise(F.lit(0).cast("long")))
    # the rows at the end, one for each source but for repeated rows, take their words in turn
    nth = F.row_number().over(W.Window.partitionBy("source").orderBy("__h"))
    last = rows.where("__here").withColumn("__nth", nth - 1)
    last = last.withColumn("__extra", F.least("size", F.greatest(F.col("__end_rest") - F.col("__nth") * F.col("size"), F.lit(0)))).drop("__nth")
    taken = F.col("__whole") * F.col("size") + F.col("__extra")
    return most.unionByName(last).withColumn("taken", taken).select(*names, "source_size", "target", "taken")


def taken(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of docs."""
    rows = cut(sized(docs.select("doc_id", "source", "text")).drop("text"), "sizes")
    return plan(rows, **how).select("doc_id", "size", "source_size", "target", "taken")


def materialise(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus with the columns of docs: whole repetitions as repeated rows, a part as its first words."""
    names, own = docs.columns, ("doc_id", "source", "text")
    packed = docs.select(*own, F.struct(F.lit(1).alias("__one"), *[F.col(c) for c in names if c not in own]).alias("__row"))
    mixed = plan(sized(packed), **how).where("taken > 0")
    size = F.nullif("size", F.lit(0).cast("long"))
    rest = F.col("taken") % size
    copies = F.floor(F.col("taken") / size).cast("int")
    words = F.regexp_extract_all("text", F.lit(r"[ \t-\r]*[^ \t-\r]+"), F.lit(0))
    first = F.array_join(F.slice(words, F.lit(1), rest.cast("int")), "")
    repeated = F.when(copies > 0, F.array_repeat("text", copies)).otherwise(F.array().cast("array<string>"))
    both = F.when(rest > 0, F.concat(repeated, F.array(first))).otherwise(repeated)
    out = mixed.withColumn("__texts", both).select("doc_id", "source", "__row", F.explode("__texts").alias("text"))
    value = {c: F.col(c) if c in own else F.col("__row")[c] for c in names}
    if "n_chars" in names:
        value["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[v.alias(c) for c, v in value.items()])
