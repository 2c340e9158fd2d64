"""Guarded access to JSON held as VARIANT.

variant_get coerces (a number becomes a string), and a JSON null is not NULL, so
every access here looks at the value's own type first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: Finds each comma or colon of a compact JSON text that isn't inside a string.
_MARKS = r'\G((?:"(?:[^"\\]++|\\.)*+"|[^",:])*+)([,:])'

#: How every JSON text begins. The parser's exceptions cost far more than this look.
_BEGINS = r'^[ \t\r\n]*+(?:\{[ \t\r\n]*+["}]|["\[tfn0-9-])'


def parse_json(text: Column) -> Column:
    """The JSON value of a text, or null. try_parse_json passes over what follows a value; this doesn't."""

    def only(t: Column) -> Column:
        listed = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))).try_cast("array<variant>")
        # only a text with a bracket of its own can close the list early
        held = lambda: ~F.contains(t, F.lit("]")) | F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}"))).isNotNull()
        one = let(listed, lambda items: F.when(F.coalesce(F.size(items) == 1, F.lit(False)), F.when(held(), F.get(items, 0))))
        return F.when(t.rlike(_BEGINS), one)

    return let(text, only)


def member(v: Column, key: str) -> Column:
    """The member of an object (of objects in it: a.b.c), or null if it isn't there; a JSON null is there."""
    return F.try_variant_get(v, f"$.{key}", "variant")


def kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_string(v: Column) -> Column:
    return F.coalesce(kind(v) == "STRING", F.lit(False))


def is_object(v: Column) -> Column:
    # schema_of_variant would walk through all of it
    return v.try_cast("map<string,variant>").isNotNull()


def is_array(v: Column) -> Column:
    return v.try_cast("array<variant>").isNotNull()


def is_there(v: Column) -> Column:
    """Neither absent nor a JSON null."""
    return v.isNotNull() & ~F.coalesce(F.is_variant_null(v), F.lit(False))


def as_string(v: Column) -> Column:
    """The value if it is a string, else null."""
    return let(v, lambda x: F.when(is_string(x), F.try_variant_get(x, "$", "string")))


def as_array(v: Column) -> Column:
    """The elements if it is an array, else null. One bad element doesn't spoil the others."""
    return v.try_cast("array<variant>")


def as_map(v: Column) -> Column:
    return v.try_cast("map<string,variant>")


def objects(items: Column) -> Column:
    return F.filter(items, is_object)


def canonical(v: Column) -> Column:
    """H5: an equality key, compact JSON with sorted keys."""
    return F.to_json(v)


def display(v: Column) -> Column:
    """H6: JSON with a blank after commas and colons. Keys are sorted."""
    return F.regexp_replace(F.to_json(v), _MARKS, "$1$2 ")


def to_text(v: Column) -> Column:
    """Null is empty, a string itself, anything else its display JSON."""
    return let(v, lambda x: F.when(~is_there(x), F.lit("")).otherwise(F.coalesce(as_string(x), display(x), F.lit(""))))


def truthy_text(v: Column) -> Column:
    """to_text of a value that isn't false, zero or empty, else null."""

    def kept(x: Column) -> Column:
        falsy = lambda t: t.isin("", "[]", "{}") | (~is_string(x) & t.isin("0", "false"))
        return let(to_text(x), lambda t: F.when(~falsy(t), t))

    return let(v, kept)


def quoted(key: Column) -> Column:
    """A string as JSON."""
    return F.regexp_replace(F.to_json(F.array(key)), r"^\[|\]$", "")
