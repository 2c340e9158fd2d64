"""String expressions with the exact semantics that the normalised corpora rely on."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every code point that Unicode-aware stripping removes, as the inside of a regex class.
BLANK = r"\t-\r\x1c-\x20\x85\xa0  -     　"
#: The same, one by one.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{BLANK}]", c))
#: Line boundaries of Unicode-aware line splitting.
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
U64 = 18446744073709551616.0


def let(value: Column, f) -> Column:
    """f(value) with value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def strip(text: Column) -> Column:
    """text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(BLANKS))


def ensure_text(text: Column) -> Column:
    """H1: null becomes empty, then strip."""
    return strip(F.coalesce(text, F.lit("")))


def lines_of(text: Column) -> Column:
    """The lines of a text; a final line break opens no further line, an empty text has none."""
    return let(F.split(text, BREAK, -1), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts))


def words_of(text: Column) -> Column:
    """The runs of anything but white space."""
    return F.regexp_extract_all(text, F.lit(rf"[^{BLANK}]+"), F.lit(0))


def path_id(file: Column, position: Column) -> Column:
    """H2: the id of a record that has none."""
    return F.concat_ws("/", file, position.cast("string"))


def est_tokens(text: Column, chars_per_token: float = 4.0) -> Column:
    """H3: 0 for an empty text, else at least 1."""
    n = F.coalesce(F.length(text), F.lit(0))
    return F.when(n == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.floor(n / F.lit(max(float(chars_per_token), 1e-6))))).cast("long")


def stable_u(key: Column) -> Column:
    """H4: a number in [0, 1) from the first 64 bits of the key's SHA-1."""
    return F.conv(F.substring(F.sha1(key.cast("binary")), 1, 16), 16, 10).cast("double") / F.lit(U64)


def first_truthy(*columns: Column) -> Column:
    """H8: the first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def by_hash(items: Column, seed: Column) -> Column:
    """The items (strings) in the order of SHA-1 of seed and item, a reproducible shuffle."""
    keyed = F.transform(items, lambda x: F.struct(F.sha1(F.concat(seed, F.lit("|"), x).cast("binary")).alias("h"), x.alias("x")))
    return F.transform(F.sort_array(keyed), lambda e: e["x"])


def slug(name: str) -> str:
    """A dataset's name as a folder name."""
    name = name.replace("/", "__").replace("\\", "__").replace("..", "_")
    return re.sub(r"[^\w.-]", "_", name)[:180]
