"""Text of categories as column expressions.

Everything runs inside the JVM but Unicode decomposition, which Spark lacks: texts with
characters beyond ASCII go through one Arrow UDF, all others are null on their way to it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NO_LEVEL = ["", "nan", "none", "null", "uncategorized"]
SYNONYMS = {"pre roll": "pre-roll", "vapes": "vape pen"}
NOT_PLURAL = ["glass", "cannabis", "press", "mass", "boss", "class"]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def each_text(f: Callable[[str], str]) -> Callable[..., Column]:
    """An Arrow UDF of ``f`` of every text but nulls. Results go straight into Arrow's buffers, so that a batch isn't also held as Python strings, neither what came nor what leaves."""

    def batch(texts: pa.Array) -> pa.Array:
        ends, known, data = np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts), bool), bytearray()
        for k, x in enumerate(texts):
            if x.is_valid:
                data += f(x.as_py()).encode()
                known[k] = True
            ends[k + 1] = len(data)
        mask = pa.py_buffer(np.packbits(known, bitorder="little"))
        return pa.Array.from_buffers(pa.large_string(), len(texts), [mask, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.string())

    return F.arrow_udf(batch, StringType())


@each_text
def _decomposed(t: str) -> str:
    """Lower-cased, decomposed, without combining marks; punctuation as spaces by Python's notion of a word character."""
    kept = (c for c in unicodedata.normalize("NFKD", t.strip().lower()) if not unicodedata.combining(c))
    return " ".join("".join(c if c.isalnum() or c == "_" or c.isspace() else " " for c in kept).split())


def is_ascii(c: str | Column) -> Column:
    return col(c).rlike(r"^[\x00-\x7F]*$")


def collapsed(c: str | Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def normalize_text(c: str | Column, *, unicode: bool = True) -> Column:
    """Lower case, no accents, punctuation as spaces, single spaces; null is empty.

    ``unicode=False`` promises ASCII input and leaves Python out of the plan.
    """
    c = F.coalesce(col(c).cast("string"), F.lit(""))
    plain = collapsed(F.regexp_replace(F.lower(c), r"[^\w\s]", " "))
    if not unicode:
        return plain
    return F.coalesce(_decomposed(F.when(~is_ascii(c), c)), plain)


def ascii_lower(c: str | Column) -> Column:
    """Lower case and single spaces; null is empty."""
    return F.lower(collapsed(F.coalesce(col(c).cast("string"), F.lit(""))))


def join_path(*parts: str | Column, separator: str = " / ", normalized: bool = False, unicode: bool = True) -> Column:
    """Normalized parts that aren't blank, joined. ``normalized``: the parts are known to be ASCII words, but for hyphens."""
    done = [F.regexp_replace(F.coalesce(col(p), F.lit("")), "-", " ") if normalized else normalize_text(p, unicode=unicode) for p in parts]
    return F.array_join(F.filter(F.array(*done), lambda x: F.trim(x) != ""), separator)


def pretty_path(*parts: str | Column) -> Column:
    """Raw levels joined for people; blanks read "nan"."""
    return F.concat_ws(" / ", *[F.when(F.trim(F.coalesce(col(p).cast("string"), F.lit(""))) == "", "nan").otherwise(col(p).cast("string")) for p in parts])


def row_id(source: str | Column, *levels: str | Column) -> Column:
    """MD5 of the source and the levels, so the same category has the same id in every run."""
    return F.md5(F.concat_ws("|", F.lit("v1"), *[ascii_lower(x) for x in (source, *levels)]))


def uuid_of(c: str | Column) -> Column:
    """A UUID made of the MD5 of a text."""
    return F.regexp_replace(F.md5(col(c)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def synonym(c: str | Column, synonyms: dict[str, str] | None = None) -> Column:
    """A whole text replaced by its synonym, if it has one."""
    known = SYNONYMS | (synonyms or {})
    pairs = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, col(c)), col(c))


def singular(c: str | Column) -> Column:
    """Without a final s, but for short words, -ss, -is, -us and a few exceptions."""
    kept = "|".join(NOT_PLURAL)
    return F.regexp_replace(F.trim(col(c)), rf"^(?!(?:{kept})$)(.{{3,}}[^siu])s$", "$1")


def without_unspecified(c: str | Column) -> Column:
    return collapsed(F.regexp_replace(col(c), r"\(\s*unspecified\s*\)", ""))


def is_infused(c: str | Column) -> Column:
    return col(c).startswith("infused ")


def without_infused(c: str | Column) -> Column:
    return F.trim(F.regexp_replace(col(c), "^infused ", ""))


def levels_of(path: str | Column) -> Column:
    """Three levels of a pretty path; markers of absence are null."""
    parts = F.transform(F.split(F.coalesce(col(path), F.lit("")), "/"), lambda x: F.trim(x))
    return F.transform(F.array(*[F.get(parts, F.lit(k)) for k in range(3)]), lambda x: F.when(~F.lower(x).isin(NO_LEVEL), x))


def count_levels(path: str | Column) -> Column:
    return F.size(F.filter(levels_of(path), lambda x: x.isNotNull()))


def three_parts(path: str | Column) -> Column:
    """The parts of a path that has exactly three, else null."""
    parts = F.filter(F.transform(F.split(col(path), "/"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(parts) == 3, parts)


def unordered_key(*parts: str | Column) -> Column:
    """Distinct parts that aren't blank, sorted and joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*[F.trim(F.coalesce(col(p), F.lit(""))) for p in parts]), lambda x: x != ""))), "||")


def unordered_path_key(path: str | Column) -> Column:
    parts = F.filter(F.transform(F.split(F.coalesce(col(path), F.lit("")), "/"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_distinct(parts)), "||")


def pair_key(left_source: str = "left_source", left_id: str = "left_id", right_source: str = "right_source", right_id: str = "right_id") -> Column:
    """The same for a pair and its reverse."""
    return F.array_join(F.array_sort(F.array(F.concat_ws("::", left_source, left_id), F.concat_ws("::", right_source, right_id))), "|")


def neighbourhood_key(path: str | Column) -> Column:
    return F.regexp_replace(col(path), r"[\s/\-&]+", "")


def usable_level(c: str | Column) -> Column:
    return col(c).isNotNull() & (col(c) != "") & (F.lower(col(c)) != "uncategorized")


def to_timestamp_or(c: str | Column, as_of: str | Column) -> Column:
    """The timestamp that a text holds, else ``as_of``."""
    other = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return F.coalesce(F.try_to_timestamp(col(c).cast("string")), other)


def blank_to_null(c: str | Column, *markers: str) -> Column:
    text = F.trim(col(c).cast("string"))
    return F.when(~F.lower(text).isin("", *markers), text)
