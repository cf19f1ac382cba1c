"""Text, units and places of products as column expressions."""

from __future__ import annotations

import html
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import blank_to_null, col, collapsed, each_text, is_ascii

COMPANY_SUFFIXES = ["inc", "co", "corp", "corporation", "llc", "ltd", "gmbh", "s.a.", "sa", "bv", "ag", "plc", "pte", "oy", "srl", "spa", "k.k.", "kk"]
#: Milligrams in a unit; a millilitre counts as a gram.
MILLIGRAMS = {"mg": 1.0, "gram": 1000.0, "g": 1000.0, "ml": 1000.0, "oz": 28000.0, "fl oz": 29573.5}
UNITS_FROM_NAME = ["each", "mg", "gram", "g", "ml", "fl oz", "oz"]
ABSENT = ["na", "none", "null", "nan"]
_NUMBER = r"(\d+(?:\.\d+)?|\.\d+|\d+/\d+)"
_TAG = re.compile("<[^>]+>")


@each_text
def _to_ascii(t: str) -> str:
    """Entities resolved, tags as spaces, decomposed; what then isn't ASCII is dropped."""
    return unicodedata.normalize("NFKD", _TAG.sub(" ", html.unescape(t))).encode("ascii", "ignore").decode()


@each_text
def _folded(t: str) -> str:
    return unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().casefold()


def to_ascii(c: str | Column) -> Column:
    """Only texts with an entity or beyond ASCII go through Python."""
    c = col(c)
    plain = c.rlike(r"^[\x00-\x7F&&[^&]]*$")
    return F.coalesce(_to_ascii(F.when(~plain, c)), F.regexp_replace(c, "<[^>]+>", " "))


def normalize_text(c: str | Column, *, ascii_input: bool = False) -> Column:
    """Without mark-up, accents, addresses of web pages and punctuation; lower case; null is empty. ``ascii_input`` promises ASCII without entities."""
    c = F.coalesce(col(c).cast("string"), F.lit(""))
    x = F.trim(F.lower(F.regexp_replace(c, "<[^>]+>", " ") if ascii_input else to_ascii(c)))
    x = F.regexp_replace(x, r"https?://\S+|www\.\S+", " ")
    return collapsed(F.regexp_replace(x, r"[^\w\s]+", " "))


def apply_synonyms(c: str | Column, synonyms: dict[str, str] | None) -> Column:
    """Whole words replaced, one entry after the other."""
    c = col(c)
    for k, v in (synonyms or {}).items():
        c = F.regexp_replace(c, F.lit(rf"\b\Q{k.lower()}\E\b"), F.lit(v.lower().replace("\\", "\\\\").replace("$", "\\$")))
    return collapsed(c) if synonyms else c


def number_or_fraction(c: str | Column) -> Column:
    parts = F.split(col(c), "/", 2)
    d = lambda x: x.try_cast("double")
    return F.when(col(c).contains("/"), F.try_divide(d(F.get(parts, F.lit(0))), d(F.get(parts, F.lit(1))))).otherwise(d(col(c)))


def normalize_unit(c: str | Column, synonyms: dict[str, str] | None = None) -> Column:
    """One name for each unit; unknown ones stay as they are."""
    s = apply_synonyms(F.lower(F.trim(col(c).cast("string"))), synonyms)
    for many, one in (("ounces", "ounce"), ("grams", "gram"), ("milliliters", "milliliter")):
        s = F.replace(s, F.lit(many), F.lit(one))
    return F.when(s.isin("g", "gram"), "gram").when(s.isin("ml", "milliliter"), "ml").when(s.isin("oz", "ounce"), "oz").when(s.isin("fl oz", "fl. oz", "fl.oz"), "fl oz").otherwise(s)


def measure_from_name(c: str | Column) -> Column:
    """(value, unit) of the first measure in a name: fluid ounces, then ounces, then the others; nulls where there is none."""
    text = F.lower(col(c))
    fluid, ounce, other = (rf"{_NUMBER}\s*{u}\b" for u in (r"fl\.?\s*oz", "(oz|ounce)", "(mg|g|gram|ml|milliliter)"))
    pick = lambda p, k: F.regexp_extract(text, p, k)
    unit = F.when(pick(other, 2).isin("g", "gram"), "gram").when(pick(other, 2) == "mg", "mg").otherwise("ml")
    found = F.when(text.rlike(fluid), F.struct(number_or_fraction(pick(fluid, 1)).alias("value"), F.lit("fl oz").alias("unit")))
    found = found.when(text.rlike(ounce), F.struct(number_or_fraction(pick(ounce, 1)).alias("value"), F.lit("oz").alias("unit")))
    return found.when(text.rlike(other), F.struct(number_or_fraction(pick(other, 1)).alias("value"), unit.alias("unit")))


def number_or_null(c: str | Column) -> Column:
    return blank_to_null(c, *ABSENT).try_cast("double")


def milligrams(measure: Column, unit: Column, factors: dict[str, float] | None = None) -> Column:
    """``N-milligrams``, rounded half to even; "each" for that unit; null for unknown units."""
    known = F.create_map(*[F.lit(x) for kv in (MILLIGRAMS | (factors or {})).items() for x in kv])
    n = F.bround(measure * F.try_element_at(known, unit), 0).cast("long")
    return F.when(unit == "each", "each").otherwise(F.concat(n.cast("string"), F.lit("-milligrams")))


def normalize_brand(c: str | Column, aliases: dict[str, str] | None = None, suffixes: list[str] | None = None, *, ascii_input: bool = False) -> Column:
    """Lower case without accents, punctuation and company suffixes; null if nothing is left."""
    x = F.trim(F.lower(col(c).cast("string")))
    if not ascii_input:
        x = F.trim(F.coalesce(_folded(F.when(~is_ascii(x), x)), x))
    x = collapsed(F.regexp_replace(F.regexp_replace(x, r"[&+]", " and "), r"[^\w\s]", " "))
    if aliases:
        known = F.create_map(*[F.lit(y.lower()) for kv in aliases.items() for y in kv])
        x = F.coalesce(F.try_element_at(known, x), x)
    kept = F.array_join(F.filter(F.split(x, " "), lambda w: ~w.isin(suffixes or COMPANY_SUFFIXES)), " ")
    return F.when(F.trim(kept) != "", F.trim(kept))


def normalize_strain(c: str | Column, *, ascii_input: bool = False) -> Column:
    x = normalize_text(c, ascii_input=ascii_input)
    out = F
    for word in ("indica", "sativa", "hybrid", "cbd"):
        out = out.when(x.rlike(rf"\b{word}\b"), word)
    return out.when(x != "", x)


def normalize_states(c: str | Column) -> Column:
    """Distinct codes, sorted, with commas; null if there is none."""
    codes = F.transform(F.split(F.coalesce(col(c).cast("string"), F.lit("")), r"[,|;/\s]+"), lambda x: F.upper(F.regexp_replace(x, "[^A-Za-z]", "")))
    codes = F.array_sort(F.array_distinct(F.filter(codes, lambda x: x != "")))
    return F.when(F.size(codes) > 0, F.array_join(codes, ","))


def normalize_country(c: str | Column) -> Column:
    s = F.lower(F.trim(col(c).cast("string")))
    letters = F.upper(F.regexp_replace(s, "[^a-z]", ""))
    return F.when(s.isin("united states", "usa", "us"), "US").when(s.isin("canada", "ca"), "CA").when(letters != "", letters)


def description_or_name(description: Column, name: Column) -> Column:
    """Descriptions of fewer than 10 characters give way to the name, if there is one."""
    return F.when((F.length(description) < 10) & (name != ""), name).otherwise(description)


def tokens(c: str | Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(col(c).cast("string"), F.lit(""))), r"(?U)[^\w]+"), lambda x: x != "")


def list_literal(c: str | Column) -> Column:
    """The set of a text that reads like a list of strings; any other text is its only member. Lower case, trimmed, no blanks."""
    c = col(c).cast("string")
    items = F.from_json(F.replace(c, F.lit("'"), F.lit('"')), "array<string>")
    made = F.when(F.trim(c).startswith("["), F.coalesce(items, F.array(c))).otherwise(F.array(c))
    return F.array_sort(F.array_distinct(F.filter(F.transform(made, lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != ""))))
