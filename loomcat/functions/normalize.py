"""Scalar normalisers (D2 to D13): Column in, Column out; null in gives the stated default."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .text import bound, first_rule, has_part, haystack, literal_map, strip, title_case, word_pattern

DESCRIPTION_RULES = tuple((name, tuple(w for w in words if w not in rules.DESCRIPTION_AMBIGUOUS)) for name, words in rules.CATEGORY_RULES)


def category(*sources: Column) -> Column:
    """The first matching category, empty if none."""
    return bound(haystack(*sources), lambda h: first_rule(h, rules.CATEGORY_RULES, F.lit("")))


def category_from_description(*sources: Column) -> Column:
    """D3: as ``category`` without the words that descriptions use in other senses."""
    return bound(haystack(*sources), lambda h: first_rule(h, DESCRIPTION_RULES, F.lit("")))


def is_fashion(*sources: Column, strict: bool = False) -> Column:
    """Strict wants a category; else only clearly other goods fail."""
    if strict:
        return category(*sources) != ""
    return bound(haystack(*sources), lambda h: (h == "") | (first_rule(h, rules.CATEGORY_RULES, F.lit("")) != "") | ~has_part(h, rules.NON_FASHION))


def color(value: Column) -> Column:
    """The known colour named first; unknown ones in title case."""

    names = {s: name for name, synonyms in reversed(rules.COLORS) for s in reversed(synonyms)}
    # the leftmost match wins, and of several at one place the alternative that comes first in the table
    pattern = "(" + "|".join(re.escape(s) for _, synonyms in rules.COLORS for s in synonyms) + ")"
    known = literal_map(names, "string")

    def pick(v: Column) -> Column:
        return F.coalesce(F.try_element_at(known, F.regexp_extract(F.lower(v), pattern, 1)), title_case(v))

    return bound(strip(F.coalesce(value, F.lit(""))), pick)


def distinct_ignoring_case(values: Column) -> Column:
    """Keeps the first spelling of each value."""
    low = F.transform(values, lambda v: F.lower(v))
    return bound(F.struct(values.alias("v"), low.alias("low")), lambda b: F.filter(b["v"], lambda v, i: F.array_position(b["low"], F.get(b["low"], i)) == i + 1))


def colors(values: Column) -> Column:
    """Each colour normalised, empty ones dropped, first spelling kept; null: empty list."""
    named = F.transform(F.array_distinct(F.coalesce(values, F.array().cast("array<string>"))), color)
    return bound(F.filter(named, lambda c: c != ""), distinct_ignoring_case)


def gender(*sources: Column) -> Column:
    """Men, women, unisex, kids or empty."""

    def pick(h: Column) -> Column:
        men = h.rlike(word_pattern(rules.MEN_WORDS, plural=False)) | has_part(h, rules.MEN_PARTS)
        women = h.rlike(word_pattern(rules.WOMEN_WORDS, plural=False)) | has_part(h, rules.WOMEN_PARTS)
        return (
            F.when(has_part(h, rules.KIDS), "kids").when(has_part(h, rules.UNISEX), "unisex")
            .when(men & women, "unisex").when(women, "women").when(men, "men").otherwise("")
        )

    return bound(haystack(*sources), pick)


def to_decimal(value: Column) -> Column:
    """A price text as decimal(18,2); of comma and point the later one is the decimal mark, a comma
    alone only before two last digits. What cannot be read is null."""

    def read(t: Column) -> Column:
        comma, point = F.locate(",", F.reverse(t)), F.locate(".", F.reverse(t))  # from the end
        plain = (
            F.when((comma > 0) & (point > 0) & (comma < point), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
            .when((comma > 0) & (point > 0), F.replace(t, F.lit(","), F.lit("")))
            .when(t.rlike(r",[0-9]{2}$"), F.replace(t, F.lit(","), F.lit(".")))
            .otherwise(F.replace(t, F.lit(","), F.lit("")))
        )
        return F.when(plain.rlike(r"[0-9]"), plain).try_cast("decimal(18,2)")

    def any_form(t: Column) -> Column:
        latin = F.translate(t, "٠١٢٣٤٥٦٧٨٩", "0123456789")
        # most prices are plain numbers, which need no reading
        return F.when(t.rlike(r"^[0-9]+(\.[0-9]+)?\z"), t.try_cast("decimal(18,2)")).otherwise(bound(F.regexp_replace(latin, r"[^0-9.,]", ""), read))

    return bound(value.cast("string"), any_form)


def clean_list(values: Column) -> Column:
    """Trimmed, without nulls and empties, first spelling kept; null: empty list."""
    some = F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v.isNotNull())
    return bound(F.filter(F.transform(F.array_distinct(some), strip), lambda v: v != ""), distinct_ignoring_case)


def currency(value: Column, default: str | Column = "EGP") -> Column:
    """A currency code from a symbol or code."""
    fallback = F.lit(default) if isinstance(default, str) else default
    key = F.lower(strip(value))
    known = literal_map(dict(rules.CURRENCIES), "string")
    return F.coalesce(F.try_element_at(known, key), F.when(F.upper(key).rlike(r"^\p{L}{3}$"), F.upper(key)), fallback)


def availability(in_stock: Column) -> Column:
    """D11."""
    return F.when(in_stock.isNull(), "").when(in_stock, "in_stock").otherwise("out_of_stock")


def materials(*sources: Column) -> Column:
    """The materials that the text names, in the order of the table."""
    return bound(haystack(*sources), lambda h: F.array_compact(F.array(*(F.when(has_part(h, s), F.lit(name)) for name, s in rules.MATERIALS))))


def canonical_url(url: Column) -> Column:
    """Without query, fragment and closing slashes, the scheme in lower case; null: empty."""
    bare = F.regexp_replace(F.regexp_replace(strip(F.coalesce(url, F.lit(""))), r"(?s)[?#].*$", ""), r"(?<!:/|:)/+$", "")
    scheme = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    return F.concat(F.lower(scheme), F.substr(bare, F.length(scheme) + 1))


