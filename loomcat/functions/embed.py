"""Texts for embeddings and their vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

MAX_WORDS, MOST_COLORS, MOST_MATERIALS, LEAST_TAIL = 45, 4, 3, 4


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def embedding_text(gender: Column, category: Column, subcategory: Column, brand: Column, vendor: Column, title: Column, colors: Column, material: Column, description: Column, max_words: int = MAX_WORDS) -> Column:
    """A short text of gender, category, brand, title, colours and materials, then as much of the
    description as fits if more than four words do. Without any of the first it begins with ". "."""
    g = F.lower(F.coalesce(gender, F.lit("")))
    phrase = F.when(g == "men", "men's").when(g == "women", "women's").when(g.isin("kids", "unisex"), g)
    some = lambda *cs: strip(F.coalesce(*(F.nullif(c, F.lit("")) for c in cs), F.lit("")))
    text = lambda c: F.nullif(c, F.lit(""))
    present = lambda a: F.filter(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
    listed = lambda label, a, n: F.when(F.size(present(a)) > 0, F.concat(F.lit(label), F.array_join(F.slice(present(a), 1, n), ", ")))
    by = text(some(brand, vendor))
    head = F.concat_ws(". ", text(F.concat_ws(" ", phrase, text(some(category, subcategory)))), F.concat(F.lit("by "), by), text(some(title)), listed("color ", colors, MOST_COLORS), listed("material ", material, MOST_MATERIALS))
    left = F.lit(max_words) - F.size(words(head))
    tail = strip(F.coalesce(description, F.lit("")))
    full = F.when((tail != "") & (left > LEAST_TAIL), F.concat(head, F.lit(". "), F.array_join(F.slice(words(tail), F.lit(1), F.greatest(left, F.lit(0))), " "))).otherwise(head)
    return F.array_join(F.slice(words(full), 1, max_words), " ")


def color_text(color: Column, title: Column) -> Column:
    """Colour and title, or the title alone."""
    return strip(F.concat_ws(" ", F.nullif(color, F.lit("")), title))


def average_embeddings(image: Column, text: Column, strict: bool = True) -> Column:
    """The element-wise mean; vectors of different length fail, or give null where not strict."""
    mean = F.zip_with(image, text, lambda a, b: ((a + b) / 2).cast("float"))
    same = F.size(image) == F.size(text)
    bad = F.raise_error(F.lit("embedding lengths differ")).cast("array<float>") if strict else F.lit(None).cast("array<float>")
    return F.when(same, mean).when(image.isNull() | text.isNull(), F.lit(None)).otherwise(bad)
