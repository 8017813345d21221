"""Scope classification (F1 to F3): clothing and footwear in, other goods out with a reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .text import bound, first_rule

SCOPE_DDL = "struct<is_supported:boolean,scope_type:string,rejection_reason:string>"
PRIMARY = (("footwear", rules.FOOTWEAR), ("clothing", rules.CLOTHING), *rules.OUT_OF_SCOPE)
DESCRIPTION = (
    ("footwear", tuple(w for w in rules.FOOTWEAR if w not in rules.DESCRIPTION_FOOTWEAR_AMBIGUOUS)),
    ("clothing", tuple(w for w in rules.CLOTHING if w not in rules.DESCRIPTION_CLOTHING_AMBIGUOUS)),
)


def _joined(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *(F.nullif(p, F.lit("")) for p in parts)))


def scope_label(primary: Column, description: Column) -> Column:
    """footwear, clothing, or the reason of rejection."""
    none = F.lit(None).cast("string")
    first = bound(primary, lambda t: first_rule(t, PRIMARY, none))
    second = bound(F.lower(F.coalesce(description, F.lit(""))), lambda t: first_rule(t, DESCRIPTION, none))
    return F.coalesce(first, second, F.lit("out_of_scope"))


def scope_of(label: Column) -> Column:
    """The scope struct of a label; null for a null label."""
    inside = label.isin("footwear", "clothing")
    return F.when(label.isNotNull(), F.struct(inside.alias("is_supported"), F.when(inside, label).alias("scope_type"), F.when(~inside, label).alias("rejection_reason")))


def classify(category: Column, subcategory: Column, title: Column, breadcrumbs: Column, tags: Column, description: Column) -> Column:
    """the scope struct. breadcrumbs and tags are arrays; any source may be null."""
    return bound(label_of(category, subcategory, title, breadcrumbs, tags, description), scope_of)


def label_of(category: Column, subcategory: Column, title: Column, breadcrumbs: Column, tags: Column, description: Column) -> Column:
    """The label of the same sources."""
    text = lambda a: F.array_join(a, " ")
    return scope_label(_joined(category, subcategory, title, text(breadcrumbs), text(tags)), description)


def classify_record() -> Column:
    """the scope of a canonical product row."""
    return bound(record_label(), scope_of)


def record_label() -> Column:
    """The label of a canonical product row."""
    return label_of(F.col("category"), F.col("subcategory"), F.col("title"), F.col("attributes.breadcrumbs"), F.col("attributes.tags"), F.col("description"))
