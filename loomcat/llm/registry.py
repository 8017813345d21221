"""Queries and oracle SQL of all operators of this folder."""

from functools import wraps
from importlib import import_module

from .shared import ship

MODULES = ("chat", "bpe", "quality", "decontaminate", "repeats", "jaccard", "packing", "toxicity", "lines", "warc", "periods", "bestfit", "centroids")


def _merged(what: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(import_module(f"{__package__}.{name}"), what)
    return out


def shipped(query):
    """The query, after the package has been sent to the workers."""

    @wraps(query)
    def run(spark, *args):
        ship(spark)
        return query(spark, *args)

    return run


def queries() -> dict:
    return {name: shipped(q) for name, q in _merged("QUERIES").items()}


def oracle_sql() -> dict:
    return _merged("ORACLE")
