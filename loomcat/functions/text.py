"""Text building blocks: keyword rules (D1), haystacks, title case, HTML to text (C4)."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE = r"[^\p{L}\p{N}_]"
SPACE = " \t\n\x0b\f\r"


def word_pattern(words: Iterable[str], plural: bool = True) -> str:
    """A pattern that finds any of the words between word edges. Edges are spelt out by Unicode class,
    since ``\\b`` means different things to different engines."""
    body = "|".join(re.escape(w).replace(r"\ ", " ").replace(r"\-", "-") for w in sorted(words, key=lambda w: (-len(w), w)))
    return f"(^|{EDGE})({body})" + "(s|es)?" * plural + f"($|{EDGE})"


def split_words(words: Iterable[str]) -> tuple[list[str], list[str]]:
    """Words matched between edges (ASCII), and those matched as substrings."""
    words = list(words)
    return [w for w in words if w.isascii()], [w for w in words if not w.isascii()]


def has_part(text: Column, parts: Iterable[str]) -> Column:
    """Whether text holds any of the substrings."""
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(text, F.lit(p))
    return out


def keyword_match(text: Column, words: Iterable[str]) -> Column:
    """Whether lower-case text holds a keyword; null and empty text: false."""
    edged, parts = split_words(words)
    found = has_part(text, parts)
    if edged:
        found = text.rlike(word_pattern(edged)) | found
    return F.coalesce(found, F.lit(False))


def haystack(*sources: Column) -> Column:
    """The non-empty sources, lower case, joined by a space."""
    return F.lower(F.concat_ws(" ", *(F.nullif(s, F.lit("")) for s in sources)))


def once(df: DataFrame, *names: str) -> DataFrame:
    """df with the columns so named computed once a row: the optimizer does not put their expressions in place of their uses, so not into
    a function that runs for each element of a list, or a filter that it infers from an explode."""
    made = df.withColumn("_once", F.explode(F.array(F.struct(*names))))
    return made.select(*(F.col(f"_once.{c}").alias(c) if c in names else F.col(c) for c in df.columns))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.transform(F.array(value), use)[0]


def trie_pattern(words: Iterable[str]) -> str:
    """A pattern for any of the words, by shared beginnings; where several fit, the longest is taken first."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def of(node: dict) -> str:
        options = [re.escape(c).replace(r"\ ", " ") + of(below) for c, below in sorted(node.items()) if c]
        if "" in node:
            options += [""] if options else []
        return options[0] if len(options) == 1 else f"(?:{'|'.join(options)})" if options else ""

    return of(root)


def keyword_hits(text: Column, words: Iterable[str]) -> Column:
    """At each place of lower-case text the longest keyword that begins there, plural endings included: one scan for all edged
    keywords, and one for the others if text has characters of their range. Matches may overlap, so none hides another that begins elsewhere."""
    edged, parts = split_words(words)
    found = []
    inside = EDGE.replace("^", "", 1)
    if edged:
        found.append(F.regexp_extract_all(text, F.lit(f"(?<!{inside})(?=({trie_pattern(edged)}(?:s|es)?)(?!{inside}))"), F.lit(1)))
    if parts:
        begins = f"[{min(w[0] for w in parts)}-{max(w[0] for w in parts)}]"  # a range is one comparison, a list of letters many
        all_ = F.regexp_extract_all(text, F.lit(f"(?={begins})(?=({trie_pattern(parts)}))"), F.lit(1))
        found.append(F.when(text.rlike(begins), all_).otherwise(F.array().cast("array<string>")))
    return F.concat(*found)


def _within(hit: str, word: str) -> bool:
    """Whether word matches at the beginning of a hit."""
    if not word.isascii():
        return hit.startswith(word)
    return any(hit.startswith(w) and (len(hit) == len(w) or not (hit[len(w)].isalnum() or hit[len(w)] == "_")) for w in (word, word + "s", word + "es"))


def literal_map(values: dict[str, object], kind: str) -> Column:
    """A constant map from texts: one literal, however many entries, which the optimizer folds."""
    return F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), f"map<string,{kind}>")


@lru_cache
def hit_table(groups: tuple[tuple[str, ...], ...]) -> dict[str, list[int]]:
    """The numbers of the groups (of words) that each possible hit matches."""
    words = dict.fromkeys(w for g in groups for w in g)
    hits = dict.fromkeys(h for w in words for h in ((w, w + "s", w + "es") if w.isascii() else (w,)))
    return {h: [i for i, g in enumerate(groups) if any(_within(h, w) for w in g)] for h in hits}


def first_rule(text: Column, rules: Iterable[tuple[str, Iterable[str]]], otherwise: Column) -> Column:
    """The name of the first rule whose keywords text holds: the hits of all rules at once, then the least of their ranks."""
    rules = [(name, list(words)) for name, words in rules]
    ranks = {h: at[0] for h, at in hit_table(tuple(tuple(words) for _, words in rules)).items()}
    rank_of = literal_map(ranks, "int")
    least = F.array_min(F.transform(keyword_hits(text, [w for _, words in rules for w in words]), lambda h: F.try_element_at(rank_of, h)))
    return F.coalesce(F.get(F.array(*(F.lit(name) for name, _ in rules)), least), otherwise)


def merged_lists(pairs: Column) -> Column:
    """A map from k to the distinct values of all v of an array of (k, v), keys in the order of their first place: one pass over the pairs."""
    start = F.expr("cast(map() as map<string,array<string>>)")

    def add(have: Column, p: Column) -> Column:
        old = F.try_element_at(have, p["k"])
        new = F.array_distinct(F.concat(F.coalesce(old, F.array().cast("array<string>")), p["v"]))
        return F.when(old.isNull(), F.map_concat(have, F.create_map(p["k"], new))).otherwise(F.transform_values(have, lambda k, v: F.when(k == p["k"], new).otherwise(v)))

    return F.aggregate(F.array_distinct(pairs), start, add)


def strip(text: Column) -> Column:
    """text without white space at its ends."""
    return F.btrim(text, F.lit(SPACE))


def title_case(text: Column) -> Column:
    """Upper case after every character that is no letter, lower case elsewhere."""
    pieces = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2))))), "")


#: An entity as the reference's w3lib reads it: a whole run of letters and digits is one name, the semicolon may be missing.
ENTITY = re.compile(r"&(?:#([0-9]+)|#[xX]([0-9a-fA-F]+)|([a-zA-Z0-9]+))(;?)")


def _entity(m: re.Match) -> str:
    """The character of an entity; what is none is dropped if a semicolon ends it, else kept."""
    dec, hexa, name, end = m.groups()
    if name:
        code = name2codepoint.get(name) or name2codepoint.get(name.lower())
    else:
        digits = (dec or hexa).lstrip("0")[:8]  # eight digits are beyond every character
        code = int(digits or "0", 10 if dec else 16)
    if code is not None and code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF:
        if not 0x80 <= code <= 0x9F:
            return chr(code)
        try:
            return bytes((code,)).decode("cp1252")  # as browsers do
        except UnicodeDecodeError:
            pass
    return "" if end else m[0]


def decode_entities(text: Column, closed: bool = False) -> Column:
    """HTML entities decoded, in Arrow batches: Spark has no such function. Texts without ``&`` stay in the JVM. closed: only those
    that a semicolon ends, so a text that was cut within an entity keeps what is left of it."""

    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: ENTITY.sub(lambda m: m[0] if closed and not m[4] else _entity(m), t), na_action="ignore")

    return F.coalesce(decode(F.when(F.contains(text, F.lit("&")), text)), text)


def html_text(markup: Column, closed: bool = False) -> Column:
    """C4: tags out, entities decoded (closed: see ``decode_entities``), white space collapsed; null: empty."""
    bare = decode_entities(F.regexp_replace(F.coalesce(markup, F.lit("")), r"(?s)<[^>]*>", ""), closed)
    return strip(F.regexp_replace(bare, r"\s+", " "))
