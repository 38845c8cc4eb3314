"""Elements of nested markup, as expressions over an array of tokens.

A page is cut into tokens: a comment, a script or style with its content, a tag, or the text
between two of them. An element is found by its start tag; its end tag is the one at which
the sum of start tags (+1) and end tags (-1) of that name comes back to zero, however many
elements of the same name it holds. An element whose end tag is missing ends with the
element that holds it. A stray ``<`` is text. Null pages have no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.html import ENTITIES

# Quoted attribute values may hold ">". Possessive loops do not recurse, however many there are.
TAG = r"""</?[a-zA-Z][^<>"']*+(?:"[^"]*+"[^<>"']*+|'[^']*+'[^<>"']*+)*+>"""
TOKEN = rf"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|{TAG}|<![^>]*>|[^<]+|<"
NAME = r"^<(/?[a-zA-Z][a-zA-Z0-9]*)"
#: Elements without content and end tag.
VOID = ("br", "hr", "img", "input", "link", "meta")


@dataclass(frozen=True)
class Selector:
    """``name#id.class``, every part of which may be missing."""

    name: str | None = None
    id: str | None = None
    cls: str | None = None

    @classmethod
    def of(cls, text: str) -> Selector:
        found = re.fullmatch(r"([a-z][a-z0-9]*)?(?:#([\w-]+))?(?:\.([\w-]+))?", text)
        if not found or not text:
            raise ValueError(f"no selector: {text!r}")
        return cls(*found.groups())

    def holds(self, token: Column) -> Column:
        """Whether a token is a start tag that the selector means."""
        kind, raw = token["name"], token["raw"]
        test = kind == self.name if self.name else (kind != "") & ~F.startswith(kind, F.lit("/"))
        if self.id:
            test = test & (attribute(raw, "id") == self.id)
        if self.cls:
            test = test & attribute(raw, "class").rlike(rf"(^|\s){re.escape(self.cls)}(\s|$)")
        return test


def tokens(page: Column) -> Column:
    """Array of (name, raw): ``p`` for a start tag, ``/p`` for an end tag, empty for all else."""
    raw = F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(TOKEN), 0)
    return F.transform(
        raw,
        lambda t: F.struct(
            F.when(t.rlike(r"(?i)^<(script|style)\b"), "").otherwise(F.lower(F.regexp_extract(t, NAME, 1))).alias("name"),
            t.alias("raw"),
        ),
    )


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a start tag, entities decoded; empty where it is missing."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
    parts = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return decoded(F.concat(*parts))


def inside(df: DataFrame, page: str, path: Sequence[str], out: str, tag: str | None = None) -> DataFrame:
    """Add ``out``: the tokens inside the first element at the end of a path of selectors, each
    inside the last; none if there is no such element. ``tag`` names a column for its start tag.

    Every step is a column of its own, as the next one asks for it once per token.
    """
    for selector in path:
        df = _inner(df, page, Selector.of(selector), out)
        page = out
    if tag:
        df = df.withColumn(tag, F.coalesce("_tag.raw", F.lit("")))
    return df.drop("_at", "_tag", "_rest", "_end")


def _inner(df: DataFrame, page: str, selector: Selector, out: str) -> DataFrame:
    tokens_, at = F.col(page), F.col("_at")
    df = df.withColumn("_at", F.array_position(F.transform(tokens_, selector.holds), F.lit(True)).cast("int"))
    df = df.withColumn("_tag", F.try_element_at(tokens_, F.nullif(at, F.lit(0))))
    df = df.withColumn("_rest", F.slice(tokens_, at + 1, F.size(tokens_)))
    name = F.coalesce("_tag.name", F.lit(""))
    state = F.struct(name.alias("name"), F.lit(1).alias("depth"), F.lit(0).alias("at"), F.lit(-1).alias("end"))

    def step(s: Column, t: Column) -> Column:
        change = F.when(t["name"] == s["name"], 1).when(t["name"] == F.concat(F.lit("/"), s["name"]), -1).otherwise(0)
        depth = s["depth"] + change
        end = F.when(s["end"] >= 0, s["end"]).when(depth == 0, s["at"]).otherwise(F.lit(-1))
        return F.struct(s["name"].alias("name"), depth.alias("depth"), (s["at"] + 1).alias("at"), end.alias("end"))

    df = df.withColumn("_end", F.aggregate("_rest", state, step)["end"])
    found = F.when(F.col("_end") >= 0, F.slice("_rest", 1, F.col("_end"))).otherwise(F.col("_rest"))
    none = (at == 0) | F.coalesce(F.col("_tag.name").isin(*VOID), F.lit(True))
    return df.withColumn(out, F.when(none, F.slice(tokens_, 1, 0)).otherwise(found))


def raw(page: Column) -> Column:
    """The tokens as markup, without comments, scripts and styles."""
    return F.array_join(
        F.transform(F.filter(page, lambda t: ~t["raw"].rlike(r"(?i)^<(!|script\b|style\b)")), lambda t: t["raw"]), ""
    )


def text(page: Column) -> Column:
    """The text between the tags, entities decoded."""
    words = F.filter(page, lambda t: ~t["raw"].rlike("^<.") | (t["raw"] == "<"))
    return decoded(F.array_join(F.transform(words, lambda t: t["raw"]), ""))


def _character(code: Column) -> Column:
    """The character of a code point; those that are none become U+FFFD."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    point = F.when(valid, code).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def decoded(value: Column) -> Column:
    """Text with its entities, by name or number, as characters; unknown ones stay as they are."""
    names = F.create_map(*[F.lit(x) for pair in ENTITIES for x in pair])
    parts = F.regexp_extract_all(value, F.lit(r"&#?[0-9A-Za-z]+;|[^&]+|&"), 0)

    def one(part: Column) -> Column:
        decimal = F.regexp_extract(part, r"^&#([0-9]{1,8});$", 1)
        hexadecimal = F.regexp_extract(part, r"^&#[xX]([0-9A-Fa-f]{1,7});$", 1)
        return (
            F.when(~F.startswith(part, F.lit("&")), part)
            .when(decimal != "", _character(F.conv(decimal, 10, 10).cast("bigint")))
            .when(hexadecimal != "", _character(F.conv(hexadecimal, 16, 10).cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(names, part), part))
        )

    return F.when(F.contains(value, F.lit("&")), F.array_join(F.transform(parts, one), "")).otherwise(value)


def number(value: Column) -> Column:
    """The first whole number in a text, 0 where there is none."""
    return F.coalesce(F.regexp_extract(value, r"([0-9]+)", 1).try_cast("int"), F.lit(0))
