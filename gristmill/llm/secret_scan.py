"""Secrets in texts: fixed patterns, and credential values that are costly to guess.

Base kinds are found by pattern, leftmost first, without overlaps within a kind; matches
that are too short are dropped afterwards. A base span is the whole match.

The added kind ``guess`` looks at values behind a credential word. A dynamic programme
cuts the value into words, dates, repeats, keyboard walks and brute-force stretches so that
the number of guesses, in bits, is smallest. A value of ``MIN_BITS`` or more that no base
span touches is a secret. The programme looks back ``WINDOW`` characters at most, so a very
long value costs time in proportion to its length. Words cost by their rank among the words
of all documents (``ranked_words``) and among a few of passwords. Values behind credential
words, and words that one text alone holds (with its copies), are not counted there, so a
secret does not make itself a cheap word. The ``ranked`` most frequent words are a model of
bounded size; a rarer word costs as much as any other letters. What a text's values cost
thus depends on the other texts: pass the same ranks to scan a part again alike.

Addresses and running text are not guessed as a whole: a value with white space in it, a
URL or a mail address is as costly as its costliest part between separators, so a token in a
URL is found while the URL of a page and a quoted sentence are not.

Null and empty texts have no span. Repeated rows give repeated rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Mapping

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.columns import map_arrow
from gristmill.operators.splits import digest, smallest_digests

# Fixed values of the task: patterns and least lengths.
ASSIGN = re.compile(
    r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "guess")

#: A word that announces a credential, a separator, and a value without white space.
CONTEXT = re.compile(
    r"""(?ai)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"""
    r"""|credentials?|auth|login|bearer)["'`]?(?:\x20*(?:=>|->|:=|[:=])\x20*|\x20+is\x20+)"""
    r"""(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"'`<>,;]{6,}))"""
)
#: Lower-case stems, one of which every match of ``ASSIGN`` or ``CONTEXT`` contains.
STEMS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "login", "bearer")
MIN_BITS = 45.0
WINDOW = 32

# Frequent words of passwords, most frequent first: the rank is the guess cost.
WORDS = (
    "password pass admin welcome login letmein monkey dragon master qwerty shadow sunshine princess"
    " football baseball superman batman trustno hello freedom whatever secret summer winter spring"
    " autumn love god money charlie michael jordan hunter tiger test guest root user changeme default"
    " example token please access server system computer internet correct horse battery staple"
    " the and you for your none null true false undefined required optional string value placeholder"
).split()
RANK = {word: i + 1 for i, word in enumerate(WORDS)}
#: Words of the documents that are ranked, unless told otherwise: the size of the model.
RANKED = 50_000
#: Values that are judged by their parts, and what stands between the parts.
ADDRESS = re.compile(r"(?ai)[a-z][a-z0-9+.-]*://\S+|www\.\S+|[\w.+-]+@[\w-]+(?:\.[\w-]+)+|[~.]{0,2}/\S+")
BETWEEN = re.compile(r"[\s/?&=:;,.@#|()\[\]<>]+")
LETTERS = re.compile(r"[^\W\d_]{3,}")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("4@3150$7!", "aaeisost" + "i")
DATES = re.compile(
    r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d"
)


def _steps() -> dict[tuple[str, str], int]:
    """Pairs of neighbours on a keyboard row or in the alphabet, with their direction."""
    found = {}
    for row in ROWS:
        for a, b in zip(row, row[1:], strict=False):
            found[a, b], found[b, a] = 1, -1
    return found


STEPS = _steps()


def brute_bits(char: str) -> float:
    """Bits to guess one character of its class."""
    if char.isdigit():
        return math.log2(10)
    if "a" <= char <= "z" or "A" <= char <= "Z":
        return math.log2(26)
    return math.log2(33) if ord(char) < 128 else math.log2(1000)


def guess_bits(value: str, rank_of: Mapping[str, int] = RANK) -> float:
    """The least cost, in bits, of guessing a value piece by piece; each piece costs one more."""
    low = value.lower()
    plain = low.translate(LEET)
    n = len(value)
    cost = [0.0] + [math.inf] * n
    same = walk = 0
    heading = 0
    dates: dict[int, list[int]] = {}
    for i in range(n):
        found = DATES.match(low, i)
        if found:
            dates.setdefault(found.end(), []).append(i)
    for end in range(1, n + 1):
        at = end - 1
        brute = brute_bits(value[at])
        cost[end] = cost[at] + brute
        if at and low[at] == low[at - 1]:
            same += 1
        else:
            same = 0
        turn = STEPS.get((low[at - 1], low[at]), 0) if at else 0
        walk = (walk + 1 if turn == heading else 1) if turn else 0
        heading = turn
        for length in range(3, min(WINDOW, same + 1) + 1):
            cost[end] = min(cost[end], cost[end - length] + brute + math.log2(length) + 1)
        for length in range(3, min(WINDOW, walk + 1) + 1):
            cost[end] = min(cost[end], cost[end - length] + math.log2(2 * 47) + math.log2(length) + 1)
        for start in dates.get(end, ()):
            bits = math.log2(119) if end - start == 4 else math.log2(119 * 365)
            cost[end] = min(cost[end], cost[start] + bits + 1)
        for length in range(3, min(WINDOW, end) + 1):
            start = end - length
            rank = rank_of.get(low[start:end])
            extra = 1.0
            if rank is None:
                rank, extra = rank_of.get(plain[start:end]), 2.0
            if rank:
                if value[start:end] != low[start:end]:
                    extra += 1
                cost[end] = min(cost[end], cost[start] + math.log2(rank + 1) + extra)
    return cost[n]


def value_bits(value: str, rank_of: Mapping[str, int] = RANK) -> float:
    """The cost of a value, or of its costliest part if it is an address or running text."""
    if ADDRESS.fullmatch(value) or re.search(r"\s", value.strip()):
        return max((guess_bits(part, rank_of) for part in BETWEEN.split(value) if part), default=0.0)
    return guess_bits(value, rank_of)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind number and end of the spans found by pattern."""
    spans = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST
        ]
    spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    return sorted(spans)


def guess_spans(
    text: str, base: list[tuple[int, int, int]], rank_of: Mapping[str, int] = RANK
) -> list[tuple[int, int, int]]:
    """Costly values behind credential words that touch no base span."""
    spans = []
    for m in CONTEXT.finditer(text):
        group = m.lastindex
        start, end = m.span(group)
        if any(s < end and start < e for s, _, e in base):
            continue
        if value_bits(m[group], rank_of) >= MIN_BITS:
            spans.append((start, 3, end))
    return spans


def find_spans(text: str | None, rank_of: Mapping[str, int] = RANK) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind number, end), in order."""
    if not text:
        return []
    low = text.lower()
    if any(stem in low for stem in STEMS):
        base = base_spans(text)
        return sorted(base + guess_spans(text, base, rank_of))
    spans = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST
        ]
    return sorted(spans)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with every span replaced by ``[REDACTED]``; overlapping spans count as one."""
    if not spans:
        return text
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], "[REDACTED]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def common_words(text: str) -> set[str]:
    """Lower-case words of a text, without the values behind credential words."""
    low = text.lower()
    if any(stem in low for stem in STEMS):
        low = ASSIGN.sub(" ", CONTEXT.sub(" ", text)).lower()
    return {w for w in LETTERS.findall(low) if len(w) <= WINDOW}


def ranked_words(docs: DataFrame, text: str = "text", ranked: int = RANKED) -> dict[str, int]:
    """Ranks of the ``ranked`` words that the most texts hold, two different texts at least, and of
    ``WORDS``. Of words held by as many texts as the last one, those with the smallest digests
    are taken; all words of one frequency are ranked in their own order."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found: dict[str, list[int]] = {}
            for value in batch["_text"]:
                if not value:
                    continue
                mark = xxhash.xxh64_intdigest(value) >> 1
                for word in common_words(value):
                    seen = found.setdefault(word, [0, mark, mark])
                    seen[0] += 1
                    seen[1], seen[2] = min(seen[1], mark), max(seen[2], mark)
            columns = list(zip(*found.values(), strict=True)) or [(), (), ()]
            yield {"word": list(found)} | dict(zip(("n", "low", "high"), map(list, columns), strict=True))

    each = map_arrow(docs.select(F.col(text).alias("_text")), "word string, n bigint, low bigint, high bigint", rows)
    sums = each.groupBy("word").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    counts = sums.where("low <> high").select("word", "n").checkpoint()
    # One row per frequency: the last one that is ranked, and how many of its words.
    rest, last = ranked, None
    for row in sorted(counts.groupBy("n").agg(F.count("*").alias("words")).collect(), reverse=True):
        last = row["n"]
        if row["words"] >= rest:
            break
        rest -= row["words"]
    kept = counts.where(F.col("n") > last) if last is not None else counts.limit(0)
    if last is not None:
        ties = counts.where(F.col("n") == last)
        bound, extra = smallest_digests(ties, ["word"], rest)
        own = digest("word")
        kept = kept.unionByName(ties.where((own < bound) | ((own == bound) & F.lit(extra > 0))))
    # ``ranked`` words, and those few that share the last digest.
    words = sorted(kept.collect(), key=lambda r: (-r["n"], r["word"]))
    ranks = {r["word"]: i + 1 for i, r in enumerate(words)}
    return ranks | {word: min(rank, ranks.get(word, rank)) for word, rank in RANK.items()}


def scan_secrets(
    docs: DataFrame, text: str = "text", key: str = "doc_id", clean: bool = False, ranks: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per input row: ``key``, ``found`` (array of kind, start, end; code points, end
    exclusive) and, if ``clean``, ``clean_text``. Words are ranked over ``docs`` unless ``ranks`` are given."""
    ranks = ranked_words(docs, text) if ranks is None else ranks

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            spans = [find_spans(t, ranks) for t in batch["_text"]]
            out = {"_key": batch["_key"]}
            out["found"] = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in x] for x in spans]
            if clean:
                out["clean_text"] = [redact(t, x) for t, x in zip(batch["_text"], spans, strict=True)]
            yield out

    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, found array<struct<kind string, start int, end int>>"
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return map_arrow(narrow, schema + ", clean_text string" * clean, rows).withColumnRenamed("_key", key)


def redact_column(docs: DataFrame, text: str = "text", ranks: Mapping[str, int] | None = None) -> DataFrame:
    """The same rows and columns, with the secrets in ``text`` replaced."""
    ranks = ranked_words(docs, text) if ranks is None else ranks

    def cleaned(values: pd.Series) -> pd.Series:
        return values.map(lambda t: redact(t, find_spans(t, ranks)))

    return docs.withColumn(text, F.pandas_udf(cleaned, "string")(F.col(text)))

