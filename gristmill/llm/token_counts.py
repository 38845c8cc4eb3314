"""Token counts without ids: a Viterbi that carries best score and piece count.

An Aho-Corasick automaton names, for every end position, the vocabulary pieces that end
there, longest first. Per end the dynamic programme keeps the best score and its piece
count. Of equal scores the longer last piece wins, as in the public unigram tokenizer,
which visits starts in ascending order and replaces only on a higher score. Only the last
``longest`` ends are kept, so a text without any space needs no more memory than a short
one. Units between places that no piece crosses are counted once and remembered.

Null and empty texts have 0 tokens. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.columns import map_arrow
from gristmill.llm.pieces import LOWEST, REMEMBERED, SHORT, Vocabulary, vocabulary


def count_short(v: Vocabulary, unit: str) -> int:
    """As ``count_unit``, for a short unit whose characters are all pieces themselves."""
    score, count = [0.0] + [LOWEST] * len(unit), [0] * (len(unit) + 1)
    for last, (length, own, _) in v.automaton.iter(unit):
        end = last + 1
        total = score[end - length] + own
        if total > score[end]:
            score[end], count[end] = total, count[end - length] + 1
    return count[-1]


def count_unit(v: Vocabulary, unit: str) -> int:
    """Pieces of the best segmentation of one unit."""
    if len(unit) <= SHORT and v.singles.issuperset(unit):
        return count_short(v, unit)
    size = v.longest + 1
    score, count = [0.0] * size, [0] * size
    matches = v.automaton.iter(unit)
    at, found = next(matches, (-1, None))
    for end in range(len(unit)):
        best, pieces, single = None, 0, False
        while at == end:
            length, own, _ = found
            start = (end + 1 - length) % size
            total = score[start] + own
            if best is None or total > best:
                best, pieces = total, count[start] + 1
            single = single or length == 1
            at, found = next(matches, (-1, None))
        if not single:
            total = score[end % size] + v.unknown
            if best is None or total > best:
                best, pieces = total, count[end % size] + len(v.fallback(unit[end]))
        score[(end + 1) % size], count[(end + 1) % size] = best, pieces
    return count[len(unit) % size]


def count_text(v: Vocabulary, text: str | None, known: dict[str, int]) -> int:
    total = 0
    for unit in v.units(text or ""):
        n = known.get(unit)
        if n is None:
            n = count_unit(v, unit)
            if len(unit) <= SHORT:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[unit] = n
        total += n
    return total


def token_counts(docs: DataFrame, model: bytes, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: ``key`` and ``n_tokens``."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        v, known = vocabulary(model), {}
        for batch in batches:
            yield {"_key": batch["_key"], "n_tokens": [count_text(v, t, known) for t in batch["_text"]]}

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    counted = map_arrow(narrow, f"_key {kind}, n_tokens bigint", rows)
    return counted.withColumnRenamed("_key", key)
