"""SentencePiece ids and back, by a Viterbi that commits as it reads.

The encoder reads characters one at a time. It keeps the scores of the last ``longest``
boundaries only: a later piece cannot start before them. Whenever the backpointer paths of
all these boundaries meet in one boundary, the ids up to it are final and are handed out;
what lies before is forgotten. Ties go to the longer last piece (see ``token_counts``).

Decoding joins the pieces, turns byte runs back into characters and drops the leading
space mark. The round trip gives the text back, except that a literal U+2581 comes back as
a space. Null and empty texts have no ids and decode to the empty text.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.columns import map_arrow
from gristmill.llm.pieces import LOWEST, REMEMBERED, SHORT, SPACE, Vocabulary, vocabulary


def meeting(back: dict[int, tuple[int, tuple[int, ...]]], live: Iterable[int]) -> int:
    """The last boundary that the paths of all live boundaries pass."""
    ends = set(live)
    while len(ends) > 1:
        last = max(ends)
        ends.remove(last)
        ends.add(back[last][0])
    return ends.pop()


def path_ids(back: dict[int, tuple[int, tuple[int, ...]]], base: int, end: int) -> list[int]:
    steps = []
    while end > base:
        end, ids = back[end]
        steps.append(ids)
    return [i for ids in reversed(steps) for i in ids]


def stream_ids(v: Vocabulary, text: str) -> Iterator[list[int]]:
    """Runs of final ids of a marked text, in order."""
    size = v.longest + 1
    score = [0.0] * size
    back: dict[int, tuple[int, tuple[int, ...]]] = {}
    base = 0
    matches = v.automaton.iter(text)
    at, found = next(matches, (-1, None))
    for here in range(len(text)):
        best, single, step = None, False, None
        while at == here:
            length, own, i = found
            total = score[(here + 1 - length) % size] + own
            if best is None or total > best:
                best, step = total, (here + 1 - length, (i,))
            single = single or length == 1
            at, found = next(matches, (-1, None))
        if not single:
            total = score[here % size] + v.unknown
            if best is None or total > best:
                best, step = total, (here, v.fallback(text[here]))
        end = here + 1
        score[end % size] = best
        back[end] = step
        if end % size == 0:
            met = meeting(back, range(max(base, end - v.longest + 1), end + 1))
            if met > base:
                yield path_ids(back, base, met)
                for old in range(base + 1, met + 1):
                    del back[old]
                # Paths now start at the meeting boundary: scores are counted from there.
                origin = score[met % size] if end - met < size else 0.0
                if end - met < size:
                    score = [s - origin for s in score]
                base = met
    if base < len(text):
        yield path_ids(back, base, len(text))


def short_ids(v: Vocabulary, unit: str) -> tuple[int, ...]:
    """The ids of a unit that fits the window whole; all its characters are pieces."""
    score = [0.0] + [LOWEST] * len(unit)
    step: list[tuple[int, int]] = [(0, 0)] * (len(unit) + 1)
    for last, (length, own, i) in v.automaton.iter(unit):
        end = last + 1
        total = score[end - length] + own
        if total > score[end]:
            score[end], step[end] = total, (end - length, i)
    out, end = [], len(unit)
    while end:
        end, i = step[end]
        out.append(i)
    return tuple(reversed(out))


def encode_bytes(v: Vocabulary, text: str | None, known: dict[str, bytes]) -> bytes:
    """The ids as 32-bit machine words, end to end."""
    out: list[bytes] = []
    for unit in v.units(text or ""):
        ids = known.get(unit)
        if ids is None:
            if len(unit) > SHORT:
                out.extend(array("i", run).tobytes() for run in stream_ids(v, unit))
                continue
            if len(unit) <= v.longest and v.singles.issuperset(unit):
                ids = array("i", short_ids(v, unit)).tobytes()
            else:
                ids = b"".join(array("i", run).tobytes() for run in stream_ids(v, unit))
            if len(known) >= REMEMBERED:
                known.clear()
            known[unit] = ids
        out.append(ids)
    return b"".join(out)


def encode(v: Vocabulary, text: str | None, known: dict[str, bytes] | None = None) -> array:
    return array("i", encode_bytes(v, text, {} if known is None else known))


def decode(v: Vocabulary, ids: Iterable[int]) -> str:
    parts: list[str] = []
    held = bytearray()
    pieces, values = v.pieces, v.byte_values
    for i in ids:
        if i in values:
            held.append(values[i])
            continue
        if held:
            parts.append(held.decode(errors="replace"))
            held.clear()
        parts.append(pieces[i])
    if held:
        parts.append(held.decode(errors="replace"))
    text = "".join(parts).replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def encode_documents(
    docs: DataFrame, model: bytes, text: str = "text", key: str = "doc_id", keep_ids: bool = True
) -> DataFrame:
    """One row per input row: ``key``, ``n_ids``, ``ids_sha256`` (of the ids as 32-bit machine words),
    ``round_trip`` (the decoded ids are the text) and, unless ``keep_ids`` is false, ``ids``."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        v, known = vocabulary(model), {}
        for batch in batches:
            out: dict[str, list] = {"_key": batch["_key"], "n_ids": [], "ids_sha256": [], "round_trip": []}
            if keep_ids:
                out["ids"] = []
            for t in batch["_text"]:
                data = encode_bytes(v, t, known)
                ids = array("i", data)
                out["n_ids"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
                out["round_trip"].append(decode(v, ids) == (t or "").replace(SPACE, " "))
                if keep_ids:
                    out["ids"].append(ids)
            yield out

    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, n_ids bigint, ids_sha256 string, round_trip boolean"
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    done = map_arrow(narrow, schema + ", ids array<int>" * keep_ids, rows)
    return done.withColumnRenamed("_key", key)


def decode_column(ids: Column, model: bytes) -> Column:
    """The texts of arrays of ids; a null array gives null."""

    def texts(values: pd.Series) -> pd.Series:
        v = vocabulary(model)
        return values.map(lambda x: None if x is None else decode(v, x))

    return F.pandas_udf(texts, "string")(ids)
