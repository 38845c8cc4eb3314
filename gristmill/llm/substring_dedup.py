"""Removal of word passages that occur more than once, by fixed-block anchors.

A text's words are cut into adjacent blocks of ``anchor`` words, the reference blocks. Two
equal passages of ``window`` words each hold a whole block of the other's text, as
``2 * anchor - 1 <= window``. So every rolling window of ``anchor`` words is looked up among
the reference blocks; a hit at an occurrence other than the block itself is an anchor, and
only passages around anchors can repeat. They are extended to maximal exact repeats: all
windows of ``window`` words around an anchor are counted over all texts, and the union of
those that occur again is the union of the maximal repeats. Pairs of occurrences are never
listed, so a passage of m copies costs m, not m².

Lookups travel as sorted arrays of hashes per chunk of texts and hash bucket; a chunk sends
a hash at most twice, however often it holds it, so a passage that a third of all texts
share is combined before it moves. Anchors are looked up by 32 bits within a bucket, where
a false hit only costs a further count; windows are counted by 96 bits within a bucket of
other bits, so that equal means equal words. No text is verified beyond these bits: two of
n windows differ unseen with chance n² / 2^(97 + log2 buckets).

Words are runs without space, tab, line feed, vertical tab, form feed and carriage return.
A null text and a text without words have no words and keep the empty string. Texts shorter
than the window keep everything. Repeated rows, also of one id, are occurrences of their
own: all their windows go. Null ids stay null. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.chunks import CHUNK_BYTES, dealt, in_order, packed, unpacked

WINDOW = 35
SEPARATORS = b"\t\n\v\f\r "
#: Places in the table of factors.
REACH = 1 << 16
#: Hash buckets per shuffle partition.
BUCKETS = 4
SEED = 20_240_607


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random byte values of two hash functions, and odd random factors by place in a word."""
    draw = np.random.default_rng(SEED)
    values = draw.integers(0, 2**64, (2, 256), dtype=np.uint64)
    return values[0], values[1], draw.integers(0, 2**63, REACH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the hash spread over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """The words of the texts of a chunk, in one row of bytes."""

    data: np.ndarray
    letters: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    place: np.ndarray
    first: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Words:
        joined = b" ".join((t or "").encode() for t in texts) + b" "
        data = np.frombuffer(joined, dtype=np.uint8)
        inside = np.zeros(len(data) + 1, dtype=bool)
        is_word = np.ones(256, dtype=bool)
        is_word[list(SEPARATORS)] = False
        inside[1:] = is_word.take(data)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        lengths = np.array([len((t or "").encode()) for t in texts], dtype=np.int64)
        begins = np.cumsum(lengths + 1) - lengths - 1
        text = np.searchsorted(begins, start, side="right") - 1
        count = np.bincount(text, minlength=len(texts)) if len(texts) else np.zeros(0, dtype=np.int64)
        first = np.cumsum(count) - count
        return cls(data, data[inside[1:]], start, end, text, np.arange(len(start)) - first[text], first, count)

    def hashes(self, which: int) -> np.ndarray:
        """One 64-bit hash per word."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        values, factor = _tables()[which], _tables()[2]
        lengths = self.end - self.start
        offset = np.cumsum(lengths) - lengths
        at = np.arange(lengths.sum(), dtype=np.int32) - np.repeat(offset.astype(np.int32), lengths)
        terms = values.take(self.letters)
        if lengths.max() > REACH:
            terms *= (at // REACH).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            at %= REACH
        terms *= factor.take(at)
        sums = np.add.reduceat(terms, offset)
        return mixed(sums + lengths.astype(np.uint64) * factor[1])

    def rolling(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """The hash of each run of ``width`` words, by its first word; runs may cross texts."""
        n = len(hashes)
        if n < width:
            return np.zeros(0, dtype=np.uint64)
        total = np.zeros(n - width + 1, dtype=np.uint64)
        factor = _tables()[2]
        # A window is a weighted sum; the weights are random and odd.
        for i in range(width):
            total += hashes[i : n - width + 1 + i] * factor[i + 2]
        return mixed(total)

    def whole(self, width: int) -> np.ndarray:
        """Whether the run of ``width`` words from each word lies in one text."""
        n = max(0, len(self.text) - width + 1)
        return self.place[:n] + width <= self.count[self.text[:n]]


def at_most_twice(*keys: np.ndarray) -> np.ndarray:
    """The places of the first two of each key, sorted by key; the last key counts most."""
    order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    if len(order) < 3:
        return order
    third = np.ones(len(order) - 2, dtype=bool)
    for key in keys:
        ranked = key[order]
        third &= ranked[2:] == ranked[:-2]
    return order[np.concatenate([[True, True], ~third])]


def distinct(values: np.ndarray) -> np.ndarray:
    """The values once each, sorted."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur in a sorted array and where each starts, with the end."""
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, dtype=np.int64)
    return bucket[start], np.append(start, len(bucket))


def _split(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit value of a hash."""
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), h.astype(np.uint32)


class Anchors:
    """The rolling windows of a chunk that can be reference blocks of some text."""

    def __init__(self, words: Words, hashes: np.ndarray, width: int, buckets: int):
        rolling = words.rolling(hashes, width)
        self.at = np.flatnonzero(words.whole(width))
        self.block = words.place[self.at] % width == 0
        self.bucket, self.value = _split(rolling[self.at], buckets)

    def keys(self) -> np.ndarray:
        return self.bucket.astype(np.uint64) << np.uint64(32) | self.value.astype(np.uint64)


PROBES = "bucket int, chunk long, blocks binary, probes binary"


def probe_rows(table: pa.Table, width: int, buckets: int) -> pa.Table:
    """Per bucket: the values of the reference blocks, at most two of each, and of all windows once."""
    words = Words.of(in_order(table)["_text"].to_pylist())
    anchors = Anchors(words, words.hashes(0), width, buckets)
    keys = anchors.keys()
    blocks = keys[anchors.block]
    blocks = blocks[at_most_twice(blocks)]
    probes = distinct(keys)
    names, starts = by_bucket(probes >> np.uint64(32))
    cuts = np.searchsorted(blocks, np.append(names, buckets).astype(np.uint64) << np.uint64(32))
    blocks, probes = blocks.astype(np.uint32), probes.astype(np.uint32)
    return pa.table(
        {
            "bucket": pa.array(names.astype(np.int32)),
            "chunk": pa.array([table["_chunk"][0].as_py()] * len(names), pa.int64()),
            "blocks": pa.array([packed(blocks[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
            "probes": pa.array([packed(probes[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary()),
        }
    )


HITS = "chunk long, bucket int, once binary, more binary"


def found_rows(table: pa.Table) -> pa.Table:
    """For each chunk, its values that one reference block has, and those that more have."""
    blocks, times = np.unique(unpacked(table["blocks"], np.uint32), return_counts=True)
    once, more = [], []
    for part in table["probes"]:
        values = np.frombuffer(part.as_py(), dtype=np.uint32)
        if len(blocks):
            at = np.minimum(np.searchsorted(blocks, values), len(blocks) - 1)
            n = np.where(blocks[at] == values, times[at], 0)
        else:
            n = np.zeros(len(values), dtype=np.int64)
        once.append(packed(values[n == 1]))
        more.append(packed(values[n > 1]))
    return pa.table(
        {
            "chunk": table["chunk"],
            "bucket": table["bucket"],
            "once": pa.array(once, pa.binary()),
            "more": pa.array(more, pa.binary()),
        }
    )


def _known(found: pa.Table, column: str) -> np.ndarray:
    """Bucket and value of a chunk's replies, sorted."""
    parts = [np.frombuffer(x, dtype=np.uint32) for x in found[column].to_pylist()]
    bucket = np.repeat(found["bucket"].to_numpy().astype(np.uint64), [len(p) for p in parts])
    values = np.concatenate([*parts, np.zeros(0, dtype=np.uint32)]).astype(np.uint64)
    return np.sort(bucket << np.uint64(32) | values)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


WINDOWS = "bucket int, chunk long, high binary, low binary"


def window_rows(table: pa.Table, found: pa.Table, window: int, width: int, buckets: int) -> pa.Table:
    """Per bucket, the windows that hold an anchor, at most two of each, by 64 and 32 bits.

    The row of bucket ``-1 - chunk`` holds one bit per word, set where such a window starts.
    """
    words = Words.of(in_order(table)["_text"].to_pylist())
    hashes = words.hashes(0)
    anchors = Anchors(words, hashes, width, buckets)
    keys = anchors.keys()
    # A reference block finds itself: it is an anchor only if another block is equal.
    hit = among(keys, _known(found, "more")) | (among(keys, _known(found, "once")) & ~anchors.block)
    marks = np.zeros(len(words.text) + 1, dtype=np.int64)
    at = anchors.at[hit]
    # Windows that hold the anchor start up to window - width words before it.
    np.add.at(marks, np.maximum(at - (window - width), 0), 1)
    np.add.at(marks, at + 1, -1)
    near = np.zeros(len(words.text), dtype=bool)
    whole = words.whole(window)
    near[: len(whole)] = whole & (np.cumsum(marks)[: len(whole)] > 0)
    starts = np.flatnonzero(near)
    high = words.rolling(hashes, window)[starts]
    other = words.rolling(words.hashes(1), window)[starts]
    bucket, low = _split(other, buckets)
    kept = at_most_twice(low, high, bucket)
    bucket, high, low = bucket[kept], high[kept], low[kept]
    names, cuts = by_bucket(bucket)
    chunk = table["_chunk"][0].as_py()
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.table(
        {
            "bucket": pa.array([*names.tolist(), -1], pa.int32()),
            "chunk": pa.array([chunk] * (len(names) + 1), pa.int64()),
            "high": pa.array([*(packed(high[a:b]) for a, b in spans), packed(np.packbits(near))], pa.binary()),
            "low": pa.array([*(packed(low[a:b]) for a, b in spans), b""], pa.binary()),
        }
    )


SINGLE = "chunk long, bucket int, high binary, low binary"


def single_rows(table: pa.Table) -> pa.Table:
    """For each chunk, its windows of this bucket that occur nowhere else; marks pass through."""
    if table["bucket"][0].as_py() < 0:
        return table.select(["chunk", "bucket", "high", "low"])
    high, low = unpacked(table["high"], np.uint64), unpacked(table["low"], np.uint32)
    lengths = [len(x) // 4 for x in table["low"].to_pylist()]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    order = np.lexsort((low, high))
    high, low, owner = high[order], low[order], owner[order]
    same = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
    alone = ~(np.append(same, False) | np.append(False, same)) if len(high) else np.zeros(0, dtype=bool)
    high, low, owner = high[alone], low[alone], owner[alone]
    by_owner = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[by_owner], np.arange(len(lengths) + 1))
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.table(
        {
            "chunk": table["chunk"],
            "bucket": table["bucket"],
            "high": pa.array([packed(high[by_owner[a:b]]) for a, b in spans], pa.binary()),
            "low": pa.array([packed(low[by_owner[a:b]]) for a, b in spans], pa.binary()),
        }
    )


def covered_words(words: Words, found: pa.Table, window: int, buckets: int) -> np.ndarray:
    """Whether each word lies in a window that occurs again."""
    n = len(words.text)
    is_mark = found["bucket"].to_numpy() < 0
    near = np.zeros(0, dtype=bool)
    for bits in found.filter(pa.array(is_mark))["high"].to_pylist():
        near = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)
    starts = np.flatnonzero(near)
    cover = np.zeros(n + 1, dtype=np.int64)
    if len(starts):
        single = found.filter(pa.array(~is_mark))
        high = words.rolling(words.hashes(0), window)[starts]
        bucket, low = _split(words.rolling(words.hashes(1), window)[starts], buckets)
        lengths = [len(x) // 4 for x in single["low"].to_pylist()]
        owner = np.repeat(single["bucket"].to_numpy(), lengths)
        alone_high = unpacked(single["high"], np.uint64)
        none = _window_keys(alone_high, unpacked(single["low"], np.uint32), owner)
        maybe = np.flatnonzero(among(high, np.sort(alone_high)))
        alone = np.zeros(len(starts), dtype=bool)
        alone[maybe] = np.isin(_window_keys(high[maybe], low[maybe], bucket[maybe]), none)
        again = starts[~alone]
        np.add.at(cover, again, 1)
        np.add.at(cover, again + window, -1)
    return np.cumsum(cover)[:n] > 0


def _window_keys(high: np.ndarray, low: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """All bits of a window as one fixed-length value; the last byte is never zero."""
    rows = np.ones((len(high), 17), dtype=np.uint8)
    rows[:, :8] = high.astype(np.uint64).view(np.uint8).reshape(-1, 8)
    rows[:, 8:12] = low.astype(np.uint32).view(np.uint8).reshape(-1, 4)
    rows[:, 12:16] = bucket.astype(np.uint32).view(np.uint8).reshape(-1, 4)
    return rows.reshape(-1).view("S17")


def kept_texts(words: Words, removed: np.ndarray) -> list[bytes]:
    """The words that stay, joined by one space, for each text."""
    stays = ~removed
    start, end, text = words.start[stays], words.end[stays], words.text[stays]
    # Every word is followed by a separator, which becomes its space.
    lengths = end - start + 1
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = words.data[at + np.repeat(start, lengths)].copy()
    out[np.cumsum(lengths) - 1] = 32
    sizes = np.bincount(text, weights=lengths, minlength=len(words.count)).astype(np.int64)
    ends = np.cumsum(sizes)
    data = out.tobytes()
    return [data[e - s : e - 1] if s else b"" for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def dedup_rows(table: pa.Table, found: pa.Table, window: int, buckets: int, keep_text: bool) -> pa.Table:
    table = in_order(table)
    words = Words.of(table["_text"].to_pylist())
    removed = covered_words(words, found, window, buckets)
    kept = kept_texts(words, removed)
    gone = np.bincount(words.text[removed], minlength=len(words.count))
    out = {
        "_key": table["_key"],
        "n_words": pa.array(words.count.astype(np.int64)),
        "n_removed": pa.array(gone.astype(np.int64)),
        "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
    }
    if keep_text:
        out["kept"] = pa.array([x.decode() for x in kept])
    return pa.table(out)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    keep_text: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``key``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept``, per row."""
    width = (window + 1) // 2
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = dealt(docs, chunk_bytes, _key=F.col(key), _text=F.col(text).cast("string"))
    grouped = texts.groupBy("_chunk")
    probes = grouped.applyInArrow(lambda t: probe_rows(t, width, buckets), PROBES)
    hits = probes.groupBy("bucket").applyInArrow(found_rows, HITS)
    windows = grouped.cogroup(hits.groupBy("chunk")).applyInArrow(
        lambda t, f: window_rows(t, f, window, width, buckets), WINDOWS
    )
    # Marks need no counting; they are spread over the buckets by their chunk.
    place = F.when(F.col("bucket") < 0, -1 - F.col("chunk")).otherwise(F.col("bucket").cast("long"))
    single = windows.groupBy(place.alias("place")).applyInArrow(single_rows, SINGLE)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    done = grouped.cogroup(single.groupBy("chunk")).applyInArrow(
        lambda t, f: dedup_rows(t, f, window, buckets, keep_text), schema + ", kept string" * keep_text
    )
    return done.withColumnRenamed("_key", key)
