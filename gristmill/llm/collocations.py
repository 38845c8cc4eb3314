"""Phrases whose words occur together more often than apart, from FM-indexes over word ids.

Each chunk of texts is a shard. For each language a shard holds the pieces of its texts as
one sequence of word ids, with a mark between pieces, and indexes it forwards and backwards:
the symbols before (after) all places, in the order of the words that follow (precede)
them. The order looks at as many words as the longest phrase has, which is all that
intervals of such phrases need. A phrase is an interval in both indexes; one step of
backward search extends all phrases of a length at once to the left or to the right, with
the counts of the extensions, and the twin interval follows from the counts of the smaller
symbols.

Counts are summed over the shards. A phrase is spelled out only where it can reach the
least count: shards send the words and pairs they hold as 32-bit values within hash buckets,
with their counts up to the least one, and get back the values whose sum reaches it. Values
that collide only add phrases, which the sum of the spelled phrases drops again. A phrase of
k + 1 words is a left extension of its last k words and a right extension of its first k
words, and both must reach the least count to let it do so; only such phrases are extended.
Counts are exact. Scores are whole numbers; products are taken in 38 decimal digits.

A-Z become lower case. Pieces end at ``.,;:!?``, line feed, vertical tab, form feed and
carriage return; words are runs without space and tab. Null and empty texts have no words;
a null language counts as ``und``. Repeated rows count again. An empty table, and one whose
phrases are all rare, give no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.chunks import dealt, in_order, packed, unpacked
from gristmill.llm.substring_dedup import BUCKETS, among, by_bucket, mixed

LONGEST = 3
LEAST = 10
#: Share of a phrase's count, in hundredths, that a longer candidate may take from it.
SUBSUMED = 50
TOP = 2_000
SCALE = 1_000_000
#: A phrase's score at one cut; the products have up to 38 digits, for counts up to 10^16.
SCORE = f"({SCALE}BD * cast(a as decimal(16,0)) * cast(a as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"
UNKNOWN = "und"
#: Bytes of a shard's texts.
SHARD_BYTES = 16 << 20
PIECE_ENDS = b".,;:!?\n\v\f\r"
_SAME = bytes(10 if i in PIECE_ENDS else 32 if i == 9 else i for i in range(256))


def symbols(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of a shard and its texts as numbers: 0 ends a piece, word i is i + 1."""
    joined = "\n".join(texts).encode().lower().translate(_SAME).replace(b"\n", b" \n ")
    tokens = pc.split_pattern(pa.array([b"\n " + joined + b" \n"], pa.large_binary()), b" ").values.dictionary_encode()
    words, codes = tokens.dictionary, tokens.indices.to_numpy()
    rank = np.full(len(words), -1, dtype=np.int64)
    names = words.to_pylist()
    mark = names.index(b"\n")
    blank = names.index(b"") if b"" in names else -1
    real = [i for i in range(len(names)) if i not in (mark, blank)]
    rank[real] = np.arange(1, len(real) + 1)
    rank[mark] = 0
    found = rank[codes]
    return words.take(pa.array(real, pa.int64())).cast(pa.large_string()), found[found >= 0]


def _order(s: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the ``depth`` symbols from there on; the sequence is a circle."""
    size = int(s.max()) + 1
    rank = s.astype(np.int64)
    for k in range(1, depth):
        if int(rank.max()) + 1 > (1 << 62) // size:
            rank = np.unique(rank, return_inverse=True)[1]
        rank = rank * size + np.roll(s, -k)
    return np.argsort(rank)


class Half:
    """One direction: the symbols that stand before the places, in their order."""

    def __init__(self, s: np.ndarray, depth: int):
        self.order = _order(s, depth)
        self.before = s[self.order - 1]
        self.size = int(s.max()) + 1
        # Symbol and row as one number: ranks are found by binary search.
        self.rows = np.sort(self.before.astype(np.int64) * len(s) + np.arange(len(s)))

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The first row of the symbol followed by what the interval from ``row`` has."""
        return np.searchsorted(self.rows, symbol.astype(np.int64) * len(self.before) + row)


class ShardIndex:
    """Both directions of one sequence; the sequence starts and ends with a mark."""

    def __init__(self, s: np.ndarray, depth: int):
        self.s = s
        self.ahead = Half(s, depth)
        self.back = Half(s[::-1], depth)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Interval starts (ahead, back) and sizes of all single words."""
        count = np.bincount(self.s, minlength=self.ahead.size)
        start = np.cumsum(count) - count
        return start[1:], start[1:].copy(), count[1:]

    def _extend(
        self, half: Half, low: np.ndarray, size: np.ndarray, twin: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start in ``half``, start in the other half, count and parent of every extension."""
        parent = np.repeat(np.arange(len(low)), size)
        rows = np.arange(len(parent)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        keys = np.sort(parent * half.size + half.before[rows])
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
        count = np.diff(np.append(first, len(keys)))
        parent, symbol = keys[first] // half.size, keys[first] % half.size
        # Within a parent the extensions follow each other in the other half, by symbol.
        other = twin[parent] + first - (np.cumsum(size) - size)[parent]
        real = symbol > 0
        parent, symbol, count, other = parent[real], symbol[real], count[real], other[real]
        return half.step(symbol, low[parent]), other, count, parent

    def left(self, ahead, back, size):
        new, other, count, parent = self._extend(self.ahead, ahead, size, back)
        return new, other, count, parent

    def right(self, ahead, back, size):
        new, other, count, parent = self._extend(self.back, back, size, ahead)
        return other, new, count, parent

    def spell(self, ahead: np.ndarray, length: int) -> list[np.ndarray]:
        """The symbols of the phrases that start at the rows."""
        at = self.ahead.order[ahead]
        return [self.s[(at + i) % len(self.s)] for i in range(length)]

    def longer(self, ahead, back, size) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases one word longer of which both the first and the last words are given."""
        to_left = self.left(ahead, back, size)
        to_right = self.right(ahead, back, size)
        kept = np.isin(to_left[0], to_right[0])
        return to_left[0][kept], to_left[1][kept], to_left[2][kept]


def _phrases(words: pa.Array, index: ShardIndex, ahead: np.ndarray, length: int) -> pa.Array:
    parts = [words.take(pa.array(x - 1)) for x in index.spell(ahead, length)]
    return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if length > 1 else parts[0]


def _rows(chunk: int, lang: str, words, index, ahead, size, length: int) -> pa.Table:
    n = len(ahead)
    return pa.table(
        {
            "_shard": pa.array(np.full(n, chunk, dtype=np.int64)),
            "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(n, dtype=np.int64))),
            "k": pa.array(np.full(n, length, dtype=np.int32)),
            "phrase": _phrases(words, index, ahead, length).cast(pa.string()),
            "c": pa.array(size.astype(np.int64)),
        }
    )


COUNTS = "_shard bigint, lang string, k int, phrase string, c bigint"
_EMPTY = {"_shard": pa.int64(), "lang": pa.string(), "k": pa.int32(), "phrase": pa.string(), "c": pa.int64()}


def _by_language(table: pa.Table):
    """Language, words and index of each language of a shard."""
    table = in_order(table)
    for lang in pc.unique(table["_lang"]).to_pylist():
        own = table.filter(pc.equal(table["_lang"], lang))
        words, s = symbols([t or "" for t in own["_text"].to_pylist()])
        if len(words):
            yield lang, words, s


def _whole(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts) if parts else pa.table({n: pa.array([], t) for n, t in _EMPTY.items()})


SENT = "bucket int, chunk bigint, values binary, counts binary"


def _hashes(words: pa.Array, lang: str) -> np.ndarray:
    """One 64-bit hash per word of a language."""
    names = np.array([lang, *words.to_pylist()], dtype=object)
    h = pd.util.hash_array(names, categorize=False)
    return h[1:] ^ mixed(h[:1])


def _values(index: ShardIndex, hashes: np.ndarray, ahead: np.ndarray, length: int, buckets: int) -> np.ndarray:
    """Bucket and 32-bit value of phrases, as one number."""
    total = np.zeros(len(ahead), dtype=np.uint64)
    for i, symbol in enumerate(index.spell(ahead, length)):
        total = mixed(total + hashes[symbol - 1] + np.uint64(i + 1))
    return ((total >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (total & np.uint64(0xFFFFFFFF))


def _short(lang: str, words: pa.Array, index: ShardIndex, buckets: int):
    """Words and pairs of a shard: their lengths, starts (ahead, back), sizes and values."""
    hashes = _hashes(words, lang)
    one = index.words()
    two = index.right(*one)[:3]
    for length, (ahead, back, size) in ((1, one), (2, two)):
        yield length, ahead, back, size, _values(index, hashes, ahead, length, buckets)


def send_short(table: pa.Table, least: int, buckets: int) -> pa.Table:
    """Per bucket, the values of a shard's words and pairs with their counts, at most ``least``."""
    values, counts = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for lang, words, s in _by_language(table):
        for _, _, _, size, value in _short(lang, words, ShardIndex(s, 2), buckets):
            values.append(value)
            counts.append(np.minimum(size, least))
    value, count = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(value)
    value, count = value[order], count[order].astype(_count_type(least))
    names, cuts = by_bucket(value >> np.uint64(32))
    value = value.astype(np.uint32)
    spans = list(zip(cuts[:-1], cuts[1:], strict=True)) if len(names) else []
    return pa.table(
        {
            "bucket": pa.array(names.astype(np.int32)),
            "chunk": pa.array([table["_chunk"][0].as_py()] * len(names), pa.int64()),
            "values": pa.array([packed(value[x:y]) for x, y in spans], pa.binary()),
            "counts": pa.array([packed(count[x:y]) for x, y in spans], pa.binary()),
        }
    )


def _count_type(least: int) -> type:
    return np.uint8 if least < 256 else np.uint32


def frequent_short(table: pa.Table, least: int) -> pa.Table:
    """For each shard, its values of this bucket whose sum reaches ``least``."""
    values = unpacked(table["values"], np.uint32)
    counts = unpacked(table["counts"], _count_type(least)).astype(np.int64)
    order = np.argsort(values)
    first = np.flatnonzero(np.append(True, values[order][1:] != values[order][:-1]))
    often = values[order][first][np.add.reduceat(counts[order], first) >= least]
    own = [np.frombuffer(x, dtype=np.uint32) for x in table["values"].to_pylist()]
    return pa.table(
        {
            "chunk": table["chunk"],
            "bucket": table["bucket"],
            "values": pa.array([packed(x[among(x, often)]) for x in own], pa.binary()),
        }
    )


def spell_short(table: pa.Table, found: pa.Table, buckets: int, longest: int) -> pa.Table:
    """Words and pairs of a shard that can reach the least count, and phrases of three words
    made of such pairs. A row of length 0 counts all words of a language."""
    chunk, parts = table["_chunk"][0].as_py(), []
    sent = [np.frombuffer(x, dtype=np.uint32) for x in found["values"].to_pylist()]
    bucket = np.repeat(found["bucket"].to_numpy().astype(np.uint64), [len(x) for x in sent])
    values = np.concatenate([*sent, np.zeros(0, dtype=np.uint32)]).astype(np.uint64)
    known = np.sort(bucket << np.uint64(32) | values)
    for lang, words, s in _by_language(table):
        index = ShardIndex(s, min(longest, 3))
        whole = {"_shard": [chunk], "lang": [lang], "k": [0], "phrase": [""], "c": [int((s > 0).sum())]}
        parts.append(pa.table(whole, schema=pa.schema(_EMPTY)))
        for length, ahead, back, size, value in _short(lang, words, index, buckets):
            kept = among(value, known)
            ahead, back, size = ahead[kept], back[kept], size[kept]
            parts.append(_rows(chunk, lang, words, index, ahead, size, length))
        if longest > 2:
            ahead, back, size = index.longer(ahead, back, size)
            parts.append(_rows(chunk, lang, words, index, ahead, size, 3))
    return _whole(parts)


def count_longer(table: pa.Table, known: pa.Table, length: int) -> pa.Table:
    """Phrases of ``length`` words of a shard whose shorter phrases are all ``known``."""
    chunk, parts = table["_chunk"][0].as_py(), []
    for lang, words, s in _by_language(table):
        asked = known.filter(pc.equal(known["lang"], lang))["phrase"]
        if not len(asked):
            continue
        index = ShardIndex(s, length)
        ahead, back, size = _find(index, words, asked, length - 1)
        ahead, back, size = index.longer(ahead, back, size)
        parts.append(_rows(chunk, lang, words, index, ahead, size, length))
    return _whole(parts)


def _counter(length: int):
    return lambda table, known: count_longer(table, known, length)


def _find(index: ShardIndex, words: pa.Array, phrases: pa.ChunkedArray, length: int):
    """The intervals of phrases that the shard holds, by backward search."""
    split = pc.split_pattern(phrases.combine_chunks().cast(pa.large_string()), " ")
    ids = pc.index_in(split.values, words).to_numpy().reshape(-1, length) + 1
    ahead, back, size = (x[ids[:, -1] - 1] for x in index.words())
    for i in range(length - 2, -1, -1):
        symbol = ids[:, i]
        low = index.ahead.step(symbol, ahead)
        count = index.ahead.step(symbol, ahead + size) - low
        back, size, ahead = back + _smaller(index.ahead, symbol, ahead, size), count, low
    return ahead, back, size


def _smaller(half: Half, symbol: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many rows of each interval have a smaller symbol before them."""
    parent = np.repeat(np.arange(len(low)), size)
    rows = np.arange(len(parent)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
    less = half.before[rows] < symbol[parent]
    return np.bincount(parent[less], minlength=len(low))


def _summed(local: DataFrame, least: int) -> DataFrame:
    total = local.groupBy("lang", "phrase", "k").agg(F.sum("c").alias("a"))
    return total.where((F.col("k") < 2) | (F.col("a") >= least))


def phrase_counts(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Words with their counts (``lang``, ``phrase``, ``a``, and ``k``: 1, or 0 for all words of the
    language), and the phrases of two to ``longest`` words that occur ``least`` times or more.
    Words that occur less often may be absent."""
    if longest < 2:
        raise ValueError("a phrase has two words or more")
    named = F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN))
    texts = dealt(docs, shard_bytes, _lang=named, _text=F.col(text).cast("string")).groupBy("_chunk")
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = texts.applyInArrow(lambda t: send_short(t, least, buckets), SENT)
    often = sent.groupBy("bucket").applyInArrow(lambda t: frequent_short(t, least), "chunk bigint, bucket int, values binary")
    local = texts.cogroup(often.groupBy("chunk")).applyInArrow(
        lambda t, f: spell_short(t, f, buckets, longest), COUNTS
    )
    if longest > 3:  # several users below: the rows are written once
        local = local.checkpoint()
    levels = [_summed(local, least)]
    for length in range(4, longest + 1):
        back = local.where(F.col("k") == length - 1).join(levels[-1].drop("a"), ["lang", "phrase", "k"], "left_semi")
        known = back.select("_shard", "lang", "phrase").groupBy("_shard")
        local = texts.cogroup(known).applyInArrow(_counter(length), COUNTS).checkpoint()
        levels.append(_summed(local, least))
    return reduce(DataFrame.unionByName, levels)


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    subsumed: int = SUBSUMED,
    top: int = TOP,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the best phrases per language."""
    # Few rows are left, and all of them came from the shuffles above: they are written once.
    counts = phrase_counts(docs, text, lang, longest, least, shard_bytes).checkpoint()
    totals = counts.where("k = 0").select("lang", F.col("a").alias("n"))
    phrases = counts.where("k > 1")
    parts = counts.where((F.col("k") > 0) & (F.col("a") >= least)).select("lang", "phrase", "a")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).withColumn(
        "_first", F.expr("substring_index(phrase, ' ', cut)")
    )
    cuts = cuts.withColumn("_rest", F.expr("substring(phrase, length(_first) + 2)"))
    left = parts.select("lang", F.col("phrase").alias("_first"), F.col("a").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("_rest"), F.col("a").alias("r"))
    scored = cuts.join(left, ["lang", "_first"]).join(right, ["lang", "_rest"]).withColumn("score", F.expr(SCORE))
    weakest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("w")
    scored = scored.groupBy("lang", "phrase", "k", "a").agg(weakest).select("lang", "phrase", "k", "a", "w.*")
    # Every run of fewer words inside a phrase, with the largest count of a phrase around it.
    runs = [
        F.array_join(F.slice(F.col("_w"), start, size), " ")
        for size in range(2, longest)
        for start in range(1, longest - size + 2)
    ]
    if runs:
        fits = [
            F.when((F.lit(size) < F.col("k")) & (F.lit(start + size - 1) <= F.col("k")), run)
            for run, (size, start) in zip(
                runs, [(z, s) for z in range(2, longest) for s in range(1, longest - z + 2)], strict=True
            )
        ]
        inner = phrases.withColumn("_w", F.split("phrase", " ", -1)).select(
            "lang", F.col("a").alias("_around"), F.explode(F.array_compact(F.array(*fits))).alias("phrase")
        )
        around = inner.groupBy("lang", "phrase").agg(F.max("_around").alias("_around"))
        scored = scored.join(around, ["lang", "phrase"], "left").where(
            F.col("_around").isNull() | (100 * F.col("_around") < subsumed * F.col("a"))
        )
    # The first rows of each part first, so that no window holds a whole language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    best = best.where(F.col("rank") <= top).join(totals, "lang")
    return best.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
