"""N-gram Jaccard self-join through a MinHash LSH forest, verified exactly.

Texts become sets of hashed shingles of five words. Texts with equal sets are one class from
the start and travel as one row. A signature of ``TREES`` × ``DEPTH`` MinHash values puts a
set into ``TREES`` prefix tries. Matching starts at the full depth and shortens the prefix
until the chance that a pair at the threshold shares a prefix in some tree reaches
``RECALL`` (``match_depth``). In every trie, sets under one prefix are tied to the smallest
of them, so a prefix with n sets gives n - 1 ties, not all pairs. Tied sets form a
candidate group.

Within a candidate group all pairs are compared exactly, by counting shared shingles over
an inverted list. A large group is cut into blocks of bounded size, and every two blocks
meet in one task; only link counts and a spanning forest leave the task, never the pairs.
The class of a text is its component of verified links.

A text with fewer than five words has the one shingle of all its words; texts without
words and null texts have no shingle, link to nothing, and each is its own class.
Rows with one id and one set (repeats) are one document and get equal rows. The class id
is the smallest id of the class; null ids never name a class unless it has no other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.columns import map_arrow, prepared
from gristmill.llm.components import components

WIDTH, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 32, 8, 0.9999
#: Shingles that one block of a candidate group holds at most, besides its last text.
BLOCK_SHINGLES = 1_000_000
SEED = 7_919
REMEMBERED = 200_000

WORD = re.compile(r"[^\W_]+")


def match_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree often enough."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    raise ValueError("more trees are needed for this recall")


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are remembered up to a bound."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[str, int] = {}
        odd = np.random.default_rng(SEED).integers(0, 1 << 62, width, dtype=np.int64).astype(np.uint64)
        self.factors = odd * np.uint64(2) + np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        known = self.known
        words = WORD.findall(text.lower()) if text else []
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > REMEMBERED:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter((known[w] for w in words), np.uint64, len(words))
        n = max(1, len(words) - self.width + 1)
        mixed = np.full(n, min(len(words), self.width), np.uint64)
        for k in range(min(self.width, len(words))):
            mixed += hashes[k : k + n] * self.factors[k]
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def signatures(sets: list[np.ndarray], depth: int) -> np.ndarray:
    """One 64-bit prefix hash per set and tree, of the tree and its first ``depth`` MinHash values."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.concatenate(sets)
    draw = np.random.default_rng(SEED + 1)
    factors = draw.integers(0, 1 << 63, (TREES, DEPTH), dtype=np.int64).astype(np.uint64) * np.uint64(2)
    factors += np.uint64(1)
    shifts = draw.integers(0, 1 << 63, (TREES, DEPTH), dtype=np.int64).astype(np.uint64)
    out = np.tile(np.arange(1, TREES + 1, dtype=np.uint64), (len(sets), 1))
    for tree in range(TREES):
        for at in range(depth):
            least = np.minimum.reduceat(flat * factors[tree, at] + shifts[tree, at], starts)
            out[:, tree] = (out[:, tree] ^ least) * np.uint64(0x9E3779B97F4A7C15)
            out[:, tree] ^= out[:, tree] >> np.uint64(31)
    return out


def _signed(docs: DataFrame, width: int, depth: int) -> DataFrame:
    """``_key``, ``mark`` (hash of the text), ``node`` (digest of the shingle set; null if it
    has none), ``size`` (its shingles) and ``sig``."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        shingle = Shingler(width)
        for batch in batches:
            sets = [shingle(t) for t in batch["_text"]]
            full = [i for i, s in enumerate(sets) if len(s)]
            nodes: list[bytes | None] = [None] * len(sets)
            sigs: list[bytes | None] = [None] * len(sets)
            if full:
                signed = signatures([sets[i] for i in full], depth)
                for row, i in enumerate(full):
                    nodes[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                    sigs[i] = signed[row].astype("<i8").tolist()
            yield {
                "_key": batch["_key"],
                "mark": batch["mark"],
                "node": nodes,
                "size": [len(s) for s in sets],
                "sig": sigs,
            }

    kind = docs.schema["_key"].dataType.simpleString()
    schema = f"_key {kind}, mark bigint, node binary, size bigint, sig array<bigint>"
    return map_arrow(docs, schema, rows)


def group_links(
    sets: list[np.ndarray], blocks: np.ndarray, first: int, second: int, threshold: float
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Link counts of all sets and a spanning forest of the links between two blocks
    (or within one, if they are the same)."""
    counts = np.zeros(len(sets), np.int64)
    sizes = np.array([len(s) for s in sets])
    left = np.flatnonzero(blocks == first)
    right = np.flatnonzero(blocks == second)
    if not len(left) or not len(right):
        return counts, []
    flat = np.concatenate([sets[i] for i in right])
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tree = []
    for row, i in enumerate(left):
        low = np.searchsorted(flat, sets[i], "left")
        runs = np.searchsorted(flat, sets[i], "right") - low
        total = int(runs.sum())
        if not total:
            continue
        at = np.arange(total) + np.repeat(low - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs)
        shared = np.bincount(owner[at], minlength=len(right))
        if first == second:
            shared[: row + 1] = 0
        close = np.flatnonzero(shared >= threshold * (sizes[i] + sizes[right] - shared))
        close = close[shared[close] > 0]
        counts[i] += len(close)
        counts[right[close]] += 1
        for j in right[close]:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                tree.append((int(i), int(j)))
    return counts, tree


def _verified(members: DataFrame, width: int, threshold: float) -> DataFrame:
    """Rows ``u``, ``v``, ``n``: links of ``u`` counted in a block pair, or a tree edge (n = 0)."""
    sized = members.groupBy("root").agg(F.sum("size").alias("total"))
    blocked = members.join(sized.withColumn("bs", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int")), "root")
    own = F.pmod(F.xxhash64("node"), F.col("bs")).cast("int")
    spread = (
        blocked.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("bs") - 1)))
        .select(
            "root",
            F.least("own", "other").alias("a"),
            F.greatest("own", "other").alias("b"),
            "own",
            "node",
            "_text",
        )
    )

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(width)
        key, nodes, sets, own, seen = None, [], [], [], set()

        def done() -> pa.RecordBatch:
            counts, tree = group_links(sets, np.array(own), key[1], key[2], threshold)
            u = [n for n, c in zip(nodes, counts, strict=True) if c] + [nodes[i] for i, _ in tree]
            v = [None] * (len(u) - len(tree)) + [nodes[j] for _, j in tree]
            n = [int(c) for c in counts if c] + [0] * len(tree)
            return pa.RecordBatch.from_arrays(
                [pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(n, pa.int64())], ["u", "v", "n"]
            )

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
                if row[:3] != key:
                    if len(nodes) > 1:
                        yield done()
                    key, nodes, sets, own, seen = row[:3], [], [], [], set()
                if row[4] in seen:  # a repeated row
                    continue
                seen.add(row[4])
                nodes.append(row[4])
                sets.append(shingle(row[5]))
                own.append(row[3])
        if len(nodes) > 1:
            yield done()

    together = spread.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b")
    return together.mapInArrow(links, "u binary, v binary, n bigint")


def jaccard_join(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per input row: ``key``, ``class_id``, ``class_size`` (documents), ``n_links``
    (other sets at the threshold or above) and ``n_copies`` (other documents with this set)."""
    classes = _classes(docs, text, key, width, threshold)
    return classes.drop("mark", "names").withColumnRenamed("_key", key)


def _classes(docs: DataFrame, text: str, key: str, width: int, threshold: float) -> DataFrame:
    """The columns of ``jaccard_join`` with the id as ``_key``, ``mark``, a hash of the text, and
    ``names``: whether this id and text name the class (its smallest id, then its smallest mark)."""
    prepared(docs.sparkSession)
    depth = match_depth(threshold)
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("mark"))
    signed = _signed(narrow, width, depth).checkpoint()
    full = signed.where("node is not null")
    # One row per set: a set with very many copies leaves one row per task.
    sets = full.groupBy("node").agg(
        F.first("sig").alias("sig"), F.first("size").alias("size"), F.min(F.struct("_key", "mark")).alias("one")
    )
    by_id = full.groupBy("node", "_key").agg(F.min("mark").alias("mark"))
    first = F.struct(F.col("_key").isNull().alias("without"), "_key", "mark")
    distinct = by_id.groupBy("node").agg(
        F.min("_key").alias("least"), F.count("*").alias("copies"), F.min(first).alias("first")
    )
    tries = sets.select("node", F.explode("sig").alias("prefix"))
    least = tries.groupBy("prefix").agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1")
    ties = tries.join(least, "prefix").where("node <> v").select(F.col("node").alias("u"), "v")
    groups = components(ties)
    spoken = sets.join(groups, "node").select("node", "root", "size", "one._key", "one.mark")
    texts = narrow.alias("t").join(
        spoken.alias("s"), F.expr("t._key <=> s._key and t.mark = s.mark")
    ).select("s.root", "s.node", "s.size", "t._text")
    found = _verified(texts, width, threshold).checkpoint()
    counted = found.where("n > 0").groupBy("u").agg(F.sum("n").alias("n_links"))
    classes = components(found.where("n = 0").select("u", "v"))
    labelled = (
        distinct.join(classes, "node", "left")
        .join(counted.withColumnRenamed("u", "node"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    sized = labelled.groupBy("root").agg(
        F.min("least").alias("class_id"), F.sum("copies").alias("class_size"), F.min("first").alias("chief")
    )
    by_node = labelled.join(sized, "root").select("node", "class_id", "class_size", "copies", "n_links", "chief")
    is_chief = F.col("_key").eqNullSafe(F.col("chief._key")) & (F.col("mark") == F.col("chief.mark"))
    return signed.join(by_node, "node", "left").select(
        "_key",
        "mark",
        F.when(F.col("node").isNull(), F.col("_key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("bigint").alias("class_size"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.greatest(F.coalesce(F.col("copies") - 1, F.lit(0)), F.lit(0)).cast("bigint").alias("n_copies"),
        (F.col("node").isNull() | is_chief).alias("names"),
    )


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents, all columns, that name a class: one of each class stays.

    It is the one with the smallest id, and of its texts in the class the one with the
    smallest hash; a document without an id names a class only where none has an id.
    Repeated rows of such a document become one. The rows are dealt out once, for join and repeats alike.
    """
    columns = docs.columns
    as_text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    named = _classes(docs, text, key, WIDTH, THRESHOLD).where("names")
    kept = named.select(as_text(F.col("_key")).alias("__id"), F.col("mark").alias("__mark")).distinct()
    marked = docs.withColumn("__id", as_text(F.col(key))).withColumn("__mark", F.xxhash64(text))
    left = marked.join(kept, ["__id", "__mark"], "left_semi")
    return left.dropDuplicates(["__id", "__mark"]).select(columns)
