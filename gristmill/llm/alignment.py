"""Which tokens of two tokenizers cover the same bytes, by pointer jumping.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (BPE over pieces) reads
the text and adds the space itself, so both cut the same bytes. Tokens are intervals of
bytes; tokens of A and B that overlap belong together. Every token points to the token
farthest to the right that it overlaps, itself included; of two that end alike it is B's.
All pointers of a batch are doubled at once (``next = next[next]``) until none moves; each
then names the last token of its group. Groups end where an A and a B token end together.

A link is a pair of occurrences that overlap. Between two neighbouring ends lies exactly one
token of each side, so links are counted by ends. The count of a pair of ids is the number
of documents that hold it linked. Documents are encoded once: their rows, with their links
as places in the sorted pairs of their batch, are written below the shared folder. Each
batch's pairs are summed over all batches and sent back to it by buckets of pairs; a pair
that every document holds is one row per batch.

Strings of special tokens in a text are plain text. Texts that are null or empty, or that a
tokenizer does not give back byte by byte, have no tokens: their counts are 0 and ``groups``
and its digest are empty. Repeated rows count as documents of their own. An empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gristmill.llm.chunks import STEP, packed, unpacked
from gristmill.llm.pieces import SPACE
from gristmill.session import scratch

#: Characters after which a long text is cut at the next place no token crosses.
PART = 1 << 16
#: A space between a plain letter or mark and a letter starts a token on both sides.
CUT = re.compile(r"(?<=[A-Za-z.,]) (?=[A-Za-z])")


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones stand
    for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """Tokenizer A, from its JSON file and the pattern that splits texts before the merges."""

    def __init__(self, file: bytes, pattern: str):
        whole = json.loads(file)
        special = {t["content"] for t in whole["added_tokens"] if t["special"]}
        values = byte_characters()
        ranks = {}
        for token, i in whole["model"]["vocab"].items():
            if token not in special:
                ranks[bytes(values[c] for c in token)] = i
        merges = [m.split(" ") if isinstance(m, str) else m for m in whole["model"]["merges"]]
        order = [ranks[bytes(values[c] for c in a + b)] for a, b in merges]
        if order != sorted(order):
            raise ValueError("the vocabulary's ids are not in the order of its merges")
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self.encoding = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(" " + text)


class PieceTokens:
    """Tokenizer B, from its model file."""

    def __init__(self, file: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        #: Whether every piece holds its space marks at the front, so that words are apart.
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def _ends(tokens: list[bytes]) -> np.ndarray:
    return np.array([len(t) for t in tokens], dtype=np.int64)


class Pair:
    """Both tokenizers with what a batch needs of them."""

    def __init__(self, a: bytes, b: bytes, pattern: str):
        self.a, self.b = ByteTokens(a, pattern), PieceTokens(b)
        self.a_size, self.b_size = _ends(self.a.bytes), _ends(self.b.bytes)
        # The text of each id inside a group and at its end.
        self.a_text = np.array([f"{i}{c}" for i in range(len(self.a_size)) for c in ",|"], dtype=object)
        self.b_text = np.array([f"{i}{c}" for i in range(len(self.b_size)) for c in ",;"], dtype=object)

    def encode(self, text: str | None, part: int = PART) -> tuple[list[int], list[int]]:
        """The ids of both, or none at all if one does not give the bytes back."""
        if not text:
            return [], []
        ids_a: list[int] = []
        ids_b: list[int] = []
        for piece in cut(text, part) if self.b.apart else [text]:
            ids_a += self.a.encode(piece)
            ids_b += self.b.encode(piece)
        data = (" " + text).encode()
        same = (
            b"".join(map(self.a.bytes.__getitem__, ids_a)) == data
            and b"".join(map(self.b.bytes.__getitem__, ids_b)) == data
        )
        return (ids_a, ids_b) if same else ([], [])


def cut(text: str, part: int) -> list[str]:
    """The text in parts which both tokenizers read alone as they do inside the text; the
    space at a cut is the one that a part starts with."""
    out, start = [], 0
    while len(text) - start > part:
        found = CUT.search(text, start + part)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.end()
    return [*out, text[start:]]


@lru_cache(2)
def tokenizers(a: bytes, b: bytes, pattern: str) -> Pair:
    return Pair(a, b, pattern)


def farthest(start_a, end_a, start_b, end_b) -> np.ndarray:
    """The place of the token farthest right that each token overlaps: A's tokens first, then B's."""
    n = len(end_a)
    to_b = np.searchsorted(start_b, end_a) - 1 + n
    to_a = np.searchsorted(start_a, end_b) - 1
    own = np.arange(n, n + len(end_b))
    return np.concatenate([to_b, np.where(end_a[to_a] > end_b, to_a, own) if n else own])


def labels(pointer: np.ndarray) -> np.ndarray:
    """The end of every pointer chain, by doubling."""
    while True:
        after = pointer[pointer]
        if np.array_equal(after, pointer):
            return after
        pointer = after


class Aligned:
    """The groups and links of the texts of a batch, whose bytes lie end to end."""

    def __init__(self, pair: Pair, ids_a: list[list[int]], ids_b: list[list[int]]):
        self.a = np.array([i for x in ids_a for i in x], dtype=np.int64)
        self.b = np.array([i for x in ids_b for i in x], dtype=np.int64)
        self.n_a = np.array([len(x) for x in ids_a], dtype=np.int64)
        self.n_b = np.array([len(x) for x in ids_b], dtype=np.int64)
        size_a, size_b = pair.a_size[self.a], pair.b_size[self.b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        label = labels(farthest(end_a - size_a, end_a, end_b - size_b, end_b))
        # Last tokens of groups are B's; they number the groups from left to right.
        last = np.flatnonzero(label[len(self.a) :] == np.arange(len(self.a), len(label)))
        number = np.cumsum(np.bincount(last, minlength=len(self.b))) - 1 if len(last) else np.zeros(0, dtype=np.int64)
        self.group = number[label - len(self.a)]
        self.text_end = np.append(0, np.cumsum(self.n_a))[1:]
        self.end_a, self.end_b, self.last = end_a, end_b, last
        first = np.cumsum(self.n_b) - self.n_b
        group_b = self.group[len(self.a) :]
        self.n_groups = np.zeros(len(self.n_a), dtype=np.int64)
        some = self.n_b > 0
        at = first[some]
        self.n_groups[some] = group_b[at + self.n_b[some] - 1] - group_b[at] + 1

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The A token and the B token of every link, and the text it lies in."""
        ends = np.sort(np.concatenate([self.end_a, self.end_b]))
        ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
        at_a, at_b = np.searchsorted(self.end_a, ends), np.searchsorted(self.end_b, ends)
        return at_a, at_b, np.searchsorted(self.text_end, at_a, side="right")

    def written(self, pair: Pair) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for every text."""
        n, m = len(self.a), len(self.b)
        group_a, group_b = self.group[:n], self.group[n:]
        groups = len(self.last)
        through_a = np.cumsum(np.bincount(group_a, minlength=groups))
        through_b = np.cumsum(np.bincount(group_b, minlength=groups))
        out = np.empty(n + m, dtype=object)
        before_b = through_b - np.bincount(group_b, minlength=groups)
        last_a = np.append(group_a[1:] != group_a[:-1], True)[:n]
        last_b = np.append(group_b[1:] != group_b[:-1], True)[:m]
        out[np.arange(n) + before_b[group_a]] = pair.a_text[self.a * 2 + last_a]
        out[np.arange(m) + through_a[group_b]] = pair.b_text[self.b * 2 + last_b]
        cuts = np.append(0, np.cumsum(self.n_a + self.n_b)).tolist()
        whole = out.tolist()
        return ["".join(whole[x:y])[:-1] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def planes(values: np.ndarray) -> bytes:
    """Rising numbers as differences, the bytes of equal weight together: high ones are mostly zero."""
    return np.diff(values, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    rows = np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(rows).view("<u4").ravel().astype(np.int64))


ROWS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def encoded(docs: DataFrame, a: bytes, b: bytes, pattern: str, key: str, text: str, keep_groups: bool) -> DataFrame:
    """A row per document with its links; the first row of a batch has the batch's pairs, as
    ``id of A * size of B + id of B``, and in how many of its documents each is linked."""
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, _batch bigint, {ROWS}, links binary, pairs binary, docs binary"
    fields = docs.sparkSession.createDataFrame([], schema + ", groups string" * keep_groups).schema
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(a, b, pattern)
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) * STEP
        for number, batch in enumerate(batches):
            texts = batch.column("_text").to_pylist()
            both = [pair.encode(t) for t in texts]
            made = Aligned(pair, [x[0] for x in both], [x[1] for x in both])
            groups = made.written(pair)
            at_a, at_b, owner = made.links()
            pairs, place = np.unique(made.a[at_a] * len(pair.b_size) + made.b[at_b], return_inverse=True)
            spots = np.sort(owner * max(1, len(pairs)) + place)
            owners, spots_in = spots // max(1, len(pairs)), spots % max(1, len(pairs))
            new = np.append(True, spots[1:] != spots[:-1])[: len(spots)]
            held = np.bincount(spots_in[new], minlength=len(pairs))
            n_links = np.bincount(owners, minlength=len(texts))
            cuts = np.append(0, np.cumsum(n_links))
            spans = zip(cuts[:-1], cuts[1:], strict=True)
            out = {
                "_key": batch.column("_key"),
                "_batch": pa.array(np.full(len(texts), first + number)),
                "n_a": pa.array(made.n_a),
                "n_b": pa.array(made.n_b),
                "n_groups": pa.array(made.n_groups),
                "n_links": pa.array(n_links.astype(np.int64)),
                "groups_sha256": pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
                "links": pa.array([planes(spots_in[x:y]) for x, y in spans], pa.binary()),
                "pairs": pa.array([packed(pairs)] + [None] * (len(texts) - 1), pa.binary()),
                "docs": pa.array([packed(held.astype(np.int64))] + [None] * (len(texts) - 1), pa.binary()),
            }
            if keep_groups:
                out["groups"] = pa.array(groups)
            yield pa.RecordBatch.from_arrays([out[f.name].cast(f.type) for f in arrow], schema=arrow)

    return narrow.mapInArrow(run, fields)


def _spread(rows: DataFrame, buckets: int) -> DataFrame:
    """The pairs and document counts of every batch by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, pairs, docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pairs, docs = np.frombuffer(pairs, dtype=np.int64), np.frombuffer(docs, dtype=np.int64)
                bucket = pairs % buckets
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                used = [i for i in range(buckets) if cuts[i] < cuts[i + 1]]
                spans = [order[cuts[i] : cuts[i + 1]] for i in used]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used, pa.int32()),
                        pa.array([number] * len(used), pa.int64()),
                        pa.array([packed(pairs[s]) for s in spans], pa.binary()),
                        pa.array([packed(docs[s]) for s in spans], pa.binary()),
                    ],
                    names=["bucket", "batch", "pairs", "docs"],
                )

    asked = rows.where("pairs is not null").select("_batch", "pairs", "docs")
    return asked.mapInArrow(run, "bucket int, batch bigint, pairs binary, docs binary")


def _sum(table: pa.Table) -> pa.Table:
    pairs, docs = unpacked(table["pairs"], np.int64), unpacked(table["docs"], np.int64)
    found, place = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, place, docs)
    return pa.table({"pair": pa.array(found), "total": pa.array(total)})


def _answer(asked: pa.Table, totals: pa.Table) -> pa.Table:
    """For every batch, the corpus-wide count of each of its pairs, negative if it is not the best."""
    order = np.argsort(totals["pair"].to_numpy())
    pair = totals["pair"].to_numpy()[order]
    value = np.where(totals["best"].to_numpy(), totals["total"].to_numpy(), -totals["total"].to_numpy())[order]
    counts = [packed(value[np.searchsorted(pair, np.frombuffer(p, dtype=np.int64))]) for p in asked["pairs"].to_pylist()]
    return pa.table({"batch": asked["batch"], "pairs": asked["pairs"], "counts": pa.array(counts, pa.binary())})


def _finish(docs: pa.Table, counts: pa.Table) -> pa.Table:
    pairs, values = unpacked(counts["pairs"], np.int64), unpacked(counts["counts"], np.int64)
    values = values[np.argsort(pairs)]
    best, total = [], []
    for data in docs["links"].to_pylist():
        mine = values[from_planes(data)]
        best.append(int((mine > 0).sum()))
        total.append(int(np.abs(mine).sum()))
    out = docs.drop_columns(["_batch", "links"])
    return out.append_column("n_best", pa.array(best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))


def pair_counts(rows: DataFrame, buckets: int, b_size: int) -> tuple[DataFrame, DataFrame]:
    """The batches' pairs by bucket, and ``bucket``, ``pair``, ``total``, ``best`` of all pairs."""
    asked = _spread(rows, buckets)
    totals = asked.groupBy("bucket").applyInArrow(_sum, "pair bigint, total bigint")
    # One row per pair of ids: at most the product of the vocabularies, whatever the corpus.
    own = Window.partitionBy(F.expr(f"pair div {b_size}"))
    ranked = totals.withColumn("best", F.col("total") == F.max("total").over(own))
    return asked, ranked.withColumn("bucket", (F.col("pair") % buckets).cast("int"))


def align_documents(
    docs: DataFrame,
    a: bytes,
    b: bytes,
    pattern: str,
    text: str = "text",
    key: str = "doc_id",
    keep_groups: bool = False,
) -> DataFrame:
    """``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256`` and, if asked for, ``groups``, per row of ``docs``."""
    spark = docs.sparkSession
    path = scratch(spark, "alignment")
    encoded(docs, a, b, pattern, key, text, keep_groups).write.parquet(path)
    rows = spark.read.parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked, totals = pair_counts(rows, buckets, len(PieceTokens(b).bytes))
    answers = asked.groupBy("bucket").cogroup(totals.groupBy("bucket")).applyInArrow(
        _answer, "batch bigint, pairs binary, counts binary"
    )
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, {ROWS}" + ", groups string" * keep_groups + ", n_best bigint, count_sum bigint"
    own = rows.drop("pairs", "docs").groupBy("_batch")
    done = own.cogroup(answers.groupBy("batch")).applyInArrow(_finish, schema)
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return done.select(F.col("_key").alias(key), *columns, *["groups"] * keep_groups)


def read_files(a: str, b: str) -> tuple[bytes, bytes]:
    """Both files as bytes; the driver reads them once and tasks carry them."""
    with open(a, "rb") as file_a, open(b, "rb") as file_b:
        return file_a.read(), file_b.read()
