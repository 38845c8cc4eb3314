"""Dataset splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.operators.order import with_position


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.9, 0.1), seed: int = 42
) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)


def in_test(*key: str, parts: int = 10, seed: int = 42) -> Column:
    """True for one of ``parts`` shares of the rows, by a hash of the key: the
    same rows whatever the partitioning and after the loss of an executor."""
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(parts)) == parts - 1


def hash_split(df: DataFrame, *key: str, parts: int = 10, seed: int = 42):
    """Train and test rows by ``in_test``."""
    test = in_test(*key, parts=parts, seed=seed)
    return df.where(~test), df.where(test)


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all tables, columns matched by position."""
    for other in others:
        first = first.union(other)
    return first


def k_folds(df: DataFrame, order: Sequence[str], k: int = 5, size: int | None = None) -> DataFrame:
    """Add ``fold`` 1..k: consecutive blocks of ``size`` rows in the given order,
    by default just large enough for k blocks. Rows past the last block get 0.
    """
    numbered = with_position(df, order)
    if size is None:
        total = numbered.agg(F.max("pos")).scalar()
        numbered = numbered.withColumn("_total", total).withColumn(
            "_size", F.expr(f"(_total + {k - 1}) div {k}")
        )
    else:
        numbered = numbered.withColumn("_size", F.lit(size))
    fold = F.expr("(pos - 1) div _size") + 1
    return numbered.withColumn(
        "fold", F.when(fold <= k, fold).otherwise(F.lit(0)).cast("int")
    ).select(*df.columns, "pos", "fold")


def fold(folds: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
    """Base and test rows of one fold."""
    return folds.where(F.col("fold") != i), folds.where(F.col("fold") == i)


#: Positions that are ranked together when the rows of a user are counted.
BLOCK_ROWS = 1_000_000


def leave_n(
    df: DataFrame,
    user: str,
    order: Sequence[str],
    start: int,
    stop: int,
    max_test: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``is_test``: the ``start``-th to ``stop``-th row of each user, at most
    ``max_test`` rows in total in row order (no bound if 0 or less).

    A row's number is its rank within its user and block of positions, plus the user's
    rows in earlier blocks, which are counted per user and block. A window holds one
    block of one user at most, whatever the bounds and however many rows a user has.
    """
    blocked = with_position(df, order).withColumn("_block", F.expr(f"(pos - 1) div {block_rows}"))
    earlier = Window.partitionBy(user).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        blocked.groupBy(user, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            F.col(user).alias("_user"),
            F.col("_block").alias("_b"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    inside = Window.partitionBy(user, "_block").orderBy("pos")
    ranked = blocked.withColumn("_in", F.row_number().over(inside))
    same = F.col(user).eqNullSafe(F.col("_user")) & (F.col("_block") == F.col("_b"))
    marked = ranked.join(counts, same).withColumn(
        "is_test", (F.col("_in") + F.col("_offset")).between(start, stop)
    )
    if max_test > 0:
        last = (
            with_position(marked.where("is_test").select("pos"), ["pos"], "_rank")
            .where(F.col("_rank") <= max_test)
            .agg(F.max("pos"))
            .scalar()
        )
        marked = marked.withColumn("is_test", F.col("is_test") & (F.col("pos") <= last))
    return marked.select(*df.columns, "pos", "is_test")


def random_row(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """One row drawn by a digest of seed and key: the same row whatever the partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return df.orderBy(digest, key).limit(1)


#: Bits of a digest that are counted at a time, and digest bits in all.
STEP_BITS, DIGEST_BITS = 12, 60


def digest(*key: str, seed: int = 42) -> Column:
    """A number of ``DIGEST_BITS`` bits from seed and key; null parts are told from empty ones."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in key]
    text = F.concat_ws(":", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGEST_BITS // 4), 16, 10).cast("bigint")


def smallest_digests(rows: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> tuple[int, int]:
    """``(bound, extra)``: the ``n`` smallest digests are all those below the bound and ``extra`` of
    those that equal it.

    The bound is found by counting: each pass counts the rows by the next ``STEP_BITS`` bits
    among the rows whose digest begins like the bound, so a pass returns a few thousand
    numbers and no row moves.
    """
    if n <= 0:
        return 0, 0
    found, rest = 0, n
    digests = rows.select(digest(*key, seed=seed).alias("d"))
    for low in range(DIGEST_BITS - STEP_BITS, -1, -STEP_BITS):
        begins = F.shiftrightunsigned("d", low + STEP_BITS) == F.lit(found).cast("bigint")
        part = F.shiftrightunsigned("d", low).bitwiseAND(F.lit((1 << STEP_BITS) - 1))
        counts = dict(digests.where(begins).groupBy(part.alias("p")).count().collect())
        for p in sorted(counts):
            if rest <= counts[p]:
                found = found << STEP_BITS | p
                break
            rest -= counts[p]
        else:  # fewer than n rows
            return 1 << DIGEST_BITS, 0
    return found, rest


def exact_split(df: DataFrame, *key: str, share: float = 0.9, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Two parts, the first of exactly ``round(share * rows)`` rows (halves up): those with the
    smallest digests of their key. The same rows whatever the partitioning and after the loss of
    an executor. Rows of one digest (repeated keys) that the bound parts are told apart by all
    their columns; whole repeats are then split by number."""
    total = df.count()
    bound, extra = smallest_digests(df, key, int(total * share + 0.5), seed)
    own = digest(*key, seed=seed)
    first, second = df.where(own < bound), df.where(own > bound)
    ties = df.where(own == bound)
    if extra == 0:
        return first, second.unionByName(ties)
    # Rows of one digest: of one key, or of so few that their number does not grow with the table.
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
    ranked = with_position(ties.withColumn("_whole", whole), ["_whole"], "_rank")
    kept = ranked.where(F.col("_rank") <= extra).drop("_whole", "_rank")
    left = ranked.where(F.col("_rank") > extra).drop("_whole", "_rank")
    return first.unionByName(kept), second.unionByName(left)
