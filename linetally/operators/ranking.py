"""Row numbers and tiles that do not put one big group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linetally.env import written

# A key or a window of up to this many rows may be handled by one task.
ONE_TASK_ROWS = 2_000_000
# Keys are counted in this many hash buckets to find the big ones.
HASH_BUCKETS = 65_536
# There are enough buckets for the mean to stay this many times under the limit.
ROOM = 8
# A selection counts its rows in this many value ranges a round ...
SELECT_RANGES = 4_096
# ... and reads the row itself once no more than this many are left.
SELECT_FEW = 10_000
# Shuffles sized from row counts aim for this many rows per task: order lines of that number are sorted in memory, even
# where chance deals a task a few times as many.
ROWS_PER_TASK = 250_000


def tasks_for(rows: int) -> int:
    """Shuffle partitions for a number of rows."""
    return max(1, -(-rows // ROWS_PER_TASK))


def hash_buckets_for(rows: int, limit: int) -> int:
    """Hash buckets that keep the mean well under the limit, at any number of rows."""
    count = HASH_BUCKETS
    while count * limit < ROOM * rows:
        count *= 2
    return count


def ranged_row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, partitions: int
) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` for any key size.

    Rows are range-partitioned by key and order, so a key that does not fit in
    one partition spans neighbouring ones. Each (partition, key) piece is
    numbered on its own, then shifted by the rows of that key in earlier
    partitions. A per-row tie id lets even exact copies be split. The ranged
    rows are written once, because both the pieces and the shifts read them.
    """
    tie, part, local, before = "__tie", "__part", "__local", "__before"
    sort = [F.col(k).asc() for k in keys] + list(order) + [F.col(tie).asc()]
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(partitions, *sort)
    ranged = written(ranged.withColumn(part, F.spark_partition_id()), "ranged")

    piece = Window.partitionBy(part, *keys).orderBy(*order, F.col(tie).asc())
    # by range of the part's number: each part is a task of its own, where a hash would leave tasks empty
    numbered = ranged.repartitionByRange(partitions, part).withColumn(local, F.row_number().over(piece))

    # a key has at most one piece per partition, so this window stays small
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    pieces = ranged.groupBy(part, *keys).agg(F.count(F.lit(1)).alias("__n"))
    shifts = pieces.withColumn(before, F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    # Only the first key of a partition can have begun in an earlier one, so
    # there are at most as many shifts as partitions: small enough to send out.
    shifts = F.broadcast(shifts.where(F.col(before) > 0))

    p, s = numbered.alias("p"), shifts.alias("s")
    same = F.col(f"p.{part}") == F.col(f"s.{part}")
    for k in keys:
        same = same & F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}"))
    number = F.col(f"p.{local}") + F.coalesce(F.col(f"s.{before}"), F.lit(0))
    return p.join(s, same, "left").select(*[F.col(f"p.{c}") for c in df.columns], number.alias(out))


def hot_hash_buckets(df: DataFrame, bucket: Column, more_than: int) -> dict[int, int]:
    """Hash buckets of the key with more rows than ``more_than``, and their rows.

    A bucket's rows are at least those of any key in it, so no bigger key is
    missed. The count combines before the shuffle; only buckets over the limit
    reach the driver, and there cannot be more than rows / limit of them.
    """
    counted = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return {r["b"]: r["n"] for r in counted.where(F.col("n") > more_than).collect()}


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str,
    one_task_rows: int = ONE_TASK_ROWS,
    along: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Row numbers per key: a plain window, and the ranged form for big keys.

    ``df`` should read from a table, since it is looked at more than once.
    Every row goes through exactly one of the two forms, so nothing is dropped
    or capped, and the numbers are those of the plain window.

    ``along`` names columns that follow from the key. The rows are then
    shuffled by them, which serves the window and leaves the output laid out
    by them, where a shuffle by the key would call for a second one.
    """
    # the row count comes from file footers; a small frame has no big key
    total, limit = df.count(), max(1, one_task_rows)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(hash_buckets_for(total, limit)))
    hot = hot_hash_buckets(df, bucket, limit) if total > limit else {}
    is_hot = bucket.isin(list(hot))

    rest = df.where(~is_hot) if hot else df
    if along:
        rest = rest.repartition(partitions or tasks_for(total), *along)
    plain = Window.partitionBy(*along, *keys).orderBy(*order)
    numbered = rest.withColumn(out, F.row_number().over(plain))
    if not hot:
        return numbered
    # a few pieces per hot bucket at least, so that a small limit splits too
    pieces = max(tasks_for(sum(hot.values())), 2 * len(hot))
    hot_part = ranged_row_number(df.where(is_hot), keys, order, out, pieces)
    if along:  # laid out like the others, in as many tasks as their sizes ask for
        hot_part = hot_part.hint("rebalance", *along)
    return numbered.unionByName(hot_part.withColumn(out, F.col(out).cast("int")))


def tile_of(number: Column, total: int, tiles: int) -> Column:
    """The ``ntile`` of a row number: the first ``total mod tiles`` tiles get one row more."""
    q, r = divmod(total, tiles)
    in_long_tiles = F.ceil(number / F.lit(q + 1))
    if q == 0:
        return in_long_tiles.cast("int")
    rest = F.lit(r) + F.ceil((number - F.lit(r * (q + 1))) / F.lit(q))
    return F.when(number <= F.lit(r * (q + 1)), in_long_tiles).otherwise(rest).cast("int")


def ntile_over_all(
    df: DataFrame,
    tiles: int,
    order: Sequence[Column],
    out: str,
    partitions: int | None = None,
) -> DataFrame:
    """``ntile(tiles) over (order by order)`` across the whole frame, ranked by ranges at any size.

    ``df`` should read from a table: it is counted first.
    """
    total = df.count()
    at_least = df.sparkSession.sparkContext.defaultParallelism
    ranked = ranged_row_number(df, [], order, "__rank", partitions or max(at_least, tasks_for(total)))
    return ranked.withColumn(out, tile_of(F.col("__rank"), total, tiles)).drop("__rank")


def _kind(value: str) -> Column:
    """Where a double stands in ascending order, NULL last: -inf, finite, inf, NaN, NULL."""
    v = F.col(value)
    infinite = F.abs(v) == F.lit(float("inf"))
    return F.when(v.isNull(), 4).when(F.isnan(v), 3).when(infinite & (v > 0), 2).when(infinite, 0).otherwise(1)


def _kth_text(df: DataFrame, text: str, k: int, few: int) -> str:
    """The k-th smallest text, one more code point of it known a round."""
    known = ""
    while True:
        step = F.substring(F.col(text), len(known) + 1, 1)
        groups = df.where(F.startswith(F.col(text), F.lit(known))).groupBy(step.alias("step"))
        for g in groups.agg(F.count(F.lit(1)).alias("n"), F.max(text).alias("last")).orderBy("step").collect():
            if k <= g["n"]:
                break
            k -= g["n"]
        known += g["step"]
        if k == g["n"] or g["step"] == "":
            return g["last"]
        if g["n"] <= few:
            left = df.where(F.startswith(F.col(text), F.lit(known)))
            return left.select(text).orderBy(text).offset(k - 1).limit(1).first()[0]


def kth_row(df: DataFrame, value: str, tie: str, k: int, ranges: int = SELECT_RANGES, few: int = SELECT_FEW) -> tuple[int, float | None, str]:
    """Kind, value and tie of the k-th row in ascending order of ``value`` (a double, NULL last) and ``tie`` (a text).

    A selection, not a sort: rows are counted in value ranges between the smallest and the greatest value that can
    still be it, and the range of the k-th row is looked at again, until it holds one value or few rows. Rows of one
    value are told apart by the text in the same way, code point by code point. What moves are counts of up to
    ``ranges`` ranges a round, at any number of rows and however many rows share a value.
    """
    df = df.select(value, tie)
    for kind, n in df.groupBy(_kind(value).alias("kind")).agg(F.count(F.lit(1)).alias("n")).orderBy("kind").collect():
        if k <= n:
            break
        k -= n
    left = df.where(_kind(value) == kind)
    if kind != 1:
        return kind, left.select(value).first()[0], _kth_text(left, tie, k, few)
    v = F.col(value)
    low, high = left.agg(F.min(v), F.max(v)).first()
    while low != high:
        if n <= few:
            row = left.orderBy(value, tie).offset(k - 1).limit(1).first()
            return kind, row[0], row[1]
        # halves, so that the width of the widest range is still a double
        width = F.lit(high / 2 - low / 2)
        number = F.least(F.floor((v / 2 - F.lit(low / 2)) / width * ranges), F.lit(ranges - 1))
        if high / 2 == low / 2:  # below the smallest double that can be halved
            number = F.when(v == F.lit(low), 0).otherwise(1)
        counts = left.groupBy(number.alias("number")).agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"))
        for _, n, low, high in counts.orderBy("number").collect():
            if k <= n:
                break
            k -= n
        left = df.where((_kind(value) == kind) & v.between(F.lit(low), F.lit(high)))
    return kind, low, _kth_text(left, tie, k, few)


def ntile_by_selection(
    df: DataFrame, tiles: int, value: str, tie: str, out: str, ranges: int = SELECT_RANGES, few: int = SELECT_FEW
) -> DataFrame:
    """``ntile(tiles) over (order by value asc nulls last, tie)`` without a sort or a shuffle of the rows.

    The last row of each tile but the last is selected, and rows are tagged by comparison with these. ``value`` is a
    double and ``tie`` a text that no two rows of one value share and that is never NULL. ``df`` should read from a
    table: it is scanned a few times, two columns wide.
    """
    if df.schema[value].dataType.typeName() != "double" or df.schema[tie].dataType.typeName() != "string":
        raise TypeError(f"tiles are selected by a double and a text, not {df.schema[value]} and {df.schema[tie]}")
    total = df.count()
    q, r = divmod(total, tiles)
    ends = accumulate(q + (i < r) for i in range(tiles - 1))
    tile = F.lit(1)
    for end in sorted({e for e in ends if e < total}):
        kind, last, text = kth_row(df, value, tie, end, ranges, few)
        later = F.col(tie) > F.lit(text)
        if kind == 1:
            later = (F.col(value) > F.lit(last)) | ((F.col(value) == F.lit(last)) & later)
        tile = tile + ((_kind(value) > kind) | ((_kind(value) == kind) & later)).cast("int")
    return df.withColumn(out, tile)
