"""Sharding as a minimax contiguous partition. DataFrame functions only.

Documents of equal text are one atomic group; groups are ordered by a hash of the
text. The smallest shard capacity under which greedy filling needs no more than
the given shards is found by binary search, and the groups are cut there.

The search works on sums over cells of the ordered hash range, of which the
driver holds a bounded number. It treats cells once as divisible and once as
whole, which brackets the smallest capacity; cells in which a cut may fall are
divided further until both agree. That capacity is the exact one. Groups larger
than a fair share come first in the order and have a shard each.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, fresh

SHARDS = 40
#: Hex digits of the first cells, and by how many a cell is divided further.
FIRST_DIGITS, MORE_DIGITS = 3, 2
#: Bytes that each document counts besides its text.
OVERHEAD = 16
#: Documents that are numbered in one task, about.
NUMBERED = 2000

Cell = tuple[str, int, int]  # first digits of the hash, bytes, groups


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def group_key(text: Column) -> Column:
    """Equal for equal texts; null texts are a group of their own."""
    return F.md5(F.coalesce(F.concat(F.lit("="), text), F.lit("")).cast("binary"))


def greedy(cells: list[Cell], capacity: int, divisible: bool) -> tuple[int, list[int]]:
    """Shards that greedy filling needs, and how many bytes lie before each cut. Cells of several groups may be
    divided anywhere if ``divisible``; a whole cell above the capacity makes it infeasible (more shards than bytes)."""
    n, free, done, cuts = 1, capacity, 0, []
    for _, size, groups in cells:
        if divisible and groups > 1:
            rest = size
            while rest > free:
                rest -= free
                done += free
                cuts.append(done)
                n, free = n + 1, capacity
            free -= rest
            done += rest
        else:
            if size > capacity:
                return 1 << 62, []
            if size > free:
                cuts.append(done)
                n, free = n + 1, capacity
            free -= size
            done += size
    return n, cuts


def smallest(cells: list[Cell], shards: int, divisible: bool) -> int:
    """The smallest feasible capacity, by binary search."""
    total = sum(c[1] for c in cells)
    low, high = max(1, -(-total // shards)), max(1, total)
    while low < high:
        middle = (low + high) // 2
        if greedy(cells, middle, divisible)[0] <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def uncertain(cells: list[Cell], low: int, high: int, shards: int) -> list[Cell]:
    """Cells of several groups in which a cut may fall for some capacity from low to high."""
    ends = []
    for _, size, _ in cells:
        ends.append((ends[-1] if ends else 0) + size)
    earliest, latest = [], greedy(cells, high, True)[1]
    # With whole cells a shard may stay short by the cell that did not fit, never by more.
    at = 0
    for _ in range(shards - 1):
        k = bisect.bisect_right(ends, at + low)
        at = ends[k - 1] if k and ends[k - 1] > at else at
        earliest.append(at)
    wanted: set[int] = set()
    for k in range(shards - 1):
        last = latest[k] if k < len(latest) else ends[-1]
        for i in range(bisect.bisect_right(ends, earliest[k]), min(bisect.bisect_left(ends, last) + 1, len(cells))):
            wanted.add(i)
    return [cells[i] for i in sorted(wanted) if cells[i][2] > 1]


def _cells(groups: DataFrame, digits: int, inside: list[str] | None = None) -> list[Cell]:
    """Sums of the groups by the first digits of their keys; only below the given shorter beginnings, if any."""
    if inside:
        spark, width = groups.sparkSession, len(inside[0])
        # A bounded list: the cells in which a cut may fall.
        few = spark.createDataFrame([(x,) for x in inside], "cell string")
        groups = groups.join(F.broadcast(few), F.substring("key", 1, width) == F.col("cell"), "left_semi")
    rows = groups.groupBy(F.substring("key", 1, digits).alias("cell")).agg(F.sum("bytes"), F.count(F.lit(1))).collect()
    return [(r[0], int(r[1]), int(r[2])) for r in rows]


def plan(groups: DataFrame, shards: int = SHARDS) -> tuple[list[str], list[str], int]:
    """Keys of the groups with a shard of their own, the first keys of all later shards, and the capacity.

    ``groups`` has key (hexadecimal, of 32 digits) and bytes, one row per group.
    """
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    own, left, rest = [], shards, total
    for key, size in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        if left == 1 or size * left <= rest:
            break
        own.append(key)
        left, rest = left - 1, rest - size
    groups = groups.where(~F.col("key").isin(own)) if own else groups
    cells = sorted(_cells(groups, FIRST_DIGITS))
    while cells:
        low, high = smallest(cells, left, True), smallest(cells, left, False)
        if low == high:
            break
        by_width: dict[int, list[str]] = {}
        for cell, _, _ in uncertain(cells, low, high, left):
            by_width.setdefault(len(cell), []).append(cell)
        if not by_width:
            by_width = {len(c[0]): [] for c in cells if c[2] > 1}
            for c in cells:
                if c[2] > 1:
                    by_width[len(c[0])].append(c[0])
        if not by_width:
            break
        divided = {x for some in by_width.values() for x in some}
        cells = [c for c in cells if c[0] not in divided]
        for width, some in by_width.items():
            cells += _cells(groups, min(32, width + MORE_DIGITS), some)
        cells.sort()
    capacity = smallest(cells, left, False) if cells else 0
    firsts, free = [], capacity
    for cell, size, _ in cells:
        if size > free:
            firsts.append(cell)
            free = capacity
        free -= size
    return own, firsts, capacity


def _shard(key: Column, own: list[str], firsts: list[str]) -> Column:
    after = F.size(F.filter(F.array(*map(F.lit, firsts)), lambda x: x <= key)) if firsts else F.lit(0)
    shard = after + len(own)
    for k, x in enumerate(own):
        shard = F.when(key == x, k).otherwise(shard)
    return shard.cast("int")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All columns and rows of ``docs`` with shard and slot (underscores go in front of taken names).

    Slots count from 0 without gaps in each shard, in a shuffled order. Null texts are one group, of OVERHEAD bytes
    each; equal texts, and so repeated rows, share a shard; no rows give none; fewer groups than shards leave shards
    empty. A group larger than a fair share of what is left has a shard to itself.
    """
    taken = list(docs.columns)
    key, salt, bucket, number, shard_name, slot = (fresh(taken, x) for x in ("key", "salt", "bucket", "number", "shard", "slot"))
    text = F.col("text")
    groups = checkpoint(docs.select(group_key(text).alias("key"), size_of(text).alias("bytes")).groupBy("key").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")))
    rows = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own, firsts, _ = plan(groups.select("key", "bytes"), shards)

    buckets = max(1, rows // (NUMBERED * shards)) * 8
    keyed = docs.withColumn(key, group_key(text)).withColumn(shard_name, _shard(F.col(key), own, firsts))
    # The row's place tells repeated rows apart, so that even those are numbered in several tasks.
    keyed = keyed.withColumn(salt, F.xxhash64("doc_id", key, F.monotonically_increasing_id()))
    keyed = keyed.withColumn(bucket, F.pmod(F.col(salt), F.lit(buckets)).cast("int"))
    return _numbered(keyed, shard_name, bucket, salt, key, slot).select(*(F.col(f"`{c}`") for c in taken), shard_name, slot)


def _numbered(keyed: DataFrame, shard_name: str, bucket: str, salt: str, key: str, slot: str) -> DataFrame:
    counts = keyed.groupBy(shard_name, bucket).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(shard_name).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    begun_name = fresh(keyed.columns, "begun")
    begun = counts.select(shard_name, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(begun_name))
    inside = Window.partitionBy(shard_name, bucket).orderBy(salt, key, "doc_id")
    joined = keyed.join(begun, [shard_name, bucket])
    return joined.withColumn(slot, (F.col(begun_name) + F.row_number().over(inside) - 1).cast("long"))


def sharding_report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    Null texts are one group, of OVERHEAD bytes each and crc32 0; equal texts, and so repeated rows, share a shard, each
    with a slot of its own; a null doc_id changes nothing; fewer groups than shards leave shards empty; no rows, none.
    """
    text = F.col("text")
    # Narrow rows: the text itself is read once and not shuffled.
    narrow = checkpoint(docs.select("doc_id", size_of(text).alias("size"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), group_key(text).alias("key"), F.monotonically_increasing_id().alias("row")))
    groups = checkpoint(narrow.groupBy("key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")))
    rows = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own, firsts, _ = plan(groups.select("key", "bytes"), shards)
    buckets = max(1, rows // (NUMBERED * shards)) * 8
    keyed = narrow.withColumn("shard", _shard(F.col("key"), own, firsts)).withColumn("salt", F.xxhash64("doc_id", "key", "row"))
    keyed = keyed.withColumn("bucket", F.pmod(F.col("salt"), F.lit(buckets)).cast("int"))
    numbered = _numbered(keyed, "shard", "bucket", "salt", "key", "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
