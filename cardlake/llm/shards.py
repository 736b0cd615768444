"""Minimax contiguous sharding, in DataFrame functions only.

Rows with equal texts form a group that is never split.  Groups stand in the
order of the SHA-256 of their text (rows without a text first), so a shard is a
range of digests and mixes the corpus evenly.  The boundaries of a group are
the sums of all sizes before it and up to it.

1. Smallest capacity: a binary search between the mean shard size and that
   plus the largest group.  A capacity is feasible if filling shard after
   shard greedily, each up to the last group that fits, takes all groups.
2. Cut: any cut within that capacity has the smallest possible largest shard.
   Of these each shard is cut next to the mean of what remains, where groups
   larger than that mean count as shards of their own; never so early that the
   rest wouldn't fit the shards that remain, nor so late that one of them would
   stay empty.  So a huge group doesn't make the other shards uneven.

The search needs few of all boundaries.  The driver holds sums of digest
ranges (4,096 ranges by three hex digits at first), and looks up as if
ranges were groups; ranges that a look-up fell into are split by one
aggregate over the table, and the search runs again, until it touches
boundaries of single groups only.  Its answer is then that of the whole
table.  What the driver holds grows with the number of splits, not with the
table; no group, however large, is more than one number.

Numbers within a shard come from one range shuffle of (digest, id) and the
row's place in its sorted partition; a group or an id that holds a third of all
rows spans several partitions.

Defined cases: a null text has no bytes, no checksum, and forms a group with
the other null texts, apart from empty texts; with fewer groups than shards the
shards at the end stay empty; rows of one id and text are interchangeable and
each get a number; null ids come first within their group; an empty table
gives an empty one; columns other than the key are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import small, written

ROW_BYTES = 16      # size of a row besides its text (fixed by the format of shards)
DIGITS = 3          # hex digits of the first ranges
CHILDREN = 1 << 16  # ranges that one split may make, as far as one digit allows


class Bounds:
    """Sorted boundaries of digest ranges, and the ranges that look-ups fell into."""

    def __init__(self, ranges: dict[str, tuple[int, bool]]):
        """``ranges``: digits -> (size, whether it is a single group)."""
        self.name = sorted(ranges)
        self.end = list(accumulate(ranges[n][0] for n in self.name))
        self.single = [ranges[n][1] for n in self.name]
        self.total = self.end[-1] if self.end else 0
        self.by_size = sorted(range(len(self.name)), key=lambda i: -ranges[self.name[i]][0])
        self.largest = ranges[self.name[self.by_size[0]]][0] if ranges else 0
        self.touched: set[str] = set()

    def start(self, i: int) -> int:
        return self.end[i - 1] if i else 0

    def touch(self, i: int) -> None:
        if not self.single[i]:
            self.touched.add(self.name[i])

    def down(self, x: int) -> int:
        """The last boundary up to x (0 at least)."""
        if x >= self.total:
            return self.total
        i = bisect_right(self.end, x)  # the range that x lies in
        if x > self.start(i):
            self.touch(i)
        return self.start(i)

    def up(self, x: int) -> int:
        """The first boundary from x on."""
        if x <= 0:
            return 0
        i = bisect_left(self.end, x)
        if x < self.end[i]:
            self.touch(i)
        return self.end[i]

    def near(self, x: int) -> int:
        """The boundary next to x; of two, the lower one."""
        low, high = self.down(x), self.up(x)
        return low if x - low <= high - x else high


def feasible(b: Bounds, capacity: int, shards: int) -> bool:
    """Whether greedy filling takes everything."""
    at = 0
    for _ in range(shards):
        at = b.down(at + capacity)
    return at >= b.total


def smallest_capacity(b: Bounds, shards: int) -> int:
    low, high = -(-b.total // shards), -(-b.total // shards) + b.largest
    while low < high:
        middle = (low + high) // 2
        if feasible(b, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def share(b: Bounds, at: int, shards: int) -> int:
    """What each of the ``shards`` after ``at`` gets, if groups larger than that stand alone."""
    rest = b.total - at
    for i in b.by_size:
        if shards == 1 or (b.end[i] - b.start(i)) * shards <= rest:
            break
        if b.start(i) >= at:
            b.touch(i)
            rest, shards = rest - (b.end[i] - b.start(i)), shards - 1
    return -(-rest // shards)


def cuts(b: Bounds, capacity: int, shards: int) -> list[int]:
    """Ends of all shards but the last; see the module text."""
    # of the start of a rest of so many shards: the earliest that fits, the last that leaves a group for each
    first, last = [b.total], [b.total]
    for _ in range(shards - 1):
        first.append(b.up(max(first[-1] - capacity, 0)))
        last.append(b.down(max(last[-1] - 1, 0)))
    out, at = [], 0
    for rest in range(shards - 1, 0, -1):
        one = b.up(min(at + 1, b.total))
        wish = max(b.near(at + share(b, at, rest + 1)), first[rest], one)
        at = min(wish, b.down(at + capacity), max(last[rest], one))
        out.append(at)
    return out


def _digits(n: Column | int) -> Column:
    return F.substring(F.col("digest"), 1, n)


def _sums(rows: DataFrame, name: Column) -> dict[str, tuple[int, bool]]:
    """Range -> (size, single group) of the rows that have a range name."""
    # two digests of a range with one 64-bit hash would stay together: a less even cut, no wrong one
    h = F.xxhash64("digest")
    found = (rows.select(name.alias("name"), "size", h.alias("h")).where("name is not null").groupBy("name")
             .agg(F.sum("size").alias("size"), (F.min("h") == F.max("h")).alias("single")))
    return {r["name"]: (r["size"], r["single"]) for r in found.collect()}


def minimax_cuts(rows: DataFrame, shards: int) -> tuple[int, list[str]]:
    """(capacity, first digits of each shard but the first) over (digest, size) rows.

    Ends that no group follows are left out.
    """
    ranges = _sums(rows, _digits(DIGITS))
    while True:
        b = Bounds(ranges)
        capacity = smallest_capacity(b, shards)
        ends = cuts(b, capacity, shards)
        if not b.touched:
            return capacity, [b.name[bisect_right(b.end, e)] for e in ends if e < b.total]
        more, width = 1, len(b.touched) * 16
        while width * 16 <= CHILDREN:
            more, width = more + 1, width * 16
        name = F.lit(None).cast("string")
        for n in sorted({len(t) for t in b.touched}):
            name = F.when(_digits(n).isin([t for t in b.touched if len(t) == n]), _digits(n + more)).otherwise(name)
        for t in b.touched:
            del ranges[t]
        ranges.update(_sums(rows, name))


def sharded(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row: ``shards`` shards whose largest is as
    small as groups of equal texts allow, and gapless numbers from 0 in each."""
    raw = F.col("text").cast("binary")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).select(
        "id", (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw).alias("crc"), F.coalesce(F.sha2(raw, 256), F.lit("")).alias("digest"))
    # the texts are read once
    rows = written(rows, "rows")
    _, starts = minimax_cuts(rows, shards)
    # an id with one text may hold many rows, so the order of reading is part of the range
    placed = (rows.withColumn("copy", F.monotonically_increasing_id())
              .repartitionByRange("digest", "id", "copy").sortWithinPartitions("digest", "id", "copy"))
    shard = F.size(F.filter(F.array(*[F.lit(s) for s in starts]).cast("array<string>"),
                            lambda s: s <= F.col("digest")))
    placed = written(placed.select("id", "size", "crc", shard.alias("shard"),
                                   F.monotonically_increasing_id().alias("place")), "placed")
    # a partition holds a stretch of each of its shards: no more stretches than partitions and shards
    part = F.shiftright("place", 33)
    stretch = placed.groupBy("shard", part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = written(stretch.select("shard", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
                                   .alias("shift")), "starts")
    numbered = placed.withColumn("part", part).join(small(start, 40), ["shard", "part"])
    return numbered.select(F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
                           (F.col("place") + F.col("shift")).alias("slot"))
