"""Sharding by minimax contiguous partition: groups of equal texts, in hash order, are
cut into shards so that the largest shard is as small as it can be.

The smallest feasible capacity is found by binary search with a greedy check.  The check
needs prefix sums only where cuts may fall, so sizes are summed by ranges of the hash:
65,536 ranges first, then finer ones around the cuts, until every cut is exact.  The
driver holds range sums, never groups, and a shard's slots come from a range sort.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, with_defaults

SHARDS = 24
#: Bits of the hash that the first and each later pass tells apart.
FIRST_BITS, MORE_BITS = 16, 8
#: Partitions of the sort that numbers slots: about one for so many rows.
ROWS_PER_PART = 2_000_000


@dataclass
class Range:
    """Groups whose hash begins with ``prefix`` (of ``bits`` bits): their bytes."""

    prefix: int
    bits: int
    size: int
    low: int  # smallest and largest hash (unsigned); equal for a single group
    high: int

    @property
    def single(self) -> bool:
        return self.low == self.high


class Sums:
    """Running sums over ranges in hash order, and greedy fills over them."""

    def __init__(self, ranges: list[Range], shards: int):
        self.ranges, self.shards = ranges, shards
        self.at = [0, *accumulate(r.size for r in ranges)]

    @property
    def total(self) -> int:
        return self.at[-1]

    def next_cut(self, begin: int, capacity: int, hopeful: bool) -> int:
        """Where a shard that begins at a running sum ends, at most ``capacity`` later.

        A range of several groups may be cut inside at an unknown place: hopefully just
        where the shard is full, warily only before the range.
        """
        full = begin + capacity
        if full >= self.total:
            return self.total
        k = bisect_right(self.at, full) - 1
        return full if hopeful and not self.ranges[k].single else self.at[k]

    def feasible(self, capacity: int, hopeful: bool) -> bool:
        at = 0
        for _ in range(self.shards):
            end = self.next_cut(at, capacity, hopeful)
            if end >= self.total:
                return True
            if end <= at:
                return False
            at = end
        return False

    def smallest(self, low: int, hopeful: bool) -> int:
        """The smallest feasible capacity from ``low`` on, by binary search."""
        high = self.total
        while low < high:
            mid = (low + high) // 2
            if self.feasible(mid, hopeful):
                high = mid
            else:
                low = mid + 1
        return low

    def unsure(self, low: int, high: int) -> list[int]:
        """Ranges of several groups in which a cut of the best partition may lie: each cut
        is no earlier than a wary fill of ``low`` and no later than a hopeful one of ``high``."""
        least = most = 0
        found: set[int] = set()
        for _ in range(self.shards - 1):
            least = max(least, self.next_cut(least, low, False))
            most = max(most, self.next_cut(most, high, True))
            if least >= self.total:
                break
            a, b = bisect_right(self.at, least) - 1, bisect_right(self.at, most) - 1
            found.update(k for k in range(a, min(b, len(self.ranges) - 1) + 1) if not self.ranges[k].single)
        return sorted(found)

    def cuts(self, capacity: int) -> list[int]:
        """First hash of each shard after the first, for exact ranges."""
        at, out = 0, []
        while (at := self.next_cut(at, capacity, False)) < self.total:
            out.append(self.ranges[bisect_right(self.at, at) - 1].low)
        return out


def minimax(refine, ranges: list[Range], shards: int) -> tuple[int, list[int]]:
    """(capacity, first hash of each shard after the first), exactly.

    ``refine(ranges)`` gives the parts of some ranges.
    """
    while True:
        sums = Sums(ranges, shards)
        low = sums.smallest(max(1, -(-sums.total // shards)), True)
        high = sums.smallest(low, False)
        open_ = set(sums.unsure(low, high))
        if not open_:
            return high, sums.cuts(high)
        kept = [r for k, r in enumerate(ranges) if k not in open_]
        ranges = sorted(kept + refine([ranges[k] for k in sorted(open_)]), key=lambda r: r.low)


def summed(sized: DataFrame, bits: int, within: list[Range] | None = None) -> list[Range]:
    """Bytes by the first ``bits`` bits of the hash, of all rows or within some ranges."""
    if within is not None:
        coarse = within[0].bits
        wanted = sized.sparkSession.createDataFrame([(r.prefix,) for r in within], "at long")
        sized = sized.withColumn("at", F.shiftrightunsigned("h", 64 - coarse)).join(F.broadcast(wanted), "at", "left_semi")
    # the hash with its top bit turned orders as unsigned
    flipped = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))
    rows = sized.groupBy((F.shiftrightunsigned("h", 64 - bits) if bits < 64 else F.col("h")).alias("prefix")).agg(F.sum("size").alias("size"), F.min(flipped).alias("low"), F.max(flipped).alias("high"))
    word, top = (1 << 64) - 1, 1 << 63
    return sorted((Range(r[0] & word, bits, int(r[1]), r[2] + top, r[3] + top) for r in rows.collect()), key=lambda r: r.prefix)


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` of every row of ``docs(doc_id, text)``.

    Size is the UTF-8 bytes of the text plus 8; null counts as empty.  Rows of equal text
    are one atomic group and share a shard (so do texts of equal 64-bit hash).  Shards
    are runs of groups in hash order with the smallest possible largest shard; ``slot``
    numbers a shard's rows without gaps from 0, by doc_id.  Fewer groups than shards
    leave the last shards empty; an empty table gives none.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = with_defaults(docs, doc_id="long", text="string").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")
    )
    narrow = cut(narrow, "sized")  # the texts are read once
    first = summed(narrow, FIRST_BITS)
    cuts = minimax(lambda rs: _refine(narrow, rs), first, shards)[1] if first else []
    flipped = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))
    shard = sum((F.when(flipped >= F.lit(c - (1 << 63)), 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    n = narrow.count()
    parts = max(1, min(20_000, max(int(narrow.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS_PER_PART))))
    ordered = narrow.withColumn("shard", shard).repartitionByRange(parts, "shard", "doc_id").sortWithinPartitions("shard", "doc_id")
    # the number holds the partition and the row's place in it; written, so it is the same for every use
    placed = cut(ordered.select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("place")), "placed")
    part = F.shiftrightunsigned("place", 33)
    runs = placed.groupBy(part.alias("part"), "shard").agg(F.min("place").alias("start"), F.count("*").alias("n")).collect()  # partitions + shards at most
    before: dict[int, int] = {}
    offsets = []
    for p, s, start, rows in sorted(map(tuple, runs)):
        offsets.append((p, s, start - before.get(s, 0)))
        before[s] = before.get(s, 0) + rows
    base = narrow.sparkSession.createDataFrame(offsets, "part long, shard int, base long")
    found = placed.withColumn("part", part).join(F.broadcast(base), ["part", "shard"])
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("base")).alias("slot"))


def _refine(narrow: DataFrame, ranges: list[Range]) -> list[Range]:
    """The parts of ranges of any widths, one job for each width (at most seven)."""
    out = []
    for bits in sorted({r.bits for r in ranges}):
        out += summed(narrow, min(64, bits + MORE_BITS), [r for r in ranges if r.bits == bits])
    return out


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    placed = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
