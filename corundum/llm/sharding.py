"""Sharding by a minimax contiguous partition, in DataFrame and SQL operations only.

Rows of equal texts form an atomic group; groups are ordered by the MD5 of their text. The smallest capacity with which a
greedy cut of the ordered groups needs no more than the given shards is found by binary search, then the groups are cut there.

The driver never sees all groups. It gets the sizes of pieces, runs of groups whose digests share a prefix, at first 16**PREFIX of them
at most. Two capacities hold the answer between them: the best one if no piece may be cut, and the best one if pieces of several
groups could be cut anywhere. Pieces in which a cut may lie between these two are parted by a longer prefix, until both are
the same or no such piece is left; so the partition is exact, and what is gathered depends on shards and prefixes, not on rows.

Law: `bytes`. Null and empty texts have no bytes, size 1, and are one group; rows that repeat a doc_id, and wholly equal rows, get places of
their own in the same shard; an empty table gives an empty result; columns of the documents named like a result are replaced,
others change nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corundum.llm._spark import cut

#: Hexadecimal digits of the first pieces, and how many a piece that is parted gets more.
PREFIX, MORE = 4, 2
#: Numbering blocks of a shard; shards x BLOCKS rows are broadcast.
BLOCKS = 1 << 12
ADDED = ("size", "text_crc32", "shard", "slot")


def minimax_cuts(sizes: list[int], shards: int) -> list[int]:
    """Ends (exclusive) of at most `shards` contiguous runs of sizes whose largest sum is as small as possible."""
    total = list(accumulate(sizes, initial=0))
    lo, hi = max(sizes, default=0), total[-1]
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if len(_ends(total, mid, shards)) <= shards else (mid + 1, hi)
    return _ends(total, lo, shards) if sizes else []


def _ends(total: list[int], capacity: int, shards: int) -> list[int]:
    """Where a greedy cut ends each run; it gives up behind the first run too many, or at a size above the capacity."""
    out, at = [], 0
    while at < len(total) - 1 and len(out) <= shards:
        after = bisect_right(total, total[at] + capacity) - 1
        if after == at:
            return [*out, *[at] * (shards + 1)]
        out.append(at := after)
    return out


def _loose(total: list[int], whole: list[bool], capacity: int, shards: int) -> list[int]:
    """Bytes up to which each run reaches if only the pieces marked whole must stay together."""
    out, done = [], 0
    while done < total[-1] and len(out) <= shards:
        k = bisect_right(total, done + capacity) - 1
        reach = total[-1] if k == len(total) - 1 else total[k] if whole[k] else done + capacity
        if reach <= done:
            return [*out, *[done] * (shards + 1)]
        out.append(done := reach)
    return out


def _open_pieces(sizes: list[int], whole: list[bool], shards: int) -> list[int]:
    """Numbers of the pieces of several groups in which a cut of the best partition may lie."""
    total = list(accumulate(sizes, initial=0))
    ends = minimax_cuts(sizes, shards)
    high = max(total[e] - total[b] for b, e in zip([0, *ends], ends, strict=False))
    lo, hi = max([-(-total[-1] // shards), *(s for s, w in zip(sizes, whole, strict=True) if w)]), high
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if len(_loose(total, whole, mid, shards)) <= shards else (mid + 1, hi)
    if lo >= high:
        return []
    first, last = [total[e] for e in _ends(total, lo, shards)[:shards]], _loose(total, whole, high, shards)
    first += [total[-1]] * (shards - len(first))
    last += [total[-1]] * (shards - len(last))
    found = set()
    for a, z in zip(first[: shards - 1], last, strict=False):
        for k in range(max(0, bisect_right(total, a) - 1), min(len(sizes), bisect_right(total, z))):
            if not whole[k]:
                found.add(k)
    return sorted(found)


def cut_points(groups: DataFrame, shards: int, prefix: int = PREFIX, more: int = MORE) -> list[str]:
    """From which digest on each shard but the first begins. groups: (digest, size), a row for each document."""

    def pieces(rows: DataFrame, digits: Column) -> list[tuple[str, int, bool]]:
        grouped = rows.groupBy(F.substring("digest", F.lit(1), digits).alias("at")).agg(F.sum("size").alias("size"), (F.min("digest") == F.max("digest")).alias("whole"))
        return sorted((r["at"], r["size"], r["whole"]) for r in grouped.collect())

    known = pieces(groups, F.lit(prefix))
    while known:
        parted = [known[k] for k in _open_pieces([p[1] for p in known], [p[2] for p in known], shards)]
        if not parted:
            break
        fresh = []
        for n in sorted({len(p[0]) for p in parted}):
            mine = [p[0] for p in parted if len(p[0]) == n]
            fresh += pieces(groups.where(F.substring("digest", 1, n).isin(mine)), F.lit(n + more))
        known = sorted([*(set(known) - set(parted)), *fresh])
    ends = minimax_cuts([p[1] for p in known], shards)
    return [known[e][0] for e in ends[:-1]]


def shard(docs: DataFrame, shards: int = 8, prefix: int = PREFIX, more: int = MORE, blocks: int = BLOCKS, whole_rows: bool = False) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot, gapless from 0 within the shard; whole_rows: with all its columns."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    parts = [(F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.md5(body).alias("digest")]
    rows = cut(docs.select("doc_id", *parts))
    firsts = cut_points(rows.select("digest", "size"), shards, prefix, more)
    number = sum(((F.col("digest") >= a).cast("int") for a in firsts), F.lit(0))
    block = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(blocks))
    counts = rows.groupBy(number.alias("shard"), block.alias("block")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    # At most shards x blocks rows, whatever the input.
    starts = F.broadcast(counts.select("shard", "block", F.coalesce(before, F.lit(0)).alias("start")))
    kept = [c for c in docs.columns if c not in ADDED] if whole_rows else ["doc_id"]
    if whole_rows:
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), *parts, "doc_id")
    else:
        rows = rows.withColumn("doc", F.struct("doc_id"))
    rows = rows.select("doc", "doc_id", "size", "text_crc32", "digest", number.alias("shard"), block.alias("block")).join(starts, ["shard", "block"])
    nth = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "digest"))
    return rows.select("doc.*", "size", "text_crc32", "shard", (F.col("start") + nth - 1).cast("long").alias("slot"))
