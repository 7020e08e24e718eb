"""Near-duplicate documents by circulant MinHash.

One permutation places every shingle, a second one, shifted circularly by k, gives
coordinate k of the signature; so a text's signature is the minimum over slices of
one table. Bands of the signature propose pairs, the full shingle sets decide.

With ROWS = 8 and BANDS = 72 a pair of similarity 0.8 shares a band with probability
1 - (1 - 0.8**8)**72 = 0.999998, one of similarity 0.4 with 0.05.

Edge cases: null, empty and blank texts have no shingles, link with nothing and are
their own component; every row is a document of its own, so rows that repeat a doc_id with
different texts may be in different components, those with equal texts are in the same; a null id is
never the smallest, and is a component's id only where all its ids are null; texts
shorter than a shingle are one shingle; extra columns, also of clashing names, are ignored
by ``near_duplicates`` (only the named id and text columns are read); an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.llm._spark import components, counted, cut, small
from corundum.llm._words import hashed_blocks, shingle_sets

BANDS, ROWS = 72, 8
#: Places of the first permutation; shingles beyond so many in one text share places, which only adds candidates.
PLACES = 1 << 20


@lru_cache(2)
def _circle(coordinates: int) -> np.ndarray:
    """Row p: what the shifted second permutations give for place p."""
    order = np.random.default_rng(97).permutation(PLACES).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[: coordinates - 1]]), coordinates)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Circulant MinHash of sets of 64-bit shingle hashes, a row for each, none of which is empty."""
    circle, place = _circle(coordinates), (np.concatenate(sets) >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)
    low = np.full((len(sets), coordinates), np.iinfo(np.uint32).max, np.uint32)
    ends, step = np.cumsum([len(x) for x in sets]), max(128, (1 << 17) // coordinates)
    row = at = 0
    while at < len(place):
        upto = min(at + step, len(place))
        slices = circle[place[at:upto]]
        lo = at
        while lo < upto:
            hi = min(int(ends[row]), upto)
            np.minimum(low[row], slices[lo - at : hi - at].min(0), out=low[row])
            row += hi == ends[row]
            lo = hi
        at = upto
    return low


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The signature of one set."""
    return signatures([shingles], coordinates)[0]


def band_keys(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature (a row of `low`)."""
    x = low.reshape(len(low), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), (len(low), bands)).copy()
    for r in range(rows):
        key = (key ^ x[:, :, r]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def sketcher(width: int, bands: int, rows: int):
    @F.arrow_udf("struct<digest:binary,n_shingles:bigint,bands:array<bigint>>")
    def sketch(text: pa.Array) -> pa.Array:
        digests, counts, low, has = [], [], [], []
        for h, cuts in hashed_blocks(text):
            sets = shingle_sets(h, cuts, width)
            digests += [hashlib.md5(h[lo:hi].tobytes()).digest() for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
            counts += [len(x) for x in sets]
            has += [bool(len(x)) for x in sets]
            if some := [x for x in sets if len(x)]:
                low.append(band_keys(signatures(some, bands * rows), bands, rows).ravel())
        keys = np.concatenate(low) if low else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(np.array(has, np.int64) * bands)]).astype(np.int32)
        return pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))], ["digest", "n_shingles", "bands"])

    return sketch


def shingle_rows(width: int):
    @F.arrow_udf("array<bigint>")
    def split(text: pa.Array) -> pa.Array:
        sets = [x.view(np.int64) for h, cuts in hashed_blocks(text) for x in shingle_sets(h, cuts, width)]
        ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))

    return split


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the asked similarity."""
    left, right = (sets.select(F.col("node").alias(k), F.col("sh").alias(f"sh_{k}")) for k in "ab")
    same = F.size(F.array_intersect("sh_a", "sh_b"))
    return pairs.join(left, "a").join(right, "b").where(100 * same >= percent * (F.size("sh_a") + F.size("sh_b") - same)).select("a", "b")


def contracted(found: DataFrame, links: DataFrame | None) -> DataFrame | None:
    """(node, root) after the links found, on top of the earlier ones."""
    found, (n, _) = counted(found)
    if not n:
        return links
    return cut(components(found if links is None else found.union(links.select(F.col("node").alias("a"), F.col("root").alias("b")))))


def rooted(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    """The rows with the root of their node, itself where it has no links."""
    rows = rows.drop("root")
    if links is None:
        return rows.withColumn("root", F.col("node"))
    return rows.join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))


def still_open(rows: DataFrame, group: str) -> DataFrame:
    """Rows of the groups that hold more than one component."""
    shared = rows.groupBy(group).agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select(group)
    return rows.join(shared, group, "left_semi")


def least_overlap(n: Column | str, m: Column | str, percent: int) -> Column:
    """The smallest intersection with which sets of n and m shingles are similar enough."""
    return F.ceil(percent * (F.col(n) if isinstance(n, str) else n).cast("long") / F.lit(100 + percent) + percent * (F.col(m) if isinstance(m, str) else m) / F.lit(100 + percent) - 1e-9)


def pivot_pairs(rows: DataFrame, group: str, fits: Column) -> DataFrame:
    """Each group's pivot, the node that meets most others, with the members of other components that fit it."""
    p = rows.groupBy(group).agg(F.max(F.struct("met", "node", "n", "root", "at")).alias("p"))
    pairs = rows.join(p, group).where((F.col("root") != F.col("p.root")) & fits)
    return pairs.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()


def prefixes(sets: DataFrame, open_nodes: DataFrame, percent: int) -> DataFrame:
    """(h, at, node, n, met, root): the rarest shingles of each open node, as far as a link needs.

    Shingles stand in the order of their frequency among the open nodes. Two sets with the asked similarity have a
    shingle in common at a place `at` of either that leaves enough shingles behind it for their intersection, so nodes that
    share none of these are no link."""
    tokens = sets.join(open_nodes.select("node"), "node").select("node", F.explode("sh").alias("h"))
    often = tokens.groupBy("h").agg(F.count("*").alias("f")).where("f > 1")
    ranked = tokens.join(often, "h").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("f", "h"))).alias("t")).join(open_nodes, "node")
    own = F.col("n") - F.size("t")  # shingles that no other open node has stand first
    need = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    first = F.when(own < need, F.slice("t", F.lit(1), (need - own).cast("int"))).otherwise(F.array().cast("array<struct<f:bigint,h:bigint>>"))
    return ranked.select("node", "n", "met", "root", own.alias("own"), F.posexplode(first).alias("k", "x")).select("x.h", (F.col("own") + F.col("k")).cast("long").alias("at"), "node", "n", "met", "root")


def pruned(entries: DataFrame, percent: int) -> DataFrame:
    """Without entries that stand too far back for a link with even the smallest set of another component they meet."""
    groups = entries.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("small")).where("lo < hi").select("h", "small")
    partner = F.greatest(F.col("small"), F.ceil(percent * F.col("n") / 100))
    return entries.join(groups, "h").where(F.col("at") <= F.col("n") - least_overlap("n", partner, percent)).drop("small")


def linked(nodes: DataFrame, sets_of, percent: int) -> DataFrame | None:
    """(node, root) of all nodes that have links, from nodes (node, n, bands); None if there are none.

    sets_of gets a table with the nodes that share a bucket and returns (node, sh), their distinct shingles. In every bucket
    the node that meets most others is compared with all members of a like size, and the links found are contracted. Nodes
    of buckets that still hold several components are then joined by their rarest shingles (prefix filter), again first
    with one pivot for each shingle and then, if several components are left, with each other. So every
    pair that shares a bucket is in one component, was compared, or cannot reach the similarity. Nothing is capped."""
    # The widest table, a row for each band of each node, knows nodes by 64 bits; two nodes of one key only become candidates together.
    buckets = nodes.select(F.xxhash64("node").alias("k"), F.explode("bands").alias("bucket"))
    met = buckets.groupBy("bucket").agg(F.count("*").alias("met")).where("met > 1")
    shared, (n, _) = counted(buckets.join(met, "bucket"))
    if not n:
        return None
    keys = shared.groupBy("k").agg(F.sum("met").alias("met"))
    who = cut(nodes.select("node", F.col("n").cast("long").alias("n"), F.xxhash64("node").alias("k")).join(keys, "k"))
    sets = cut(sets_of(who))
    active = cut(shared.drop("met").join(who, "k").select("bucket", "node", "n", "met", F.col("node").alias("root"), F.lit(0).cast("long").alias("at")))
    alike = 100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n")
    links = contracted(compared(pivot_pairs(active, "bucket", alike), sets, percent), None)
    open_nodes, (n, _) = counted(still_open(rooted(active, links), "bucket").select("node", "n", "met", "root").distinct())
    if not n:
        return links
    entries, (n, _) = counted(pruned(cut(pruned(cut(prefixes(sets, open_nodes, percent)), percent)), percent))
    close = alike & (F.col("at") <= F.col("n") - least_overlap("n", "p.n", percent)) & (F.col("p.at") <= F.col("p.n") - least_overlap("n", "p.n", percent))
    for _ in range(2):
        if not n:
            return links
        links = contracted(compared(pivot_pairs(entries, "h", close), sets, percent), links)
        entries, (n, _) = counted(pruned(rooted(entries, links), percent))
    if not n:
        return links
    other = entries.select("h", F.struct("node", "n", "root", "at").alias("p"))
    rest = entries.join(other, "h").where((F.col("node") < F.col("p.node")) & (F.col("root") != F.col("p.root")) & close)
    return contracted(compared(rest.select(F.col("node").alias("a"), F.col("p.node").alias("b")).distinct(), sets, percent), links)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the id, raw (md5 of the text), n_shingles and component_id, the smallest id reachable over links.

    Texts of equal word sequences are one class, known by its digest, and go on as one node; the classes that share a bucket are
    linked by ``linked``. A component's id is the smallest id of all rows of its classes."""
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    raw = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    sketch = cut(docs.select("id", raw.alias("raw"), sketcher(width, bands, rows)("text").alias("s")).select("id", "raw", "s.digest", "s.n_shingles", "s.bands"))
    some = sketch.where("n_shingles > 0")
    nodes = some.groupBy("digest").agg(F.max("n_shingles").alias("n"), F.first("bands").alias("bands")).withColumnRenamed("digest", "node")
    ids = some.groupBy("digest").agg(F.min("id").alias("rep"), F.min(F.struct("id", "raw")).alias("row"))

    def sets_of(who: DataFrame) -> DataFrame:
        wanted = cut(ids.join(who.select(F.col("node").alias("digest")), "digest").select(F.col("digest").alias("node"), F.col("row.id").alias("_id"), F.col("row.raw").alias("_raw")))
        found = docs.withColumn("raw", raw).join(small(wanted), (F.col("raw") == F.col("_raw")) & F.col("id").eqNullSafe(F.col("_id")))
        return found.groupBy("node").agg(F.first("text").alias("text")).select("node", shingle_rows(width)("text").alias("sh"))

    links = linked(nodes, sets_of, percent)
    classes = ids.select("digest", "rep")
    if links is not None:
        grouped = cut(classes.join(links.withColumnRenamed("node", "digest"), "digest").select("digest", "root", "rep"))
        least = grouped.groupBy("root").agg(F.min("rep").alias("least"))
        classes = classes.join(grouped.join(least, "root").select("digest", "least"), "digest", "left").select("digest", F.coalesce("least", "rep").alias("rep"))
    return sketch.join(classes, "digest", "left").select(F.col("id").alias(key), "raw", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("id")).alias("component_id"))
