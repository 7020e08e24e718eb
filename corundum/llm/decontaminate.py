"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts and benchmark items are normalised to lower-case words with one space around each; the patterns are
all runs of WINDOW item words (a shorter item is one pattern). Patterns are searched together: a shift table over
blocks of bytes says how far a position can be skipped, a block with shift 0 selects a bucket of test
strings by the hash of their suffix block, and the bytes themselves confirm an occurrence. Many cursors
walk over one block of texts at once, so every step is one numpy operation.

The benchmark is shipped in blocks of about PATTERN_BYTES of item text, from which each Python worker builds the tables of one
block at a time. With several blocks the texts are searched for one after the other, and the marks of the texts that were
hit are written before the next block is read, so neither the driver nor a worker holds more than one.

Null, empty and wordless texts have no words and no hits; wordless or null items have no windows; repeated item_ids
count once; item ids that are null are searched but not listed; documents may repeat, each row gets its own result; extra columns
are kept, those named like a result are replaced; empty tables give empty results and no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corundum.llm._spark import cut, small
from corundum.llm._words import LOWER, pieces, runs, text_bytes

WINDOW = 10
PATTERN_BYTES = 2 << 20
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Patterns are searched by classes of these least lengths in bytes, each with its own block size.
CLASSES = ((24, 8), (8, 4), (3, 2))
CURSORS = 2048


def normalised(b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space before each and one behind the last of a text, a zero byte between texts.

    Also the places of the words' leading spaces, and how many words lie before each text."""
    word = WORD[b]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = starts[(starts > 0) & (starts < len(b))]
    first[inner] = word[inner]
    n, cuts = len(starts), np.searchsorted(at := np.flatnonzero(first), starts)
    where = np.flatnonzero(word)
    nth = np.cumsum(first)[where]  # the word a byte belongs to, from 1
    text_of = np.searchsorted(starts, where, side="right") - 1
    size = len(where) + len(at) + 2 * n
    out = np.full(size, 0x20, np.uint8)
    spot = np.arange(len(where)) + nth + 2 * text_of  # each text adds its closing space and a zero byte
    out[spot] = LOWER[b[where]]
    lead = spot[np.searchsorted(where, at)] - 1
    ends = np.append(cuts[1:], len(at))
    closing = np.searchsorted(where, np.append(starts[1:], len(b))) + ends + 2 * np.arange(n)
    out[closing + 1] = 0
    return out, lead, cuts


class Patterns:
    """The windows of a block of items, with their Wu-Manber tables."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            if not text:
                continue
            b = np.frombuffer(text.encode(), np.uint8)
            words = normalised(b, np.zeros(1, np.int64))[0].tobytes().strip(b"\0").split()
            for k in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(b" " + b" ".join(words[k : k + window]) + b" ", set()).update([] if item is None else [item])
        self.texts = sorted(owners)
        self.owners = [tuple(sorted(owners[t])) for t in self.texts]
        self.words = [t.count(b" ") - 1 for t in self.texts]
        self.tables = []
        for (least, block), most in zip(CLASSES, (1 << 60, *(c[0] for c in CLASSES)), strict=False):
            mine = [i for i, t in enumerate(self.texts) if least <= len(t) < most]
            if not mine:
                continue
            m = min(len(self.texts[i]) for i in mine)
            bits = min(22, max(16, (len(mine) * (m - block + 1)).bit_length() + 3))
            shift = np.full(1 << bits, m - block + 1, np.int64)
            suffix = np.empty(len(mine), np.uint64)
            heads = np.array([np.frombuffer(self.texts[i][:m], np.uint8) for i in mine])
            for j in range(m - block + 1):
                key = _blocks(heads[:, j : j + block], block)
                np.minimum.at(shift, _slot(key, bits), m - block - j)
                suffix = key
            order = np.argsort(suffix, kind="stable")
            self.tables.append((block, m, bits, shift, suffix[order], np.array(mine)[order]))

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start byte and number of every pattern that occurs in the normalised text."""
        at, which = [], []
        for block, m, bits, shift, suffix, ids in self.tables:
            ends = _candidates(text, block, m, bits, shift)
            if not len(ends):
                continue
            keys = _Blocks(text, block)[ends]
            lo, hi = np.searchsorted(suffix, keys, "left"), np.searchsorted(suffix, keys, "right")
            for p, a, z in zip((ends + block - m)[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                for i in ids[a:z].tolist():
                    t = self.texts[i]
                    if text[p : p + len(t)].tobytes() == t:
                        at.append(p)
                        which.append(i)
        return np.array(at, np.int64), np.array(which, np.int64)


class _Blocks:
    """The block that starts at each byte, as a number."""

    def __init__(self, text: np.ndarray, block: int):
        self.view = np.ndarray((max(0, len(text) - block + 1),), f"<u{block}", np.ascontiguousarray(text), strides=(1,))

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.view[at].astype(np.uint64)


def _blocks(heads: np.ndarray, block: int) -> np.ndarray:
    return np.ascontiguousarray(heads).view(f"<u{block}").ravel().astype(np.uint64)


def _slot(key: np.ndarray, bits: int) -> np.ndarray:
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _candidates(text: np.ndarray, block: int, m: int, bits: int, shift: np.ndarray) -> np.ndarray:
    """Places of blocks with shift 0, found by cursors that each walk over a stretch of the text."""
    last = len(text) - block
    if last < m - block:
        return np.zeros(0, np.int64)
    stretch = max(4 * m, -(-(last + 1) // CURSORS))
    pos = np.arange(m - block, last + 1, stretch)
    end = np.minimum(pos + stretch, last + 1)
    view, hits = _Blocks(text, block), []
    while len(pos):
        step = shift[_slot(view[pos], bits)]
        if not step.all():
            hits.append(pos[step == 0])
        pos = pos + np.maximum(step, 1)
        alive = pos < end
        if not alive.all():
            pos, end = pos[alive], end[alive]
    return np.sort(np.concatenate(hits)) if hits else np.zeros(0, np.int64)


def marked(column: pa.Array, patterns: Patterns) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    """For each text: its words, the disjoint ranges of words inside an occurrence, and the items that occur."""
    b, at = text_bytes(column)
    longest = max(patterns.words, default=1)
    for lo, hi in runs(at):
        part, starts = b[at[lo] : at[hi]], at[lo:hi] - at[lo]
        if hi - lo > 1 or len(part) <= 4 << 20:
            yield from _search(part, starts, patterns)
            continue
        # One very long text: pieces that overlap by a window less a word, so that every occurrence lies in one.
        seen, spans, items = 0, [], set()
        for x, y in pieces(part, WORD):
            z = y
            if y < len(part):
                more, reach = np.zeros(0, np.int64), 1 << 14
                while len(more) < longest and z < len(part):
                    z = min(len(part), y + reach)
                    more = np.flatnonzero(WORD[part[y + 1 : z]] & ~WORD[part[y : z - 1]])
                    reach *= 2
                if len(more) >= longest:
                    z = y + 1 + int(more[longest - 1])
            (n, got, found), = _search(part[x:z], np.zeros(1, np.int64), patterns)
            spans += [(s + seen, e + seen) for s, e in got]
            items |= found
            seen += n if z == y else int(np.count_nonzero(np.diff(WORD[part[x:y]].astype(np.int8), prepend=0) == 1))
        yield seen, union(spans), items


def _search(part: np.ndarray, starts: np.ndarray, patterns: Patterns) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    if not len(part):
        yield from ((0, [], set()) for _ in starts)
        return
    text, lead, cuts = normalised(part, starts)
    at, which = patterns.find(text) if patterns.texts else (np.zeros(0, np.int64),) * 2
    first = np.searchsorted(lead, at)
    doc = np.searchsorted(cuts, first, side="right") - 1
    count = np.diff(np.append(cuts, len(lead)))
    order = np.lexsort((first, doc))
    edge = np.searchsorted(doc[order], np.arange(len(starts) + 1))
    for k in range(len(starts)):
        mine = order[edge[k] : edge[k + 1]]
        if not len(mine):
            yield int(count[k]), [], set()
        else:
            s = (first[mine] - cuts[k]).tolist()
            yield int(count[k]), union([(a, a + patterns.words[i]) for a, i in zip(s, which[mine].tolist(), strict=True)]), {o for i in set(which[mine].tolist()) for o in patterns.owners[i]}


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


KIND = "struct<n_words:bigint,spans:array<struct<first:bigint,end:bigint>>,items:array<string>>"


@lru_cache(1)
def _patterns(items: tuple[tuple[str | None, str | None], ...], window: int) -> Patterns:
    return Patterns(list(items), window)


def searcher(block: list[tuple[str | None, str | None]], window: int):
    span, shipped = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])), tuple(block)

    @F.arrow_udf(KIND)
    def search(text: pa.Array) -> pa.Array:
        n, spans, items = [], [], []
        for count, got, found in marked(text, _patterns(shipped, window)):
            n.append(count)
            spans.append([{"first": s, "end": e} for s, e in got])
            items.append(sorted(found))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))], ["n_words", "spans", "items"])

    return search


def item_blocks(benchmark: DataFrame, most: int = PATTERN_BYTES) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in lists of about `most` bytes of text; never more than one list is held."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + 2 * total // most if total > most else 1
    for k in range(n):
        yield [tuple(r) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).distinct().collect()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", most: int = PATTERN_BYTES) -> DataFrame:
    """The documents with n_words, hits (disjoint ranges of words inside occurrences), n_hit and items (ids, sorted)."""
    kept = [c for c in docs.columns if c not in ("n_words", "hits", "n_hit", "items")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.col(text).alias("text"))
    digest, earlier, blocks = F.md5(F.coalesce("text", F.lit(""))), None, item_blocks(benchmark, most)
    block = next(blocks)
    for after in blocks:
        found = rows.select(digest.alias("digest"), searcher(block, window)("text").alias("f")).where("size(f.spans) > 0")
        marks = cut(found.groupBy("digest").agg(F.first("f.spans").alias("spans"), F.first("f.items").alias("items")))
        earlier, block = marks if earlier is None else earlier.unionByName(marks), after
    rows = rows.withColumn("f", searcher(block, window)("text"))
    spans, items = F.col("f.spans"), F.col("f.items")
    if earlier is not None:
        merged = cut(earlier.groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("more_spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("more_items")))
        rows = rows.withColumn("digest", digest).join(small(merged), "digest", "left")
        spans = F.when(F.col("more_spans").isNull(), spans).otherwise(F.array_sort(F.concat(spans, "more_spans")))
        items = F.when(F.col("more_items").isNull(), items).otherwise(F.array_union(items, F.col("more_items")))
    # Ranges of several blocks may overlap; a fold over the sorted ranges joins those that do, so each word counts once.
    span = "array<struct<first:bigint,end:bigint>>"

    def joined(out, s):
        last = F.element_at(out, -1)
        over = (F.size(out) > 0) & (s["first"] <= F.when(F.size(out) > 0, last["end"]).otherwise(F.lit(-1).cast("long")))
        whole = F.array(F.struct(last["first"].alias("first"), F.greatest(last["end"], s["end"]).alias("end")))
        return F.when(over, F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))), whole)).otherwise(F.concat(out, F.array(s))).cast(span)

    if earlier is not None:
        spans = F.when(F.size(spans) < 2, spans).otherwise(F.aggregate(spans, F.array().cast(span), joined))
    rows = rows.select("doc", F.col("f.n_words").alias("n_words"), spans.alias("hits"), F.array_sort(items).alias("items"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return rows.select("doc.*", "n_words", "hits", n_hit.alias("n_hit"), "items")
