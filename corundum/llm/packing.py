"""Packing of documents into as few sequences as possible, by best fit and a swap-based local search.

A document's tokens and an end mark are cut into pieces of a sequence's length; only longer documents are cut. Pieces are dealt
evenly into blocks of about BLOCK_BINS sequences, each packed in one call: best fit on falling lengths gives the first bins, then
documents are moved from one underfull bin into another, or exchanged one for one or two for one, whenever that raises the sum of squared fills.
So full bins get fuller and others run empty. The emptiest OPEN bins of each block go on, whole, into a sixteenth as many blocks, where
they are searched again together with those of other blocks, until one block is left.

Blocks hold a bounded number of tokens whatever the table holds, as pieces are dealt by the hash of a row number, not of their content.

Null and empty texts are the end mark alone; very long texts are cut into pieces, tokenised slice by slice; rows of equal lengths are
interchangeable; rows that repeat a doc_id, or are equal in all columns, are packed each for itself; a null doc_id stays null; an empty
table gives an empty result; only the named id and text columns are read, so that other columns change nothing.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from corundum.llm._spark import cut

CAPACITY = 4096
#: The mark behind every document.
END_ID = 1
#: Sequences' worth of tokens in a block.
BLOCK_BINS = 256
#: Bins of a block that go on to the next round.
OPEN = 16
#: Sweeps over a block's open bins that may pass without emptying one.
PATIENCE = 3
#: Characters that are tokenised at a time, words that a worker keeps, and letters of the longest of them.
SLICE, WORDS, LONGEST = 1 << 23, 1_000_000, 40
#: Words that are one group of their own and that lower case and composition leave as they are.
LETTERS = re.compile("[a-zß-öø-ÿ]+")


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of texts, for a vocabulary that lowers letters, drops white space and never joins words, or words and the marks behind them.

    Texts are taken apart at blanks, line ends and between a letter and a mark; each word that isn't known yet is encoded once."""

    def __init__(self, path: str):
        self.tokenizer, self.known = Tokenizer.from_file(path), {"": b""}
        (self.mark,) = self.tokenizer.encode("~", add_special_tokens=False).ids
        # The same vocabulary without the steps that change nothing in words of small letters.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for w, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if w.endswith("</w>")]] = True

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encodes many words in one text, those of letters alone by their last tokens, the rest parted by a mark that none of them has."""
        letters = [w for w in words if LETTERS.fullmatch(w)]
        plain = [w for w in set(words).difference(letters) if "~" not in w]
        for some, tokenizer, between in ((letters, self.letters, " "), (plain, self.tokenizer, " ~ ")):
            for k in range(0, len(some), 1000):
                block = some[k : k + 1000]
                ids = np.array(tokenizer.encode_batch_fast([between.join(block)], add_special_tokens=False)[0].ids, "<u4")
                if between == " ":
                    ends = np.flatnonzero(self.last[ids]) + 1
                    begins = np.concatenate([[0], ends[:-1]])
                else:
                    marks = np.flatnonzero(ids == self.mark)
                    begins, ends = np.concatenate([[0], marks + 1]), np.concatenate([marks, [len(ids)]])
                raw = ids.tobytes()
                for word, a, b in zip(block, (4 * begins).tolist(), (4 * ends).tolist(), strict=True):
                    self.known[word] = raw[a:b]
        other = [w for w in words if "~" in w]
        self.known.update(zip(other, self._plain(other), strict=True))

    def _slice(self, texts: list[str]) -> list[bytes]:
        t = pc.replace_substring(pc.ascii_lower(pa.array(texts, pa.string())), "\n", " ")
        words = pc.split_pattern(pc.replace_substring_regex(t, "([a-zß-öø-ÿ])([.,;:!?*]+)", r"\1 \2"), " ")
        coded = words.flatten().dictionary_encode()
        unique = coded.dictionary.to_pylist()
        self._learn([w for w in unique if w not in self.known])
        found = [self.known[w] for w in unique]
        for w in unique:
            if len(w) > LONGEST:
                del self.known[w]
        ids, size = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        first, which = np.cumsum(size) - size, coded.indices.to_numpy()
        many = size[which]
        ends = np.concatenate([[0], np.cumsum(many)])
        all_ids = ids[np.repeat(first[which] - ends[:-1], many) + np.arange(ends[-1])]
        at = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return [all_ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text. Texts in which special tokens may be spelled out are encoded as they are."""
        out = [b""] * len(texts)
        odd = [k for k, t in enumerate(texts) if "<|" in t]
        for k, raw in zip(odd, self._plain([texts[k] for k in odd]), strict=True):
            out[k] = raw
        for n, slices in _slices(["" if "<|" in t else t for t in texts]):
            if len(self.known) > WORDS:
                self.known = {"": b""}
            for k, raw in zip(n, self._slice(slices), strict=True):
                out[k] += raw
        return out


def _slices(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers and slices of texts, about SLICE characters at a time; texts are cut at blanks only."""
    n, some, size = [], [], 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text) if len(text) - at <= SLICE else text.find(" ", at + SLICE)
            end = len(text) if end < 0 else end
            n.append(k)
            some.append(text[at:end])
            size += end - at
            at = end
            if size >= SLICE:
                yield n, some
                n, some, size = [], [], 0
    if some:
        yield n, some


_WORKERS: dict[str, WordIds] = {}


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document."""
    path = path or vocabulary()
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType())])
    schema = schema.add("start", "long").add("length", "long").add("ids_crc32", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _WORKERS:
            _WORKERS[path] = WordIds(path)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                some = b.slice(at, 1000)
                row, parts = [], []
                for k, raw in enumerate(_WORKERS[path].encode([t or "" for t in some.column(1).to_pylist()])):
                    raw += end
                    for p, start in enumerate(range(0, len(raw), 4 * capacity)):
                        one = raw[start : start + 4 * capacity]
                        row.append(k)
                        parts.append((p, start // 4, len(one) // 4, zlib.crc32(one)))
                ids = some.column(0).take(pa.array(row, pa.int64()))
                rest = [pa.array(c, kind) for c, kind in zip(zip(*parts, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[Counter]:
    """Bins, as counts of lengths: each length, largest first, goes where the least room is left beside it."""
    bins, open_bins, mask = [], defaultdict(list), 0
    for n in sorted(lengths, reverse=True):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            k = open_bins[room].pop()
            if not open_bins[room]:
                mask ^= 1 << room
        else:
            room, k = capacity, len(bins)
            bins.append(Counter())
        bins[k][n] += 1
        if room > n:
            open_bins[room - n].append(k)
            mask |= 1 << (room - n)
    return bins


class Search:
    """Local search on bins that are not full; every step raises the sum of squared fills, so it ends."""

    def __init__(self, bins: list[Counter], capacity: int = CAPACITY):
        self.bins, self.capacity = bins, capacity
        self.fill = [sum(n * c for n, c in b.items()) for b in bins]
        self.open = {k for k, f in enumerate(self.fill) if 0 < f < capacity}
        self.used = sum(f > 0 for f in self.fill)
        self.pairs: dict[int, int] = {}
        self.having: dict[int, set[int]] = defaultdict(set)
        self.mask = 0
        for k in self.open:
            for n in bins[k]:
                self._enter(k, n)

    def _enter(self, k: int, n: int) -> None:
        self.having[n].add(k)
        self.mask |= 1 << n

    def _leave(self, k: int, n: int) -> None:
        self.having[n].discard(k)
        if not self.having[n]:
            self.mask &= ~(1 << n)

    def _change(self, k: int, less: tuple[int, ...], more: tuple[int, ...]) -> None:
        """Take and put lengths, and keep the index of open bins."""
        was, own = k in self.open, self.bins[k]
        self.pairs.pop(k, None)
        for n in less:
            own[n] -= 1
            if not own[n]:
                del own[n]
                if was:
                    self._leave(k, n)
        for n in more:
            own[n] += 1
            if was and own[n] == 1:
                self._enter(k, n)
        self.fill[k] += sum(more) - sum(less)
        if was and not 0 < self.fill[k] < self.capacity:
            self.open.discard(k)
            self.used -= not self.fill[k]
            for n in own:
                self._leave(k, n)

    def _donor(self, k: int, n: int, gain: int) -> int | None:
        """The emptiest other open bin with that length, if giving `gain` to bin k raises the sum of squares."""
        best = min((b for b in self.having[n] if b != k), key=lambda b: (self.fill[b], b), default=None)
        return best if best is not None and self.fill[k] + gain > self.fill[best] else None

    def _step(self, k: int) -> bool:
        """The exchange that fills bin k most: moves, one for one and two for one, then one for two."""
        room, own = self.capacity - self.fill[k], self.bins[k]
        outs = [(), *((n,) for n in own), *combinations(sorted(own), 2), *((n, n) for n, c in own.items() if c > 1)]
        best = None
        for out in outs:
            given = sum(out)
            below = self.mask & ((1 << (min(given + room, self.capacity) + 1)) - 1)
            while below:
                n = below.bit_length() - 1
                gain = n - given
                if gain <= (best[0] if best else 0):
                    break
                if (b := self._donor(k, n, gain)) is not None:
                    best = (gain, out, (n,), b)
                    break
                below ^= 1 << n
            if best and best[0] == room:
                break
        if best is None:
            best = self._two_for_one(k, room)
        if best is None:
            return False
        _, out, into, b = best
        self._change(b, into, out)
        self._change(k, out, into)
        return True

    def _pairs(self, k: int) -> int:
        """Sums of two lengths of a bin, as bits; kept until the bin changes."""
        if k not in self.pairs:
            own, found = self.bins[k], 0
            lengths = sum(1 << n for n in own)
            for n, c in own.items():
                found |= (lengths if c > 1 else lengths ^ (1 << n)) << n
            self.pairs[k] = found
        return self.pairs[k]

    def _two_for_one(self, k: int, room: int):
        """Two lengths of one other bin for none or one of bin k."""
        best, most, outs = None, 0, (0, *self.bins[k])
        for b in sorted(self.open - {k}, key=lambda b: (self.fill[b], b)):
            other, pairs = self.bins[b], self._pairs(b)
            for given in outs if pairs else ():
                total = (pairs & ((2 << (given + room)) - 1)).bit_length() - 1
                if total - given > max(most, self.fill[b] - self.fill[k]):
                    most = total - given
                    x = next(n for n in sorted(other) if (total - n) in other and (2 * n != total or other[n] > 1))
                    best = (most, (given,) if given else (), (x, total - x), b)
            if most == room:
                break
        return best

    def run(self, patience: int = PATIENCE) -> None:
        """Fills the fullest bins first, so that what room there is gathers in few of them."""
        idle, moved = 0, True
        while moved and len(self.open) > 1 and idle < patience:
            before, moved = self.used, False
            for k in sorted(self.open, key=lambda k: (-self.fill[k], k)):
                while k in self.open and self._step(k):
                    moved = True
            idle = 0 if self.used < before else idle + 1


def pack_block(lengths: np.ndarray, bins: np.ndarray | None = None, capacity: int = CAPACITY) -> np.ndarray:
    """Bin number of each length. Bins that are given already are searched as they are, and kept unless best fit needs fewer."""
    tries = [best_fit(lengths.tolist(), capacity)]
    if bins is not None:
        given: dict[int, Counter] = defaultdict(Counter)
        for b, n in zip(bins.tolist(), lengths.tolist(), strict=True):
            given[b][n] += 1
        tries.append([given[b] for b in sorted(given)])
    for t in tries:
        Search(t, capacity).run()
    found = min(([b for b in t if b] for t in tries), key=len)
    rows, out = {n: list(np.flatnonzero(lengths == n)) for n in np.unique(lengths).tolist()}, np.zeros(len(lengths), np.int64)
    for k, b in enumerate(found):
        for n, c in sorted(b.items(), reverse=True):
            for _ in range(c):
                out[rows[n].pop()] = k
    return out


def pack(rows: DataFrame, capacity: int = CAPACITY, block_bins: int = BLOCK_BINS) -> DataFrame:
    """Every piece with sequence_id and offset, its place in the sequence, gapless from 0."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = T.StructType([*(rows.schema[c] for c in columns), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("closed", T.BooleanType())])
    # The row number is written with the rows, so that tasks that are run again deal them alike.
    rest, nth, out = cut(rows.withColumn("deal", F.monotonically_increasing_id())), 0, None
    total = rest.agg(F.sum("length").alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // (capacity * block_bins)))
    while True:
        packed = rest.groupBy(_block(nth, blocks).alias("block")).applyInArrow(_packer(nth, capacity, columns), schema)
        if blocks == 1:
            packed = packed.drop("closed")
            return packed if out is None else out.union(packed)
        packed = cut(packed)
        closed, rest = packed.where("closed").drop("closed"), packed.where("not closed").drop("closed")
        out = closed if out is None else out.union(closed)
        blocks = -(-blocks // max(2, block_bins // OPEN))
        nth, rest = nth + 1, rest.withColumn("deal", F.col("sequence_id"))


def _block(nth: int, blocks: int) -> Column:
    return F.pmod(F.xxhash64("deal", F.lit(nth)), F.lit(blocks))


def _packer(nth: int, capacity: int, columns: list[str]):
    def run(key: tuple, block: pa.Table) -> pa.Table:
        lengths = block["length"].to_numpy()
        bins = pack_block(lengths, block["deal"].to_numpy() if nth else None, capacity)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        start = np.concatenate([[0], ends])[first]
        offset, fill = np.zeros(len(bins), np.int64), np.bincount(bins, lengths).astype(np.int64)
        offset[order] = ends - lengths[order] - start[bins[order]]
        emptiest = np.isin(bins, np.argsort(fill, kind="stable")[:OPEN])
        number = (nth << 54) + (key[0].as_py() << 20) + bins
        return pa.table([*(block[c].combine_chunks() for c in columns), pa.array(number), pa.array(offset), pa.array(~emptiest)], [*columns, "sequence_id", "offset", "closed"])

    return run
