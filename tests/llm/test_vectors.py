"""Whitening, vector codes and packing against brute force, with odd rows."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corundum.llm import bidiagonal, packing, queries, vector_codes, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, v int, code string, n int, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", 1, "y", 2, "z") for i, v, l in rows], SCHEMA)


def odd_vectors(spark, length=16, n=150, hot=None):
    """Random vectors, many equal ones, and nulls, null entries, NaN, infinity, other lengths, null ids and repeated rows."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, length)], None if i % 4 == 0 else i % 3) for i in range(n)]
    rows += [(1000 + i, hot or [0.25] * length, 1) for i in range(n // 2)] + [rows[3], rows[3], (None, rows[5][1], None)]
    good = list(rows)
    rows += [(2001, None, 1), (2002, [None] + [0.0] * (length - 1), 1), (2003, [float("nan")] * length, 1), (2004, [float("inf")] + [0.0] * (length - 1), 2), (2005, [0.5] * (length + 2), 1), (2006, [], 1)]
    return vectors(spark, rows), good


# -- whitening ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "x",
    [
        np.random.default_rng(0).normal(size=(90, 40)),
        np.random.default_rng(1).normal(size=(60, 4)) @ np.random.default_rng(2).normal(size=(4, 12)),
        np.diag([3.0] * 9 + [2.0] * 9 + [1.0] * 2 + [0.0] * 3) @ np.linalg.qr(np.random.default_rng(3).normal(size=(23, 23)))[0],
        np.random.default_rng(4).normal(size=(80, 30)) * np.logspace(0, -13, 30),
        np.eye(7),
        np.zeros((5, 3)),
        np.random.default_rng(6).normal(size=(4, 1)),
    ],
)
def test_singular_directions(x):
    r = np.linalg.qr(x, mode="r")
    r = np.vstack([r, np.zeros((x.shape[1] - len(r), x.shape[1]))])
    k = x.shape[1]
    s, v = bidiagonal.right_singular(r, k)
    want = np.linalg.svd(r, compute_uv=False)
    top = max(want[0], 1e-300)
    assert np.abs(s - want).max() <= 1e-13 * top
    assert np.abs(v.T @ v - np.eye(k)).max() < 1e-10
    assert np.abs(r.T @ (r @ v) - v * s**2).max() <= 1e-13 * top**2


def test_dqds_is_relatively_accurate():
    """Tiny values of a graded bidiagonal keep their digits, which eigenvalues of its square lose."""
    from fractions import Fraction

    a, b = np.array([1.0, 1e-5, 1e-10]), np.array([1e-3, 1e-8])
    got = bidiagonal.squared_values(a, b)
    product = Fraction(1)
    for x in a:
        product *= Fraction(float(x)) ** 2
    assert abs(float(product) / float(np.prod(got)) - 1) < 1e-13


def brute_white(rows, components=8):
    x = np.floor(1024 * np.array([v for _, v, _ in rows], np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    z = (n * x - s) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return ((n * x - s) ** 2).sum(1), (z @ u) / np.sqrt(e), e / np.trace(z.T @ z / n)


def test_whitening_of_odd_rows(spark):
    df, good = odd_vectors(spark)
    got = whitening.whiten(df.repartition(7)).toPandas()
    assert len(got) == 8 * len(good) and set(got["n"]) == {len(good)} and got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    deviation, white, explained = brute_white(good)
    want = {}
    for (i, _, _), d, w in zip(good, deviation, white, strict=True):
        want.setdefault(i, []).append((int(d), w))
    signs = {}
    for r in got.itertuples():
        i = None if np.isnan(r.vec_id) else int(r.vec_id)
        d, w = want[i][0]
        x = w[r.component - 1]
        signs.setdefault(r.component, np.sign(r.whitened * x))
        assert r.deviation == d and abs(r.whitened - signs[r.component] * x) < 1e-9 and abs(r.explained / explained[r.component - 1] - 1) < 1e-9


def test_triangles_merge_by_trees(spark):
    df, good = odd_vectors(spark, n=400)
    rows = whitening.finite_rows(df.repartition(13), "embedding", {"id": "vec_id"}).where("size(v) = 16")
    n, sums = whitening._add_sums(rows, 16, 1024)
    few, many = whitening.triangle(rows, n, sums, 1024, fan=2), whitening.triangle(rows, n, sums, 1024)
    assert np.abs(few.T @ few - many.T @ many).max() < 1e-9 * np.abs(many.T @ many).max()


def test_whitening_without_variance(spark):
    one = whitening.whiten(vectors(spark, [(1, [0.5] * 4, 1)])).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in one)
    flat = whitening.whiten(vectors(spark, [(k, [k / 8, 1.0, 2.0], 1) for k in range(8)])).collect()
    assert {r.component for r in flat if r.whitened is not None} == {1} and len(flat) == 24
    for rows in ([], [(1, None, 1)], [(1, [], 1)]):
        assert whitening.whiten(vectors(spark, rows)).count() == 0


def test_whitening_of_huge_entries(spark):
    rows = [(k, [float(1 << (40 + k % 3)), -float(k), 1e30 if k == 9 else 0.0], 1) for k in range(10)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert {r.vec_id for r in got} == set(range(9)) and all(r.deviation is None for r in got)


def test_whitening_query(spark):
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 8 * spark.read.parquet(f"{SF}/embeddings.parquet").count()


# -- vector codes -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n,k,width,leaf,spread", [(700, 64, 4, 4, 40), (700, 64, 4, 16, 2), (5, 64, 3, 4, 9), (300, 1, 2, 4, 5), (1, 1, 1, 4, 5), (257, 7, 5, 4, 1)])
def test_dual_tree_assignment(n, k, width, leaf, spread):
    rng = np.random.default_rng(n + k)
    x = np.floor(rng.normal(0, spread, (6, n, width))).astype(np.int64)
    x[:, : n // 3] = x[:, :1]  # a hot point
    x[0] += np.int64(500)
    books = np.floor(rng.normal(0, spread, (6, k, width))).astype(np.int64)
    books[:, k // 2 :] = books[:, : k - k // 2]  # equal entries
    want = ((x[:, :, None] - books[:, None]) ** 2).sum(3).argmin(2)
    got, stats = vector_codes.assign(x, books, leaf)
    assert (got == want).all()
    assert stats["distances"] < x.shape[0] * 2 * n * k or n < 300


def test_whole_nodes_are_assigned_by_bounds():
    x = np.concatenate([np.random.default_rng(0).integers(0, 9, (1, 500, 4)) + 1000 * c for c in range(4)], 1)
    books = np.array([[[1000 * c + 4] * 4 for c in range(4)]])
    got, stats = vector_codes.assign(x, books)
    assert (got[0] == np.repeat(np.arange(4), 500)).all() and stats["whole"] >= 2000 and not stats["distances"]


def brute_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[int(np.floor(scale * float(np.float32(c)))) for c in v] for _, v, _ in rows]
    w = len(x[0]) // parts
    books = [[x[e][p * w : p * w + w] for e in range(min(entries, len(x)))] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w : p * w + w], c, strict=True)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        found = [[near(v, p)[1] for p in range(parts)] for v in x]
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p * w : p * w + w] for v, f in zip(x, found, strict=True) if f[p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, by = [], {}
    for (i, _, label), v in zip(rows, x, strict=True):
        d = [near(v, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in d), sum(e for e, _ in d), label))
        by[label] = by.get(label, 0) + out[-1][2]
    return sorted(((i, c, e, by[label], sha) for i, c, e, label in out), key=str)


def test_codes_of_odd_rows(spark):
    df, good = odd_vectors(spark, length=32)
    got = vector_codes.compress(df.repartition(5))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(good)


def test_codes_of_few_and_huge_vectors(spark):
    rows = [(1, [1e9 * k for k in range(16)], None), (2, [-3.0] * 16, 1), (3, [2e9 + k for k in range(16)], 1)]
    assert sorted((tuple(r) for r in vector_codes.compress(vectors(spark, rows), entries=2).collect()), key=str) == [
        (i, c, e if e < 1 << 63 else None, by, s) for (i, c, e, _, s), by in zip(brute_codes(rows, entries=2), [r["label_error"] for r in vector_codes.compress(vectors(spark, rows), entries=2).orderBy("vec_id").collect()], strict=True)
    ]
    assert vector_codes.compress(vectors(spark, [(1, None, 1)])).count() == 0
    with pytest.raises(ValueError):
        vector_codes.compress(vectors(spark, [(1, [1.0] * 17, 1)]))


def test_codes_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op12_vector_codes"](spark, SF).collect()), key=str)
    assert got == brute_codes(rows)


# -- packing ------------------------------------------------------------------------------------------------------------

SPECIAL = [
    "<|endoftext|> Some ~ text",
    "Σας ΟΔΟΣ. ~ b~ a~. İstanbul, ﬁ x́. é, a\tb\x1cc don't, I'LL. 'tis 12,5 3rd. ÀÉ. ÿ;: ×, x.'s x,\"y K.",
    "́abc,  \n x...",
    "~",
    " ",
    "",
    "a" * 5000,
    "don't" * 900 + " x",
    "naïve café. NAÏVE CAFÉ! ñandú,über;straße?",
    "日本語 текст, 한국어! emoji 🙂🙂. a b c\r\nd",
]


def test_ids_are_those_of_the_tokenizer(spark, monkeypatch):
    texts = SPECIAL + [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    plain = Tokenizer.from_file(packing.vocabulary())
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    words = packing.WordIds(packing.vocabulary())
    assert words.encode(texts) == want and words.encode(texts[::-1]) == want[::-1]
    monkeypatch.setattr(packing, "SLICE", 500)
    monkeypatch.setattr(packing, "WORDS", 50)
    assert packing.WordIds(packing.vocabulary()).encode(texts) == want


def check_packing(rows, capacity):
    """Sequences are gapless, no longer than their capacity, and every document's pieces cover it."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and 0 < length <= capacity
            at += length
        assert at <= capacity
    return by_sequence, by_doc


def test_packing_of_odd_rows(spark):
    long = "alpha beta gamma, " * 4000
    rows = [(k, t) for k, t in enumerate(SPECIAL)] + [(50, None), (50, None), (51, long), (51, long), (None, "lost"), (52, "twice"), (52, "twice")]
    docs = spark.createDataFrame([(t, i, "p", 0, 1) for i, t in rows], "text string, doc_id bigint, piece string, start int, length int")
    got = packing.pack(packing.pieces(docs.repartition(3), capacity=256), capacity=256, block_bins=20).collect()
    check_packing(got, 256)
    plain = Tokenizer.from_file(packing.vocabulary())
    want = []
    for i, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, p, s, len(ids[s : s + 256]), zlib.crc32(ids[s : s + 256].tobytes())) for p, s in enumerate(range(0, len(ids), 256))]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got)
    assert len({r.sequence_id for r in got}) == -(-sum(r.length for r in got) // 256)
    assert packing.pack(packing.pieces(docs.where("false"))).count() == 0


def test_exchanges_raise_the_sum_of_squares_and_keep_the_lengths():
    for seed, (lo, hi) in enumerate(((600, 1500), (1000, 3000), (1300, 2200), (1, 900))):
        lengths = np.random.default_rng(seed).integers(lo, hi, 300)
        first = packing.best_fit(lengths.tolist())
        search = packing.Search([b.copy() for b in first])
        before = sum(f * f for f in search.fill)
        search.run()
        assert sum(f * f for f in search.fill) >= before and max(search.fill) <= 4096
        assert sorted(n for b in search.bins for n in b.elements()) == sorted(lengths.tolist())
        assert search.fill == [sum(b.elements()) for b in search.bins]
        assert search.used == sum(f > 0 for f in search.fill) <= len(first)
    # Best fit on falling lengths needs three bins here, an exchange two.
    hard = np.array([44, 24, 24, 22, 21, 17, 8, 8, 6, 6])
    tight = packing.pack_block(hard, capacity=90)
    assert tight.max() + 1 <= len(packing.best_fit(hard.tolist(), 90))


@pytest.mark.parametrize("out,into", [((3,), (5,)), ((3, 2), (6,)), ((), (4,)), ((3,), (2, 2))])
def test_each_kind_of_exchange(out, into):
    from collections import Counter

    a, b = Counter([*out, 90]), Counter([*into, 20])
    search = packing.Search([a, b], 90 + sum(into))
    assert search._step(0) and search.fill[0] == 90 + sum(into)


def test_rounds_join_open_bins_of_blocks(spark):
    docs = spark.range(3000).select("id", F.expr("repeat('ab ', cast(1 + pmod(xxhash64(id), 60) as int))").alias("text"))
    got = packing.pack(packing.pieces(docs.repartition(4), "id", capacity=128), capacity=128, block_bins=20).collect()
    check_packing(got, 128)
    assert len({r.sequence_id for r in got}) <= -(-sum(r.length for r in got) // 128) * 1.002 + 1


def test_packing_query(spark):
    got = queries.QUERIES["op13_best_fit_packing"](spark, SF).collect()
    check_packing(got, 4096)
    assert len({r.sequence_id for r in got}) == -(-sum(r.length for r in got) // 4096)
