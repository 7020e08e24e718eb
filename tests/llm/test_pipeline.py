"""The pipeline's stages, each on its own input."""

import hashlib
import re
from collections import Counter

import pyarrow as pa

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages_pass_documents_on(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in P.STAGES[:4]:
        before = {r.doc_id for r in kept.select("doc_id").collect()}
        kept = stage(spark, kept, SF)
        assert kept.columns == columns, name
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        after = {r.doc_id for r in kept.select("doc_id").collect()}
        assert after <= before and len(after) > 0.5 * len(before), name
    out = P.STAGES[4][1](spark, kept, SF)
    assert out.count() == kept.count() and {r.shard for r in out.select("shard").distinct().collect()} <= set(range(8))


def test_run(spark):
    out = P.run(spark, SF)
    assert out.count() > 0 and out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "text_crc32", "shard", "slot"]


def test_near_copies_and_contaminated_documents_go(spark):
    base = " ".join(f"w{k}" for k in range(60))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(1, base), (2, base + " x"), (3, base), (4, "clean words of another kind " * 3), (5, "before " + item + " after"), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert {r.doc_id for r in P.drop_near_copies(spark, docs, SF).collect()} == {1, 4, 5, 6}
    assert {r.doc_id for r in P.drop_contaminated(spark, docs, SF).collect()} == {1, 2, 3, 4, 6}


CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, items string, n_words string, _score int, _found int, _copies int, gone_id int, raw string, key string, spot string, doc string, digest int"


def odd(spark):
    """Null ids and texts, equal rows, one id with two texts, and columns named like what the stages compute."""
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, a), (1, b), (5, a), (5, b + " tail"), (7, b), (None, a), (None, None), (8, None), (9, ""), (10, " \n"), (11, "one two"), (11, "one two"), (12, "only here " * 40_000)]
    return spark.createDataFrame([(i, t, None if i == 11 else "en", None if i == 8 else "s", 0, "mine", "183", 1, 2, 3, 4, "r", "k", "s", "d", 6) for i, t in rows], CLASHING)


def plain(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_stages_hand_on_odd_rows_and_clashing_columns(spark):
    docs = odd(spark)
    for stage, gone in ((P.drop_toxic, []), (P.drop_near_copies, [2, 3, 4, 5]), (P.drop_contaminated, [])):
        rows = docs.collect()
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and plain(got) == sorted(repr(tuple(r)) for k, r in enumerate(rows) if k not in gone), stage.__name__
    mixed = P.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns and set(plain(mixed)) <= set(plain(docs))
    placed = P.shard_documents(spark, docs, SF)
    assert placed.columns == [*docs.columns, "size", "text_crc32", "shard", "slot"] and plain(placed.select(*docs.columns)) == plain(docs)
    slots = {}
    for r in placed.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_stages_of_an_empty_table(spark):
    for name, stage in P.STAGES:
        got = stage(spark, odd(spark).limit(0), SF)
        assert got.count() == 0 and set(odd(spark).columns) <= set(got.columns), name


def test_toxic_stage_drops_what_its_classifier_flags(spark):
    from corundum.llm.toxicity import fit

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = {r.doc_id for r in P.drop_toxic(spark, docs, "/root/testdata/sf0.01").collect()}
    c = fit(docs, labels)
    rows = docs.collect()
    scores = c.model.scores(pa.array([r.text for r in rows], pa.string()))
    assert kept == {r.doc_id for r, s in zip(rows, scores, strict=True) if s < c.by_lang.get(r.lang, c.default)}


def test_mix_and_shards_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, copies = docs.collect(), Counter(r.doc_id for r in P.mix_sources(spark, docs, SF).collect())
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    names = sorted({r.source for r in rows if r.source is not None}) + ([None] if any(r.source is None for r in rows) else [])
    own = {s: sum(words[r.doc_id] for r in rows if r.source == s) for s in names}
    weight, full = {s: k % 3 + 1 for k, s in enumerate(names)}, set()
    while True:
        level = (sum(own.values()) - sum(3 * own[s] for s in full)) / max(1, sum(weight[s] for s in names if s not in full))
        if not (more := {s for s in names if s not in full and weight[s] * level > 3 * own[s]}):
            break
        full |= more
    for s in names:
        mine = [r.doc_id for r in rows if r.source == s]
        target = 3 * own[s] if s in full else weight[s] * level
        assert abs(sum(copies[i] * words[i] for i in mine) - target) <= max(words[i] for i in mine) / 2 + 1e-6
        assert max(copies[i] for i in mine) - min(copies[i] for i in mine) <= 1
    placed = P.shard_documents(spark, docs, SF).collect()
    load, groups = Counter(), Counter()
    for r in placed:
        load[r.shard] += r.size
        groups[hashlib.md5((r.text or "").encode()).hexdigest()] += len((r.text or "").encode()) + 1
    sizes = [groups[g] for g in sorted(groups)]
    need = lambda most: 1 + sum(1 for _ in cuts(sizes, most))
    best = next(m for m in range(max([*sizes, -(-sum(sizes) // 8)]), sum(sizes) + 1) if need(m) <= 8)
    assert max(load.values()) == best


def cuts(sizes, most):
    have = 0
    for s in sizes:
        if have + s > most:
            yield s
            have = 0
        have += s
