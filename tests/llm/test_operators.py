"""The corpus operators against brute force, exact round trips, held-out rows and edge cases."""

import base64
import glob
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corundum.llm import decontaminate as D
from corundum.llm import html_text, licenses, minhash, mixing, passages, quality, queries, sharding, toxicity, warc
from corundum.llm._spark import shared_folder
from corundum.llm._words import mix, shingle_sets, shingles, windows
from tests.oracle import same

SF = "/root/testdata/sf0.001"
BLANK = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, n int, items string, words string, bucket int, root string"
LONG = " ".join(f"word{i % 9973} and{i % 77}" for i in range(300_000))


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def edge(spark, rows=None):
    """Documents with nulls, blanks, very long and repeated texts, null sources, and extra columns whose names clash."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from here to there".split()
    near = [" ".join(base * 4)] + [" ".join(base * 4 + [f"x{k}"]) for k in range(3)]
    if rows is None:
        rows = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, LONG + " end"), (6, near[0]), (7, near[0]), (8, near[1]), (9, near[2]), (9, near[2]), (10, "Is"), (11, "é É ñ " * 30), (12, near[0].upper()), (13, "one two three four five"), (None, "lost words of no document")]
    return spark.createDataFrame([(i, t, "en" if i and i % 2 else None, None if i and i % 3 == 0 else f"s{(i or 0) % 2}", 0, "x", 1, "y", "z", 3, "r") for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# -- near duplicates ------------------------------------------------------------------------------------------------------


def components(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = re.findall(BLANK, lower(t))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    ids = [i for i in sets if i is not None]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * (n := len(sets[a] & sets[b])) >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_of_edge_cases(spark):
    d = edge(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(d, width=4).collect()}
    want = components([(r.doc_id, r.text) for r in d.collect()], 4, 80)
    assert {i: got[i] for i in want} == want and minhash.near_duplicates(empty(spark)).count() == 0


def test_an_id_with_two_texts_is_two_documents(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    got = minhash.near_duplicates(edge(spark, [(1, a), (1, b), (2, b + " tail"), (4, a), (3, a + " tail"), (None, b)]), width=4)
    assert sorted((str(r.doc_id), r.component_id) for r in got.collect()) == [("1", 1), ("1", 1), ("2", 1), ("3", 1), ("4", 1), ("None", 1)]


def test_near_duplicates_in_a_group_around_the_threshold(spark):
    """Copies of one text from 0.4 to 0.97, whose edits come from few words, so many share buckets and rare shingles alike."""
    rng = np.random.default_rng(5)
    base, other = [f"w{k}" for k in range(80)], [f"e{k}" for k in range(6)]
    docs = [(0, " ".join(base))]
    for i in range(1, 160):
        t = list(base)
        for k in rng.choice(80, int(rng.integers(1, 8)), replace=False):
            t[k] = other[int(rng.integers(6))]
        docs.append((i, " ".join(t)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(edge(spark, docs), width=4).collect()}
    want = components(docs, 4, 80)
    assert got == want and len(set(c for _, c in want.values())) > 5


def test_near_duplicates_link_chains_and_find_every_pair(spark):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(400)]
    docs = []
    for group in range(12):
        t = list(rng.choice(words, 60))
        for _ in range(int(rng.integers(1, 9))):  # each differs a little from the one before
            docs.append((len(docs), " ".join(t)))
            t[int(rng.integers(60))] = f"n{len(docs)}"
    common = " ".join(rng.choice(words, 30))
    docs += [(len(docs) + k, common + " " + " ".join(rng.choice(words, 25))) for k in range(30)]  # share a passage, link with nothing
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(edge(spark, docs), width=4).collect()}
    assert got == components(docs, 4, 80)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    both, x, y = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) for n in (600, 150, 150))
    a, b = (minhash.signature(np.concatenate([both, z]), 576) for z in (x, y))
    assert abs((a == b).mean() - 600 / 900) < 0.08


# -- decontamination ------------------------------------------------------------------------------------------------------


def hits(docs, items, window=10):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(t))
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            grams[tuple(w[k : k + window])].add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (own := grams.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= own
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [D.PATTERN_BYTES, 300])
def test_decontamination(spark, most):
    items = [(10, "The quick brown fox jumps over the lazy dog and runs far"), (11, "is"), (12, "and runs"), (13, ""), (14, None), (15, "é É ñ é É ñ é É ñ é É ñ é"), (15, "word5 and5 word6 and6"), (16, "...")]
    d, bench = edge(spark), spark.createDataFrame(items, "item_id bigint, text string")
    got = D.decontaminate(d, bench, most=most)
    assert "id" in got.columns and got.columns.count("items") == 1
    have = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()), key=str)
    assert have == hits([(r.doc_id, r.text) for r in d.collect()], items)
    assert D.decontaminate(d, bench.limit(0)).where("n_hit > 0").count() == 0 and D.decontaminate(empty(spark), bench).count() == 0


def test_op3_on_the_driver_tables(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op3_decontaminate"](spark, SF).collect()}
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    for i, n, hit, found in hits(docs, items):
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0)


def test_a_text_longer_than_a_block_is_searched_across_its_pieces():
    item = " ".join(f"key{k}" for k in range(12))
    text = ("filler words " * 340_000)[: (4 << 20) - 40] + " " + item + " " + "filler words " * 200_000
    (n, spans, found), = D.marked(pa.array([text]), D.Patterns([("a", item)]))
    assert n == len(text.split()) and sum(e - s for s, e in spans) == 12 and found == {"a"}


# -- toxicity -------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def classifier(spark):
    sf = "/root/testdata/sf0.1"
    return toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def test_toxicity_ranks_held_out_rows(spark, classifier):
    sf = "/root/testdata/sf0.1"
    # English only: the labels of the other languages of this table don't follow the texts.
    d = spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en'").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(toxicity.held_out(F.col("doc_id")))
    rows = d.select("toxic", classifier.score("text").alias("s")).collect()
    pos, neg = ([r.s for r in rows if r.toxic == k] for k in (1, 0))
    auc = np.mean([np.mean(np.array(neg) < p) for p in pos])
    assert auc > 0.93 and np.mean(np.array(pos) >= 0.7) > 0.85 and np.mean(np.array(neg) >= 0.7) < 0.02


def test_toxicity_of_edge_cases(spark, classifier):
    d = edge(spark).withColumn("s", classifier.score("text")).withColumn("f", classifier.flag("s", "lang"))
    got = {(r.doc_id, r.text): r.s for r in d.collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[1, None] == got[2, ""] == got[3, " \n\t"]
    bad = LONG + " you idiot moron " + LONG
    one = classifier.model.scores(pa.array([bad, LONG, None, ""]))
    assert one[0] > one[1] and one[2] == one[3] and classifier.model.scores(pa.array([], pa.string())).size == 0


def test_scores_by_a_plain_forward_pass(classifier):
    """Word by word and window by window, from the embeddings and filters alone."""
    m = classifier.model
    texts = ["you are an idiot and a moron", "", "one", "é ñ ü straße", "12 34", "The quick brown fox, jumps over; the lazy dog! " * 40]
    want = []
    for t in texts:
        b = np.frombuffer(t.encode(), np.uint8)
        rows, which, _ = toxicity.features(b, np.zeros(1, np.int64))
        assert len(which) == len(re.findall(rb"[A-Za-z\x80-\xff]+", t.encode()))
        words = [m.emb[rows[k]].mean(0) for k in which] + [np.zeros(toxicity.DIM, np.float32)] * toxicity.PAD
        hidden = []
        for w, width in enumerate(toxicity.WIDTHS):
            sums = [sum(words[k + j] @ m.filters[w][j] for j in range(width)) for k in range(len(words) - width + 1)]
            hidden.append(np.maximum(np.max(sums, axis=0) + m.bias[w], 0))
        z = m.scale * float(np.concatenate(hidden) @ m.weights + m.intercept) + m.shift
        want.append(1 / (1 + np.exp(-np.clip(z, -40, 40))))
    assert np.allclose(m.scores(pa.array(texts)), want, atol=1e-4)


def test_toxicity_of_empty_tables_and_clashing_columns(spark):
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(200)], "doc_id bigint, quality int, toxic int")
    names = "doc_id bigint, text string, lang string, toxic string, model string, quality string"
    docs = spark.createDataFrame([(k, ["fine words here", "you idiot there"][k % 2], "en", "x", "y", "z") for k in range(200)], names)
    c = toxicity.fit(docs, labels)
    got = docs.select("doc_id", "toxic", c.score("text").alias("s")).collect()
    assert all(r.toxic == "x" and (r.s >= 0.5) == (r.doc_id % 2 == 1) for r in got)
    assert toxicity.fit(docs.limit(0), labels).model is None


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    c = toxicity.fit(edge(spark), none)
    assert {r.s for r in edge(spark).select(c.score("text").alias("s")).collect()} == {0.0}


def test_windows_reach_over_the_cut_of_a_long_text():
    rng = np.random.default_rng(4)
    filters = [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    m = toxicity.Model(rng.normal(size=(toxicity.BUCKETS, toxicity.DIM)).astype(np.float32), filters, [np.zeros(toxicity.FILTERS, np.float32)] * 3, np.ones(3 * toxicity.FILTERS, np.float32), 0.0)
    text = LONG.encode()[: 3 << 20]
    b = np.frombuffer(text, np.uint8)
    whole = m._block(b, np.zeros(1, np.int64)) @ m.weights
    assert len(b) > 2 << 20 and np.allclose(m.logits(b, np.array([0, len(b)])), whole)


# -- quality, licenses, mixing --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    same(spark, SF, queries.QUERIES[name], queries.ORACLES[name])


def test_quality_of_edge_cases(spark):
    got = {r.doc_id: r for r in quality.quality(edge(spark)).collect()}
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept and got[3].n_words == 0 and got[4].n_words == 600_000
    words = got[6].n_words
    assert got[6].n_repeat_words == words == 68 and quality.quality(empty(spark)).count() == 0


def test_common_lines_deplete_documents(spark):
    line = " ".join("foot" + chr(97 + j % 26) * (1 + j // 26) for j in range(65))
    own = lambda k: " ".join(f"own{k}x{chr(97 + j % 26) * (1 + j // 26)}" for j in range(60))
    again = [(2, line + "\n" + own(k)) for k in range(2, 300, 6)]  # one document, however many rows it has
    assert not any(r.removed_words for r in quality.quality(edge(spark, again)).collect())
    many = [(k, line + "\n" + own(k)) for k in range(2, 300, 6)] + [(1000, line + "\nshort own text here")]
    got = {r.doc_id: r for r in quality.quality(edge(spark, many)).collect()}
    assert got[2].removed_words == 65 and not got[2].kept and not got[1000].kept and got[1000].removed_words == 65


def test_licenses(spark):
    mit = dict(licenses.TEMPLATES)["MIT grant"]
    rows = [(1, None), (2, ""), (3, "x " * 500 + mit + " y" * 300), (4, mit.replace("without restriction", "with restriction")), (5, "Released under the MIT License."), (5, "Released under the MIT License."), (6, "free of any license")]
    got = {(r.doc_id, r.license): r for r in licenses.scan(edge(spark, rows)).collect()}
    assert (3, "MIT grant") in got and got[3, "MIT grant"].matched == got[3, "MIT grant"].total and (4, "MIT grant") in got and (5, "MIT line") in got
    assert {i for i, _ in got} == {3, 4, 5} and licenses.scan(empty(spark)).count() == 0


def test_license_templates_of_any_length(spark):
    long = " ".join(f"clause{k} says" for k in range(330))
    half = long.split()
    rows = [(1, "x " * 90 + long + " y" * 70), (2, long), (3, " ".join(half[:400])), (4, " ".join(half[:600])), (5, " ".join(half[:300])), (5, long), (None, long)]
    got = {r.doc_id: r for r in licenses.scan(edge(spark, rows), [("long", long), ("five words", "one two three four five")]).collect()}
    assert set(got) == {1, 2, 4, 5, None} and all(r.license == "long" and r.total == 656 for r in got.values()) and got[5].matched == 656
    for short in ("four words are few", "", "..."):
        with pytest.raises(ValueError, match="short"):
            licenses.scan(edge(spark, rows), [("short", short)])


def test_mixing(spark):
    d = edge(spark)
    got = mixing.mix(d).collect()
    assert len(got) == d.count() and all(0 <= r.taken <= 3 * r["size"] for r in got) and mixing.mix(empty(spark)).count() == 0
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in mixing.mix(docs).collect()}
    words, taken, target = Counter(), Counter(), {}
    for r in docs.collect():
        words[r.source] += rows[r.doc_id]["size"]
        taken[r.source] += rows[r.doc_id].taken
        target[r.source] = rows[r.doc_id].target
    most = max(r["size"] for r in rows.values())
    assert all(abs(taken[s] - target[s]) <= most for s in words) and abs(sum(target.values()) - sum(words.values())) < 1e-6 * sum(words.values())
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {i: r.taken for i, r in rows.items()}
    copies = Counter(r.doc_id for r in mixing.repeat_rows(docs).collect())
    assert all(copies[i] * r["size"] == r.taken for i, r in rows.items())


def test_water_filling_clamps(spark):
    s = spark.createDataFrame([("a", 10), ("b", 10), ("c", 980), (None, 0)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(s, (1, 2, 3)).collect()}
    assert got == {"a": 30.0, "b": 30.0, "c": 940.0, None: 0.0}


# -- sharding -------------------------------------------------------------------------------------------------------------


def test_cuts_are_minimal():
    rng = np.random.default_rng(9)
    for _ in range(200):
        sizes, k = [int(x) for x in rng.integers(1, 30, int(rng.integers(1, 9)))], int(rng.integers(1, 5))
        cuts = sharding.minimax_cuts(sizes, k)
        load = [sum(sizes[a:b]) for a, b in zip([0, *cuts], cuts, strict=False)]
        best = [[0 if not i else float("inf") for i in range(len(sizes) + 1)]]
        for _ in range(k):
            best.append([min([best[-1][i], *(max(best[-1][j], sum(sizes[j:i])) for j in range(i))]) for i in range(len(sizes) + 1)])
        assert cuts[-1] == len(sizes) and len(cuts) <= k and max(load) == best[-1][-1]


def test_pieces_are_parted_until_the_partition_is_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(hashlib.md5(str(k % 900).encode()).hexdigest(), int(s)) for k, s in enumerate(rng.integers(1, 500, 1000))]
    groups = Counter()
    for g, s in rows:
        groups[g] += s
    names = sorted(groups)
    load = lambda firsts: max(sum(groups[g] for g in names if a <= g < z) for a, z in zip(["", *firsts], [*firsts, "g"], strict=True))
    ends = sharding.minimax_cuts([groups[g] for g in names], 8)
    d = spark.createDataFrame(rows, "digest string, size bigint")
    for prefix, more in ((1, 1), (1, 4), (4, 2)):
        firsts = sharding.cut_points(d, 8, prefix, more)
        assert len(firsts) <= 7 and load(firsts) == load([names[e] for e in ends[:-1]])


def test_sharding(spark):
    for d in (edge(spark), spark.read.parquet(f"{SF}/documents.parquet")):
        got, texts = sharding.shard(d).collect(), Counter((r.doc_id, len((r.text or "").encode()) + 1) for r in d.collect())
        assert Counter((r.doc_id, r["size"]) for r in got) == texts
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(8))
    load = Counter()
    for r in got:
        load[r.shard] += r["size"]
    assert max(load.values()) < 1.2 * sum(load.values()) / 8
    by_text = defaultdict(set)
    for r, t in ((r, t) for r in got for t in [r.text_crc32]):
        by_text[t, r["size"]].add(r.shard)
    assert all(len(x) == 1 for x in by_text.values()) and sharding.shard(empty(spark)).count() == 0


# -- archives, pages, passages --------------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    big = "ö" * 700_000
    rows = [(1, "http://a/", "<p>x"), (2, None, "<p>x"), (3, "http://b/\n", None), (4, "c", ""), (5, "d", big), (6, "e", big + "!"), (7, "f", "<p>x"), (7, "f", "<p>x"), (None, "g", "alone")]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id bigint, url string, html string, body string, response string").repartition(3)
    folder = shared_folder(spark)
    manifest = warc.write_archives(pages, folder)
    chunks = warc.read_chunks(manifest, folder)
    parts = defaultdict(list)
    for r in chunks.collect():
        parts[r.page_id, r.record_type].append(r)
    whole = b"".join(bytes(r.data) for r in sorted(parts[5, "response"], key=lambda r: r.chunk_no))
    assert whole == big.encode() and len(parts[5, "response"]) > 1
    running = hashlib.sha1()
    for r in sorted(parts[5, "response"], key=lambda r: r.chunk_no):
        running.update(bytes(r.data))
        assert r.digest_so_far == base64.b32encode(running.digest()).decode()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.record_index(warc.read_chunks(manifest, folder, with_data=False)).collect())
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        other = last[h or ""] if last[h or ""] not in (i, -1) else None
        want[i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if other is not None else "response", other] += 1
    assert got == want and sum(r.records for r in manifest.collect()) == len(rows)
    assert warc.record_index(warc.read_chunks(warc.write_archives(pages.limit(0), folder), folder, False)).count() == 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>
<div class="sidebar">Read   also <a href=c>this</a></div><div id="cookie-notice">We use cookies and they are long, so that this text is dense enough</div>
<article><h1>A &amp; B</h1><p>First   para
with <b>bold<br>text</b>.<p>Second &lt;para&gt; &copy; caf&eacute;</p><script>var x = "</p>";</script><ul><li>one<li>two</ul><form>Name <input></form>
<div class="comments"><p>I disagree with all of it, says a reader at length</p></div></article><footer>&copy; 2020</footer></body>"""


def test_main_text(spark):
    want = "A & B\n\nFirst para with bold text.\n\nSecond <para> © café\n\none\n\ntwo"
    assert html_text.main_text(PAGE) == want and html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<script>x</script>") == ""
    assert html_text.main_text("<p>hi") == "hi" and html_text.main_text("just &lt;text") == "just <text"
    assert html_text.main_text("<div>" * 2000 + "deep").endswith("deep")
    d = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y")], "page_id bigint, url string, html string, text string")
    assert [r.t for r in d.select("page_id", html_text.extract("html").alias("t")).orderBy("page_id").collect()] == [want, want, ""]


def test_pages_of_the_driver(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.QUERIES["op8_html_text"](spark, SF).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        import html

        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_main_text_of_several_containers():
    paras = [f"{k} " + "words of the article that go on and on, " * 8 for k in range(12)]
    p = lambda lo, hi: "".join(f"<p>{x}</p>" for x in paras[lo:hi])
    links = "<div>" + "".join(f"<a href=x{k}>Link {k}</a> " for k in range(12)) + "</div>"
    want = "\n\n".join(x.strip() for x in paras)
    for page in (
        f"<body>{links}<div><div>{p(0, 6)}</div><div>{p(6, 12)}</div></div>{links}</body>",
        f"<html><body>{links}<section>{p(0, 2)}</section><section>{p(2, 9)}</section>{links}<section>{p(9, 12)}</section></body></html>",
        f"<body>{links}{p(0, 3)}<div>{p(3, 12)}</div>{links}</body>",
    ):
        assert html_text.main_text(page) == want


def plain_pages():
    """Pages that mark nothing: no article, no class names, menus and notes in plain div elements."""
    text = lambda k: f"Paragraph {k} tells at some length what happened there, and who said so, " * 4
    p = lambda lo, hi: "".join(f"<p>{text(k)}</p>" for k in range(lo, hi))
    menu = "<div><div>" + "</div><div>".join(f"<a href=x{k}>Topic number {k}</a>" for k in range(15)) + "</div></div>"
    want = lambda lo, hi: "\n\n".join(text(k).strip() for k in range(lo, hi))
    return [
        (f"<body>{menu}<div>{p(0, 6)}</div><div>Thank you for reading.</div></body>", want(0, 6)),
        (f"<body><div>Short words of a note.</div><div>{menu}<div><div>{p(0, 3)}</div><div>{p(3, 8)}</div></div></div></body>", want(0, 8)),
        (f"<table><tr><td>{menu}<td>{p(0, 5)}<td>See you</table>", want(0, 5)),
    ]


def test_density_chooses_where_nothing_is_marked(monkeypatch):
    for page, want in plain_pages():
        assert html_text.main_text(page) == want
    true = html_text.densities

    def inverse(t):
        d, *rest = true(t)
        return [1 / (x + 1e-3) if t.pieces else x for x in d], *rest

    monkeypatch.setattr(html_text, "densities", inverse)
    for page, want in plain_pages():
        assert html_text.main_text(page) != want


def test_densities_by_a_plain_count():
    """Another parser, and the formula node by node over its nested lists."""
    from html.parser import HTMLParser
    from math import e, log

    class Nested(HTMLParser):
        def __init__(self):
            super().__init__()
            self.top = ["#", []]
            self.open, self.order = [self.top], [self.top]

        def handle_starttag(self, tag, attrs):
            node = [tag, []]
            self.open[-1][1].append(node)
            self.order.append(node)
            self.open.append(node)

        def handle_endtag(self, tag):
            self.open.pop()

        def handle_data(self, data):
            self.open[-1][1].append(" ".join(data.split()))

    page = "<div><p>One two three <a>four five</a> six</p><div><p>Seven, eight and nine are here</p><p><a>ten</a></p></div></div>"
    parser = Nested()
    parser.feed(page)

    def counts(node, link=False):
        link = link or node[0] == "a"
        c = lc = g = a = 0
        for x in node[1]:
            if isinstance(x, str):
                c, lc = c + len(x), lc + len(x) * link
            else:
                n = counts(x, link)
                c, lc, g, a = c + n[0], lc + n[1], g + n[2] + 1, a + n[3] + (x[0] == "a")
        return c, lc, g, a

    share = (top := counts(parser.top))[1] / top[0]
    want = []
    for node in parser.order:
        inside = any(node in up[1] and up[0] == "a" for up in parser.order)
        c, lc, g, a = counts(node, inside)
        ratio = c / max(1, lc) * max(1, g) / max(1, a)
        want.append(c / max(1, g) * max(0, log(ratio)) / log(c / max(1, c - lc) * lc + share * c + e) if c else 0)
    tree = html_text.Tree(page)
    assert tree.tag == [n[0] for n in parser.order] and np.allclose(html_text.densities(tree)[0], want)


def test_pages_left_open_take_time_in_proportion():
    import time

    for one in ("<b><p>x</p>", "<div>", "<ul><li><p>t", "<a ", '<a b="', "<div></b></i>"):
        spent = []
        for size in (1 << 17, 1 << 19):
            began = time.process_time()
            html_text.main_text(one * (size // len(one)))
            spent.append(time.process_time() - began)
        assert spent[1] < 12 * spent[0] + 0.5


def test_odd_markup(spark):
    assert html_text.main_text("<p class=it's>Hello</p><p>don't go</p><p>Last</p>") == "Hello\n\ndon't go\n\nLast"
    assert html_text.main_text("<p>kept</p><a href='x") == "kept"
    d = spark.createDataFrame([], "page_id bigint, url string, html string, text string, run string")
    assert d.select(html_text.extract("html").alias("t")).count() == 0
    d = spark.createDataFrame([(1, "u", "<p>a  b", "mine", "r")], "page_id bigint, url string, html string, text string, run string")
    assert [tuple(r) for r in d.select("*", html_text.extract("html").alias("t")).collect()] == [(1, "u", "<p>a  b", "mine", "r", "a b")]


def test_repeated_passages(spark):
    rng = np.random.default_rng(8)
    fresh = lambda n: " ".join("".join(chr(97 + x) for x in rng.integers(0, 26, 6)) for _ in range(n))
    para, inner = fresh(60), ". ".join(fresh(9).capitalize() for _ in range(7)) + "."
    near = " ".join(para.split()[:30] + ["other"] + para.split()[31:])
    rows = [(1, fresh(80) + "\n" + para), (2, para + "\n" + fresh(50)), (3, fresh(40) + "\n" + near), (4, fresh(50) + ". " + inner + " " + fresh(40)), (5, fresh(30) + ".\n" + fresh(20) + ". " + inner), (6, fresh(300)), (7, None), (8, ""), (9, "tiny"), (6, fresh(60))]
    got = passages.repeated_passages(edge(spark, rows)).collect()
    assert {(r.doc_id, r.removed) for r in got if r.kind == "paragraph"} == {(1, False), (2, True), (3, True)}
    runs = {r.doc_id: r for r in got if r.kind == "run"}
    assert {i for i, r in runs.items() if r.removed} >= {5} and runs[4].n_words >= 50 and not runs[4].removed
    assert not {6, 7, 8, 9} & {r.doc_id for r in got} and passages.repeated_passages(empty(spark)).count() == 0


def test_repeated_passages_whatever_lines_and_marks(spark):
    rng = np.random.default_rng(11)
    fresh = lambda n: " ".join("".join(chr(97 + x) for x in rng.integers(0, 26, 6)) for _ in range(n))
    lines = lambda t, n: re.sub(rf"((?:\S+ ){{{n - 1}}}\S+) ", r"\1\n", t)
    inner, marked, short, edited, long = fresh(55), " ".join(w + "!!" for w in fresh(60).split()), fresh(60), fresh(51).split(), fresh(200_000)
    other = " ".join(edited[:25] + ["other"] + edited[26:])
    rows = [
        (1, fresh(70) + " " + inner + " " + fresh(33)), (2, fresh(41) + " " + inner + " " + fresh(90)),  # in the middle of a line
        (3, lines(marked, 7)), (4, lines(marked, 7)), (5, fresh(9) + "\n" + lines(short, 5) + "\n" + fresh(8)), (6, lines(fresh(17) + " " + short, 11)),  # short lines
        (7, fresh(60) + " " + " ".join(edited) + " " + fresh(60)), (8, fresh(45) + " " + other + " " + fresh(70)), (9, fresh(400)), (10, fresh(29)), (11, fresh(29)),
        (12, long + " " + inner), (13, lines(long, 6)),  # longer than a block
    ]
    got = {(r.doc_id, r.position): r for r in passages.repeated_runs(edge(spark, rows)).collect()}
    want = {(1, 70): (55, 1), (2, 41): (55, 1), (3, 0): (60, 3), (4, 0): (60, 3), (5, 9): (60, 5), (6, 17): (60, 5), (7, 60): (51, 7), (8, 45): (51, 7), (12, 0): (200_055, 12), (13, 0): (200_000, 12)}
    assert {i: r.component_id for i, r in got.items()} == {i: c for i, (_, c) in want.items()}
    assert all(abs(r.n_words - want[i][0]) <= 1 and r.removed == (r.component_id < r.doc_id) for i, r in got.items())


def test_runs_keep_little_on_disk(spark):
    """Anchors are computed and dealt out by key once and spans by document once, and paragraphs are deleted when they are compared."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = passages.repeated_runs(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2 and plan.count("MapInArrow ") == 1
    folder = shared_folder(spark).rsplit("/", 1)[0].removeprefix("file:")
    left = set(glob.glob(f"{folder}/*/*.parquet"))
    assert passages.repeated_paragraphs(docs).count() and set(glob.glob(f"{folder}/*/*.parquet")) == left


def test_runs_of_words_repeated_over_and_over(spark):
    """One pair of words, thousands of times in a text, is few anchors of each text, and the run goes to its ends."""
    own, pair = [" ".join(f"{c}{k}" for k in range(20)) for c in "abcdef"], " tick tock" * 4000
    docs = edge(spark, [(k, own[k] + pair + " " + own[3 + k]) for k in range(3)])
    fields = "first int, more int, again int, key bigint, before bigint, after bigint"
    rows = passages._parts(docs, fields, passages._anchor_rows(35)).groupBy("key").count().agg(F.max("count")).first()[0]
    got = {r.doc_id: (r.position, r.n_words, r.component_id) for r in passages.repeated_runs(docs).collect()}
    assert rows < 40 and got == {k: (20, 8000, 0) for k in range(3)}


def test_runs_of_rows_without_an_id(spark):
    text = " ".join(f"w{k}" for k in range(70))
    got = passages.repeated_runs(edge(spark, [(1, text), (None, text), (2, "other words " + text), (2, "other words " + text)])).collect()
    assert {(r.doc_id, r.position, r.n_words, r.component_id, r.removed) for r in got} == {(1, 0, 70, 1, False), (2, 2, 70, 1, True)} and len(got) == 2


def test_anchors_and_signatures_of_blocks_of_texts():
    """Texts hashed together have the anchors, shingles and signatures of each text alone, counted plainly."""
    rng = np.random.default_rng(6)
    sizes = [0, 3, 15, 16, 34, 35, 36, 60, 0, 200, 5000, 16, 90]
    rows = [rng.integers(1, 1 << 63, n, dtype=np.uint64) for n in sizes] + [np.tile(rng.integers(1, 1 << 63, p, dtype=np.uint64), 30) for p in (1, 2, 3, 7)]
    h, cuts = np.concatenate(rows), np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    got = list(zip(*(x.tolist() for x in passages.anchors(h, cuts, 35)), strict=True))
    want = []
    for i, x in enumerate(rows):
        if len(x) >= 35:
            key = windows(x, 8, 0)
            at = sorted({j + min(range(9), key=lambda k: (key[j + k] >> np.uint64(20), k)) for j in range(len(key) - 8)})  # noqa: B023
            sign = [max(int(y) >> 56, 1) for y in mix(x)]
            for k in at:
                sides = [sum(y << 8 * n for n, y in enumerate(side)) for side in (sign[max(0, k - 8) : k][::-1], sign[k + 8 : k + 16])]
                last = (i, int(key[k].view(np.int64)), *(y - (1 << 64) if y >> 63 else y for y in sides))
                if want and (want[-1][0], *want[-1][4:]) == last:
                    want[-1] = (i, want[-1][1], k - want[-1][1], want[-1][3] + 1, *last[1:])
                else:
                    want.append((i, k, 0, 0, *last[1:]))
    assert got == want and Counter(r[0] for r in got)[len(sizes) + 1] < 10
    sets = shingle_sets(h, cuts, 5)
    assert all((a == shingles(x, 5)).all() and len(a) == len(set(a.tolist())) for a, x in zip(sets, rows, strict=True))
    some = [x for x in sets if len(x)]
    circle = minhash._circle(80)
    plain = np.array([circle[(x >> np.uint64(44)).astype(np.int64)].min(0) for x in some])
    assert (minhash.signatures(some, 80) == plain).all()


def test_runs_by_brute_force(spark):
    """Every document that shares 51 words in a row with another is found, and none that shares no 16 with any."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    words = {r.doc_id: re.findall(BLANK, lower(r.text)) for r in docs.collect()}

    def sharing(n):
        owner, hit = {}, set()
        for i, w in words.items():
            for k in range(len(w) - n + 1):
                j = owner.setdefault(tuple(w[k : k + n]), i)
                if j != i:
                    hit |= {i, j}
        return hit

    runs = {r.doc_id for r in passages.repeated_runs(docs).collect()}
    found = passages.repeated_passages(docs).collect()
    assert sharing(51) <= runs and runs <= sharing(16)
    kept = {r.component_id for r in found}
    assert all((r.component_id < r.doc_id) == r.removed for r in found if r.kind == "run") and kept <= set(words)


def test_paragraphs_cover_every_word_once():
    rng = np.random.default_rng(3)
    for _ in range(30):
        lines = [" ".join(f"w{k}" for k in rng.integers(0, 50, int(n))) for n in rng.choice([0, 1, 5, 12, 39, 40, 90], 40)]
        text = "\n".join(lines)
        got, all_words = passages.paragraphs(text.encode(), 40), text.split()
        assert all(p.decode().split() == all_words[at : at + n] and n >= 40 for at, n, p in got)
        assert all(a + n <= b for (a, n, _), (b, _, _) in zip(got, got[1:], strict=False))
        rest = len(all_words) - sum(n for _, n, _ in got)
        assert rest <= 40 * (1 + sum(len(x.split()) >= 40 for x in lines))
    assert passages.paragraphs(b"", 40) == []


def test_paragraph_ids_of_any_range(spark):
    rng = np.random.default_rng(2)
    para = " ".join(f"p{k}" for k in rng.integers(0, 10**6, 60))
    rows = [(-5, para), (-3, "own words\n" + para), (1 << 61, para + " more"), (None, "other " * 50)]
    got = {r.doc_id: (r.component_id, r.removed) for r in passages.repeated_paragraphs(edge(spark, rows)).collect()}
    assert got == {-5: (-5, False), -3: (-5, True), 1 << 61: (-5, True)}


def test_slots_are_long(spark):
    assert dict(sharding.shard(edge(spark)).dtypes)["slot"] == "bigint"


def test_quality_of_a_text_with_many_lines(spark):
    """One document of 200,000 distinct lines, two of them frequent on its host; equal rows are counted once each."""
    import time

    # Digits are alike to the rules, so numbers are spelled in letters.
    letters = lambda k: "".join(chr(97 + int(c)) for c in str(k))
    shared = "menu home about contact us"
    many = "\n".join([shared, *(f"line of a very long list {letters(k)}" for k in range(200_000)), shared])
    rows = [(k, f"{shared}\n" + " ".join(f"w{letters(k)}q{letters(j)}" for j in range(60)), "h") for k in range(40)] + [(100, many, "h"), (100, many, "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    quality.quality(docs.where("doc_id < 3")).collect()
    began = time.time()
    got = quality.quality(docs).collect()
    assert time.time() - began < 60  # some seconds; a quadratic run takes hours
    assert {r.removed_words for r in got if r.doc_id == 100} == {10} and {r.removed_words for r in got if r.doc_id < 40} == {5} and len(got) == 42
