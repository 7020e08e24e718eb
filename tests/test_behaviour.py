"""Behaviour that the driver tables don't show: small rows with known answers."""

import itertools
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corundum.functions import scalars as S
from corundum.functions.lineage import scratch
from corundum.operators import assembly as A
from corundum.operators import audit as Q
from corundum.operators import equations as E
from corundum.operators import evaluation as V
from corundum.operators import responses as R
from corundum.operators import state as R_STATE
from corundum.operators import tables as B
from corundum.operators import text as T
from corundum.operators.flows import cheapest_flow, numbered
from corundum.schema import COLUMNS, OUTPUT
from corundum.sources import corpus, tables
from corundum.streaming import runs

SCHEMA = ", ".join(f"{c} {t}" for c, t in OUTPUT)


def record(**facts):
    row = dict.fromkeys(COLUMNS) | {"material_name": "apple", "frequency_mhz": 915.0, "temperature_c": 20.0, "paper_uid": "a" * 12, "data_provenance": "measured_table"} | facts
    return tuple(row[c] for c in COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_split_halves_merge_only_when_unambiguous(spark):
    d = record(dielectric_constant=60.0, source_table="T1")
    x = record(loss_factor=12.0, source_table="T2", loss_tangent=0.2)
    got = A.merge_split(frame(spark, d, x)).collect()
    assert len(got) == 1 and got[0].loss_factor == 12.0 and got[0].source_table == "T1; T2" and got[0].loss_tangent == 0.2
    assert A.merge_split(frame(spark, d, x, x)).count() == 3
    assert A.merge_split(frame(spark, d, x, record(dielectric_constant=1.0, loss_factor=1.0))).count() == 3
    unknown = [record(dielectric_constant=60.0, frequency_mhz=None), record(loss_factor=12.0, frequency_mhz=None)]
    assert A.merge_split(frame(spark, *unknown)).count() == 1


def test_duplicates_keep_the_better_source_and_complete_rows(spark):
    rows = [record(dielectric_constant=60.0, loss_factor=12.0, data_provenance="measured_text"), record(dielectric_constant=60.01, loss_factor=12.0), record(dielectric_constant=59.0), record(dielectric_constant=59.0, frequency_mhz=None), record(dielectric_constant=61.0, loss_factor=9.0, moisture_content_pct=50.0)]
    got = A.dedup_records(frame(spark, *rows))
    assert sorted((r.dielectric_constant, r.frequency_mhz) for r in got.collect()) == [(59.0, None), (61.0, 915.0)]
    again = A.dedup_records(A.dedup_records(frame(spark, *reversed(rows)).repartition(3)))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_overrides_reject_unknown_columns(spark):
    with pytest.raises(ValueError):
        A.apply_overrides(frame(spark, record()), rules=[{"where": {"nothing": 1}, "drop": True}])


def test_strict_coverage_raises(spark):
    ledger = spark.createDataFrame([("no_parse_artifact", 0)], "outcome string, assembled_records bigint")
    with pytest.raises(RuntimeError):
        A.coverage_summary(ledger, strict=True)


def test_export_of_an_empty_table_has_its_schema(spark, tmp_path):
    tables.export_dataset(frame(spark), str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "parquet")).columns == COLUMNS


def brute_flow(edges, supply, room):
    """Most units, then least cost, over all one-to-one choices of single units."""
    left = [i for i, n in enumerate(supply) for _ in range(n)]
    right = [j for j, n in enumerate(room) for _ in range(n)]
    cost, best = {(i, j): c for i, j, c in edges}, (0, 0.0)
    for choice in itertools.product([None, *range(len(right))], repeat=len(left)):
        used = [c for c in choice if c is not None]
        if len(used) == len(set(used)) and all(c is None or (left[k], right[c]) in cost for k, c in enumerate(choice)):
            best = max(best, (len(used), -sum(cost[left[k], right[c]] for k, c in enumerate(choice) if c is not None)))
    return best


def random_flow(rng, most):
    n, m = rng.integers(1, 4, 2)
    supply, room = ([int(x) for x in rng.integers(1, most, k)] for k in (n, m))
    return [(i, j, float(rng.integers(0, 20))) for i in range(n) for j in range(m) if rng.random() < 0.6], supply, room


def test_flows_are_optimal():
    rng = np.random.default_rng(3)
    for k in range(120):
        edges, supply, room = random_flow(rng, 2 if k % 2 else 3)
        if sum(supply) > 5 or sum(room) > 6:
            continue
        flow = cheapest_flow(edges, supply, room)
        for own, most in ((0, supply), (1, room)):
            assert all(sum(f for e, f in zip(edges, flow, strict=True) if e[own] == i) <= n for i, n in enumerate(most))
        assert min(flow, default=0) >= 0
        assert (sum(flow), -sum(f * e[2] for f, e in zip(flow, edges, strict=True))) == brute_flow(edges, supply, room)


def test_larger_flows_have_no_cheaper_exchange():
    """Against a plain Hungarian-free check: a flow is cheapest if its residual network has no negative cycle, and most if it has no path to free room."""
    rng = np.random.default_rng(9)
    for _ in range(5):
        n, m = 25, 30
        edges = [(i, j, float(rng.integers(0, 60))) for i in range(n) for j in range(m) if rng.random() < 0.3]
        supply, room = rng.integers(1, 5, n).tolist(), rng.integers(1, 4, m).tolist()
        flow = cheapest_flow(edges, supply, room)
        sent = [sum(f for e, f in zip(edges, flow, strict=True) if e[0] == i) for i in range(n)]
        got = [sum(f for e, f in zip(edges, flow, strict=True) if e[1] == j) for j in range(m)]
        assert all(a <= b for a, b in zip(sent + got, supply + room, strict=True))
        # Source n + m, sink n + m + 1; Bellman-Ford over residual arcs.
        arcs = [a for (i, j, c), f in zip(edges, flow, strict=True) for a in ((i, n + j, c), *([(n + j, i, -c)] if f else []))]
        arcs += [(n + m, i, 0) for i in range(n) if sent[i] < supply[i]] + [(i, n + m, 0) for i in range(n) if sent[i]]
        arcs += [(n + j, n + m + 1, 0) for j in range(m) if got[j] < room[j]] + [(n + m + 1, n + j, 0) for j in range(m) if got[j]]
        for start, limit in ((0.0, None), (float("inf"), n + m + 1)):
            dist = [start] * (n + m + 2)
            dist[n + m] = 0.0
            for _ in range(n + m + 3):
                changed = False
                for v, w, c in arcs:
                    if dist[v] + c < dist[w] - 1e-9:
                        dist[w], changed = dist[v] + c, True
            assert not changed and (limit is None or dist[limit] == float("inf"))


MATCHED = "{} bigint, paper_key string, material_name string, frequency_mhz double, temperature_c double, moisture_content_pct double, moisture_basis string, salt_content string, electrical_conductivity_s_m double"


def test_equal_rows_are_one_class(spark):
    """20,000 equal rows on each side would be 400 million pairs; as classes they are one, and every row finds a partner."""
    side = lambda name, n, temperature: spark.range(n).select(F.col("id").alias(name), F.lit("p1").alias("paper_key"), F.lit("apple").alias("material_name"), F.lit(915.0).alias("frequency_mhz"), F.lit(temperature).alias("temperature_c"), *[F.lit(None).cast(t).alias(c) for c, t in (("moisture_content_pct", "double"), ("moisture_basis", "string"), ("salt_content", "string"), ("electrical_conductivity_s_m", "double"))])
    gold = side("gold_id", 20_000, 20.0).union(side("gold_id", 500, 22.0).withColumn("gold_id", F.col("gold_id") + 50_000))
    pred = side("pred_id", 15_000, 20.0).union(side("pred_id", 6_000, 21.0).withColumn("pred_id", F.col("pred_id") + 50_000))
    m = V.match_records(gold, pred).cache()
    assert {r.kind: r["count"] for r in m.groupBy("kind").count().collect()} == {"tp": 20_500, "fp": 500}
    assert m.select("gold_id").where("gold_id is not null").distinct().count() == 20_500 and m.select("pred_id").distinct().count() == 21_000
    # The cheapest: all 15,000 at the same temperature are matched there.
    assert m.where("kind = 'tp' and pred_id < 50000 and gold_id < 50000").count() == 15_000


def test_matches_of_rows_and_of_classes_cost_the_same(spark):
    rng = np.random.default_rng(11)
    pick = lambda *x: x[rng.integers(len(x))]
    make = lambda k: [(i, f"p{i % 3}", pick("apples", "apple juice", "pear", None, "sweet apple juice"), pick(27.0, 27.12, 915.0, 2450.0, 0.0), float(pick(20, 21, 22.5)), pick(None, 10.0, 11.5), "wet", pick(None, "1%"), None) for i in range(k)]
    gold, pred = (spark.createDataFrame(make(n), MATCHED.format(c)) for n, c in ((90, "gold_id"), (80, "pred_id")))
    pairs = V.match_candidates(gold, pred).cache()
    one, other = V.match_records(gold, pred), V.match_records(gold, pred, pairs)
    cost = lambda m: m.where("kind = 'tp'").join(pairs, ["gold_id", "pred_id"]).agg(F.count("*"), F.round(F.sum("score"), 6)).first()
    assert cost(one) == cost(other) and cost(one)[0] == one.where("kind = 'tp'").count() > 30
    assert pairs.count() == pairs.distinct().count()


def test_joined_rows_are_the_candidates(spark):
    """Labels that share only a frequent word never meet: what the join gives is the pairs themselves."""
    labels = spark.range(400).select(F.lit("p").alias("paper_key"), F.concat(F.lit("dried sample corn kind"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("label"))
    assert V.label_pairs(labels, labels).count() == 400
    few = spark.createDataFrame([("p", x) for x in ("", "a", "a b", "b c", "a b c", "d")], "paper_key string, label string")
    got = {(r.p_label, r.g_label) for r in V.label_pairs(few, few).collect()}
    words = ["", "a", "a b", "b c", "a b c", "d"]
    assert got == {(x, y) for x in words for y in words if not x or not y or set(x.split()) <= set(y.split()) or set(y.split()) <= set(x.split())}
    assert V.label_pairs(few, few).count() == len(got)


def test_numbering_covers_a_hot_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("key"), "id")
    got = numbered(rows, "key", "id").groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("nth").alias("d"), F.max("nth").alias("m")).collect()
    assert all(r.n == r.d == r.m + 1 for r in got) and len(got) == 8


def test_shared_folder_is_needed_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context

    with pytest.raises(ValueError, match="checkpoint"):
        scratch(Session)


def test_candidates_agree_with_all_pairs(spark):
    rng = np.random.default_rng(5)
    pick = lambda *x: x[rng.integers(len(x))]
    make = lambda k: [(i, "p1", pick("apples", "apple juice", "pear", None), pick(27.0, 27.12, 915.0, 2450.0, 0.0, None), float(pick(20, 21, 22.5, 30)), pick(None, 10.0, 11.5, 60.0), "wet", pick(None, "1%", "2%"), pick(None, 0.5)) for i in range(k)]
    gold, pred = make(40), make(40)
    got = {(r.gold_id, r.pred_id) for r in V.match_candidates(spark.createDataFrame(gold, MATCHED.format("gold_id")), spark.createDataFrame(pred, MATCHED.format("pred_id"))).collect()}

    def fits(g, p):
        if None in (g[3], p[3]) or (g[3] > 0 and abs(p[3] - g[3]) / g[3] > 0.05) or abs(g[4] - p[4]) > 2:
            return False
        words = [{"apples": {"apple"}, "apple juice": {"apple", "juice"}, "pear": {"pear"}, None: set()}[x[2]] for x in (g, p)]
        if words[0] and words[1] and not (words[0] <= words[1] or words[1] <= words[0]):
            return False
        return not (None not in (g[5], p[5]) and abs(g[5] - p[5]) > 2) and not (None not in (g[7], p[7]) and g[7] != p[7])

    assert got == {(g[0], p[0]) for g in gold for p in pred if fits(g, p)}


def test_salvage():
    whole = {"material_name": "a ] } b"}
    cut = '{"records": [' + json.dumps(whole) + ", " + json.dumps(whole) + ', {"material_na'
    assert json.loads(R.salvage(cut))["records"] == [whole, whole]
    assert json.loads(R.salvage("nothing here"))["records"] == []


def test_salvage_keeps_what_is_complete():
    load = lambda t: json.loads(R.salvage(t))
    assert load('{"records": [{"a": 1}, {"b": {"c": [1, 2]}}], "notes": "the end is mis')["records"] == [{"a": 1}, {"b": {"c": [1, 2]}}]
    assert load('{"equations": [{"a": "x \\" ]} y"}, {"b": {"c": 1}, "d": ')["equations"] == [{"a": 'x " ]} y'}]
    assert load('{"records": [{"a": 1}] trailing')["records"] == [{"a": 1}]
    for none in ("", "{", '{"records": [', '{"records": [{"a": 1', "]}"):
        assert load(none)["records"] == []


def test_strict_windows(spark):
    texts = {"a": '{"records": [{"material_name": "x"}]}', "b": '[{"material_name": "y"}]', "c": '{"records": [{"material_name": "z"}', "d": '{"records": 7}', "e": '{"notes": "none"}', "f": '{"records": null}', "g": None}
    d = spark.createDataFrame(list(texts.items()), "custom_id string, text string")
    got = {r.custom_id: r for r in R.parse_responses(d, strict=True).collect()}
    assert {k for k, r in got.items() if r.response_complete} == {"a", "e"} and [r.material_name for r in got["a"].payload.records] == ["x"]
    assert all(r.payload is None for k, r in got.items() if k not in "ae")


def test_malformed_records(spark):
    rec = lambda **x: json.dumps({"material_name": "m", "dielectric_constant": 3.5} | x)
    texts = [("t1", f'{{"records": [{rec()}, {rec(loss_factor="much")}, {rec(loss_tangent="n.d.")}, {rec(loss_tangent="big")}]}}'), ("t2", f'{{"records": [{rec()}]}}')]
    parsed = R.parse_responses(spark.createDataFrame(texts, "custom_id string, text string"))
    requests = spark.createDataFrame([("t1", "p1", "x"), ("t2", "p2", "x")], "custom_id string, paper_uid string, model string")
    papers = spark.createDataFrame([("p1", "d1"), ("p2", "d2")], "paper_uid string, doi string")
    assert sorted(r.paper_uid for r in R.records_from_responses(parsed, requests, papers).collect()) == ["p1", "p1", "p2"]
    assert [r.paper_uid for r in R.records_from_responses(parsed, requests, papers, "measured_text").collect()] == ["p2"]


def test_responses_in_fences_and_bare_arrays(spark):
    d = spark.createDataFrame([("a", 'So:\n```json\n{"records": [{"material_name": "x"}]}\n```\nok'), ("b", '[{"material_name": "y"}]'), ("c", '{"records": [{"material_name": "z"}, {"mat'), ("d", None)], "custom_id string, text string")
    got = {r.custom_id: r for r in R.parse_responses(d).collect()}
    assert [r.material_name for r in got["a"].payload.records] == ["x"] and got["a"].response_complete
    assert [r.material_name for r in got["b"].payload.records] == ["y"]
    assert [r.material_name for r in got["c"].payload.records] == ["z"] and not got["c"].response_complete
    assert not got["d"].response_complete


FORMULAS = ["3 + T**2", "sqrt(M)", "__import__('os')", "T / 0", "1 / (1 / (T - 2))", "-T**2 + +M*(T - 1)/3", "exp(1000) * 0", "log(M) - log10(100) + abs(-T)", "pow(T, 0.5) * log(M, 3)", "log(0)", "(-8)**0.5", "T +", "T.real", "Q + 1", "True + 1", "2", "", None, "sqrt(T, M)", "S + 1"]


def by_hand(text, at):
    """A formula run one operation at a time, as plain Python would."""
    import ast
    import math
    import operator as o

    two = {ast.Add: o.add, ast.Sub: o.sub, ast.Mult: o.mul, ast.Div: o.truediv, ast.Pow: o.pow}
    calls = {"exp": math.exp, "log": math.log, "log10": math.log10, "sqrt": math.sqrt, "abs": abs, "pow": pow}

    def run(n):
        if isinstance(n, ast.Constant) and type(n.value) in (int, float):
            return float(n.value)
        if isinstance(n, ast.Name):
            return float(at[n.id])
        if isinstance(n, ast.UnaryOp):
            return {ast.USub: o.neg, ast.UAdd: o.pos}[type(n.op)](run(n.operand))
        if isinstance(n, ast.BinOp):
            return float(two[type(n.op)](run(n.left), run(n.right)))
        if isinstance(n, ast.Call):
            return float(calls[n.func.id](*map(run, n.args)))
        raise ValueError

    try:
        got = run(ast.parse(text, mode="eval").body)
        return got if math.isfinite(got) else None
    except (ValueError, SyntaxError, TypeError, KeyError, AttributeError, ArithmeticError):
        return None


def test_formulas_run_natively(spark):
    points = [{"T": 2.0, "M": 9.0}, {"T": 30.0, "M": 0.25}, {"T": -1.0, "M": 0.0}]
    rows = [(k, f, p["T"], p["M"]) for f in FORMULAS for k, p in enumerate(points)]
    df = spark.createDataFrame(rows, "k int, expression string, T double, M double")
    at = {v: F.col(v) if v in "TM" else F.lit(None).cast("double") for v in E.VARIABLES}
    done = E.compiled(df).withColumn("value", E.run_formula(F.col("code"), at))
    got = {(r.k, r.expression): r.value for r in done.collect()}
    assert len(got) == len(rows)
    for f in FORMULAS:
        for k, p in enumerate(points):
            want = by_hand(f, p)
            assert (want is None and got[k, f] is None) or got[k, f] == pytest.approx(want, rel=1e-12), f


def test_formulas_of_random_trees(spark):
    rng = np.random.default_rng(2)

    def tree(depth):
        if depth == 0 or rng.random() < 0.2:
            return str(rng.choice(["T", "M", "2", "0.5", "10"]))
        if rng.random() < 0.25:
            return f"{rng.choice(['sqrt', 'exp', 'log', 'abs'])}({tree(depth - 1)})"
        return f"({tree(depth - 1)} {rng.choice(['+', '-', '*', '/', '**'])} {tree(depth - 1)})"

    texts = sorted({tree(4) for _ in range(150)})
    df = spark.createDataFrame([(t, 3.0, 0.7) for t in texts], "expression string, T double, M double")
    at = {v: F.col(v) if v in "TM" else F.lit(None).cast("double") for v in E.VARIABLES}
    for r in E.compiled(df).withColumn("value", E.run_formula(F.col("code"), at)).collect():
        want = by_hand(r.expression, {"T": 3.0, "M": 0.7})
        assert (want is None and r.value is None) or r.value == pytest.approx(want, rel=1e-9), r.expression


def test_first_response_of_a_repeated_id(spark):
    """Whatever order the rows come in, the complete one with most records is taken."""
    requests = spark.createDataFrame([("c1", "p", 1, "text")], "custom_id string, paper_uid string, unit_no bigint, kind string")
    answers = [("c1", "b", False, 9), ("c1", "a", True, 2), ("c1", "z", True, 5), ("c1", None, None, 1)]
    for order in (answers, answers[::-1], answers[2:] + answers[:2]):
        r = spark.createDataFrame(list(order), "custom_id string, text string, response_complete boolean, n_records bigint").repartition(3)
        assert [(x.complete, x.n_records) for x in R_STATE.route_responses(requests, r).collect()] == [(True, 5)]


def equation(**facts):
    base = dict.fromkeys("paper_uid eq_no material_name property variables subscripts terms expression coefficients variable domain frequency_mhz r_squared source_table".split()) | {"paper_uid": "p", "eq_no": 1, "material_name": "corn", "property": "dielectric_constant", "frequency_mhz": 915.0, "source_table": "Table 2"}
    return tuple((base | facts).values())


EQUATIONS = "paper_uid string, eq_no bigint, material_name string, property string, variables map<string,string>, subscripts map<string,string>, terms array<struct<coef:string,vars:map<string,int>>>, expression string, coefficients array<string>, variable string, domain map<string,array<double>>, frequency_mhz double, r_squared double, source_table string"
PAPER = "paper_uid string, moisture_basis string, moisture_levels_pct array<double>, moisture_range_pct struct<lo:double,hi:double>, temperature_range_c struct<lo:double,hi:double>, measurement_frequencies_mhz array<double>"


def test_models_become_records(spark):
    rows = [equation(coefficients=["2", "0.5"], domain={"temp": [20.0, 40.0]}), equation(eq_no=2, property="loss_factor", coefficients=["1", "− 1 × 10 - 1"]), equation(eq_no=3, material_name="bad", coefficients=["1", None]), equation(eq_no=4, material_name="odd", coefficients=["1"], variable="mass")]
    papers = spark.createDataFrame([("p", "wet", [], None, (20.0, 40.0), [])], PAPER)
    models = E.build_models(spark.createDataFrame(rows, EQUATIONS))
    assert sorted(r.eq_no for r in models.collect()) == [1, 2]
    got = sorted((r.temperature_c, r.dielectric_constant, r.loss_factor) for r in E.evaluate_models(models, papers).collect())
    assert got == [(20.0, 12.0, None), (30.0, 17.0, None), (40.0, 22.0, None)]


def test_subscripts_and_expressions_agree(spark):
    order = {"1": "moisture", "2": "temperature"}
    rows = [equation(variables=order, subscripts={"a0": "1", "a1": "0.5", "a12": "0.01", "a7": "9"}), equation(eq_no=2, material_name="same", variables=order, expression="eps = 1 + 0.5*M + 0.01*M*T")]
    papers = spark.createDataFrame([("p", "wet", [10.0, 20.0], None, None, [])], PAPER)
    got = {}
    for r in E.evaluate_models(E.build_models(spark.createDataFrame(rows, EQUATIONS)), papers).collect():
        got.setdefault(r.material_name, set()).add((r.temperature_c, r.moisture_content_pct, r.dielectric_constant))
    assert len(got["corn"]) == 18 and got["corn"] == got["same"]


def test_windows_cover_the_text(spark):
    text = "".join(chr(97 + i % 26) for i in range(5000))
    d = spark.createDataFrame([("a", text), ("b", ""), ("c", None)], "paper_uid string, text string")
    got = T.text_windows(d, 2000, 200).orderBy("paper_uid", "window_no").collect()
    mine = [r.text for r in got if r.paper_uid == "a"]
    assert mine[0] + "".join(x[200:] for x in mine[1:]) == text and len(got) == len(mine) + 2


def chunks(rows, most):
    """Sizes of chunks by reading the rule off, one row after the other."""

    def groups(col):
        out, prev = [], None
        for r in rows:
            v = r[col].strip()
            if out and v and prev is not None and v != prev:
                out.append(1)
            elif out:
                out[-1] += 1
            else:
                out = [1]
            prev = v or prev
        return out

    if len(rows) <= most:
        return [len(rows)]
    g = groups(0)
    if len(g) == 1:
        fit = [x for x in map(groups, range(len(rows[0]))) if len(x) >= 2 and max(x) <= most]
        g = max(fit, key=len) if fit else g
    packed = []
    for n in g:
        if packed and packed[-1] + n <= most:
            packed[-1] += n
        else:
            packed.append(n)
    return [min(most, n - k) for n in packed for k in range(0, n, most)]


def test_chunks(spark):
    rng = np.random.default_rng(2)
    made = [(f"t{i}", [[str(rng.integers(0, 3)) if rng.random() < 0.6 else "", str(k // int(rng.integers(2, 6))), "x"] if i % 3 else ["", str(k // 4), "x"] for k in range(int(rng.integers(1, 40)))]) for i in range(30)]
    got = B.chunk_tables(spark.createDataFrame(made, "table_id string, rows array<array<string>>"), 12).orderBy("table_id", "chunk_no").collect()
    for name, rows in made:
        mine = [r.rows for r in got if r.table_id == name]
        assert [len(x) for x in mine] == chunks(rows, 12) and [y for x in mine for y in x] == rows


def test_tables_are_classified_by_the_first_rule_that_speaks(spark):
    made = [("a", "p", "Penetration depth", [["Dp (mm)", "27 MHz"]], [["1", "2"]]), ("b", "p", "Dielectric properties", [["T"]], [["1"]]), ("c", "p", "Density", [["x"]], [["1"]]), ("d", "p", "Fit", [["Regression"]], [["1"]])]
    papers = spark.createDataFrame([("p", [], [])], "paper_uid string, data_tables array<string>, skip_tables array<string>")
    got = {r.table_id: r.decision for r in B.classify_tables(spark.createDataFrame(made, "table_id string, paper_uid string, caption string, headers array<array<string>>, rows array<array<string>>"), papers).collect()}
    assert got == {"a": False, "b": True, "c": False, "d": True}


def test_request_ids(spark):
    d = spark.createDataFrame([("ok_1",), ("a/b",), ("a b",), ("x" * 80,)], "c string").select(T.sanitize_custom_id("c").alias("i"))
    ids = [r.i for r in d.collect()]
    assert ids[0] == "ok_1" and len(set(ids)) == 4 and max(map(len, ids)) == 64


def test_file_identity(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, body in (("b.pdf", b"same"), ("sub/A.PDF", b"same"), ("c.pdf", b"other"), ("d.txt", b"same")):
        (tmp_path / name).write_bytes(body)
    got = corpus.corpus_dedup(corpus.read_files(spark, str(tmp_path))).collect()
    assert sorted(r.path.rpartition("/")[2] for r in got) == ["b.pdf", "c.pdf"]


def test_reference_files(spark, tmp_path):
    (tmp_path / "g.csv").write_text("Paper ID,Frequency_MHz,Temperature_C,Dielectric_Constant,Loss_Factor\n1. My_paper,915,20,60.5 ± 1,n.d.\n")
    row = tables.load_reference(spark, [str(tmp_path / "g.csv")]).first()
    assert (row.paper_key, row.frequency_mhz, row.dielectric_constant, row.loss_factor) == ("my paper", 915.0, 60.5, None)
    with pytest.raises(ValueError):
        tables.normalize_columns(spark.createDataFrame([(1,)], "paper_id int"))


def test_scalars(spark):
    d = spark.createDataFrame([("data\\x\\1. My_Paper.PDF", "7. my-paper", "abcdef012345__some_slug")], "p string, l string, a string")
    r = d.select(S.normalize_paper_path("p").alias("p"), S.normalize_paper_label("l").alias("l"), S.split_artifact_name("a").alias("a"), S.slugify(F.lit("A b/c")).alias("s"), S.is_uid(F.lit("abc")).alias("u")).first()
    assert (r.p, r.l, r.a.uid, r.a.slug, r.s, r.u) == ("my paper", "my paper", "abcdef012345", "some_slug", "A_b_c", False)


def test_append_in_a_stream(spark, tmp_path):
    """append_assemble as the body of foreachBatch: the table after two batches is the table of all rows."""
    rows = [record(dielectric_constant=60.0 + k % 3, loss_factor=5.0, paper_uid=str(k % 2) * 12) for k in range(12)]
    for k in range(2):
        frame(spark, *rows[k::2]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    seen = []

    def body(batch, _):
        seen.append(tables.append_assemble(seen[-1] if seen else batch.limit(0), batch).cache())
        seen[-1].count()

    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).writeStream.foreachBatch(body).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    stream.awaitTermination(60)
    assert sorted(map(str, seen[-1].collect())) == sorted(map(str, A.dedup_records(frame(spark, *rows)).collect()))


def table_rows(df):
    return sorted(df.select(*COLUMNS).collect(), key=repr)


def test_append_rewrites_touched_buckets_only(spark, tmp_path):
    """The files of other buckets stay, repeated batches and empty ones change nothing, and the table is that of all rows at once."""
    path = str(tmp_path / "table")
    old = [record(material_name=f"m{k}", dielectric_constant=50.0 + k % 3, loss_factor=5.0 if k % 4 else None, moisture_content_pct=None if k % 2 else 80.0) for k in range(60)]
    new = [record(material_name="m7", dielectric_constant=51.0, loss_factor=6.0, moisture_content_pct=70.0), record(material_name="m8", loss_factor=9.0, frequency_mhz=None)]
    assert tables.append_to_table(frame(spark), path, 16) == [] and len(tables.append_to_table(frame(spark, *old), path, 16)) > 8
    files = lambda: {f for f in (tmp_path / "table").rglob("*.parquet")}
    before, touched = files(), tables.append_to_table(frame(spark, *new), path, 16)
    assert len(touched) <= 2
    assert {f for f in before - files()} == {f for f in before if int(f.parent.name.split("=")[1]) in touched}
    want = table_rows(A.dedup_records(frame(spark, *old, *new)))
    assert table_rows(tables.read_table(spark, path)) == want
    assert tables.append_to_table(frame(spark, *new), path, 16) == touched and tables.append_to_table(frame(spark), path, 16) == []
    assert table_rows(tables.read_table(spark, path)) == want


def test_append_stream(spark, tmp_path):
    rows = [record(material_name=f"m{k % 5}", dielectric_constant=50.0, loss_factor=None if k % 3 else 5.0, data_provenance="measured_table" if k % 2 else "text") for k in range(30)]
    frame(spark, *rows).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    runs.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "c"), 4).trigger(availableNow=True).start().awaitTermination()
    assert table_rows(tables.read_table(spark, str(tmp_path / "out"))) == table_rows(A.dedup_records(frame(spark, *rows)))


def test_fold_stream_takes_late_events_and_goes_on(spark, tmp_path):
    """Events that arrive late, tie in time or come after a restart end in the batch result."""
    schema = "paper string, event_id long, ts long, status string, pdf_path string, screen_time long, error_message string, cost_cents long"
    rows = [(f"p{k % 3}", k, k // 4, f"s{k}", f"f{k}" if k % 5 == 0 else " ", k if k % 7 == 0 else None, None, k) for k in range(40)]
    for part, keep in enumerate((lambda k: k >= 20, lambda k: k % 2, lambda k: not k % 2)):
        batch = [r for r in rows if (r[1] >= 20) == (part == 0) and (part == 0 or keep(r[1]))]
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        runs.fold_stream(events, str(tmp_path / "out"), str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    want = R_STATE.checkpoint_fold(spark.createDataFrame(rows, schema))
    assert sorted(runs.current_state(spark, str(tmp_path / "out")).select(*want.columns).collect()) == sorted(want.collect())


def test_requests_are_bounded_and_lose_no_flag(spark):
    """A paper with many flags, equal ones too, has pages whose numbers go on; row limits hold for each paper."""
    rows = [record(dielectric_constant=0.5, loss_factor=1.0, temperature_c=float(k % 50)) for k in range(500)] + [record(paper_uid="b" * 12, dielectric_constant=0.2, loss_factor=-1.0)]
    r = frame(spark, *rows)
    flags = Q.audit_negative(r)
    got = Q.audit_review_requests(flags, r, limit=7, page=60).collect()
    assert sorted((x.paper_key[0], x.page, x.n_flags) for x in got) == [("a", k, min(60, 500 - 60 * k)) for k in range(9)] + [("b", 0, 2)]
    assert all(len(x.prompt.split("\nROWS\n")[1].split("\n")) == (7 if x.paper_key[0] == "a" else 1) for x in got)
    numbered = Q.number_flags(flags).collect()
    assert sorted(x.n for x in numbered if x.paper_key[0] == "a") == list(range(1, 501)) and len(numbered[0]) == len(flags.columns) + 1
    assert Q.audit_review_requests(flags.limit(0), r).count() == 0


def test_condition_rules_take_null_keys_and_ties(spark):
    """Groups whose keys are NULL are groups as well; the first row of equal ones is named, and the lowest frequency of the largest value."""
    none = {"temperature_c": None, "moisture_content_pct": None}
    rows = [record(**none, frequency_mhz=f, dielectric_constant=d, loss_factor=1.0, source_table=t) for f, d, t in ((27.0, 10.0, "T2"), (27.0, 10.0, "T1"), (2450.0, 60.0, "T3"), (915.0, 60.0, "T4"), (915.0, 30.0, "T5"))]
    got = {x.rule_id: x for x in Q.audit_report(frame(spark, *rows)).collect() if x.severity == "CRITICAL"}
    assert set(got) == {"FREQ_INVERSION", "DUPLICATE_DIVERGE"}
    assert got["FREQ_INVERSION"].source_table == "T1" and "at 915 MHz" in got["FREQ_INVERSION"].description
    assert got["DUPLICATE_DIVERGE"].source_table == "T5" and got["DUPLICATE_DIVERGE"].current_value == "30.0–60.0"
    assert Q.audit_report(frame(spark)).count() == 0
