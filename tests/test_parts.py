"""Jobs that take their tables part by part: the same rows as at once, and nothing left on disk but the result."""

import os
import time

import pytest
from pyspark.sql import functions as F

from corundum.functions import lineage
from corundum.operators import assembly as A
from corundum.operators import audit as Q
from corundum.operators import evaluation as V
from corundum.plans.fixtures import frame
from corundum.sources import tables

SF = "/root/testdata/sf0.001"


def folders(spark):
    top = lineage.shared_folder(spark).removeprefix("file:")
    return {f for f in os.listdir(top) if "rdd" not in f}


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.split("_")[1] for f in (files.apply(k).getName() for k in range(files.size())) if f.startswith("shuffle_")}


@pytest.fixture
def parts(monkeypatch):
    monkeypatch.setattr(lineage, "PART_ROWS", 5000)
    monkeypatch.setattr(tables, "PART_ROWS", 2500)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_shuffles_of_what_is_written_are_deleted(spark):
    before = shuffles(spark)
    out = lineage.cut(spark.range(20_000).groupBy((F.col("id") % 7_000).alias("k")).agg(F.count("*").alias("n")))
    for _ in range(50):  # they go beside the job
        if not (left := shuffles(spark) - before):
            break
        time.sleep(0.2)
    assert not left and out.count() == 7_000


def test_only_the_result_of_parts_stays(spark, parts):
    d = lineage.cut(spark.range(10_000).select("id", (F.col("id") % 100).alias("k")))
    before = folders(spark)
    out = lineage.by_parts(lambda x, y: lineage.cut(x.groupBy("k").agg(F.count("*").alias("n"))).join(y.groupBy("k").agg(F.max("id").alias("most")), "k"), (d, F.col("k")), (d, F.col("k")))
    assert rows(out) == rows(d.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("most")))
    assert len(folders(spark) - before) == 1


def test_assembly_by_parts(spark, monkeypatch):
    """All spellings of a material, and those that aliases name, are in one part."""
    records, papers = frame(spark, SF, "records"), frame(spark, SF, "papers")
    names = [r[0].strip() for r in frame(spark, SF, "part").select("p_name").distinct().orderBy("p_name").limit(4).collect()]
    aliases = {names[0].upper(): names[1], names[2]: "Something  new"}
    whole = rows(A.assemble_records(records, papers, aliases=aliases))
    monkeypatch.setattr(lineage, "PART_ROWS", 2500)
    assert rows(A.assemble_records(records, papers, aliases=aliases)) == whole


def test_duplicates_are_found_with_one_shuffle(spark):
    records = lineage.cut(frame(spark, SF, "records").where("dielectric_constant > 0"))
    plan = A.dedup_records(records)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_negative_zero_is_zero_in_duplicates(spark):
    r = frame(spark, SF, "records").where("temperature_c is not null and frequency_mhz is not null").limit(1)
    two = r.withColumn("temperature_c", F.lit(-0.3)).unionByName(r.withColumn("temperature_c", F.lit(0.3)))
    assert A.dedup_records(two).count() == 1


def test_a_table_is_appended_to_in_batches_of_buckets(spark, parts):
    records, folder = frame(spark, SF, "records"), lineage.scratch(spark)
    before = folders(spark)
    tables.append_to_table(records.where("year % 2 = 0"), folder, 8)
    tables.append_to_table(records.where("year % 2 <> 0"), folder, 8)
    assert rows(tables.read_table(spark, folder)) == rows(A.dedup_records(records))
    assert folders(spark) - before == {folder.rpartition("/")[2]}
    assert tables._batches([1, 2, 3, 4], {1: 2000, 2: 400, 3: 9000, 4: 1}) == [[1, 2], [3], [4]]


def test_matching_by_parts(spark, parts):
    gold, pred = (lineage.cut(frame(spark, SF, t)) for t in ("gold", "pred"))
    got = rows(V.match_candidates(gold, pred))
    before = folders(spark)
    m = V.match_records(gold, pred)
    assert len(folders(spark) - before) == 1  # the pairs
    lineage.PART_ROWS = 1 << 40
    assert got == rows(V.match_candidates(gold, pred))
    cost = lambda m: m.where("kind = 'tp'").join(V.match_candidates(gold, pred), ["gold_id", "pred_id"]).agg(F.count("*"), F.round(F.sum("score"), 6)).first()
    assert cost(m) == cost(V.match_records(gold, pred))


def test_review_by_parts(spark, monkeypatch):
    records = lineage.cut(A.loss_tangent(frame(spark, SF, "records")))
    whole = rows(Q.audit_review(records, page=20))
    monkeypatch.setattr(lineage, "PART_ROWS", 3000)
    before = folders(spark)
    assert rows(Q.audit_review(records, page=20)) == whole
    assert len(folders(spark) - before) == 2  # the records and the requests
