"""Costs, run state and routing of responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corundum.functions.scalars import filled


def cost_ledger(usage: DataFrame, prices: DataFrame, discount: float = 1.0) -> DataFrame:
    """Usage with cost_usd: tokens times the model's prices per million; a model without price costs nothing.

    prices (model, input, output) is a short list."""
    cost = (F.col("input_tokens") * F.col("input") + F.col("output_tokens") * F.col("output")) / 1e6 * discount
    return usage.join(prices, "model", "left").select(*usage.columns, F.coalesce(cost, F.lit(0.0)).alias("cost_usd"))


def cost_rollup(costs: DataFrame) -> DataFrame:
    """Tokens and cost per paper, per stage and in total; NULL marks what a row sums over."""
    return costs.groupingSets([["paper"], ["stage"], []], "paper", "stage").agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.round(F.sum("cost_usd"), 6).alias("cost_usd"))


def checkpoint_fold(events: DataFrame) -> DataFrame:
    """The current row of each paper: last status, last path that isn't blank, last known time and error, summed cost.

    Every column is a map-side aggregate ordered by time and event id, so a paper with very many events is no hot spot."""
    order = F.struct("ts", "event_id")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order))
    e = events.withColumn("pdf_path", filled("pdf_path"))
    return e.groupBy("paper").agg(F.max_by("status", order).alias("status"), last("pdf_path").alias("pdf_path"), last("screen_time").alias("screen_time"), last("error_message").alias("error_message"), F.sum("cost_cents").alias("cost_cents"))


def checkpoint_summary(state: DataFrame) -> DataFrame:
    return state.groupBy("status").agg(F.count("*").alias("cnt"))


def cost_estimate(papers: DataFrame, unit_costs: dict[str, float], discount: float = 1.0) -> DataFrame:
    """Planned cost by stage: papers times unit price times discount."""
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), F.lit(c).alias("unit")) for s, c in unit_costs.items()])
    return papers.agg(F.count("*").alias("n")).select("n", F.explode(stages).alias("s")).select("s.stage", F.round(F.col("n") * F.col("s.unit") * discount, 6).alias("cost"))


def route_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """One artifact per paper and kind from expected requests and what came back.

    A missing, empty or incomplete response is a reason of incompleteness; reasons stand in unit order, `; ` between. Of responses that
    repeat an id, a complete one counts before others, then the one with most records, then the least text."""
    order = F.struct((~F.coalesce("response_complete", F.lit(False))).alias("open"), (-F.coalesce("n_records", F.lit(0))).alias("fewer"), "text", "response_complete", "n_records")
    r = responses.groupBy("custom_id").agg(F.min(order).alias("r")).select("custom_id", "r.text", "r.response_complete", "r.n_records")
    j = requests.join(r, "custom_id", "left")
    reason = (
        F.when(F.col("response_complete").isNull(), F.concat(F.lit("unit "), F.col("unit_no"), F.lit(": no response")))
        .when(F.coalesce(F.trim("text"), F.lit("")) == "", F.concat(F.lit("unit "), F.col("unit_no"), F.lit(": empty response")))
        .when(~F.col("response_complete"), F.concat(F.lit("unit "), F.col("unit_no"), F.lit(": incomplete response")))
    )
    j = j.withColumn("reason", reason)
    reasons = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("unit_no", "custom_id", "reason")))), lambda x: x["reason"]), "; ")
    return j.groupBy("paper_uid", "kind").agg(F.count("*").alias("units"), F.coalesce(F.sum(F.when(F.col("reason").isNull() | F.col("reason").endswith("incomplete response"), F.col("n_records"))), F.lit(0)).alias("n_records"), (F.count("reason") == 0).alias("complete"), reasons.alias("incomplete_reason"))



def better_read(records: DataFrame, tables: DataFrame, min_rows: int = 3, threshold: float = 0.5) -> DataFrame:
    """Records of the better of two reads of each table.

    records carry (paper_uid, table_id, read: text or image, is_equation); tables (paper_uid, table_id, n_rows, damaged, missing, is_equation).
    A re-read is considered if the table has min_rows rows and the text read covers less than threshold of them, is empty, or lost the header or
    conditions; equation tables are always considered. It is kept only where it has strictly more usable records."""
    value = F.col("dielectric_constant").isNotNull() & F.col("loss_factor").isNotNull()
    key = ["paper_uid", "table_id"]
    r = records.join(tables.select(*key, F.col("is_equation").alias("_eq")), key, "left").withColumn("_use", F.coalesce("_eq", F.lit(False)) | value)
    n = r.groupBy(*key).agg(*[F.count_if((F.col("read") == x) & F.col("_use")).alias(f"u_{x}") for x in ("text", "image")], F.count_if(F.col("read") == "text").alias("n_text"))
    t = tables.join(n, key, "left").na.fill(0, ["u_text", "u_image", "n_text"])
    retry = (F.col("n_rows") >= min_rows) & ((F.col("u_text") < threshold * F.col("n_rows")) | (F.col("n_text") == 0) | F.col("damaged") | F.col("missing"))
    won = t.select(*key, F.when((F.col("is_equation") | retry) & (F.col("u_image") > F.col("u_text")), "image").otherwise("text").alias("read"))
    return records.join(won, [*key, "read"], "left_semi")
