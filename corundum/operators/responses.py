"""Model responses to records."""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.scalars import barrier, filled, ism_normalize

#: Numbers are read as strings first, so that one that is none is told from one that is missing.
RECORD = (
    "struct<material_name:string,frequency_mhz:string,temperature_c:string,dielectric_constant:string,loss_factor:string,loss_tangent:string,"
    "moisture_content_pct:string,moisture_basis:string,salt_content:string,electrical_conductivity_s_m:string,measurement_method:string,"
    "source_table:string,source_location:string>"
)
PAYLOAD = f"struct<records:array<{RECORD}>,data:array<{RECORD}>,notes:string>"


def unfenced(text: str | Column) -> Column:
    """The JSON part of a response: inside a code fence if there is one, from the first bracket to the last of its kind."""
    t = F.trim(F.col(text) if isinstance(text, str) else text)
    inner = F.when(t.contains("```json"), F.regexp_extract(t, r"(?s)```json(.*?)(?:```[^`]*)?$", 1)).when(t.contains("```"), F.regexp_extract(t, r"(?s)```[a-z]{0,4}\n?(.*?)(?:```[^`]*)?$", 1)).otherwise(t)
    brace, bracket = F.instr(inner, "{"), F.instr(inner, "[")
    array = (bracket > 0) & ((brace == 0) | (bracket < brace))
    cut = lambda a, b: F.when(inner.rlike(f"(?s)\\{a}.*\\{b}"), F.regexp_extract(inner, f"(?s)(\\{a}.*\\{b})", 1)).otherwise(F.regexp_extract(inner, f"(?s)(\\{a}.*)", 1))
    return F.trim(F.when(array, cut("[", "]")).when(brace > 0, cut("{", "}")).otherwise(inner))


#: A string, or a bracket outside strings; a string that the end cuts off is one token up to the end.
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[\[\]{}]', re.S)


def salvage(text: str) -> str:
    """Valid JSON of a broken response: its members and list elements that are complete, the rest left off.

    One pass keeps the stack of open brackets and remembers the last place at which a member of the outer object, or an element of
    one of its lists, was whole; there the text is cut and the open brackets are closed."""
    stack: list[str] = []
    end, closing = 0, ""
    for token in _TOKEN.finditer(text):
        mark = token[0]
        if mark in "[{":
            stack.append("]" if mark == "[" else "}")
        elif mark in "]}":
            if not stack or stack.pop() != mark:
                break
            if stack in (["}"], ["}", "]"]):
                end, closing = token.end(), "".join(reversed(stack))
            elif not stack:
                end, closing = token.end(), ""
                break
    if not end:
        return json.dumps({"records": [], "notes": "No complete part of this response could be read."})
    try:
        found = json.loads(text[:end] + closing)
    except ValueError:
        return json.dumps({"records": [], "notes": "The complete parts of this response are no valid JSON."})
    return json.dumps(found)


def parse_responses(responses: DataFrame, schema: str = PAYLOAD, strict: bool = False) -> DataFrame:
    """(custom_id, payload, response_complete): the built-in parser first; only what it can't read goes to the salvage helper.

    strict: nothing is repaired, and a response that is no object, or whose records are no list, has no payload (windows of a text)."""
    r = barrier(responses.select("custom_id", unfenced("text").alias("json")))
    if not strict:
        r = r.withColumn("json", F.when(F.col("json").startswith("["), F.concat(F.lit('{"records":'), "json", F.lit("}"))).otherwise(F.col("json")))
    value = F.try_parse_json("json")
    ok = value.isNotNull() & F.col("json").startswith("{")
    if strict:
        listed = F.try_variant_get(value, "$.records", "array<variant>").isNotNull() | F.try_variant_get(value, "$.records", "variant").isNull()
        ok = ok & listed
    r = barrier(r.withColumn("ok", F.coalesce(ok, F.lit(False))))
    good = r.where("ok").select("custom_id", F.from_json("json", schema).alias("payload"), F.lit(True).alias("response_complete"))
    if strict:
        return good.unionByName(r.where("not ok").select("custom_id", F.lit(None).cast(schema).alias("payload"), F.lit(False).alias("response_complete")))

    @F.pandas_udf("string")
    def repair(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: salvage(t) if t else None)

    bad = r.where("not ok").select("custom_id", F.from_json(repair("json"), schema).alias("payload"), F.lit(False).alias("response_complete"))
    return good.unionByName(bad)


NUMERIC = ("frequency_mhz", "temperature_c", "dielectric_constant", "loss_factor", "moisture_content_pct", "electrical_conductivity_s_m")
#: What a record's loss tangent may say instead of a number (fixed values).
NO_TANGENT = ("", "n.d.", "N.A.")


def malformed(record: Column) -> Column:
    """Whether a record of the raw payload (numbers still strings) has a number that is none."""
    number = lambda c: record[c].isNull() | record[c].try_cast("double").isNotNull()
    bad = record.isNull() | ~reduce(Column.__and__, [number(c) for c in NUMERIC])
    return bad | (record["loss_tangent"].isNotNull() & ~record["loss_tangent"].isin(*NO_TANGENT) & record["loss_tangent"].try_cast("double").isNull())


def records_from_responses(parsed: DataFrame, requests: DataFrame, papers: DataFrame, provenance: str = "measured_table") -> DataFrame:
    """Records of parsed responses, stamped with paper, model and provenance; table records get nominal ISM frequencies.

    A malformed record of a table is left out alone; of a text it takes all records of its paper with it, as text records
    are checked together."""
    table = provenance in ("measured_table", "vision_table")
    p = papers.groupBy("paper_uid").agg(F.min("doi").alias("doi"))
    d = parsed.join(requests.select("custom_id", "paper_uid", "model"), "custom_id").join(p, "paper_uid", "left")
    d = d.select("*", F.explode(F.coalesce("payload.records", "payload.data")).alias("r")).withColumn("bad", malformed(F.col("r")))
    if table:
        d = d.where("not bad")
    else:
        d = d.join(d.where("bad").select("paper_uid").distinct(), "paper_uid", "left_anti")
    number = lambda c: F.col(f"r.{c}").try_cast("double")
    basis = F.lower(F.coalesce(F.col("r.moisture_basis"), F.lit("unknown")))
    text = ["material_name", "salt_content", "measurement_method", "source_location"]
    return d.select(
        *[F.col(f"r.{c}").alias(c) for c in text],
        *[number(c).alias(c) for c in NUMERIC if c != "frequency_mhz"],
        (ism_normalize(number("frequency_mhz")) if table else number("frequency_mhz")).alias("frequency_mhz"),
        number("loss_tangent").alias("loss_tangent"),
        F.when(basis.isin("wet", "dry", "unknown"), basis).alias("moisture_basis"),
        F.coalesce(filled("r.source_table"), F.lit("" if table else "Narrative text")).alias("source_table"),
        "paper_uid",
        "doi",
        F.lit("table" if table else "text").alias("extraction_source"),
        F.col("model").alias("extraction_model"),
        F.lit(provenance).alias("data_provenance"),
    )


def text_completeness(parsed: DataFrame, requests: DataFrame) -> DataFrame:
    """(paper_uid, windows, failed_windows, malformed, complete) of strictly parsed text responses."""
    one = parsed.join(requests.select("custom_id", "paper_uid"), "custom_id")
    bad = F.exists(F.coalesce("payload.records", F.array().cast(f"array<{RECORD}>")), malformed)
    g = one.groupBy("paper_uid").agg(F.count("*").alias("windows"), F.count_if(~F.col("response_complete")).alias("failed_windows"), F.max(bad).alias("malformed"))
    return g.withColumn("complete", (F.col("failed_windows") == 0) & ~F.col("malformed"))
