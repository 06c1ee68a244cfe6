"""Queries that write files from the shared tables and read them back through the library's own readers."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rooftree.plans.bindings import cte
from rooftree.plans.registry import query
from rooftree.session import scratch_dir
from rooftree.sources import grids, payloads, splits

L, P = cte("listings"), cte("payloads")
ARRAY_ITEMS = 200_000  # items of one array of an export
CELL = "CASE WHEN id % 3 = 0 THEN 'He said \"yes\",' || chr(10) || chr(10) || 'then left; ' ELSE '' END || COALESCE(title, '')"


def _path(t, name: str) -> str:
    return f"{scratch_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("grid_sheet_rows", L + f"""SELECT operation AS tab, row_number() OVER (PARTITION BY operation ORDER BY id) + 1 AS sheet_row, CAST(id AS VARCHAR) AS id,
 NULLIF({CELL}, '') AS note, NULLIF(comments, '') AS comments FROM listings""")
def _(t):
    path = _path(t, "grid")
    rows = t.listings.selectExpr("operation AS tab", "id", f"{CELL} AS note", "comments")
    grids.write_grid(rows.repartitionByRange("tab", "id").sortWithinPartitions("tab", "id"), path, tabs=["rent", "buy"])
    tabs = [grids.read_grid(t.spark, f"{path}/tab={tab}", row_number="sheet_row", one_sheet=True).select(F.lit(tab).alias("tab"), "sheet_row", "id", "note", "comments")
            for tab in ("rent", "buy")]
    return tabs[0].unionByName(tabs[1])


@query("export_array", """WITH e AS (SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE 'olx_' || CAST(user_id AS VARCHAR) END AS k, event_id,
 CASE WHEN event_type = 'error' THEN NULL ELSE '+38067' || CAST(1000000 + event_id % 3 AS VARCHAR) END AS ph FROM events)
SELECT k AS external_id, string_agg(ph, ',' ORDER BY o) AS phones FROM (SELECT k, ph, min(event_id) AS o FROM e WHERE k IS NOT NULL AND ph IS NOT NULL GROUP BY k, ph) GROUP BY k""")
def _(t):
    path = _path(t, "export")
    url = F.when(F.col("event_type") == "signup", "no id } here").otherwise(F.format_string("https://board.example/{x}-ID%d.html", "user_id"))
    phone = F.when(F.col("event_type") != "error", F.format_string("067 %d", F.lit(1_000_000) + F.col("event_id") % 3))
    item = F.struct(url.alias("url"), phone.alias("phone"), F.col("event_id").alias("pos"), F.lit('a "quoted" ] \\ [{').alias("note"), F.array(F.struct(F.lit(1).alias("n"))).alias("inner"))
    spark, array = t.spark, F.floor(F.col("event_id") / ARRAY_ITEMS).alias("array")
    lines = t.events.select(array, F.col("event_id").alias("at"), F.concat(F.lit(","), F.to_json(item)).alias("value"))
    arrays = t.events.select(array).distinct()
    for at, text in ((-1, "[{}"), ((1 << 63) - 1, "]")):
        lines = lines.unionByName(arrays.select("array", F.lit(at).cast("long").alias("at"), F.lit(text).alias("value")))
    # a file for each array, so no task sorts more than a few of them
    lines.repartition("array").sortWithinPartitions("array", "at").select("array", "value").write.partitionBy("array").text(path)
    rows = splits.read_json_array(spark, path, payloads.EXPORT_SCHEMA).where("pos IS NOT NULL")
    return payloads.merge_export(rows)[0].select("external_id", F.array_join("merged", ",").alias("phones"))


FIELDS = {"id": "string", "price": "double", "rooms": "int", "floor": "int", "city": "string"}
KIND = """CASE json_type(payload, '$.' || f) WHEN 'NULL' THEN 'VOID' WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'DECIMAL'
 ELSE json_type(payload, '$.' || f) END"""


@query("payload_drift", P + f"""SELECT operation, f AS field, {KIND} AS kind, count(*) AS items FROM (SELECT operation, payload, unnest(json_keys(payload)) AS f FROM payloads) GROUP BY ALL""")
def _(t):
    report = payloads.drift_report(payloads.as_variant(t.payloads.select("operation", "payload")), by=("operation",))
    kind = F.regexp_extract("type", "^[A-Z]+", 0)
    return report.groupBy("operation", "field", kind.alias("kind")).agg(F.sum("items").alias("items"))


@query("payload_variant_fields", P + """SELECT event_id, json_extract_string(payload, '$.id') AS id, TRY_CAST(json_extract_string(payload, '$.price') AS DOUBLE) AS price,
 TRY_CAST(json_extract_string(payload, '$.rooms') AS INTEGER) AS rooms, TRY_CAST(json_extract_string(payload, '$.floor') AS INTEGER) AS floor,
 json_extract_string(payload, '$.city.name') AS city, (SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT unnest(json_keys(payload)) AS k) x
  WHERE k NOT IN ('id', 'price', 'rooms', 'floor', 'city')) AS others FROM payloads""")
def _(t):
    rows = payloads.typed_fields(payloads.as_variant(t.payloads.select("event_id", "payload")), FIELDS, others="others")
    return rows.select("event_id", "id", "price", "rooms", "floor", F.get_json_object("city", "$.name").alias("city"), F.array_join("others", ",").alias("others"))


@query("payload_lines", P + """SELECT count(*) AS items, count(json_extract_string(payload, '$.id')) AS ids, CAST(sum(TRY_CAST(json_extract_string(payload, '$.floor') AS BIGINT)) AS BIGINT) AS floors,
 json_extract_string(payload, '$.currency') AS currency FROM payloads GROUP BY 4""")
def _(t):
    path = _path(t, "payloads")
    t.payloads.select("payload").write.text(path)
    items = payloads.read_payload_files(t.spark, path)
    return items.groupBy("currency").agg(F.count(F.lit(1)).alias("items"), F.count("id").alias("ids"), F.sum(F.col("floor").cast("bigint")).alias("floors"))
