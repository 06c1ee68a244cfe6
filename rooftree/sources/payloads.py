"""Nested JSON items, items whose fields drift, and JSON-array exports."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftree.functions.text import blank_to_null, phone_values, rx
from rooftree.operators.normalize import PAYLOAD_SCHEMA
from rooftree.operators.values import merge_values_by_key
from rooftree.sources.splits import read_json_array

EXPORT_SCHEMA = "external_token string, url string, phone string, pos long"


def read_payloads(df: DataFrame, json_col: str = "payload", schema: str = PAYLOAD_SCHEMA) -> DataFrame:
    """JSON text column to typed item columns (objects in text fields stay JSON text); other columns are kept."""
    rest = [c for c in df.columns if c != json_col]
    return df.withColumn("__item", F.from_json(json_col, schema)).select(*rest, "__item.*")


def read_payload_files(spark: SparkSession, path: str, schema: str = PAYLOAD_SCHEMA) -> DataFrame:
    """One JSON item per line, schema given (no inference pass)."""
    return spark.read.schema(schema).json(path)


# --- payloads that drift -----------------------------------------------------------------------------------------------------------

def as_variant(df: DataFrame, json_col: str = "payload", name: str = "item") -> DataFrame:
    """The JSON text as a variant, which keeps every field with the type it came with; broken text is NULL."""
    rest = [c for c in df.columns if c != json_col]
    return df.select(*rest, F.try_parse_json(json_col).alias(name))


def typed_fields(df: DataFrame, fields: dict[str, str], item: str = "item", others: str | None = None) -> DataFrame:
    """Columns from a variant by ``{name: type}``; a value that cannot be cast is NULL, a number or object may serve as text.

    ``others`` names a column for the sorted names of the fields that the list does not know.
    """
    rest = [c for c in df.columns if c != item]
    picked = [F.try_variant_get(item, f"$['{name}']", kind).alias(name) for name, kind in fields.items()]
    extra = []
    if others is not None:
        keys = F.map_keys(F.try_variant_get(F.col(item), "$", "map<string, variant>"))
        extra = [F.array_sort(F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*[F.lit(n) for n in fields]))).alias(others)]
    return df.select(*rest, *picked, *extra)


def drift_report(df: DataFrame, item: str = "item", by: tuple[str, ...] = ()) -> DataFrame:
    """(by, field, type, items): how many items have a top-level field with a type; the type is the variant's own schema.

    Counts are taken map-side, so the shuffle carries a row for each field and type, not the items.
    """
    entries = F.explode(F.map_entries(F.try_variant_get(F.col(item), "$", "map<string, variant>"))).alias("entry")
    kinds = df.select(*by, entries).select(*by, F.col("entry.key").alias("field"), F.schema_of_variant("entry.value").alias("type"))
    return kinds.groupBy(*by, "field", "type").agg(F.count(F.lit(1)).alias("items"))


def common_schema(df: DataFrame, item: str = "item") -> DataFrame:
    """One row: the schema that holds all items, and how many have none (broken text)."""
    return df.agg(F.schema_of_variant_agg(item).alias("schema"), F.count_if(F.col(item).isNull()).alias("broken"))


# --- exports -------------------------------------------------------------------------------------------------------------------------

def export_key(token, url) -> Column:
    """External id of an export row: explicit token, else the id in the URL."""
    found = F.coalesce(blank_to_null(token), rx(url, r"-ID([A-Za-z0-9]+)\.html"))
    return F.concat(F.lit("olx_"), F.trim(found))


def read_export(spark: SparkSession, path: str, array: bool = True) -> tuple[DataFrame, DataFrame]:
    """(merged phones per key, counters) of an export with external_token, url, phone and pos.

    A JSON array is cut at its elements by as many tasks as the file has splits; with ``array=False`` a line is an item.
    """
    rows = read_json_array(spark, path, EXPORT_SCHEMA) if array else spark.read.schema(EXPORT_SCHEMA).json(path)
    return merge_export(rows)


def keyed_export(rows: DataFrame) -> DataFrame:
    """(external_id, phones, pos) of export rows."""
    return rows.select(export_key("external_token", "url").alias("external_id"), phone_values("phone").alias("phones"), "pos")


def merge_export(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return merge_values_by_key(keyed_export(rows), "external_id", "phones", "pos")
