"""Listing-shaped views of the shared test tables, as Spark DataFrames and as SQL text of the same meaning.

Every view is a projection of whole tables: no row is left out, ids are never filtered.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


ASOF = "TIMESTAMP '2024-02-01 00:00:00'"
MID = "TIMESTAMP '1998-01-01 00:00:00'"
_G = "(o_orderkey - CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END)"
BASE = {"orders": f"*, {_G} AS g"}  # shared sub-expression of the listing columns, computed once per row


def _g(expr: str) -> str:
    return expr.replace("{g}", "g")


LISTING = {k: _g(v) for k, v in {
    "id": "o_orderkey",
    "source": "CASE o_custkey % 4 WHEN 0 THEN 'olx' WHEN 1 THEN 'rieltor' WHEN 2 THEN 'olx' ELSE 'feed_olx' END",
    "external_id": "'x_' || CAST(o_orderkey AS STRING)",
    "catalog": "CASE o_orderpriority WHEN '1-URGENT' THEN 'houses' WHEN '2-HIGH' THEN 'commercial' ELSE 'apartments' END",
    "operation": "CASE WHEN {g} % 2 = 0 THEN 'rent' ELSE 'buy' END",
    "property_type": "CASE WHEN {g} % 9 = 0 THEN 'Будинок' WHEN {g} % 29 = 3 THEN 'office' ELSE 'Квартира' END",
    "status": "CASE WHEN o_orderstatus <> 'P' THEN 'active' WHEN {g} % 4 = 0 THEN 'quarantine' "
              "WHEN {g} % 4 = 1 THEN 'archived' ELSE 'inactive' END",
    "title": "CASE WHEN {g} % 13 = 0 THEN '' WHEN {g} % 17 = 0 THEN NULL WHEN {g} % 31 = 4 THEN 'test flat for rent' "
             "ELSE 'Bright listing number ' || CAST({g} AS STRING) || ' near the park' END",
    "description": "CASE WHEN {g} % 6 = 0 THEN NULL WHEN {g} % 6 = 1 THEN 'опис' ELSE "
                   "CAST(1 + {g} % 4 AS STRING) || '-кімнатна квартира, ' || CAST(30 + {g} % 90 AS STRING) || ' м², ' || "
                   "CAST(1 + {g} % 12 AS STRING) || '/' || CAST(5 + {g} % 12 AS STRING) || ' поверх. ' || "
                   "CASE {g} % 4 WHEN 0 THEN 'Печерський район, вул. Лесі Українки, поруч парк.' "
                   "WHEN 1 THEN 'Оболонь, без комісії, від власника.' WHEN 2 THEN 'Дарниця, комісія 50%, агентство.' "
                   "ELSE 'Телефон 067 123 45 ' || CAST(10 + {g} % 90 AS STRING) || ', ЖК Сонячний, метро Кловська.' END END",
    "price_uah": "CASE WHEN {g} % 7 = 3 THEN NULL ELSE CAST(10000 + ({g} * 7919) % 600000 AS DOUBLE) END",
    "price_usd": "CASE WHEN {g} % 11 = 5 THEN NULL ELSE CAST(30000 + ({g} * 104729) % 6000000 AS DOUBLE) END",
    "price_eur": "CASE WHEN {g} % 5 = 1 THEN CAST(20000 + ({g} * 31) % 90000 AS DOUBLE) ELSE NULL END",
    "area": "CASE WHEN {g} % 8 = 1 THEN NULL ELSE CAST(5 + ({g} * 31) % 900 AS DOUBLE) END",
    "rooms": "CASE WHEN {g} % 6 = 2 THEN NULL ELSE {g} % 6 END",
    "floor": "CASE WHEN {g} % 10 = 7 THEN NULL ELSE {g} % 25 END",
    "floors_total": "CASE WHEN {g} % 14 = 3 THEN NULL ELSE ({g} * 3) % 27 END",
    "district": "CASE WHEN {g} % 15 = 2 THEN '' ELSE 'District ' || CAST({g} % 10 AS STRING) END",
    "city": "CASE {g} % 12 WHEN 0 THEN 'Львів' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'Київ, Оболонь' ELSE 'Київ' END",
    "street": "CASE WHEN {g} % 3 = 0 THEN NULL ELSE 'вул. Садова ' || CAST({g} % 40 AS STRING) END",
    "residential_complex": "CASE WHEN {g} % 4 = 1 THEN 'ЖК Сонячний' ELSE '' END",
    "metro_station": "CASE {g} % 5 WHEN 0 THEN 'Кловська' WHEN 1 THEN '' ELSE NULL END",
    "agent_type": "CASE {g} % 6 WHEN 0 THEN 'owner' WHEN 1 THEN 'agent' WHEN 2 THEN 'unknown' WHEN 3 THEN '' ELSE NULL END",
    "agent_name": "CASE WHEN {g} % 7 = 0 THEN NULL ELSE 'Agent ' || CAST({g} % 50 AS STRING) END",
    "agent_phone": "CASE WHEN {g} % 23 = 6 THEN '' ELSE '+380' || CAST(500000000 + {g} AS STRING) END",
    "commission": "CASE {g} % 7 WHEN 0 THEN 'Комісія 50' WHEN 1 THEN 'false' WHEN 2 THEN 'Без комісії!' WHEN 3 THEN '' ELSE NULL END",
    "url": "'https://site.example/' || CAST(o_orderkey - CASE WHEN o_orderkey % 5 = 2 THEN 1 ELSE 0 END AS STRING)",
    "photo_url": "CASE WHEN {g} % 10 = 4 THEN '' ELSE 'https://cdn.example/' || CAST({g} % 500 AS STRING) || '.jpg' END",
    "ai_title": "CASE {g} % 5 WHEN 0 THEN NULL WHEN 1 THEN 'назва' WHEN 2 THEN 'Квартира від агента' "
                "ELSE 'Оренда квартири у центрі міста ' || CAST({g} AS STRING) END",
    "ai_description": "CASE {g} % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Продається квартира. ' || CAST({g} AS STRING) "
                      "WHEN 2 THEN '[Назва] квартири для продажу' ELSE 'Простора квартира з ремонтом біля парку та школи, "
                      "поверх ' || CAST({g} % 25 AS STRING) || ', затишний двір, зручний транспорт, магазини поруч, тихі сусіди.' END",
    "comments": "CASE WHEN o_orderstatus <> 'P' THEN NULL ELSE CASE {g} % 3 WHEN 0 THEN 'rent_price_too_high' "
                "WHEN 1 THEN 'not_apartment' ELSE 'area_too_big' END END",
    "data_completeness": "({g} * 37) % 101",
    "created_at": "o_orderdate - INTERVAL 10 DAYS",
    "updated_at": "CASE WHEN {g} % 37 = 9 THEN NULL ELSE o_orderdate END",
}.items()}

# same catalog seen again: every order, some under a new key, some fields blank or changed
INCOMING = dict(LISTING)
INCOMING.update({k: _g(v) for k, v in {
    "external_id": "CASE WHEN {g} % 4 = 3 THEN 'new_' ELSE 'x_' END || CAST(o_orderkey AS STRING)",
    "title": "CASE WHEN {g} % 3 = 0 THEN '' ELSE 'Fresh title ' || CAST({g} % 100 AS STRING) END",
    "price_uah": "CASE WHEN {g} % 5 = 0 THEN NULL ELSE CAST(15000 + ({g} * 13) % 9000 AS DOUBLE) END",
    "district": "CASE WHEN {g} % 2 = 0 THEN '' ELSE 'District ' || CAST({g} % 10 AS STRING) END",
    "agent_type": "CASE WHEN {g} % 2 = 0 THEN 'unknown' ELSE 'agency' END",
    "agent_phone": "CASE WHEN {g} % 2 = 1 THEN '' ELSE '+380' || CAST(600000000 + {g} AS STRING) END",
    "status": "'active'",
    "updated_at": "o_orderdate + INTERVAL 30 DAYS",
    "is_valid": "{g} % 10 <> 4",
}.items()})

CHECK = {"event_id": "event_id", "listing_id": "user_id", "checked_at": "ts",
         "http_status": "CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 429 WHEN 'purchase' THEN NULL ELSE 200 END",
         "source": "CASE WHEN user_id % 3 = 0 THEN 'rieltor' ELSE 'olx' END",
         "operation": "CASE WHEN user_id % 2 = 0 THEN 'rent' ELSE 'buy' END"}

PHOTO = {"listing_id": "l_orderkey",
         "url": "CASE WHEN l_returnflag = 'R' THEN 'http' ELSE 'https' END || '://cdn.example/' || CAST(l_partkey AS STRING) || '.jpg'",
         "pos": "l_linenumber", "tie": "l_partkey * 1000 + l_suppkey", "shipped": "l_shipdate"}

MEDIA = {"url": "'https://cdn.example/' || CAST(p_partkey AS STRING) || '.jpg'",
         "status": "CASE WHEN p_size <= 30 THEN 'archived' WHEN p_size <= 36 THEN 'gone' WHEN p_size <= 42 THEN 'retry' ELSE 'pending' END",
         "storage_key": "'files/' || CAST(p_partkey AS STRING) || '.webp'", "byte_size": "CAST(p_size AS BIGINT) * 1000",
         "attempts": "CAST(p_size % 4 AS BIGINT)",
         "retry_after": "CASE WHEN p_size % 2 = 0 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE NULL END"}

JOB = {"job_id": "o_orderkey",
       "status": "CASE o_orderpriority WHEN '1-URGENT' THEN 'pending' WHEN '2-HIGH' THEN 'retry' WHEN '3-MEDIUM' THEN 'done' "
                 "WHEN '5-LOW' THEN 'failed' ELSE 'retry' END",
       "attempt_count": "o_custkey % 7", "next_attempt_at": "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_orderdate END"}
OUTCOME = {"job_id": "o_orderkey",
           "listing_status": "CASE o_custkey % 6 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN NULL ELSE 200 END",
           "ad_id": "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
           "phone_status": "CASE o_custkey % 9 WHEN 0 THEN 401 WHEN 1 THEN 400 WHEN 2 THEN NULL ELSE 200 END",
           "phone_count": "o_custkey % 3", "failed": "o_custkey % 13 = 0"}
RESULT = {"job_id": "l_orderkey", "phone_count": "MAX(l_linenumber) % 3",
          "coverage_status": "CASE MAX(l_returnflag) WHEN 'R' THEN 'found' WHEN 'N' THEN 'blocked' ELSE 'not_found' END"}
PUBLICATION = {"listing_id": "l_orderkey", "status": "CASE MAX(l_returnflag) WHEN 'R' THEN 'published' WHEN 'N' THEN 'pending' ELSE 'retry' END",
               "updated_at": "MAX(l_shipdate)",
               "synced_at": "CASE WHEN COUNT(*) % 4 = 0 THEN NULL ELSE MIN(l_shipdate) + INTERVAL 400 DAYS END",
               "n": "COUNT(*)"}
RUN_PAGE = {"run_id": "CAST(floor(event_id / 8) AS BIGINT)",
            "operation": "CASE WHEN CAST(floor(event_id / 8) AS BIGINT) % 2 = 0 THEN 'rent' ELSE 'buy' END",
            "ok": "event_type <> 'error'", "listing_id": "user_id", "started_at": "ts",
            "expected_pages": "CASE WHEN CAST(floor(event_id / 8) AS BIGINT) % 5 = 0 THEN 7 ELSE 8 END"}
NOTE = {"catalog": "CASE role WHEN 'user' THEN 'apartments' WHEN 'system' THEN 'houses' ELSE 'commercial' END",
        "listing_id": "CAST(conv_id AS STRING)", "note": "trim(text)", "pos": "turn"}
PAYLOAD = {"event_id": "event_id", "operation": "CASE WHEN user_id % 2 = 0 THEN 'rent' ELSE 'buy' END",
           "payload": "'{\"id\": \"' || CAST(event_id AS STRING) || '\", \"title\": \" Item  ' || CAST(user_id AS STRING) || ' \", \"price\": ' || "
                      "CASE event_type WHEN 'error' THEN 'null' ELSE CAST(user_id * 25 AS STRING) END || ', \"currency\": \"' || "
                      "CASE WHEN user_id % 3 = 0 THEN 'usd' ELSE 'UAH' END || '\", \"rooms\": \"' || CAST(user_id % 5 AS STRING) || "
                      "'\", \"floor\": ' || CAST(event_id % 12 AS STRING) || ', \"total_floors\": 9, \"city\": {\"name\": \"Київ\"}, "
                      "\"district\": \"District ' || CAST(user_id % 10 AS STRING) || '\", \"photos\": [{\"src\": \"https://img.' || event_type || "
                      "'.olx.example/1.jpg\"}, {\"url\": \"https://img.example/2.jpg\"}], \"props\": ' || props || '}'"}

VIEWS = {  # view -> (table, columns, grouped by)
    "listings": ("orders", LISTING, None), "listings_in": ("orders", INCOMING, None), "checks": ("events", CHECK, None),
    "photos": ("lineitem", PHOTO, None), "media": ("part", MEDIA, None), "jobs": ("orders", JOB, None),
    "outcomes": ("orders", OUTCOME, None), "results": ("lineitem", RESULT, "l_orderkey"),
    "publications": ("lineitem", PUBLICATION, "l_orderkey"), "run_pages": ("events", RUN_PAGE, None),
    "notes": ("conversations", NOTE, None), "payloads": ("events", PAYLOAD, None)}


def cte(*names: str, **extra: str) -> str:
    """WITH clause of the named views (and further CTEs) for a SQL oracle."""
    parts = []
    for name in names:
        table, cols, by = VIEWS[name]
        body = ", ".join(f"{e} AS {c}" for c, e in cols.items())
        source = f"(SELECT {BASE[table]} FROM {table})" if table in BASE else table
        parts.append(f"{name} AS (SELECT {body} FROM {source}" + (f" GROUP BY {by})" if by else ")"))
    parts += [f"{n} AS ({q})" for n, q in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"


class Tables:
    """The shared tables of one folder and the listing-shaped views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table as a file stream.  A glob pattern serves a single file and a folder of part files alike."""
        path = f"{self.folder}/[{name[0]}]{name[1:]}.parquet"
        return self.spark.readStream.schema(self.read(name).schema).parquet(path)

    def stream_view(self, name: str) -> DataFrame:
        table, cols, _ = VIEWS[name]
        return self.stream(table).selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])

    def view(self, name: str) -> DataFrame:
        table, cols, by = VIEWS[name]
        df = self.read(table)
        if table in BASE:
            df = df.selectExpr("*", BASE[table].split(", ", 1)[1])
        if by is None:
            return df.selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])
        from pyspark.sql import functions as F
        keys = {c: e for c, e in cols.items() if e == by}
        aggs = [F.expr(e).alias(c) for c, e in cols.items() if c not in keys]
        return df.groupBy(by).agg(*aggs).withColumnRenamed(by, next(iter(keys))).select(*cols)

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            return self.view(name)
        return self.read(name)

    def catalogs(self) -> dict[str, DataFrame]:
        from pyspark.sql import functions as F
        base = self.listings
        return {c: base.where(F.col("catalog") == c) for c in ("apartments", "houses", "commercial")}

    def photo_lists(self) -> DataFrame:
        """(id, photos[]) per listing in line order."""
        from pyspark.sql import functions as F
        p = self.photos.groupBy("listing_id").agg(F.array_sort(F.collect_list(F.struct("pos", "tie", "url"))).alias("p"))
        return p.select(F.col("listing_id").alias("id"), F.transform("p", lambda s: s["url"]).alias("photos"))
