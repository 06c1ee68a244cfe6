"""Joins: raw pages, ledgers, archives, notes, plans, media, publications, rates.

Joined sides are projected to keys and small columns first; no broadcast hints here - Spark measures
the small side itself and falls back to a shuffle join with skew splitting.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree.functions.arrays import distinct_ordered, https_photos
from rooftree.functions.money import convert_currency
from rooftree.functions.text import as_col, is_blank, phone_values
from rooftree.operators.skew import attach_lookup, per_group_top

KEY = ("source", "external_id")


def join_raw(df: DataFrame, raw: DataFrame, on=KEY, columns=("html",)) -> DataFrame:
    """Attach raw page columns to curated rows by natural key."""
    return df.join(raw.select(*on, *columns), list(on), "inner")


def due_for_attempt(df: DataFrame, ledger: DataFrame, asof, ttl_days: int, on: str = "id",
                    ts_col: str = "attempted_at") -> DataFrame:
    """Rows never attempted, or not within the last ``ttl_days`` before ``asof``."""
    fresh = ledger.where(F.col(ts_col) >= F.expr(f"{asof} - INTERVAL {int(ttl_days)} DAYS")).select(on)
    return df.join(fresh, on, "left_anti")


def below_version(df: DataFrame, ledger: DataFrame, version: int, on: str = "id") -> DataFrame:
    """Rows never rebuilt, or rebuilt with an older version."""
    return df.join(ledger.where(F.col("version") >= version).select(on), on, "left_anti")


def not_archived(df: DataFrame, archive: DataFrame, on=("catalog", "id")) -> DataFrame:
    return df.join(archive.select(*on), list(on), "left_anti")


def new_ids(df: DataFrame, known: DataFrame, refresh_n: int, cap: int | None = None, by=("source", "operation"),
            key: str = "external_id", pos: str = "pos") -> DataFrame:
    """Intake plan per scope: all unknown ids, then up to ``refresh_n`` known ones, then an optional cap."""
    by = list(by)
    keys = [*by, key]
    seen = known.select(*keys).distinct()
    fresh = df.join(seen, keys, "left_anti").withColumn("is_known", F.lit(False))
    again = per_group_top(df.join(seen, keys, "left_semi"), by, [F.col(pos).asc()], refresh_n, "__r").drop("__r")
    plan = fresh.unionByName(again.withColumn("is_known", F.lit(True)))
    if cap is None:
        return plan
    return per_group_top(plan, by, [F.col("is_known").asc(), F.col(pos).asc()], cap, "queue_rank")


def exists_filter(df: DataFrame, arr: str, pred) -> DataFrame:
    """Rows with at least one array element that satisfies ``pred`` (no shuffle)."""
    return df.where(F.exists(F.coalesce(F.col(arr), F.array().cast("array<string>")), pred))


def not_exists_filter(df: DataFrame, arr: str, pred, other: DataFrame, on: str, key: str = "id") -> DataFrame:
    """Rows without an element that satisfies ``pred`` and is missing from ``other``."""
    items = df.select(key, F.explode(F.array_distinct(F.filter(arr, pred))).alias(on))
    found = other.select(on).distinct().withColumn("__found", F.lit(True))
    gaps = attach_lookup(items, found, on).where(F.col("__found").isNull()).select(key).distinct()
    return df.join(gaps, key, "left_anti")


def identity_overlap(a: DataFrame, b: DataFrame, on=KEY) -> DataFrame:
    """Keys that occur in both catalogs."""
    return a.select(*on).distinct().join(b.select(*on).distinct(), list(on), "left_semi")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def attach_notes(df: DataFrame, notes: DataFrame, catalog: Column | str = "catalog", key: str = "id") -> DataFrame:
    """A non-empty human note replaces the comment of its row."""
    keyed = df.withColumns({"__cat": as_col(catalog), "__id": F.col(key).cast("string")})
    notes = notes.where(~is_blank("note")).select(F.col("catalog").alias("__cat"),
                                                  F.col("listing_id").cast("string").alias("__id"), "note")
    out = keyed.join(notes, ["__cat", "__id"], "left")
    return out.withColumn("comments", F.coalesce("note", "comments")).select(*df.columns)


def plan_import(catalogs: DataFrame, phones: DataFrame, key: str = "external_id", current: str = "agent_phone"
                ) -> tuple[DataFrame, DataFrame]:
    """(plan, stats) for merging incoming phones (key, phones[]) into catalog rows by exact key."""
    plan = catalogs.join(phones.select(key, F.col("phones").alias("incoming")), key, "inner")
    merged = F.array_join(distinct_ordered(phone_values(current), "incoming"), " ")
    plan = plan.withColumns({"old_value": F.coalesce(F.col(current), F.lit("")), "new_value": merged})
    plan = plan.withColumn("needs_update", F.col("old_value") != F.col("new_value"))
    plan = plan.select("catalog", "id", key, "operation", "status", "old_value", "new_value", "needs_update")
    unmatched = phones.join(catalogs.select(key).distinct(), key, "left_anti")
    per_key = plan.groupBy(key).agg(F.min("catalog").alias("lo"), F.max("catalog").alias("hi"),
                                    F.count(F.lit(1)).alias("rows"), F.count_if("needs_update").alias("updates"),
                                    F.count_if(F.col("status") == "active").alias("active"))
    stats = per_key.agg(F.count(F.lit(1)).alias("matched_keys"), F.sum("rows").alias("matched_rows"),
                        F.sum("active").alias("matched_active_rows"), F.sum("updates").alias("rows_to_update"),
                        F.count_if(F.col("lo") != F.col("hi")).alias("cross_catalog_keys"))
    stats = stats.withColumn("rows_current", F.col("matched_rows") - F.col("rows_to_update"))
    return plan, stats.withColumn("unmatched_keys", unmatched.agg(F.count(F.lit(1))).scalar())


def resolve_media(df: DataFrame, archive: DataFrame, base: str, on_missing: str = "hold", key: str = "id",
                  arr: str = "photos") -> DataFrame:
    """Photos mapped to stored copies in order; a row with a missing copy is held, or falls back to the source."""
    items = df.select(key, F.posexplode(https_photos(arr)).alias("pos", "url"))
    items = items.withColumn("source_sha256", F.sha2("url", 256))
    stored = archive.where((F.col("status") == "archived") & ~is_blank("storage_key"))
    stored = stored.select("source_sha256", "storage_key")
    hit = attach_lookup(items, stored, "source_sha256")
    durable = F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace("storage_key", "^/+", ""))
    shown = durable if on_missing == "hold" else F.coalesce(durable, F.col("url"))
    rebuilt = hit.groupBy(key).agg(
        F.count_if(F.col("storage_key").isNull()).alias("missing_copies"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", shown.alias("u")))), lambda s: s["u"]).alias("media"))
    if on_missing == "hold":
        rebuilt = rebuilt.withColumn("media", F.when(F.col("missing_copies") == 0, F.col("media")))
    return df.join(rebuilt, key, "left")


def publication_targets(pubs: DataFrame, listings: DataFrame, on=("source", "external_id", "operation")
                        ) -> tuple[DataFrame, DataFrame]:
    """(resolved, rejected): publications with and without an active listing."""
    active = listings.where(F.col("status") == "active").groupBy(*on).agg(F.min("id").alias("listing_id"))
    joined = pubs.join(active, list(on), "left")
    return joined.where(F.col("listing_id").isNotNull()), joined.where(F.col("listing_id").isNull())


def with_catalog_columns(pubs: DataFrame, catalogs: dict[str, DataFrame], cols, key: str = "listing_id") -> DataFrame:
    """Columns of the right catalog for each publication: one tagged union, one left join."""
    tagged = None
    for name, df in catalogs.items():
        part = df.select(F.lit(name).alias("catalog"), F.col("id").alias(key), *cols)
        tagged = part if tagged is None else tagged.unionByName(part)
    return pubs.join(tagged, ["catalog", key], "left")


def classify_ids(ids: DataFrame, stored: DataFrame, on=("source", "operation", "external_id"),
                 by=("source", "operation")) -> DataFrame:
    """Seen ids against stored status: active, other status or missing, counted per scope."""
    joined = ids.select(*on).distinct().join(stored.select(*on, "status"), list(on), "left")
    state = F.when(F.col("status").isNull(), "missing").when(F.col("status") == "active", "active").otherwise("other")
    return joined.groupBy(*by, state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def lifecycle_join(rows: DataFrame, mirror: DataFrame, key: str = "id", watch=("status", "updated_at")) -> DataFrame:
    """Full mirror: unknown ids are appended, otherwise only the watched cells that differ are updated."""
    theirs = mirror.select(F.col(key).alias("__id"), *[F.col(w).alias(f"__m_{w}") for w in watch])
    out = rows.join(theirs, rows[key] == theirs["__id"], "left")
    changed = {f"{w}_changed": F.col("__id").isNotNull() & ~F.col(w).eqNullSafe(F.col(f"__m_{w}")) for w in watch}
    out = out.withColumns(changed)
    any_change = F.lit(False)
    for name in changed:
        any_change = any_change | F.col(name)
    action = F.when(F.col("__id").isNull(), "append").when(any_change, "update").otherwise("unchanged")
    return out.withColumn("action", action).select(*rows.columns, *changed, "action")


def orphan_migration(active_copy: DataFrame, known: DataFrame, lifecycle: DataFrame, key: str = "id",
                     pos: str = "pos") -> DataFrame:
    """Rows of the copy unknown to the catalog and not yet in the lifecycle: first one per id, as archived record."""
    unknown = active_copy.where(~is_blank(key)).join(known.select(key).distinct(), key, "left_anti")
    unknown = unknown.join(lifecycle.select(key).distinct(), key, "left_anti")
    rest = [c for c in active_copy.columns if c not in (key, pos)]
    first = unknown.groupBy(key).agg(F.min_by(F.struct(pos, *rest), F.col(pos)).alias("r"))
    return first.select(key, *[F.col(f"r.{c}").alias(c) for c in (pos, *rest)]).withColumn(
        "status", F.lit("inactive"))


def remove_inactive(copy: DataFrame, rows: DataFrame, orphan_ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows of the copy to delete: known but not active, or orphaned."""
    gone = rows.groupBy(key).agg(F.max((F.col("status") == "active").cast("int")).alias("live"))
    gone = gone.where(F.col("live") == 0).select(key).unionByName(orphan_ids.select(key)).distinct()
    return copy.join(gone, key, "left_semi")


def convert_with_rates(df: DataFrame, rates: DataFrame, amount: str, currency: str) -> DataFrame:
    """Amounts to three currencies with a rate table of one row, read as scalar subqueries."""
    quoted = {code.upper(): rates.agg(F.max(code)).scalar() for code in ("usd", "eur")}
    conv = convert_currency(amount, currency, quoted)
    return df.withColumn("__c", conv).select(
        *df.columns, *[F.col(f"__c.{k}").alias(f"{amount}_{k}") for k in ("uah", "usd", "eur")])


def result_by_job(jobs: DataFrame, results: DataFrame, on: str = "job_id") -> DataFrame:
    joined = jobs.join(results.select(on, "coverage_status"), on, "left")
    return joined.groupBy("status", "coverage_status").agg(F.count(F.lit(1)).alias("cnt"))
