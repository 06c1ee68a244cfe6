"""Flows composed of operators: intake, availability with archive, contact import, publication batch.

A flow returns plain DataFrames.  Write each result to a new path (as ``staged`` does) before the next flow
reads it, so that a long chain is neither recomputed nor lost with an executor.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.operators import dedupe, lookups, quality, selection, snapshots, state
from rooftree.operators.normalize import normalize_listing
from rooftree.session import staged


def intake(curated: DataFrame, extracted: DataFrame, asof: str, rates=None) -> DataFrame:
    """Extracted page fields -> normalized -> wrong types and low prices out -> merged -> gated -> de-duplicated."""
    fresh = staged(normalize_listing(extracted, rates))  # a filter on computed fields would repeat their expressions
    rows = curated.count() + fresh.count()  # whole rows are shuffled three times, by tasks that follow their number
    fresh = quality.price_gate(quality.resolve_catalog(fresh, D.FLAT))
    merged = staged(snapshots.merge_apartments(curated, fresh, asof), rows)  # each of these is read twice by the next
    merged = staged(dedupe.dedupe_by_url(quality.quality_gate(merged)), rows)
    return staged(dedupe.dedupe_by_fingerprint(merged), rows)


def availability(listings: DataFrame, checks: DataFrame, archive: DataFrame, asof: str, threshold: int = 2
                 ) -> tuple[DataFrame, DataFrame]:
    """(listings, archive): confirmed removals become inactive with a comment and are archived once."""
    gone = state.confirmed_once(checks, threshold).select(F.col("listing_id").alias("id"), F.col("reason").alias("__why"))
    marked = listings.join(gone, "id", "left")
    hit = (F.col("status") == "active") & F.col("__why").isNotNull()
    comment = F.concat(F.coalesce("comments", F.lit("")), F.lit(" cleaning_"), "__why")
    lost = marked.where(hit)
    added = lookups.not_archived(lost, archive).select(
        "catalog", "id", F.expr(asof).alias("archived_at"), F.col("__why").alias("reason"),
        F.to_json(F.struct(*listings.columns), {"ignoreNullFields": "false"}).alias("snapshot"))
    after = marked.withColumns({"comments": F.when(hit, comment).otherwise(F.col("comments")),
                                "status": F.when(hit, "inactive").otherwise(F.col("status"))})
    return after.select(*listings.columns), archive.unionByName(added)


def contact_import(catalogs: DataFrame, phones: DataFrame, target: str = "agent_phone") -> tuple[DataFrame, DataFrame]:
    """(new snapshot, verification counts): planned phone updates, and the proof that nothing else changed."""
    plan, _stats = lookups.plan_import(catalogs, phones, current=target)
    todo = plan.where("needs_update").select("id", "new_value")
    new = catalogs.join(todo, "id", "left").withColumn(target, F.coalesce("new_value", target)).select(*catalogs.columns)
    return new, snapshots.verify_only_changed(catalogs, new, "id", target, plan.select("id", "new_value"))


def publication_batch(listings: DataFrame, pubs: DataFrame, archive: DataFrame, asof: str, limit: int,
                      photos: str = "photos") -> DataFrame:
    """Active listings that are due, have secure photos and all of them archived, interleaved by catalog."""
    done = pubs.where(~(F.col("status").isin("pending", "retry") & (F.col("retry_after").isNull() | (F.col("retry_after") <= F.expr(asof)))))
    due = listings.where(F.col("status") == "active").join(done.select(F.col("listing_id").alias("id")), "id", "left_anti")
    secure = lambda u: u.startswith("https://")
    stored = archive.where(F.col("status") == "archived")
    ready = lookups.not_exists_filter(lookups.exists_filter(due, photos, secure), photos, secure, stored, "url")
    return selection.round_robin(ready, "catalog", D.CATALOGS, limit)
