"""Mutations as pure snapshot functions: (current, incoming) -> new snapshot.

One full outer join on the key and one generated expression per column; results are meant to be written
to a new path.  Repeated incoming keys are folded to one row per key first (map-side combined, on the join's own
partitioning), so the join sees one row per key and a hot key cannot exist there.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.text import blank_to_null, extract_phones, is_blank, some
from rooftree.operators.lookups import not_archived
from rooftree.operators.quality import needs_copy
from rooftree.operators.skew import attach_lookup

KEY = ("source", "external_id")


def latest_per_key(df: DataFrame, keys, order: list[str]) -> DataFrame:
    """One row per key: the one with the largest order tuple (aggregated, map-side combined)."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return best.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)


_KEPT_BY = {"non_blank": lambda c: ~is_blank(c), "non_null": lambda c: F.col(c).isNotNull(), "non_empty": lambda c: F.size(c) > 0,
            "unless_unknown": lambda c: F.col(c) != "unknown"}


def _orderable(kind) -> bool:
    return not any(part in kind.simpleString() for part in ("map<", "variant", "interval"))


def fold_repeats(incoming: DataFrame, keys, policy: dict, default: str, order: list[str] | None) -> DataFrame:
    """One incoming row per key, as merging row after row in ``order`` would leave it; ``__n`` counts the rows.

    Rows whose key occurs once stay as they are; only the others are folded, map-side combined.  Without ``order`` the rows of
    a key follow each other by all their values, which is deterministic.
    """
    rest = [f for f in incoming.schema.fields if f.name not in keys]
    along = F.struct(*(order or [f.name for f in rest if _orderable(f.dataType)]), F.lit(0).alias("__last"))

    def last(name):
        rule = policy.get(name, default)
        if rule == "keep":
            return F.min_by(name, along)
        kept = _KEPT_BY.get(rule) if isinstance(rule, str) else None
        newest = F.max_by(name, along)
        return newest if kept is None else F.coalesce(F.max_by(name, F.when(kept(name), along)), newest)

    repeated = incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    marked = attach_lookup(incoming, repeated, list(keys))
    alone = marked.where("__n IS NULL").withColumn("__n", F.lit(1).cast("bigint"))
    folded = marked.where("__n IS NOT NULL").groupBy(*keys).agg(*[last(f.name).alias(f.name) for f in rest], F.count(F.lit(1)).alias("__n"))
    return alone.unionByName(folded)


def _merge_column(name: str, policy, asof: Column, hit: Column) -> Column:
    """New value of a column for a key that exists on both sides."""
    old, new = F.col(f"__cur.{name}"), F.col(f"__inc.{name}")
    if callable(policy):
        return policy(old, new)
    return {"overwrite": lambda: new, "keep": lambda: old,
            "non_blank": lambda: F.coalesce(some(new), old),
            "non_null": lambda: F.coalesce(new, old),
            "non_empty": lambda: F.when(F.size(new) > 0, new).otherwise(old),
            "unless_unknown": lambda: F.when(new != "unknown", new).otherwise(old),
            "sticky": lambda: F.when(old.isin(*D.STICKY_STATUS), old).otherwise("active"),
            "increment": lambda: old + F.col("__inc.__n"), "asof": lambda: asof}[policy]()


def upsert(current: DataFrame, incoming: DataFrame, keys=KEY, policy: dict | None = None, asof="current_date()",
           default: str = "overwrite", guard: Column | None = None, order: list[str] | None = None) -> DataFrame:
    """Insert new keys, merge known ones by per-column policy, keep the rest unchanged.

    A key may repeat in ``incoming``: its rows are merged in ``order`` (see ``fold_repeats``), the last one wins.

    ``guard`` (over the current row's columns) protects matching rows from any change.
    """
    keys, policy = list(keys), policy or {}
    now = F.expr(asof) if isinstance(asof, str) else asof
    cols = current.columns
    inc = incoming.select(*keys, *[c for c in cols if c in incoming.columns and c not in keys])
    inc = fold_repeats(inc, keys, policy, default, order)
    cur_side = current.withColumn("__guard", F.coalesce(guard, F.lit(False)) if guard is not None else F.lit(False))
    rest = [c for c in cols if c not in keys]
    left = cur_side.select(*keys, F.struct(F.lit(1).alias("__hit"), "__guard", *rest).alias("__cur"))
    right = inc.select(*keys, F.struct(F.lit(1).alias("__hit"), *[c for c in inc.columns if c not in keys]).alias("__inc"))
    joined = left.join(right, keys, "full_outer")
    known, fresh = F.col("__cur").isNotNull(), F.col("__inc").isNotNull()
    touch = known & fresh & ~F.col("__cur.__guard")

    def value(name):
        if name in keys:
            return F.col(name)
        rule = policy.get(name, default)
        kind = current.schema[name].dataType
        if name not in inc.columns:
            merged = now if rule == "asof" else F.lit("active") if rule == "sticky" else F.col(f"__cur.{name}")
            if rule == "sticky":
                merged = F.when(F.col(f"__cur.{name}").isin(*D.STICKY_STATUS), F.col(f"__cur.{name}")).otherwise("active")
            first = now if rule == "asof" else F.lit("active") if rule == "sticky" else F.lit(None)
        else:
            merged = _merge_column(name, rule, now, fresh)
            first = now if rule == "asof" else F.col(f"__inc.{name}")
            first = first + F.col("__inc.__n") - 1 if rule == "increment" else first
        return F.when(touch, merged.cast(kind)).when(known, F.col(f"__cur.{name}")).otherwise(first.cast(kind)).alias(name)

    return joined.select(*[value(c) for c in cols])


def merge_apartments(curated: DataFrame, normalized: DataFrame, asof: str, since: str | None = None,
                     sources=("olx", "rieltor")) -> DataFrame:
    """Valid flats of the wanted sources into the curated catalog; aggregator rows are never touched."""
    fresh = normalized.where(F.col("is_valid") & (F.col("property_type") == D.FLAT) & F.col("source").isin(*sources))
    if since is not None:
        fresh = fresh.where(F.col("updated_at") >= F.expr(since))
    fresh = fresh.withColumn("status", F.lit("active"))
    if "cdn_photo_url" in normalized.columns:
        fresh = fresh.withColumn("photo_url", F.coalesce(blank_to_null("cdn_photo_url"), F.col("photo_url")))
    guard = F.col("source").startswith(D.AGGREGATOR_PREFIX)
    return upsert(curated, fresh, KEY, D.APARTMENT_MERGE, asof, guard=guard)


def typed_policy(df: DataFrame, overrides: dict | None = None) -> dict:
    """Policy by column type: texts keep a non-blank value, arrays a non-empty one, the rest a non-NULL one."""
    def rule(kind):
        return "non_blank" if kind == "string" else "non_empty" if kind.startswith("array") else "non_null"
    return {**{f.name: rule(f.dataType.simpleString()) for f in df.schema.fields}, **(overrides or {})}


def merge_commercial(current: DataFrame, incoming: DataFrame, asof: str, keys=KEY) -> DataFrame:
    """Wide commercial catalog: nothing known is lost to a gap in the newer record."""
    fixed = {"operation": "overwrite", "url": "overwrite", "parsed_at": "overwrite", "extraction_confidence": "overwrite",
             "raw_listing_id": "keep", "created_at": "keep", "status": "sticky", "last_seen_at": "asof", "updated_at": "asof"}
    return upsert(current, incoming, keys, typed_policy(current, fixed), asof)


def merge_since(curated: DataFrame, normalized: DataFrame, since: str, asof: str) -> DataFrame:
    return merge_apartments(curated, normalized, asof, since)


def overwrite_upsert(current: DataFrame, incoming: DataFrame, asof: str, keys=KEY) -> DataFrame:
    """Last value wins; a blank phone and sticky status survive."""
    return upsert(current, incoming, keys, D.HOUSE_MERGE_KEEP, asof)


def upsert_raw(current: DataFrame, incoming: DataFrame, asof: str, keys=KEY) -> DataFrame:
    """Landing table: overwrite and count the repeats."""
    return upsert(current, incoming, keys, {"retry_count": "increment", "created_at": "keep", "updated_at": "asof"}, asof)


def insert_if_absent(current: DataFrame, incoming: DataFrame, keys=KEY, order: list[str] | None = None) -> DataFrame:
    """Rows of new keys; of several incoming rows of a key the first in ``order`` (by default: by all values) goes in."""
    incoming = fold_repeats(incoming.select(*current.columns), list(keys), {}, "keep", order)
    return current.unionByName(incoming.join(current.select(*keys), list(keys), "left_anti").select(*current.columns))


FILL_TEXT = ("title", "rooms", "area", "district", "street", "residential_complex", "metro_station", "agent_name",
             "agent_phone", "commission", "photo_url")


def fill_missing(current: DataFrame, candidate: DataFrame, fields=FILL_TEXT, key="id", flat: str = D.FLAT,
                 house: str = D.HOUSE, min_description: int = 40) -> DataFrame:
    """Fill only what is missing; add ``changed_fields``.  Descriptions and floors have their own rules."""
    keys = [key] if isinstance(key, str) else list(key)
    cand = candidate.select(*keys, F.struct(*[c for c in candidate.columns if c not in keys]).alias("__cand"))
    joined = current.join(cand, keys, "left")
    have = set(candidate.columns)
    new, kind = {}, F.col("property_type")
    offered = lambda f: F.col(f"__cand.{f}")
    for f in fields:
        if f in have and f in current.columns:
            new[f] = is_blank(f) & ~is_blank(offered(f))
    if "description" in have:
        weak = is_blank("description") | (F.length(F.trim("description")) < min_description)
        new["description"] = weak & (F.length(offered("description")) >= min_description)
    for f, kinds in (("floor", [flat]), ("floors_total", [flat, house])):
        if f in have:
            new[f] = kind.isin(*kinds) & F.col(f).isNull() & offered(f).isNotNull()
    if "agent_type" in have:
        open_type = is_blank("agent_type") | F.col("agent_type").isin("unknown", D.COMMISSION_UNKNOWN)
        new["agent_type"] = open_type & offered("agent_type").isin("owner", "agent", "agency")
    if "photos" in have:
        new["photos"] = F.coalesce(F.size("photos") <= 0, F.lit(True)) & (F.size(offered("photos")) > 0)
    new = {f: F.coalesce(cond, F.lit(False)) for f, cond in new.items()}
    changed = reduce(lambda a, b: a + b, [c.cast("int") for c in new.values()])
    out = joined.withColumn("changed_fields", changed)
    picked = [F.when(new[c], offered(c).cast(current.schema[c].dataType)).otherwise(F.col(c)).alias(c)
              if c in new else F.col(c) for c in current.columns]
    return out.select(*picked, "changed_fields")


def archive_inactive(df: DataFrame, archive: DataFrame, reason: str, asof: str) -> tuple[DataFrame, DataFrame]:
    """(archive, rest): inactive rows not archived yet become one snapshot each and leave the active copy."""
    from rooftree.sources.grids import snapshot_json
    gone = df.where(F.col("status").isin("inactive", "archived"))
    todo = not_archived(gone, archive)
    added = todo.select("catalog", "id", F.expr(asof).alias("archived_at"), F.lit(reason).alias("reason"),
                        snapshot_json(todo).alias("snapshot"))
    return archive.unionByName(added), df.where(~F.col("status").isin("inactive", "archived") | F.col("status").isNull())


def split_catalog(df: DataFrame, wanted: Column, ledgers: dict[str, DataFrame], moved_type: str | None = None,
                  on: str = "id") -> tuple[DataFrame, DataFrame, dict[str, tuple[DataFrame, DataFrame]]]:
    """(kept, moved, ledgers): rows of one type and their ledger rows go to another set of tables."""
    hit = F.coalesce(wanted, F.lit(False))
    moved, kept = df.where(hit), df.where(~hit)
    if moved_type is not None:
        moved = moved.withColumn("property_type", F.lit(moved_type))
    ids = df.where(hit).select(on).distinct()
    parts = {name: (led.join(ids, on, "left_anti"), led.join(ids, on, "left_semi")) for name, led in ledgers.items()}
    return kept, moved, parts


def append_comment(old: Column, note: str) -> Column:
    return F.concat_ws("; ", some(old), F.lit(note))


def clear_invalid_pairs(df: DataFrame, a: str = "floor", b: str = "floors_total", note: str = D.FLOOR_NOTE) -> DataFrame:
    bad = F.coalesce(F.col(a) > F.col(b), F.lit(False))
    return df.withColumns({a: F.when(~bad, F.col(a)), b: F.when(~bad, F.col(b)),
                           "comments": F.when(bad, append_comment(F.col("comments"), note)).otherwise(F.col("comments"))})


def upsert_notes(notes: DataFrame, rows: DataFrame, asof: str, pos: str = "pos", keys=("catalog", "listing_id")
                 ) -> DataFrame:
    """Keep non-empty human notes (last one per row wins); the edit time moves only if the note differs."""
    keys = list(keys)
    ok = rows.where(~is_blank("listing_id") & ~is_blank("note"))
    ok = ok.withColumns({"listing_id": F.trim(F.col("listing_id").cast("string")), "note": F.trim("note")})
    last = ok.groupBy(*keys).agg(F.max_by("note", pos).alias("note"))
    last = last.withColumn("edited_at", F.expr(asof))
    cur = notes.withColumn("listing_id", F.col("listing_id").cast("string"))
    left = cur.select(*keys, F.col("note").alias("__n"), F.col("edited_at").alias("__e"), F.lit(1).alias("__hit"))
    joined = left.join(last, keys, "full_outer")
    same = F.col("note").isNull() | (F.col("__hit").isNotNull() & F.col("__n").eqNullSafe(F.col("note")))
    return joined.select(*keys, F.when(same, F.col("__n")).otherwise(F.col("note")).alias("note"),
                         F.when(same, F.col("__e")).otherwise(F.col("edited_at")).alias("edited_at"))


def page_registry(registry: DataFrame, listings: DataFrame, base: str, asof: str) -> DataFrame:
    """Register a page per active listing; pages whose listing is gone become inactive."""
    live = listings.where(F.col("status") == "active").select(
        "catalog", F.col("id").alias("listing_id"),
        F.concat(F.lit(base + "/listing/"), "catalog", F.lit("/"), F.col("id").cast("string")).alias("url"),
        F.col("updated_at").alias("source_updated_at"))
    keys = ["catalog", "listing_id"]
    old = registry.select(*keys, F.struct("url", "source_updated_at", "active", "created_at", "updated_at").alias("__o"))
    new = live.select(*keys, F.struct("url", "source_updated_at").alias("__n"))
    j = old.join(new, keys, "full_outer")
    now, seen = F.expr(asof), F.col("__n").isNotNull()
    turned_off = ~seen & F.col("__o.active")
    return j.select(
        *keys, F.coalesce("__n.url", "__o.url").alias("url"),
        F.when(seen, F.col("__n.source_updated_at")).otherwise(F.col("__o.source_updated_at")).alias("source_updated_at"),
        seen.alias("active"), F.coalesce(F.col("__o.created_at"), now).alias("created_at"),
        F.when(seen | turned_off, now).otherwise(F.col("__o.updated_at")).alias("updated_at"))


def row_fingerprint(df: DataFrame, cols=tuple(D.FINGERPRINT_FIELDS), photos: str | None = None,
                    version: str = "v1") -> Column:
    """Hash of watched columns, template version and ordered photos."""
    watched = sorted(c for c in cols if c in df.columns)
    parts = [F.lit(version).alias("template"), *[F.col(c) for c in watched]]
    if photos is not None:
        parts.append(F.col(photos).alias("photos"))
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def detect_changes(df: DataFrame, registry: DataFrame, key, print_col: str = "fingerprint") -> DataFrame:
    """new / changed / unchanged against the registered fingerprint."""
    keys = [key] if isinstance(key, str) else list(key)
    known = registry.select(*keys, F.col(print_col).alias("__known"))
    state = (F.when(F.col("__known").isNull(), "new").when(F.col("__known") != F.col(print_col), "changed")
             .otherwise("unchanged"))
    return df.join(known, keys, "left").withColumn("change", state).drop("__known")


def verify_only_changed(before: DataFrame, after: DataFrame, key: str, target: str, expected: DataFrame) -> DataFrame:
    """Counts of planned rows that hold the planned value and of rows where any other column moved."""
    others = [c for c in before.columns if c not in (key, target)]
    mark = lambda df: F.sha2(F.to_json(F.struct(*[F.col(c) for c in others]), {"ignoreNullFields": "false"}), 256)
    b = before.select(key, mark(before).alias("__b"))
    a = after.select(key, F.col(target).alias("__v"), mark(after).alias("__a"))
    j = expected.select(key, F.col("new_value").alias("__want")).join(a, key, "left").join(b, key, "left")
    right = F.col("__v").eqNullSafe(F.col("__want"))
    same = F.col("__a").eqNullSafe(F.col("__b"))
    return j.agg(F.count_if(right & same).alias("verified_rows"), F.count_if(~right).alias("wrong_value_rows"),
                 F.count_if(right & ~same).alias("other_changes"))


def repair_column(df: DataFrame, col: str, expr: Column, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(new snapshot, changed rows with old and new value)."""
    both = df.withColumn("__new", expr)
    changed = both.where(~F.col(col).eqNullSafe(F.col("__new"))).select(
        key, F.col(col).alias("old_value"), F.col("__new").alias("new_value"))
    return both.withColumn(col, F.col("__new")).drop("__new"), changed


def project_contacts_upsert(current: DataFrame, rows: DataFrame, asof: str) -> DataFrame:
    policy = {"first_seen_at": "keep", "last_seen_at": "asof", "updated_at": "asof"}
    incoming = rows.withColumns({"first_seen_at": F.expr(asof), "last_seen_at": F.expr(asof), "updated_at": F.expr(asof)})
    return upsert(current, incoming, ("catalog", "source", "external_id"), policy, asof)


def apply_defaults(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Default labels for blank values of active, non-aggregator rows."""
    open_row = (F.col("status") == "active") & ~F.col("source").startswith(D.AGGREGATOR_PREFIX)
    return df.withColumns({c: F.when(open_row & (F.col(c).isNull() | (F.col(c) == "")), v).otherwise(F.col(c))
                           for c, v in defaults.items()})


def pending(df: DataFrame) -> DataFrame:
    return df.where(F.col("synced_at").isNull() | (F.col("updated_at") > F.col("synced_at")))


def mark_synced(df: DataFrame, results: DataFrame, asof: str, keys=("catalog", "source", "external_id", "operation",
                                                                   "locale")) -> DataFrame:
    """Write sync outcomes back: time on success, error text (and no time) on failure."""
    out = df.join(results.select(*keys, F.col("ok").alias("__ok"), F.col("error").alias("__err")), list(keys), "left")
    done = F.col("__ok").isNotNull()
    return out.withColumns({
        "synced_at": F.when(F.col("__ok"), F.expr(asof)).when(done, None).otherwise(F.col("synced_at")),
        "sync_error": F.when(done, F.when(~F.col("__ok"), F.col("__err"))).otherwise(F.col("sync_error")),
    }).select(*df.columns)


def cooldown_merge(control: DataFrame, event: DataFrame, asof: str) -> DataFrame:
    """Latest cooldown per name and whether it still blocks at ``asof``."""
    both = control.select("name", "cooldown_until").unionByName(event.select("name", "cooldown_until"))
    return both.groupBy("name").agg(F.max("cooldown_until").alias("cooldown_until")).withColumn(
        "blocked", F.coalesce(F.col("cooldown_until") > F.expr(asof), F.lit(False)))


def fill_blank_contacts(df: DataFrame, contacts: DataFrame, key: str = "id", cell: str = "agent_phone") -> DataFrame:
    """Fill only blank phone cells from active public contacts."""
    ok = contacts.where((F.col("status") == "active") & (F.col("contact_method") == "public_phone")
                        & ~is_blank("contact_phone"))
    ok = ok.select("catalog", F.col("listing_id").alias("__id"),
                   F.trim(F.regexp_replace("contact_phone", r"\s*,\s*", " ")).alias("__phone"))
    out = df.join(ok, (df["catalog"] == ok["catalog"]) & (df[key] == ok["__id"]), "left").drop(ok["catalog"])
    return out.withColumn(cell, F.when(is_blank(cell), F.coalesce("__phone", cell)).otherwise(F.col(cell))).select(
        *df.columns)


def fill_phones_from_text(df: DataFrame, source: str = "olx", note: str = D.TEXT_PHONE_NOTE) -> DataFrame:
    """Blank phones of active rows of one source, taken from phone numbers their own text already shows."""
    text = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))
    open_row = (F.col("source") == source) & (F.col("status") == "active") & is_blank("agent_phone")
    out = df.withColumn("__found", F.when(open_row, some(F.array_join(extract_phones(text), " "))))
    hit = F.col("__found").isNotNull()
    return out.withColumns({"agent_phone": F.coalesce("__found", "agent_phone"),
                            "comments": F.when(hit, append_comment(F.col("comments"), note)).otherwise(F.col("comments"))}
                           ).drop("__found")


def refresh_copy(df: DataFrame, title: Column, description: Column) -> DataFrame:
    """(Re)build generated texts of the rows that need it."""
    todo = needs_copy(df).select(F.col("id"), title.alias("__t"), description.alias("__d"))
    out = df.join(todo, "id", "left")
    hit = F.col("__t").isNotNull()
    return out.withColumns({"ai_title": F.when(hit, F.col("__t")).otherwise(F.col("ai_title")),
                            "ai_description": F.when(hit, F.col("__d")).otherwise(F.col("ai_description"))}
                           ).select(*df.columns)
