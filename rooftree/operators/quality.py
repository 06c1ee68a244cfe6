"""Filters, gates and validation: one pass over the rows, first matching rule wins."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.facts import in_region, property_type_from
from rooftree.functions.text import contains_any, has, is_blank
from rooftree.operators.skew import attach_group


def source_filter(df: DataFrame, exclude_prefix: str | None = D.AGGREGATOR_PREFIX, include=None) -> DataFrame:
    """Rows of the wanted sources: a prefix excluded, or a list included."""
    if include is not None:
        df = df.where(F.col("source").isin(*include))
    return df if exclude_prefix is None else df.where(~F.col("source").startswith(exclude_prefix))


def price_gate(df: DataFrame, rent_min=D.RENT_MIN_UAH, buy_min=D.BUY_MIN_USD) -> DataFrame:
    op = F.col("operation")
    return df.where(F.when(op == "rent", F.col("price_uah") >= rent_min)
                    .when(op == "buy", F.col("price_usd") >= buy_min).otherwise(False))


def intake_reason(row_text: Column, minimums=None, prefix: str = "policy_houses_", region=in_region) -> Column:
    """Combined reason string (price below the operation's minimum, outside the region), NULL when accepted."""
    minimums = minimums or D.INTAKE_MIN_USD
    price = F.col("price_usd")
    low = F.when(F.col("operation") == "rent", F.lit(minimums["rent"])).otherwise(F.lit(minimums["buy"]))
    price_part = (F.when(price.isNull(), "usd_missing")
                  .when(price < low, F.concat(F.lit("usd_below_"), low.cast("string"))))
    place_part = F.when(~region(row_text), "outside_kyiv_region")
    joined = F.concat_ws("_", price_part, place_part)
    return F.when(joined != "", F.concat(F.lit(prefix), joined))


def intake_policy(df: DataFrame, fields=("city", "district", "street", "title", "description"), minimums=None,
                  region=in_region) -> DataFrame:
    text = F.concat_ws(" ", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])
    return df.withColumn("policy_reason", intake_reason(text, minimums, region=region))


def rule_reason(rules=tuple(D.QUALITY_RULES)) -> Column:
    """Reason code of the first rule whose SQL condition holds; NULL conditions do not match."""
    return F.coalesce(*[F.when(F.expr(cond), name) for name, cond in rules])


def quality_gate(df: DataFrame, rules=tuple(D.QUALITY_RULES)) -> DataFrame:
    """Active rows that match a rule go to quarantine with the rule's code as comment."""
    open_row = (F.col("status") == "active") & ~F.col("source").startswith(D.AGGREGATOR_PREFIX)
    df = df.withColumn("__reason", F.when(open_row, rule_reason(rules)))
    hit = F.col("__reason").isNotNull()
    return df.withColumns({"status": F.when(hit, "quarantine").otherwise(F.col("status")),
                           "comments": F.when(hit, F.col("__reason")).otherwise(F.col("comments"))}).drop("__reason")


def quality_restore(df: DataFrame, reasons=tuple(D.RESTORABLE_REASONS)) -> DataFrame:
    """Quarantined rows whose cause is gone become active again."""
    op = F.col("operation")
    priced = F.col("comments").isin(*reasons) & F.col("price_uah").isNotNull() & (
        ((op == "rent") & F.col("price_uah").between(*D.RESTORE_UAH))
        | ((op == "buy") & F.col("price_usd").between(*D.RESTORE_USD)))
    typed = (F.col("comments") == "not_apartment") & F.col("property_type").isin(*D.HOUSE_TYPES)
    back = F.coalesce((F.col("status") == "quarantine") & ~F.col("source").startswith(D.AGGREGATOR_PREFIX)
                      & (priced | typed), F.lit(False))
    return df.withColumns({"status": F.when(back, "active").otherwise(F.col("status")),
                           "comments": F.when(~back, F.col("comments"))})


def needs_backfill(df: DataFrame, core=tuple(D.CORE_FIELDS), flat: str = D.FLAT, house: str = D.HOUSE,
                   contact_source: str = "rieltor") -> DataFrame:
    gap = F.lit(False)
    for name in core:
        gap = gap | is_blank(name)
    kind = F.col("property_type")
    gap = gap | ((kind == flat) & (F.col("floor").isNull() | F.col("floors_total").isNull()))
    gap = gap | ((kind == house) & F.col("floors_total").isNull())
    gap = gap | ((F.col("source") == contact_source) & (is_blank("agent_name") | is_blank("agent_phone")))
    return df.where(F.coalesce(gap, F.lit(False)))


def null_junk_text(df: DataFrame) -> DataFrame:
    """NULL out boilerplate, too short or unwanted texts and false-like values; rents are not 'for sale'."""
    def keep(name, bad):
        return F.when(~F.coalesce(bad, F.lit(False)), F.col(name))

    short = lambda name, n: F.length(F.trim(name)) < n
    any_of = lambda name, words: contains_any(F.col(name), words)
    junk = short("description", 10) | F.lower(F.trim("description")).isin(*D.JUNK_DESCRIPTIONS) | any_of(
        "description", D.JUNK_PHRASES)
    copy = keep("ai_description", short("ai_description", 20) | any_of("ai_description", D.JUNK_COPY_PHRASES))
    copy = F.when(F.col("operation") == "rent", F.replace(copy, F.lit("Продається"), F.lit("Здається в оренду"))
                  ).otherwise(copy)
    fee = keep("commission", F.lower("commission").isin(*D.FALSE_COMMISSIONS))
    return df.withColumns({
        "description": keep("description", junk), "ai_description": copy,
        "ai_title": keep("ai_title", any_of("ai_title", D.JUNK_TITLE_WORDS)),
        "commission": F.when(F.lower(fee).contains("без комісі"), D.COMMISSION_NONE).otherwise(fee),
        "agent_type": keep("agent_type", F.col("agent_type").isin(*D.FALSE_AGENTS))})


def needs_copy(df: DataFrame, banned: str = D.COPY_BANNED, source_len: int = 40) -> DataFrame:
    """Active rows with enough source text whose generated title or text is missing, short, placeholder or unsafe."""
    def weak(name, n, placeholders):
        t = F.lower(F.trim(name))
        return (F.col(name).isNull() | (F.length(F.trim(name)) < n) | t.isin(*placeholders)
                | F.col(name).rlike(r"^#?[0-9]+"))

    title = weak("ai_title", 18, D.PLACEHOLDER_TITLES)
    text = weak("ai_description", 100, D.PLACEHOLDER_COPY) | has(F.col("ai_description"), banned)
    usable = (F.col("status") == "active") & (F.length(F.trim("description")) > source_len)
    return source_filter(df).where(usable & (title | text))


def resolve_catalog(df: DataFrame, wanted: str | None = None) -> DataFrame:
    """Correct the declared type by the title; with ``wanted`` keep only that catalog's rows."""
    out = df.withColumn("property_type", property_type_from("property_type", "title"))
    return out if wanted is None else out.where(F.col("property_type") == wanted)


def url_scope(df: DataFrame, site: str, url: str = "url") -> DataFrame:
    return df.where(F.lower(F.col(url)).contains(site))


# ---- constraints -----------------------------------------------------------------------------
@dataclass
class Constraints:
    not_null: list[str] = field(default_factory=list)
    one_of: dict[str, list] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)      # name -> SQL condition that must not be false
    unique: list[str] = field(default_factory=list)


LISTING_CONSTRAINTS = Constraints(
    not_null=["source", "external_id", "operation", "url"],
    one_of={"operation": ["rent", "buy"], "status": ["active", "inactive", "quarantine", "archived"]},
    checks={"price_not_negative": "price_uah >= 0", "area_positive": "area > 0",
            "floor_not_above_total": "floor <= floors_total"},
    unique=["source", "external_id"])


def validate(df: DataFrame, rules: Constraints = LISTING_CONSTRAINTS) -> DataFrame:
    """Add ``constraint_errors``: ordered names of violated constraints (empty array when valid)."""
    errors = [F.when(F.col(c).isNull(), f"null:{c}") for c in rules.not_null]
    errors += [F.when(~F.col(c).isin(*values), f"enum:{c}") for c, values in rules.one_of.items()]
    errors += [F.when(~F.expr(cond), f"check:{name}") for name, cond in rules.checks.items()]
    if rules.unique:
        df = attach_group(df, rules.unique, {"__copies": F.count(F.lit(1))})
        errors.append(F.when(F.col("__copies") > 1, "unique:" + "+".join(rules.unique)))
    out = df.withColumn("constraint_errors", F.filter(F.array(*errors), lambda e: e.isNotNull()))
    return out.drop("__copies")
