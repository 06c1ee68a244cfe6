"""Display cells of the string grid: truncation, none-like values, formula guard, labels."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.facts import label_for
from rooftree.functions.text import as_col, cut, display_id, let, some


def safe_text(c, limit: int | None = None) -> Column:
    """Trimmed, cut if a width is given, none-like values blank, and a quote before anything a grid would run as a formula."""
    def shown(s):
        cell = cut(s, limit)
        return (F.when(F.lower(s).isin("none", "null", "false"), "")
                .when(s.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), cell)).otherwise(cell))

    return F.coalesce(let(F.trim(as_col(c).cast("string")), shown), F.lit(""))


def safe_int(c) -> Column:
    return F.coalesce(as_col(c).cast("string").try_cast("double").try_cast("bigint").cast("string"), F.lit(""))


def number_cell(c) -> Column:
    shown = lambda v: F.when(v == F.floor(v), v.try_cast("bigint").cast("string")).otherwise(v.cast("string"))
    return F.coalesce(let(as_col(c).cast("string").try_cast("double"), shown), safe_text(c))


def image_cell(url) -> Column:
    u = F.coalesce(as_col(url), F.lit(""))
    return F.when(u.startswith("http"), F.concat(F.lit('=IMAGE("'), u, F.lit('")'))).otherwise("")


def label_status(c) -> Column:
    return label_for(F.lower(F.trim(as_col(c))), D.STATUS_LABELS, D.STATUS_UNKNOWN)


def floor_display(floor, total, label) -> Column:
    """"f з t" plus the label when it says something else; the label or the floor alone otherwise."""
    def shown(p):
        f, t, tag = p["f"], p["t"], p["tag"]
        pair = F.concat(f, F.lit(" з "), t)
        return (F.when((f != "") & (t != ""), F.when((tag != "") & (tag != f), F.concat(tag, F.lit("; "), pair))
                       .otherwise(pair)).when(tag != "", tag).otherwise(f))

    return let(F.struct(number_cell(floor).alias("f"), number_cell(total).alias("t"), safe_text(label).alias("tag")), shown)


def address_display(city, street) -> Column:
    return F.concat_ws(", ", some(safe_text(city)), some(safe_text(street)))


def _without(cell: Column, *values) -> Column:
    return let(cell, lambda v: F.when(F.lower(v).isin(*values), "").otherwise(v))


def _or(cell: Column, default: str) -> Column:
    return let(cell, lambda v: F.when(v == "", default).otherwise(v))


def listing_grid_spec(widths: dict[str, int] | None = None) -> dict[str, Column]:
    """Column spec of the 32-column display grid; ``widths`` cuts the cells of the named columns, ``D.GRID_WIDTHS`` as the sheet does."""
    widths = widths or {}
    t = lambda name, value=None: safe_text(name if value is None else value, widths.get(name))
    cells = [
        t("id"), t("external_id", display_id("source", "url", "external_id")), image_cell("photo_url"), t("source"),
        t("operation"), _or(t("property_type"), D.FLAT), t("url"), t("title"), t("ai_title"), t("description"),
        t("ai_description"), safe_int("price_uah"), safe_int("price_usd"), safe_int("price_eur"), t("rooms"), t("area"),
        t("floor"), t("floors_total"), t("district"), _or(t("city"), D.CITY), t("street"), t("residential_complex"),
        t("metro_station"), _without(t("agent_type"), "unknown", "none"), t("agent_name"), t("agent_phone"),
        _without(t("commission"), "false", "none", "0"), t("created_at"), t("updated_at"), t("comments"), F.lit(""), F.lit("")]
    return dict(zip(D.GRID_HEADERS, cells))


def _one_of(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def commercial_grid_spec(df: DataFrame, widths: dict[str, int] | None = None) -> dict[str, Column]:
    """Column spec of the commercial sheet for the columns that ``df`` has; others are blank."""
    widths, g = widths or {}, lambda name: _one_of(df, name)
    t = lambda name, value=None: safe_text(g(name) if value is None else value, widths.get(name))
    n = lambda name: number_cell(g(name))
    yes = lambda name: F.when(F.coalesce(g(name).cast("boolean"), F.lit(False)), "Так").otherwise("")
    joined = lambda name, sep: t(name, F.array_join(g(name), sep) if name in df.columns else None)
    floor = floor_display(g("floor"), g("floors_total"), t("floor_label"))
    cells = [
        t("id"), t("external_id"), image_cell(t("photo_url")), t("source"), F.when(g("operation") == "rent", "Оренда").otherwise("Продаж"), label_status(g("status")),
        *map(t, ("commercial_type", "commercial_subtype", "url", "title", "ai_title", "description", "ai_description")),
        *map(n, ("price_uah", "price_usd", "price_eur")), t("price_period"), *map(n, ("price_per_m2_uah", "price_per_m2_usd", "price_per_m2_eur")), t("price_per_m2_period"),
        n("area_total_m2"), n("area_usable_m2"), floor, n("ceiling_height_m"),
        *map(t, ("district", "city", "street", "full_address", "permitted_use", "condition", "layout_type")), n("electric_power_kw"),
        *map(yes, ("generator", "electricity_backup", "ventilation", "air_conditioning", "facade", "separate_entrance", "showcase_windows", "ramp", "loading_dock")),
        n("parking_spaces"), *map(t, ("advertiser_type", "contact_name", "agency_name")), joined("phones", " "), t("commission_text"), yes("vat_included"),
        n("opex_amount"), yes("utilities_included"), *map(t, ("created_at", "updated_at", "parsed_at")), joined("validation_errors", ", "), t("comments")]
    return dict(zip(D.COMMERCIAL_HEADERS, cells))


def plain_text(c, limit: int | None = None) -> Column:
    """Trimmed, cut if a width is given, with a quote before a formula; none-like words stay."""
    def shown(s):
        return F.when(s.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), s)).otherwise(s)

    return F.coalesce(let(cut(F.trim(as_col(c).cast("string")), limit), shown), F.lit(""))


def house_grid_spec(widths: dict[str, int] | None = None) -> dict[str, Column]:
    """Column spec of the house sheet, named by the catalog's columns."""
    widths = widths or {}
    return {c: image_cell(c) if c == "photo_url" else plain_text(c, widths.get(c)) for c in D.HOUSE_COLUMNS}


def display_projection(df: DataFrame, spec: dict[str, Column] | None = None) -> DataFrame:
    """Project rows to display strings by a header -> expression spec; whole texts unless the spec has widths."""
    spec = spec or listing_grid_spec()
    return df.select(*[expr.alias(header) for header, expr in spec.items()])
