"""Money expressions: price text, currency conversion, rates, commercial total/rate prices."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.text import as_col, clean_text, contains_any, has, let, rx


def _count(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def currency_of(c) -> Column:
    raw = F.coalesce(as_col(c), F.lit(""))
    up, low = F.upper(raw), F.lower(raw)
    return (F.when(raw.contains("$") | up.contains("USD"), "USD")
            .when(raw.contains("€") | up.contains("EUR"), "EUR")
            .when(low.contains("грн") | up.contains("UAH") | raw.contains("₴"), "UAH").otherwise(""))


def parse_price(c) -> Column:
    """Price text to struct(amount, currency); thousands marks, decimal comma and joined digits handled."""
    raw = F.coalesce(as_col(c), F.lit(""))
    positive = lambda text: let(text.try_cast("double"), lambda v: F.when(v > 0, v))

    def amount(kept):
        plain = (F.when(_count(kept, ".") > 1, F.replace(kept, F.lit("."), F.lit("")))
                 .when(_count(kept, ",") > 1, F.replace(kept, F.lit(","), F.lit(""))).otherwise(kept))
        direct = positive(F.replace(plain, F.lit(","), F.lit(".")))
        joined = positive(F.regexp_replace(raw, r"(?U)\D", ""))
        return F.coalesce(direct, F.when(kept != "", joined))

    kept = F.btrim(F.regexp_replace(raw, r"(?U)[^\d.,]", ""), F.lit(".,"))
    return F.struct(let(kept, amount).alias("amount"), currency_of(raw).alias("currency"))


def _rate(rates, code: str) -> Column:
    value = rates[code]
    return value if isinstance(value, Column) else F.lit(float(value))


def convert_currency(amount, currency, rates=None) -> Column:
    """Amount to struct(uah, usd, eur), whole numbers, half-even; unknown currency passes through."""
    rates = rates or D.FALLBACK_RATES
    a, cur = as_col(amount).cast("double"), F.upper(as_col(currency))
    usd, eur = _rate(rates, "USD"), _rate(rates, "EUR")

    def by(uah, dollars, euros, other):
        return F.bround(F.when(cur == "UAH", uah).when(cur == "USD", dollars).when(cur == "EUR", euros)
                        .otherwise(other), 0)

    return F.struct(by(a, a * usd, a * eur, a).alias("uah"),
                    by(a / usd, a, a * eur / usd, a).alias("usd"),
                    by(a / eur, a * usd / eur, a, a).alias("eur"))


def pick_rates(items: DataFrame, codes=None, fallback=None) -> DataFrame:
    """Rate board rows (code_a, code_b, rate_sell, rate_buy, rate_cross) to one row (usd, eur).

    Both currencies must be quoted, otherwise the fallback pair is used as a whole.
    """
    codes, fallback = codes or D.RATE_CODES, fallback or D.FALLBACK_RATES
    quote = F.coalesce(*[F.when(F.col(c) != 0, F.col(c)) for c in ("rate_sell", "rate_buy", "rate_cross")])
    pair = lambda code: F.max(F.when((F.col("code_a") == codes[code]) & (F.col("code_b") == codes["UAH"]), quote))
    both = items.agg(pair("USD").alias("u"), pair("EUR").alias("e"))
    ok = F.col("u").isNotNull() & F.col("e").isNotNull()
    return both.select(F.when(ok, F.col("u")).otherwise(fallback["USD"]).cast("double").alias("usd"),
                       F.when(ok, F.col("e")).otherwise(fallback["EUR"]).cast("double").alias("eur"))


def fill_prices(df: DataFrame, rates=None) -> DataFrame:
    """Cross-fill a missing currency, in order: EUR from UAH, EUR from USD, USD from UAH, UAH from USD."""
    rates = rates or D.CLEANUP_RATES
    usd, eur = F.lit(rates["USD"]), F.lit(rates["EUR"])
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    df = df.withColumn("price_eur", F.coalesce("price_eur", F.round(positive("price_uah") / eur),
                                               F.round(positive("price_usd") * usd / eur)))
    df = df.withColumn("price_usd", F.coalesce("price_usd", F.round(positive("price_uah") / usd)))
    return df.withColumn("price_uah", F.coalesce("price_uah", F.round(positive("price_usd") * usd)))


# ---- commercial prices: totals and per-square-metre rates -------------------------------------
_RATE_TAIL = rf"(\s*(?:/|за\s*){D.SQUARE_UNIT})?"
_SUFFIX = rf"(?iu)(\d[\d\s.,]*)\s*({D.MONEY_TOKEN}){_RATE_TAIL}"
_PREFIX = rf"(?iu)({D.MONEY_TOKEN})\s*(\d[\d\s.,]*){_RATE_TAIL}"
RATE_MARKER = rf"(?:{D.MONEY_TOKEN})\s*(?:/|за\s*){D.SQUARE_UNIT}"


def loose_number(c) -> Column:
    return F.replace(F.replace(as_col(c).cast("string"), F.lit(" "), F.lit("")), F.lit(","), F.lit(".")).try_cast(
        "double")


def _currency_token(c: Column) -> Column:
    return let(F.lower(c), lambda low: F.when(low.isin("$", "usd") | low.startswith("дол"), "USD")
               .when(low.isin("€", "eur"), "EUR").otherwise("UAH"))


def _mentions(text: Column, pattern: str, amount_group: int, currency_group: int, tie: int) -> Column:
    """All money mentions of one shape with their start offset (pieces and matches before it).

    The text is searched once; the shapes look at nothing around a match, so its groups are found in the match alone.
    """
    def placed(whole, pieces):
        def one(item, i):
            before = F.array_join(F.slice(pieces, F.lit(1), i + 1), "")
            earlier = F.array_join(F.slice(whole, F.lit(1), i), "")
            group = lambda n: F.regexp_extract(item, pattern, n)
            return F.struct((F.length(before) + F.length(earlier)).alias("at"), F.lit(tie).alias("tie"),
                            loose_number(group(amount_group)).alias("amount"),
                            _currency_token(group(currency_group)).alias("currency"), (group(3) != "").alias("is_rate"))

        return F.transform(whole, one)

    return let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda whole: let(
        F.when(F.size(whole) > 0, F.split(text, pattern, -1)), lambda pieces: placed(whole, pieces)))


def period_of(text: Column, operation: Column) -> Column:
    low = F.lower(text)
    out = F.when(contains_any(low, D.PERIOD_MARKS[0][1]), D.PERIOD_MARKS[0][0])
    for name, marks in D.PERIOD_MARKS[1:]:
        out = out.when(contains_any(low, marks), name)
    return out.when(operation == "buy", "total").otherwise("unknown")


def parse_commercial_price(raw, operation, area) -> Column:
    """struct(total, currency, period, rate, rate_currency, rate_period); the missing side comes from the area."""
    operation, area = as_col(operation), as_col(area).cast("double")

    def scan(text):
        found = F.array_sort(F.concat(_mentions(text, _SUFFIX, 1, 2, 0), _mentions(text, _PREFIX, 2, 1, 1)))
        pick = lambda ms, rate: F.try_element_at(F.filter(
            ms, lambda m: m["amount"].isNotNull() & (m["is_rate"] == F.lit(rate))), F.lit(1))
        return let(found, lambda ms: F.struct(
            pick(ms, False).alias("total"), pick(ms, True).alias("rate"), (F.size(ms) == 0).alias("silent"),
            F.when(F.size(ms) == 0, loose_number(rx(text, r"(?:ціна|price)\s*[:\-]?\s*(\d[\d\s.,]*)"))).alias("labelled"),
            period_of(text, operation).alias("period")))

    return let(let(clean_text(raw), scan), lambda s: _settle(s, area))


def _settle(s: Column, area: Column) -> Column:
    """Derive the missing one of total and rate from the area."""
    total, rate, period, labelled = s["total"], s["rate"], s["period"], s["labelled"]
    sized = F.when(area > 0, area)
    none = total.isNull() & rate.isNull()
    total_amount = (F.when(none, F.when(s["silent"], labelled))
                    .when(total.isNotNull(), total["amount"]).otherwise(rate["amount"] * sized))
    rate_amount = F.when(rate.isNotNull(), rate["amount"]).otherwise(total["amount"] / sized)
    unknown = F.lit("UNKNOWN")
    return F.struct(
        total_amount.alias("total"),
        F.when(none, unknown).otherwise(F.coalesce(total["currency"], rate["currency"])).alias("currency"),
        period.alias("period"),
        F.when(~none, rate_amount).alias("rate"),
        F.when(none, unknown).otherwise(F.coalesce(rate["currency"], total["currency"])).alias("rate_currency"),
        F.when(~none & rate_amount.isNotNull(), period).otherwise("unknown").alias("rate_period"))


def price_from_listing(raw, title, description, operation, area) -> Column:
    """Price field first; a per-metre rate in the text corrects a rate disguised as a total (rent <= 500)."""
    operation, area = as_col(operation), as_col(area).cast("double")
    context = F.concat_ws(" ", F.coalesce(as_col(title), F.lit("")), F.coalesce(as_col(description), F.lit("")))
    return let(F.struct(parse_commercial_price(raw, operation, area).alias("own"),
                        has(as_col(raw), RATE_MARKER, "(?iu)").alias("in_raw"),
                        has(context, RATE_MARKER, "(?iu)").alias("in_context")),
               lambda p: let(F.when(p["in_context"] & ~p["in_raw"], parse_commercial_price(context, operation, area)),
                             lambda ctx: _choose_price(p["own"], ctx, p["in_raw"], p["in_context"], operation, area)))


def _choose_price(own, ctx, rate_in_raw, rate_in_context, operation, area) -> Column:
    small = (operation == "rent") & (own["total"] <= 500)
    use_context = (rate_in_context & ~rate_in_raw & ctx["rate"].isNotNull()
                   & (own["total"].isNull() | F.coalesce(small, F.lit(False))))
    disguised = ((operation == "rent") & (area >= 50) & own["currency"].isin("UAH", "USD", "EUR")
                 & (own["total"] > 0) & (own["total"] <= 500)) & ~(rate_in_context & rate_in_raw)

    def build(total, cur, period, rate, rate_cur, rate_period):
        return F.struct(total.alias("total"), cur.alias("currency"), period.alias("period"), rate.alias("rate"),
                        rate_cur.alias("rate_currency"), rate_period.alias("rate_period"))

    from_context = build(F.when(area != 0, ctx["rate"] * area), ctx["rate_currency"], ctx["rate_period"],
                         ctx["rate"], ctx["rate_currency"], ctx["rate_period"])
    from_disguise = build(own["total"] * area, own["currency"], own["period"], own["total"], own["currency"],
                          own["period"])
    return (F.when(use_context, from_context).when(F.coalesce(disguised, F.lit(False)), from_disguise)
            .otherwise(own))
