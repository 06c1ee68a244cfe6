"""Set operations over catalogs and id lists."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftree import defaults as D
from rooftree.functions.text import has


def union_catalogs(catalogs: dict[str, DataFrame], phone: str = "agent_phone") -> DataFrame:
    """All catalogs in one contact schema (UNION ALL)."""
    def contact(name, df):
        text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))
        number = F.coalesce(F.col(phone), F.lit(""))
        return df.select(F.lit(name).alias("catalog"), F.col("id").alias("listing_id"), F.lower("source").alias("source"),
                         "external_id", "operation", "status", F.col("url").alias("source_url"),
                         number.alias("contact_phone"),
                         F.when(F.trim(number) != "", 1).otherwise(0).cast("bigint").alias("phone_count"),
                         has(text, D.PHONE_IN_TEXT).alias("text_phone_candidate"))
    return reduce(DataFrame.unionByName, [contact(n, df) for n, df in catalogs.items()])


def contact_projection(df: DataFrame, review_source: str = "olx") -> DataFrame:
    """Contact method and origin: published field, phone-like text to review, or the source link only."""
    own = F.trim("contact_phone") != ""
    review = ~own & (F.col("source") == review_source) & F.col("text_phone_candidate")
    return df.withColumns({
        "contact_method": F.when(own, "public_phone").otherwise("source_link"),
        "phone_origin": F.when(own, "public_listing_field").when(review, "public_text_candidate").otherwise(""),
        "needs_review": review, "contact_phone": F.when(own, F.col("contact_phone")).otherwise(""),
        "phone_count": F.when(own, F.col("phone_count")).otherwise(0).cast("bigint")})


def with_manual(df: DataFrame, manual: DataFrame) -> DataFrame:
    """Parsed rows and human-entered rows."""
    return df.unionByName(manual, allowMissingColumns=True)


def ids_minus(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` that are not in ``b``."""
    return a.select(key).subtract(b.select(key))


def ids_intersect(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))
