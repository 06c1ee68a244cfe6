"""String grids (spreadsheet exports): read with header aliases, conform, check the header, write with a manifest."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rooftree.sources.splits import read_numbered_grid


def find_column(columns: list[str], aliases: list[str]) -> str | None:
    """First column whose trimmed lower-case name is one of the aliases, in alias order."""
    by_name = {}
    for c in columns:
        by_name.setdefault(c.strip().lower(), c)
    return next((by_name[a.lower()] for a in aliases if a.lower() in by_name), None)


def read_grid(spark: SparkSession, path: str, aliases: dict[str, list[str]] | None = None, row_number: str | None = None, one_sheet: bool = False) -> DataFrame:
    """CSV grid with a header row, all cells as text; aliased columns are renamed to their wanted names.

    With ``row_number`` every row carries its 1-based number in its sheet, and cells with line breaks do not keep a file from
    being read in many splits; without it such a file is one split.
    """
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    if row_number is not None:
        df = read_numbered_grid(spark, path, df.columns, row_number, one_sheet)
    return rename_aliases(df, aliases or {})


def rename_aliases(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    for wanted, names in aliases.items():
        found = find_column(df.columns, names)
        if found is None:
            raise ValueError(f"no column for {wanted!r}: expected one of {names}")
        df = df.withColumnRenamed(found, wanted)
    return df


def assert_header(df: DataFrame, columns: list[str]) -> DataFrame:
    """Refuse to go on when the grid's header is not the expected one."""
    if df.columns != list(columns):
        raise ValueError(f"unexpected header: {df.columns}")
    return df


def conform(df: DataFrame, columns: list[str]) -> DataFrame:
    """Wanted columns in order, blank where missing, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit("").alias(c) for c in columns])


def snapshot_json(df: DataFrame) -> Column:
    """Whole row as JSON text, NULL fields included."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def with_snapshot(df: DataFrame, name: str = "snapshot") -> DataFrame:
    return df.withColumn(name, snapshot_json(df))


def write_grid(df: DataFrame, path: str, tab: str = "tab", tabs: list[str] | None = None) -> DataFrame:
    """Write one CSV folder per tab; the returned manifest (tab, n_rows) holds the row count per tab.

    The counts are observed while the rows are written, so nothing is read back.  Without ``tabs`` the names are taken from
    the data first; with them the write is the only job, and rows of a tab that is not named are an error.
    """
    spark, text = df.sparkSession, df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    name = F.col(f"`{tab}`")
    if tabs is None:
        tabs = [r[0] for r in text.select(name).distinct().collect()]  # as many as the folders that the write makes
    seen = Observation()
    counts = [F.count_if(name.eqNullSafe(F.lit(t))).alias(f"tab_{i}") for i, t in enumerate(tabs)]
    watched = text.observe(seen, F.count(F.lit(1)).alias("all"), *counts)
    watched.write.mode("errorifexists").partitionBy(tab).csv(path, header=True, quoteAll=True, escape='"', emptyValue="", nullValue="",
                                                                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows = seen.get
    found = [(t, rows[f"tab_{i}"]) for i, t in enumerate(tabs) if rows[f"tab_{i}"]]
    if sum(n for _, n in found) != rows["all"]:
        raise ValueError(f"rows of other tabs than {tabs}: {rows['all'] - sum(n for _, n in found)}")
    return spark.createDataFrame(found, f"`{tab}` string, n_rows long")
