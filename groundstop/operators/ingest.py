"""Ingest: two raw layouts -> one unified flights table.

Narrow transformations only (project, cast, union): no shuffle between
the CSV scans and the table write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.functions import date_from_parts, number_text
from groundstop.schemas import LEGACY_RENAMES, ROW_KEY, TEXT_NUMBER_COLUMNS, UNIFIED_COLUMNS


def _key(df: DataFrame) -> list[str]:
    return [ROW_KEY] if ROW_KEY in df.columns else []


def normalize_legacy(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Legacy layout -> unified columns.

    The date comes from three double parts via ``make_date``; times and
    the flight number are doubles here and text in the modern layout, so
    they become integer text before the union (``1530.0`` -> ``"1530"``).
    """
    df = raw.withColumn("fl_date", date_from_parts("year", "month", "dayofmonth"))
    df = df.withColumnsRenamed({k: v for k, v in LEGACY_RENAMES.items() if k != v})
    df = df.withColumns({c: number_text(c) for c in TEXT_NUMBER_COLUMNS})
    return df.select(*_key(df), *UNIFIED_COLUMNS, *(keep or []))


def normalize_modern(raw: DataFrame) -> DataFrame:
    """Modern layout -> unified columns (already text times)."""
    df = raw.withColumns({c: F.col(c).cast("string") for c in TEXT_NUMBER_COLUMNS})
    return df.select(*_key(df), *UNIFIED_COLUMNS)


def unify(legacy_raw: DataFrame, modern_raw: DataFrame) -> DataFrame:
    """Union by column name, keeping duplicates (UNION ALL)."""
    return normalize_legacy(legacy_raw).unionByName(normalize_modern(modern_raw))


def prototype_slice(
    legacy_raw: DataFrame, origins: list[str] | str, year_from: int, year_to: int | None = None
) -> DataFrame:
    """Lower-case 25-column projection of legacy rows for some origins and years.

    ``year_from <= year < year_to`` (``year_to`` open when None).  The
    predicates are on raw columns, so they reach the scan.
    """
    origins = [origins] if isinstance(origins, str) else list(origins)
    cond = F.col("origin").isin(origins) & (F.col("year") >= year_from)
    if year_to is not None:
        cond = cond & (F.col("year") < year_to)
    df = legacy_raw.where(cond)
    return normalize_legacy(df).withColumn("diverted", F.col("diverted").cast("double"))


def slice_name(year_from: int, year_to: int | None) -> str:
    return f"{year_from}-{'' if year_to is None else year_to}"


def prototype_slices(legacy_raw: DataFrame, airports: list[str], year_slices: list[tuple[int, int | None]]) -> DataFrame:
    """The prototype rows of all airports and year slices, from one scan, with ``year_slice`` naming the slice.

    A row that lies in several year slices comes back once for each.  The
    filters are on raw columns, so they reach the scan.
    """
    year = F.col("year")
    within = [(year >= low) if high is None else (year >= low) & (year < high) for low, high in year_slices]
    any_slice = within[0]
    for one in within[1:]:
        any_slice = any_slice | one
    names = F.array_compact(F.array(*[F.when(w, F.lit(slice_name(*s))) for w, s in zip(within, year_slices, strict=True)]))
    rows = legacy_raw.where(F.col("origin").isin(list(airports)) & any_slice)
    rows = rows.withColumn("year_slice", F.explode(names))
    return normalize_legacy(rows, keep=["year_slice"]).withColumn("diverted", F.col("diverted").cast("double"))


def _prototype_select() -> list[str]:
    """SQL select items for the unified columns, derived from the declared legacy mapping."""
    legacy_name = {unified: legacy for legacy, unified in LEGACY_RENAMES.items()}
    items = []
    for col in UNIFIED_COLUMNS:
        if col == "fl_date":
            items.append("make_date(CAST(year AS INT), CAST(month AS INT), CAST(dayofmonth AS INT)) AS fl_date")
        elif col in TEXT_NUMBER_COLUMNS:
            items.append(f"CAST(CAST({legacy_name[col]} AS BIGINT) AS STRING) AS {col}")
        elif col == "diverted":
            items.append(f"CAST({legacy_name[col]} AS DOUBLE) AS {col}")
        else:
            items.append(f"{legacy_name[col]} AS {col}")
    return items


def prototype_slice_sql(
    spark, source: str, origin: str, year_from: int, year_to: int | None = None, with_key: bool = True
) -> DataFrame:
    """The prototype projection as a parameterised SQL query on a catalog table or view.

    An alias + cast projection with a filter on origin and a half-open year
    range; the values are bound as named parameters, the source by
    ``IDENTIFIER``.
    """
    items = ([ROW_KEY] if with_key else []) + _prototype_select()
    sql = (
        "SELECT " + ",\n  ".join(items) + "\nFROM IDENTIFIER(:source)\n"
        "WHERE origin = :origin AND year >= :year_from AND (:year_to IS NULL OR year < :year_to)"
    )
    return spark.sql(
        sql, args={"source": source, "origin": origin, "year_from": year_from, "year_to": year_to}
    )
