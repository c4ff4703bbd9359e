"""Publication of a table's next version behind a view that changes in one statement.

Readers use the view.  A new version is written as a table of its own; only
when that is complete is the view pointed at it, by one ``CREATE OR REPLACE
VIEW``.  So there is no moment without a table, a failed or interrupted
write leaves the old version in place, and a reader that has planned its
query on the old version can finish, since that one is kept until the next
publication.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from groundstop.sources.tables import ensure_database, save_table

_MARK = "__v_"


def _split(name: str) -> tuple[str, str]:
    namespace, _, base = name.rpartition(".")
    return (f"{namespace}." if namespace else ""), base


def versions(spark: SparkSession, name: str) -> list[str]:
    """The stored versions of a published table (their names hold no order)."""
    namespace, base = _split(name)
    where = f" IN {namespace[:-1]}" if namespace else ""
    found = spark.sql(f"SHOW TABLES{where} LIKE '{base}{_MARK}*'").collect()  # a few
    return [f"{namespace}{r['tableName']}" for r in found]


def current_version(spark: SparkSession, name: str) -> str | None:
    """The stored version that the view points at."""
    if not spark.catalog.tableExists(name):
        return None
    return next((r["data_type"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").selectExpr("key", "value AS data_type").collect() if r["key"] == "groundstop.version"), None)


def publish_table(df: DataFrame, name: str, fmt: str = "parquet") -> str:
    """Make ``df`` the content and schema of ``name``; ``df`` may read the version it replaces.

    A plain table of that name, from before its first publication, becomes
    the version that is replaced (the one step that is not a single
    statement).
    """
    spark = df.sparkSession
    namespace, base = _split(name)
    ensure_database(spark, name)
    fresh = f"{namespace}{base}{_MARK}{uuid.uuid4().hex[:12]}"
    try:
        save_table(df, fresh, fmt)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    old = current_version(spark, name)
    if old is None and spark.catalog.tableExists(name):
        old = f"{namespace}{base}{_MARK}{uuid.uuid4().hex[:12]}"
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('groundstop.version' = '{fresh}') AS SELECT * FROM {fresh}")
    for table in versions(spark, name):
        if table not in (fresh, old):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return name
