"""W-30: load a table into the warehouse folder.

``append`` keeps history: rows are written partitioned by the snapshot key
with dynamic partition overwrite, so loading a snapshot again replaces only
that snapshot (reruns are idempotent) and other snapshots stay; an empty
input touches no partition, so it needs no probe.  ``replace`` overwrites
the whole table; there an empty input is skipped, as the source system did,
and the probe is cheap because the inputs are written tables.

Reports are published instead: each run writes a new folder, and the catalog table moves to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

SNAPSHOT_COL = "snapshot_date_key"


def load_table(df: DataFrame, path: str, mode: str = "append", partition_col: str = SNAPSHOT_COL,
               skip_empty: bool = True, table: str | None = None) -> bool:
    """Write ``df`` to the parquet table at ``path``; returns False when skipped.

    With ``table`` the data is also a catalog table (external, at ``path``):
    created on the first load, and later snapshot loads go through
    ``insertInto`` with dynamic partition overwrite, which keeps the other
    snapshots (``saveAsTable`` in overwrite mode would replace the table).
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode must be 'append' or 'replace', not {mode!r}")
    if mode == "replace" and skip_empty and df.isEmpty():
        return False
    spark = df.sparkSession
    if table is not None and mode == "append" and spark.catalog.tableExists(table):
        target_cols = spark.table(table).columns  # insertInto is positional
        df.select(*target_cols).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)
        return True
    w = df.write.mode("overwrite")
    if mode == "append":
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_col)
    if table is None:
        w.parquet(path)
    else:
        w.format("parquet").option("path", path).saveAsTable(table)
    return True


def publish(df: DataFrame, folder: str, version: str, table: str | None = None) -> str:
    """Write ``df`` as a new version beside the old ones, ``folder/version``, and only then make it the catalog table.

    Readers that opened the older version keep reading its files; when the write fails the table stays as it was.
    Versions are never deleted here.
    """
    path = f"{folder.rstrip('/')}/{version}"
    df.write.parquet(path)
    if table is not None:
        if df.sparkSession.catalog.tableExists(table):
            df.sparkSession.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        register_table(df.sparkSession, table, path)
    return path


def register_table(spark, table: str, path: str) -> None:
    """A catalog table over the parquet files at ``path``; one that is there sees the files of now."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def register_views(spark, tables: dict[str, str]) -> list[str]:
    """Expose written tables (name -> path) as temporary views for ``spark.sql``.

    E.g. the ``tables`` of a ``run_snapshot`` result: ``fact_customer_360``,
    the dimensions and the six ``olap_*`` reports.
    """
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return sorted(tables)
