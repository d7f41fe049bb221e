"""The stored tables as parquet under one root folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.operators.merge import merge_claims, merge_partition_log
from remitlens.schemas import SCHEMAS, columns
from remitlens.session import materialise, method_limit, no_rows

FOLDERS = {
    "claim_import": "staging",
    "claim_reject": "ops",
    "partition_log": "ops",
    "fact_claim_denial_daily": "warehouse",
}
#: Tables split by date, so that a load reads and rewrites only its own dates.
PARTITION_COLUMN = {"claim": "service_from_date", "fact_claim_denial_daily": "service_date"}
#: A row for every date a write of a date-split table touched: the version folder that holds the date from then on, and
#: how many rows it has there (0: the date is empty from then on).  The newest version of a date counts.
MANIFEST = "day date, version bigint, folder string, rows bigint, written_utc timestamp"


def read_staging(
    spark: SparkSession, path: str, source_file: str | None = None, file_format: str = "parquet"
) -> DataFrame:
    """Raw rows as text columns, parquet or CSV with a header; optionally of one source file."""
    reader = spark.read.schema(SCHEMAS["claim_import"])
    if file_format == "csv":
        # Blanks around a value are part of the raw text.
        reader = reader.option("header", True).option("ignoreLeadingWhiteSpace", False)
    rows = reader.format(file_format).load(path)
    return rows if source_file is None else rows.filter(F.col("source_file_name") == source_file)


def dates_of(dates: DataFrame) -> list:
    """The distinct dates in the first column of ``dates``, ascending: one value per date."""
    first = F.col(dates.columns[0])
    return [row[0] for row in dates.select(first).filter(first.isNotNull()).distinct().orderBy(first).toLocalIterator()]


def on_dates(df: DataFrame, column: str, days: list) -> DataFrame:
    """The rows of ``df`` on the given dates, as a filter that prunes partitions."""
    if not days:
        return df.filter(F.lit(False))
    return df.filter(F.col(column).between(days[0], days[-1]) & F.col(column).isin(days))


class ClaimStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{FOLDERS.get(table, 'source')}/{table}"

    def _hadoop_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        return jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self, path: str):
        configuration = self.spark.sparkContext._jsc.hadoopConfiguration()
        return self._hadoop_path(path).getFileSystem(configuration)

    def _present(self, path: str) -> bool:
        return self._file_system(path).exists(self._hadoop_path(path))

    def exists(self, table: str) -> bool:
        return self._present(self._manifest_path(table) if table in PARTITION_COLUMN else self.path(table))

    def read(self, table: str) -> DataFrame:
        """A table with its declared schema; no rows when it was never written."""
        if not self.exists(table):
            return no_rows(self.spark, SCHEMAS[table])
        if table == "partition_log":
            return self._latest_log()
        if table in PARTITION_COLUMN:
            return self._read_versions(table, self.live(table))
        return self.spark.read.schema(SCHEMAS[table]).parquet(self.path(table)).select(*columns(table))

    def read_dates(self, table: str, days: list) -> DataFrame:
        """The rows of a date-split table on ``days``: only the folders of their current versions are listed and read."""
        return on_dates(self._read_versions(table, self.live(table, days)), PARTITION_COLUMN[table], days)

    # ---- versions of date-split tables

    def _data_path(self, table: str) -> str:
        return f"{self.path(table)}/data"

    def _manifest_path(self, table: str) -> str:
        return f"{self.path(table)}/manifest"

    def _manifest(self, table: str) -> DataFrame:
        if not self._present(self._manifest_path(table)):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self._manifest_path(table))

    def live(self, table: str, days: list | None = None) -> dict:
        """date -> version folder of every date (of ``days``) whose newest version holds rows.

        The manifest has a row per date and write, so it stays small next to the data.
        """
        entries = self._manifest(table)
        if days is not None:
            entries = on_dates(entries, "day", days)
        newest = entries.groupBy("day").agg(
            F.max_by(F.struct("folder", "rows"), F.struct("version", "folder")).alias("newest")
        )
        return {r["day"]: r["newest"]["folder"] for r in newest.toLocalIterator() if r["newest"]["rows"] > 0}

    def _read_versions(self, table: str, live: dict) -> DataFrame:
        if not live:
            return no_rows(self.spark, SCHEMAS[table])
        column, data = PARTITION_COLUMN[table], self._data_path(table)
        paths = [f"{data}/version={folder}/{column}={day.isoformat()}" for day, folder in sorted(live.items())]
        rows = self.spark.read.schema(SCHEMAS[table]).option("basePath", data).parquet(*paths)
        return rows.select(*columns(table))

    def _write_version(self, table: str, df: DataFrame, days: list) -> str:
        """Write ``df`` as a new version of its dates and of ``days``, then switch them in one append to the manifest.

        Until the append, readers see the previous versions; a write that dies before it leaves an unseen folder.
        """
        column = PARTITION_COLUMN[table]
        newest = self._manifest(table).agg(F.max("version")).first()[0] or 0
        folder = f"{newest + 1:010d}-{uuid.uuid4().hex[:8]}"
        path = f"{self._data_path(table)}/version={folder}"
        with method_limit(self.spark):
            df.select(*columns(table)).hint("rebalance", column).write.partitionBy(column).parquet(path)
        # Counted from the files just written: ``df`` may be a long plan and is not run again.
        written = self.spark.read.schema(SCHEMAS[table]).parquet(path)
        counts = {r[0]: r[1] for r in written.groupBy(column).count().toLocalIterator() if r[0] is not None}
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        entries = [(day, newest + 1, folder, counts.get(day, 0), now) for day in sorted(set(days) | set(counts))]
        self._switch(table, entries)
        return folder

    def _switch(self, table: str, entries: list) -> None:
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(self._manifest_path(table))

    def vacuum(self, table: str) -> list[str]:
        """Remove the version folders that no date reads any more; returns their names."""
        keep = set(self.live(table).values())
        data = self._data_path(table)
        if not self._present(data):
            return []
        fs = self._file_system(data)
        gone = []
        for status in fs.listStatus(self._hadoop_path(data)):
            name = status.getPath().getName()
            if name.startswith("version=") and name.removeprefix("version=") not in keep:
                fs.delete(status.getPath(), True)
                gone.append(name.removeprefix("version="))
        return gone

    def replace(self, table: str, df: DataFrame) -> None:
        """Overwrite a table.  ``df`` must not read the table it replaces.

        A date-split table gets a new version of all its dates; dates that ``df`` no longer has become empty.
        """
        if table in PARTITION_COLUMN:
            self._write_version(table, df, list(self.live(table)))
            return
        df.select(*columns(table)).write.mode("overwrite").parquet(self.path(table))

    def append(self, table: str, df: DataFrame) -> None:
        df.select(*columns(table)).write.mode("append").parquet(self.path(table))

    def replace_dates(self, table: str, df: DataFrame, dates: DataFrame) -> None:
        """Replace the rows of the given dates (first column of ``dates``) by a new version; dates without rows in ``df``
        become empty.  ``df`` and ``dates`` are materialised by the caller.  Rebalancing keeps one date together unless it
        is large, in which case it is written by several tasks.
        """
        self._write_version(table, df, dates_of(dates))

    def upsert_claims(self, incoming: DataFrame) -> None:
        """Merge accepted rows, rewriting only the dates they come from or go to.

        ``incoming`` is materialised by the caller.
        """
        current = self.read("claim")
        # Two narrow columns of the stored claims tell where older versions lie.
        left_dates = (
            current.select("claim_id", "service_from_date")
            .join(incoming.select("claim_id"), "claim_id", "left_semi")
            .select("service_from_date")
        )
        dates = materialise(
            left_dates.union(incoming.select("service_from_date")).distinct()
        )
        touched = self.read_dates("claim", dates_of(dates))
        merged = materialise(merge_claims(touched.select(*columns("claim")), incoming))
        self.replace_dates("claim", merged, dates)

    def update_log(self, results: DataFrame) -> None:
        """Fold load results into the log as new versions of their dates."""
        log = self.read("partition_log")
        changed = merge_partition_log(log, results).join(
            results.select("partition_date"), "partition_date", "left_semi"
        )
        versions = self._log_versions()
        newest = versions.agg(F.coalesce(F.max("version"), F.lit(0))).scalar()
        rows = materialise(changed.withColumn("version", (newest + 1).cast("bigint")))
        rows.write.mode("append").parquet(self.path("partition_log"))

    def _log_versions(self) -> DataFrame:
        schema = SCHEMAS["partition_log"].fields
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", version bigint"
        if not self.exists("partition_log"):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(self.path("partition_log"))

    def _latest_log(self) -> DataFrame:
        """The log is only ever appended to; the newest version of a date counts."""
        row = F.struct(*columns("partition_log"))
        return (
            self._log_versions().groupBy(F.col("partition_date").alias("key"))
            .agg(F.max_by(row, "version").alias("row")).select("row.*")
        )
