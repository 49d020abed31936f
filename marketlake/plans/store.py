"""Parquet tables of the schema below one root folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlake.operators import maintain
from marketlake.operators.fetchplan import high_water
from marketlake.operators.latest import latest_per_key
from marketlake.schemas import TABLES


@dataclass(frozen=True)
class Store:
    """Location of the tables; each table is a folder named like it."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(
        self, spark: SparkSession, table: str, start: Column | None = None, end: Column | None = None
    ) -> DataFrame:
        """The stored table, or an empty one before the first write.

        ``start`` and ``end`` (inclusive) bound the time column the table is
        partitioned by; folders outside the range are not opened.
        """
        spec = TABLES[table]
        if (start is not None or end is not None) and spec.partition_source is None:
            raise ValueError(f"{table} is not partitioned by time")
        path = self.path(table)
        if not maintain.stored(spark, path):
            return spark.createDataFrame([], spec.schema)
        stored = maintain.read_table(spark, path, spec.schema)
        if start is not None:
            first = F.to_date(F.date_trunc(spec.partition_unit, start))
            stored = stored.where((F.col("date") >= first) & (F.col(spec.partition_source) >= start))
        if end is not None:
            last = F.to_date(F.date_trunc(spec.partition_unit, end))
            stored = stored.where((F.col("date") <= last) & (F.col(spec.partition_source) <= end))
        return stored.select(*spec.names)

    @staticmethod
    def _partitioned(rows: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
        spec = TABLES[table]
        if spec.partition_source is None:
            return rows, []
        period = F.date_trunc(spec.partition_unit, F.col(spec.partition_source))
        return rows.withColumn("date", F.to_date(period)), ["date"]

    def upsert(self, rows: DataFrame, table: str) -> None:
        """Replace rows by key; tables without a key are appended to.

        The newest row per key wins; equal times are settled by the other
        columns, so that the result does not depend on arrival order.
        """
        spec = TABLES[table]
        if not spec.key:
            return self.append(rows, table)
        rows, partitions = self._partitioned(rows.select(*spec.names), table)
        latest = [c for c in (spec.latest, *spec.names) if c is not None and c not in spec.key]
        after = (lambda fresh: self._raise_marks(fresh, table)) if self._marked(table) else None
        maintain.upsert_table(
            rows, self.path(table), spec.key, list(dict.fromkeys(latest)), partitions, after=after
        )

    def append(self, rows: DataFrame, table: str) -> None:
        partitioned, partitions = self._partitioned(rows.select(*TABLES[table].names), table)
        maintain.append(partitioned, self.path(table), partitions)
        if self._marked(table):
            self._raise_marks(rows, table)

    @staticmethod
    def _marked(table: str) -> list[str]:
        """Key columns besides the time of a keyed series; empty for other tables."""
        spec = TABLES[table]
        return [k for k in spec.key if k != spec.partition_source] if spec.partition_source in spec.key else []

    def marks(self, spark: SparkSession, table: str) -> DataFrame:
        """High-water mark per key of a series: the key columns and the newest stored time, under its own name.

        Kept up by every upsert and append, so that no series folder is opened;
        only a series stored before there were marks is scanned, once.  A job
        that stops between a change and its marks leaves them too low: rows are
        then requested again and replace themselves.
        """
        keys, time = self._marked(table), TABLES[table].partition_source
        if not keys:
            raise ValueError(f"{table} is no keyed series")
        path = f"{self.path(table)}.marks"
        if maintain.stored(spark, path):
            return maintain.read_table(spark, path)
        return high_water(self.read(spark, table), keys, time, time)

    def _raise_marks(self, fresh: DataFrame, table: str) -> None:
        keys, time = self._marked(table), TABLES[table].partition_source
        raised = high_water(fresh, keys, time, time).unionByName(self.marks(fresh.sparkSession, table))
        maintain.upsert_table(raised, f"{self.path(table)}.marks", keys, [time])

    def deduplicated(self, spark: SparkSession, table: str) -> DataFrame:
        """The stored table with one row per key."""
        spec = TABLES[table]
        return latest_per_key(self.read(spark, table), spec.key, [spec.latest])
