"""Upsert, append, swap, export and import of stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
import json
from operator import and_
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from marketlake.functions import epoch_to_ts, strip_suffix, ts_to_iso_full, zero_date_to_null
from marketlake.operators.latest import latest_per_key
from marketlake.sources.tables import table_columns


def _without_keys(existing: DataFrame, arriving: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows whose key does not arrive; null key parts count as equal."""
    arriving = arriving.select(*[F.col(k).alias(f"{k}_in_") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_in_")) for k in keys])
    return existing.join(arriving, same, "left_anti")


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], latest: Sequence[str | Column]
) -> DataFrame:
    """Existing rows whose key does not arrive again, plus the newest incoming row per key."""
    incoming = incoming.select(*existing.columns)
    kept = _without_keys(existing, incoming.select(*keys).distinct(), keys)
    return kept.unionByName(latest_per_key(incoming, keys, latest))


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def _discard(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    fs, old = _fs(spark, source)
    return fs.rename(old, _fs(spark, target)[1])


def _write_note(spark: SparkSession, path: str, note: dict) -> None:
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(json.dumps(note).encode()))
    out.close()


def _read_note(spark: SparkSession, path: str) -> dict | None:
    if not _exists(spark, path):
        return None
    return json.loads("".join(row.value for row in spark.read.text(path, wholetext=True).collect()))


# --- changes that take effect in one step ------------------------------------
#
# A change is written next to the table.  Renaming its note to ``<table>.pending``
# is the one step in which it takes effect: from then on readers take the touched
# folders from there.  Moving the folders in is tidying up that anyone can repeat:
# each folder is removed and renamed in, and until then it is read from the change.


def _base(path: str) -> str:
    return path.rstrip("/")


def _commit(spark: SparkSession, staged: str, path: str, note: dict) -> None:
    _write_note(spark, f"{staged}/_note", {**note, "staged": staged})
    if not _rename(spark, f"{staged}/_note", f"{_base(path)}.pending"):
        raise RuntimeError(f"another change of {path} is pending")


def _folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Partition folders below ``root``, relative to it: one entry per folder of the change."""
    found = [""]
    for _ in range(depth):
        below = []
        for folder in found:
            fs, target = _fs(spark, f"{root}/{folder}")
            names = [status.getPath().getName() for status in fs.listStatus(target) if status.isDirectory()]
            below += [f"{folder}/{name}" if folder else name for name in names if "=" in name]
        found = below
    return found


def _move_in(spark: SparkSession, path: str, note: dict) -> None:
    merged, path = f"{note['staged']}/merged", _base(path)
    if not _exists(spark, merged):
        return
    if not note["partition_by"] or not _exists(spark, path):
        _discard(spark, path)
        _rename(spark, merged, path)
        return
    for folder in _folders(spark, merged, len(note["partition_by"])):
        # an encoded name is taken as it stands
        _discard(spark, f"{path}/{folder}")
        parent = _fs(spark, f"{path}/{folder}")[1].getParent()
        _fs(spark, path)[0].mkdirs(parent)
        _rename(spark, f"{merged}/{folder}", f"{path}/{folder}")


def settle(spark: SparkSession, path: str) -> None:
    """Finish a change that took effect but was not moved in; nothing to do otherwise."""
    note = _read_note(spark, f"{_base(path)}.pending")
    if note is None:
        return
    _move_in(spark, path, note)
    if note.get("stream"):
        _write_note(spark, f"{_base(path)}.batches/{note['stream']}", {"batch": note["batch"]})
    _discard(spark, f"{_base(path)}.pending")
    _discard(spark, note["staged"])


def stored(spark: SparkSession, path: str) -> bool:
    """Whether the table exists, be it as a change not yet moved in."""
    return _exists(spark, path) or _exists(spark, f"{_base(path)}.pending")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table as of its last change, moved in or not."""
    reader = spark.read.schema(schema) if schema else spark.read
    note = _read_note(spark, f"{_base(path)}.pending")
    merged = f"{note['staged']}/merged" if note else ""
    if not note or not _exists(spark, merged):
        return reader.parquet(path)
    parts = note["partition_by"]
    if not parts or not _exists(spark, path):
        return reader.parquet(merged)
    if not _folders(spark, merged, len(parts)):
        return reader.parquet(path)
    fresh = reader.parquet(merged)
    return _without_keys(reader.parquet(path), fresh.select(*parts).distinct(), parts).unionByName(fresh)


def last_batch(spark: SparkSession, path: str, stream: str) -> int:
    """Number of the last micro-batch of ``stream`` that the table holds, -1 before the first."""
    note = _read_note(spark, f"{_base(path)}.pending")
    if not note or note.get("stream") != stream:
        note = _read_note(spark, f"{_base(path)}.batches/{stream}")
    return note["batch"] if note else -1


def _gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition folder together for writing.

    Rebalancing merges small folders into few files and splits a heavy one over
    several tasks.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a Parquet table."""
    settle(df.sparkSession, path)
    _gathered(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def _stored_schema(spark: SparkSession, path: str, rows: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """Schema of a stored table; partition columns keep the type of the rows, not that guessed from folder names."""
    stored = spark.read.parquet(path).schema
    return T.StructType([rows.schema[f.name] if f.name in partition_by else f for f in stored.fields])


def _prune(existing: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Restrict the scan to the touched partition folders before it is planned.

    Only partition values reach the driver, one per folder that is about to be
    rewritten; the file listing of the same folders is larger than that.
    """
    values = touched.collect()
    for c in partition_by:
        present = {row[c] for row in values}
        wanted = F.col(c).isin([v for v in present if v is not None])
        existing = existing.where(wanted | F.col(c).isNull() if None in present else wanted)
    return existing


def upsert_table(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    latest: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    batch: tuple[str, int] | None = None,
    after: Callable[[DataFrame], None] | None = None,
) -> None:
    """Upsert into a Parquet table, rewriting only the partitions that are touched.

    ``partition_by`` columns must be part of the key or follow from it.  The
    incoming rows are written once, cleaned, next to the table, then the merged
    partitions; the change takes effect in one step (see :func:`read_table`) and
    its folders are then renamed in, with no further copy.  A failure before that
    step leaves the table as it was; after it, the next reader, writer or
    :func:`settle` sees the change.  One writer at a time.

    ``batch`` (stream, number) is recorded with the change; ``after`` gets the
    cleaned incoming rows once the change took effect.
    """
    spark = incoming.sparkSession
    settle(spark, path)
    staged = f"{_base(path)}.staged-{uuid.uuid4().hex}"
    note = {"partition_by": list(partition_by)}
    if batch:
        note |= {"stream": batch[0], "batch": batch[1]}
    try:
        if not _exists(spark, path):
            fresh = latest_per_key(incoming, keys, latest)
            _gathered(fresh, partition_by).write.partitionBy(*partition_by).parquet(f"{staged}/merged")
            fresh = spark.read.schema(incoming.schema).parquet(f"{staged}/merged")
        else:
            schema = _stored_schema(spark, path, incoming, partition_by)
            existing = spark.read.schema(schema).parquet(path)
            latest_per_key(incoming, keys, latest).select(*existing.columns).write.parquet(f"{staged}/incoming")
            fresh = spark.read.schema(schema).parquet(f"{staged}/incoming")
            if fresh.head(1):
                if partition_by:
                    touched = fresh.select(*partition_by).distinct()
                    existing = _prune(existing, touched, partition_by).join(touched, list(partition_by), "left_semi")
                merged = _without_keys(existing, fresh, keys).unionByName(fresh)
                _gathered(merged, partition_by).write.partitionBy(*partition_by).parquet(f"{staged}/merged")
        _commit(spark, staged, path, note)
    except BaseException:
        _discard(spark, staged)
        raise
    if after:
        after(fresh)
    settle(spark, path)


def upsert_batches(
    path: str, keys: Sequence[str], latest: Sequence[str], partition_by: Sequence[str] = (), stream: str | None = None
):
    """``foreachBatch`` handler: a replayed micro-batch leaves the same table.

    With a ``stream`` name the number of the last batch is stored in the same
    step as its rows, and a batch that is delivered again is not computed at all.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if stream is None:
            # an empty batch is staged like any other: asking first would run the stateful plan twice
            upsert_table(batch, path, keys, latest, partition_by)
        elif last_batch(batch.sparkSession, path, stream) < batch_id:
            upsert_table(batch, path, keys, latest, partition_by, (stream, batch_id))

    return write


def _version_of(spark: SparkSession, view: str) -> str:
    """The table that a published view shows."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {view}").where("col_name = 'View Text'").collect()
    return rows[0]["data_type"].rsplit(" ", 1)[1]


def publish_table(
    spark: SparkSession, name: str, rows: DataFrame, location: str, partition_by: Sequence[str] = ()
) -> None:
    """Write ``rows`` as a new version, complete with its partitions, then show it under ``name`` in one step.

    ``name`` is a view over the version's table; versions shown before stay
    until they are dropped.
    """
    version = _write_version(spark, name, rows, location, partition_by)
    shown = spark.catalog.tableExists(name)
    spark.sql(f"{'ALTER' if shown else 'CREATE'} VIEW {name} AS SELECT * FROM {version}")


def _write_version(
    spark: SparkSession, name: str, rows: DataFrame, location: str, partition_by: Sequence[str]
) -> str:
    """A table of its own with ``rows`` and all partitions, not yet shown to anyone."""
    version = f"{name}__{uuid.uuid4().hex}"
    ordered = rows.select(*[c for c in rows.columns if c not in partition_by], *partition_by)
    _gathered(ordered, partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(location)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {version} ({ddl}) USING parquet{parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {version}")
    return version


def swap_table(spark: SparkSession, table: str, rebuilt: DataFrame, location: str) -> None:
    """Write ``rebuilt`` to a new location, then let ``table`` show it, in one step.

    Readers see the old or the new version; failures raise and leave the old.
    That is one step for a published view (see :func:`publish_table`) and for a
    table without partitions.  A partitioned table cannot change its partitions
    in one: its new version is completed aside and then renamed, so that readers
    find the old table, for a moment none, or the new one, never an empty one.
    """
    if spark.catalog.getTable(table).tableType == "VIEW":
        columns = spark.catalog.listColumns(_version_of(spark, table))
        publish_table(spark, table, rebuilt, location, [c.name for c in columns if c.isPartition])
        return
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if partitions:
        version = _write_version(spark, table, rebuilt, location, partitions)
        spark.sql(f"ALTER TABLE {table} RENAME TO {version}_before")
        try:
            spark.sql(f"ALTER TABLE {version} RENAME TO {table}")
        except BaseException:
            spark.sql(f"ALTER TABLE {version}_before RENAME TO {table}")
            raise
        spark.sql(f"DROP TABLE {version}_before")
        return
    rebuilt.write.mode("errorifexists").parquet(location)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)


def deduplicate_table(
    spark: SparkSession, table: str, keys: Sequence[str], latest: Sequence[str | Column], location: str
) -> None:
    """Keep the newest row per key of a catalog table (create, then swap)."""
    current = spark.table(table)
    clean = latest_per_key(current, keys, latest).select(*table_columns(current))
    swap_table(spark, table, clean, location)


def migrate_table(spark: SparkSession, table: str, columns: Sequence[str], location: str) -> None:
    """Turn epoch columns of a catalog table into timestamps: copy, then swap."""
    current = spark.table(table)
    if spark.catalog.getTable(table).tableType != "VIEW":
        raise ValueError(f"{table} is no published view: a change of types needs one (publish_table)")
    swap_table(spark, table, migrate_epochs(current, columns).select(*table_columns(current)), location)


def migrate_epochs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn epoch-second columns into timestamps, in place and in order."""
    return df.withColumns({c: epoch_to_ts(c) for c in columns})


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV without header, comma separated, double-quoted, in declared column order."""
    df.select(*(columns or df.columns)).write.option("header", False).option("sep", ",").option(
        "quote", '"'
    ).option("escape", '"').csv(path)


def write_database(
    df: DataFrame, url: str, table: str, batch_size: int = 10000, properties: dict[str, str] | None = None
) -> None:
    """Append to a database table with batched parameterised inserts."""
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=str(batch_size), **(properties or {})
    ).save()


def timestamps_to_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Export form: timestamps (or text with zero dates) as ISO text named ``<column>_str``, microseconds kept."""
    types = dict(df.dtypes)

    def text(c: str) -> Column:
        value = F.try_to_timestamp(zero_date_to_null(c)) if types[c] == "string" else F.col(c)
        return ts_to_iso_full(value).alias(f"{c}_str")

    return df.select(*[text(c) if c in columns else F.col(c) for c in df.columns])


def text_to_timestamps(df: DataFrame, suffix: str = "_str", columns: Sequence[str] | None = None) -> DataFrame:
    """Import form: ``<column>_str`` text back to timestamps under the plain name.

    ``columns`` lists the names to restore; other columns with the suffix stay
    as they are.  Without it every such column is restored, and text that is no
    timestamp raises rather than turning into null.
    """
    names = strip_suffix(df.columns, suffix)
    if columns is not None:
        names = {old: new if new in columns and old not in columns else old for old, new in names.items()}
    if len(set(names.values())) < len(names):
        raise ValueError(f"a column and its {suffix} form occur together: {sorted(names)}")

    def restore(old: str, new: str) -> Column:
        if old == new:
            return F.col(old)
        parsed = F.try_to_timestamp(zero_date_to_null(old)).cast("timestamp_ntz")
        if columns is None:
            wrong = F.raise_error(F.concat(F.lit(f"{old} is no timestamp: "), F.col(old))).cast("timestamp_ntz")
            parsed = F.when(zero_date_to_null(old).isNotNull() & parsed.isNull(), wrong).otherwise(parsed)
        return parsed.alias(new)

    return df.select(*[restore(old, new) for old, new in names.items()])


def export_chunks(
    df: DataFrame, path: str, order: Sequence[str], chunk: str = "chunk_start", partitions: int | None = None
) -> None:
    """Snappy Parquet, one folder per chunk, sorted inside each file.

    Rows are spread by range over the chunk *and* the sort columns, so a heavy
    chunk is written by several tasks as consecutive files.
    """
    columns = [chunk, *[c for c in order if c != chunk]]
    spread = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    spread.sortWithinPartitions(*columns).write.partitionBy(chunk).option("compression", "snappy").parquet(path)


def import_chunks(
    spark: SparkSession, path: str, chunk: str = "chunk_start", columns: Sequence[str] | None = None
) -> DataFrame:
    """Read exported chunks back in table form; ``columns`` are the table's, see :func:`text_to_timestamps`."""
    return text_to_timestamps(spark.read.parquet(path).drop(chunk), columns=columns)


__all__ = [
    "append",
    "deduplicate_table",
    "last_batch",
    "migrate_table",
    "publish_table",
    "read_table",
    "settle",
    "stored",
    "export_chunks",
    "import_chunks",
    "migrate_epochs",
    "swap_table",
    "text_to_timestamps",
    "timestamps_to_text",
    "upsert",
    "upsert_batches",
    "upsert_table",
    "write_csv",
    "write_database",
]
