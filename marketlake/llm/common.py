"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlake.session import configure, shared_path

Query = Callable[[SparkSession, str], DataFrame]

# White space of every word and line rule here: [\x20\x09-\x0D].
SPACE = b" \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Rows per Arrow batch: keeps a batch of long documents small in a Python worker.
BATCH_ROWS = "500"


def shipped(module: str) -> None:
    """Send a module's functions along with the tasks, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


shipped(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with the session settings the operators assume."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage and is computed once."""
    path = shared_path(df.sparkSession, label)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))
