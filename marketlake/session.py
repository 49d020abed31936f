"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator assumes.  Nothing here depends on cluster
# size: partition counts are left to AQE, which coalesces small shuffles and
# splits skewed join partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs a later shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keeps the map-side group limit active for "last n bars" up to 5000 points
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "8", app: str = "marketlake") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus) if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    A session without that setting uses a folder below the warehouse, which
    executors share as well.  Only a local master (tests, single machine) gets a
    fresh temporary folder, which is then kept for the rest of the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        fresh = tempfile.mkdtemp(prefix="marketlake-")
    else:
        fresh = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{uuid.uuid4().hex}"
    spark.sparkContext.setCheckpointDir(fresh)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below :func:`shared_root`."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job made for itself."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the shared folder."""
    shared = shared_root(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared)
    return df.checkpoint(eager=True)
