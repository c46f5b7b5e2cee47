"""Session helpers: a local session for tests and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan in this package relies on. AQE re-plans joins from
# runtime sizes, splits skewed partitions and coalesces small ones.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_plan_conf(spark: SparkSession) -> SparkSession:
    for key, value in PLAN_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, partitions: int | None = None,
                  app: str = "reelrank") -> SparkSession:
    """A local session for tests and benchmarks (never used by operators)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    )
    for key, value in PLAN_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local=True)
    return spark


def is_one_machine(spark: SparkSession) -> bool:
    """True for ``local`` and ``local[n]``: driver and tasks are one process.
    ``local-cluster[...]`` has executors of its own and is a cluster here."""
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001 - Spark Connect client
        return False
    return master == "local" or master.startswith("local[")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application left in its checkpoint folder
    (checkpoints and written tables). The caller decides when: results that
    still read them must have been written elsewhere."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession, allow_local: bool = False) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is read from the session.
    Only runs in one process (tests, bench, the driver's smoke check) may
    fall back to a fresh temporary folder, when nothing is configured.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not allow_local or not is_one_machine(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for it")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="reelrank-ckpt-"))
    return sc.getCheckpointDir()


def _scratch_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark, allow_local=is_one_machine(spark))
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for it")
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """``df`` written once to the shared checkpoint folder and read back. A
    written table, not ``checkpoint()``: that computes its input twice and
    keeps no statistics."""
    return write_table_once(df, "cut")


def write_bucketed(df, name: str, buckets: int, by: tuple[str, ...],
                   folders: tuple[str, ...] = (), tasks: int | None = None):
    """Write ``df`` as a bucketed table, one file per bucket, under the shared
    checkpoint folder and read it back: joins and groups by ``by`` find its
    rows in place, only the other side moves.

    ``folders``: columns to partition the table by as well. ``tasks``: write
    with so many tasks (a bucket then has several files); 0 if the rows lie as
    they should already."""
    spark = df.sparkSession
    table = f"reelrank_{name}_{uuid.uuid4().hex}"
    rows = df if tasks == 0 else df.repartition(tasks or buckets, *by)
    (rows.write.partitionBy(*folders).bucketBy(buckets, *by).sortBy(*by)
     .option("path", _scratch_path(spark, name)).saveAsTable(table))
    return spark.table(table)


@contextmanager
def tasks_kept_whole(spark: SparkSession):
    """Steps run inside take ``coalesce(1)`` as said: Spark would else add a
    shuffle behind it by its estimate of the size."""
    key = "spark.sql.maxSinglePartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(2 ** 62))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_table_once(df, name: str, sort_by: tuple[str, ...] = ()):
    """Write ``df`` as a parquet table under the shared checkpoint folder
    and read it back: filters reach its scan, and with ``sort_by`` each file
    is sorted so row groups can be skipped by min/max (no extra shuffle)."""
    spark = df.sparkSession
    path = _scratch_path(spark, name)
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
