"""Session construction and shared-storage helpers.

Everything that has to outlive a task (checkpoints and staged
tables) goes under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (local tests) do we
pick one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "kestrel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here assumes (UTC, AQE, no UI)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    defaults.update(conf)
    for k, v in defaults.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``. Where that is unset a local master (tests) gets a
    private folder, any other master an error. It is registered as the RDD checkpoint dir too.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no SparkContext
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        master = sc.master if sc is not None else "remote"
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the whole cluster shares (master: {master})")
        path = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never a machine-local temp dir)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop-compatible) file system."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
    except Exception:  # noqa: BLE001 - no JVM gateway (remote session): ask the reader instead
        try:
            spark.read.format("text").load(path).schema  # noqa: B018
            return True
        except Exception:  # noqa: BLE001
            return False


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path`` on its (Hadoop-compatible) file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def spread(df):
    """``df`` dealt out evenly over as many tasks as a shuffle has.

    For costly work on each row of a small file: a scan makes a task for so many bytes, and at most one for
    each row group, so that a few compressed megabytes with millions of rows would all be worked on by a few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def materialize(df, name: str, **options: str):
    """Write ``df`` once as parquet under the shared folder and read it back.

    For an intermediate that several branches of a plan reuse: it is computed once, the
    lineage is cut (a lost executor re-reads the files instead of recomputing the inputs),
    and the read-back is columnar with statistics for the planner. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)
