"""SparkSession settings shared by the library, tests and the bench."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "lakelens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and ANSI left on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (None if unset)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder; set a scratch one only in local mode.

    On a cluster the folder must be shared storage named by the deployment; we
    never invent a machine-local one there.
    """
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):      # local-cluster has several machines' worth of JVMs
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    d = tempfile.mkdtemp(prefix="lakelens-ckpt-", dir=os.environ.get("LAKELENS_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/tables/" + name


def materialize(df):
    """Cut lineage before iterative work (model fitting): the rows are written
    once as parquet in the shared checkpoint folder and read back, so each
    training pass reads stored rows and a lost executor re-reads files instead
    of replaying the whole plan.  (A reliable ``checkpoint()`` would compute the
    plan twice unless it were also cached.)"""
    return stage_table(df, "fit-input")


def spread(df, per_core: int = 2):
    """Rows dealt evenly over all cores.  A small stored table is read by a few
    tasks (one per row group); per-row work that costs far more than the row is
    worth this shuffle of narrow rows."""
    return df.repartition(per_core * df.sparkSession.sparkContext.defaultParallelism)


def deal(df, key: str, rows: int = 5000):
    """Fit input in tasks of some ``rows`` rows, at most one a core, dealt and
    ordered by ``key``.  A stored table of a few MB is read by one or two tasks,
    however much work a forest does on each row; more tasks than cores would only
    shuffle more statistics.  Input that already has as many tasks stays as it is."""
    n = min(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    if n <= df.rdd.getNumPartitions():
        return df
    return materialize(df.repartition(n, key).sortWithinPartitions(key))


def stage_table(df, name: str):
    """Write an intermediate that later stages read several times (and that is
    expensive to derive) as parquet in the shared checkpoint folder, then read
    it back: one computation, and a lost executor re-reads files instead of
    replaying the lineage.  Used for reduced frames (distinct values, token
    counts), never for raw tables."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    STAGED.append(path)
    return spark.read.parquet(path)


STAGED: list[str] = []      # tables this process has staged and not yet deleted


def drop_staged(spark: SparkSession) -> int:
    """Delete the staged tables of this process; call it once the results that
    read them are written.  Returns how many there were."""
    n = len(STAGED)
    while STAGED:
        path = spark._jvm.org.apache.hadoop.fs.Path(STAGED.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n
