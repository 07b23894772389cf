"""Session set-up and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs count on. Sizes follow the input: AQE splits and coalesces.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, whatever folder the driver was started in. Spark's own
    file server takes it from the driver; it is a few hundred kilobytes, once a session."""
    context = spark.sparkContext
    if context in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallybook-"), "tallybook.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.join("tallybook", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _SHIPPED.add(context)


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               # Checkpoints go when nothing refers to them any more.
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def size_shuffles(df: DataFrame) -> int:
    """Let shuffles start with as many partitions as the table has bytes for: two a task that reads
    it, no fewer than the session's own number. AQE joins those that turn out small."""
    spark = df.sparkSession
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 2 * df.rdd.getNumPartitions())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return wanted


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate table, wherever its file system is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. The cluster names it in spark.checkpoint.dir; only a
    session without that setting (a local test) falls back to a fresh temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        current = tempfile.mkdtemp(prefix="tallybook-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which outlives lost executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{os.urandom(6).hex()}")
