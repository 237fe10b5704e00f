"""Session construction and shared scratch locations.

On a cluster the operator of the cluster names a shared folder in
``spark.checkpoint.dir``; everything we write (checkpoints, stream sinks,
materialised intermediate tables) goes below it.  Only when the setting is
absent (unit tests, local runs) do we fall back to a fresh local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "trellis", extra: dict | None = None) -> SparkSession:
    """A session configured the way every job in this package expects.

    AQE stays on (partition coalescing, skew-join splitting, runtime
    broadcast demotion); the UI stays off; timestamps are read in UTC.  The
    number of shuffle partitions and the driver's heap are the cluster's own
    settings; only for a local master are they set here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("TRELLIS_DRIVER_MEMORY", "8g")
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting it only where the session has none.

    ``spark.checkpoint.dir`` (cluster-provided, shared) wins.  A local
    temporary folder is used only on a local master (tests, benchmarks); on a
    cluster without the setting this raises, since executors do not see each
    other's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="trellis-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint location."""
    base = spark.conf.get(_CHECKPOINT_KEY, None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under ``path`` if there is none: whole or not at all, and of
    several writers one succeeds.  True for that one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        return False
    staged = jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(staged), context.makeQualified(target), options)
    except Exception as e:
        fs.delete(staged, False)
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_once(spark: SparkSession, staged: str, target: str) -> None:
    """Rename a written folder to its final name; where that is there already (an
    attempt that was repeated) it stays and the new copy goes."""
    jvm = spark._jvm
    source, to = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(target)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(to):
        fs.delete(source, True)
        return
    fs.mkdirs(to.getParent())
    if not fs.rename(source, to):
        raise RuntimeError(f"could not rename {staged} to {target}")
