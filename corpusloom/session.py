"""Session defaults and the shared scratch folder.

The engine never invents a machine-local temp folder on a cluster: every
intermediate table is written below ``spark.checkpoint.dir``, which the
cluster names. Only when the setting is absent (local runs and tests) do we
create one under the system temp directory and record it on the session.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators rely on. They are session-scoped and may
# be set at any time, so ``prepare_session`` applies them to a session that
# someone else built (the driver's, a notebook's).
_RUNTIME_CONF = {
    # JSON objects with repeated keys keep the last value, as Python's json does.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a batch for a Python worker is bounded by bytes, not by rows alone
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.session.timeZone": "UTC",
    # lets the binidx reader prune sequence ranges (seq_id comparisons)
    "spark.sql.python.filterPushdown.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "corpusloom", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**_RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    for k, v in _RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    _checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusloom`` importable in the Python workers (what
    ``--py-files`` does): the package is zipped once per SparkContext into the
    shared checkpoint folder and added with ``addPyFile``."""
    import io
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    root = _checkpoint_root(spark).rstrip("/")
    target = f"{root}/corpusloom-pkg-{uuid.uuid4().hex[:12]}.zip"
    loc = local_path(target)
    if "://" not in loc:
        with open(loc, "wb") as f:
            f.write(buf.getvalue())
    else:  # shared file system named by a URI (hdfs://, s3a://, ...)
        jvm = sc._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(target)
        out = hpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(hpath, True)
        out.write(bytearray(buf.getvalue()))
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(key)


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # local mode: nobody configured a folder
        root = tempfile.mkdtemp(prefix="corpusloom-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = _checkpoint_root(spark)
    path = local_path(root.rstrip("/") + f"/corpusloom/{name}-{uuid.uuid4().hex[:12]}")
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


def stored_table(df):
    """``df`` written as Parquet below the shared checkpoint folder and read back:
    a checkpoint with columns and compression."""
    schema, path = df.schema, scratch_dir(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now: it does so when
    the driver's garbage collector finds their plans unreachable, which on a
    quiet driver may be much later than the next step fills the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def checkpoint(df):
    """Reliable, eager checkpoint into the shared checkpoint folder (never a
    machine-local one on a cluster): cuts the lineage, survives executor
    loss, and is never silently reused by a later look-alike plan."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
