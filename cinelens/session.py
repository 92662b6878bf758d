"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: naive timestamps are read and written in UTC,
# AQE re-plans joins and partition counts at run time and splits skewed keys.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "cinelens",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are only set when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cinelens`` importable in Python workers (pandas UDF kernels).

    The package is zipped once per application and added with
    ``addPyFile``, which copies it to every executor, as ``--py-files``
    would on submit.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="cinelens-pkg-")
    archive = shutil.make_archive(
        os.path.join(out, "cinelens"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="cinelens"
    )
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from the running context or ``spark.checkpoint.dir``.
    Only a local-mode session (tests, bench) may get a fresh folder of its
    own; on a cluster a machine-local folder would not survive the loss of
    an executor, so an unset value is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for this cluster"
        )
    path = tempfile.mkdtemp(prefix="cinelens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Spark's setting by which a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark):
    """Tables written inside leave no shuffle files: nothing reads these again,
    and else they stay until the driver collects its garbage, beside those of the
    next step."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df):
    """``df`` written once as a Parquet table in the shared checkpoint folder,
    and read from there: its lineage is cut, and its size is known to the
    planner. (A checkpointed frame keeps the estimate of the plan that made it;
    in a loop of joins these multiply until planning takes minutes.) The shuffle
    files behind it go once it is written."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def release(*tables) -> None:
    """Delete tables made by :func:`stored` that nothing reads any more, and let
    the driver collect its garbage: executors keep the shuffle files of other
    queries until the driver's collector notices that nothing refers to them,
    which in a job of many stages may be long after."""
    for df in tables:
        path = df.__dict__.pop("stored_path", None)
        if path:
            spark = df.sparkSession
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()
