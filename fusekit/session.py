"""Session helpers: a tuned local session for tests/bench, and the shared
scratch folder that every lineage cut and stream checkpoint goes to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "fusekit") -> SparkSession:
    """Session used by tests and the bench.  On a cluster the caller's own
    session is used instead; nothing here is required by the library."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.files.maxPartitionBytes", os.environ.get("FUSEKIT_SPLIT_BYTES", "128m"))
        .config("spark.driver.memory", os.environ.get("FUSEKIT_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and the master is local
    (tests) a fresh temporary folder is created and registered.  On a cluster
    an unset folder is an error."""
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            conf_dir = jdir.get()
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="fusekit-ckpt-")
        try:  # record it for later readers; some sessions refuse core keys at runtime
            spark.conf.set(CHECKPOINT_CONF, conf_dir)
        except Exception:  # noqa: BLE001 - the context's checkpoint dir below is what counts
            pass
    # keep the RDD-level checkpoint dir in sync so DataFrame.checkpoint() works
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable lineage cut (survives executor loss): ``checkpoint()`` into
    the shared checkpoint folder.  Never a local checkpoint."""
    spark = spark or df.sparkSession
    checkpoint_root(spark)
    return df.checkpoint(eager=True)


class persisted:
    """OP-R2: ``with persisted(df) as d:`` keeps ``df`` in memory and disk
    for the jobs inside the block and always releases it.  For inputs read
    by several jobs; a lost block is recomputed from lineage."""

    def __init__(self, df, level=None):
        from pyspark import StorageLevel
        self.df = df
        self.level = level or StorageLevel.MEMORY_AND_DISK

    def __enter__(self):
        return self.df.persist(self.level)

    def __exit__(self, *exc):
        self.df.unpersist()
        return False


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``fusekit`` importable by the executors' Python workers: zip the
    package once per application and ``addPyFile`` it (what ``--py-files``
    does at submit time).  Needed whenever the driver imports the package
    from a path the workers do not have."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="fusekit-pkg-"), "fusekit.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(zpath)
    _SHIPPED.add(app)
