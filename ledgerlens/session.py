"""Session helpers: a local session for tests and benchmarks, and the
shared checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlens") -> SparkSession:
    """Local session with the settings the library is designed for.

    On a cluster the same settings belong in the job's configuration;
    the checkpoint folder there is the cluster's shared one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # batch jobs: no Python call-site capture on every column call (it only
        # enriches error messages and costs several JVM round trips per call)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # bounded driver bookkeeping for long runs of many queries (no UI is served)
        .config("spark.sql.ui.retainedExecutions", "50")
        .config("spark.ui.retainedJobs", "200")
        .config("spark.ui.retainedStages", "200")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)  # a local session without a shared folder gets a scratch one
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir`` (or the context's folder). A local-mode
    session without one gets a scratch folder, as in tests; a cluster
    session without one is an error, because a machine-local folder would
    not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get(CHECKPOINT_CONF, None)
    if not conf and sc is not None:
        conf = sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder of the cluster")
        conf = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
        try:
            spark.conf.set(CHECKPOINT_CONF, conf)
        except Exception:  # static in some deployments; the folder is still returned
            pass
    if sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    return conf


_SHIPPED: set[str] = set()  # applications whose Python workers have the package


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, so that functions run
    there can import it wherever a worker starts (once per application)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the package is sent with addArtifacts
        return
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerlens-src-"), "ledgerlens.zip")
    with zipfile.ZipFile(archive, "w") as out:  # Spark copies it to the executors
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


_MATERIALIZED: list[str] = []  # folders written by this process
_TABLES: list[str] = []  # catalog tables made for one session's use


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under the shared checkpoint folder; ``clear_materialized``
    removes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/ledgerlens/{label}-{uuid.uuid4().hex}"
    _MATERIALIZED.append(path)
    return path


def scratch_table(label: str) -> str:
    """A new table name; ``clear_materialized`` drops the table."""
    name = f"{label}_{uuid.uuid4().hex}"
    _TABLES.append(name)
    return name


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    The explicit store step where one result feeds several consumers. The
    written files cut the lineage, survive executor loss and keep column pruning
    on the read side. ``clear_materialized`` removes them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_materialized(spark: SparkSession) -> int:
    """Delete what this process has stored for the session (materialized
    folders, scratch tables and their files, shared model runs), once no result
    that reads it is used any more; returns the number of folders deleted."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    hadoop = spark._jsc.hadoopConfiguration()
    n = 0
    while _MATERIALIZED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MATERIALIZED.pop())
        n += bool(path.getFileSystem(hadoop).delete(path, True))
    return n
