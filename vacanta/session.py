"""Session helpers: a local session for tests/bench and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vacanta") -> SparkSession:
    """Session for tests and the local bench. On a cluster, use the cluster's session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("vacanta.scan.tasks", "0" if cores == "*" else str(cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("VACANTA_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once per application, unless PYTHONPATH does:
    a job may have it on the driver's path only."""
    sc, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.applicationId in _SHIPPED or root in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))):
        return
    _SHIPPED.add(sc.applicationId)
    archive = os.path.join(tempfile.mkdtemp(prefix="vacanta-code-"), "vacanta.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "vacanta")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is used as is.
    Only when it is unset on a local master (tests, the bench) a private folder is created;
    on a cluster an unset folder is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="vacanta-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    import uuid

    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
