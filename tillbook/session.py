"""Session settings, report clocks and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Fixed report clocks: every report takes an explicit as-of instead of now().
# The events table spans 2024-01-01..30 and the last order is dated 2001-08-01 at every scale.
EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-02 00:00:00"

# Runtime SQL settings every job relies on. AQE re-plans joins from measured shuffle sizes
# (sort-merge -> broadcast only when the materialised side is small), splits skewed
# partitions, and coalesces tiny ones, so the plans below never hard-code a strategy for a
# side whose size grows with the data.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}

_local_checkpoint_dir: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (idempotent; safe on a session somebody else built) and make
    the package importable on the executors."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


_shipped_to: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Ship ``tillbook`` to the executors' Python workers, once per application.

    The keyed-state stream functions run in Python workers, which import them by module
    name. So the package is zipped on the driver and added with ``addPyFile``, as
    ``spark-submit --py-files`` would do. Executors then import it whatever their working
    directory, on any cluster.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # pragma: no cover - Spark Connect ships code with addArtifacts instead
        return
    if app in _shipped_to:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tillbook-pyfiles-")   # read once on the driver by addPyFile
    archive = os.path.join(folder, "tillbook.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    _shipped_to.add(app)


def _given_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system the cluster names), or the
    folder already given to ``setCheckpointDir``. Only a local master without either, as in tests,
    gets a scratch folder; any other raises an error, as its executors could not share one.
    """
    global _local_checkpoint_dir
    base = spark.conf.get("spark.checkpoint.dir", None) or _given_checkpoint_dir(spark)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_checkpoint_dir is None:
            _local_checkpoint_dir = tempfile.mkdtemp(prefix="tillbook-ckpt-", dir="/tmp")
        base = _local_checkpoint_dir
    try:
        sc = spark.sparkContext
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(base)
    except Exception:  # pragma: no cover - Spark Connect has no SparkContext
        pass
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tillbook") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TILLBOOK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in _RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
