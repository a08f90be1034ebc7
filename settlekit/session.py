"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Sized for local tests; on a cluster these come from the job's spark-defaults.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, app: str = "settlekit",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf.setdefault("spark.driver.memory", os.environ.get("SETTLEKIT_DRIVER_MEMORY", "16g"))
    # Catalog entries (bucketed tables) are external; keep the default database
    # folder out of the working directory.
    conf.setdefault("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="settlekit-warehouse-"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")  # local sessions only
    shared_folder(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by spark.checkpoint.dir.

    Read from the session; only a local master may go without the setting and
    gets a private temporary folder, registered as the session's checkpoint dir
    so ``DataFrame.checkpoint()`` works. A cluster without it fails here.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/").rsplit("/", 1)[0] if _is_session_subdir(current) else current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is not None and not sc.master.startswith("local") or sc is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="settlekit-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
    return configured


def _is_session_subdir(path: str) -> bool:
    # setCheckpointDir appends a random UUID folder per SparkContext.
    leaf = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(leaf)
        return True
    except ValueError:
        return False


def shared_folder(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared checkpoint root (job scratch, stream state)."""
    root = checkpoint_root(spark)
    return "/".join([root.rstrip("/"), "settlekit", *parts])


_dropped_at_exit: set[str] = set()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables; all of an application's are dropped when it ends."""
    try:
        base = shared_folder(spark, f"app-{spark.sparkContext.applicationId}")
    except RuntimeError:
        raise
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        return shared_folder(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    if base not in _dropped_at_exit:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _dropped_at_exit.add(base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_named_tables: list[tuple[SparkSession, str]] = []


def forget_at_exit(spark: SparkSession, table_name: str) -> None:
    """Drop an external table's catalog entry when the program ends (its files stay), so that a lasting metastore gathers none."""
    if not _named_tables:
        atexit.register(_forget_tables)
    _named_tables.append((spark, table_name))


def _forget_tables() -> None:
    for spark, name in _named_tables:
        try:
            if not spark.sparkContext._jsc.sc().isStopped():
                spark.sql(f"DROP TABLE IF EXISTS {name}")
        except Exception:  # noqa: BLE001 - the session or its JVM has ended before
            return
    _named_tables.clear()
