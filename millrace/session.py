"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # keyed stream state lives on disk, not on the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    """Session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: The folder of local sessions of this process that name none.
_LOCAL: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session on one machine may go without it: it gets a fresh folder under /tmp.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="millrace-", dir="/tmp"))
        root = _LOCAL[0]
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call uses.

    All of them lie in one folder of the application, which is removed when its JVM ends.
    """
    root = f"{shared_root(spark).rstrip('/')}/millrace-{spark.sparkContext.applicationId}"
    target = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        store.mkdirs(target)
        store.deleteOnExit(target)
    return f"{root}/{name}-{uuid.uuid4().hex}"
