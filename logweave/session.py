"""Session helpers.

Operators never create sessions; only entry points (tests, bench, CLI) do.
``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the running session.  Only a
``local[...]`` master may go without it and gets a scratch folder.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Event-time jobs run over wall-clock UTC timestamps; keep NTZ literals exact.
    "spark.sql.ansi.enabled": "true",
}
#: transformWithState needs this state store.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def get_spark(master: str | None = None, app: str = "logweave", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside use the RocksDB state store; the session's own setting comes back afterwards."""
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE[0])
        else:
            spark.conf.set(STATE_STORE[0], before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder and is
    used as is.  When it is unset a local master gets a scratch folder; a cluster raises,
    since executors could not read each other's files in a machine-local folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="logweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written intermediate tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def cut(df):
    """Cut lineage with a reliable checkpoint in the session's checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()
