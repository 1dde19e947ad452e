"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "marquee", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark.

    On a cluster the session comes from ``spark-submit``; nothing in the library
    depends on this function.
    """
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("MARQUEE_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only in a single-process ``local[...]`` session that leaves it
    unset (tests) a folder of our own is created and registered, so ``DataFrame.checkpoint()``
    and written tables land in the same place; on any other master a machine-local folder
    would scatter the files over the nodes, so an unset folder is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if conf:
            return conf
        raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
    local = tempfile.mkdtemp(prefix="marquee-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one written table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
