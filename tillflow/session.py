"""Session helpers: a tuned SparkSession and the shared working folder."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target


def get_spark(master: str | None = None, app: str = "tillflow",
              shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Create (or reuse) a session with AQE and sane defaults.

    On a cluster the master and most settings come from spark-submit; only
    unset values are filled in here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # broadcast only small, size-checked sides (registry, lookups)
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if shuffle_partitions is not None:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    defaults.update({k.replace("_", "."): str(v) for k, v in conf.items()})
    for k, v in defaults.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def one_process(master: str) -> bool:
    """Whether driver and tasks are one process; the executors of ``local-cluster`` are others."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def compiled_methods(spark: SparkSession) -> None:
    """HotSpot never compiles a method of more than 8,000 bytes.  A stage whose generated method is larger, as with many
    rules on many columns, runs as single operators, whose methods are split; a session's own setting stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) == 65535:       # Spark's default
        spark.conf.set(key, "8000")


def few_listing_tasks(spark: SparkSession) -> None:
    """Folders of many small directories are listed by a few tasks a core, not by one task a directory;
    a session's own setting stays."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(4 * spark.sparkContext.defaultParallelism))


def together(spark: SparkSession, steps: list, most: int = 8) -> list:
    """Results of ``steps`` (functions that run Spark jobs of their own), in order.  They run at the same time: a small job's
    planning, listing and last tasks leave most cores idle.  The first error ends the call when the steps under way are done."""
    shared_dir(spark)       # names the folder once
    own = [inheritable_thread_target(spark)(step) for step in steps]
    with ThreadPoolExecutor(max(1, min(most, len(own)))) as pool:
        started = [pool.submit(step) for step in own]
        try:
            return [s.result() for s in started]
        finally:
            for s in started:
                s.cancel()


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files of jobs that have ended stay on the executors' disks until the driver happens to collect its garbage;
    called where a step has ended whose shuffles nothing needs any more."""
    sc = spark.sparkContext
    for _ in range(2):          # Python tells the JVM about once a second which objects it has let go
        gc.collect()
        time.sleep(1.2)
        sc._jvm.System.gc()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The cluster names its shared folder in ``spark.checkpoint.dir``; it is
    only set here when unset (local runs and tests), never overridden.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not one_process(sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="tillflow-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    name = "/".join(p.strip("/") for p in parts if p)
    path = base.rstrip("/") + "/tillflow/" + (name + "/" if name else "") + uuid.uuid4().hex
    return path
