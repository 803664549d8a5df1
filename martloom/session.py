"""Session settings the jobs are written for."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution splits hot join partitions and sizes shuffles at run time.
# Forcing the split matters where a join is followed by a grouping on the same
# key: by default Spark then keeps the hot partition whole to save a shuffle.
# Broadcasts stay under autoBroadcastJoinThreshold; nothing here raises it.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Results must not hang on these: casts that do not fit raise, dates do not move
# with the machine's zone.
SEMANTICS = {"spark.sql.ansi.enabled": "true", "spark.sql.session.timeZone": "UTC"}
SETTINGS = {**ADAPTIVE, **SEMANTICS}


def tune(spark: SparkSession) -> SparkSession:
    """Switch a running session to the settings the jobs count on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "martloom") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def free_shuffles(spark: SparkSession) -> None:
    """Have the files of finished shuffles removed.

    Spark removes them when the driver's garbage collector finds that nothing uses
    them, by default as its memory fills or after half an hour; until then
    the shuffles of all passes lie on the disks together.
    """
    spark.sparkContext._jvm.System.gc()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder of the session.

    That folder is ``spark.checkpoint.dir``, or else the one given to
    ``setCheckpointDir``. Only a session whose executors run inside the driver
    may do without either and gets a temporary folder; elsewhere every executor
    would write to its own disk, so this raises.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        given = context._jsc.sc().getCheckpointDir()
        base = given.get() if given.isDefined() else None
    if not base and re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        base = tempfile.mkdtemp(prefix="martloom-")
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4()}"
