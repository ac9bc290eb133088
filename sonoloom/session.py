"""Session set-up and the shared folder used for checkpoints and work tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel


def build_session(app_name: str = "sonoloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` overrides any of them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the cluster.  Only a local session may go without one: it gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="sonoloom-ckpt-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for an intermediate table."""
    return f"{shared_dir(spark)}/work/{name}-{uuid.uuid4().hex}"


def load_moment(spark: SparkSession) -> Column:
    """The current local time as a constant, the same however often a plan is run."""
    now = spark.range(1).select(F.localtimestamp().cast("string")).first()[0]
    return F.lit(now).cast("timestamp_ntz")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so a lost executor loses no state."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(df: DataFrame) -> DataFrame:
    """A checkpoint that is known by its real size, for tables a loop carries from round to round.

    A plain checkpoint keeps the size the planner estimated, a product over the joins it came from.  Carried on, that number gets
    several times as many digits each round, and fills the driver's memory after some ten rounds.  A stored table is measured.
    """
    held = df.persist(StorageLevel.DISK_ONLY)
    held.count()
    done = checkpointed(held)
    held.unpersist()
    return done
