"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "modelkit", master: str | None = None, **conf: str) -> SparkSession:
    """A session pinned to UTC with ANSI mode and adaptive execution on.

    Cluster sizing (shuffle partitions, memory, checkpoint folder) is left to the caller's ``conf``
    or the cluster defaults; AQE coalesces small shuffle partitions and splits skewed joins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the duration of a block, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and intermediate tables, on the storage all executors share.

    Uses ``spark.checkpoint.dir``. Where that is unset, a local-mode session gets a temporary folder;
    on a cluster the missing setting is an error, because a machine-local folder dies with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="modelkit-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
