"""Session set-up and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every recordlink job relies on. AQE coalesces small shuffles and splits
# skewed join partitions (one key may hold a large share of all rows).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "recordlink", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with recordlink's defaults.

    On a cluster pass ``master=None`` and let the launcher decide; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared (distributed) folder there. In local mode an unset
    folder becomes a temporary one; off local mode that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="recordlink-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/recordlink-{name}-{os.getpid()}-{next(_counter)}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
