"""Spark session defaults and the few helpers every operator shares."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Session settings used by bench and tests. A cluster's own settings are left alone by the operators.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with DEFAULTS, for tests, benches and interactive use."""
    builder = SparkSession.builder.master(master).appName("archivolt")
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "8g"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each application, so that it needn't be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(), "archivolt.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("archivolt", os.path.relpath(path, root)))
    sc.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory; Catalyst prunes its columns and pushes filters into the scan."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share. The cluster names it in spark.checkpoint.dir; a local one is set only where none is."""
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "archivolt-checkpoints"))
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and cut its lineage; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Largest estimated size, in bytes, of a table that is broadcast without a count.
BROADCAST_BYTES = 8 << 20


def small_enough(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True if the optimizer's own size estimate of df is under the limit."""
    stats = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(stats)) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side of checked size; otherwise Spark shuffles as usual."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if small_enough(df, limit) else df
