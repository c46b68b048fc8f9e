"""Session settings and lineage cuts shared by every plan."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings. Joins of many rows to one row per visit lean on the
# adaptive skew split, so it is forced even where it costs one more exchange. A side
# that Spark broadcasts by its size goes through the driver, and a plan has some twenty
# such sides with a row per visit: only those under a megabyte are worth it.
BROADCAST_BYTES = "1m"
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": BROADCAST_BYTES,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_BYTES,
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing is left to the session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each context, so that it need not be installed there."""
    sc = spark.sparkContext
    if getattr(sc, "_icuriver_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="icuriver-package-"), "icuriver.zip")
    with open(path, "wb") as f:
        f.write(packed.getvalue())
    sc.addPyFile(path)
    sc._icuriver_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = sc.getConf().get("spark.checkpoint.dir")
    if shared is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="icuriver-checkpoint-")
    sc.setCheckpointDir(shared)


def shared_folder(spark: SparkSession) -> str:
    """A folder of this run below the checkpoint folder, for tables that stages hand on."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder once nothing reads it any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, which survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Model tables (states x actions) of this size are shipped to the executors.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side whose row count is checked; a larger one is joined by shuffle.

    The check reads the frame, so pass one that is materialised or cheap to make.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
