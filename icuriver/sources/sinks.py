"""Writing: gap report, state labels, metrics, trials."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_COMMITS = "_commits"


def write_csv(df: DataFrame, path: str) -> None:
    """Gap sizes, state labels and trial tables. One file per partition."""
    df.write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _names(fs, folder) -> list[str]:
    return sorted(f.getPath().getName() for f in fs.listStatus(folder)) if fs.exists(folder) else []


def _newest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number of the last commit below ``path`` and the run that it names; (0, None) without any."""
    fs, make = _files(spark, path)
    # a commit is named <number>-<run>, so that its name alone says all and no file need be whole
    done = [n.split("-", 1) for n in _names(fs, make(f"{path}/{_COMMITS}")) if n[0].isdigit()]
    if not done:
        return 0, None
    number, run = max((int(n), r) for n, r in done)
    return number, run


def write_committed(df: DataFrame, path: str, kind: str = "parquet", **options: str) -> None:
    """Replace the table at ``path`` as a whole: readers see the old one or the new one, never a part.

    A run writes a folder of its own; an empty file that names it commits it, and only then do earlier
    runs go. A run that ends before its commit leaves the old table in force, and the next commit clears
    its folder away. ``df`` may read the table it replaces. There is one writer at a time.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    fs, make = _files(spark, path)
    df.write.options(**options).format(kind).save(f"{path}/run-{run}")
    number, _ = _newest(spark, path)
    name = f"{number + 1:012d}-{run}"
    fs.create(make(f"{path}/{_COMMITS}/{name}"), False).close()
    for old in _names(fs, make(path)):
        if old.startswith("run-") and old != f"run-{run}":
            fs.delete(make(f"{path}/{old}"), True)
    for old in _names(fs, make(f"{path}/{_COMMITS}")):
        if old < name:
            fs.delete(make(f"{path}/{_COMMITS}/{old}"), False)


def read_committed(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None, **options: str) -> DataFrame:
    """The table that the last commit at ``path`` names."""
    _, run = _newest(spark, path)
    if run is None:
        raise FileNotFoundError(f"no committed table at {path}")
    reader = spark.read.options(**options).format(kind)
    return (reader.schema(schema) if schema else reader).load(f"{path}/run-{run}")
