"""What a job needs of its session: the shared folder, written tables, the package on the workers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        made = tempfile.mkdtemp(prefix="vecloom-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_folders[context.applicationId] = made
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet.

    All tables of an application lie in one folder, ``vecloom/<application id>``, to be removed after it.
    """
    place = f"{shared_folder(spark).rstrip('/')}/vecloom/{spark.sparkContext.applicationId}"
    return f"{place}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used where a result must be computed once (partition numbers, training rounds, tokenised text):
    the lineage ends at the files, so a lost executor costs a re-read and never a different answer.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, options: dict[str, str] | None = None) -> DataFrame:
    """:func:`write_table` with rows dealt into ``buckets`` files by ``key``, so that a join or grouping by it need not move them.

    The table is for a moment an entry of the session's current database, which has to be writable.
    """
    return _bucketed(df, new_path(df.sparkSession, name), key, buckets, options or {})


def _bucketed(df: DataFrame, path: str, key: str, buckets: int, options: dict[str, str]) -> DataFrame:
    spark, entry = df.sparkSession, f"vecloom_{uuid.uuid4().hex}"
    df.write.format("parquet").mode("overwrite").bucketBy(buckets, key).options(path=path, **options).saveAsTable(entry)
    table = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")  # the entry goes; the files stay, and the frame knows them
    return table


class Rotation:
    """A table that is replaced again and again, in a few folders that are overwritten in turn.

    A written table stays until it is neither the latest nor kept. With ``key``, tables are bucketed by it.
    """

    def __init__(self, spark: SparkSession, name: str, key: str | None = None, buckets: int = 0) -> None:
        self.spark, self.places, self.key, self.buckets = spark, [new_path(spark, name) for _ in range(3)], key, buckets
        self.latest = self.kept = -1

    def write(self, df: DataFrame) -> DataFrame:
        free = next(i for i in range(3) if i not in (self.latest, self.kept))
        self.latest = free
        if self.key:
            return _bucketed(df, self.places[free], self.key, self.buckets, {})
        df.write.mode("overwrite").parquet(self.places[free])
        return self.spark.read.schema(df.schema).parquet(self.places[free])

    def keep(self, place: int | None = None) -> None:
        """Keep the latest table, or that written when ``latest`` was ``place``, and give up the one kept before."""
        self.kept = self.latest if place is None else place


def ship_package(spark: SparkSession) -> None:
    """Put this package on the Python workers' path, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="vecloom-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "vecloom.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for place, _, files in os.walk(root):
            for file in sorted(files):
                if file.endswith(".py"):
                    full = os.path.join(place, file)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
