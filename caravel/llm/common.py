"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java's class for the word separators of every contract here: space and \x09-\x0D.
SPACE = r"[ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a temporary one only where that is unset (local tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="caravel-")
        atexit.register(shutil.rmtree, folder, True)
        spark.conf.set("spark.checkpoint.dir", folder)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, kind: str) -> str:
    """A new, empty path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/caravel-{kind}-{uuid.uuid4().hex}"


@contextmanager
def having(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Bytes of an Arrow batch: texts and shingle sets are long, and executor and worker hold a batch each, twice while it grows.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: computed once, kept in the shared folder, so that a lost executor costs no recomputation of the lineage."""
    shared_dir(df.sparkSession)
    with having(df.sparkSession, BATCHES):
        return df.checkpoint(eager=True)


#: Lets a write release its shuffle files as soon as it is over.
RELEASE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(df: DataFrame, kind: str) -> tuple[DataFrame, str]:
    """``df`` as a table below the shared folder, and its path; the shuffle files that it took are released at once.

    The table goes when the application ends, or by drop().
    """
    spark = df.sparkSession
    path = scratch(spark, kind)
    with having(spark, RELEASE | BATCHES):
        df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: A key is looked for as hot among this share of rows, and is hot with so many of a partition's fair share of rows.
HOT_SAMPLE, HOT_SHARE = 32, 0.5


def with_aggregates(df: DataFrame, keys: list[str], aggregates: list, by: str) -> DataFrame:
    """Rows of a stored table with aggregates over their key's rows, without meeting a hot key's rows in one task.

    Which keys are hot is read off one row in HOT_SAMPLE, chosen by ``by``; that decides only the way, the aggregates
    are exact.  Hot keys are so few by definition, at most 4 a partition, that their aggregates, summed up map-side,
    are broadcast; the others' are joined by a shuffle.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(64, HOT_SHARE * df.count() / partitions / HOT_SAMPLE)
    sampled = df.where(F.pmod(F.xxhash64(by), F.lit(HOT_SAMPLE)) == 0).groupBy(*keys).agg(F.count("*").alias("_n"))
    heavy = [tuple(r[k] for k in keys) for r in sampled.where(F.col("_n") >= least).orderBy(F.desc("_n"), *keys).limit(4 * partitions).collect()]
    plain = lambda rows: rows.join(rows.groupBy(*keys).agg(*aggregates), keys)
    if not heavy:
        return plain(df)
    hot = F.broadcast(df.sparkSession.createDataFrame(heavy, df.select(*keys).schema))
    mine = df.join(hot, keys, "left_semi")
    return plain(df.join(hot, keys, "left_anti")).unionByName(mine.join(F.broadcast(mine.groupBy(*keys).agg(*aggregates)), keys))


def words(text) -> F.Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column, JVM side; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
