"""Places and small helpers that all operators of this subpackage use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a small table that may be broadcast; each is some dozens of bytes.
SMALL = 100_000
#: A key with more than this part of all rows is hot, so there are fewer hot keys than this.
HOT = 10_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where the session names none, a temporary folder is made and set on a single
    machine; on a cluster that is an error, as each machine would have its own.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="pagemart-")
        spark.conf.set("spark.checkpoint.dir", where)
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


#: What this process has put into shared folders and not cleared yet.
_MADE: list[str] = []


def fresh_path(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Removes all that this process has written by fresh_path and stored; returns how many paths.

    To be called when no result that reads them is needed any more.
    """
    for done in _MADE:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(done)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    n = len(_MADE)
    _MADE.clear()
    return n


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to the shared folder and read back, which cuts its lineage.

    The files outlive any executor. They stay until clear() is called, because
    results that read them are lazy.
    """
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """name, with underscores before it until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str) -> str:
    """A column's name as col() takes it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def join_hot(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """The inner join of rows and groups on key, where groups has each key once with its number of rows.

    Keys of more than total / HOT rows, of which there are fewer than HOT whatever
    the input, are broadcast, so that no task is dealt such a key; the rest are
    joined by a shuffle in which no key has more rows than that.
    """
    hot = F.col(size) > total / HOT
    many = F.broadcast(groups.where(hot))
    few = rows.join(F.broadcast(groups.where(hot).select(key)), key, "left_anti")
    return rows.join(many, key).unionByName(few.join(groups.where(~hot), key))


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def sampled(rows: DataFrame, id_col: str, stratum: str, per_stratum: int) -> DataFrame:
    """At most about per_stratum rows of each value of stratum, the same rows each time.

    A row stays if the hash of its id, as a fraction, is under per_stratum / size
    of its stratum; no group is gathered anywhere. For fitting models only.
    """
    share = free_name(rows.columns, "share")
    sizes = stored(rows.groupBy(stratum).agg((F.lit(float(per_stratum)) / F.count(F.lit(1))).alias(share)), "sizes")
    if sizes.count() <= SMALL:
        sizes = F.broadcast(sizes)
    fraction = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.join(sizes, stratum).where(fraction < F.col(share)).drop(share)
