"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Rows of one input partition that are numbered together: ids from
# monotonically_increasing_id() agree above this many low bits.
CELL_BITS = 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir`` that driver and executors share.

    Where it is unset a scratch folder is made, on a local master only: a
    folder of the driver's machine is of no use to executors elsewhere.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="scoutlab-llm-"))
    return sc.getCheckpointDir().rstrip("/")


_SCRATCH: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


class Scratch:
    """Tables settled within ``with Scratch() as s:`` are deleted at its end, but
    those given to ``s.keep``.

    For the intermediates of what is itself settled and kept: nothing needs them
    any more, and a lost executor is no reason to read them again.
    """

    def __init__(self) -> None:
        self.paths: dict[str, SparkSession] = {}

    def __enter__(self) -> Scratch:
        self._outer = _SCRATCH.set(self)
        return self

    def keep(self, settled: DataFrame) -> DataFrame:
        self.paths.pop(settled._settled, None)
        return settled

    def __exit__(self, *failure) -> None:
        _SCRATCH.reset(self._outer)
        for path, spark in self.paths.items():
            file = spark._jvm.org.apache.hadoop.fs.Path(path)
            file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at files that survive the loss of an executor, fixes
    what is not repeatable (row ids), and gives the optimizer true sizes.  Within
    a :class:`Scratch` the files are deleted when it ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled = path
    if (scratch := _SCRATCH.get()) is not None:
        scratch.paths[path] = spark
    return out


def numbered(df: DataFrame, keys: list[str], rid: str, out: str) -> DataFrame:
    """Add ``out``: a gapless number from 0 within ``keys``, in order of ``rid``.

    ``rid`` comes from ``monotonically_increasing_id()`` on a settled table.
    No key is gathered in one task: rows are numbered within cells of at most
    2**CELL_BITS rows of one input partition, and a running sum over the cell
    counts gives each cell its first number.
    """
    cell = f"_{out}_cell"
    df = df.withColumn(cell, F.shiftright(rid, CELL_BITS))
    counts = df.groupBy(*keys, cell).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(cell).alias("_cell"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys, cell).orderBy(rid)) - 1)
    match = F.col(cell) == F.col("_cell")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (within.join(firsts, match)
            .withColumn(out, (F.col("_first") + F.col("_at")).cast("long"))
            .drop("_at", "_first", "_cell", cell, *[f"_k{i}" for i in range(len(keys))]))


# Most bytes that a side of a join is broadcast at.
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` (settled) marked for broadcast if its rows are counted to fit
    BROADCAST_BYTES; beyond that it is left as it is, for a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space, as an array.

    Java's ``\\s`` is exactly [\\x20\\x09-\\x0D].
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def packed(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``docs`` as one struct column ``_row`` next to the named columns.

    Operators that return their input's rows work on this form, so that no
    column of the input can clash with one of theirs.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("_row"), *columns)
