"""Sources and sinks.

All readers take explicit schemas where the layout is known, so no
inference pass runs over the data and numeric columns come back typed
(predicates on typed Parquet columns reach the scan as ``PushedFilters``).
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full scan of one Parquet table (column pruning is Catalyst's)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             sep: str = ",", header: bool = True,
             min_partitions: int | None = None) -> DataFrame:
    """Header CSV, plain or gzip (Spark picks the codec by suffix).

    A ``.gz`` file is not splittable, so one task reads it; pass
    ``min_partitions`` to spread the rows before any wide operator.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


RESCUED = "_rescued"


def read_csv_permissive(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """S1/S2 for dirty files: a value that does not fit its column's type is null, and
    the whole line is kept in ``_rescued`` (null for clean lines); lines with too few
    or too many fields likewise.  Nothing raises and no row is lost."""
    wide = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    return (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RESCUED).schema(wide).csv(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Iterable[str] | None = None) -> None:
    """Replace a table as a whole (``if_exists='replace'``)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV folder; parents are created by the writer.  No
    ``coalesce(1)`` — one file per partition keeps the write parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)


def load_raw(spark: SparkSession, sources: dict[str, str], out_dir: str,
             schemas: dict[str, T.StructType] | None = None) -> dict[str, str]:
    """Load several raw CSV files to named Parquet tables in one step."""
    written = {}
    for name, path in sources.items():
        df = read_csv(spark, path, (schemas or {}).get(name))
        target = f"{out_dir.rstrip('/')}/{name}"
        write_table(df, target)
        written[name] = target
    return written


POSITION = T.StructType([T.StructField("id", T.LongType()), T.StructField("fen", T.StringType())])


def read_positions_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """S7 source: JSON ``{id, fen}`` records, one array a file (``multi_line``) or one
    record a line, which large files need to be split.  A record that does not parse
    has a null id and its text in ``_rescued``."""
    wide = T.StructType([*POSITION.fields, T.StructField(RESCUED, T.StringType())])
    return (spark.read.schema(wide).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RESCUED).json(path))


def fen_lookup(positions: DataFrame, position_id: int) -> DataFrame:
    """The FEN of one id.  A missing id is an error, as in the reference;
    the check looks at a single bounded row (``limit(1)``)."""
    hit = positions.filter(F.col("id") == F.lit(position_id)).select("id", "fen")
    if hit.limit(1).isEmpty():
        raise KeyError(f"position {position_id} not found")
    return hit


def fen_lookups(positions: DataFrame, wanted: DataFrame) -> DataFrame:
    """S7 for many ids at once: ``(id, fen, error)`` for every row of ``wanted`` (id); an id
    that no position has keeps its row, with the error that :func:`fen_lookup` raises."""
    known = positions.filter(F.col("id").isNotNull()).select(F.col("id").alias("_id"), "fen")
    joined = wanted.select("id").join(known, F.col("id") == F.col("_id"), "left")
    missing = F.concat(F.lit("position "), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(" not found"))
    return joined.select("id", "fen", F.when(F.col("_id").isNull(), missing).alias("error"))


def table_structure(df: DataFrame) -> DataFrame:
    """``(position, name, type, n_null, n_distinct)``: the schema with the nulls and the
    distinct values of every column, counted in one aggregate over the rows (distinct
    values to the relative error of ``approx_count_distinct``)."""
    fields = df.schema.fields
    one = df.agg(*[a for i, f in enumerate(fields) for a in (
        F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"z{i}"), F.approx_count_distinct(F.col(f"`{f.name}`")).alias(f"d{i}"))])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.col(f"z{i}").alias("n_null"), F.col(f"d{i}").alias("n_distinct")) for i, f in enumerate(fields)]
    return one.select(F.inline(F.array(*rows)))


def table_preview(df: DataFrame, n: int = 3, key: str | None = None) -> DataFrame:
    """The first rows of a table by ``key`` (the reference's ``LIMIT 3``, which has no
    order of its own); without a key any n rows."""
    return (df.orderBy(key) if key else df).limit(n)


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fields of the first line of every file that starts in this partition."""
    seen = set()
    for batch in batches:
        for path, start, line in zip(*(c.to_pylist() for c in batch.columns)):
            if start == 0 and path not in seen:
                seen.add(path)
                names = next(csv.reader([line]), [])
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([names], pa.list_(pa.string()))], ["path", "names"])


def schema_catalog(spark: SparkSession, folder: str, pattern: str = "*.csv.gz") -> DataFrame:
    """S3: the header of every matching file below a folder:
    ``(folder, file, n_columns, position, column_name, error)``, sorted by file name.

    Files are listed and their first lines read on the executors, one task per file;
    a file that cannot be read has one row that says so in ``error`` and the scan goes
    on.  Spark's readers do not list files without a byte."""
    def reader(fmt: str):
        return (spark.read.format(fmt).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
                .option("ignoreCorruptFiles", True))
    files = reader("binaryFile").load(folder).select("path", "length")  # the content is not read
    lines = reader("text").load(folder).select("_metadata.file_path", "_metadata.file_block_start", "value")
    found = lines.mapInArrow(_headers, "path string, names array<string>")
    joined = files.join(found.withColumnRenamed("path", "_path"), F.col("path") == F.col("_path"), "left")
    parts = F.split("path", "/")
    error = F.when(F.col("names").isNull(), F.lit("no header could be read"))
    cells = joined.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("file"),
                          F.coalesce(F.size("names"), F.lit(0)).alias("n_columns"), error.alias("error"),
                          F.posexplode_outer("names").alias("position", "column_name"))
    return cells.select("folder", "file", F.greatest("n_columns", F.lit(0)).alias("n_columns"), "position", "column_name", "error").orderBy("file", "position")
