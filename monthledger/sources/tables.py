"""Source readers and result writers.

Readers select and cast exactly the declared columns, so Catalyst prunes every
other column at the Parquet scan and pushes the job's filters into it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthledger.functions.dates import date_lit
from monthledger.sources.schemas import SOURCE_SCHEMAS
from monthledger.sources.stage import file_system


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, same order, cast types.

    A missing column is an error (the feeds must carry every used column);
    extra columns are dropped.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"source is missing columns {missing}")
    return df.select(
        *[
            (F.col(f.name) if df.schema[f.name].dataType == f.dataType else F.col(f.name).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


@dataclass(frozen=True)
class SourceLocation:
    """Where the job reads a logical source: a table name or a file path."""

    table: str | None = None
    path: str | None = None
    format: str = "parquet"


def read_source(spark: SparkSession, name: str, where: SourceLocation | str) -> DataFrame:
    """Read logical source ``name`` and conform it to its declared schema."""
    schema = SOURCE_SCHEMAS[name]
    if isinstance(where, str):
        where = SourceLocation(table=where) if "/" not in where else SourceLocation(path=where)
    if where.table is not None:
        df = spark.table(where.table)
    else:
        df = spark.read.format(where.format).load(where.path)
    return conform(df, schema)


#: A month's file has a row or so of each contract, so that ids do not repeat in
#: it and little is left to Parquet's encodings: the codec has to do more.
PARTITIONED_CODEC = "zstd"


def _writer(df: DataFrame, mode: str, partition: str | None):
    writer = df.write.mode(mode)
    return writer.partitionBy(partition).option("compression", PARTITIONED_CODEC) if partition else writer


def _swap_path(df: DataFrame, path: str, partition: str | None) -> None:
    """Write beside ``path``, then take its place: until the new files are
    whole the old ones stand, and a failed rename puts them back."""
    spark, path = df.sparkSession, path.rstrip("/")
    new, old = (f"{path}.{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    fs, at = file_system(spark, path)
    new_at, old_at = file_system(spark, new)[1], file_system(spark, old)[1]
    fs.mkdirs(new_at)
    fs.deleteOnExit(new_at)  # tasks of a failed write may put files there after the delete below
    try:
        _writer(df, "overwrite", partition).parquet(new)
        had = fs.exists(at)
        if had and not fs.rename(at, old_at):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(new_at, at):
            if had:
                fs.rename(old_at, at)
            raise OSError(f"could not move the new result to {path}")
        fs.delete(old_at, True)
    finally:
        fs.delete(new_at, True)


def _swap_table(df: DataFrame, target: str, partition: str | None) -> None:
    """The same with tables: a new table, two renames, one drop."""
    spark = df.sparkSession
    schema, _, name = target.rpartition(".")
    if schema:
        spark.sql(f"create schema if not exists {schema}")
    mark = uuid.uuid4().hex
    new, old = (f"{schema}.{name}_{kind}_{mark}".lstrip(".") for kind in ("new", "old"))
    try:
        _writer(df, "error", partition).saveAsTable(new)
        had = spark.catalog.tableExists(target)
        if had:
            spark.sql(f"alter table {target} rename to {old}")
        try:
            spark.sql(f"alter table {new} rename to {target}")
        except Exception:
            if had:
                spark.sql(f"alter table {old} rename to {target}")
            raise
        spark.sql(f"drop table if exists {old}")
    finally:
        spark.sql(f"drop table if exists {new}")


def _brought_together(df: DataFrame, partition: str) -> DataFrame:
    """Rows of a value of ``partition`` (of a date: those of its year) moved to
    one task, or to several if they are many.

    Months of a year go together because a contract's rows then stay neighbours
    and nearly all that they share is compressed away in the shuffle; a task
    writes up to twelve folders instead of one.
    """
    if not isinstance(df.schema[partition].dataType, T.DateType):
        return df.hint("rebalance", partition)
    return df.withColumn("_year_of_rows", F.year(partition)).hint("rebalance", "_year_of_rows").drop("_year_of_rows")


def write_result(df: DataFrame, target: str, mode: str = "overwrite", path: str | None = None, partition: str | None = None) -> None:
    """Materialise a result as a table (``schema.name``) or as Parquet files.

    Both published outputs of the job are this call with another ``target``;
    the target's schema is created if it is not there.  ``overwrite`` writes
    the new result whole before it takes the old one's place; other modes are
    Spark's own.  ``partition``: one folder a value of this column, rows of a
    value, or of a date's year, brought together (many split) before they are
    written.
    """
    if partition:
        df = _brought_together(df, partition)
    if mode == "overwrite":
        return _swap_path(df, path, partition) if path is not None else _swap_table(df, target, partition)
    writer = _writer(df, mode, partition)
    if path is not None:
        writer.parquet(path)
    else:
        writer.saveAsTable(target)


def refresh_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions that ``df`` has rows of; Spark stages them
    and moves them at the job's end, so a failed job changes nothing."""
    _writer(_brought_together(df, partition), "overwrite", partition).option("partitionOverwriteMode", "dynamic").parquet(path)


def read_published(spark: SparkSession, path: str, schema: T.StructType, partition: str, start=None, end=None) -> DataFrame:
    """A partitioned result; a window on ``partition`` reads its folders alone."""
    df = spark.read.schema(schema).parquet(path)
    if start is not None:
        df = df.where(F.col(partition) >= date_lit(start))
    if end is not None:
        df = df.where(F.col(partition) <= date_lit(end))
    return df.select(*schema.fieldNames())


def register_view(df: DataFrame, name: str) -> None:
    """Expose a result as a session view (the default, unmaterialised output)."""
    df.createOrReplaceTempView(name)
