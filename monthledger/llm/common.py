"""Helpers shared by the operators: shared-folder tables and connected components."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One space or \t \n \v \f \r: the white space that parts words.
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Tasks carry this module's code with them, so executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without it gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def arrow_batches(rows, schema, most_rows: int = 4096, most_chars: int = 4_000_000):
    """Rows (tuples) as record batches bounded by rows and by code points."""
    import pyarrow as pa

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most_rows or size >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path of ``path``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def passing(spark: SparkSession, path: str) -> None:
    """``path`` is deleted when the driver's file system closes: results that
    are still lazy read it until then."""
    fs, folder = file_system(spark, path)
    fs.deleteOnExit(folder)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors, and gives later joins a real size."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    passing(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that no name among them meets a helper
    column; ``unpacked`` gives them back."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def unpacked(df: DataFrame, like: DataFrame, row: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{row}.{quoted(c)}").alias(c) for c in like.columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long edges -> (node, root), root the smallest node reachable.

    Alternating large-star and small-star rounds, each a map-side combined
    ``min`` and one join; every round is written to the shared folder. A star
    around one hub never gathers its spokes in a task.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, "edges")

    def large_star(e):
        both = e.union(e.select("b", "a").toDF("a", "b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small_star(e):
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        j = e.join(low, "a")
        return j.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))

    def digest(e):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    last = None
    while (now := digest(e)) != last:
        last = now
        e = large_star(e).where("a <> b").distinct()
        e = materialize(small_star(e).where("a <> b").distinct(), "edges")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


ship(__name__)
