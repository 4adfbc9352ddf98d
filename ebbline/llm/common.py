"""What several operators share: reading tables, written intermediates, connected components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.session import work_dir

#: Bytes that separate words, as in ``[\x20\x09-\x0D]``; bytes.split() splits on exactly these.
SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared checkpoint folder and read it back.

    This cuts lineage: losing an executor later means reading a file again.
    """
    path = f"{work_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like :func:`save`, in buckets of ``key``: a join on it does not shuffle this side."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    writer = df.write.option("path", f"{work_dir(spark).rstrip('/')}/{name}").option("compression", "zstd")
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def release(df: DataFrame) -> None:
    """Delete the files of a table that :func:`save` wrote and nothing reads any more."""
    spark = df.sparkSession
    folder = work_dir(spark).rstrip("/")
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.removeprefix("file:").lstrip("/") in name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that nothing refers to any more; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tagged(docs: DataFrame, name: str) -> DataFrame:
    """A written copy of ``docs`` as columns ``doc`` (all of its columns) and ``row`` (a number of the row's own).

    The number is written down, so every later read agrees about it, and rows with the same or a
    null doc_id stay apart.  Columns packed into ``doc`` cannot clash with an operator's own.
    """
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return save(docs.select(packed, F.monotonically_increasing_id().alias("row")), name)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """A written copy of ``docs`` with ``row``, a number of the row's own."""
    return save(docs.withColumn("row", F.monotonically_increasing_id()), name)


def held_out(parts: int, held: int) -> Column:
    """Whether a row is held out: crc32 of doc_id as text, modulo ``parts``; a null doc_id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == held, F.lit(True))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (columns ``a``, ``b``): rows ``node``, ``root``.

    Alternates large-star and small-star steps until the edges no longer change, about
    log(diameter) rounds.  ``root`` is the least node of the component.  The minima are written
    before they are joined, so that a node with very many edges can be split by the join.
    """
    ends = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = save(edges.where("a <> b").select(*ends).distinct(), "edges")
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = save(
            both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(),
            "large",
        )
        low = save(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = (
            large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
        )
        after = save(small.distinct(), "edges")
        now = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        for old in (edges, least, large, low):
            release(old)
        edges = after
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
