"""Helpers that the operators of this subpackage share: written tables in the shared folder, words,
labels' folds and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of the operators whose contract names them: runs of anything but ASCII white space.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
#: Words for shingles that should not depend on punctuation.
LETTER_WORD = r"[\p{L}\p{N}]+"
#: Spark's switch to delete a query's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach: spark.checkpoint.dir. Where that is unset, a folder of our own for a
    session in one process, as in tests; on a cluster executors could not read it, so there it is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="tidemark-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, which cuts its lineage; a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    # once the table is there, nothing reads the shuffles that made it
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table made by `written` that no later step reads."""
    path = getattr(df, "_tidemark_path", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else. Pure ASCII takes the faster built-in."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def words(text: Column, pattern: str = PLAIN_WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(of)).cast("int")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected `edges`: a row (node, root) for each node, the root being the smallest.

    Alternating large-star and small-star steps. Every step is two shuffles by node with minima taken before the
    shuffle; only a count and a checksum of the edges come to the driver. Self-loops and null ends are dropped.
    """
    u, v = F.col("u"), F.col("v")
    kind = edges.schema[a].dataType
    now = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (u != v)).distinct(),
        "edges",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v")).where(u != v).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        after = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new = _mark(after)
        forget(now)
        now = after
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    out = now.select(u.alias("node"), v.alias("root")).unionByName(roots)
    out = out.select(F.col("node").cast(kind), F.col("root").cast(kind))
    out._tidemark_path = now._tidemark_path  # so that `forget` finds the table behind it
    return out


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
