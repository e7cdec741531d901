"""Helpers of the subpackage: shared checkpoint folder, joins with hot keys, connected components."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.session import ship as send

HEAVY_PARTS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by spark.checkpoint.dir; only where none is set (tests) a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoints-"))


BATCH_ROWS = "1000"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, and keep Arrow batches of texts small.

    A batch of the default 10,000 rows of text takes tens of megabytes several times over, in Spark and in the Python
    worker, which keeps them for as long as it lives. A session's own setting is left as it is."""
    send(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def arrow_map(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """mapInArrow by a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def cut(df: DataFrame, layout: bool = False) -> DataFrame:
    """Cut the lineage: the rows are written to the shared checkpoint folder and read from there.

    Rows go to a quarter of the shuffle's partitions at most, but one a core at least, since every file costs the
    executors a few calls of the system; ``layout`` keeps the partitioning of ``df`` for the joins that follow."""
    ensure_checkpoint_dir(df.sparkSession)
    if not layout:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, partitions(df) // 4))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table in the shared checkpoint folder, for rows of which later steps read some columns only."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Have the driver collect what is no longer referenced: Spark then deletes its shuffle files on the executors.

    Files are deleted when the driver's heap happens to be collected, which a driver with little to do puts off
    while large shuffles, long read, fill the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fold(id_text: str | Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``."""
    col = F.col(id_text) if isinstance(id_text, str) else id_text
    return F.crc32(col.cast("string").cast("binary")) % parts


def crc_fold(value: int, parts: int) -> int:
    return zlib.crc32(str(value).encode()) % parts


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lookup(rows: DataFrame, key: list[str], values: DataFrame, weight: str, total: int, how: str = "left") -> DataFrame:
    """Join ``rows`` with ``values`` (one row a key) when some keys may hold a large share of ``rows``.

    ``weight`` is the column of ``values`` that counts the rows of each key, ``total`` their sum. Keys with over
    1/HEAVY_PARTS of all rows, of which there can be HEAVY_PARTS at most, are broadcast; the others, each too
    small to fill a task, are joined by a shuffle.
    """
    heavy = values.where(F.col(weight) * HEAVY_PARTS > F.lit(total)).drop(weight)
    light = values.where(F.col(weight) * HEAVY_PARTS <= F.lit(total)).drop(weight)
    names = [c for c in values.columns if c not in key and c != weight]
    flagged = rows.join(F.broadcast(heavy.withColumn("_heavy", F.lit(True))), key, "left")
    hot = flagged.where(F.col("_heavy")).drop("_heavy")
    rest = flagged.where(F.col("_heavy").isNull()).drop("_heavy", *names)
    return hot.unionByName(rest.join(light, key, how))


BUCKETS = 1 << 20


def narrowed(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among the keys of ``wanted``, before a shuffle join.

    The keys' hash buckets are broadcast as bits, 64 in a row, so BUCKETS / 64 rows at most whatever the number of keys."""
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    word, bit = F.shiftright(bucket, 6).alias("_word"), F.expr("shiftleft(1L, cast(_bucket & 63 as int))")
    words = wanted.select(bucket.alias("_bucket"), word).groupBy("_word").agg(F.bit_or(bit).alias("_bits"))
    found = rows.withColumn("_bucket", bucket).withColumn("_word", F.shiftright("_bucket", 6)).join(F.broadcast(words), "_word")
    return found.where(F.col("_bits").bitwiseAND(bit) != 0).select(*rows.columns)


SAMPLED_KEYS = 30_000


@contextmanager
def bounded_samples(spark: SparkSession) -> Iterator[None]:
    """While this holds, sorting into ranges sends the driver 3 * SAMPLED_KEYS keys at most (10 a partition at least),
    however many partitions the ranges have; by Spark's default their number grows with the partitions."""
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(max(10, min(100, SAMPLED_KEYS // int(spark.conf.get("spark.sql.shuffle.partitions"))))))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


STEPS_A_ROUND = 4
ROUNDS = 4
EDGES_A_TASK = 20_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Every node takes the smallest label among its own and its neighbours' until nothing changes (hash-min). The edges
    stay partitioned by the node that sends, the labels come out partitioned by node, so a step costs one shuffle;
    lineage is cut every STEPS_A_ROUND steps. Components of a wide diameter, which are not done after ROUNDS rounds,
    are contracted to the graph of their labels, which is many times smaller, and this is solved in the same way. Nodes
    with over EDGES_A_TASK edges and a thousandth of all, of which there are HEAVY_PARTS at most, send by a broadcast of
    their labels; their edges stay dealt as they are.
    """
    ways = edges.select(F.explode(F.array(*(F.struct(F.col(x).alias("node"), F.col(y).alias("other")) for x, y in ("ab", "ba", "aa", "bb")))).alias("e")).select("e.*")
    ways = cut(ways.distinct())
    n = ways.count()
    if not n:
        return ways.select("node", F.col("other").alias("component"))
    parts = max(1, min(partitions(edges), -(-n // EDGES_A_TASK)))  # a few links need not be dealt to many tasks
    hubs = ways.groupBy("other").agg(F.count("*").alias("n")).where((F.col("n") > EDGES_A_TASK) & (F.col("n") * HEAVY_PARTS > F.lit(n))).select("other")
    hubs = cut(hubs)
    spokes = None if hubs.isEmpty() else cut(ways.join(F.broadcast(hubs), "other", "left_semi"))
    if spokes is not None:
        ways = ways.join(F.broadcast(hubs), "other", "left_anti")
    ways = cut(ways.repartition(parts, "other"), layout=True)
    labels = ways if spokes is None else ways.unionByName(spokes)
    labels = labels.groupBy(F.col("other").alias("node")).agg(F.min("node").alias("component"))
    labels = cut(labels if spokes is None else labels.repartition(parts, "node"), layout=True)
    before = None
    for _ in range(ROUNDS):
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)")).alias("s")).first().s
        if now is None or now == before:
            return labels
        before = now
        for _ in range(STEPS_A_ROUND):
            known = labels.withColumnRenamed("node", "other")
            sent = ways.join(known, "other").select("node", "component")
            if spokes is not None:
                sent = sent.unionByName(spokes.join(F.broadcast(known.join(F.broadcast(hubs), "other", "left_semi")), "other").select("node", "component"))
            labels = sent.repartition(parts, "node").groupBy("node").agg(F.min("component").alias("component"))
        labels = cut(labels, layout=True)
    ends = edges.join(labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a").join(labels.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
    ends = cut(ends.where("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
    if ends.isEmpty():
        return labels
    roots = components(ends).select(F.col("node").alias("component"), F.col("component").alias("root"))
    sizes = labels.groupBy("component").agg(F.count("*").alias("members")).join(roots, "component")
    return cut(lookup(labels, ["component"], sizes, "members", labels.count()).select("node", F.coalesce("root", "component").alias("component")))
