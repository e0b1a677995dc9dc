"""Tables that cut lineage, written where every executor can read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywatch.operators.scratch import folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again.

    A lost executor then costs the tasks that ran on it and nothing before the
    table. Shuffle files of the write go once it is done, since nothing reads
    them again; the folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = folder(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Written tables that nothing will read any more; their folders go at once."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        there = jvm.org.apache.hadoop.fs.Path(df._folder)
        there.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


#: What a repeated task reads alike: files, row by row.
_BY_ROW = {"LogicalRelation", "DataSourceV2ScanRelation", "Project", "Filter"}


def settled(df: DataFrame, name: str) -> DataFrame:
    """`df` itself where it is files, read row by row without chance, which a repeated task reads alike; written where it is anything else."""
    plan = df._jdf.queryExecution().optimizedPlan()
    nodes, sure = [plan], plan.deterministic()
    while nodes and sure:
        node = nodes.pop()
        children = node.children()
        sure = node.getClass().getSimpleName() in _BY_ROW
        nodes += [children.apply(k) for k in range(children.size())]
    return df if sure else written(df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node is either on one edge downwards or at the lower end of edges."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("low")), F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("low")))).alias("e")).select("e.*")
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("low").alias("low")).where("up + low > 1").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root) for each node on an edge; root is the smallest node that is reachable.

    Alternating large-star and small-star rounds; each hooks every node to the
    smallest neighbour, so a chain shortens by a constant factor a round. Each
    round's edges are written, and no round gathers a component in one place.
    """
    now = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "cc"
    )
    for _ in range(most_rounds):
        if _stars(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The minima are a table, so that the join can split a node with many neighbours.
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("m", "u").alias("m")), "cc-low")
        large = (
            both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # Small star: every smaller neighbour of u, and u, hook to the smallest of them.
        large = written(large, "cc-large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m"), "cc-low")
        hooked = large.join(low, F.col("u") == F.col("k"))
        was, now = now, written(
            hooked.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct(),
            "cc",
        )
        discard(was, least, large, low)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    # Settled: each non-root has one edge, to its root.
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
