"""Sharding by extendible hashing: a directory over hash-prefix bits.

All rows begin in one bucket. A bucket over the byte limit splits on the next
bit of its rows' hash, and only such a bucket does, so a row's shard is the
shortest prefix of its hash whose rows fit. The prefix sums come from one
histogram: first over cells a few bits deeper than the mean shard, then, for
cells that are still too large, over their distinct hashes at full depth.

The hash is the first 60 bits of the md5 of the key. Rows with one hash can't
be parted by bits: a bucket of them over the limit gets overflow pages, named
after the prefix, each within the limit. A row that is over the limit by itself
has a page of its own.

A null text has 0 bytes. A row with a null key is hashed by its text. Repeated
rows are placed each. No rows give no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywatch.llm.tables import written

BITS = 60
LIMIT = 1 << 20
#: Bits of a first cell beyond those of the mean shard.
FINER = 4
_HASH, _SIZE = "_shard_hash", "_shard_size"


def hashed(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with the two columns that `assign` needs."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("text:"), text))
    return documents.withColumns({_HASH: F.conv(F.substring(F.md5(key.cast("binary")), 1, BITS // 4), 16, 10).cast("long"), _SIZE: F.octet_length(text).cast("long")})


def _nodes(cells: DataFrame, low: int, high: int) -> DataFrame:
    """(hash, depth, prefix, bytes, n_rows): each cell beside the buckets that it lies in, of depths low to high."""
    spread = cells.select(_HASH, _SIZE, "n", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn("prefix", F.expr(f"shiftright({_HASH}, {BITS} - depth)"))
    sums = spread.groupBy("depth", "prefix").agg(F.sum(_SIZE).alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    return spread.select(_HASH, "depth", "prefix").join(sums, ["depth", "prefix"])


def _leaves(nodes: DataFrame, limit: int) -> DataFrame:
    """The shortest prefix that fits, of each cell; nulls where none does."""
    fits = F.struct("depth", "prefix", "shard_bytes", "shard_rows")
    return nodes.groupBy(_HASH).agg(F.min(F.when(F.col("shard_bytes") <= limit, fits)).alias("leaf"))


def assign(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The rows of `hashed`, without its two columns, with shard, depth, shard_bytes and shard_rows.

    Only cells travel, and the directory is joined back by cell; rows of an
    overflowing bucket are grouped with their likes and dealt over its pages.
    """
    others = [c for c in rows.columns if c not in (_HASH, _SIZE)]
    total = rows.agg(F.coalesce(F.sum(_SIZE), F.lit(0)).alias("b")).first().b
    first = min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FINER)
    cell = F.shiftleft(F.shiftright(_HASH, BITS - first), BITS - first)
    cells = rows.groupBy(cell.alias(_HASH)).agg(F.sum(_SIZE).alias(_SIZE), F.count("*").alias("n"))
    coarse = written(_leaves(_nodes(cells, 0, first), limit), "shard-cells").withColumnRenamed(_HASH, "_shard_cell")
    placed = rows.withColumn("_shard_cell", cell).join(coarse, "_shard_cell")
    large = placed.where("leaf is null").drop("leaf", "_shard_cell")
    # Distinct hashes in the cells that no depth so far could part.
    deep = large.groupBy(_HASH).agg(F.sum(_SIZE).alias(_SIZE), F.count("*").alias("n"))
    fine = written(_leaves(_nodes(deep, first + 1, BITS), limit).join(deep.withColumnRenamed(_SIZE, "_shard_all").withColumnRenamed("n", "_shard_n"), _HASH), "shard-hashes") if first < BITS else None
    parts = [placed.where("leaf is not null").drop("_shard_cell").withColumn("_page", F.lit(""))]
    if fine is not None and fine.limit(1).count():
        deeper = large.join(fine, _HASH)
        parts.append(deeper.where("leaf is not null").drop("_shard_all", "_shard_n").withColumn("_page", F.lit("")))
        # One hash, over the limit: likes share pages of at most limit bytes, and at least a row.
        alike = deeper.where("leaf is null").groupBy(*others, _HASH, _SIZE).agg(F.count("*").alias("n"))
        each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(limit) / F.col(_SIZE)))
        kind = F.hex(F.xxhash64(*others, _SIZE))
        paged = alike.where(F.col(_SIZE) > 0).withColumn("_each", each).withColumn("_no", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div _each"))))
        paged = paged.withColumn("_in", F.least(F.col("_each"), F.col("n") - F.col("_no") * F.col("_each")))
        none = alike.where(F.col(_SIZE) == 0).withColumn("_each", F.lit(1 << 20).cast("long")).withColumn("_no", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div _each"))))
        none = none.withColumn("_in", F.least(F.col("_each"), F.col("n") - F.col("_no") * F.col("_each")))
        paged = paged.unionByName(none).withColumn("_page", F.concat(F.lit("."), kind, F.lit("."), F.col("_no")))
        paged = paged.withColumn("leaf", F.struct(F.lit(BITS).alias("depth"), F.col(_HASH).alias("prefix"), (F.col("_in") * F.col(_SIZE)).alias("shard_bytes"), F.col("_in").alias("shard_rows")))
        paged = paged.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_in")))).select(*others, _HASH, _SIZE, "leaf", "_page")
        parts.append(paged)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    bits = F.when(F.col("leaf.depth") == 0, "").otherwise(F.expr("lpad(bin(leaf.prefix), leaf.depth, '0')"))
    return out.select(*others, F.concat(bits, "_page").alias("shard"), F.col("leaf.depth").alias("depth"), F.col("leaf.shard_bytes").alias("shard_bytes"), F.col("leaf.shard_rows").alias("shard_rows"))


def shards(documents: DataFrame, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, shard, depth, shard_bytes and shard_rows of each document; texts don't travel."""
    light = written(hashed(documents, id_column, text_column).select(F.col(id_column).alias("doc_id"), _HASH, _SIZE), "shard-rows")
    return assign(light, limit)


def write_shards(documents: DataFrame, path: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> None:
    """The documents, all their columns, in one folder of Parquet a shard, `shard=...`; a column of that name gets the folders called `shard_`."""
    marked = hashed(documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_whole"), F.col(id_column).alias("_id"), F.col(text_column).alias("_text")), "_id", "_text")
    placed = assign(marked.drop("_id", "_text"), limit)
    name = "shard"
    while name in documents.columns:
        name += "_"
    placed.select(*(F.col("_whole")[c].alias(c) for c in documents.columns), F.col("shard").alias(name)).repartition(name).write.partitionBy(name).parquet(path)
