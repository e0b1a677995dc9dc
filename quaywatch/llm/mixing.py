"""Mixing sources to target weights, with DataFrame functions only.

Sources, in code-point order with null last, weigh 1, 2, 3, 1, 2, ... and share
the words of all documents. A target stops at `most` times its source's words;
the excess goes to the others by weight until none is above.

A source's documents are dealt by hash into blocks. A target of r times the
source's words draws every block floor(r) times and, for the rest of r, whole
blocks in a permuted order up to the rest, and in the block that crosses it,
documents in a permuted order up to the first that overshoots. That document is
passed over, and rounds over all that is left fill what is missing, until no
document fits; last comes the smallest, if it brings the total nearer. So a
total is off its target by half of the smallest document left, at most.

The draws are dealt over output shards by a splitting tree: a node's draws are
halved by a uniformly random subset of exactly half of them, so the sources'
counts in each half are multivariate hypergeometric, and so on down to the
shards. Draws are counted by ranges of chance, and none but those of a range meet. That fixes each shard's quota of blocks of each source. The shards then
take disjoint runs of the source's permuted draws, and rows are shuffled within
a shard by `order_key`. Hashes with a seed stand for chance: reruns agree.

Null texts have size 0. Rows without words are drawn as others are; a source
without words has target 0. Rows alike in source, doc_id and size are drawn
alike. Null doc_ids are such rows too. No rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaywatch.llm.tables import written


@dataclass(frozen=True)
class Mix:
    """cycle: weights in turn; most: times a document may be taken; levels: log2 of the shards; rows: of a block, at least; blocks: of a source, at most."""

    cycle: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    levels: int = 4
    rows: int = 256
    blocks: int = 4096
    seed: int = 17


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`: where a word begins, after blanks are made one character."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A source as a key without nulls that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def targets(sized: DataFrame, how: Mix = Mix()) -> DataFrame:
    """(source_key, weight, source_size, source_rows, target): one row a source.

    The windows run over a row for each source, no more. Sorted by the ratio
    most * size / weight, the sources up to some place are at their limit; the
    rest share what remains by weight.
    """
    one = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    order = Window.orderBy("source_key")
    weights = F.array(*(F.lit(w) for w in how.cycle))
    one = one.withColumn("weight", F.element_at(weights, ((F.row_number().over(order) - 1) % len(how.cycle) + 1).cast("int")))
    limit = F.lit(how.most) * F.col("source_size")
    by_ratio = Window.orderBy(limit / F.col("weight"), "source_key")
    everything = Window.partitionBy()
    one = one.withColumns({
        "_all": F.sum("source_size").over(everything),
        "_limited": F.coalesce(F.sum(limit).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_weights": F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
    })
    one = one.withColumn("_level", (F.col("_all") - F.col("_limited")) / F.col("_weights"))
    # Past the first source below its limit the level only falls.
    level = F.max(F.when(limit / F.col("weight") >= F.col("_level"), F.col("_level"))).over(everything)
    one = one.withColumn("_least", level)
    return one.select("source_key", "weight", "source_size", "source_rows", F.least(limit.cast("double"), F.coalesce(F.col("_least") * F.col("weight"), limit.cast("double"))).alias("target"))


def _order(how: Mix, *columns: str) -> Column:
    return F.xxhash64(F.lit(how.seed), *(F.lit(c) if c == "doc" else F.col(c) for c in columns))


def plan(sized: DataFrame, how: Mix = Mix()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per source, what its documents need to know; per block, the shards of its draws; and the units of several rows.

    sized: source_key, doc_id, size. The first has a row a source, the second at
    most `blocks` rows a source, whatever the documents.
    """
    each = targets(sized, how).withColumns({
        "n_blocks": F.least(F.lit(how.blocks), F.greatest(F.lit(1), F.ceil(F.col("source_rows") / how.rows))).cast("long"),
        "passes": F.when(F.col("source_size") > 0, F.least(F.lit(how.most), F.floor(F.col("target") / F.col("source_size") + F.lit(1e-12)))).otherwise(0).cast("int"),
    })
    each = written(each.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size"))), "mix-sources")
    # Rows alike are one unit, since they are drawn alike.
    units = written(sized.groupBy("source_key", "doc_id", "size").agg(F.count("*").alias("n")), "mix-units")
    rows = units.join(each.select("source_key", "n_blocks"), "source_key").withColumns(_places(how)).withColumn("words", F.col("size") * F.col("n"))
    now = _rounds(rows, each)

    # No unit that is left fits; the smallest is taken where that brings the total nearer.
    left = rows.join(now, "source_key").where(~taken_in_rounds()).where("words > 0 and words < 2 * gap")
    extra = left.groupBy("source_key").agg(F.min(F.struct("words", "place", "doc_id", "size")).alias("extra"))
    each = written(each.join(now.select("source_key", "rounds"), "source_key", "left").join(extra, "source_key", "left"), "mix-plan")
    return each, written(_dealt(rows, each, how), "mix-draws"), written(units.where("n > 1"), "mix-repeated")


def _rounds(rows: DataFrame, each: DataFrame) -> DataFrame:
    """(source_key, gap, rounds) of the sources with a rest: what each round takes, and the words still missing.

    A round takes units in the order of blocks and places up to the first that
    overshoots: the first round of all units, a later one of those left with at
    most half of the gap or, where there are none, at most the gap. So the gap
    halves in each round but the last, after which it is less than any unit
    left. Blocks are summed first; a window over units has one block a source.
    """
    key = f"turn: bigint, block: bigint, place: bigint, doc_id: {rows.schema['doc_id'].dataType.simpleString()}, size: bigint"
    none = f"cast(array() as array<struct<least: bigint, most: double, last: struct<{key}>>>)"
    now = written(each.where("rest > 0").select("source_key", F.col("rest").alias("gap"), F.expr(none).alias("rounds")), "mix-round")
    least, small, fits = 0, F.lit(True), F.lit(True)
    while True:
        left = rows.join(now, "source_key").where(~taken_in_rounds() & (F.col("words") >= least))
        blocks = left.where(fits).groupBy("source_key", "turn", "block").agg(F.sum(F.when(small, F.col("words"))).alias("some"), F.sum("words").alias("every"), F.first("gap").alias("gap"))
        whole = Window.partitionBy("source_key")
        halves = F.max("some").over(whole).isNotNull()
        most = F.when(halves, F.col("gap") / 2).otherwise(F.col("gap")) if least else F.lit(float("inf"))
        blocks = blocks.withColumn("most", most).withColumn("sum", F.when(halves, F.coalesce("some", F.lit(0))).otherwise(F.col("every")))
        permuted = Window.partitionBy("source_key").orderBy("turn", "block")
        blocks = written(blocks.withColumn("before", F.sum("sum").over(permuted) - F.col("sum")), "mix-blocks")
        if blocks.isEmpty():
            return now
        cross = F.min(F.when(F.col("before") + F.col("sum") > F.col("gap"), F.struct("turn", "block", "before")))
        cuts = written(blocks.groupBy("source_key").agg(F.first("most").alias("most"), F.sum("sum").alias("all"), cross.alias("cut")), "mix-cuts")

        # Units of the block that crosses the gap.
        crossing = left.join(cuts, "source_key").where((F.col("block") == F.col("cut.block")) & (F.col("words") <= F.col("most")))
        some = Window.partitionBy("source_key").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
        crossing = crossing.withColumn("upto", F.sum("words").over(some) + F.col("cut.before")).where("upto <= gap")
        here = crossing.groupBy("source_key").agg(F.max(_key_of_unit()).alias("last"), F.max("upto").alias("upto"))
        upto = F.coalesce(F.when(F.col("cut").isNull(), F.col("all")).otherwise(F.coalesce("upto", "cut.before")), F.lit(0))
        # Where no unit of the block fits, nulls, which come before any place; where all units fit, no last one.
        last = F.when(F.col("cut").isNotNull(), F.coalesce("last", F.expr(f"cast(named_struct('turn', cut.turn, 'block', cut.block, 'place', null, 'doc_id', null, 'size', null) as struct<{key}>)")))
        more = F.when(F.col("most").isNotNull(), F.concat("rounds", F.array(F.struct(F.lit(least).cast("long").alias("least"), "most", last.alias("last"))))).otherwise(F.col("rounds"))
        now = written(now.join(cuts, "source_key", "left").join(here, "source_key", "left").select("source_key", (F.col("gap") - upto).alias("gap"), more.alias("rounds")), "mix-round")
        least, small, fits = 1, F.col("words") <= F.col("gap") / 2, F.col("words") <= F.col("gap")


def _places(how: Mix) -> dict[str, Column]:
    at = block(how)
    return {"block": at, "turn": F.xxhash64(F.lit(how.seed), F.col("source_key"), at), "place": _order(how, "doc", "doc_id")}


def _key_of_unit() -> Column:
    return F.struct("turn", "block", "place", "doc_id", "size")


def block(how: Mix) -> Column:
    return F.pmod(F.xxhash64(F.lit(how.seed + 1), F.col("doc_id")), F.col("n_blocks"))


def taken_in_rounds() -> Column:
    took = lambda r: F.col("words").between(r["least"], r["most"]) & (r["last"].isNull() | (_key_of_unit() <= r["last"]))
    return F.coalesce(F.exists("rounds", took), F.lit(False))


def taken_in_rest() -> Column:
    extra = F.col("extra").isNotNull() & F.col("extra.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("extra.size") == F.col("size"))
    return taken_in_rounds() | F.coalesce(extra, F.lit(False))


def _shards(units: DataFrame, levels: int, bins: int = 10) -> DataFrame:
    """The units with `node`, the shard that the tree of halvings leads them to.

    One order by `_chance` serves all levels: a uniformly random order of a
    node's units leaves those of each half in one, independent of the halving. A
    node of n units gives its first (n + parity) div 2 to its first half. Units
    are counted in 2^bins ranges of chance, and ranked inside a range, so no
    task has all of them; the window over ranges has 2^bins rows.
    """
    units = units.withColumn("_bin", F.shiftright("_chance", 64 - bins))
    counts = units.groupBy("_bin").agg(F.count("*").alias("_in"))
    whole = Window.orderBy("_bin")
    counts = counts.select("_bin", (F.sum("_in").over(whole) - F.col("_in")).alias("_before"), F.sum("_in").over(Window.partitionBy()).alias("_n"))
    ranked = Window.partitionBy("_bin").orderBy("_chance", "source_key", "block", "pass")
    out = units.join(counts, "_bin").withColumn("_at", F.row_number().over(ranked) + F.col("_before")).withColumn("node", F.lit(0))
    for _ in range(levels):
        half = F.floor((F.col("_n") + F.col("node") % 2) / 2)
        left = F.col("_at") <= half
        out = out.withColumns({"node": F.col("node") * 2 + F.when(left, 0).otherwise(1), "_n": F.when(left, half).otherwise(F.col("_n") - half), "_at": F.when(left, F.col("_at")).otherwise(F.col("_at") - half)})
    return out.drop("_chance", "_bin", "_before", "_n", "_at")


def _dealt(rows: DataFrame, each: DataFrame, how: Mix) -> DataFrame:
    """(source_key, block, shards): the shard of each draw of the block, the rest's draw last.

    A unit is one draw of a block.
    """
    drawn = rows.join(each.select("source_key", "passes", "rounds", "extra"), "source_key").groupBy("source_key", "block").agg(F.first("passes").alias("passes"), F.max(taken_in_rest()).alias("rest"))
    # After the full passes, one more draw of each block that the rest takes anything of.
    n = F.col("passes") + F.col("rest").cast("int")
    units = drawn.withColumn("_n", n).where("_n > 0").select("source_key", "block", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("pass"))
    units = written(units, "mix-drawn")
    quota = _shards(units.withColumn("_chance", F.xxhash64(F.lit(how.seed + 2), "source_key", "block", "pass")), how.levels)
    # Quotas of each shard and source; the shards then take runs of the source's permuted draws.
    quota = quota.groupBy("node", "source_key").agg(F.count("*").alias("quota"))
    runs = Window.partitionBy("source_key").orderBy("node")
    quota = quota.withColumn("first", F.sum("quota").over(runs) - F.col("quota"))
    places = quota.select("source_key", F.col("node").alias("shard"), F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("quota"))).alias("at"))
    permuted = Window.partitionBy("source_key").orderBy(F.xxhash64(F.lit(how.seed + 99), "block", "pass"), "block", "pass")
    drawn = units.withColumn("at", F.row_number().over(permuted).cast("long")).join(places.withColumn("at", F.col("at").cast("long")), ["source_key", "at"])
    return drawn.groupBy("source_key", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("pass", "shard"))), lambda x: x["shard"]).alias("shards"))


def draws(sized: DataFrame, each: DataFrame, dealt: DataFrame, repeated: DataFrame, how: Mix = Mix()) -> DataFrame:
    """`sized` with source_size, target and `shards`, an output shard for each time the document is taken."""
    joined = sized.join(each, "source_key").withColumns(_places(how)).join(dealt, ["source_key", "block"], "left")
    again = repeated.select(F.col("source_key").alias("_of"), F.col("doc_id").alias("_doc"), F.col("size").alias("_size"), "n")
    joined = joined.join(again, (F.col("source_key") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("size") == F.col("_size")), "left")
    joined = joined.withColumn("words", F.col("size") * F.coalesce("n", F.lit(1)))
    times = F.col("passes") + taken_in_rest().cast("int")
    kept = [c for c in sized.columns]
    return joined.select(*kept, "source_size", "target", F.slice(F.coalesce("shards", F.array().cast("array<int>")), F.lit(1), times).alias("shards"))


def _sized(documents: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return documents.select(F.col(id_column).alias("doc_id"), _key(F.col(source_column)).alias("source_key"), word_count(F.col(text_column)).alias("size"))


def decide(documents: DataFrame, how: Mix = Mix(), id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken and shards of every document."""
    sized = written(_sized(documents, id_column, text_column, source_column), "mix-sizes")
    each, dealt, repeated = plan(sized, how)
    return draws(sized, each, dealt, repeated, how).select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), F.array_join(F.transform("shards", lambda s: s.cast("string")), ",").alias("shards"))


def mix(documents: DataFrame, how: Mix = Mix(), id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", place: bool = True) -> DataFrame:
    """The documents, all their columns, once for each time they are taken; `place` adds mix_shard and order_key, by which `write_mixed` shuffles within a shard."""
    sized = written(_sized(documents, id_column, text_column, source_column), "mix-sizes")
    each, dealt, repeated = plan(sized, how)
    names = documents.columns
    whole = documents.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_whole"), F.col(id_column).alias("doc_id"), _key(F.col(source_column)).alias("source_key"), word_count(F.col(text_column)).alias("size"))
    taken = draws(whole, each, dealt, repeated, how).select("_whole", F.posexplode("shards").alias("_time", "mix_shard"))
    columns = [F.col("_whole")[c].alias(c) for c in names]
    if place:
        columns += ["mix_shard", F.xxhash64(F.lit(how.seed + 7), F.col("mix_shard"), F.col("_whole")[id_column], F.col("_time")).alias("order_key")]
    return taken.select(*columns)


def write_mixed(documents: DataFrame, path: str, how: Mix = Mix(), **names: str) -> None:
    """The mix as Parquet files, a folder mix_shard=k for each shard, its rows in the order of order_key."""
    mixed = mix(documents, how, **names)
    mixed.repartition("mix_shard").sortWithinPartitions("mix_shard", "order_key").write.partitionBy("mix_shard").parquet(path)
