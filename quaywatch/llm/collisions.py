"""Near-duplicate embeddings by counting collisions of one-dimensional projections.

Equal vectors of a label form a class, which is searched for once and counted as
many times as it has rows. Vectors of one label and dimension are scaled to
length 1 and turned; m coordinates of the turned vector are its projections. Two
vectors collide in a projection when one lies in the window of half-width w
around the other. For unit vectors of cosine c or more, the squared differences
over any orthonormal projections sum to 2 - 2c at most, so they miss at most
(2 - 2c) / w^2 windows: pairs with m less that many collisions are candidates.
The count is thus calibrated to recall 1, and a random pair rarely reaches it.
Candidates are verified by their cosine in double precision.

No projection of such a pair differs by more than sqrt(2 - 2c). Cells as wide as
that, over one to `axes` projections, deal the classes; the more classes a label
has, the more projections, so that a class goes to no more neighbouring cells than
it would meet blocks anyway. A cell meets itself and its neighbours. Cells are cut
into blocks of `block` classes; a pair of blocks is one unit of work. In it, the
second block is sorted along every projection. A query's window of that greatest
difference is a range in each of them; the shortest range gives its partners, and the
windows of half-width w are counted in it. Links are counted there, and a spanning
forest goes on, never the pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and
those without a label, link with nothing. Repeated rows are vectors each; a
null vec_id stays null and is no component's smallest unless alone. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywatch.llm.groups import each_group, roots
from quaywatch.llm.tables import components, written


@dataclass(frozen=True)
class Search:
    """cosine: least similarity; projections: at most; window: half-width; first: projections counted for all pairs; axes: projections that deal cells, at most; block: classes; tile: queries at once."""

    cosine: float = 0.98
    projections: int = 32
    window: float = 0.1
    first: int = 16
    axes: int = 4
    block: int = 2048
    tile: int = 128
    seed: int = 5

    @property
    def reach(self) -> float:
        return float(np.sqrt(2 - 2 * self.cosine)) + 1e-9

    def misses(self) -> int:
        return int(np.floor((2 - 2 * self.cosine + 1e-9) / self.window**2))


def turn(dimension: int, how: Search) -> np.ndarray:
    """Orthonormal directions, as columns."""
    q, _ = np.linalg.qr(np.random.default_rng([how.seed, dimension]).standard_normal((dimension, dimension)))
    return q[:, : min(dimension, how.projections)]


def _tiles(best: np.ndarray, px: np.ndarray, tile: int) -> Iterator[tuple[int, np.ndarray]]:
    """(projection, queries that take it), in the order of that projection, a tile at a time."""
    for p in np.unique(best):
        queries = np.flatnonzero(best == p)
        queries = queries[np.argsort(px[queries, p], kind="stable")]
        for a in range(0, len(queries), tile):
            yield p, queries[a : a + tile]


def pairs(x: np.ndarray, y: np.ndarray, how: Search, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and y whose cosine is how.cosine or more; of a set with itself, each pair once."""
    lengths = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
    directions = turn(x.shape[1], how)
    px, py = ((v / n[:, None]) @ directions for v, n in zip((x, y), lengths))
    m, k = px.shape[1], min(how.first, px.shape[1])
    slack = how.window + 1e-7
    # Each query takes the projection in which the fewest lie within reach of it.
    order = np.argsort(py, axis=0, kind="stable")
    ranges = np.empty((m, len(px)), dtype=np.int64)
    for p in range(m):
        line = py[order[:, p], p]
        ranges[p] = np.searchsorted(line, px[:, p] + how.reach, "right") - np.searchsorted(line, px[:, p] - how.reach)
    best = ranges.argmin(axis=0)
    out = [], []
    for p, mine in _tiles(best, px, how.tile):
        line = py[order[:, p], p]
        lo = np.searchsorted(line, px[mine[0], p] - how.reach)
        hi = np.searchsorted(line, px[mine[-1], p] + how.reach, "right")
        if lo >= hi:
            continue
        theirs = order[lo:hi, p]
        near = np.ascontiguousarray(py[theirs, :k].T.astype(np.float32))
        count = np.zeros((len(mine), hi - lo), dtype=np.uint8)
        for q in range(k):
            count += np.abs(px[mine, q].astype(np.float32)[:, None] - near[q]) <= np.float32(slack)
        i, j = np.nonzero(count >= max(0, k - how.misses()))
        if not len(i):
            continue
        n = count[i, j].astype(np.int64)
        i, j = mine[i], theirs[j]
        if same:
            once = i < j
            i, j, n = i[once], j[once], n[once]
        for b in range(0, len(i), 1 << 16):
            ib, jb, nb = i[b : b + (1 << 16)], j[b : b + (1 << 16)], n[b : b + (1 << 16)]
            nb = nb + (np.abs(px[ib, k:] - py[jb, k:]) <= slack).sum(axis=1)
            enough = nb >= m - how.misses()
            ib, jb = ib[enough], jb[enough]
            cosine = np.einsum("ij,ij->i", x[ib], y[jb]) / (lengths[0][ib] * lengths[1][jb])
            linked = cosine >= how.cosine
            out[0].append(ib[linked])
            out[1].append(jb[linked])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *out[0]]), np.concatenate([none, *out[1]])


def _read(vectors: DataFrame, how: Search) -> DataFrame:
    """(row, vec_id, label, vector, dimension, cells, key): the vector as doubles, null where it links with nothing; its cell along each axis; a digest of it."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            blobs, sizes, cells, keys = [], [], [], []
            for v, label in zip(batch.column("vector"), batch.column("label").is_valid().to_pylist()):
                x = None
                if label and v.is_valid and len(v) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    with np.errstate(over="ignore"):
                        size = float(x @ x)
                    if not np.isfinite(x).all() or not np.any(x):
                        x = None
                    elif not np.isfinite(size) or size < 1e-290:
                        x = x / np.abs(x).max()
                if x is None:
                    blobs.append(None), sizes.append(0), cells.append(None), keys.append(None)
                    continue
                if len(x) not in turns:
                    turns[len(x)] = turn(len(x), how)[:, : how.axes]
                x = x + 0.0  # -0.0 is 0.0
                blobs.append(x.astype("<f8").tobytes())
                sizes.append(len(x))
                cells.append(np.floor((x @ turns[len(x)]) / np.sqrt(x @ x) / how.reach).astype(np.int32).tolist())
                keys.append(hashlib.blake2b(blobs[-1], digest_size=16).digest())
            columns = [batch.column("row"), batch.column("vec_id").cast(pa.int64()), batch.column("label").cast(pa.string()), pa.array(blobs, pa.binary()), pa.array(sizes, pa.int32()), pa.array(cells, pa.list_(pa.int32())), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "vec_id", "label", "vector", "dimension", "cells", "key"])

    return vectors.mapInArrow(each, "row long, vec_id long, label string, vector binary, dimension int, cells array<int>, key binary")


def _units(seats: DataFrame, how: Search) -> tuple[DataFrame, DataFrame]:
    """The seats (row, label, dimension, cell, block) of all classes, and the units (label, dimension, cell, block, unit, same, side) in which a block takes part."""
    space = ["label", "dimension"]
    # A class goes to 3^axes cells at most, and to as many blocks as hold its label's classes; the axes follow the lesser.
    sizes = seats.groupBy(*space).agg(F.greatest(F.lit(1), F.least(F.lit(how.axes), F.floor(F.log(F.count("*") / how.block) / float(np.log(3))))).cast("int").alias("axes"))
    # Tables of their own, so that a large label or cell can be split in the joins.
    sizes = written(sizes, "vector-axes")
    placed = seats.join(sizes, space).select("row", *space, "axes", F.slice("cells", 1, F.col("axes")).alias("cell"))
    cells = written(placed.groupBy(*space, "axes", "cell").agg(F.ceil(F.count("*") / how.block).cast("int").alias("blocks")), "vector-cells")
    placed = placed.join(cells.drop("axes"), [*space, "cell"]).select("row", *space, "cell", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"))
    # Each pair of neighbouring cells once, a cell with itself included; a cell may have fewer coordinates than axes.
    step = F.explode(F.expr("sequence(0, int(pow(3, size(cell))) - 1)"))
    around = cells.select(*space, "cell", "blocks", step.alias("step")).withColumn("other", F.expr("transform(cell, (x, k) -> int(x + int(step / pow(3, k)) % 3 - 1))"))
    around = around.where("cell <= other").join(cells.select(*space, F.col("cell").alias("other"), F.col("blocks").alias("others")), [*space, "other"])
    met = around.select(*space, "cell", "other", "others", F.explode(F.expr("sequence(0, blocks - 1)")).alias("i")).select("*", F.explode(F.expr("sequence(0, others - 1)")).alias("j")).where("cell < other or i <= j")
    met = met.select(*space, "cell", "other", "i", "j", F.expr("cell = other and i = j").alias("same"), F.xxhash64(*space, "cell", "other", "i", "j").alias("unit"))
    left = met.select(*space, "cell", F.col("i").alias("block"), "unit", "same", F.lit(0).alias("side"))
    right = met.where("not same").select(*space, F.col("other").alias("cell"), F.col("j").alias("block"), "unit", "same", F.lit(1).alias("side"))
    return placed, written(left.unionByName(right), "vector-units")


def _linked(classes: DataFrame, vectors: DataFrame, how: Search) -> DataFrame:
    """(cls, links, low) of each class in each unit where it has links: rows linked, and a class that it is connected with."""
    placed, units = _units(classes.select(F.col("cls").alias("row"), "label", "dimension", "cells"), how)
    heavy = classes.select(F.col("cls").alias("row"), "size").join(vectors.select("row", "vector"), "row")
    seats = placed.join(units, ["label", "dimension", "cell", "block"]).select("row", "unit", "same", "side")

    def work(table: pa.Table) -> pa.RecordBatch | None:
        same = table["same"][0].as_py()
        side, ids = table["side"].to_numpy(), table["row"].to_numpy()
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        if not len(left) or not len(right) or same and len(left) < 2:
            return None
        x = np.frombuffer(b"".join(table["vector"].to_pylist()), dtype="<f8").reshape(len(ids), -1)
        a, b = pairs(x[left], x[right], how, same)
        if not len(a):
            return None
        a, b = left[a], right[b]
        size = table["size"].to_numpy()
        links = np.bincount(a, weights=size[b], minlength=len(ids)) + np.bincount(b, weights=size[a], minlength=len(ids))
        by_id = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), dtype=np.int64)
        rank[by_id] = np.arange(len(ids))
        low = by_id[roots(len(ids), rank[a], rank[b])[rank]]
        some = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(ids[low[some]])], ["cls", "links", "low"])

    return each_group(heavy.join(seats, "row"), ["unit"], work, "cls long, links long, low long")


def near_duplicates(vectors: DataFrame, how: Search = Search(), id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector."""
    numbered = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    rows = written(_read(numbered, how), "vectors")
    kind = ["label", "dimension", "key"]
    classes = rows.where("vector is not null").groupBy(*kind).agg(F.min("row").alias("cls"), F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("cells").alias("cells"))
    classes = written(classes, "vector-classes")
    links = written(_linked(classes, rows, how), "vector-links")
    found = components(links.where("cls <> low").select(F.col("cls").alias("a"), F.col("low").alias("b")))
    counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
    members = found.join(classes.select(F.col("cls").alias("node"), "least"), "node")
    lowest = written(members.groupBy("root").agg(F.min("least").alias("least")), "vector-roots")
    component = members.select("node", "root").join(lowest, "root").select(F.col("node").alias("cls"), F.col("least").alias("component"))
    told = classes.select(*kind, "cls", "least", "size").join(counts, "cls", "left").join(component, "cls", "left")
    told = written(told.select(*kind, (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "least").alias("component")), "vector-told")
    out = rows.select("vec_id", *kind).join(told, kind, "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
