"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by shingle count into classes (2^j, 2^(j+1)]. An item's
sketch is its smallest hashes, as many as its class's largest size u asks for:
u - ceil(t u) + 1. An item of q shingles whose containment in a document is t
or more lacks at most floor((1-t) q) of them, so the document holds at least
sketch - floor((1-t) q) sketch hashes; that count makes a candidate, and none
is missed at any document length. Candidates are verified by exact shingle
containment |item in document| / |item|.

The item index is sent to all tasks in blocks of at most `block` shingles. Each
block scans the documents once, its hits are written, and it goes before the
next comes, so memory doesn't grow with the benchmark. `remove` filters texts as it reads them
where one block holds all items; with more it gathers the hits' digests and leaves those texts out by one join.

An item or text with fewer than five words is one shingle, its whole sequence;
without words, or null, it matches nothing. So an item of one to four words
matches only whole texts; inside a longer document it isn't found. Repeated rows of either side count
each; null ids stay null; ids are integers. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywatch.llm import words
from quaywatch.llm.tables import written

THRESHOLD = (4, 5)
BLOCK = 2_000_000


class Index:
    """Sketches and whole shingle sets of one block of items."""

    def __init__(self, ids: list, sets: list[np.ndarray], threshold: tuple[int, int] = THRESHOLD):
        top, bottom = threshold
        self.ids, self.sets = ids, sets
        self.least = np.zeros(len(sets), dtype=np.int64)
        self.needs = np.zeros(len(sets), dtype=np.int64)
        hashes, of = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for k, s in enumerate(sets):
            q = len(s)
            u = 1 << (q - 1).bit_length()
            sketch = min(q, u - -(-top * u // bottom) + 1)
            self.least[k] = -(-top * q // bottom)
            self.needs[k] = max(1, sketch - (q - self.least[k]))
            hashes.append(s[:sketch])
            of.append(np.full(sketch, k))
        hashes, of = np.concatenate(hashes), np.concatenate(of)
        order = np.argsort(hashes, kind="stable")
        self.of = of[order]
        self.keys, self.first = np.unique(hashes[order], return_index=True)
        self.upto = np.append(self.first[1:], len(hashes))

    def search(self, found: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) at or over the threshold; `found` is sorted by (row, hash)."""
        if not len(self.keys) or not len(found):
            return
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        hit = self.keys[at] == found
        at, row = at[hit], rows[hit]
        n = self.upto[at] - self.first[at]
        items = self.of[np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())] if len(at) else np.zeros(0, dtype=np.int64)
        pairs, hits = np.unique(np.repeat(row, n) * len(self.sets) + items, return_counts=True)
        for pair, h in zip(pairs.tolist(), hits.tolist()):
            r, item = divmod(pair, len(self.sets))
            if h < self.needs[item]:
                continue
            a, b = np.searchsorted(rows, [r, r + 1])
            mine, s = found[a:b], self.sets[item]
            shared = int((mine[np.minimum(np.searchsorted(mine, s), len(mine) - 1)] == s).sum())
            if shared >= self.least[item]:
                yield r, item, shared


def _blocks(benchmark: DataFrame, id_column: str, text_column: str, block: int) -> Iterator[Index]:
    """Indexes of the benchmark's items, block after block; one block at a time is on the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in words.chunks(batch):
                found, rows, _ = words.shingles(data, offsets)
                at = words.bounds(rows, piece.num_rows)
                sets = [found[at[k] : at[k + 1]].tobytes() for k in range(piece.num_rows)]
                yield pa.RecordBatch.from_arrays([piece.column("item_id").cast(pa.int64()), pa.array(sets, pa.binary())], ["item_id", "s"])

    items = benchmark.select(benchmark[id_column].alias("item_id"), benchmark[text_column].alias("text")).mapInArrow(each, "item_id long, s binary").where(F.length("s") > 0)
    ids, sets, size = [], [], 0
    for r in items.toLocalIterator():
        s = np.frombuffer(bytes(r.s), dtype=np.uint64)
        if sets and size + len(s) > block:
            yield Index(ids, sets)
            ids, sets, size = [], [], 0
        ids.append(r.item_id)
        sets.append(s)
        size += len(s)
    if sets:
        yield Index(ids, sets)


def _hits(docs: DataFrame, sent: Broadcast, schema: str, told: Callable[[pa.RecordBatch, list, Index], list[pa.Array]]) -> DataFrame:
    """What `told` makes of each piece of texts with hits (row, item, shared) in one block."""
    names = T.StructType.fromDDL(schema).names

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in words.chunks(batch):
                found, rows, _ = words.shingles(data, offsets)
                hits = list(sent.value.search(found, rows))
                if hits:
                    yield pa.RecordBatch.from_arrays(told(piece, hits, sent.value), names)

    return docs.mapInArrow(each, schema)


def _by_block(docs: DataFrame, first: Index, others: Iterator[Index], schema: str, told: Callable[[pa.RecordBatch, list, Index], list[pa.Array]]) -> DataFrame:
    """The hits of all blocks; those of one are written before the next is sent."""
    context, second = docs.sparkSession.sparkContext, next(others, None)
    if second is None:
        return _hits(docs, context.broadcast(first), schema, told)
    out = None
    for index in chain((first, second), others):
        sent = context.broadcast(index)
        part = written(_hits(docs, sent, schema, told), "hits")
        sent.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def find(documents: DataFrame, benchmark: DataFrame, block: int = BLOCK, id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, item_size) of each document and item it contains."""
    docs = documents.select(documents[id_column].cast("long").alias("doc_id"), documents[text_column].alias("text"))
    schema = "doc_id long, item_id long, shared long, item_size long"
    blocks = _blocks(benchmark, item_id, item_text, block)
    first = next(blocks, None)
    if first is None:
        return documents.sparkSession.createDataFrame([], schema)

    def told(piece: pa.RecordBatch, hits: list, index: Index) -> list[pa.Array]:
        take = pa.array([r for r, _, _ in hits], pa.int64())
        return [piece.column("doc_id").take(take), *(pa.array(c, pa.int64()) for c in ([index.ids[i] for _, i, _ in hits], [s for _, _, s in hits], [len(index.sets[i]) for _, i, _ in hits]))]

    return _by_block(docs, first, blocks, schema, told)


def remove(documents: DataFrame, benchmark: DataFrame, block: int = BLOCK, text_column: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents, all their columns, that contain no item; no shuffle where one block holds all items."""
    blocks = _blocks(benchmark, item_id, item_text, block)
    first = next(blocks, None)
    if first is None:
        return documents
    second = next(blocks, None)
    if second is None:
        sent = documents.sparkSession.sparkContext.broadcast(first)

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece, data, offsets in words.chunks(batch, text_column):
                    found, rows, _ = words.shingles(data, offsets)
                    clean = np.ones(piece.num_rows, dtype=bool)
                    clean[[r for r, _, _ in sent.value.search(found, rows)]] = False
                    yield piece.filter(pa.array(clean))

        return documents.mapInArrow(each, documents.schema)
    # Whether a text holds an item depends on the text alone.
    digest = F.sha2(F.col(f"`{text_column}`"), 256)
    docs = documents.select(digest.alias("key"), F.col(f"`{text_column}`").alias("text"))
    keys = _by_block(docs, first, chain((second,), blocks), "key string", lambda piece, hits, _: [piece.column("key").take(pa.array(sorted({r for r, _, _ in hits}), pa.int64()))]).distinct()
    whole = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_whole"), digest.alias("_digest"))
    kept = whole.join(keys, F.col("_digest") == F.col("key"), "left_anti")
    return kept.select(*(F.col("_whole")[c].alias(c) for c in documents.columns))
