"""Self-join of texts by Jaccard similarity of word shingles, with several global token orders.

Two sets of similarity t or more share a token in their prefixes of
n - ceil(t n) + 1 tokens, under any order of all tokens. A candidate pair must
do so under three: by (document frequency, hash), by hash, and by hash
backwards. Candidates are verified by exact intersection.

1. Every text's set is hashed; equal sets form a class. Tokens go to the shuffle
   in sorted, packed runs, a run for a few million tokens and a hash range; a token
   that several sets of a run share is sent once, so that a token in a third of
   all texts costs a value a run. What comes back tells each set how many of
   its tokens others have. A set with a whole prefix of tokens of its own has no
   partner under the frequency order, and leaves here.
2. For what is left, one text a class, frequencies are counted exactly in the
   same way, and give the prefixes.
3. Sets that share a token of the frequency prefix are chained into candidate
   components. One with more than a block of sets is dealt into blocks of
   bounded size by its sets' lengths and rarest shared tokens, and an index
   from prefix tokens to blocks tells, for each order, which blocks have a token in common.
   Blocks that do under all three, of lengths that can reach the similarity, meet; others never do.
4. A pair of blocks, or a block with itself, is one unit of work: intersect the
   three filters set by set, then verify. It gives each set's number of links
   and a spanning forest of the links, never the pairs.
5. Components of the forests are the result's.

A null or empty text, or one without words, links with nothing. Repeated rows
are documents of one class, linked with each other. Each input row gives one
row; a null doc_id stays null and is no component's smallest unless alone.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywatch.llm import words
from quaywatch.llm.groups import each_group, roots, shared
from quaywatch.llm.tables import components, partitions, settled, written


@dataclass(frozen=True)
class Join:
    """top/bottom: the similarity; run: tokens packed together; block_sets, block_tokens: the most of a block; ranges: least hash ranges a partition; range_tokens: most tokens of a range."""

    top: int = 4
    bottom: int = 5
    run: int = 2_000_000
    block_sets: int = 256
    block_tokens: int = 2_000_000
    ranges: int = 4
    range_tokens: int = 4_000_000

    def ranged(self, documents: DataFrame) -> int:
        """How many hash ranges: a task holds one, so their number follows the input. A token takes two characters at least."""
        characters = documents.agg(F.sum(F.length("text"))).first()[0] or 0
        return max(self.ranges * partitions(documents.sparkSession), -(-characters // (2 * self.range_tokens)))

    def prefix(self, n):
        """Length of the prefix of a set of n tokens."""
        return n - (self.top * n + self.bottom - 1) // self.bottom + 1


ALL = np.uint16(0xFFFF)
_DROPPED = np.uint64(16)


def _pack(tokens: np.ndarray, extra: np.ndarray) -> bytes:
    """Sorted 48-bit tokens and 16 bits each, as planes of bytes."""
    planes = np.empty((8, len(tokens)), dtype=np.uint8)
    planes[:6] = tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 5::-1].T
    planes[6:] = extra.astype("<u2").view(np.uint8).reshape(-1, 2).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(8, -1)
    tokens = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    tokens[:, 5::-1] = planes[:6].T
    return tokens.reshape(-1).view("<u8"), np.ascontiguousarray(planes[6:].T).reshape(-1).view("<u2")


def _squeeze(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unsqueeze(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def class_keys(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 128-bit key of each set, as 16 bytes; of an empty set, zeros."""
    with np.errstate(over="ignore"):
        out = np.zeros((len(at) - 1, 2), dtype=">u8")
        for k, salt in enumerate((np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))):
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words.mix(found ^ salt), dtype=np.uint64)])
            out[:, k] = total[at[1:]] - total[at[:-1]]
    return out.view(np.uint8).reshape(-1, 16)


class _Run:
    """Sets gathered until they are packed together."""

    def __init__(self) -> None:
        self.tokens: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []
        self.size = self.sets = 0

    def add(self, tokens: np.ndarray, owners: np.ndarray, sets: int) -> None:
        self.tokens.append(tokens)
        self.owners.append(owners + self.sets)
        self.size += len(tokens)
        self.sets += sets

    def sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct tokens in order, how many sets have each, one owner of each, and of each set the tokens that another has."""
        tokens = np.concatenate(self.tokens) if self.tokens else np.zeros(0, dtype=np.uint64)
        owners = np.concatenate(self.owners) if self.owners else np.zeros(0, dtype=np.int64)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = tokens[1:] != tokens[:-1]
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(tokens)))
        many = np.repeat(n >= 2, n)
        return tokens[first], n, owners[first], np.bincount(owners[many], minlength=self.sets)


def _ranges(tokens: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) of the sorted tokens; ranges part the hashes evenly."""
    of = ((tokens >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    cuts = np.searchsorted(of, np.arange(n + 1, dtype=np.uint64))
    return ((r, int(a), int(b)) for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b)


_PACKED = "rng int, run long, kind int, blob binary"


def _emit(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    rng, run, kind, blob = zip(*rows) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(rng, pa.int32()), pa.array(run, pa.int64()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], ["rng", "run", "kind", "blob"])


def _sets(documents: DataFrame, how: Join, n_ranges: int) -> DataFrame:
    """(doc_id, text_key, cls, n, others): each document's set, and how many of its tokens another set has."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, run, heads, seen = TaskContext.get().partitionId() << 24, _Run(), [], {}

        def close() -> pa.RecordBatch:
            tokens, n, owner, others = run.sorted()
            sole = np.where(n >= 2, ALL, owner.astype(np.uint16))
            rows = [(r, name, 0, _pack(tokens[a:b] >> _DROPPED, sole[a:b])) for r, a, b in _ranges(tokens, n_ranges)]
            head = [pa.concat_arrays([h[k] for h in heads]) for k in range(5)]
            sink = pa.BufferOutputStream()
            table = pa.table([*head, pa.array(others[head[4].to_numpy()])], ["doc_id", "text_key", "cls", "n", "place", "others"])
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            rows.append((-1 - name % n_ranges, name, 1, zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())))
            return _emit(rows)

        for batch in batches:
            for piece, data, offsets in words.chunks(batch):
                found, rows, _ = words.shingles(data, offsets)
                at = words.bounds(rows, piece.num_rows)
                keys = [k.tobytes() for k in class_keys(found, at)]
                # Of a class, the run holds one set.
                fresh, place = [], []
                for k, key in enumerate(keys):
                    if key not in seen:
                        seen[key] = run.sets + len(fresh)
                        fresh.append(k)
                    place.append(seen[key])
                new = np.full(piece.num_rows, -1)
                new[fresh] = np.arange(len(fresh))
                mine = new[rows] >= 0
                run.add(found[mine], new[rows][mine], len(fresh))
                heads.append([piece.column("doc_id").cast(pa.int64()), piece.column("text_key"), pa.array(keys, pa.binary()), pa.array(np.diff(at).astype(np.int64)), pa.array(place, pa.int64())])
                if run.size >= how.run or run.sets >= 50_000:
                    yield close()
                    name, run, heads, seen = name + 1, _Run(), [], {}
        if heads:
            yield close()

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf.kind.iat[0] == 1:
            return pdf[["run", "kind", "blob"]]
        got = [_unpack(b) for b in pdf.blob]
        tokens = np.concatenate([t for t, _ in got])
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        same = np.zeros(len(tokens), dtype=bool)
        same[1:] = ordered[1:] == ordered[:-1]
        same[:-1] |= same[1:]
        many = np.empty(len(tokens), dtype=bool)
        many[order] = same
        out, at = [], 0
        for run, (t, owner) in zip(pdf.run, got):
            mine = owner[many[at : at + len(t)] & (owner != ALL)]
            at += len(t)
            if len(mine):
                out.append((run, 0, _squeeze(np.bincount(mine))))
        return pd.DataFrame(out, columns=["run", "kind", "blob"])

    def tell(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(pdf.blob[pdf.kind == 1].iat[0])).read_all()
        place = head["place"].to_numpy()
        total = np.zeros(place.max() + 1, dtype=np.int64)
        for blob in pdf.blob[pdf.kind == 0]:
            more = _unsqueeze(blob)
            total[: len(more)] += more
        others = head["others"].to_numpy() + total[place]
        ids = head["doc_id"].to_pandas(types_mapper=lambda t: pd.Int64Dtype() if t == pa.int64() else None)
        return pd.DataFrame({"doc_id": ids, "text_key": head["text_key"].to_numpy(), "cls": head["cls"].to_pylist(), "n": head["n"].to_numpy(), "others": others})

    packed = documents.mapInArrow(pack, _PACKED)
    counted = packed.groupBy("rng").applyInPandas(count, "run long, kind int, blob binary")
    return counted.groupBy("run").applyInPandas(tell, "doc_id long, text_key long, cls binary, n long, others long")


def _prefixes(documents: DataFrame, cores: DataFrame, how: Join, n_ranges: int) -> DataFrame:
    """(cls, n, size, tokens, a, b, c, lead): one set a class, the shared tokens of its three prefixes, and the rarest of them.

    Sets whose frequency prefix is all their own leave.
    """
    spark = documents.sparkSession
    texts = documents.join(cores.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "cls", "size"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select("cls", "size", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, run, seen, kept = TaskContext.get().partitionId() << 24, _Run(), set(), []

        def close() -> pa.RecordBatch:
            tokens, n, _, _ = run.sorted()
            rows = [(r, name, 0, _pack(tokens[a:b] >> _DROPPED, n[a:b].astype(np.uint16))) for r, a, b in _ranges(tokens, n_ranges)]
            return _emit(rows + [(-1, name, 1, blob) for blob in kept])

        for batch in batches:
            for piece, data, offsets in words.chunks(batch):
                found, rows, _ = words.shingles(data, offsets)
                at = words.bounds(rows, piece.num_rows)
                for k, (key, size) in enumerate(zip(piece.column("cls").to_pylist(), piece.column("size").to_pylist())):
                    if key in seen:
                        continue
                    seen.add(key)
                    mine = found[at[k] : at[k + 1]]
                    run.add(mine, np.zeros(len(mine), dtype=np.int64), 1)
                    kept.append(key + struct.pack("<q", size) + mine.astype("<u8").tobytes())
                if run.size >= how.run or run.sets >= 50_000:
                    yield close()
                    name, run, kept = name + 1, _Run(), []
        if kept:
            yield close()

    packed = written(texts.repartition(partitions(spark), "cls").mapInArrow(pack, _PACKED), "join-runs")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        got = [_unpack(b) for b in pdf.blob]
        tokens, n = np.concatenate([t for t, _ in got]), np.concatenate([c for _, c in got]).astype(np.int64)
        distinct, inverse = np.unique(tokens, return_inverse=True)
        total = np.bincount(inverse, weights=n).astype(np.int64)[inverse]
        out, at = [], 0
        for run, (t, _) in zip(pdf.run, got):
            mine = total[at : at + len(t)]
            at += len(t)
            many = mine >= 2
            if many.any():
                out.append((run, t[many].tobytes(), np.minimum(mine[many], 0xFFFFFFFF).astype("<u4").tobytes()))
        return pd.DataFrame(out, columns=["run", "tokens", "df"])

    counted = packed.where("kind = 0").select("rng", "run", "blob").groupBy("rng").applyInPandas(count, "run long, tokens binary, df binary")

    def finish(sets: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        known = np.concatenate([np.zeros(0, dtype="<u8"), *(np.frombuffer(t, dtype="<u8") for t in told.tokens)])
        df = np.concatenate([np.zeros(0, dtype="<u4"), *(np.frombuffer(t, dtype="<u4") for t in told.df)])
        order = np.argsort(known, kind="stable")
        known, df = known[order], df[order].astype(np.int64)
        out = []
        for blob in sets.blob:
            mine = np.frombuffer(blob[24:], dtype="<u8")
            n, p = len(mine), how.prefix(len(mine))
            short = mine >> _DROPPED
            at = np.minimum(np.searchsorted(known, short), max(len(known) - 1, 0))
            often = np.where(known[at] == short, df[at], 1) if len(known) else np.ones(n, dtype=np.int64)
            by_frequency = np.lexsort((mine, often))[:p]
            a, b, c = (mine[k][often[k] >= 2] for k in (np.arange(p), by_frequency, np.arange(n - p, n)))
            if len(a) and len(b) and len(c):
                out.append((blob[:16], n, struct.unpack("<q", blob[16:24])[0], mine.tobytes(), a.tobytes(), np.sort(b).tobytes(), c.tobytes(), int(b[:1].view("<i8")[0])))
        return pd.DataFrame(out, columns=["cls", "n", "size", "tokens", "a", "b", "c", "lead"])

    sets = packed.where("kind = 1").select("run", "blob")
    return sets.groupBy("run").cogroup(counted.groupBy("run")).applyInPandas(finish, "cls binary, n long, size long, tokens binary, a binary, b binary, c binary, lead long")


def _posted(sets: DataFrame, orders: str, *keep: str) -> DataFrame:
    """(order, token, *keep): a row for each token in the named prefixes of each set."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order in orders:
                tokens = [np.frombuffer(b, dtype="<i8") for b in batch.column(order).to_pylist()]
                owner = pa.array(np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]))
                token = np.concatenate([np.zeros(0, dtype="<i8"), *tokens])
                yield pa.RecordBatch.from_arrays([pa.array([order] * len(token), pa.string()), pa.array(token), *(batch.column(k).take(owner) for k in keep)], ["order", "token", *keep])

    kinds = dict(sets.dtypes)
    return sets.select(*keep, *orders).mapInArrow(each, ", ".join(["order string, token long", *(f"{k} {kinds[k]}" for k in keep)]))


def _chained(prefixes: DataFrame) -> DataFrame:
    """(cls, root): sets that share a token of the frequency prefix, chained."""
    posted = _posted(prefixes, "b", "cls")
    low = posted.groupBy("token").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high").select("token", "low")
    edges = posted.join(low, "token").where("cls <> low").select(F.col("cls").alias("a"), F.col("low").alias("b")).distinct()
    return components(edges).select(F.col("node").alias("cls"), "root")


def _blocks(prefixes: DataFrame, chained: DataFrame, how: Join) -> DataFrame:
    """(cls, block, length, split): blocks are of bounded size; a component of a block's size is one, others are split by length class and rarest token.

    Lengths of similar sets are in the same class or in neighbouring ones.
    """
    wide = float(np.log(how.bottom / how.top)) * (1 + 1e-9)
    seats = prefixes.select("cls", "n", "lead").join(chained, "cls")
    need = F.ceil(F.greatest(F.count("*") / how.block_sets, F.sum("n") / how.block_tokens)).cast("int")
    # Tables of their own, so that a large component can be split in the joins.
    sizes = written(seats.groupBy("root").agg(need.alias("need")), "join-sizes")
    split = F.col("need") > 1
    seats = seats.join(sizes, "root").select(
        "cls", "n", "root", split.alias("split"), F.when(split, F.floor(F.log("n") / wide)).otherwise(0).cast("int").alias("length"), F.when(split, F.pmod(F.xxhash64("lead"), F.col("need"))).otherwise(0).cast("int").alias("bucket")
    )
    key = ["root", "length", "bucket"]
    parts = written(seats.groupBy(*key).agg(need.alias("parts")), "join-parts")
    seats = seats.join(parts, key)
    return seats.select("cls", F.xxhash64(*key, F.pmod(F.xxhash64("cls"), F.col("parts"))).alias("block"), "length", "split")


def _meeting(prefixes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(i, j): pairs of different blocks that have a prefix token in common under each of the three orders, and neighbouring lengths."""
    seat = F.struct("length", "block")
    posted = _posted(prefixes.join(blocks.where("split"), "cls"), "abc", "length", "block")
    lists = posted.groupBy("order", "token").agg(F.sort_array(F.collect_set(seat)).alias("seats")).where("size(seats) > 1")
    # Tokens of the same blocks tell the same.
    one = lists.select("order", "seats").distinct().select("order", "seats", F.explode("seats").alias("x"))
    pairs = one.select("order", "x", F.explode("seats").alias("y")).where("x.block < y.block and abs(x.length - y.length) <= 1").select("order", F.col("x.block").alias("i"), F.col("y.block").alias("j"))
    order = F.when(F.col("order") == "a", 1).when(F.col("order") == "b", 2).otherwise(4)
    return pairs.groupBy("i", "j").agg(F.bit_or(order).alias("orders")).where("orders = 7").select("i", "j")


def _verified(prefixes: DataFrame, chained: DataFrame, how: Join) -> DataFrame:
    """(cls, links, low): of each set and pair of blocks, the documents linked, and a set that it is connected with."""
    blocks = written(_blocks(prefixes, chained, how), "join-blocks")
    met = written(_meeting(prefixes, blocks), "join-units")
    own = blocks.select("cls", "block", F.col("block").alias("i"), F.col("block").alias("j"))
    units = met.select(F.col("i").alias("block"), "i", "j").unionByName(met.select(F.col("j").alias("block"), "i", "j"))
    seats = own.unionByName(blocks.where("split").select("cls", "block").join(units, "block"))
    spread = prefixes.drop("lead").join(seats, "cls")

    def verify(rows: pa.Table) -> pa.RecordBatch | None:
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        block = rows["block"].to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        n, size = rows["n"].to_numpy(), rows["size"].to_numpy()
        if not len(left) or not len(right) or len(n) < 2:
            return None
        small, large = np.minimum.outer(n[left], n[right]), np.maximum.outer(n[left], n[right])
        pairs = how.bottom * small >= how.top * large
        if i == j:
            pairs &= left[:, None] < right[None, :]
        read = lambda name, which: [np.frombuffer(x, dtype="<u8") for x in (rows[name][int(k)].as_py() for k in which)]
        for name in ("b", "a", "c"):
            if not pairs.any():
                return None
            mine, theirs = pairs.any(axis=1), pairs.any(axis=0)
            left, right, pairs = left[mine], right[theirs], pairs[mine][:, theirs]
            pairs &= shared(read(name, left), read(name, right)) > 0
        if not pairs.any():
            return None
        mine, theirs = pairs.any(axis=1), pairs.any(axis=0)
        left, right, pairs = left[mine], right[theirs], pairs[mine][:, theirs]
        both = shared(read("tokens", left), read("tokens", right))
        pairs &= how.bottom * both >= how.top * (np.add.outer(n[left], n[right]) - both)
        a, b = np.nonzero(pairs)
        if not len(a):
            return None
        a, b = left[a], right[b]
        links = np.bincount(a, weights=size[b], minlength=len(n)) + np.bincount(b, weights=size[a], minlength=len(n))
        some = np.flatnonzero(links)
        low = roots(len(n), a, b)
        keys = rows["cls"].combine_chunks()
        keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
        return pa.RecordBatch.from_arrays([keys.take(pa.array(some)), pa.array(links[some].astype(np.int64)), keys.take(pa.array(low[some]))], ["cls", "links", "low"])

    return each_group(spread, ["i", "j"], verify, "cls binary, links long, low binary")


def join(documents: DataFrame, how: Join = Join(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_key, root, n_shingles, n_links, component_id) of each document; root names its group."""
    docs = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("text_key"))
    docs = settled(docs, "join-texts")  # runs are named by task, and must be the same in a repeated one
    n_ranges = how.ranged(docs)
    sets = written(_sets(docs, how, n_ranges), "join-sets")
    classes = sets.where("n > 0").groupBy("cls").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"), F.count("*").alias("size"), F.first("n").alias("n"), F.max("others").alias("others"))
    classes = written(classes.select("cls", "first.doc_id", "first.text_key", "size", "n", "others"), "join-classes")
    own = F.col("n") - F.col("others")
    cores = classes.where(own < F.expr(f"n - ({how.top} * n + {how.bottom - 1}) div {how.bottom} + 1"))
    prefixes = written(_prefixes(docs, cores, how, n_ranges), "join-prefixes")
    links = written(_verified(prefixes, _chained(prefixes), how), "join-links")
    found = components(links.where("cls <> low").select(F.col("cls").alias("a"), F.col("low").alias("b")))
    counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
    linked = found.join(classes.select(F.col("cls").alias("node"), "doc_id"), "node")
    least = written(linked.groupBy("root").agg(F.min("doc_id").alias("least")), "join-roots")
    linked = linked.join(least, "root").select(F.col("node").alias("cls"), "root", "least")
    told = classes.select("cls", "doc_id", "size").join(counts, "cls", "left").join(linked, "cls", "left")
    told = told.select("cls", F.coalesce("root", "cls").alias("root"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("least", "doc_id").alias("component_id"))
    # A table of its own, so that a class with many documents can be split in the join.
    told = written(told, "join-told")
    some = sets.where("n > 0").join(told, "cls").select("doc_id", "text_key", "root", F.col("n").alias("n_shingles"), "n_links", "component_id")
    none = sets.where("n = 0").select("doc_id", "text_key", F.col("cls").alias("root"), F.col("n").alias("n_shingles"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


def one_of_each(documents: DataFrame, how: Join = Join(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all their columns, with one row of each group of linked ones: its smallest doc_id."""
    joined = written(join(documents, how, id_column, text_column), "join-result")
    some = joined.where("n_shingles > 0")
    first = some.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("f")).select(F.col("f.doc_id").alias("_id"), F.col("f.text_key").alias("_key"))
    # Rows alike in id and text: one of them stays, so those few are looked at by themselves.
    alike = some.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_i"), F.col("text_key").alias("_k"))
    first = first.join(alike, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")), "left").select("_id", "_key", F.col("_k").isNotNull().alias("_again"))
    none = joined.where("n_shingles = 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.lit(False).alias("_again")).distinct()
    keep = written(first.unionByName(none), "join-kept")
    columns = documents.columns
    whole = documents.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_whole"), F.col(id_column).alias("_doc"), F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("_hash"))
    match = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key"))
    single = whole.join(keep.where("not _again"), match, "left_semi").select("_whole")
    again = whole.join(keep.where("_again"), match, "left_semi").dropDuplicates(["_doc", "_hash"]).select("_whole")
    return single.unionByName(again).select(*(F.col("_whole")[c].alias(c) for c in columns))
