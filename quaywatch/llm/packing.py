"""Token ids packed into rows of fixed length by best fit decreasing.

A text's ids, and an end-of-text id, are cut losslessly into pieces of at most
`length`. Pieces of a group are placed largest first, each into the fullest row
that still has room: a segment tree over free space gives the smallest free
space that is enough in log2(length) steps. A packed row carries its ids, padded
and little-endian; the cumulative segment lengths, from 0; and the positions,
which restart at 0 with each segment.

A group is the documents that a task reads, up to `group` tokens, so packing
needs no shuffle and bounded memory, and a lost task is packed again alike.

Null texts are empty texts: just the end-of-text id. Repeated rows are packed
each; a null doc_id stays null. Nothing is dropped or truncated.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaywatch.llm import words

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Packing:
    """vocabulary: a file of ranks, on each executor; end: an id that it leaves free; group: tokens packed together."""

    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    length: int = 2048
    end: int = 50256
    pad: int = 50256
    group: int = 2_000_000


def encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Rooms:
    """Rows by free space, with a segment tree that finds the least space that is enough."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.some = [False] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at and not self.some[at]:
            self.some[at] = True
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row with `need` or more; it leaves the tree."""
        at = need + self.size
        if not self.some[at]:
            while at & 1 or not self.some[at + 1]:
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            while at < self.size:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        room = at - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self.some[at] = False
            at >>= 1
            while at and not (self.some[2 * at] or self.some[2 * at + 1]):
                self.some[at] = False
                at >>= 1
        return room, row


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows, each a list of the pieces in it, in the order they were placed."""
    rooms, rows = Rooms(length), []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        found = rooms.take(sizes[k])
        room, row = found or (length, len(rows))
        if not found:
            rows.append([])
        rows[row].append(k)
        if room > sizes[k]:
            rooms.add(room - sizes[k], row)
    return rows


SCHEMA = "pack string, row long, n_tokens long, doc_ids array<long>, pieces array<long>, cumulative array<long>, ids binary, positions binary"
_TYPES = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())


def _packed(pack: str, docs: list[tuple[int | None, np.ndarray]], how: Packing) -> pa.RecordBatch:
    pieces = [(d, k, ids[at : at + how.length]) for d, ids in docs for k, at in enumerate(range(0, len(ids), how.length))]
    cols: list[list] = [[] for _ in range(8)]
    for row, held in enumerate(best_fit([len(p[2]) for p in pieces], how.length)):
        sizes = [len(pieces[k][2]) for k in held]
        ids, positions = np.full(how.length, how.pad, dtype="<i4"), np.zeros(how.length, dtype="<i4")
        ends = np.cumsum(sizes)
        ids[: ends[-1]] = np.concatenate([pieces[k][2] for k in held])
        positions[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        for col, x in zip(cols, (pack, row, int(ends[-1]), [pieces[k][0] for k in held], [pieces[k][1] for k in held], [0, *ends.tolist()], ids.tobytes(), positions.tobytes())):
            col.append(x)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], ["pack", "row", "n_tokens", "doc_ids", "pieces", "cumulative", "ids", "positions"])


def pack(documents: DataFrame, how: Packing = Packing(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each packed row: (pack, row) name it, `pieces` numbers a document's pieces from 0."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, n = encoder(how.vocabulary), TaskContext.get().partitionId(), 0
        held, size = [], 0
        for batch in batches:
            for piece, _, _ in words.chunks(batch):
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    held.append((doc_id, np.array([*own.encode_ordinary(text or ""), how.end], dtype="<i4")))
                    size += len(held[-1][1])
                    if size >= how.group:
                        yield _packed(f"{task}-{n}", held, how)
                        held, size, n = [], 0, n + 1
        if held:
            yield _packed(f"{task}-{n}", held, how)

    return documents.select(documents[id_column].alias("doc_id"), documents[text_column].alias("text")).mapInArrow(each, SCHEMA)


def write_packed(documents: DataFrame, path: str, how: Packing = Packing(), **columns: str) -> None:
    """Packed rows as Parquet; `matrix` reads a pack's rows as one matrix."""
    pack(documents, how, **columns).write.option("compression", "zstd").parquet(path)


def matrix(rows: list, length: int, field: str = "ids") -> np.ndarray:
    """The packed rows of one pack, in row order, as a matrix of ids or positions."""
    return np.stack([np.frombuffer(bytes(r[field]), dtype="<i4") for r in sorted(rows, key=lambda r: r["row"])]).reshape(-1, length)


def digests(packed: DataFrame) -> DataFrame:
    """The packed rows with digests in place of the binary columns."""
    return packed.select("pack", "row", "n_tokens", "doc_ids", "pieces", "cumulative", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"))
