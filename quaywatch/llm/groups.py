"""Groups of rows that a task handles one after another, and links within a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quaywatch.llm.tables import partitions


def each_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str, n: int | None = None) -> DataFrame:
    """`work` on the rows of each key. Groups must be of bounded size; a task holds one, and one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                c = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                mine = tuple(c[a].as_py() for c in columns)
                if held and mine != last:
                    out = work(pa.Table.from_batches(held))
                    if out is not None:
                        yield out
                    held = []
                last = mine
                held.append(batch.slice(a, b - a))
        if held:
            out = work(pa.Table.from_batches(held))
            if out is not None:
                yield out

    return df.repartition(n or partitions(df.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n nodes, the smallest node that is reachable over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        was = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == was).all():
            return label


def shared(left: list[np.ndarray], right: list[np.ndarray], wide: int = 8192) -> np.ndarray:
    """How many elements each set on the left has in common with each on the right."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    both = [*left, *right]
    sizes = [len(x) for x in both]
    if not sum(sizes[: len(left)]) or not sum(sizes[len(left) :]):
        return out
    values = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    code = np.cumsum(new) - 1
    many = np.bincount(code)[code] >= 2
    owner, code = owner[many], code[many]
    if not len(code):
        return out
    fresh = np.ones(len(code), dtype=bool)
    fresh[1:] = code[1:] != code[:-1]
    code = np.cumsum(fresh) - 1
    cuts = np.searchsorted(code, np.arange(0, code[-1] + 1 + wide, wide))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a == b:
            continue
        flags = np.zeros((len(both), int(min(wide, code[-1] + 1 - k * wide))), dtype=np.float32)
        flags[owner[a:b], code[a:b] - k * wide] = 1
        out += np.rint(flags[: len(left)] @ flags[len(left) :].T).astype(np.int64)
    return out
