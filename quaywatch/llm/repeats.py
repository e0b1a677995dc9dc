"""Substring dedup by line hashing: later occurrences of repeated passages, with their offsets.

Units are logical lines, so that a passage is found wherever physical lines
break it: a newline is a blank like any other. A word begins a line where its
key, the lower half of its MD5, is less than that of the `around` words before
it and not more than that of the `around` words after it (A-Z lowered; fewer
words at a text's ends). So lines have over `around` words, 2 * around + 1 on
average, and equal texts break alike but for `around` words at their ends. A
line of more than `most` words is cut after every `most`. by="paragraph" takes
physical paragraphs, parted by blank lines, instead.

A line's words, joined by single blanks, are hashed to 128 bits. Digests are
grouped globally; the earliest occurrence by (doc_id, text hash, line number)
is kept and later ones are repeats. Consecutive repeats of a document form a
passage. It is extended word by word, up to `most + around` words on either side, as far as the
words before its first line and after its last one equal those beside their kept occurrences.
Passages of `min_words` words or more are removed; so short lines
that recur by themselves stay, in however many documents. Passages of a
document that touch after extension stay rows of their own.

A null text has no units. A null doc_id ranks before any other. Rows alike in
doc_id and text are one document: they get the same decisions, once. Texts are
read whole at any length; offsets are code points of the original text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaywatch.llm import words
from quaywatch.llm.tables import written


@dataclass(frozen=True)
class Lines:
    """min_words: least words of a passage; around: words on either side that a line's first word is less than; most: words of a line; by: line or paragraph."""

    min_words: int = 50
    around: int = 4
    most: int = 32
    by: str = "line"

    @property
    def reach(self) -> int:
        return self.most + self.around


_SALT = np.uint64(0x452821E638D01377)
_ID = ["doc_id", "text_key"]


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The lower half of each word's MD5; a word that occurs often is hashed once."""
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    text, md5 = data.tobytes().lower(), hashlib.md5
    digests = b"".join([md5(text[a:b]).digest()[8:] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
    return np.frombuffer(digests, dtype="<u8")[back]


def _begins(keys: np.ndarray, rows: np.ndarray, around: int) -> np.ndarray:
    """Whether a word's key is less than those before it and not more than those after it, in its text."""
    out = np.ones(len(keys), dtype=bool)
    for j in range(1, min(around, len(keys) - 1) + 1):
        same = rows[j:] == rows[:-j]
        out[j:] &= ~same | (keys[j:] < keys[:-j])
        out[:-j] &= ~same | (keys[:-j] <= keys[j:])
    return out


def lines(data: np.ndarray, offsets: np.ndarray, how: Lines) -> tuple[np.ndarray, ...]:
    """Of each line of a chunk of texts: its text's row, its first word, its words, and two digests; and of all words their rows, hashes, starts and ends."""
    starts, ends, rows = words.spans(data, offsets)
    hashes, _ = words.word_hashes(data, offsets)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, hashes, hashes, rows, hashes, starts, ends
    new = np.ones(len(starts), dtype=bool)
    new[1:] = rows[1:] != rows[:-1]
    if how.by == "paragraph":
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        new[1:] |= breaks[starts[1:]] - breaks[ends[:-1]] >= 2
    else:
        new |= _begins(_keys(data, starts, ends, hashes), rows, how.around)
        first = np.flatnonzero(new)
        place = np.arange(len(new)) - np.repeat(first, np.diff(np.append(first, len(new))))
        new |= place % how.most == 0
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(new)))
    low, high = (words.sequence_hashes(h, first, n) for h in (hashes, words.mix(hashes ^ _SALT)))
    return rows[first], first, n, low, high, rows, hashes, starts, ends


def _hashed(documents: DataFrame, how: Lines) -> DataFrame:
    """(doc_id, text_key, line, word, n_words, before, after, low, high) of each line; word: its first; before, after: words of its neighbours."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in words.chunks(batch):
                row, first, n, low, high, of, _, _, _ = lines(data, offsets, how)
                at, first_line = words.bounds(of, piece.num_rows), words.bounds(row, piece.num_rows)
                before, after = np.zeros_like(n), np.zeros_like(n)
                same = row[1:] == row[:-1]
                before[1:], after[:-1] = np.where(same, n[:-1], 0), np.where(same, n[1:], 0)
                own = piece.select(_ID).take(pa.array(row))
                cols = [np.arange(len(row)) - first_line[row], first - at[row], n, before, after]
                yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(c.astype(np.int32)) for c in cols), pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], [*_ID, "line", "word", "n_words", "before", "after", "low", "high"])

    return documents.mapInArrow(each, "doc_id long, text_key long, line int, word int, n_words int, before int, after int, low long, high long")


def _beside(documents: DataFrame, wanted: DataFrame, how: Lines) -> DataFrame:
    """(doc_id, text_key, place, hashes, ends): for each wanted place, the words beside it, outwards, and where a passage ends with each of them taken in.

    A place is 2w for the words before word w, 2w + 1 for word w and those after it.
    ends[k] is the offset with k words taken in.
    """
    places = wanted.groupBy(*_ID).agg(F.collect_set("place").alias("places")).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "places")
    texts = documents.join(places, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select(*_ID, "text", "places")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in words.chunks(batch):
                starts, ends, rows = words.spans(data, offsets)
                hashes, _ = words.word_hashes(data, offsets)
                hashes = hashes.view(np.int64)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
                at = words.bounds(rows, piece.num_rows)
                out: list[list] = [[], [], [], []]
                for k, places in enumerate(piece.column("places").to_pylist()):
                    a, b, zero = at[k], at[k + 1], points[offsets[k]]
                    for place in places:
                        w = a + place // 2
                        if place % 2:
                            to = min(b, w + how.reach)
                            found, edge = hashes[w:to], points[ends[w - 1 : to]]
                        else:
                            to = max(a, w - how.reach)
                            found, edge = hashes[to:w][::-1], points[starts[to : w + 1]][::-1]
                        for col, x in zip(out, (k, place, found.tolist(), (edge - zero).tolist())):
                            col.append(x)
                own = piece.select(_ID).take(pa.array(out[0], pa.int64()))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(out[1], pa.int64()), pa.array(out[2], longs), pa.array(out[3], longs)], [*_ID, "place", "hashes", "ends"])

    return texts.mapInArrow(each, "doc_id long, text_key long, place long, hashes array<long>, ends array<long>").dropDuplicates([*_ID, "place"])


def _alike(a: str, b: str) -> Column:
    """How many of the first elements of two arrays are equal."""
    n = f"least(size({a}), size({b}))"
    return F.expr(f"coalesce(nullif(array_position(transform(slice({a}, 1, {n}), (x, i) -> x = {b}[i]), false), 0) - 1, {n})")


def passages(documents: DataFrame, how: Lines = Lines(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_key, start, end, n_lines, n_words, kept_doc_id) of each passage to remove; n_lines: whole lines in it; kept_doc_id: where its first line stays."""
    docs = documents.select(documents[id_column].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(documents[text_column], F.lit(""))).alias("text_key"), documents[text_column].alias("text"))
    found = written(_hashed(docs, how), "lines")
    # Grouped by digest with map-side minima, so that a digest of a third of all rows costs one row a task.
    place = F.struct(*_ID, "line")
    first = found.groupBy("low", "high").agg(F.min(F.struct(*_ID, "line", "word")).alias("kept"), F.max(place).alias("top"))
    first = first.where(~F.struct("kept.doc_id", "kept.text_key", "kept.line").eqNullSafe(F.col("top"))).select("low", "high", "kept")
    # A table of its own, so that a digest with many lines can be split in the join.
    first = written(first, "line-firsts")
    later = found.join(first, ["low", "high"]).where(~place.eqNullSafe(F.struct("kept.doc_id", "kept.text_key", "kept.line")))
    # A document's repeats by line number: neighbours share line - rank.
    one = later.dropDuplicates([*_ID, "line"])
    run = one.withColumn("run", F.col("line") - F.row_number().over(Window.partitionBy(*_ID).orderBy("line")))
    run = run.groupBy(*_ID, "run").agg(
        F.min(F.struct("line", "word", "before", "kept")).alias("a"), F.max(F.struct("line", F.expr("word + n_words").alias("word"), "after", F.expr("kept.word + n_words").alias("to"), "kept")).alias("z"), F.count("*").alias("n_lines"), F.sum("n_words").alias("n_words")
    )
    # A passage reaches less than `around` words beyond the line before its first and after its last: else those lines would be repeats.
    run = run.where(F.expr(f"n_words + a.before + z.after + {2 * how.around}") >= how.min_words)
    edges = written(
        run.select(
            *_ID, "n_lines", "n_words", (F.col("a.word") * F.lit(2)).cast("long").alias("p1"), (F.col("z.word") * 2 + 1).cast("long").alias("p2"), F.col("a.kept.doc_id").alias("kept_doc_id"), F.col("a.kept.text_key").alias("k1"),
            (F.col("a.kept.word") * 2).cast("long").alias("q1"), F.col("z.kept.doc_id").alias("last_doc_id"), F.col("z.kept.text_key").alias("k2"), (F.col("z.to") * 2 + 1).cast("long").alias("q2"),
        ),
        "line-edges",
    )
    ways = {"x1": ("doc_id", "text_key", "p1"), "y1": ("kept_doc_id", "k1", "q1"), "x2": ("doc_id", "text_key", "p2"), "y2": ("last_doc_id", "k2", "q2")}
    wanted = None
    for names in ways.values():
        one = edges.select(*(F.col(n).alias(to) for n, to in zip(names, (*_ID, "place"))))
        wanted = one if wanted is None else wanted.unionByName(one)
    beside = written(_beside(docs, wanted.distinct(), how), "line-edges-beside")
    for side, names in ways.items():
        there = beside.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("place").alias("_place"), F.col("hashes").alias(f"{side}h"), F.col("ends").alias(f"{side}e"))
        there = there.drop(f"{side}e") if side[0] == "y" else there
        edges = edges.join(there, F.col(names[0]).eqNullSafe(F.col("_id")) & (F.col(names[1]) == F.col("_key")) & (F.col(names[2]) == F.col("_place"))).drop("_id", "_key", "_place")
    edges = edges.withColumns({"l": _alike("x1h", "y1h"), "r": _alike("x2h", "y2h")})
    return edges.select(
        *_ID, F.expr("x1e[int(l)]").alias("start"), F.expr("x2e[int(r)]").alias("end"), "n_lines", (F.col("n_words") + F.col("l") + F.col("r")).cast("long").alias("n_words"), "kept_doc_id"
    ).where(F.col("n_words") >= how.min_words)


def clean(documents: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all their columns, without the passages in `found`."""
    cuts = found.groupBy(*_ID).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    d, c = documents.alias("d"), cuts.alias("c")
    match = F.col(f"d.{id_column}").eqNullSafe(F.col("c.doc_id")) & (F.xxhash64(F.coalesce(F.col(f"d.{text_column}"), F.lit(""))) == F.col("c.text_key"))
    columns = documents.columns
    joined = d.join(c, match, "left").select(F.struct(*(F.col(f"d.`{x}`") for x in columns)).alias("_row"), F.col(f"d.{text_column}").alias("_text"), F.col("c.cuts").alias("_cuts"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_cuts").to_pylist()):
                if spans:
                    out, at = [], 0
                    for s in spans:
                        out.append(text[at : max(at, s["start"])])
                        at = max(at, s["end"])
                    text = "".join([*out, text[at:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())], ["_row", "_text"])

    schema = joined.select("_row", "_text").schema
    return joined.mapInArrow(each, schema).select(*(F.col("_text").alias(x) if x == text_column else F.col("_row")[x].alias(x) for x in columns))
