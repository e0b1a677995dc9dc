"""Personal data: patterns, and terms that the corpus shows to disclose an entity.

An entity is a value that a pattern finds (an address, a number). With N
documents, of which d(e) hold entity e, d(t) hold term t, and c(e,t) hold t
within `near` words of e, the share of t's documents with e beside it is taken
as s = (c + 1) / (d(t) + 2): few documents tell less than many, but an entity or
a term that is in one document only is judged too. The information that t gives about e is
PMI = log2(s N / d(e)), and e's own is IC = log2(N / d(e)). A term discloses e
when PMI >= alpha * IC, that is when s >= p(e)^(1-alpha). So in a large corpus a rare
name beside a rare address is told, and a common word isn't. Pairs seen in fewer than `support` different
texts are left; 1 leaves none. Disclosing terms beside e become spans, and
`sanitise` generalises them to a class label or removes them, `sanitised` for all documents.

A term is a whole run of letters, of any length, whatever lies between it and
the entity. A run that goes on into the entity, as unspaced text does, is told
as the whole run; its span is the part outside.

Counts cover every document. Nulls and empty texts have no spans. Each input
row gives one row, repeated rows alike, and counts as a document; a null
doc_id stays null. Ids are integers.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywatch.llm import words
from quaywatch.llm.tables import written

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match can begin only where a run of digits does; that keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TERM = re.compile(r"[A-Za-z\x80-\U0010ffff]+")
#: Bits of the filter that spares most words the exact join; its size is fixed, half a megabyte.
FILTER_BITS = 22
#: Counts that a task holds before it sums them by term.
_HELD = 2_000_000


@dataclass(frozen=True)
class Disclosure:
    """near: words on either side; alpha: share of an entity's information; support: different texts; letters: shortest term, 1 for all."""

    near: int = 10
    alpha: float = 0.9
    support: int = 1
    letters: int = 1


def luhn(digits: str) -> bool:
    twice = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(int(c) for c in digits[::-2]) + sum(x - 9 if x > 9 else x for x in twice)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long runs stay linear."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        else:
            end = max(end, at + 1)
        at = text.find("@", at + 1)
    return out


def base(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := re.sub(r"[^0-9]", "", m[0])) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return out


def entity(kind: str, value: str) -> str:
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else re.sub('[^0-9]', '', value)}"


def beside(text: str, found: list[tuple[str, int, int]], how: Disclosure) -> list[tuple[str, tuple[int, int], int, int]]:
    """(entity, run, start, end) of the terms within `near` words of an entity and in no base span; a run is a whole word."""
    out, starts, ends = [], [], []
    for m in TERM.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
    # The base spans' union, in order.
    first, last = [], []
    for s, e in sorted((s, e) for _, s, e in found):
        if last and s <= last[-1]:
            last[-1] = max(last[-1], e)
        else:
            first.append(s)
            last.append(e)
    for kind, a, b in found:
        # Runs that begin before the entity, and runs that end after it.
        i, j = bisect_left(starts, a), bisect_right(ends, b)
        name = entity(kind, text[a:b])
        for k in [*range(max(0, i - how.near), i), *range(j, min(len(starts), j + how.near))]:
            s, e = (starts[k], min(ends[k], a)) if k < i else (max(starts[k], b), ends[k])
            at = bisect_left(first, e)
            if ends[k] - starts[k] >= how.letters and not (at and last[at - 1] > s):
                out.append((name, (starts[k], ends[k]), s, e))
    return out


def _term_hashes(terms: list[str]) -> np.ndarray:
    data, offsets = words.buffers(pa.array(terms, pa.large_string()))
    hashes, rows = words.word_hashes(data, offsets, words.NOT_LETTER)
    return hashes[words.bounds(rows, len(terms))[:-1]].view(np.int64)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_FOUND = "row long, doc_id long, text_key long, text_check long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, near array<struct<entity:string,term:long,start:long,end:long>>"


def _scanned(documents: DataFrame, how: Disclosure) -> DataFrame:
    near = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece, _, _ in words.chunks(batch):
                cols: list[list] = [[] for _ in range(8)]
                for text in piece.column("text").to_pylist():
                    text = text or ""
                    found = base(text)
                    kinds, joined = [k for k, _, _ in found], _joined(found)
                    terms = beside(text, found, how) if found else []
                    runs = sorted({r for _, r, _, _ in terms})  # a long one is hashed once
                    hashes = dict(zip(runs, _term_hashes([text[a:b] for a, b in runs]).tolist())) if terms else {}
                    for col, x in zip(cols, (row, *(kinds.count(k) for k in KINDS[:4]), hashlib.sha256(joined.encode()).hexdigest(), joined, [{"entity": e, "term": hashes[r], "start": a, "end": b} for e, r, a, b in terms])):
                        col.append(x)
                    row += 1
                ints = [pa.array(c, pa.int64()) for c in cols[:5]]
                yield pa.RecordBatch.from_arrays(
                    [ints[0], *(piece.column(c).cast(pa.int64()) for c in ("doc_id", "text_key", "text_check")), *ints[1:], pa.array(cols[5], pa.string()), pa.array(cols[6], pa.string()), pa.array(cols[7], near)],
                    ["row", "doc_id", "text_key", "text_check", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "near"],
                )

    return documents.mapInArrow(each, _FOUND)


def _document_counts(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, documents) over the whole corpus, for the given terms."""
    shift = 64 - FILTER_BITS
    bit = F.shiftrightunsigned("term", shift) + 1
    maps = terms.groupBy(F.bitmap_bucket_number(bit).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    held = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for r in maps.collect():  # at most 2**FILTER_BITS / 32768 rows of 4 KB
        held[(r.k - 1) * 4096 : r.k * 4096] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    sent = documents.sparkSession.sparkContext.broadcast(held.tobytes())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(sent.value, dtype=np.uint8), bitorder="little").astype(bool)
        held, counts, size = [], [], 0

        def summed() -> pa.RecordBatch:
            term, at = np.unique(np.concatenate(held), return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(np.bincount(at, weights=np.concatenate(counts)).astype(np.int64))], ["term", "n"])

        for batch in batches:
            for _, data, offsets in words.chunks(batch):
                hashes, rows = words.word_hashes(data, offsets, words.NOT_LETTER)
                keep = wanted[(hashes >> np.uint64(shift)).astype(np.int64)]
                hashes, rows = hashes[keep], rows[keep]
                order = np.lexsort((rows, hashes))
                hashes, rows = hashes[order], rows[order]
                if len(hashes):
                    new = np.ones(len(hashes), dtype=bool)
                    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
                    term, n = np.unique(hashes[new], return_counts=True)
                    held.append(term)
                    counts.append(n)
                    size += len(term)
                    if size >= _HELD:  # a row for each term and so many counts, not for each chunk of text
                        yield summed()
                        held, counts, size = [], [], 0
        if held:
            yield summed()

    counted = documents.select("text").mapInArrow(each, "term long, n long").groupBy("term").agg(F.sum("n").alias("d_term"))
    return counted.join(terms, "term")


def _keys(text: Column) -> list[Column]:
    """Two hashes of a text, which name it."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("text_key"), F.xxhash64(F.lit(1), text).alias("text_check")]


def find(documents: DataFrame, how: Disclosure = Disclosure(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, all spans, and the number of disclosing terms."""
    return _found(documents, how, id_column, text_column).drop("text_key", "text_check")


def _found(documents: DataFrame, how: Disclosure, id_column: str, text_column: str) -> DataFrame:
    docs = documents.select(documents[id_column].cast("long").alias("doc_id"), documents[text_column].alias("text"), *_keys(documents[text_column]))
    found = written(_scanned(docs, how), "pii")
    seen = found.where(F.size("near") > 0).select("row", "text_key", F.explode("near").alias("x")).select("row", "text_key", "x.*")
    seen = seen.select("row", "text_key", "entity", "term", "start", "end")
    by_row = seen.select("entity", "term", "row", "text_key").distinct()
    # Rows of one text are counted first, so that texts of a pair are counted with what is left.
    by_text = by_row.groupBy("entity", "term", "text_key").agg(F.count("*").alias("n"))
    pairs = by_text.groupBy("entity", "term").agg(F.sum("n").alias("c"), F.count("*").alias("texts")).where(F.col("texts") >= how.support)
    pairs = written(pairs.select("entity", "term", "c"), "pii-pairs")
    entities = written(seen.select("entity", "row").distinct().groupBy("entity").agg(F.count("row").alias("d_entity")), "pii-entities")
    d_terms = _document_counts(docs, pairs.select("term").distinct())
    n = F.lit(float(found.count()))
    ic = F.log2(n / F.col("d_entity"))
    pmi = F.log2((F.col("c") + 1) / (F.col("d_term") + 2) * n / F.col("d_entity"))
    told = pairs.join(d_terms, "term").join(entities, "entity").where((ic > 0) & (pmi >= how.alpha * ic)).select("entity", "term")
    spans = (
        seen.join(told, ["entity", "term"]).select("row", "start", "end").distinct().groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
        .select("row", F.size("s").cast("long").alias("n_term"), F.array_join(F.transform("s", lambda x: F.concat(F.lit("term:"), x["start"], F.lit(":"), x["end"])), ",").alias("more"))
    )
    return found.join(spans, "row", "left").select(
        "doc_id", "text_key", "text_check", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "more").alias("spans"),
        F.coalesce("n_term", F.lit(0)).alias("n_term"),
    )


def sanitise(text: str, spans: str, remove_terms: bool = False) -> str:
    """The text with each span generalised to its kind in brackets; terms can be removed instead."""
    parts = sorted(((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s)), key=lambda p: (p[0], -p[1]))
    out, at = [], 0
    for a, b, kind in parts:
        if a < at:
            at = max(at, b)
            continue
        out += [text[at:a], "" if remove_terms and kind == "term" else f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def sanitised(documents: DataFrame, how: Disclosure = Disclosure(), remove_terms: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, all their columns, with each text as `sanitise` leaves it; a null text stays null."""
    found = _found(documents, how, id_column, text_column).where("spans <> ''")
    # A text's spans depend on the text and the corpus alone. A table of its own, so that a text of many documents can be split in the join.
    spans = written(found.select("text_key", "text_check", "spans").distinct(), "pii-texts")
    names = documents.columns
    one, two = _keys(F.col(f"`{text_column}`"))
    whole = documents.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_whole"), F.col(f"`{text_column}`").alias("_text"), one, two)
    joined = whole.join(spans, ["text_key", "text_check"], "left").select("_whole", "_text", "spans")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [sanitise(t, s, remove_terms) if s else t for t, s in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("_whole"), pa.array(texts, pa.string())], ["_whole", "_text"])

    out = joined.mapInArrow(each, joined.select("_whole", "_text").schema)
    return out.select(*(F.col("_text").alias(c) if c == text_column else F.col("_whole")[c].alias(c) for c in names))
