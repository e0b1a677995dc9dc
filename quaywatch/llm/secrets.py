"""Secret scans: key patterns, and windows of high Shannon entropy per character class.

Candidate strings are the maximal runs of a character class. A window slides
over each; one character enters and one leaves, and the counts and the sum of
c*log2(c) are kept up to date, so a step costs the same at any window length.
Windows at or over the class's threshold are joined into one span. Spans that
an allow-list pattern covers, or that lie in a base span, are suppressed.

Nulls and empty texts have no spans. Each input row gives one row, repeated
rows alike; a null doc_id stays null. Texts are scanned whole at any length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quaywatch.llm import words

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX_BYTES = b"0123456789abcdef"
_CODE_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])", re.DOTALL)

#: Uuids, runs of digits with separators, and dashed or slashed words are no secrets.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[0-9+/_=-]+",
    r"[A-Za-z]+([/_=-]+[A-Za-z]+)*",
)


@dataclass(frozen=True)
class Scan:
    """Window length, bits of entropy by class, and the allow-list (whole-string patterns)."""

    window: int = 20
    hex_bits: float = 3.0
    code_bits: float = 3.9
    allowed: tuple[str, ...] = field(default=ALLOWED)


def windows(text: str, size: int, bits: float) -> list[tuple[int, int]]:
    """Joined windows of `size` characters whose Shannon entropy is `bits` or more."""
    if len(text) < size:
        return []
    part = [0.0, *(c * math.log2(c) for c in range(1, size + 1))]
    most = size * (math.log2(size) - bits) + 1e-9
    count: dict[str, int] = {}
    total, found = 0.0, []
    for i, c in enumerate(text):
        n = count.get(c, 0)
        total += part[n + 1] - part[n]
        count[c] = n + 1
        if i >= size:
            gone = text[i - size]
            n = count[gone]
            total += part[n - 1] - part[n]
            count[gone] = n - 1
        if i >= size - 1 and total <= most:
            if found and found[-1][1] >= i - size + 1:
                found[-1][1] = i + 1
            else:
                found.append([i - size + 1, i + 1])
    return [(a, b) for a, b in found]


def base(text: str, hexes: bool) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the key patterns; hexes: whether the text has a long run of hex digits."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if hexes:
        out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def added(candidates: list[tuple[int, str, float]], have: list[tuple[int, str, int]], scan: Scan, allowed: re.Pattern) -> list[tuple[int, str, int]]:
    """Entropy spans of the candidate strings (start, string, bits)."""
    found = []
    for start, string, bits in candidates:
        if allowed.fullmatch(string):
            continue
        for a, b in windows(string, scan.window, bits):
            if _MIXED.match(string[a:b]) and not allowed.fullmatch(string[a:b]):
                found.append((start + a, start + b))
    out: list[list[int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, "entropy", b) for a, b in out if not any(s <= a and b <= e for s, _, e in have)]


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def _runs(data: np.ndarray, offsets: np.ndarray, within: bytes, least: int) -> dict[int, list[tuple[int, int]]]:
    starts, ends, rows = words.spans(data, offsets, ~words.byte_class(within))
    keep = np.flatnonzero(ends - starts >= least)
    out: dict[int, list[tuple[int, int]]] = {}
    for k in keep:
        out.setdefault(int(rows[k]), []).append((int(starts[k]), int(ends[k])))
    return out


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long"


def scan_documents(documents: DataFrame, scan: Scan = Scan(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, and all spans."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = re.compile("|".join(f"(?:{x})" for x in scan.allowed) or r"(?!)")
        for batch in batches:
            for piece, data, offsets in words.chunks(batch):
                hexes = _runs(data, offsets, _HEX_BYTES, min(24, scan.window))
                codes = _runs(data, offsets, _CODE_BYTES, scan.window)
                ends = ((data & 0xC0) != 0x80).cumsum() if len(hexes) or len(codes) else None
                cols: list[list] = [[] for _ in range(6)]
                for row, text in enumerate(piece.column("text").to_pylist()):
                    text = text or ""
                    have = base(text, any(b - a >= 24 for a, b in hexes.get(row, ())))
                    more = []
                    if row in hexes or row in codes:
                        first = int(offsets[row])
                        before = int(ends[first - 1]) if first else 0
                        at = lambda byte: int(ends[byte]) - 1 - before  # noqa: E731  code point at a byte that begins one
                        runs = [(at(a), data[a:b].tobytes().decode(), scan.hex_bits) for a, b in hexes.get(row, ())]
                        runs += [(at(a), data[a:b].tobytes().decode(), scan.code_bits) for a, b in codes.get(row, ())]
                        more = added(runs, have, scan, allowed)
                    kinds = [k for _, k, _ in have]
                    both = sorted([*have, *more], key=lambda s: (s[0], KINDS.index(s[1])))
                    for col, x in zip(cols, (kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(_joined(have).encode()).hexdigest(), _joined(both), len(more))):
                        col.append(x)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.int64())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"],
                )

    return documents.select(documents[id_column].alias("doc_id"), documents[text_column].alias("text")).mapInArrow(each, SCHEMA)
