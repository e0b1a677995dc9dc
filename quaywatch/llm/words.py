"""Words, word shingles and character classes of whole Arrow batches of texts, in numpy.

A word is `[^\\x20\\x09-\\x0D]+` with A-Z in lower case. A shingle is five
consecutive words; a text with one to four words has its whole sequence as one
shingle; a text without words, or null, has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are looked at in one go; a longer text is taken alone and whole.
CHUNK = 1 << 20
WIDTH = 5
_M = np.uint64(0xFF51AFD7ED558CCD)
_N = np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_EACH = np.random.default_rng(20240229).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Kept(dict):
    """Tables kept by a process; they don't travel with a pickled function."""

    def __reduce__(self):
        return _Kept, ()


_powers = _Kept()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S)) * _M
    x = (x ^ (x >> _S)) * _N
    return x ^ (x >> _S)


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        full = np.full(max(n, CHUNK + 64), base, dtype=np.uint64)
        full[0] = 1
        have = np.multiply.accumulate(full)
        if n <= CHUNK + 64:
            _powers[base] = have
    return have[:n]


def _values() -> np.ndarray:
    codes = np.arange(256)
    codes[65:91] += 32
    return mix(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(77))


def byte_class(within: bytes) -> np.ndarray:
    """A table of 256 flags, set for the bytes in `within`."""
    table = np.zeros(256, dtype=bool)
    table[list(within)] = True
    return table


BLANK = byte_class(b" \t\n\v\f\r")
#: Runs of ASCII letters and of characters beyond ASCII are terms.
NOT_LETTER = ~byte_class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets at which each begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()) if pa.types.is_binary(texts.type) else texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_large_binary(texts.type) else "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK, most_rows: int = 8192) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batch with about `most` bytes of text, and their bytes and offsets."""
    data, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), at + most_rows, batch.num_rows)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end in the bytes of each run without blanks, and its row; rows part runs."""
    inside = ~blank[data]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = offsets[:-1][offsets[:-1] < len(data)]
    first[begin] = inside[begin]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    finish = offsets[1:][offsets[1:] > 0] - 1
    last[finish] = inside[finish]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and its row."""
    starts, ends, rows = spans(data, offsets, blank)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), rows
    values = _values()
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * _power(_BASE, len(data)), out=total[1:])
        return mix((total[ends] - total[starts]) * _power(_UNBASE, len(data))[starts] + (ends - starts).astype(np.uint64)), rows


def sequence_hashes(hashes: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each sequence of n words, from the words' hashes."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * _power(_BASE, len(hashes)), out=total[1:])
        return mix((total[first + n] - total[first]) * _power(_UNBASE, len(hashes))[first] + n.astype(np.uint64))


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes sorted by (row, hash), their rows, and the words of each row."""
    hashes, rows = word_hashes(data, offsets)
    n = np.bincount(rows, minlength=len(offsets) - 1)
    with np.errstate(over="ignore"):
        found, of = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        if len(hashes) >= width:
            total = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
            for k in range(width):
                total += hashes[k : len(hashes) - width + 1 + k] * _EACH[k]
            whole = rows[: len(total)] == rows[width - 1 :]
            found.append(mix(total[whole]))
            of.append(rows[: len(total)][whole])
        few = np.flatnonzero((n > 0) & (n < width))
        if len(few):
            at = np.concatenate([[0], np.cumsum(n)])[few]
            total = n[few].astype(np.uint64) * _EACH[15]
            for k in range(width - 1):
                there = n[few] > k
                total[there] += hashes[at[there] + k] * _EACH[k]
            found.append(mix(total))
            of.append(few)
    found, of = np.concatenate(found), np.concatenate(of)
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    if len(found):
        new = np.ones(len(found), dtype=bool)
        new[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
        found, of = found[new], of[new]
    return found, of, n


def bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each of n rows begins in the sorted `rows`."""
    return np.searchsorted(rows, np.arange(n + 1))
