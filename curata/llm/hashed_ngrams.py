"""Word n-grams of whole texts as buckets of their CRC-32, scored with numpy arrays.

The texts of a portion are one byte array. Words are found with a byte table, the CRC of every word is computed for all words at
once, byte by byte, and an n-gram's CRC is put together from those of its words: a CRC is linear, so going on by a word is a
table look-up for the word's length. No n-gram is ever built as a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text held at a time; a longer text goes in slices that repeat the last words of the slice before.
HELD = 1 << 20
#: Words up to this length have a table each; the CRC of longer ones is computed one by one.
SHORT = 64
ALL = np.uint32(0xFFFFFFFF)

# Fixed values of CRC-32: the reversed polynomial.
POLYNOMIAL = np.uint32(0xEDB88320)


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    """The register after one byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ POLYNOMIAL, table >> 1).astype(np.uint32)
    return table


def after_byte(register: np.ndarray, byte) -> np.ndarray:
    return byte_table()[(register ^ byte) & 255] ^ (register >> np.uint32(8))


def shifted(register: np.ndarray, tables: np.ndarray, which) -> np.ndarray:
    """``register`` after as many zero bytes as table ``which`` stands for."""
    at = np.asarray(which, np.int64) * 1024
    out = tables[at + (register & 255)]
    for part in (1, 2, 3):
        out = out ^ tables[at + part * 256 + ((register >> np.uint32(8 * part)) & 255)]
    return out


@lru_cache(maxsize=1)
def length_tables() -> np.ndarray:
    """For 0 to SHORT zero bytes, what each byte of a register becomes; flat."""
    level = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * part) for part in range(4)])
    levels = [level]
    for _ in range(SHORT):
        levels.append(level := after_byte(level, 0))
    return np.concatenate([x.ravel() for x in levels])


@lru_cache(maxsize=1)
def power_tables() -> np.ndarray:
    """For 1, 2, 4 ... zero bytes the same; flat."""
    base = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * part) for part in range(4)])
    levels = [after_byte(base, 0)]
    for _ in range(40):
        levels.append(shifted(levels[-1], levels[-1].ravel(), 0))
    return np.concatenate([x.ravel() for x in levels])


def by_length(register: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``register`` after ``lengths`` zero bytes, any number of them."""
    out = shifted(register, length_tables(), np.minimum(lengths, SHORT))
    far = np.flatnonzero(lengths > SHORT)
    if len(far):
        left, value = lengths[far] - SHORT, out[far]
        for bit in range(int(left.max()).bit_length()):
            on = (left >> bit) & 1 == 1
            value[on] = shifted(value[on], power_tables(), bit)
        out[far] = value
    return out


def word_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of every word."""
    out = np.empty(len(starts), np.uint32)
    near = np.flatnonzero(lengths <= SHORT)
    order = near[np.argsort(-lengths[near], kind="stable")]
    begin, left = starts[order], lengths[order]
    register = np.full(len(order), ALL)
    for k in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, "left"))  # those longer than k come first
        register[:n] = after_byte(register[:n], data[begin[:n] + k])
    out[order] = register ^ ALL
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = zlib.crc32(data[starts[i] : starts[i] + lengths[i]])
    return out


@lru_cache(maxsize=1)
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased; which of those belong to a word: 0-9, a-z and all of a character beyond ASCII."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    return lower, word


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and the offsets of its rows."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def buckets(data: np.ndarray, offsets: np.ndarray, n_buckets: int, longest: int, old: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every n-gram of 1 to ``longest`` words, and the number of words of each row.

    ``data`` holds the rows, lower-cased, one after the other. What ends within the first ``old`` bytes is left out.
    """
    word = _bytes()[1][data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    begins[full] = word[full]
    ends[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = word[offsets[1:][offsets[1:] > offsets[:-1]] - 1]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    row = np.searchsorted(offsets, starts, "right") - 1
    fresh = starts + lengths > old
    crcs = word_crcs(data, starts, lengths)
    rows, found, gram = [row[fresh]], [crcs[fresh] % np.uint32(n_buckets)], crcs
    for n in range(2, longest + 1):
        spaced = after_byte(gram[:-1] ^ ALL, np.uint32(32)) ^ ALL if len(gram) else gram
        gram = by_length(spaced, lengths[n - 1 :]) ^ crcs[n - 1 :]
        whole = (row[n - 1 :] == row[: len(gram)]) & fresh[n - 1 :]
        rows.append(row[n - 1 :][whole])
        found.append(gram[whole] % np.uint32(n_buckets))
    return np.concatenate(rows), np.concatenate(found).astype(np.int64), np.bincount(row[fresh], minlength=len(offsets) - 1)


def slices(data: np.ndarray, longest: int, held: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text in slices that end between words, with the number of bytes each repeats of the one before."""
    word = _bytes()[1]
    start = old = 0
    while start < len(data):
        end = start + old + held
        while end < len(data):  # up to the end of a word
            gap = np.flatnonzero(~word[data[end : end + held]])
            if len(gap):
                end += int(gap[0])
                break
            end += held
        end = min(end, len(data))
        yield data[start:end], old
        if end == len(data):
            return
        back, again = 4096, end
        while True:  # back to the begin of the last words but one
            lo = max(start, end - back)
            inside = word[data[lo:end]]
            begins = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1 + lo
            if len(begins) >= longest - 1 or lo == start:
                again = int(begins[-(longest - 1)]) if longest > 1 and len(begins) >= longest - 1 else (lo if longest > 1 else end)
                break
            back *= 8
        start, old = again, end - again


def of_texts(column: pa.Array, n_buckets: int, longest: int, held: int = HELD) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Portions of a text column: first row, number of rows, then rows (from 0) and buckets of all n-grams and words per row.

    A row longer than ``held`` comes in several portions of that one row.
    """
    lower = _bytes()[0]
    data, offsets = utf8(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + held, "right")) - 1)
        part = data[offsets[first] : offsets[last]]
        if last == first + 1 and len(part) > held:
            for piece, old in slices(lower[part], longest, held):
                yield first, 1, *buckets(piece, np.array([0, len(piece)]), n_buckets, longest, old)
        else:
            yield first, last - first, *buckets(lower[part], offsets[first : last + 1] - offsets[first], n_buckets, longest)
        first = last
