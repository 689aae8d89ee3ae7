"""Word shingles of texts as sorted 64-bit numbers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import xxhash

_MIX = np.uint64(0xFF51AFD7ED558CCD)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: What leaves the first bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mixed(numbers: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    numbers = (numbers ^ (numbers >> np.uint64(33))) * _MIX
    numbers = (numbers ^ (numbers >> np.uint64(29))) * _BASE
    return numbers ^ (numbers >> np.uint64(32))


def _word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word ``data[start:end]``: of a short one its bytes, of others a hash of them."""
    lengths = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))  # the eight bytes from every place
    own = eight[starts] & _FIRST[np.minimum(lengths, 8)]
    out = mixed(own ^ mixed(lengths.astype(np.uint64)))
    view = memoryview(data)
    longer = np.flatnonzero(lengths > 8)
    places = zip(starts[longer].tolist(), ends[longer].tolist())
    out[longer] = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in places), np.uint64, len(longer))
    return out


def words(texts: Sequence[bytes | None], fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number, start and end (bytes in its text) of every word, and the first word of each text (one more at the end).

    Words are what ASCII blanks part; ``fold`` lower-cases A-Z first.  A null text has none.
    """
    sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b" ".join([t or b"" for t in texts]) + b" ", np.uint8)
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(space & ~before)
    numbers = _word_numbers(_LOWER[data] if fold else np.ascontiguousarray(data), starts, ends)
    firsts = np.searchsorted(starts, offsets)
    base = np.repeat(offsets[:-1], np.diff(firsts))
    return numbers, starts - base, ends - base, firsts


def runs(numbers: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, text and first word of every run of ``size`` words; of a shorter text, of the whole of it."""
    count = np.diff(firsts)
    text = np.repeat(np.arange(len(count)), count)
    end = firsts[1:][text]
    at = np.arange(len(numbers))
    total = np.zeros(len(numbers), np.uint64)
    padded = np.concatenate([numbers, np.zeros(size, np.uint64)])
    factor = 1
    for k in range(size):
        factor = (factor * int(_MIX) + 2 * k + 1) % (1 << 64)
        total += np.where(at + k < end, mixed(padded[k : k + len(numbers)] + np.uint64(factor)), np.uint64(0))
    kept = (at + size <= end) | ((at == firsts[:-1][text]) & (count[text] < size))
    return mixed(total[kept]), text[kept], at[kept]


def shingle_sets(texts: Sequence[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, ascending in each, and where each text's begin (one more at the end)."""
    numbers, _, _, firsts = words(texts)
    found, text, _ = runs(numbers, firsts, size)
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[new], text[new]
    return found, np.searchsorted(text, np.arange(len(texts) + 1))


def as_bytes(values: Iterable[str | None]) -> list[bytes | None]:
    return [None if v is None else v.encode() for v in values]
