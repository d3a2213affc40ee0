"""Texts of a batch as flat numpy arrays: bytes, words and their hashes, word shingles."""

from __future__ import annotations

import unicodedata

import numpy as np

_U = np.uint64
_BASE = _U(0x5851F42D4C957F2D)
_BASE_INVERSE = _U(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}
# The bytes taken for white space between words; fixed values.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# The bytes between words where only letters and digits count; every byte beyond ASCII counts as a letter.
NOT_ALNUM = np.asarray([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 16), base, _U)
        full[0] = 1
        have = np.multiply.accumulate(full)
        _POWERS[int(base)] = have
    return have[:n]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and the n + 1 borders of the texts."""
    borders = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=borders[1:])
    return np.frombuffer(b"".join(texts), np.uint8), borders


def range_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; equal contents hash alike wherever they stand."""
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers(_BASE, len(data)), out=total[1:])
    return mix((total[stop] - total[start]) * powers(_BASE_INVERSE, len(data) + 1)[start] + (stop - start).astype(_U))


def words(texts: list[str], between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (lower case, cut at the bytes ``between``) of all texts, and the borders of the texts."""
    data, borders = joined([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    if not len(data):
        return np.empty(0, _U), np.zeros(len(texts) + 1, np.int64)
    solid = ~between[data]
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    before[borders[:-1][borders[:-1] < len(data)]] = False
    start = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1], after[:-1] = False, solid[1:]
    after[borders[1:][borders[1:] > 0] - 1] = False
    stop = np.flatnonzero(solid & ~after) + 1
    return range_hashes(data, start, stop), np.searchsorted(start, borders)


# Scripts written without spaces, as first and last code point: South East Asian, kana, Han; fixed values.
_SPACELESS = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
              (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x20000, 0x3FFFF)]
_BETWEEN, _LETTER, _ALONE = 0, 1, 2
_KINDS: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """For every code point: between words, a letter (or digit, or mark), or a word of its own."""
    if not _KINDS:
        kinds = np.zeros(0x110000, np.uint8)
        for first, last in ((0, 0x3FFFF), (0xE0000, 0xE0FFF)):  # the planes with letters or marks
            kinds[first: last + 1] = [unicodedata.category(chr(c))[0] in "LNM" for c in range(first, last + 1)]
        for first, last in _SPACELESS:
            own = kinds[first: last + 1]
            own[own == _LETTER] = _ALONE
        _KINDS.append(kinds)
    return _KINDS[0]


def unicode_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Like :func:`words`, for text of any script: runs of letters, digits and marks; where a script has no
    spaces every character is a word."""
    data, borders = joined([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    if not len(data):
        return np.empty(0, _U), np.zeros(len(texts) + 1, np.int64)
    solid = ~NOT_ALNUM[data]
    cut = np.zeros(len(data) + 1, bool)  # a word may not go on here
    cut[borders] = True
    wide = np.flatnonzero(data >= 0xC0)
    if len(wide):
        size = 2 + (data[wide] >= 0xE0) + (data[wide] >= 0xF0)
        code = data[wide].astype(np.int64) & (0x7F >> size)
        for i in range(1, 4):
            more = size > i
            code[more] = code[more] << 6 | data[wide[more] + i] & 0x3F
        kind = _kinds()[code]
        for i in range(4):
            solid[wide[(kind == _BETWEEN) & (size > i)] + i] = False
        alone = kind == _ALONE
        cut[wide[alone]] = cut[(wide + size)[alone]] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | cut[1:-1]
    start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return range_hashes(data, start, stop), np.searchsorted(start, borders)


def shingles(hashes: np.ndarray, borders: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` words in a row; a text of fewer words has one shingle of them all. With borders."""
    n = np.diff(borders)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    out = np.zeros(len(borders), np.int64)
    np.cumsum(count, out=out[1:])
    step = powers(_U(0x9E3779B97F4A7C15), width)
    rolled = np.zeros(max(0, len(hashes) - width + 1), _U)
    for i in range(width):
        rolled += hashes[i: len(hashes) - width + 1 + i] * step[i]
    whole = n >= width
    at = np.repeat(borders[:-1] - out[:-1], count) + np.arange(out[-1])
    result = np.zeros(out[-1], _U)
    of_whole = np.repeat(whole, count)
    result[of_whole] = rolled[at[of_whole]]
    for i in np.flatnonzero(~whole & (n > 0)):
        part = hashes[borders[i]: borders[i + 1]]
        result[out[i]] = np.sum(part * step[: len(part)]) + _U(len(part))
    return mix(result), out
