"""Benchmark passages in documents, up to edits, by CGK embeddings and bit-sampling LSH.

A passage counts as found where an item aligns with document words in at most ``edits(n)`` word edits
(a fifth of its n words). The candidates are item-sized windows on the diagonals of shared word
3-grams: that many edits leave at least one 3-gram of the item untouched, so no alignment is lost
there. Window and item are embedded by the same random walks (a symbol is repeated or passed on by a
coin that step and symbol decide), which turns few edits into a small Hamming distance; sampled
coordinates of the embeddings are hashed, and a pair is kept where one of ``WALKS * SAMPLES`` hashes agrees. What is kept is
verified by the exact edit distance. Items too short for a 3-gram allow no edit and are found by their one or two words.

Items are taken in blocks of bounded rows and bytes, each a pass over all documents; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.storage import slices, small_batches, spare_memory
from tabula.llm.textnum import mix, powers, unicode_words

_U = np.uint64
SEED_WORDS = 3
#: Walks, samples of each, coordinates of a sample: an alignment at the limit is missed in under one of a hundred (tested).
WALKS, SAMPLES, COORDINATES = 12, 12, 8
ITEM_BLOCK, ITEM_BYTES = 20_000, 16_000_000
#: Bytes of texts that are hashed together; a longer text comes alone.
SLICE_BYTES = 500_000
_FILTER_BITS = 22
# Rows embedded side by side, and symbols noted for them in one walk.
_WALK_ROWS, _WALK_CELLS = 5_000, 1_000_000


def edits(n: int) -> int:
    """Word edits allowed for an item of n words: a fifth, and few enough to leave a 3-gram whole."""
    return max(0, min(n // 5, (n - SEED_WORDS) // SEED_WORDS))


def _grams(hashes: np.ndarray, borders: np.ndarray, width: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``width`` words within a text."""
    if len(hashes) < width:
        return np.empty(0, _U), np.empty(0, np.int64)
    step = powers(_U(0x9E3779B97F4A7C15), width)
    inside = np.ones(len(hashes), bool)
    for i in range(1, width):
        inside[np.maximum(borders[1:] - i, borders[:-1])[borders[1:] > borders[:-1]]] = False
    at = np.flatnonzero(inside[: len(hashes) - width + 1])
    rolled = sum(hashes[i: len(hashes) - width + 1 + i] * step[i] for i in range(width))
    return mix(rolled[at]), at


class Items:
    """Words of a block of benchmark items, their 3-grams, and their sampled embeddings."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.words, borders = unicode_words(texts)
        lengths = np.diff(borders)
        self.ids, self.begin, self.length = np.asarray(ids, np.int64), borders[:-1], lengths
        self.limit = np.asarray([edits(int(n)) for n in lengths])
        gram, at = _grams(self.words, borders)
        order = np.argsort(gram, kind="stable")
        self.gram, self.at = gram[order], at[order]
        self.owner = np.searchsorted(borders, self.at, side="right") - 1
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.gram >> _U(64 - _FILTER_BITS)).astype(np.int64)] = True
        usable = np.flatnonzero(lengths >= SEED_WORDS)
        self.keys = np.zeros((len(lengths), WALKS * SAMPLES), _U)
        self.keys[usable] = embed(self.words, self.begin[usable], lengths[usable], lengths[usable])
        self.short = {}  # by words: sorted hashes of the items of so many words, and the items
        for width in range(1, SEED_WORDS):
            own = np.flatnonzero(lengths == width)
            if len(own):
                key, _ = _grams(self.words[(self.begin[own][:, None] + np.arange(width)).ravel()], np.arange(len(own) + 1) * width, width)
                order = np.argsort(key, kind="stable")
                self.short[width] = key[order], own[order]


def embed(symbols: np.ndarray, begin: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sampled hashes of the embeddings of ``count`` symbols from ``begin``, as for items of ``length`` words.

    The walk of an item of n words has 3n steps; which steps are sampled depends on n alone, so
    a window is sampled where its item is.
    """
    share = np.random.default_rng(11).random((WALKS, SAMPLES * COORDINATES))
    keys = np.zeros((len(begin), WALKS * SAMPLES), _U)
    padded = np.append(symbols, _U(0))
    order = np.argsort(length, kind="stable")
    at = 0
    while at < len(order):  # rows of similar lengths, as many as their walks have room
        room = max(1, _WALK_CELLS // int(3 * length[order[min(at + _WALK_ROWS, len(order)) - 1]]))
        own = order[at: at + min(room, _WALK_ROWS)]
        at += len(own)
        steps = 3 * int(length[own[-1]])
        seen = np.empty((len(own), steps), _U)
        for walk in range(WALKS):
            place, stop = begin[own], begin[own] + count[own]
            for step in range(steps):
                inside = place < stop
                symbol = np.where(inside, padded[np.minimum(place, len(symbols))], _U(1))
                seen[:, step] = symbol
                coin = mix(symbol + _U((walk * 100_003 + step + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> _U(63)
                place = place + (coin.astype(np.int64) & inside)
            sampled = (share[walk] * (3 * length[own])[:, None]).astype(np.int64)
            values = np.take_along_axis(seen, sampled, axis=1).reshape(len(own), SAMPLES, COORDINATES)
            key = np.zeros((len(own), SAMPLES), _U)
            for c in range(COORDINATES):
                key = mix(key + values[:, :, c] * _U(0xD1B54A32D192ED03))
            keys[own, walk * SAMPLES: (walk + 1) * SAMPLES] = key
    return keys


def fit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smallest edit distance of ``item`` to any stretch of ``text``, and where that stretch begins and ends."""
    m = len(text)
    cost, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    ramp = np.arange(m + 1)
    for i, w in enumerate(item):
        swap = cost[:-1] + (text != w)
        drop = cost[1:] + 1
        best = np.append(i + 1, np.minimum(swap, drop))
        source = np.append(0, np.where(swap <= drop, origin[:-1], origin[1:]))
        slack = best - ramp  # insertions: the cheapest place to the left, one more for each word
        low = np.minimum.accumulate(slack)
        place = np.maximum.accumulate(np.where(slack == low, ramp, 0))
        cost, origin = low + ramp, source[place]
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), end


def _short_matches(hashes: np.ndarray, borders: np.ndarray, items: Items) -> dict[tuple[int, int], tuple[int, int, int]]:
    """First place of every item of fewer words than a seed, by (text, item)."""
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for width, (key, item) in items.short.items():
        gram, at = _grams(hashes, borders, width)
        low, high = np.searchsorted(key, gram), np.searchsorted(key, gram, side="right")
        hit = np.flatnonzero(high > low)
        text = np.searchsorted(borders, at[hit], side="right") - 1
        # one place for each text and hash, the first; only then the items that share the hash
        _, first = np.unique(np.stack([text, low[hit]]), axis=1, return_index=True)
        for h in first.tolist():
            t, place = int(text[h]), int(hit[h])
            for i in item[low[place]: high[place]].tolist():
                found[t, i] = (0, int(at[place] - borders[t]), width)
    return found


def matches(texts: list[str], items: Items) -> list[tuple[int, int, int, int, int]]:
    """(text, item, distance, first word, words) of the best alignment of every item found in a text."""
    hashes, borders = unicode_words(texts)
    gram, at = _grams(hashes, borders)
    hit = items.filter[(gram >> _U(64 - _FILTER_BITS)).astype(np.int64)]
    gram, at = gram[hit], at[hit]
    low, high = np.searchsorted(items.gram, gram), np.searchsorted(items.gram, gram, side="right")
    many = high - low
    place = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    word = np.repeat(at, many)
    item = items.owner[place]
    text = np.searchsorted(borders, word, side="right") - 1
    start = np.maximum(word - (items.at[place] - items.begin[item]), borders[:-1][text])
    pairs = np.unique(np.stack([text, item, start], axis=1), axis=0)
    found: dict[tuple[int, int], tuple[int, int, int]] = _short_matches(hashes, borders, items)
    for some in range(0, len(pairs), 20_000):
        text, item, start = pairs[some: some + 20_000].T
        count = np.minimum(items.length[item], borders[1:][text] - start)
        agree = (embed(hashes, start, count, items.length[item]) == items.keys[item]).any(axis=1)
        for t, i, s in zip(text[agree].tolist(), item[agree].tolist(), start[agree].tolist()):
            n, limit = int(items.length[i]), int(items.limit[i])
            a, b = max(int(borders[t]), s - limit), min(int(borders[t + 1]), s + n + limit)
            own = items.words[items.begin[i]: items.begin[i] + n]
            distance, first, last = fit_distance(own, hashes[a:b])
            if distance <= limit:
                best = (distance, a + first - int(borders[t]), last - first)
                found[t, i] = min(found.get((t, i), best), best)
    return [(t, i, *best) for (t, i), best in sorted(found.items())]


def _blocks(benchmark: DataFrame, block: int) -> Iterator[tuple[list[int], list[str]]]:
    """Ids and texts of the items, in blocks of about ``block`` items and ``ITEM_BYTES`` bytes."""
    known = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    size = known.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(-(-size["n"] // block), -(-size["bytes"] // ITEM_BYTES))
    for turn in range(blocks):
        own = known if blocks == 1 else known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == turn)
        listed = own.collect()
        if listed:
            yield [r["item_id"] for r in listed], [r["text"] for r in listed]


def contaminated(docs: DataFrame, benchmark: DataFrame, block: int = ITEM_BLOCK) -> DataFrame:
    """doc_id, item_id, distance, first_word, n_words: the best place of each benchmark item in each document.

    Words are lower-case runs of letters, digits and marks of any script, single characters in scripts without
    spaces; whole texts are searched. Of several best places the first counts. Null and empty texts
    have no rows; items that are null or have no word are not searched for; equal rows of
    either table have rows of their own; an empty table on either side gives none. Texts are taken in slices of bounded
    bytes, a longer one alone. Columns other than doc_id, text and item_id are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    out = None
    schema = "doc_id long, item_id long, distance int, first_word long, n_words int"
    for ids, texts in _blocks(benchmark, block):

        def run(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts) -> Iterator[pa.RecordBatch]:
            spare_memory()
            items = Items([i or 0 for i in ids], texts)
            for part in slices(batches, 1, SLICE_BYTES):
                doc, hits = part.column(0).to_pylist(), matches(part.column(1).to_pylist(), items)
                if hits:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc[t] for t, *_ in hits], pa.int64()),
                        pa.array([ids[h[1]] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.int32()),
                        pa.array([h[3] for h in hits], pa.int64()), pa.array([h[4] for h in hits], pa.int32())],
                        names=["doc_id", "item_id", "distance", "first_word", "n_words"])

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def clean_rows(docs: DataFrame, benchmark: DataFrame, block: int = ITEM_BLOCK) -> DataFrame:
    """The rows of ``docs``, with all columns, in which no benchmark item is found; row by row, no shuffle.

    The text column must be named ``text``. Rows without a text are kept; see :func:`contaminated`.
    """
    small_batches(docs.sparkSession)
    place = docs.columns.index("text")
    for ids, texts in _blocks(benchmark, block):

        def run(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts) -> Iterator[pa.RecordBatch]:
            spare_memory()
            items = Items([i or 0 for i in ids], texts)
            for part in slices(batches, place, SLICE_BYTES):
                found = {h[0] for h in matches([t or "" for t in part.column(place).to_pylist()], items)}
                yield part.filter(pa.array([i not in found for i in range(part.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
