"""Licence texts in documents by patience alignment.

A template and a stretch of text are aligned on the words that are unique in both: the longest
increasing run of these anchors stands, and the gaps between anchors are aligned in the same way; a gap
without anchors keeps its common beginning and end. Coverage is the share of template words that
are aligned. Besides, the words that name a licence (its marks) must be aligned, side by side. A document is
looked at where the template's words that occur in it could reach the threshold at all, and there around every
occurrence of the template's rarest words, in stretches of template size.
Row by row: no shuffle, nothing of the documents reaches the driver.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.license_texts import MARKS, TEMPLATES
from tabula.llm.storage import lean_memory, small_batches
from tabula.llm.textnum import NOT_ALNUM, words

COVERAGE = 0.8


def _places(phrase: list[int], text: list[int]) -> list[int]:
    """Where the words of a phrase stand side by side."""
    return [i for i in range(len(text) - len(phrase) + 1) if text[i: i + len(phrase)] == phrase]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs (ordered by their first) whose seconds rise: piles of patience sorting."""
    tops, ends, back = [], [], [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back[i] = ends[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(b)
            ends.append(i)
        else:
            tops[pile], ends[pile] = b, i
    run, i = [], ends[-1] if ends else -1
    while i >= 0:
        run.append(pairs[i])
        i = back[i]
    return run[::-1]


def align(left: list, right: list) -> list[tuple[int, int]]:
    """Aligned places (left, right) of equal words, both rising."""
    found, todo = [], [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and left[a] == right[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        mine, other = Counter(left[a:b]), Counter(right[c:d])
        place = {w: j for j, w in enumerate(right[c:d], c) if other[w] == 1}
        anchors = _rising([(i, place[w]) for i, w in enumerate(left[a:b], a) if mine[w] == 1 and w in place])
        if anchors:
            found += anchors
            borders = [(a - 1, c - 1), *anchors, (b, d)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(borders, borders[1:])]
    return sorted(found)


class Scanner:
    """Templates as word hashes, with the vocabulary that decides where to look."""

    def __init__(self, templates: dict[str, str], least: float, marks: dict[str, Sequence[str]] | None = None):
        self.names, self.least = list(templates), least
        hashes, borders = words(list(templates.values()), NOT_ALNUM)
        self.templates = [hashes[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])]
        self.vocabulary = np.unique(hashes)
        self.weights = np.zeros((len(self.vocabulary), len(self.templates)), np.int32)
        for j, t in enumerate(self.templates):
            np.add.at(self.weights[:, j], np.searchsorted(self.vocabulary, np.asarray(t, np.uint64)), 1)
        self.marks, self.barred = [], []
        for name, template in zip(self.names, self.templates):
            phrases = [m for m in (marks or {}).get(name, ()) if not m.startswith("-")]
            others = [m[1:] for m in (marks or {}).get(name, ()) if m.startswith("-")]
            found = [(len(p), _places(p, template)) for p in self._phrases(phrases)]
            if any(not size or not places for size, places in found):
                raise ValueError(f"marks of {name} are not in its text")
            self.marks.append(found)
            self.barred.append(self._phrases(others))
        self.needed = np.asarray([np.ceil(least * len(t) - 1e-9) for t in self.templates])

    @staticmethod
    def _phrases(phrases: list[str]) -> list[list[int]]:
        hashes, borders = words(phrases, NOT_ALNUM)
        return [hashes[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])]

    def _named(self, j: int, pairs: list[tuple[int, int]], text: list[int]) -> bool:
        """Whether aligned pairs hold the marks of template j, in text without those of others."""
        where = dict(pairs)
        for size, places in self.marks[j]:
            if not any(p in where and all(where.get(p + k) == where[p] + k for k in range(size)) for p in places):
                return False
        # a stretch may end before the template does by the words that coverage lets it miss
        behind = len(self.templates[j]) - int(self.needed[j]) + 12
        near = text[pairs[0][1]: pairs[-1][1] + 1 + behind]
        return not any(_places(phrase, near) for phrase in self.barred[j])

    def scan(self, texts: list[str]) -> list[tuple[int, str, float, int, int]]:
        """(text, template, coverage, first word, words of the stretch) of the best place of each template."""
        hashes, borders = words(texts, NOT_ALNUM)
        if not len(hashes) or not len(self.vocabulary):
            return []
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        at = np.flatnonzero(self.vocabulary[place] == hashes)
        owner = np.searchsorted(borders, at, side="right") - 1
        counts = np.bincount(owner * len(self.vocabulary) + place[at], minlength=len(texts) * len(self.vocabulary))
        counts = counts.reshape(len(texts), -1)
        bound = np.minimum(counts, 1) @ self.weights
        found = []
        for i, j in zip(*np.nonzero((bound >= self.needed) & (self.needed > 0))):
            own = hashes[borders[i]: borders[i + 1]]
            best = self._best(own, j, counts[i])
            if best:
                found.append((int(i), self.names[j], *best))
        return found

    def _best(self, text: np.ndarray, j: int, counts: np.ndarray) -> tuple[float, int, int] | None:
        """The widest coverage around an occurrence of a word that every long enough alignment must contain one of."""
        template, needed = self.templates[j], int(self.needed[j])
        spare = len(template) - needed
        by_count = sorted(set(template), key=lambda w: (counts[np.searchsorted(self.vocabulary, np.uint64(w))], w))
        rare, missed = [], 0
        for w in by_count:  # an alignment may miss `spare` template words, so look around the rarest spare + 1
            rare.append(w)
            missed += template.count(w)
            if missed > spare:
                break
        places = np.flatnonzero(np.isin(text, np.asarray(rare, np.uint64)))
        size, best = len(template), None
        for p in places.tolist():
            # room for the words behind a stretch that tell another licence
            a, b, c = max(0, p - size - spare), min(len(text), p + size + spare + 1), p + size + 2 * spare + 14
            around = text[a:c].tolist()
            pairs = align(template, around[: b - a])
            # only what lies near the bulk counts: a stretch of about the template's own length
            at = [q for _, q in pairs]
            low, width = 0, size + spare + 1
            top = None
            for high in range(len(at)):
                while at[high] - at[low] >= width:
                    low += 1
                now = (high - low + 1, -low, high)
                if now[0] >= needed and (top is None or now > top) and self._named(j, pairs[low: high + 1], around):
                    top = now
            if top is None:
                continue
            first, last = a + at[-top[1]], a + at[top[2]]
            best = max(best or (0.0, 0, 0), (top[0] / size, -first, last - first + 1))
            if best[0] == 1.0:
                break
        return (best[0], -best[1], best[2]) if best else None


def licenses(docs: DataFrame, templates: dict[str, str] | DataFrame | None = None, least: float = COVERAGE,
             marks: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """doc_id, license, coverage, first_word, n_words of each template found in each row of ``docs``.

    Words are lower-case runs of letters and digits of whole texts. Null and empty texts have no rows; of several
    places the one with the widest coverage, then the first, counts; repeated rows have rows of
    their own; an empty table gives none. ``templates`` are texts by name, or a table (license, text and,
    if wanted, marks); ``marks`` are the phrases without which a template is not found (see MARKS). Columns
    of ``docs`` other than doc_id and text are ignored.
    """
    small_batches(docs.sparkSession)
    if templates is None:
        templates, marks = TEMPLATES, MARKS if marks is None else marks
    if isinstance(templates, DataFrame):
        table = templates.collect()  # licence texts, not documents
        if "marks" in templates.columns:
            marks = {r["license"]: r["marks"] or () for r in table} | (marks or {})
        templates = {r["license"]: r["text"] for r in table}
    templates = dict(templates)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        scanner = Scanner(templates, least, marks)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for some in range(0, len(ids), 250):
                hits = scanner.scan(texts[some: some + 250])
                if hits:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[some + h[0]] for h in hits], pa.int64()), pa.array([h[1] for h in hits]),
                        pa.array([h[2] for h in hits], pa.float64()), pa.array([h[3] for h in hits], pa.int64()),
                        pa.array([h[4] for h in hits], pa.int32())],
                        names=["doc_id", "license", "coverage", "first_word", "n_words"])

    return rows.mapInArrow(run, "doc_id long, license string, coverage double, first_word long, n_words int")
