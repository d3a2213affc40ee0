"""Fill-in-the-middle rearrangement of texts, cut between units that an indexable skip list counts.

The units of a text (its lines, unless another pattern is given) are the nodes of a skip list. A link
of any lane carries two widths: the units and the code points it spans. A rank is reached from the
top lane down, by following links while the units passed so far stay within the rank; the code points
passed then are the place of the cut. Towers come from a fixed scramble of the node's position, so the
same text gives the same list everywhere.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.storage import lean_memory, slices, small_batches

LINES = r"[^\n]*\n|[^\n]+"
MARKS = ("<P>", "<S>", "<M>")
#: A lane of at most so many links gets no lane above it.
SHORT = 8


def _tall(position: int, lane: int) -> bool:
    """Whether the tower at a position goes on above ``lane``; one in four does."""
    x = (position * 0x9E3779B97F4A7C15 + lane * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 29
    x = x * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return x >> 62 == 0


class SkipList:
    """Units in order, with lanes of links; ``reach`` finds the code points before any unit."""

    def __init__(self, widths: list[int]):
        # A link: units, code points, and the link of the lane below that begins at the same node.
        self.units, self.points, self.below = [[1] * len(widths)], [widths], [[0] * len(widths)]
        nodes = list(range(len(widths)))
        while len(nodes) > SHORT:
            units, points = self.units[-1], self.points[-1]
            up_nodes, up_units, up_points, up_below = [], [], [], []
            for i, node in enumerate(nodes):
                if not i or _tall(node, len(self.units)):
                    up_nodes.append(node)
                    up_units.append(0)
                    up_points.append(0)
                    up_below.append(i)
                up_units[-1] += units[i]
                up_points[-1] += points[i]
            if len(up_nodes) == len(nodes):
                break
            self.units.append(up_units)
            self.points.append(up_points)
            self.below.append(up_below)
            nodes = up_nodes

    def __len__(self) -> int:
        return len(self.units[0])

    def reach(self, rank: int) -> int:
        """Code points in the first ``rank`` units."""
        at, seen, passed = 0, 0, 0
        for lane in range(len(self.units) - 1, -1, -1):
            units, points = self.units[lane], self.points[lane]
            while at < len(units) and seen + units[at] <= rank:
                seen += units[at]
                passed += points[at]
                at += 1
            if seen == rank:
                return passed
            at = self.below[lane][at]  # the link that goes too far is followed one lane below
        return passed


def widths(text: str, unit: str = LINES) -> list[int]:
    """Code points of each unit of a text."""
    if unit == LINES:
        out = [len(line) + 1 for line in text.split("\n")]
        out[-1] -= 1
        return out if out[-1] else out[:-1]
    return [len(u) for u in re.findall(unit, text)]


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit draws of a document; a null id draws like an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i: i + 8], 16) for i in (0, 8, 16, 24)]


def transform(
    docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50, marks: tuple[str, str, str] = MARKS,
    unit: str = LINES, keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (default doc_id), n, form, prefix_chars, middle_chars and the output text of every row.

    ``doc_id`` and the seed alone decide form and cuts. ``percent`` of the texts are rearranged,
    ``spm_percent`` of these suffix first. A text that is null, empty or holds one of the marks keeps its
    order (form ``plain``, null lengths). ``unit`` must match every character of a text in some unit. Row by
    row, no shuffle; texts of any length are taken whole; rows with equal ids and texts give equal rows, a null
    doc_id is an id like any other; an empty table gives no rows; other columns are ignored.
    """
    keep = ["doc_id"] if keep is None else keep
    small_batches(docs.sparkSession)
    given = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    p, s, m = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in slices(batches, len(keep) + 1):
            rows = []
            for doc_id, text in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()):
                text = text or ""
                units = SkipList(widths(text, unit))
                n = len(units)
                h1, h2, h3, h4 = draws(doc_id, seed)
                if not text or any(x in text for x in marks) or h3 % 100 >= percent:
                    rows.append((n, "plain", None, None, text))
                    continue
                a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = units.reach(a), units.reach(b)
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                spm = h4 % 100 < spm_percent
                output = f"{s}{suffix}{p}{prefix}{m}{middle}" if spm else f"{p}{prefix}{s}{suffix}{m}{middle}"
                rows.append((n, "spm" if spm else "psm", a, b - a, output))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=[*keep, "n", "form", "prefix_chars", "middle_chars", "output"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in given.schema.fields[: len(keep)])
    return given.mapInArrow(run, f"{kinds}n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``transform`` was given (null texts as empty), from its output and form."""
    quoted = "|".join("\\Q" + x + "\\E" for x in marks)
    part = F.split(output, quoted, -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
