"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

The automaton reads token sequences. It starts as one state with a loop for every base symbol, and
each merge ``a b -> ab`` is applied as a gadget, in order: states reached by ``a`` lose their arc
``b``, and every state that (still) has an arc ``a`` gets an arc ``ab`` to where ``a b`` led before.
All arcs of a token lead to one state, so a state is the token that leads to it, and what remains
after the last gadget is a deterministic automaton that accepts exactly the sequences which the merge
procedure produces. Whether token y may follow token x depends only on the gadgets that made x or y
or removed the pair, so an arc is built by running those few backwards (:meth:`Automaton.arc`); arcs
are built when a word first needs them and kept in the transition table. (The whole table would
hold about 49,000 x 49,000 arcs, of which texts use a small part.)

A word is encoded left to right by look-ups in the vocabulary and the transition table: the longest
token that the state has an arc for, and a shorter one where that leads nowhere. Decoding walks the
accepted sequence and emits the labels of its arcs.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tabula.llm.storage import MEMOS, small_batches, spare_memory
from tabula.llm.units import SEPARATORS, Cache

CACHED_UNITS = 150_000
CACHED_ARCS = 500_000
_AUTOMATA: dict[str, "Automaton"] = {}
MEMOS.append(_AUTOMATA)
# White space of the Unicode standard; fixed values.
_SPACE = r"[\t-\r \x85\xa0  -     　]"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    symbols = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [symbols[b] for b in range(256)]


class Automaton:
    """Merges compiled to states and arcs; :meth:`encode` and :meth:`decode` on whole texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocabulary: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: t for t, i in (self.vocabulary | self.special).items()}
        size = max(self.labels) + 1
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.removed: dict[tuple[int, int], int] = {}
        for turn, (a, b) in enumerate(tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]):
            x, y, made = self.vocabulary[a], self.vocabulary[b], self.vocabulary[a + b]
            if self.born[made] >= 0:
                raise ValueError("two merges make the same token")
            self.born[made], self.left[made], self.right[made] = turn, x, y
            self.removed[x, y] = turn
        self.reach: dict[str, int] = {}  # length of the longest token that begins with three symbols
        for t in self.vocabulary:
            spelt = t.removesuffix(self.end)
            self.reach[spelt[:3]] = max(len(spelt), self.reach.get(spelt[:3], 3))
        self.arcs: dict[tuple[int, int], bool] = {}
        self.split = regex.compile(next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.symbols = dict(enumerate(byte_symbols()))
        self.words = Cache(lambda words: list(map(self._word, words)), CACHED_UNITS)
        self.units = Cache(self._make_units, CACHED_UNITS)

    def arc(self, x: int, y: int) -> bool:
        """Whether the state of token x has an arc y after all gadgets."""
        found = self.arcs.get((x, y))
        if found is None:
            found = self._built(x, y)
            if len(self.arcs) >= CACHED_ARCS:
                self.arcs.clear()
            self.arcs[x, y] = found
        return found

    def _built(self, x: int, y: int) -> bool:
        before = len(self.born)  # gadgets numbered below this have been applied
        while True:
            if self.removed.get((x, y), before) < before:
                return False
            older, newer = self.born[x], self.born[y]
            if older == newer == -1:
                return True  # the loops the automaton began with
            if newer > older:  # arc y was copied from arc left(y) once its own gadget had removed its pair
                y, before = self.left[y], newer + 1
            elif older > newer:  # state x was the target of right(x) before its own gadget
                x, before = self.right[x], older
            else:
                x, y, before = self.right[x], self.left[y], older

    def _word(self, symbols: str) -> list[int]:
        """Tokens of one word given as byte symbols."""
        # A prefix has one accepted path at most, so a position that leads nowhere is never tried again.
        n, known, arcs, dead = len(symbols), self.vocabulary, self.arcs, set()
        path, begins, at = [], [], 0
        length = min(n, self.reach.get(symbols[:3], 3))
        while at < n:
            while length:
                stop = at + length
                token = known.get(symbols[at:stop] + self.end if stop == n else symbols[at:stop])
                if token is not None and stop not in dead:
                    if not path:
                        break
                    found = arcs.get((path[-1], token))
                    if self.arc(path[-1], token) if found is None else found:
                        break
                length -= 1
            else:
                if not path:
                    raise ValueError("no path spells this word")
                dead.add(at)
                path.pop()
                length = at - begins[-1] - 1
                at = begins.pop()
                continue
            path.append(token)
            begins.append(at)
            at = stop
            length = min(n - at, self.reach.get(symbols[at:at + 3], 3))
        return path

    def _words(self, text: str) -> list[str]:
        """The words of a text as byte symbols."""
        symbols = self.symbols
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [
            w if w.isascii() and w.isprintable() else w.encode("utf-8").decode("latin-1").translate(symbols)
            for w in self.split.findall(text)]

    def _make_units(self, units: list[str]) -> list[tuple[bytes, bytes]]:
        words = list(map(self._words, units))
        tokens = iter(self.words.all([w for unit in words for w in unit]))
        made = []
        for unit in words:
            ids = [i for _ in unit for i in next(tokens)]
            made.append((struct.pack(f"<{len(ids)}I", *ids), self.decode(ids).encode("utf-8")))
        return made

    def pieces(self, text: str) -> list[tuple[bytes, bytes]]:
        """Ids (little-endian 32 bits) and decoded text of each white-space unit and special token of a text."""
        out = []
        parts, marks = [text], []
        if any(m in text for m in self.special):
            parts, marks = self.marks.split(text), self.marks.findall(text)
        for i, part in enumerate(parts):
            if any(c in part for c in SEPARATORS):  # these are symbols here, though Python splits at them
                units = [u for u in regex.split(_SPACE + "+", part) if u]
            else:
                units = part.split()
            out += self.units.all(units)
            if i < len(marks):
                out.append((np.asarray([self.special[marks[i]]], "<u4").tobytes(), marks[i].encode("utf-8")))
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join(a for a, _ in self.pieces(text)), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The labels along the path; this vocabulary has no decoder, so labels are set apart by spaces."""
        return " ".join(map(self.labels.__getitem__, ids))


def automaton(path: str) -> Automaton:
    """One automaton for each worker process and tokenizer file."""
    if path not in _AUTOMATA:
        _AUTOMATA[path] = Automaton(path)
    spare_memory(_AUTOMATA)  # also of what reading the file took
    return _AUTOMATA[path]


def encode_digests(docs: DataFrame, tokenizer: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``.

    Row by row: no shuffle. Null and empty texts have no tokens and the digests of nothing; ties and
    repeated rows each keep their row; columns not in ``keep``, whatever their names, are ignored.
    """
    keep = ["doc_id"] if keep is None else keep
    small_batches(docs.sparkSession)
    rows = docs.select(*[f"`{c}`" for c in keep], docs["text"].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = automaton(tokenizer)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in batch.column(len(keep)).to_pylist():
                pieces = model.pieces(text or "")
                data = b"".join([a for a, _ in pieces])
                counts.append(len(data) // 4)
                ids.append(hashlib.sha256(data).hexdigest())
                decoded.append(hashlib.sha256(b" ".join([b for _, b in pieces])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(run, f"{kinds}, n_tokens long, ids_sha256 string, decoded_sha256 string")
