"""Exact token counts of every prefix of a text, by dynamic programming over a merge vocabulary.

Merging (best score first, leftmost of equals) never crosses a border between two tokens of its own
result. So the tokens of a prefix are the tokens of a shorter prefix and one last token, and a last
token fits when it and the one before it, merged together, stay these two. Exactly one token ends a
prefix that way, which gives the recurrence

    count[i] = count[i - length of the last token at i] + weight of that token

with weight 1, or the number of UTF-8 bytes for a character outside the vocabulary. The differences
count[i] - count[i - 1] are one signed byte per character: :func:`prefix_table` stores them, and
:func:`tokens_before` and :func:`longest_within` answer from them without encoding again.

No piece holds a space after another character, so counts of a text add up over its units (spaces
and what follows them), and the differences of a unit are computed once for each worker's memo.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tabula.llm.storage import lean_memory, slices, small_batches

CACHED_UNITS = 500_000
CACHED_PAIRS = 1_000_000
#: Longer units go one by one and are not kept, so that the memo stays bounded in bytes.
LONGEST_CACHED = 64
#: Characters of units that are worked off side by side.
TOGETHER = 400_000
SPACE = "▁"
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
_EMPTY = -1
_COUNTERS: dict[str, "PrefixCounter"] = {}


class _Table:
    """Numbers by 64-bit keys (not negative) in open addressing, looked up and added in whole arrays."""

    def __init__(self, bits: int = 12):
        self.bits, self.size = bits, 0
        self.keys, self.values = np.full(1 << bits, _EMPTY, np.int64), np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it is absent."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there != _EMPTY))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            there, own = self.keys[slot], keys[open_]
            hit = there == own
            out[open_[hit]] = self.values[slot[hit]]
            rest = ~hit & (there != _EMPTY)
            open_, slot = open_[rest], slot[rest]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that are distinct and absent."""
        self.size += len(keys)
        if self.size * 2 > 1 << self.bits:
            full = self.keys != _EMPTY
            keys, values = np.append(self.keys[full], keys), np.append(self.values[full], values)
            bits = self.bits
            while self.size * 2 > 1 << bits:
                bits += 1
            self.__init__(bits)
            self.size = len(keys)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] == _EMPTY)
            self.keys[slot[free]] = keys[free]  # of several keys for one slot the last one stays
            won = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[won]] = values[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & ((1 << self.bits) - 1)


class PrefixCounter:
    """Token counts of all prefixes, as the sentencepiece library would count each of them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        rules, kinds = spec.normalizer_spec, proto.ModelProto.SentencePiece
        plain = (
            spec.trainer_spec.model_type == spec.trainer_spec.BPE and spec.trainer_spec.byte_fallback
            and not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
            and rules.escape_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix)
        if not plain or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in spec.pieces):
            raise ValueError("not a plain merge vocabulary with byte fallback, leading space and untouched text")
        pieces = [p.piece for p in spec.pieces if p.type == kinds.NORMAL]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece goes on after a space")
        # Merges of two tokens are asked of the library itself, without the space it puts in front of a text.
        rules.add_dummy_prefix = False
        self.library = SentencePieceProcessor(model_proto=spec.SerializeToString())
        # Tokens: number 0 stands for the beginning and for characters in no piece, which nothing merges with.
        known = set(pieces)
        self.names = ["", *pieces, *sorted({c for p in pieces for c in p} - known)]
        self.number = {t: i for i, t in enumerate(self.names)}
        self.weight = np.asarray([0] + [1 if t in known else len(t.encode("utf-8")) for t in self.names[1:]], np.int16)
        self.kind = np.zeros(0x110000, np.uint16)  # number of a character among those of all pieces
        letters = sorted({c for p in pieces for c in p})
        for i, c in enumerate(letters):
            self.kind[ord(c)] = i + 1
        self.single = np.asarray([0] + [self.number[c] for c in letters], np.int32)
        # A trie of the pieces: node and character to the next node, and the token that ends in a node.
        nodes: dict[str, int] = {}
        for p in pieces:
            for n in range(1, len(p) + 1):
                nodes.setdefault(p[:n], len(nodes))
        self.step = _Table()
        long = [(q, i) for q, i in nodes.items() if len(q) > 1]
        self.step.add(
            np.asarray([nodes[q[:-1]] << 16 | int(self.kind[ord(q[-1])]) for q, _ in long], np.int64),
            np.asarray([i for _, i in long], np.int32))
        self.root = np.asarray([-1] + [nodes.get(c, -1) for c in letters], np.int64)
        self.ends = np.zeros(len(nodes), np.int32)
        for p in pieces:
            self.ends[nodes[p]] = self.number[p]
        self.longest = max(map(len, pieces))
        self.nodes = nodes
        self.pairs = _Table()
        self.memo: dict[str, bytes] = {}

    def _merge(self, keys: np.ndarray) -> np.ndarray:
        """For pairs of tokens: whether merging them together leaves these two; the library's own merges."""
        left, right = (keys >> 20).tolist(), (keys & (1 << 20) - 1).tolist()
        names = self.names
        made = self.library.encode([names[a] + names[b] for a, b in zip(left, right)], num_threads=1)
        alone = dict(zip(parts := sorted({*left, *right}), self.library.encode([names[i] for i in parts], num_threads=1)))
        # a token that its own merges would not give fits nowhere
        sound = {i: len(ids) == int(self.weight[i]) for i, ids in alone.items()}
        return np.asarray([
            sound[a] and sound[b] and ids == alone[a] + alone[b] for a, b, ids in zip(left, right, made)], np.int32)

    def follows(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each ``token`` after ``last`` (0: at the beginning) is what merging makes of both."""
        keys = last.astype(np.int64) << 20 | token
        found = self.pairs.find(keys)
        gaps = np.flatnonzero(found < 0)
        if len(gaps):
            fresh, back = np.unique(keys[gaps], return_inverse=True)
            if self.pairs.size > CACHED_PAIRS:
                self.pairs = _Table()
                answer = self._merge(fresh)
                self.pairs.add(fresh, answer)
            else:
                answer = self._merge(fresh)
                self.pairs.add(fresh, answer)
            found[gaps] = answer[back]
        return found > 0

    def _units(self, units: list[str]) -> list[bytes]:
        """Differences of the prefix counts of short units, many units side by side."""
        out, group, size = [], [], 0
        for u in units:
            group.append(u)
            size += len(u)
            if size >= TOGETHER:
                out += self._together(group)
                group, size = [], 0
        return out + self._together(group) if group else out

    def _together(self, units: list[str]) -> list[bytes]:
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.asarray([len(u) for u in units])
        stop = np.cumsum(lengths)
        kind = self.kind[codes]
        place = np.arange(len(codes)) - np.repeat(stop - lengths, lengths)  # of a character in its unit
        room = np.repeat(stop, lengths) - np.arange(len(codes))
        # all pieces that stand in the units: begin, length, token
        at, node = np.arange(len(codes)), self.root[kind]
        begins, sizes, tokens = [at], [np.ones(len(at), np.int64)], [self.single[kind]]
        for size in range(2, self.longest + 1):
            keep = (node >= 0) & (room[at] >= size)
            at, node = at[keep], node[keep]
            if not len(at):
                break
            node = self.step.find(node << 16 | kind[at + size - 1]).astype(np.int64)
            here = np.flatnonzero(node >= 0)
            here = here[self.ends[node[here]] > 0]
            begins.append(at[here])
            sizes.append(np.full(len(here), size))
            tokens.append(self.ends[node[here]])
        begin, size, token = np.concatenate(begins), np.concatenate(sizes), np.concatenate(tokens)
        until = place[begin] + size  # length of the prefix that this piece would end
        order = np.argsort(until.astype(np.uint8), kind="stable")
        begin, size, token = begin[order], size[order], token[order]
        borders = np.searchsorted(until[order], np.arange(1, lengths.max() + 2))
        last, count = np.zeros(len(codes), np.int32), np.zeros(len(codes), np.int32)
        lost = np.flatnonzero(kind == 0)  # characters in no piece count as their bytes
        foreign = np.zeros(len(codes), np.int32)
        foreign[lost] = 1 + (codes[lost] > 0x7F) + (codes[lost] > 0x7FF) + (codes[lost] > 0xFFFF)
        for i in range(1, int(lengths.max()) + 1):
            some = slice(borders[i - 1], borders[i])
            b, t = begin[some], token[some]
            head = place[b] == 0
            before = np.where(head, 0, last[b - 1])
            fit = self.follows(before, t) | (t == 0)
            b, t = b[fit], t[fit]
            base = np.where(head[fit], 0, count[b - 1])
            end = b + size[some][fit] - 1
            last[end] = t
            count[end] = base + np.where(t == 0, foreign[b], self.weight[t])
        steps = np.diff(count, prepend=0)
        steps[stop[:-1]] = count[stop[:-1]]
        data = steps.astype(np.int8).tobytes()
        return [data[e - n: e] for e, n in zip(stop.tolist(), lengths.tolist())]

    def _long(self, unit: str) -> bytes:
        """The same recurrence for one unit of any length; only the last few prefixes are looked back at."""
        window, nodes = self.longest + 1, self.nodes
        last, count = [0] * window, [0] * window
        known: dict[tuple[int, int], bool] = {}
        out, before = bytearray(len(unit)), 0
        for i in range(1, len(unit) + 1):
            token, now = 0, before + len(unit[i - 1].encode("utf-8", "surrogatepass"))
            for length in range(1, min(i, self.longest) + 1):
                text = unit[i - length: i]
                number = self.number.get(text, 0)
                if number and (length == 1 or text in nodes):
                    pair = last[(i - length) % window], number
                    fits = known.get(pair)
                    if fits is None:
                        if len(known) >= CACHED_PAIRS:
                            known.clear()
                        fits = known[pair] = bool(self.follows(np.asarray(pair[:1]), np.asarray(pair[1:]))[0])
                    if fits:
                        token, now = number, count[(i - length) % window] + int(self.weight[number])
                        break
            last[i % window], count[i % window] = token, now
            out[i - 1] = (now - before) & 255
            before = now
        return bytes(out)

    def differences(self, texts: list[str]) -> list[np.ndarray]:
        """count[i] - count[i - 1] for the space that the library puts in front, then for every character of a text."""
        units, borders = [], [0]  # units without the space they begin with
        for text in texts:
            if text and SPACE not in text and "  " not in text and text[0] != " ":
                units += text.split(" ")
            elif text:
                units += [u[1:] for u in _UNIT.findall(SPACE + text.replace(" ", SPACE))]
            borders.append(len(units))
        if len(self.memo) > CACHED_UNITS:
            self.memo = {}
        fresh = set(units).difference(self.memo)
        long = {u: self._long(SPACE + u) for u in fresh if len(u) > LONGEST_CACHED}
        short = [u for u in fresh if len(u) <= LONGEST_CACHED] if long else list(fresh)
        self.memo.update(zip(short, self._units([SPACE + u for u in short])))
        if long:
            parts = [self.memo[u] if len(u) <= LONGEST_CACHED else long[u] for u in units]
        else:
            parts = list(map(self.memo.__getitem__, units))
        return [np.frombuffer(b"".join(parts[a:b]), np.int8) for a, b in zip(borders, borders[1:])]

    def counts(self, text: str) -> np.ndarray:
        """Tokens of text[:0], text[:1], .. and of the whole text."""
        return totals(self.differences([text])[0])


def totals(differences: np.ndarray) -> np.ndarray:
    """Counts of all prefixes from stored differences; the empty prefix has no token."""
    if not len(differences):
        return np.zeros(1, np.int64)
    out = np.cumsum(differences, dtype=np.int64)
    out[0] = 0
    return out


def counter(path: str) -> PrefixCounter:
    """One counter and its memo for each worker process and vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def prefix_table(docs: DataFrame, model: str, limit: int, keep: list[str] | None = None, store: bool = True) -> DataFrame:
    """``keep`` columns (default doc_id) of every row, n_bytes, n_tokens, over_limit, fit_chars, and the differences.

    ``fit_chars`` is the length of the longest prefix of at most ``limit`` tokens (a longer prefix may
    have fewer tokens than a shorter one). ``store=False`` leaves the differences out. Row by row, no
    shuffle. Null and empty texts have no tokens; texts of any length are counted whole, without a
    limit on units; ties and repeated rows each keep their row; an empty table gives no rows; columns not
    in ``keep``, whatever their names, are ignored.
    """
    keep = ["doc_id"] if keep is None else keep
    small_batches(docs.sparkSession)
    rows = docs.select(*[f"`{c}`" for c in keep], docs["text"].alias("_text"))
    names = [*keep, "n_bytes", "n_tokens", "over_limit", "fit_chars", *(["prefixes"] if store else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        model_counter = counter(model)
        for batch in slices(batches, len(keep)):
            sizes, tokens, fits, stored = [], [], [], []
            texts = batch.column(len(keep)).to_pylist()
            for text, steps in zip(texts, model_counter.differences([t or "" for t in texts])):
                n = int(steps.sum(dtype=np.int64))
                sizes.append(len((text or "").encode("utf-8", "surrogatepass")))
                tokens.append(n)
                fits.append(len(text or "") if n <= limit else int(np.flatnonzero(totals(steps) <= limit)[-1]))
                if store:
                    stored.append(steps.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_()), pa.array(fits, pa.int64()),
                 *([pa.array(stored, pa.binary())] if store else [])], names=names)

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(
        run, f"{kinds}n_bytes long, n_tokens long, over_limit boolean, fit_chars long" + (", prefixes binary" if store else ""))


@F.pandas_udf(LongType())
def _tokens_before(prefixes: pd.Series, position: pd.Series) -> pd.Series:
    return pd.Series([
        None if p is None or k is None or k != k else int(totals(np.frombuffer(p, np.int8))[: int(k) + 1][-1])
        for p, k in zip(prefixes, position)], dtype="Int64")


@F.pandas_udf(LongType())
def _longest_within(prefixes: pd.Series, budget: pd.Series) -> pd.Series:
    return pd.Series([
        None if p is None or k is None or k != k or k < 0 else int(np.flatnonzero(totals(np.frombuffer(p, np.int8)) <= k)[-1])
        for p, k in zip(prefixes, budget)], dtype="Int64")


def tokens_before(prefixes: Column, position: Column) -> Column:
    """Tokens of the first ``position`` characters (all, where there are fewer), from stored differences."""
    return _tokens_before(prefixes, position.cast("long"))


def longest_within(prefixes: Column, budget: Column) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens; null for a negative budget."""
    return _longest_within(prefixes, budget.cast("long"))
