"""Removal of byte strings that also start in a document with a smaller id, by distributed suffix sorting.

Whole texts are cut into chunks, one or more for each input partition, which are written once to the shared
folder with all columns. Every window of ``width`` bytes has an anchor, the leftmost smallest hash of its
half-width grams; equal windows have equal anchors at equal offsets, so windows of different
anchors never need to be compared. The plan, each step a Spark stage:

1. chunk -> shards: the distinct anchors of the chunk (five bytes each), and hashes of whole texts;
2. shard: anchors that occur in two different texts; texts that are copies of a smaller id's;
3. chunk -> shards: the stretches (contexts) around these anchors, each distinct one once, with its smallest id. An anchor with very
   many of them is split window by window, so that no shard gathers a hot passage;
4. shard: contexts of one anchor in several variants are laid out as one text and suffix-sorted by external induced sorting
   (:mod:`tabula.llm.induced_sorting`); neighbours that share ``width`` bytes form classes, and a
   window is a repeat where its class starts in a smaller id. A context without variants repeats as a whole;
5. chunk: the answers become byte masks of the documents.

Anchors are compared by 40-bit and texts by 128-bit hashes; the former only select what is sorted. Everything that leaves a
chunk is deduplicated within it, so a passage in a third of all documents costs one entry per chunk.
"""

from __future__ import annotations

import hashlib
import io
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.induced_sorting import common_prefixes, suffix_order
from tabula.llm.storage import parts_for, read_file, save_file, shared_folder, slices, small_batches, spare_memory
from tabula.llm.textnum import mix, powers

_U = np.uint64
WIDTH = 50
CHUNK_BYTES = 12_000_000
#: Bytes of text for each shard.
SHARD_BYTES = 13_000_000
#: Bytes of contexts that are sorted together; the contexts of one anchor are never parted.
SORT_BYTES = 2_000_000
#: Contexts whose bytes or windows are laid out at a time.
BLOCK = 50_000
#: Bytes of documents whose windows are hashed, or whose bytes are masked, at a time.
GROUP_BYTES = 250_000
#: Bytes of the batches in which tables of binary rows leave a worker.
ROW_BYTES = 1_000_000
#: Chunks that hold one anchor beyond which its contexts are split into single windows.
HOT = 200
_LOW = _U((1 << 40) - 1)
_BASE = _U(0x5851F42D4C957F2D)
_INVERSE = _U(pow(0x5851F42D4C957F2D, -1, 1 << 64))


def _pack(values: np.ndarray) -> bytes:
    """Values below 2**40 in five bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def anchors(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, number of windows, hash of the anchor's gram."""
    gram = width // 2
    span = width - gram + 1
    total = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers(_BASE, len(data)), out=total[1:])
    value = mix((total[gram:] - total[:-gram]) * powers(_INVERSE, len(data) + 1)[: len(data) - gram + 1])
    least, at, reach = value, np.arange(len(value), dtype=np.int32), 1
    while reach < span:
        step = min(reach, span - reach)
        keep = least[:-step] <= least[step:]
        least, at = np.where(keep, least[:-step], least[step:]), np.where(keep, at[:-step], at[step:])
        reach += step
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return first, np.diff(np.append(first, len(at))), value[at[first]]


class _Chunk:
    """Documents of a chunk as bytes, and the anchored runs of windows that lie within one of them."""

    def __init__(self, table: pa.Table, width: int):
        self.table, self.width = table, width
        self.ids = table["__id"].to_pylist()
        # the texts stay in Arrow's buffer; null texts have no bytes there once they are filled
        text = pc.fill_null(pa.concat_arrays(table["__text"].cast(pa.large_string()).chunks), "")
        _, offsets, data = text.buffers()
        borders = np.frombuffer(offsets, np.int64)[text.offset: text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        self.borders = borders - borders[0]
        self.data = np.frombuffer(data, np.uint8)[borders[0]: borders[-1]] if data else np.empty(0, np.uint8)

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, i: int) -> bytes:
        return self.data[self.borders[i]: self.borders[i + 1]].tobytes()

    def size(self, i: int) -> int:
        return int(self.borders[i + 1] - self.borders[i])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, first window, number of windows and anchor of every run; documents without an id have none."""
        starts, counts, keys, docs = [], [], [], []
        group, size = [], 0
        usable = np.asarray([x is not None for x in self.ids])
        for i in range(len(self) + 1):
            if i < len(self):
                if self.size(i) >= self.width and self.ids[i] is not None:
                    group.append(i)
                    size += self.size(i)
                if size < GROUP_BYTES:
                    continue
            if group:
                a, b = self.borders[group[0]], self.borders[group[-1] + 1]
                first, many, key = anchors(self.data[a:b], self.width)
                first = first + a
                # windows that cross a border, or lie in texts that take no part, are cut away
                low = np.searchsorted(self.borders, first, side="right") - 1
                cut = self.borders[1:][low] - self.width
                inside = np.minimum(many, cut - first + 1)
                keep = inside > 0
                rest = many > np.maximum(inside, 0)
                s, n, k = [first[keep]], [inside[keep]], [key[keep]]
                for j in np.flatnonzero(rest):  # a run that goes on in the next documents
                    stop = first[j] + many[j]
                    d = low[j] + 1
                    while d < len(self) and self.borders[d] < stop:
                        n_here = min(stop, self.borders[d + 1] - self.width + 1) - self.borders[d]
                        if n_here > 0:
                            s.append(np.asarray([self.borders[d]]))
                            n.append(np.asarray([n_here]))
                            k.append(key[j: j + 1])
                        d += 1
                s, n, k = np.concatenate(s), np.concatenate(n), np.concatenate(k)
                order = np.argsort(s, kind="stable")
                s, n, k = s[order], n[order], k[order]
                d = np.searchsorted(self.borders, s, side="right") - 1
                keep = usable[d]
                starts.append(s[keep])
                counts.append(n[keep])
                keys.append(k[keep])
                docs.append(d[keep])
            group, size = [], 0
        if not starts:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, _U))
        out = []
        for parts in (docs, starts, counts, keys):
            out.append(np.concatenate(parts))
            parts.clear()
        return tuple(out)


def _text_hash(chunk: _Chunk) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.md5(chunk.text(i)).digest() for i in range(len(chunk))), "<u8").reshape(-1, 2)


def _pack_runs(start: np.ndarray, many: np.ndarray, number: np.ndarray) -> bytes:
    """Runs in ascending order, as differences: two bytes a run instead of 32; documents follow from the borders."""
    sink = io.BytesIO()
    pq.write_table(
        pa.table({"start": start, "many": many, "number": number}), sink,
        compression="zstd", use_dictionary=False, column_encoding="DELTA_BINARY_PACKED")
    return sink.getvalue()


def _unpack_runs(data: bytes) -> tuple[np.ndarray, ...]:
    return tuple(column.to_numpy() for column in pq.read_table(io.BytesIO(data)).columns)


def _split(shard: np.ndarray) -> list[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    keys, starts = np.unique(shard[order], return_index=True)
    return list(zip(keys.tolist(), np.split(order, starts[1:]))) if len(order) else []


def _seen_twice(key: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorting order, group number of each sorted row, and for each group whether it holds two different texts."""
    order = np.lexsort((text, key))
    k, t = key[order], text[order]
    fresh = np.append(True, k[1:] != k[:-1]) if len(k) else np.empty(0, bool)
    group = np.cumsum(fresh) - 1
    starts = np.flatnonzero(fresh)
    stops = np.append(starts[1:], len(k)) - 1
    return order, group, t[starts] != t[stops] if len(k) else np.empty(0, bool)


def _cut_out(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``data`` laid end to end, copied in blocks."""
    ends = np.cumsum(sizes)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for at in range(0, len(sizes), BLOCK):
        n = sizes[at: at + BLOCK]
        low, high = int(ends[at] - sizes[at]), int(ends[at + len(n) - 1])
        flat[low:high] = data[np.repeat(begin[at: at + BLOCK] - np.cumsum(n) + n, n) + np.arange(high - low)]
    return flat


def _distinct(flat: np.ndarray | bytes, sizes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For strings laid end to end: the number of each, by first appearance, and the distinct strings."""
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    strings = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    found = strings.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def classes_of(contexts: list[bytes], windows: np.ndarray, width: int) -> np.ndarray:
    """A class number for every window of every context: equal windows, and only they, have equal numbers."""
    lengths = np.asarray([len(c) for c in contexts])
    text = np.zeros(int(lengths.sum() + len(contexts)) + 1, np.uint16)
    begins = np.cumsum(np.append(0, lengths + 1))[:-1]
    where = np.repeat(begins - np.append(0, np.cumsum(lengths))[:-1], lengths) + np.arange(lengths.sum())
    text[where] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.uint16) + 2
    text[begins + lengths] = 1
    with tempfile.TemporaryDirectory() as folder:
        order = suffix_order(text, folder)
    same = common_prefixes(text, order, width)
    number = np.empty(len(text), np.int64)
    number[order] = np.cumsum(~same)
    at = np.repeat(begins, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return number[at]


_ROW = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())])
_DDL = "shard long, chunk long, kind int, a binary, b binary, c binary, d binary"


def _rows(rows: list[tuple]) -> pa.Table:
    """A table of ``rows`` in chunks of bounded bytes, so that neither side of the pipe to Spark holds all of it once more."""
    chunks, held, filled = [], [], 0
    for at, row in enumerate(rows, 1):
        held.append(row)
        filled += sum(len(x) for x in row[3:] if x is not None)
        if filled >= ROW_BYTES or at == len(rows):
            chunks.append(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ROW)], schema=_ROW))
            held, filled = [], 0
    return pa.Table.from_batches(chunks, _ROW)


def remove_repeats(docs: DataFrame, carry: list[str], width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """``carry`` columns of every row of ``docs``, then kept_text, n_bytes, n_removed, n_spans, kept_sha256.

    ``kept_text`` is what remains, without the bytes of characters that were cut in two, or null where the
    text is null; the digest is of all remaining bytes.

    Reads ``doc_id`` and ``text``. A byte goes if a ``width``-byte string over it also starts in a row
    with a smaller doc_id; strings are judged on the input. Null texts count as empty; rows with a null doc_id keep all and
    are no source; rows of one doc_id do not remove each other's bytes; texts shorter than ``width``
    bytes stay whole. ``carry`` may name any columns of ``docs`` but those added here.
    """
    spark = docs.sparkSession
    small_batches(spark, 500, 2 << 20)
    folder = shared_folder(spark, "suffix-chunks")
    shards = parts_for(spark, docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, SHARD_BYTES)
    given = docs.select(
        *[f"`{c}`" for c in carry], docs["doc_id"].cast("long").alias("__id"), docs["text"].alias("__text"))
    carried = given.schema.fields[: len(carry)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spare_memory()
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, held, size
            chunk = (part << 20) + number
            table = pa.Table.from_batches(held).combine_chunks()
            sink = io.BytesIO()
            pq.write_table(table, sink, compression="zstd")
            save_file(folder, f"chunk-{chunk}", sink.getvalue())
            sink, held = None, []
            yield from _keys(_Chunk(table, width), chunk).to_batches()
            number, size = number + 1, 0
            spare_memory()

        for some in slices(batches, len(carry) + 1, 1_000_000):
            held.append(some)
            size += pc.sum(pc.binary_length(some.column(len(carry) + 1))).as_py() or 0
            if size >= CHUNK_BYTES:
                yield from flush()
        if held:
            yield from flush()

    def _keys(chunk: _Chunk, name: int) -> pa.Table:
        doc, key = chunk.runs()[::3]
        text = _text_hash(chunk)
        long_enough = np.flatnonzero([chunk.size(j) >= width and i is not None for j, i in enumerate(chunk.ids)])
        rows = [(-1, name, 0, None, None, None, None)]
        ids = np.asarray([i or 0 for i in chunk.ids], np.int64)
        for shard, at in _split((text[long_enough, 0] % _U(shards)).astype(np.int64)):
            own = long_enough[at]
            rows.append((shard, name, 1, text[own].tobytes(), ids[own].tobytes(), own.astype("<i4").tobytes(), None))
        # one entry for each anchor of the chunk; those of two texts in it are known to repeat already
        order, group, many = _seen_twice(key, text[doc, 0])
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        own, of = key[order[starts]], doc[order[starts]]
        del order, group, key, doc
        by_doc = np.argsort(of, kind="stable")
        own, of, many = own[by_doc], of[by_doc], many[by_doc]
        for shard, at in _split(((own >> _U(40)) % _U(shards)).astype(np.int64)):
            which, first = np.unique(of[at], return_index=True)
            sizes = np.diff(np.append(first, len(at)))
            rows.append((
                shard, name, 2, _pack(own[at] & _LOW), np.packbits(many[at]).tobytes(),
                text[which, 0].tobytes(), sizes.astype("<u4").tobytes()))
        return _rows(rows)

    def repeated(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table
        spare_memory()
        rows, found = table.to_pylist(), []
        texts = [r for r in rows if r["kind"] == 1]
        if texts:
            chunk = np.repeat([r["chunk"] for r in texts], [len(r["c"]) // 4 for r in texts])
            code = np.frombuffer(b"".join(r["a"] for r in texts), "<u8").reshape(-1, 2)
            ids = np.frombuffer(b"".join(r["b"] for r in texts), "<i8")
            place = np.frombuffer(b"".join(r["c"] for r in texts), "<i4")
            order = np.lexsort((ids, code[:, 1], code[:, 0]))
            fresh = np.append(True, (code[order][1:] != code[order][:-1]).any(axis=1))
            least = ids[order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            copies = order[ids[order] > least]
            for name, at in _split(chunk[copies]):
                found.append((0, name, 1, place[copies[at]].tobytes(), None, None, None))
        grams = [r for r in rows if r["kind"] == 2]
        del texts
        if grams:
            sizes = [len(r["a"]) // 5 for r in grams]
            chunk = np.repeat([r["chunk"] for r in grams], sizes)
            value = np.concatenate([_unpack(r["a"]) for r in grams])
            known = np.concatenate([np.unpackbits(np.frombuffer(r["b"], np.uint8))[:n] for r, n in zip(grams, sizes)]).astype(bool)
            text = np.concatenate([np.repeat(np.frombuffer(r["c"], "<u8"), np.frombuffer(r["d"], "<u4")) for r in grams])
            del rows, grams, table
            order, group, many = _seen_twice(value, text)
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            if len(starts):
                many = many | np.logical_or.reduceat(known[order], starts)
                wide = np.diff(np.append(starts, len(order))) > hot
                hit = order[many[group]]
                for name, at in _split(chunk[hit]):
                    own = hit[at]
                    is_hot = np.isin(value[own], value[order[starts[wide]]]) if wide.any() else np.zeros(len(own), bool)
                    found.append((0, name, 2, _pack(value[own]), np.packbits(is_hot).tobytes(), np.asarray([key[0].as_py()], "<i8").tobytes(), None))
        return _rows(found)

    def stretches(key: tuple, table: pa.Table) -> pa.Table:
        spare_memory()
        name, rows = key[0].as_py(), table.to_pylist()
        chunk = _Chunk(pq.read_table(io.BytesIO(read_file(folder, f"chunk-{name}"))), width)
        copies = np.zeros(len(chunk), bool)
        keys, heat = [np.empty(0, _U)], [np.empty(0, bool)]
        for r in rows:
            if r["kind"] == 1:
                copies[np.frombuffer(r["a"], "<i4")] = True
            if r["kind"] == 2:
                own = _unpack(r["a"])
                keys.append(own + (_U(np.frombuffer(r["c"], "<i8")[0]) << _U(40)))
                heat.append(np.unpackbits(np.frombuffer(r["b"], np.uint8))[: len(own)].astype(bool))
        keys, heat = np.concatenate(keys), np.concatenate(heat)
        by_key = np.argsort(keys)
        keys, heat = keys[by_key], heat[by_key]
        doc, start, many, anchor = chunk.runs()
        code = (anchor & _LOW) + ((anchor >> _U(40)) % _U(shards) << _U(40))
        place = np.minimum(np.searchsorted(keys, code), max(0, len(keys) - 1))
        take = (keys[place] == code) & ~copies[doc] if len(keys) else np.zeros(len(code), bool)
        doc, start, many, anchor, place = doc[take], start[take], many[take], anchor[take], place[take]
        split = heat[place] if len(place) else np.zeros(0, bool)
        if split.any():  # each window of a hot anchor is a context of its own
            each = np.where(split, many, 1)
            shift = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            doc, anchor, split = np.repeat(doc, each), np.repeat(anchor, each), np.repeat(split, each)
            start = np.repeat(start, each) + shift
            many = np.where(split, 1, np.repeat(many, each))
        ids = np.asarray([i or 0 for i in chunk.ids], np.int64)
        order = np.argsort(ids[doc], kind="stable")
        sizes = (many + width - 1)[order]
        found, stretch = _distinct(_cut_out(chunk.data, start[order], sizes), sizes)
        number = np.empty(len(doc), np.int64)
        number[order] = found
        firsts = order[np.unique(found, return_index=True)[1]]
        save_file(folder, f"runs-{name}", _pack_runs(start, many, number))
        save_file(folder, f"copies-{name}", np.packbits(copies).tobytes())
        length = pc.binary_length(stretch).to_numpy()
        key_of = anchor[firsts] if len(firsts) else np.empty(0, _U)
        for j in np.flatnonzero(split[firsts]) if len(firsts) else ():
            key_of[j] = np.frombuffer(hashlib.md5(stretch[j].as_py()).digest(), "<u8")[0]
        out = [(-1, name, 0, None, None, None, None)]
        for shard, at in _split((mix(key_of) % _U(shards)).astype(np.int64)):
            out.append((
                shard, name, 3, b"".join(stretch.take(pa.array(at)).to_pylist()), length[at].astype("<u2").tobytes(),
                np.stack([key_of[at].view(np.int64), ids[doc[firsts[at]]]]).astype("<i8").tobytes(), at.astype("<i4").tobytes()))
        return _rows(out)

    def sorted_out(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table
        spare_memory()
        rows = table.to_pylist()
        sizes, chunk, number, keys, ids = [], [], [], [], []
        for r in rows:
            n = np.frombuffer(r["b"], "<u2")
            sizes.append(n)
            chunk.append(np.full(len(n), r["chunk"]))
            number.append(np.frombuffer(r["d"], "<i4"))
            pair = np.frombuffer(r["c"], "<i8").reshape(2, -1)
            keys.append(pair[0])
            ids.append(pair[1])
        sizes, chunk, number, keys, ids = map(np.concatenate, (sizes, chunk, number, keys, ids))
        # copies of a context meet here: one entry each, with the smallest id
        same, text = _distinct(b"".join(r["a"] for r in rows), sizes)
        del rows, table
        least = np.full(len(text), np.iinfo(np.int64).max)
        np.minimum.at(least, same, ids)
        first = np.unique(same, return_index=True)[1]
        windows = pc.binary_length(text).to_numpy() - width + 1
        _, of_key, variants = np.unique(keys[first], return_inverse=True, return_counts=True)
        several = np.flatnonzero(variants[of_key] > 1)
        begin = np.cumsum(windows) - windows
        earliest = np.repeat(least, windows)
        several = several[np.argsort(of_key[several], kind="stable")]
        filled = np.cumsum(windows[several] + width - 1)
        borders = np.flatnonzero(np.diff(of_key[several], prepend=-1))
        cuts, last = [], 0
        for border in borders[1:].tolist():
            if filled[border - 1] - last >= SORT_BYTES:
                cuts.append(border)
                last = filled[border - 1]
        for some in np.split(several, cuts):
            if not len(some):
                continue
            group = classes_of(text.take(pa.array(some)).to_pylist(), windows[some], width)
            flat = np.repeat(begin[some], windows[some]) + np.arange(windows[some].sum()) - np.repeat(
                np.cumsum(windows[some]) - windows[some], windows[some])
            best = np.full(group.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(best, group, earliest[flat])
            earliest[flat] = best[group]
        out = []
        mask_of = np.zeros(len(ids), "<u4")
        for at in range(0, len(ids), BLOCK):
            own = same[at: at + BLOCK]
            n = windows[own]  # at least one each
            starts = np.cumsum(n) - n
            bit = np.arange(n.sum()) - np.repeat(starts, n)
            early = earliest[np.repeat(begin[own], n) + bit] < np.repeat(ids[at: at + BLOCK], n)
            mask_of[at: at + BLOCK] = np.bitwise_or.reduceat(np.where(early, 1 << bit, 0), starts)
        hit = np.flatnonzero(mask_of)
        for name, own in _split(chunk[hit]):
            out.append((0, name, 4, number[hit[own]].tobytes(), mask_of[hit[own]].tobytes(), None, None))
        return _rows(out)

    def apply(key: tuple, table: pa.Table) -> pa.Table:
        spare_memory()
        name = key[0].as_py()
        chunk = _Chunk(pq.read_table(io.BytesIO(read_file(folder, f"chunk-{name}"))), width)
        start, many, number = _unpack_runs(read_file(folder, f"runs-{name}"))
        doc = np.searchsorted(chunk.borders, start, side="right") - 1
        copies = np.unpackbits(np.frombuffer(read_file(folder, f"copies-{name}"), np.uint8))[: len(chunk)].astype(bool)
        masks = np.zeros(int(number.max()) + 1 if len(number) else 0, np.int64)
        for r in table.to_pylist():
            if r["kind"] == 4:
                masks[np.frombuffer(r["a"], "<i4")] = np.frombuffer(r["b"], "<u4")
        ids = np.asarray([i or 0 for i in chunk.ids], np.int64)
        # ids ascend within a number: the first holds the mask, a larger id repeats all of the context
        least = np.full(len(masks), np.iinfo(np.int64).max)
        np.minimum.at(least, number, ids[doc])
        mask = np.where(ids[doc] > least[number], (1 << many) - 1, masks[number]) if len(number) else np.empty(0, np.int64)
        whole, absent, low = [], pc.is_null(chunk.table["__text"]).to_pylist(), 0
        while low < len(chunk):  # the runs ascend by place, so some documents at a time have theirs side by side
            base = int(chunk.borders[low])
            high = max(low + 1, int(np.searchsorted(chunk.borders, base + GROUP_BYTES, side="right")) - 1)
            first, last = np.searchsorted(start, chunk.borders[[low, high]])
            edge = np.zeros(int(chunk.borders[high]) - base + 1, np.int32)
            for bit in range(int(many[first:last].max()) if last > first else 0):
                begin = start[first:last][(mask[first:last] >> bit & 1).astype(bool)] + (bit - base)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + width, -1)
            gone = np.cumsum(edge[:-1]) > 0
            for i in range(low, high):
                a, b = chunk.borders[i], chunk.borders[i + 1]
                lost = np.ones(b - a, bool) if copies[i] else gone[a - base: b - base]
                kept = chunk.text(i) if not lost.any() else chunk.data[a:b][~lost].tobytes()
                spans = int(lost[:1].sum() + (lost[1:] & ~lost[:-1]).sum())
                whole.append((
                    None if absent[i] else kept.decode("utf-8", "ignore"), int(b - a), int(b - a) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            low = high
        columns = list(zip(*whole)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        made = pa.Table.from_arrays(
            [*chunk.table.columns[: len(carry)], *[pa.array(c, k) for c, k in zip(columns, kinds)]],
            names=[*carry, "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        return pa.Table.from_batches(
            [some for batch in made.combine_chunks().to_batches() for some in slices([batch], len(carry), ROW_BYTES)], made.schema)

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in carried)
    return (
        given.mapInArrow(cut, _DDL)
        .groupBy("shard").applyInArrow(repeated, _DDL)
        .groupBy("chunk").applyInArrow(stretches, _DDL)
        .groupBy("shard").applyInArrow(sorted_out, _DDL)
        .groupBy("chunk").applyInArrow(
            apply, kinds + "kept_text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))
