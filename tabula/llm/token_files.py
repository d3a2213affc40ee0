"""Token ids as flat binary files with 64-bit offsets, written and read by Spark tasks.

A folder holds for each part ``part-NNNNN.ids`` (unsigned ids, 16 bits while the vocabulary fits,
little endian, nothing else), ``part-NNNNN.offsets`` (n + 1 signed 64-bit positions within the part)
and ``part-NNNNN.docs`` (n 64-bit document ids, then n bytes that are 0 where the id is null).
Parts follow each other in ascending doc_id. Their bases are prefix sums over the parts, of which
there are as many as tasks wrote, so token number t of the whole corpus is found without reading
anything but offsets. Local files are memory-mapped; elsewhere the ranges are read.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.llm.bpe_automaton import byte_symbols
from tabula.llm.storage import lean_memory, parts_for, shared_folder, slices, small_batches
from tabula.llm.units import OTHER_SPACES, SEPARATORS

#: Units in each of two memos; those still in use move to the younger one.
CACHED_UNITS = 400_000
DOCS_PER_PART = 4_000
#: Mark of a unit that begins a text; no regular text holds it.
_FIRST = SEPARATORS[-1]
_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Ids of whole texts, exactly as the tokenizers library gives them.

    The library splits before white space in any case: a space belongs to the word after it, and a
    line feed between two words stands alone. So a text whose white space is single spaces and single
    line feeds is the sequence of its units, and each distinct unit is encoded by the library once
    and remembered. Any other text goes to the library as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        spec = json.loads(self.library.to_str())
        split = spec["pre_tokenizer"] or {}
        self.by_words = spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        self.symbols = dict(enumerate(byte_symbols()))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [
            np.asarray(e.ids, self.dtype).tobytes()
            for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _make(self, units: list[str]) -> list[bytes]:
        """Ids of units after a space. A line feed, a word of letters and the marks after it are what the library
        splits anyway, so these go to its model at once, and a word that occurs with several marks goes there once;
        other units take the whole way."""
        out: list = [None] * len(units)
        tokens, kind = self.library.model.tokenize, self.dtype.char

        def packed(symbols: str) -> bytes:
            ids = [t.id for t in tokens(symbols)]
            return struct.pack(f"<{len(ids)}{kind}", *ids)

        feed, marks, words = packed("Ċ"), {"": b""}, {}
        for i, unit in enumerate(units if self.by_words else ()):
            first = unit[:1]
            glue = "" if first == _FIRST or first == "\n" else "Ġ"
            whole = unit if glue else unit[1:]
            word = whole if whole.isalpha() else whole.rstrip(string.punctuation)
            if not word.isalpha():
                continue
            known = words.get(glue + word) or (self._known(word) if glue and word is not whole else None)
            if known is None:
                known = packed(glue + (word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.symbols)))
            words[glue + word] = known
            mark = whole[len(word):]
            if mark not in marks:
                marks[mark] = packed(mark)
            out[i] = feed + known + marks[mark] if first == "\n" else known + marks[mark]
        rest = [i for i, ids in enumerate(out) if ids is None]
        texts = [units[i] for i in rest]
        made = self._encode([u[1:] if u[:1] == _FIRST else u if u[:1] == "\n" else " " + u for u in texts])
        for i, ids in zip(rest, made):
            out[i] = ids
        return out

    def _known(self, unit: str) -> bytes | None:
        return self.memo.get(unit) or self.older.get(unit)

    def regular(self, text: str) -> bool:
        if not text or text[0] in " \n" or text[-1] in " \n":
            return False
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return False
        odd = "\t\x0b\x0c\r" + SEPARATORS if text.isascii() else OTHER_SPACES + SEPARATORS
        return not any(c in text for c in odd) and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Texts are cut and their units numbered in Arrow's buffers, so that only distinct units
        become objects; these are looked up together, and unknown ones encoded together."""
        out = [b""] * len(texts)
        known = [bool(text) and self.regular(text) for text in texts]
        own = [i for i, regular in enumerate(known) if regular]
        if own:
            cut = pc.split_pattern(pa.array([_FIRST + texts[i].replace("\n", " \n") for i in own], pa.large_string()), " ")
            units = cut.flatten().dictionary_encode()
            ids = pa.array(self._look_up(units.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(units.indices)
            _, offsets, data = ids.buffers()
            ends = np.frombuffer(offsets, np.int64)[cut.offsets.to_numpy()].tolist()
            for i, begin, end in zip(own, ends, ends[1:]):
                out[i] = data[begin:end].to_pybytes() if data else b""
        odd = [i for i, text in enumerate(texts) if text and not known[i]]
        for i, ids in zip(odd, self._encode([texts[i] for i in odd])):
            out[i] = ids
        return out

    def _look_up(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units, from the memos or made together."""
        if len(self.memo) > CACHED_UNITS:
            self.memo, self.older = {}, self.memo
        found = list(map(self.memo.get, units))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        fresh = []
        for i in gaps:
            found[i] = self.older.get(units[i])
            if found[i] is None:
                fresh.append(i)
        for i, ids in zip(fresh, self._make([units[i] for i in fresh])):
            found[i] = ids
        self.memo.update((units[i], found[i]) for i in gaps)
        return found


def encoder(path: str) -> Encoder:
    """One encoder and its memo for each worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _load(folder: str, name: str, dtype) -> np.ndarray:
    store, path = _open(folder)
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", dtype, "r") if os.path.getsize(f"{path}/{name}") else np.empty(0, dtype)
    with store.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), dtype)


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0) -> list[dict]:
    """Encode ``text`` of every row, end each document with ``end_id``, write the files; one entry per part.

    Null and empty texts hold the end id alone, an empty table gives no files, and texts of any length are encoded
    whole. Rows are ordered by doc_id (nulls first), then by text;
    identical rows are all written. Other columns are ignored. A part is written under a name of its
    attempt and then renamed, so a repeated or lost task leaves whole files only.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = parts_for(spark, docs.count(), DOCS_PER_PART)
    store, path = _open(folder)
    store.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        enc, task = encoder(tokenizer), TaskContext.get()
        store, path = _open(folder)
        end = np.asarray([end_id], enc.dtype).tobytes()
        part, attempt = f"part-{task.partitionId():05d}", task.taskAttemptId()
        width, at, offsets, ids, valid = enc.dtype.itemsize, 0, [0], [], []
        with store.open_output_stream(f"{path}/.{part}-{attempt}.ids") as out:
            for batch in slices(batches, 1):
                data = enc.encode([t or "" for t in batch.column(1).to_pylist()])
                out.write(end.join([*data, b""]))
                for doc_id, own in zip(batch.column(0).to_pylist(), data):
                    at += len(own) // width + 1
                    offsets.append(at)
                    ids.append(doc_id or 0)
                    valid.append(doc_id is not None)
        for kind, data in (
                ("offsets", np.asarray(offsets, "<i8").tobytes()),
                ("docs", np.asarray(ids, "<i8").tobytes() + np.asarray(valid, "u1").tobytes())):
            with store.open_output_stream(f"{path}/.{part}-{attempt}.{kind}") as out:
                out.write(data)
        for kind in ("ids", "offsets", "docs"):
            store.move(f"{path}/.{part}-{attempt}.{kind}", f"{path}/{part}.{kind}")
        yield pa.RecordBatch.from_pydict(
            {"part": [task.partitionId()], "docs": [len(ids)], "tokens": [at], "width": [width]},
            schema=pa.schema([("part", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64()), ("width", pa.int64())]))

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(parts, F.col("doc_id"), F.crc32(F.col("text").cast("binary")))
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(write, "part long, docs long, tokens long, width long"))
    index = sorted((r.asDict() for r in rows.collect()), key=lambda r: r["part"])
    base = 0
    for entry in index:
        entry["base"] = base
        base += entry["tokens"]
    return index


def read_tokens(spark: SparkSession, folder: str, index: list[dict]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and part of every document, from the files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                name = f"part-{entry['part']:05d}"
                n = entry["docs"]
                offsets = np.asarray(_load(folder, f"{name}.offsets", "<i8"))
                raw = _load(folder, f"{name}.docs", "u1")
                doc_ids, valid = np.frombuffer(raw[: 8 * n].tobytes(), "<i8"), np.asarray(raw[8 * n:], bool)
                ids = _load(folder, f"{name}.ids", f"<u{entry['width']}")
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, mask=~valid), pa.array(offsets[:-1] + entry["base"]),
                    pa.array(np.diff(offsets)), pa.array(np.asarray(crc, "i8")),
                    pa.array(np.full(n, entry["part"], "i8"))],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "part"])

    parts = spark.createDataFrame(
        [(e["part"], e["docs"], e["width"], e["base"]) for e in index if e["docs"]],
        "part long, docs long, width long, base long").repartition(max(1, len(index)))
    return parts.mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, part long")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the files of ``docs`` below the shared folder and describe them by reading them back."""
    folder = shared_folder(docs.sparkSession, "tokens")
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, tokenizer, folder, end_id))
