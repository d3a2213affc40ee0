"""Near-duplicate classes with DartMinHash signatures, banded joining and exact verification.

A text is a weighted set of word shingles. Darts fall on the plane (weight, rank) of each element,
one per unit of area on average, at places that only the element decides; a dart hits a text if it falls below
the element's weight in that text. Each dart carries a coordinate, and for each coordinate the
text keeps its earliest (lowest-ranked) dart. Two texts agree in a coordinate with a probability equal
to their weighted Jaccard similarity. Darts are thrown only up to the rank that fills all
coordinates, about ``k ln k + 2k`` hits a text however many elements it has; texts with a gap go on to twice the rank.

The plan: exact copies fold into one representative; signatures are cut into bands; within a band's
bucket texts are linked to its centre (the text with most copies), not to each other; links are
verified on whole shingle sets. Where a bucket still falls into several components, the texts outside
its main component are compared with those of other components, where both have one of the rare elements by which
similar sets must meet (an exact bound: variants of one text with many edits of their own are not paired). Classes are the components.

Texts are never shuffled. The task that signs them writes them in chunks to the shared folder; later steps send ids to a
chunk, which is read by one task. A chunk carries the name of the attempt that wrote it, and so do the rows that point to it.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabula.llm.components import components
from tabula.llm.storage import lean_memory, parts_for, read_file, save_file, shared_folder, small_batches, stored
from tabula.llm.textnum import mix, shingles, words

_U = np.uint64
WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
CHUNK_BYTES = 6_000_000
#: Lower borders and widths of the first rank cells of a region, in units of 1 / its weight span.
_CELLS = [(0.0, 0.25), (0.25, 0.25), (0.5, 0.5)]
_TAIL = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> _U(11)).astype(np.float64) * 2.0**-53


def _throw(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, limit: np.ndarray, k: int, best: np.ndarray) -> None:
    """Lower ``best`` (owner x k) to the ranks of all darts below ``weight`` and below the owner's ``limit``."""
    region = 0
    while len(element):
        low, span = (0.0, 1.0) if region == 0 else (2.0 ** (region - 1), 2.0 ** (region - 1))
        cell = 0
        while True:
            bottom, height = _CELLS[cell] if cell < 3 else (float(cell - 2), 1.0)
            here = np.flatnonzero(limit[owner] * span > bottom)
            if not len(here):
                break
            key = mix(element[here] + _U((region * 1_000_003 + cell + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            u = _unit(key)
            if height == 1.0:
                many = np.searchsorted(_TAIL, u, side="right")
            else:
                many = np.searchsorted(np.cumsum(np.exp(-height) * height ** np.arange(8) / np.cumprod([1.0, *range(1, 8)])), u, side="right")
            hit = np.flatnonzero(many)
            if len(hit):
                times = many[hit]
                at, base = np.repeat(here[hit], times), np.repeat(key[hit], times)
                turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                a = mix(base + (turn.astype(_U) + _U(1)) * _U(0xD1B54A32D192ED03))
                b = mix(a ^ _U(0xA0761D6478BD642F))
                rank = (bottom + _unit(b) * height) / span
                hits = (low + _unit(a) * span < weight[at]) & (rank < limit[owner[at]])
                slot = owner[at] * k + (mix(b) % _U(k)).astype(np.int64)
                np.minimum.at(best, slot[hits], rank[hits])
            cell += 1
        region += 1
        rest = weight > 2.0 ** (region - 1)
        element, weight, owner = element[rest], weight[rest], owner[rest]


def signatures(element: np.ndarray, weight: np.ndarray, borders: np.ndarray, k: int) -> np.ndarray:
    """One row of k 64-bit values for each weighted set; sets without weight get all ones."""
    n = len(borders) - 1
    owner = np.repeat(np.arange(n), np.diff(borders))
    total = np.bincount(owner, weight, minlength=n)
    # decides how far darts are thrown, never where they fall
    limit = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    best = np.full(n * k, np.inf)
    open_ = total > 0
    while open_.any():
        some = open_[owner]
        _throw(element[some], weight[some], owner[some], limit, k, best)
        table = best.reshape(n, k)
        open_ = open_ & np.isinf(table).any(axis=1)
        limit = np.where(open_, 2 * limit, limit)
    return best.reshape(n, k).view(np.uint64)


def weighted_shingles(texts: list[str], width: int, counted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, their weights (occurrences, or 1 each) and the borders of the texts."""
    hashes, borders = shingles(*words(texts), width)
    sets, weights = [], []
    for a, b in zip(borders[:-1], borders[1:]):
        distinct, times = np.unique(hashes[a:b], return_counts=True)
        sets.append(distinct)
        weights.append(times.astype(float) if counted else np.ones(len(distinct)))
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, _U)), (np.concatenate(weights) if weights else np.empty(0)), ends


def _signed(texts: list[str], width: int, counted: bool, bands: int, rows: int) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Places of the texts with a word, the hashes of their word sequences, and their band keys."""
    hashes, borders = words(texts)
    full = np.flatnonzero(np.diff(borders))
    copies = []
    for i in full:
        h = hashes[borders[i]: borders[i + 1]]
        at = np.arange(1, len(h) + 1, dtype=_U)
        one, other = np.sum(mix(h + at * _U(0xC2B2AE3D27D4EB4F))), np.sum(mix(h ^ (at * _U(0x9E3779B97F4A7C15))))
        copies.append(f"{int(one):016x}{int(other):016x}")
    key = np.zeros((len(full), bands), _U)
    if len(full):
        element, weight, ends = weighted_shingles([texts[i] for i in full], width, counted)
        table = signatures(element, weight, ends, bands * rows).reshape(len(full), bands, rows)
        for j in range(rows):
            key = mix(key * _U(0x9E3779B97F4A7C15) + table[:, :, j])
        key = mix(key + np.arange(1, bands + 1, dtype=_U) * _U(0xD1B54A32D192ED03))
    return full, copies, key


class _Corpus:
    """Rows in chunks in the shared folder, and the table that points to them.

    ``sketch`` has a row for every row of ``docs``: doc_id, chunk, and where the text has a word copy (hash of the
    word sequence) and bands.
    """

    def __init__(self, docs: DataFrame, carry: list[str], width: int, counted: bool, bands: int, rows: int):
        spark = docs.sparkSession
        folder = shared_folder(spark, "texts")
        own = [] if "text" in carry else [docs["text"].alias("__text")]
        text = carry.index("text") if "text" in carry else len(carry) + 1
        given = docs.select(*[docs[c] for c in carry], docs["doc_id"].cast("long").alias("__id"), *own)
        self.spark, self.folder, self.text, self.carry, self.width, self.counted = spark, folder, text, carry, width, counted
        self.schema = docs.select(*[docs[c] for c in carry]).schema
        size = len(carry)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lean_memory()
            task, number, held, filled = TaskContext.get(), 0, [], 0

            def flush() -> Iterator[pa.RecordBatch]:
                name, table, sink = f"{task.partitionId()}-{number}-{task.taskAttemptId()}", pa.Table.from_batches(held), io.BytesIO()
                pq.write_table(table, sink, compression="zstd")
                save_file(folder, name, sink.getvalue())
                for part in held:
                    n = part.num_rows
                    full, copies, key = _signed([t or "" for t in part.column(text).to_pylist()], width, counted, bands, rows)
                    copy, band = [None] * n, [None] * n
                    for i, c, k in zip(full.tolist(), copies, key.view(np.int64)):
                        copy[i], band[i] = c, k
                    yield pa.RecordBatch.from_arrays([
                        part.column(size), pa.array([name] * n, pa.string()), pa.array(copy, pa.string()),
                        pa.array(band, pa.list_(pa.int64()))], names=["doc_id", "chunk", "copy", "bands"])

            for batch in batches:
                for some in range(0, batch.num_rows, 100):
                    held.append(batch.slice(some, 100))
                    filled += pc.sum(pc.binary_length(held[-1].column(text))).as_py() or 0
                    if filled >= CHUNK_BYTES:
                        yield from flush()
                        number, held, filled = number + 1, [], 0
            if held:
                yield from flush()

        self.sketch = stored(given.mapInArrow(run, "doc_id long, chunk string, copy string, bands array<long>"), "sketches")
        self.parts = parts_for(spark, self.sketch.select("chunk").distinct().count(), 4)

    def _sent(self, ids: DataFrame) -> DataFrame:
        """chunk, id for every row whose doc_id is one of ``ids``."""
        return self.sketch.select(F.col("doc_id").alias("id"), "chunk").join(ids, "id", "left_semi").distinct()

    def sets(self, ids: DataFrame) -> DataFrame:
        """Shingle sets (id, elements, weights) of the texts named by ``ids``, written once."""
        folder, text, size, width, counted = self.folder, self.text, len(self.carry), self.width, self.counted

        def run(key: tuple, sent: pa.Table) -> pa.Table:
            lean_memory()
            table = pq.read_table(io.BytesIO(read_file(folder, key[0].as_py())))
            table = table.filter(pc.and_(pc.is_in(table.column(size), sent["id"].combine_chunks()), pc.is_valid(table.column(text))))
            parts = [pa.table({"id": pa.array([], pa.int64()), "elements": pa.array([], pa.binary()), "weights": pa.array([], pa.binary())})]
            for some in range(0, table.num_rows, 250):
                part = table.slice(some, 250)
                element, weight, ends = weighted_shingles(part.column(text).to_pylist(), width, counted)
                parts.append(pa.table({
                    "id": part.column(size),
                    "elements": pa.array([element[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                    "weights": pa.array([weight[a:b].astype(np.float32).tobytes() if counted else b"" for a, b in zip(ends[:-1], ends[1:])], pa.binary())}))
            return pa.concat_tables(parts)

        sent = self._sent(ids).repartition(self.parts, "chunk")
        return stored(sent.groupBy("chunk").applyInArrow(run, "id long, elements binary, weights binary"), "sets")

    def without(self, ids: DataFrame) -> DataFrame:
        """The carried columns of all rows but those whose doc_id is one of ``ids``."""
        folder, size, carry = self.folder, len(self.carry), self.carry

        def run(key: tuple, sent: pa.Table) -> pa.Table:
            lean_memory()
            table = pq.read_table(io.BytesIO(read_file(folder, key[0].as_py())))
            gone = pc.is_in(table.column(size), sent["id"].combine_chunks().drop_null())
            return table.filter(pc.invert(gone)).select(list(range(size))).rename_columns(carry)

        every = self.sketch.select(F.lit(None).cast("long").alias("id"), "chunk").distinct()
        sent = self._sent(ids).unionByName(every).repartition(self.parts, "chunk")
        return sent.groupBy("chunk").applyInArrow(run, self.schema)


def _similarity(a: bytes, wa: bytes, b: bytes, wb: bytes) -> float:
    x, y = np.frombuffer(a, _U), np.frombuffer(b, _U)
    common, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not wa:
        return len(common) / max(1, len(x) + len(y) - len(common))
    u, v = np.frombuffer(wa, np.float32).astype(float), np.frombuffer(wb, np.float32).astype(float)
    both = np.minimum(u[i], v[j]).sum()
    return both / max(1e-300, u.sum() + v.sum() - both)


def _elements(sets: DataFrame) -> DataFrame:
    """One row for each element of each set: id, element, its weight there, and the weight of the whole set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in batches:
            for i in range(batch.num_rows):
                elements = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                given = np.frombuffer(batch.column(2)[i].as_buffer(), np.float32).astype(float)
                weight = given if len(given) else np.ones(len(elements))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(elements), batch.column(0)[i].as_py())), pa.array(elements), pa.array(weight),
                    pa.array(np.full(len(elements), weight.sum()))], names=["id", "element", "weight", "total"])

    return sets.select("id", "elements", "weights").mapInArrow(run, "id long, element long, weight double, total double")


def _rare_elements(sets: DataFrame, least: float) -> DataFrame:
    """id, element, own, partner: the elements by which a set can be found by a similar one.

    Elements are ordered from rare to frequent. Two sets of weights p and q that are similar enough share
    a weight of at least ``least / (1 + least) * (p + q)``, so the first element they share must have that much
    weight from it onwards in both. ``own`` and ``partner`` are steps of the weights (by 2 %) of the set and of
    those that it can still match by this element; elements of one set alone match nothing.
    """
    elements = _elements(sets)
    seen = elements.groupBy("element").agg(F.count(F.lit(1)).alias("n_sets")).where("n_sets > 1")
    onwards = Window.partitionBy("id").orderBy(F.desc("n_sets"), F.desc("element")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rest = elements.join(seen, "element").withColumn("rest", F.sum("weight").over(onwards))

    def step(weight: Column) -> Column:
        return F.floor(F.log(weight) / float(np.log(1.02))).cast("int")

    low, high = F.col("total") * least, F.col("rest") * ((1 + least) / least) - F.col("total")
    return rest.where(high >= low * (1 - 1e-9)).select(
        "id", "element", step(F.col("total")).alias("own"),
        F.explode(F.sequence(step(low * (1 - 1e-9)), step(F.greatest(low, high) * (1 + 1e-9)))).alias("partner"))


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("ea"), F.col("weights").alias("wa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("elements").alias("eb"), F.col("weights").alias("wb")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in batches:
            a, b, ea, wa, eb, wb = (batch.column(c) for c in ("a", "b", "ea", "wa", "eb", "wb"))
            keep = [
                _similarity(*(memoryview(c[i].as_buffer()) for c in (ea, wa, eb, wb))) >= least - 1e-9 for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))

    return stored(both.select("a", "b", "ea", "wa", "eb", "wb").mapInArrow(run, "a long, b long"), "pairs")


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, least: float = SIMILARITY, counted: bool = False, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """doc_id, class_id, n_members of every row of ``docs``: near-duplicate classes.

    ``class_id`` is the smallest doc_id of the class. Similarity is the Jaccard similarity of the sets of
    ``width``-word shingles (lower case, cut at white space), or of their multisets if ``counted``; a
    text of fewer words is one shingle. Null, empty and blank texts and rows with a null doc_id are
    alone in their class (a null doc_id has a null class). Rows of one doc_id are one member with the
    texts of all of them. Other columns are ignored.
    """
    small_batches(docs.sparkSession, 500)
    corpus = _Corpus(docs, [], width, counted, bands, rows)
    classes = _classes(corpus, least)
    sized = classes.join(classes.groupBy("root").agg(F.count(F.lit(1)).alias("n_members")), "root")
    return (
        corpus.sketch.select("doc_id").join(sized.select(F.col("node").alias("doc_id"), "root", "n_members"), "doc_id", "left")
        .select("doc_id", F.coalesce("root", "doc_id").alias("class_id"), F.coalesce("n_members", F.lit(1)).cast("long").alias("n_members")))


def first_of_each(
    docs: DataFrame, width: int = WIDTH, least: float = SIMILARITY, counted: bool = False, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """The rows of ``docs``, with all columns, whose doc_id is the smallest of its class; see :func:`near_duplicates`.

    Rows with a null doc_id are in no class and stay; so do all rows of a doc_id that stays.
    """
    small_batches(docs.sparkSession, 500)
    corpus = _Corpus(docs, docs.columns, width, counted, bands, rows)
    return corpus.without(_classes(corpus, least).where("node != root").select(F.col("node").alias("id")))


def _classes(corpus: _Corpus, least: float) -> DataFrame:
    """node, root of every document that has a copy or a similar one, itself included."""
    sketch = corpus.sketch.where("doc_id is not null and copy is not null")
    reps = stored(
        sketch.groupBy("copy").agg(
            F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")), "copies")

    buckets = reps.select(F.explode("bands").alias("bucket"), "rep", "copies")
    centres = buckets.groupBy("bucket").agg(
        F.min(F.struct((-F.col("copies")).alias("few"), "rep")).alias("m"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(buckets.join(
        centres.select("bucket", F.col("m.rep").alias("centre"), "size"), "bucket").select("bucket", "rep", "centre", "size"), "buckets")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a != b").distinct()

    def ids_of(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()

    stars = stored(ordered(members.select(F.col("rep").alias("x"), F.col("centre").alias("y"))), "stars")
    sets = corpus.sets(ids_of(stars))
    first = _verified(stars, sets, least)
    roots = stored(components(first, "a", "b"), "roots")

    # Buckets that the stars left in pieces: what is outside the main piece meets the other pieces,
    # by the rare elements that could still make them similar.
    pieces = (
        members.where("size > 2").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("bucket", "rep", "centre", F.coalesce("root", "rep").alias("root")))
    sizes = pieces.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("bucket", "main")
    open_ = stored(pieces.join(main, "bucket"), "pieces")
    open_sets = stored(sets.join(open_.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"), "open-sets")
    places = open_.groupBy(F.col("rep").alias("id"), "root").agg(
        F.collect_list("bucket").alias("buckets"), F.max(F.col("root") != F.col("main")).alias("outside"))
    rare = stored(_rare_elements(open_sets, least).join(places.drop("buckets"), "id"), "rare")
    key = ["element", "low", "high"]
    rare = rare.withColumns({"low": F.least("own", "partner"), "high": F.greatest("own", "partner")})
    met = rare.groupBy(*key).agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r != s").select(*key)
    rare = stored(rare.join(met, key, "left_semi"), "rare")
    x, y = (rare.select(*key, *[F.col(c).alias(f"{side}_{c}") for c in ("id", "own", "partner", "root", "outside")]) for side in "xy")
    met = x.where("x_outside").join(y, key).where("x_own = y_partner and x_root != y_root")
    second = ordered(met.select(F.col("x_id").alias("x"), F.col("y_id").alias("y")))
    a, b = (places.select(F.col("id").alias(side), F.col("buckets").alias(f"{side}_buckets")) for side in "ab")
    second = second.join(a, "a").join(b, "b").where(F.arrays_overlap("a_buckets", "b_buckets")).select("a", "b")
    links = first.unionByName(_verified(second, open_sets, least))

    copies = sketch.join(reps.select("copy", "rep"), "copy").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a != b")
    return stored(components(links.unionByName(copies), "a", "b"), "classes")
