"""Records of delimited text with quoted line breaks, found by many tasks in one file.

A byte range of a file can begin inside a quoted cell. What a line does to the reader depends on one
bit only, whether it begins inside quotes, so each range first tells where it ends up from either
beginning and whether a record starts in it. Following these answers range by range gives the true
beginning of every range; a second read then cuts records in all ranges at once. Only records that
cross a border travel: their pieces are brought together by the range in which they began.

Quotes count as the reader counts them: a cell is quoted if its first character is a quote, a doubled
quote stays inside, and a quote in the middle of a bare cell is an ordinary character.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLOSE = re.compile(r'(?:[^"]++|"")*+"')
_STEP = "file long, start long, outside boolean, inside boolean, begins boolean, closes boolean"
_PIECE = "file long, start long, origin long, heading boolean, text string"


def ends_inside(line: str, inside: bool, separator: str = ",") -> bool:
    """Whether a line that begins inside quotes, or does not, ends inside."""
    at = 0
    if not inside and '"' not in line:
        return False
    while True:
        if not inside:
            if line.startswith('"', at):
                at += 1
            else:  # a bare cell
                at = line.find(separator, at)
                if at < 0:
                    return False
                at += 1
                continue
        closed = _CLOSE.match(line, at)
        if not closed:
            return True
        at = line.find(separator, closed.end())
        if at < 0:
            return False
        at += 1
        inside = False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and byte range they begin in. The number of ranges must not change between two reads."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """The rows of one batch by range; lines of a range come one after the other."""
    file, start = batch.column(0), batch.column(1)
    at = 0
    while at < batch.num_rows:
        same = pc.and_(pc.equal(file, file[at]), pc.equal(start, start[at])).slice(at)
        other = pc.index(same, pa.scalar(False)).as_py()
        n = batch.num_rows - at if other < 0 else other
        yield file[at].as_py(), start[at].as_py(), batch.slice(at, n)
        at += n


def _survey(lines: DataFrame, separator: str) -> DataFrame:
    """For each range: whether it ends inside quotes when it begins outside or inside, and whether a
    record begins in it, or in the second case whether the open one ends. Lines without a quote stay in the JVM."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, [False, True, False]

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"file": now[0], "start": now[1], "outside": state[0], "inside": state[1], "begins": True, "closes": state[2]}],
                schema=pa.schema([("file", pa.int64()), ("start", pa.int64()), *[(c, pa.bool_()) for c in ("outside", "inside", "begins", "closes")]]))

        for batch in batches:
            for file, start, rows in _ranges(batch):
                if now != (file, start):
                    if now is not None:
                        yield told()
                    now, state = (file, start), [False, True, False]
                for line in rows.column(2).drop_null().to_pylist():
                    state[0], state[1] = ends_inside(line, state[0], separator), ends_inside(line, state[1], separator)
                    state[2] |= not state[1]
        if now is not None:
            yield told()

    quoted = F.when(F.contains("value", F.lit('"')), F.col("value"))
    return lines.select("file", "start", quoted.alias("value")).mapInArrow(run, _STEP)


def begins(survey: list) -> dict[tuple[int, int], tuple[bool, int]]:
    """For each range whether it begins inside quotes, and the range in which the record open there began."""
    out: dict[tuple[int, int], tuple[bool, int]] = {}
    last = None
    for r in sorted(survey, key=lambda r: (r["file"], r["start"])):
        if r["file"] != last:
            last, inside, origin = r["file"], False, r["start"]
        out[r["file"], r["start"]] = (inside, origin if inside else r["start"])
        if not inside or r["closes"]:
            origin = r["start"]  # a record that is open at the end of this range began in it
        inside = r["inside"] if inside else r["outside"]
    return out


def records(spark: SparkSession, path: str, header: bool = True, separator: str = ",") -> DataFrame:
    """One row (record) for every record of the files at ``path``, line breaks inside quotes kept.

    Each range of at most ``spark.sql.files.maxPartitionBytes`` is read by a task of its own. The driver
    holds one entry for each range. Empty records, and with ``header`` the first record of each file, are left
    out; a last record whose quotes never close ends with its file.
    """
    lines = _lines(spark, path)
    known = begins(_survey(lines, separator).collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, inside, entered, origin, first = None, [], False, False, 0, False

        def rows(texts: list, origin: int | None, heading: bool = False) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]] * n, pa.int64()), pa.array([now[1]] * n, pa.int64()), pa.array([origin] * n, pa.int64()),
                 pa.array([heading] * n, pa.bool_()), pa.array(texts, pa.string())], names=["file", "start", "origin", "heading", "text"])

        def border() -> pa.RecordBatch:
            """What is open at the end of a range: a record that began in it, or more of an earlier one."""
            return rows(["\n".join(held)], origin, first and origin == now[1])

        for batch in batches:
            for file, start, part in _ranges(batch):
                if now != (file, start):
                    if held:
                        yield border()
                    now, held = (file, start), []
                    if now not in known:
                        raise RuntimeError("the byte ranges changed between two reads of the files")
                    inside, origin = known[now]
                    entered = inside
                    first = header and start == 0
                whole = []
                for line in part.column(2).to_pylist():
                    held.append(line)
                    inside = ends_inside(line, inside, separator)
                    if inside:
                        continue
                    text = "\n".join(held) if len(held) > 1 else held[0]
                    if entered:  # the end of a record that began in an earlier range
                        yield rows([text], origin)
                        entered = False
                    elif first:
                        first = False
                    else:
                        whole.append(text)
                    held, origin = [], start
                if whole:
                    yield rows(whole, None)
        if held:
            yield border()

    pieces = lines.mapInArrow(run, _PIECE)
    # a record is put together from the range it began in and all it went on to
    crossing = (
        pieces.where("origin is not null").groupBy("file", "origin")
        .agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("p"), F.bool_or("heading").alias("heading"))
        .where("not heading").select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text")))
    text = pieces.where("origin is null").select("text").unionByName(crossing)
    # lines that end in two characters end so inside cells as well, and are read as one line feed
    ending = F.when(F.endswith("text", F.lit("\r")), F.replace(F.expr("left(text, length(text) - 1)"), F.lit("\r\n"), F.lit("\n")))
    return text.select(F.coalesce(ending, "text").alias("record")).where("record != ''")
