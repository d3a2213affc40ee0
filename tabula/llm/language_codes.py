"""Language identification with error-correcting output codes.

Each language has a codeword of +1/-1 bits; for each bit a logistic classifier over hashed byte
n-grams learns which languages have +1. A text goes to the language whose codeword costs least,
where each bit is weighted by the logistic loss of its margin; a text whose two best codewords cost nearly
the same is marked ambiguous.

Fitting uses a bounded sample (``SAMPLE`` rows per language, chosen by a hash, whole texts) of
labelled rows outside the held-out fold; the driver sees only that sample's counts.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.storage import lean_memory, small_batches
from tabula.llm.textnum import joined

BUCKETS = 4096
SAMPLE = 400
FOLDS = 5
#: A text is ambiguous when its second codeword costs less than this much more than its first.
MARGIN = 0.02
_LETTER = re.compile(r"[^\W\d_]")


def fold(id_column: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; 0 is held out. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def features(texts: list[str]) -> np.ndarray:
    """Square roots of the shares of hashed byte 1-, 2- and 3-grams: unit rows of ``BUCKETS`` columns."""
    data, borders = joined([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    n, counts = len(texts), np.zeros(len(texts) * BUCKETS, np.int64)
    owner = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(borders))
    code = data.astype(np.uint32)
    gram = code
    for width in (1, 2, 3):
        if width > 1:
            gram = gram[:-1] * np.uint32(0x01000193) ^ code[width - 1:]
        if not len(gram):
            break
        inside = owner[: len(gram)] == owner[width - 1:]
        slot = ((gram + np.uint32(width)) * np.uint32(0x9E3779B1) >> np.uint32(20)).astype(np.int64)
        counts += np.bincount((owner[: len(gram)] + slot)[inside], minlength=n * BUCKETS)
    table = counts.reshape(n, BUCKETS).astype(np.float32)
    return np.sqrt(table / np.maximum(table.sum(axis=1, keepdims=True), 1))


def codebook(languages: int, seed: int = 5) -> np.ndarray:
    """Rows of +1/-1, one for each language: all two-way partings of up to six languages, else random ones far apart."""
    if languages <= 6:
        columns = [c for c in itertools.product((1, -1), repeat=languages) if c[0] == 1 and -1 in c]
        return np.asarray(columns, np.float32).reshape(-1, languages).T
    bits, rng = 4 * int(np.ceil(np.log2(languages))) + 8, np.random.default_rng(seed)
    best, best_far = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (languages, bits)).astype(np.float32)
        apart = ((bits - code @ code.T) / 2 + np.eye(languages) * bits).min()
        if apart > best_far and (np.abs(code.sum(axis=0)) < languages).all():
            best, best_far = code, apart
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def decide(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score (share of its likelihood) and whether the choice is ambiguous."""
        cost = self._costs(features(texts) @ self.weights + self.bias)
        order = np.argsort(cost, axis=1, kind="stable")
        best = order[:, 0]
        share = np.exp(-(cost - cost.min(axis=1, keepdims=True)))
        score = 1 / share.sum(axis=1)
        if len(self.languages) == 1:
            return best, np.ones(len(texts)), np.zeros(len(texts), bool)
        rows = np.arange(len(texts))
        return best, score, cost[rows, order[:, 1]] - cost[rows, best] < MARGIN

    def _costs(self, margins: np.ndarray) -> np.ndarray:
        return np.stack([np.logaddexp(0, -margins * word).sum(axis=1) for word in self.code], axis=1)


def train(table: np.ndarray, labels: list[str], steps: int = 300, rate: float = 0.2, penalty: float = 1e-6) -> Model | None:
    """Fit one logistic classifier for each code bit on feature rows; every language weighs the same."""
    languages = sorted(set(labels))
    if not languages:
        return None
    code, index = codebook(len(languages)), np.searchsorted(languages, labels)
    target = code[index]
    weight = (1 / np.bincount(index)[index] / len(languages)).astype(np.float32)[:, None]
    w, b = np.zeros((BUCKETS, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    moments = [np.zeros_like(x) for x in (w, w, b, b)]
    for step in range(1, steps + 1):
        slope = -target * weight / (1 + np.exp(np.clip(target * (table @ w + b), -30, 30)))
        for x, g, m, v in ((w, table.T @ slope + penalty * w, *moments[:2]), (b, slope.sum(axis=0), *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(languages, code, w, b)


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = 17) -> Model | None:
    """Learn from ``sample`` rows of each language, by text and lang of rows outside the held-out fold.

    Rows with a null text or lang are not learnt from; None where nothing is left.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    grid = 1 << 30
    reach = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(grid, grid * sample // n + 1))])
    chosen = known.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(grid)) < reach[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_pydict({"lang": [lang], "row": [features([text])[0].tobytes()]})

    rows = (
        chosen.select("text", "lang").mapInArrow(count, "lang string, row binary")
        .orderBy(F.md5("row")).limit(2 * sample * len(sizes)).collect())
    table = np.frombuffer(b"".join(bytes(r["row"]) for r in rows), np.float32).reshape(-1, BUCKETS)
    return train(table, [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id), lang_pred, score, ambiguous of every row of ``docs``, row by row.

    Only ``text`` decides. A null text, one without a letter, and any text where no language was
    learnt are ``und`` with score 0. Equal texts get equal answers; ties of codewords go to the
    language that sorts first and are ambiguous. Whole texts are read, whatever their length.
    """
    keep = ["doc_id"] if keep is None else keep
    small_batches(docs.sparkSession)
    rows = docs.select(*[f"`{c}`" for c in keep], docs["text"].alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            usable = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
            lang, score, vague = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
            for some in range(0, len(usable), 256):
                part = usable[some: some + 256]
                for i, best, share, unsure in zip(part, *model.decide([texts[i] for i in part])):
                    lang[i], score[i], vague[i] = model.languages[best], float(share), bool(unsure)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(vague, pa.bool_())],
                names=[*keep, "lang_pred", "score", "ambiguous"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double, ambiguous boolean")
