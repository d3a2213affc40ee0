"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: runs of text between block-level tags, each with the
path of block-level tags, classes, ids and roles above it. A bidirectional LSTM in numpy reads a hashed vector of
the path and a hashed vector of the words of every block, in both directions over the whole page, and
labels each block as article or not. The blocks labelled article, in page order, are the text.

The model is trained on a bounded sample of the pages (``SAMPLE`` rows chosen by a hash). Their labels come
from element names and conventional class names; so that the network also learns furniture that
the sample lacks, training pages are varied by moving some of their own blocks into asides, forms, comments, notices and the like.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.storage import lean_memory, small_batches
from tabula.llm.textnum import NOT_ALNUM, words

SAMPLE = 300
PATH, WORDS, HIDDEN = 96, 32, 16
# Elements by their role in a page; fixed values.
_SKIPPED = {"script", "style", "noscript", "template", "head", "svg", "math", "iframe", "object", "textarea", "select", "title"}
_BLOCKS = set(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "button", "dialog", "option", "fieldset"}
_FURNITURE_WORD = re.compile(
    r"^(ad|ads|advert\w*|banner|breadcrumb\w*|comment\w*|cookie\w*|consent|disqus|footer|header|menu|modal|nav\w*|newsletter|notice|popup|"
    r"promo\w*|related|repl(y|ies)|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)$")
_TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>?|<[!?][^>]*>?", re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


def blocks(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """Path, text (character references decoded, white space joined) and share of linked text of each leaf block."""
    out: list[tuple[tuple[str, ...], str, float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked, in_link, at, n = 0, 0, 0, len(page)

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append((stack[-1][1] if stack else (), text, min(1.0, linked / len(text))))
        pieces.clear()
        linked = 0

    while at < n:
        m = _TAG.search(page, at)
        raw = page[at: m.start() if m else n]
        if raw:
            pieces.append(raw)
            if in_link:
                linked += len(raw)
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name == "a":
                in_link = max(0, in_link - 1)
            if name in _BLOCKS:
                close()
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
                if depth is not None:
                    del stack[depth:]
            continue
        if name in _SKIPPED:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at) if not m[3].endswith("/") else None
            if name == "head" and not end:
                continue
            if name in ("textarea", "select", "iframe", "object"):
                close()
            if not m[3].endswith("/"):
                at = end.end() if end else n
            continue
        if name == "br":
            pieces.append(" ")
        elif name == "a":
            in_link += 1
        elif name in _BLOCKS:
            close()
            if name not in _VOID:
                if stack and (stack[-1][0] == "p" or stack[-1][0] == name in ("li", "dt", "dd", "option", "tr", "td", "th")):
                    stack.pop()
                marks = [w for hit in _NAMED.finditer(m[3]) for w in _WORD.findall("".join(x or "" for x in hit.groups()).lower())]
                stack.append((name, (stack[-1][1] if stack else ()) + (name, *("." + w for w in marks))))
    close()
    return out


def weak_label(path: tuple[str, ...]) -> bool:
    """Whether element and class names make a block part of the article."""
    if any(p in _FURNITURE or p[0] == "." and _FURNITURE_WORD.match(p[1:]) for p in path):
        return False
    return any(p in ("article", "main", "p", "h1", "h2", "h3", "blockquote", "pre", "td", "li", "section", "div") for p in path)


def vectors(page: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    """One row of path, word and shape features for each block of a page."""
    n = len(page)
    table = np.zeros((n, PATH + WORDS + 4), np.float32)
    if not n:
        return table
    for i, (path, text, linked) in enumerate(page):
        for depth, p in enumerate(path):
            code = zlib.crc32(p.encode())
            table[i, code % PATH] += 1.0 if code >> 16 & 1 else -1.0
        table[i, PATH + WORDS:] = np.log1p(len(text)) / 5, linked, i / n, text[-1] in ".!?"
    hashes, borders = words([t for _, t, _ in page], NOT_ALNUM)
    owner = np.repeat(np.arange(n), np.diff(borders))
    counts = np.bincount(owner * WORDS + (hashes % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    table[:, PATH: PATH + WORDS] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
    return table


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one logistic output for each block."""

    def __init__(self, seed: int = 7):
        rng, d = np.random.default_rng(seed), PATH + WORDS + 4
        self.p = {}
        for side in "fb":
            self.p["w" + side] = rng.normal(0, d**-0.5, (d, 4 * HIDDEN)).astype(np.float32)
            self.p["u" + side] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            self.p["c" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
        self.p["o"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32)
        self.p["d"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """States of one direction over padded pages x (pages, blocks, features)."""
        w, u, c = (self.p[k + side] for k in "wuc")
        pages, length, _ = x.shape
        given = (x.reshape(-1, x.shape[2]) @ w + c).reshape(pages, length, -1)
        h = cell = np.zeros((pages, HIDDEN), np.float32)
        states, tape = np.zeros((pages, length, HIDDEN), np.float32), []
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            z = given[:, t] + h @ u
            i, f, o = (_sigmoid(z[:, k * HIDDEN: (k + 1) * HIDDEN]) for k in range(3))
            g, on = np.tanh(z[:, 3 * HIDDEN:]), mask[:, t: t + 1]
            new = f * cell + i * g
            tape.append((t, h, cell, i, f, o, g, np.tanh(new), on))
            cell = on * new + (1 - on) * cell
            h = on * (o * np.tanh(new)) + (1 - on) * h
            states[:, t] = h
        return states, tape

    def chances(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, s)[0] for s in "fb"], axis=2)
        return _sigmoid(both @ self.p["o"] + self.p["d"])

    def slopes(self, x: np.ndarray, mask: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss, by propagation back through both directions."""
        runs = {s: self._run(x, mask, s) for s in "fb"}
        both = np.concatenate([runs[s][0] for s in "fb"], axis=2)
        error = (_sigmoid(both @ self.p["o"] + self.p["d"]) - target) * mask / mask.sum()
        slope = {"o": np.einsum("ptk,pt->k", both, error), "d": np.asarray([error.sum()], np.float32)}
        for k, side in enumerate("fb"):
            at_state = error[:, :, None] * self.p["o"][k * HIDDEN: (k + 1) * HIDDEN]
            u, dz_all = self.p["u" + side], np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            dh = dc = np.zeros((len(x), HIDDEN), np.float32)
            du = np.zeros_like(u)
            for t, h, cell, i, f, o, g, squashed, on in reversed(runs[side][1]):
                dh = dh + at_state[:, t]
                inner = on * dc + on * dh * o * (1 - squashed**2)
                dz = np.concatenate([
                    inner * g * i * (1 - i), inner * cell * f * (1 - f), on * dh * squashed * o * (1 - o), inner * i * (1 - g**2)], axis=1)
                dz_all[:, t] = dz
                du += h.T @ dz
                dc = inner * f + (1 - on) * dc
                dh = dz @ u.T + (1 - on) * dh
            slope["u" + side] = du
            slope["w" + side] = x.reshape(-1, x.shape[2]).T @ dz_all.reshape(-1, 4 * HIDDEN)
            slope["c" + side] = dz_all.sum(axis=(0, 1))
        return slope


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = max(len(p) for p in pages)
    x = np.zeros((len(pages), length, PATH + WORDS + 4), np.float32)
    mask = np.zeros((len(pages), length), np.float32)
    for i, p in enumerate(pages):
        x[i, : len(p)], mask[i, : len(p)] = p, 1
    return x, mask


def _varied(page: list, rng: np.random.Generator) -> list:
    """A page with some blocks of its own repeated as furniture around and inside the article."""
    # Conventional wrappers of furniture; fixed values.
    wrappers = [
        ("aside", "p"), ("header", "div"), ("form", "p"), ("section", ".comments", "p"), ("div", ".comment", "p"), ("div", ".sidebar", "p"),
        ("div", ".cookie", ".notice"), ("div", ".related", "ul", "li"), ("div", ".newsletter", "p"), ("nav", "ul", "li"),
        ("div", ".ad"), ("div", ".promo", "p"), ("footer", "p"), ("div", ".share", "a"), ("div", ".menu", "li"), ("article", "aside", "p")]
    out = list(page)
    for _ in range(int(rng.integers(1, 5))):
        path, text, linked = page[int(rng.integers(len(page)))]
        wrap = wrappers[int(rng.integers(len(wrappers)))]
        few = text.split()
        text = " ".join(few[: int(rng.integers(3, 60))])
        out.insert(int(rng.integers(len(out) + 1)), (("html", "body", *wrap), text, linked))
    if rng.random() < 0.3:  # articles are not always called so
        name = [("main",), ("div", ".content"), ("div", ".post"), ("section",)][int(rng.integers(4))]
        out = [(tuple(y for p in path for y in (name if p == "article" else (p,))), text, linked) for path, text, linked in out]
    return out


def train(pages: list[str], turns: int = 12, rate: float = 0.01, seed: int = 7) -> Labeller:
    """Fit the labeller on sample pages and two variations of each."""
    rng, model = np.random.default_rng(seed), Labeller(seed)
    parsed = [p for p in map(blocks, pages) if p]
    sets = [p[:400] for p in parsed] + [_varied(p[:400], rng) for _ in range(2) for p in parsed]
    data = [(vectors(p), np.asarray([weak_label(path) for path, _, _ in p], np.float32)) for p in sets]
    data.sort(key=lambda d: len(d[0]))
    batches = [data[i: i + 24] for i in range(0, len(data), 24)]
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.p.items()}
    step = 0
    for _ in range(turns):
        for i in rng.permutation(len(batches)):
            x, mask = _padded([v for v, _ in batches[i]])
            target = np.zeros(mask.shape, np.float32)
            for j, (_, y) in enumerate(batches[i]):
                target[j, : len(y)] = y
            step += 1
            for k, g in model.slopes(x, mask, target).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                model.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def article_texts(pages: list[str], model: Labeller) -> list[tuple[str, int, int]]:
    """Text, number of blocks and number of article blocks of each page."""
    parsed = [blocks(p or "") for p in pages]
    out = [("", 0, 0)] * len(pages)
    order = sorted((i for i, p in enumerate(parsed) if p), key=lambda i: len(parsed[i]))
    for some in range(0, len(order), 64):
        part = order[some: some + 64]
        x, mask = _padded([vectors(parsed[i]) for i in part])
        chance = model.chances(x, mask)
        for j, i in enumerate(part):
            kept = [text for (_, text, _), c in zip(parsed[i], chance[j]) if c > 0.5]
            out[i] = ("\n\n".join(kept), len(parsed[i]), len(kept))
    return out


def fit(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """Train on ``sample`` pages, chosen by a hash of page_id; pages without html are not chosen."""
    chosen = pages.where(F.col("html").isNotNull()).select("html", F.xxhash64("page_id", "url").alias("turn")).orderBy("turn").limit(sample)
    return train([r["html"] for r in chosen.collect()])


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_article of every row of ``pages``, row by row.

    The whole html is read; null and empty html, and pages without article blocks, give an empty text. Repeated rows give equal
    results; columns other than page_id, url and html are ignored; an empty table gives no rows.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        for batch in batches:
            found = article_texts(batch.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                pa.array([len(f[0]) for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()),
                pa.array([f[2] for f in found], pa.int32())],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_article"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks int, n_article int")
