"""Prefix token counts, divergence audit and fill-in-the-middle against the library and brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tabula.llm import divergence, fill_in_middle, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_tokens long, output string, term string, rank int, _text string"
WORDS = "the of and house river Stone cloud tree light water Éé été wind".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", ".", "\n", "x"]) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, tied, repeated and very long rows; extra columns whose names the operators use."""
    texts = [
        None, "", " ", "  \n\n ", "\n", "a", "a\n", "a\n\nb", prose(1, 60), prose(1, 60), prose(2, 40_000), "中文没有空格" * 3_000, "x" * 5_000, "<P>a\nb",
        "<s> </s> <0x0A> ▁a b▁ c", "\t\x00​🙂 é", "Straße «été»\r\nz  y", prose(3, 200)]
    r = random.Random(5)
    rows = [(i, t, r.choice(["en", "fr", None]), r.choice(["a", "b", None, ""])) for i, t in enumerate(texts)]
    rows += [rows[8], (None, prose(4, 50), "en", "c"), (100, None, "de", "lonely")]
    rows += [(200 + i, prose(i, 30), "en", r.choice("abc")) for i in range(40)]
    return spark.createDataFrame([(*row, 9, "o", "t", 1, "x") for row in rows], DOCS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_every_prefix_counts_as_the_library(spark):
    library, counter = sentencepiece.SentencePieceProcessor(model_file=MODEL), token_counts.PrefixCounter(MODEL)
    r = random.Random(1)
    texts = ["", " ", "  " * 20, "a" * 200, " a  b ", "a ", "▁", "x▁y z", "\n\n\n", "no" * 60 + " 中文" * 9]
    for _ in range(400):
        picks = [r.choice(counter.names[1:]) if r.random() < 0.8 else chr(r.choice([r.randrange(1, 255), r.randrange(0x4E00, 0x4F00)])) for _ in range(6)]
        texts.append("".join(picks).replace("▁", r.choice([" ", "▁"])))
    for text in texts:
        assert counter.counts(text).tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)], text
    for unit in ("▁" + "".join(r.choice("abcdeé中🙂") for _ in range(40)) for _ in range(50)):
        assert counter._long(unit) == counter._together([unit])[0]


def test_prefix_table_and_stored_answers(spark, odd):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for r in odd.collect():
        text = r["text"] or ""
        n = len(library.encode(text))
        want.append((r["doc_id"], len(text.encode()), n, n > 300))
    found = token_counts.prefix_table(odd, MODEL, 300)
    assert rows(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    asked = found.withColumn("k", F.lit(37)).select(
        "doc_id", "fit_chars", token_counts.tokens_before(F.col("prefixes"), F.col("k")).alias("before"),
        token_counts.longest_within(F.col("prefixes"), F.lit(300)).alias("within"),
        token_counts.longest_within(F.col("prefixes"), F.lit(-1)).alias("never"),
        token_counts.longest_within(F.col("prefixes"), F.lit(0)).alias("none"))
    for r in asked.collect():
        text = texts[r["doc_id"]]
        assert r["before"] == len(library.encode(text[:37]))
        assert r["fit_chars"] == r["within"] and r["never"] is None and r["none"] == 0
        if r["within"] < len(text):  # nothing longer fits
            assert len(library.encode(text[:r["within"]])) <= 300
            assert all(len(library.encode(text[:i])) > 300 for i in range(r["within"] + 1, min(len(text), r["within"] + 40) + 1))
    assert token_counts.prefix_table(odd.limit(0), MODEL, 300).count() == 0
    assert token_counts.prefix_table(odd, MODEL, 9, keep=["doc_id", "rank"], store=False).columns == [
        "doc_id", "rank", "n_bytes", "n_tokens", "over_limit", "fit_chars"]


def audit_by_hand(docs, least, shown):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tf, df = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        terms = [t.translate(lower) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text)]
        tf[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for (lang, source), own in tf.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        both = Counter()
        for (other, _), c in tf.items():
            if other == lang:
                both.update(c)

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        mine, theirs = p(own), p(both)
        pair = [(s, sum(f(mine[t], q) for t, q in p(c).items())) for (x, s), c in tf.items() if x == lang and s != source]
        term = [(t, f(mine[t], theirs[t])) for t in kept if own[t] and mine[t] > theirs[t]]
        for part, items, top in (("pair", pair, len(pair)), ("term", term, shown)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(items[:top])]
    return sorted(out)


def test_audit_against_brute_force(spark, odd, monkeypatch):
    columns = ("lang", "source", "part", "item", "value", "rank")
    docs = [tuple(r[c] or "" for c in ("lang", "source", "text")) for r in odd.collect()]
    for least in (1, 10):
        assert rows(divergence.audit(odd, least_docs=least, terms_shown=4), *columns) == sorted(audit_by_hand(docs, least, 4), key=repr)
    # many small blocks, steps and windows give the same sums
    for name, value in (("BLOCK", 5), ("STEP", 3), ("HELD", 7), ("WINDOW", 11)):
        monkeypatch.setattr(divergence, name, value)
    assert rows(divergence.audit(odd, least_docs=2), *columns) == sorted(audit_by_hand(docs, 2, 10), key=repr)
    assert divergence.audit(odd.limit(0)).count() == 0
    bare = spark.createDataFrame([(None, None, None), (None, "b", "12 34")], "lang string, source string, text string")
    assert rows(divergence.audit(bare), *columns) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_terms_never_end_at_a_window(monkeypatch):
    text = prose(9, 300)
    whole = [t for some in divergence.terms_of(text) for t in some]
    monkeypatch.setattr(divergence, "WINDOW", 3)
    assert [t for some in divergence.terms_of(text) for t in some] == whole


def test_skip_list_reaches_every_rank():
    r = random.Random(3)
    for n in (0, 1, 2, 8, 9, 10, 100, 3_000):
        widths = [r.randrange(1, 90) for _ in range(n)]
        units = fill_in_middle.SkipList(widths)
        assert [units.reach(k) for k in range(n + 1)] == [sum(widths[:k]) for k in range(n + 1)]
        assert all(sum(u) == n for u in units.units) and (n < 100 or len(units.units) > 1)


def test_fill_in_middle_against_brute_force(spark, odd):
    def by_hand(doc_id, text, percent, spm_percent):
        text = text or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        n = len(units)
        digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
        if not text or re.search("<P>|<S>|<M>", text) or h3 % 100 >= percent:
            return doc_id, n, "plain", None, None, text
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        spm = h4 % 100 < spm_percent
        return doc_id, n, "spm" if spm else "psm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}" if spm else f"<P>{x}<S>{z}<M>{y}"

    for percent, spm in ((100, 50), (60, 20)):
        found = fill_in_middle.transform(odd, percent=percent, spm_percent=spm)
        want = sorted((by_hand(r["doc_id"], r["text"], percent, spm) for r in odd.collect()), key=repr)
        assert rows(found, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == want
        back = rows(found.select("doc_id", fill_in_middle.restore(F.col("output"), F.col("form")).alias("t")), "doc_id", "t")
        assert back == sorted(((r["doc_id"], r["text"] or "") for r in odd.collect()), key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(odd.limit(0)).count() == 0
    words = fill_in_middle.transform(odd.where("doc_id = 8"), unit=r"\S+\s*|\s+").first()
    assert words["n"] == len(re.findall(r"\S+\s*|\s+", prose(1, 60)))
