"""The dealt operators and the pipeline against brute force, round trips and odd rows."""

import hashlib
import random
import sys
import tracemalloc
import unicodedata
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tabula.llm import (  # noqa: E402
    bpe_automaton, dart_minhash, decontaminate, html_blocks, language_codes, license_scan, multi_index, sharding, suffix_dedup, textnum, token_files)
from tabula.llm.induced_sorting import common_prefixes, suffix_order  # noqa: E402
from tabula.llm.storage import spare_memory  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, row long, score double, id long, kept_text string"
WORDS = "the of and house river stone cloud tree light water wind bread table green morning letter window garden music paper".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, tied, repeated and very long rows; columns whose names the operators use inside."""
    base = prose(1, 120)
    texts = [
        (1, base), (2, base), (3, base + " more"), (4, None), (5, ""), (6, "  \n "), (7, "one"), (7, "one"), (None, base), (8, prose(2, 30_000)),
        (9, "Straße «été» <|endoftext|> 中文\t\x1c x\n\n y  z"), (10, prose(3, 80) + "\nReleased under the MIT License.\n" + prose(4, 20)),
        (11, prose(5, 60) + " " + base[100:260] + " " + prose(6, 60)), (12, "12 !! 34"), (13, prose(7, 40)), (14, prose(7, 40))]
    return spark.createDataFrame([(i, t, "en" if i != 13 else None, None, None, 1, 1, 0.5, 9, "x") for i, t in texts], DOCS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def pairs_of(odd):
    return [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]


def test_token_files_match_library(odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, start, want = Tokenizer.from_file(path), 0, []
    ordered = sorted(pairs_of(odd), key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    for i, t in ordered:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    got = rows(token_files.token_table(odd, path), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(want, key=repr)
    assert token_files.token_table(odd.limit(0), path).count() == 0


def test_token_units_of_any_marks_and_each_word_once():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, enc, r, asked = Tokenizer.from_file(path), token_files.Encoder(path), random.Random(5), []
    marks = ["%%%", "***", "$", "'", "''", "_", "!?", '"),', "'s", "'ll!", "_a", "'%"]
    stems = ["stone", "Riverün", "été", "中文", "x", "don't", "12", "a1", "ĊĠ", "ﬁ", "e\u0301"]
    texts = [" ".join(r.choice(stems) + r.choice([*marks, ""]) + r.choice(["", "\n" + r.choice(stems)]) for _ in range(30)) for _ in range(60)]
    texts += [m.join(["", *stems]) for m in marks] + ["", "\n", "%", "one", "a\n\nb", "a  b", "<|endoftext|> a", "a\x85b", "a\u2028b"]
    for some in (texts, texts[::-1], texts):
        for text, ids in zip(some, enc.encode(some)):
            assert np.frombuffer(ids, enc.dtype).tolist() == library.encode(text, add_special_tokens=False).ids
    enc = token_files.Encoder(path)
    enc._encode = lambda texts: asked.extend(texts) or [b""] * len(texts)
    enc.encode(["a" + "".join(f" stone{m}\nriver{m}" for m in marks[:8])])
    assert asked == []  # a word and the marks after it are never sent through the whole library


def test_repeat_removal_holds_little_beside_its_chunk():
    table = suffix_dedup._rows([(s, 0, 2, bytes([s]) * 300_000, None, None, b"x") for s in range(20)])
    assert max(b.nbytes for b in table.to_batches()) < suffix_dedup.ROW_BYTES + 400_000
    assert table["shard"].to_pylist() == list(range(20)) and table["a"][19].as_py() == b"\x13" * 300_000
    assert suffix_dedup._rows([]).num_rows == 0

    texts = [prose(i, 400) for i in range(1_000)] + [None, "", "ü" * 30]
    table = pa.Table.from_batches([
        pa.RecordBatch.from_arrays([pa.array(range(a, b), pa.int64()), pa.array(texts[a:b], pa.string())], names=["__id", "__text"]).slice(1)
        for a, b in ((0, 500), (500, len(texts)))])
    tracemalloc.start()
    chunk = suffix_dedup._Chunk(table, 50)
    doc, start, many, _ = chunk.runs()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 16 * len(chunk.data)
    want = [(t or "").encode() for t in texts[1:500] + texts[501:]]
    assert [chunk.data[a:b].tobytes() for a, b in zip(chunk.borders, chunk.borders[1:])] == want
    assert np.bincount(doc, many, len(want)).tolist() == [max(0, len(t) - 49) for t in want]
    assert (start >= chunk.borders[doc]).all() and (start + many + 49 <= chunk.borders[doc + 1]).all()


def test_spare_memory_lets_go_of_the_memos_of_other_operators():
    path = public_tokenizers.path("word_bpe_49k.json")
    model = bpe_automaton.automaton(path)
    assert bpe_automaton.automaton(path) is model
    spare_memory()
    assert not bpe_automaton._AUTOMATA and bpe_automaton.automaton(path) is not model


def test_bpe_automaton_matches_library(odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, model = Tokenizer.from_file(path), bpe_automaton.Automaton(path)
    r = random.Random(2)
    vocabulary = list(library.get_vocab())
    texts = [t or "" for _, t in pairs_of(odd)] + ["a" * n for n in range(40)]
    texts += ["".join(r.choice(vocabulary).replace("</w>", r.choice(["", " "])) for _ in range(5)) for _ in range(400)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)
    want = []
    for i, t in pairs_of(odd):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = rows(bpe_automaton.encode_digests(odd, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=repr)
    assert bpe_automaton.encode_digests(odd.limit(0), path).count() == 0


def test_shards_are_a_permutation(spark, odd):
    many = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    for docs, n in ((many, 5_000), (odd, odd.count())):
        got = sharding.shard_rows(docs, 8).collect()
        assert len(got) == n
        by_shard = {}
        for r in got:
            by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
        sizes = [len(by_shard.get(k, [])) for k in range(8)]
        assert max(sizes) - min(sizes) <= 1
    assert rows(sharding.shard_rows(many), "doc_id", "shard", "slot") == rows(sharding.shard_rows(many), "doc_id", "shard", "slot")
    assert sharding.shard_rows(odd.limit(0)).count() == 0
    places = spark.range(1_009).select(sharding.place(F.col("id"), 1_009, 3).alias("p")).collect()
    assert sorted(r["p"] for r in places) == list(range(1_009))


def brute_repeats(pairs, width):
    first, out = {}, []
    for i, t in pairs:
        b = (t or "").encode()
        for p in range(len(b) - width + 1) if i is not None else ():
            first[b[p:p + width]] = min(first.get(b[p:p + width], i), i)
    for i, t in pairs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - width + 1) if i is not None else ():
            if first[b[p:p + width]] < i:
                gone[p:p + width] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [200, 0])
def test_suffix_dedup_matches_brute_force(odd, hot):
    got = rows(suffix_dedup.remove_repeats(odd, ["doc_id"], hot=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_repeats(pairs_of(odd), 50)
    assert suffix_dedup.remove_repeats(odd.limit(0), ["doc_id"]).count() == 0


@pytest.mark.parametrize("hot", [200, 0])
def test_suffix_dedup_leaves_little_beside_its_chunks(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "shared_folder", lambda session, name: f"file://{tmp_path}/{name}")
    pairs = [(i, prose(100 + i // 2, 300) + " " + prose(500 + i, 300)) for i in range(100)] + [(100, None), (101, ""), (102, "short")]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").coalesce(1)
    got = rows(suffix_dedup.remove_repeats(docs, ["doc_id"], hot=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_repeats(pairs, 50)
    size = {kind: sum(f.stat().st_size for f in tmp_path.glob(f"*/{kind}-*")) for kind in ("runs", "copies")}
    # half of the windows lie in passages of two texts; a run of them took 32 bytes before, some 1.2 bytes for each byte of text
    windows = sum(len(t or "") for _, t in pairs) / 2
    assert 0 < size["runs"] < windows / (2 if hot else 1) and size["copies"] < 100
    for n in (0, 1, 1_000):
        start, many, number = np.cumsum(np.arange(n) % 7 + 1) << 20, np.arange(n) % 26 + 1, np.arange(n)[::-1] * 3
        assert all((a == b).all() and len(a) == n for a, b in zip((start, many, number), suffix_dedup._unpack_runs(suffix_dedup._pack_runs(start, many, number))))


def test_suffix_order_spills_and_sorts(tmp_path):
    rng = np.random.default_rng(0)
    for turn in range(60):
        text = np.append(np.tile(rng.integers(1, 4, rng.integers(0, 40)), 1 + turn % 3), 0)
        plain = text.tolist()
        order = suffix_order(text, str(tmp_path), memory=8)
        assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        same = common_prefixes(text, order, 3)
        assert all(same[k] == (plain[a:a + 3] == plain[b:b + 3] and a + 3 <= len(plain) and b + 3 <= len(plain))
                   for k, (a, b) in enumerate(zip(order[:-1], order[1:]), 1))


def jaccard_classes(pairs):
    sets = {}
    for i, t in pairs:
        w = (t or "").lower().split()
        if i is not None and w:
            sets.setdefault(i, []).append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))})
    ids = sorted({i for i, _ in pairs if i is not None})
    root = {i: i for i in ids}

    def find(i):
        return i if root[i] == i else find(root[i])
    for a in sets:
        for b in sets:
            if a < b and any(len(x & y) >= 0.8 * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_near_duplicates_match_brute_force(spark, odd):
    variants = []
    for k in range(30):
        w = prose(99, 150).split()
        r = random.Random(k)
        for _ in range(r.randrange(6)):
            w[r.randrange(150)] = f"edit{r.randrange(10**6)}"
        variants.append((100 + k, " ".join(w)))
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(variants, "doc_id long, text string"))
    want = jaccard_classes(pairs_of(docs))
    got = dart_minhash.near_duplicates(docs).select("doc_id", "class_id").collect()
    assert len(got) == docs.count()
    assert all(r["class_id"] == want.get(r["doc_id"]) for r in got)
    assert dart_minhash.near_duplicates(odd.limit(0)).count() == 0
    kept, alone = dart_minhash.first_of_each(odd), jaccard_classes(pairs_of(odd))
    assert kept.columns == odd.columns
    assert rows(kept, *odd.columns) == sorted(
        (tuple(r) for r in odd.collect() if r["doc_id"] is None or alone[r["doc_id"]] == r["doc_id"]), key=repr)
    assert dart_minhash.first_of_each(odd.limit(0)).count() == 0


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    element = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    a, b = rng.exponential(3, 300), rng.exponential(3, 300)
    table = dart_minhash.signatures(np.tile(element, 2), np.concatenate([a, b]), np.array([0, 300, 600]), 1_500)
    assert abs((table[0] == table[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.05


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_codes.fit(docs)
    found = language_codes.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(language_codes.fold(F.col("doc_id")) == 0)
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()


def test_language_odd_rows(odd):
    model = language_codes.fit(odd)
    got = dict((r["doc_id"], r["lang_pred"]) for r in language_codes.predict(odd, model).collect())
    assert got[4] == got[5] == got[6] == got[12] == "und" and got[1] == "en"
    assert language_codes.fit(odd.limit(0)) is None
    assert {r["lang_pred"] for r in language_codes.predict(odd, None).collect()} == {"und"}
    code = language_codes.codebook(12)
    assert min((code[i] != code[j]).sum() for i in range(12) for j in range(i)) >= 5


def test_neighbours_recall_and_ties(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    table = sorted((r["vec_id"], r["embedding"]) for r in vectors.collect())
    ids, v = np.asarray([i for i, _ in table]), np.asarray([e for _, e in table], float)
    hit = total = 0
    got = {}
    for r in multi_index.nearest(vectors, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    for k in np.flatnonzero(ids % 20 == 0):
        score = v @ v[k]
        score[k] = -9
        hit += len(got[ids[k]] & set(ids[np.argsort(-score)[:20]].tolist()))
        total += 20
    assert hit >= 0.9 * total
    nan, inf = float("nan"), float("inf")
    small = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 2.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]),
             (8, [None, 1.0]), (9, [1.0]), (20, [1.0, 0.0])]
    frame = spark.createDataFrame([(i, e, 1, 2) for i, e in small], "vec_id long, embedding array<float>, row int, score int")
    found = rows(multi_index.nearest(frame, F.col("vec_id") % 20 == 0), "query_id", "rank", "vec_id", "score")
    assert found == sorted([(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 1.0), (0, 4, 3, 0.5),
                            (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 1.0), (20, 4, 3, 0.5)], key=repr)
    assert multi_index.nearest(frame.limit(0), F.col("vec_id") == 0).count() == 0


def test_decontamination_finds_edited_items(spark, odd):
    items = [(k, prose(200 + k, 20 + k)) for k in range(30)] + [(98, None), (99, "??!"), (97, "never there"), (96, "")]
    r, texts = random.Random(3), []
    for k, t in items[:30]:
        w = t.split()
        for _ in range(decontaminate.edits(len(w))):
            w[r.randrange(len(w))] = "changed"
        texts.append((k, prose(400 + k, 50) + " " + " ".join(w) + ". " + prose(500 + k, 50)))
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(1_000 + k, t) for k, t in texts], "doc_id long, text string"))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert found == {(1_000 + k, k) for k in range(30)}
    assert decontaminate.contaminated(docs, benchmark, block=7).count() == 30
    assert decontaminate.clean_rows(docs, benchmark).count() == odd.count()
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


def plain_words(text):
    """Words by the plain reading of the rule."""
    out, run = [], ""
    for c in text.lower():
        alone = unicodedata.category(c)[0] in "LNM" and any(a <= ord(c) <= b for a, b in textnum._SPACELESS)
        if unicodedata.category(c)[0] in "LNM" and not alone:
            run += c
            continue
        out += [run] * bool(run) + [c] * alone
        run = ""
    return out + [run] * bool(run)


def plain_distance(item, text):
    """Edit distance of the item to its nearest stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j - 1] + (w != v), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_words_of_any_script():
    texts = ["", "Straße «été» naïve\u00a0x—y_z 12", "中文 句子abc，結束。", "\u3000かな カナ", "ไทย e\u0301a", "😀 a😀b 𠀀𠀁", "\ud800x", "plain words only", "中", "x"]
    hashes, borders = textnum.unicode_words(texts)
    flat = [w for t in texts for w in plain_words(t)]
    assert borders.tolist() == list(np.cumsum([0] + [len(plain_words(t)) for t in texts]))
    assert hashes.tolist() == textnum.unicode_words([" ".join(flat)])[0].tolist()
    assert len(set(hashes.tolist())) == len(set(flat))


def test_decontamination_agrees_with_edit_distances():
    r = random.Random(11)
    chinese = "今天天气很好我们一起去公园散步然后回家吃饭看书"
    items = [prose(600 + k, r.choice([1, 2, 3, 5, 8, 12, 20, 31])) for k in range(40)] + [chinese, "中文", "Été déjà vu", "x"]
    texts = []
    for k, t in enumerate(items):
        w = plain_words(t)
        for edit in range(r.randrange(3)):
            at = r.randrange(len(w) + 1)
            w[at: at + r.randrange(2)] = [f"new{k}"] * r.randrange(2)
        texts.append(prose(700 + k, r.randrange(15)) + (" —" + " ".join(w) + "… ") + prose(800 + k, r.randrange(15)))
    texts += ["前面" + chinese[:10] + "x" + chinese[10:] + "后面", "", chinese]
    found = decontaminate.matches(texts, decontaminate.Items(list(range(len(items))), items))
    want = set()
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            own = plain_words(item)
            distance = plain_distance(own, plain_words(text))
            if distance <= decontaminate.edits(len(own)):
                want.add((t, i, distance))
    assert {f[:3] for f in found} == want and len(want) > 40
    for t, i, distance, first, n in found:
        assert plain_distance(plain_words(items[i]), plain_words(texts[t])[first: first + n]) == distance


def test_decontamination_of_very_long_texts_in_one_batch(spark):
    item = prose(900, 30)
    long = [prose(901 + k, 120_000) + " " + item for k in range(4)]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert rows(decontaminate.contaminated(docs, benchmark), "doc_id", "first_word") == [(k, 120_000) for k in range(4)]
    assert decontaminate.clean_rows(docs, benchmark).count() == 0


def test_license_scan(odd):
    assert rows(license_scan.licenses(odd), "doc_id", "license", "coverage") == [(10, "mit-line", 1.0)]
    assert license_scan.licenses(odd.limit(0)).count() == 0
    template = license_scan.TEMPLATES["mit"].split()
    text = " ".join(template[:30] + ["Acme", "Inc"] + template[30:])
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    assert [h[1] for h in scanner.scan([prose(1, 50) + " " + text + " " + text + " " + prose(2, 50)])] == ["mit"]
    for seed in range(50):
        r = random.Random(seed)
        a, b = [r.randrange(9) for _ in range(12)], [r.randrange(9) for _ in range(12)]
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p < q and s < t for (p, s), (q, t) in zip(pairs, pairs[1:]))


def test_html_blocks_and_labels(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    model = html_blocks.train([r["html"] for r in pages.orderBy("page_id").limit(100).collect()], turns=8)
    held = [r["html"] for r in pages.orderBy(F.desc("page_id")).limit(60).collect()]
    got = html_blocks.article_texts(held, model)
    want = ["\n\n".join(t for path, t, _ in html_blocks.blocks(p) if html_blocks.weak_label(path)) for p in held]
    assert sum(g[0] == w for g, w in zip(got, want)) >= 58
    page = "<title>t</title><p>a &amp;  b<p>c<br>d<script>x</script><!-- y --><ul><li>e<li>f</ul>g"
    assert [t for _, t, _ in html_blocks.blocks(page)] == ["a & b", "c d", "e", "f", "g"]
    odd_pages = spark.createDataFrame(
        [(1, "u", None, 1), (2, None, "", 2), (2, None, "", 2), (None, "u", "<", 3)], "page_id long, url string, html string, text int")
    found = html_blocks.extract(odd_pages, model).collect()
    assert len(found) == 4 and {r["text"] for r in found} <= {"", "<"}
    assert html_blocks.extract(odd_pages.limit(0), model).count() == 0


def test_pipeline_stages(spark, odd, tmp_path):
    benchmark = spark.createDataFrame([(1, prose(7, 40))], "item_id long, text string")
    benchmark.write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs = odd.select(*corpus_pipeline.COLUMNS)
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    done = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    ids = sorted(r["doc_id"] for r in done if r["doc_id"] is not None)
    # 2, 3 copy 1; 4, 5, 6, 12 have no letters; 13 and 14 are the benchmark item
    assert ids == [1, 7, 7, 8, 9, 10, 11]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), f"file://{tmp_path}").count() == 0


NEAR = {"apache-2.0-line", "apache-2.0-notice", "cc-by-4.0-line", "cc-by-nc-4.0-line", "gpl-3.0-line", "gpl-3.0-notice", "mit-line", "mit"}


def test_license_marks_tell_near_misses_apart(spark):
    lines = {
        "Released under the MIT License.": "mit-line", "Released under an MIT License.": "mit-line", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0-line",
        "Licensed under the Apache License 2.0.": "apache-2.0-line", "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0-line",
        "This work is licensed under the GNU General Public License (GPL), version 3.": "gpl-3.0-line"}
    others = [
        "Released under the BSD License.", "Released under the MIT-0 License.", "Licensed under CC BY 4.0.", "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC 3.0.", "This work is licensed under the GNU General Public License, version 2.", "Licensed under the Apache License, Version 1.1.",
        "This work is licensed under the GNU Lesser General Public License, version 3.", "This work is licensed under the GNU Affero General Public License, version 3.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        license_scan.TEMPLATES["gpl-3.0-notice"].replace("version 3", "version 2"),
        license_scan.TEMPLATES["gpl-3.0-notice"].replace("GNU General", "GNU Lesser General"),
        license_scan.TEMPLATES["mit"] + " The Software shall be used for Good, not Evil."]
    docs = [(i, f"{prose(i, 9)}\n{t}\n{prose(i + 50, 9)}") for i, t in enumerate([*lines, *others])]
    got = rows(license_scan.licenses(spark.createDataFrame(docs, "doc_id long, text string")), "doc_id", "license")
    assert [g for g in got if g[1] in NEAR] == [(i, n) for i, n in enumerate(lines.values())]
    # a near miss in front does not hide the line itself
    both = [(1, "Released under the BSD License. Released under the MIT License."), (2, "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.")]
    got = rows(license_scan.licenses(spark.createDataFrame(both, "doc_id long, text string")), "doc_id", "license", "coverage")
    assert [g for g in got if g[1] in NEAR] == [(1, "mit-line", 1.0), (2, "cc-by-nc-4.0-line", 1.0)]


def test_license_texts_are_whole(spark):
    lines = {"all-rights-reserved": "All rights reserved.", "lgpl-2.1-line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
             "mpl-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.", "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
             "mit-disclaimer": "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of "
             "merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, "
             "damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use "
             "or other dealings in the software."}
    texts = [*license_scan.TEMPLATES.values(), *lines.values()]
    names = [*license_scan.TEMPLATES, *lines]
    docs = spark.createDataFrame([(i, f"{prose(i, 9)}\n{t}\n{prose(i + 99, 9)}") for i, t in enumerate(texts)], "doc_id long, text string")
    got = sorted(tuple(r) for r in license_scan.licenses(docs).select("doc_id", "license", "coverage").collect())
    inside = [(names.index("apache-2.0-notice"), "apache-2.0-line", 1.0)]  # a statement that is the notice's first sentence
    assert got == sorted([(i, n, 1.0) for i, n in enumerate(names)] + inside)
    table = spark.createDataFrame([("rights", "All rights reserved.", ["all rights"]), ("copy", license_scan.TEMPLATES["gpl-copy-notice"], None)],
                                  "license string, text string, marks array<string>")
    assert sorted({r["license"] for r in license_scan.licenses(docs, table).collect()}) == ["copy", "rights"]
