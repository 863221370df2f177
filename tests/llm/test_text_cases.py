"""The defined results of each text operator for odd input."""

from __future__ import annotations

import gzip
import io
import os
import random
import tracemalloc
import zipfile

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from farelane.llm import line_dedup, packing, quality_rules, run_index, sentencepiece_bpe, simhash, suffix_dedup, surrogates, topk_search, url_filter, warc_zip
from farelane.llm.common import FREE_SHUFFLES, land
from farelane.llm.components import components
from farelane.llm.entities import RANKED, Mention, luhn, mentions, ranked, rendered, surrogate
from farelane.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(60))


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    docs = spark.createDataFrame(rows, DOCS)
    return docs.selectExpr("*", "'own' AS _id", "1 AS key", "'fp' AS fp", "doc_id AS label", "'x' AS `a.b`")


def by_id(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, [(1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, LONG, "a"), (4, LONG, "a"), (None, LONG, "b"), (5, "one two", "b")])


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.limit(0)


# Quality rules


def test_quality_of_odd_rows(odd, nothing):
    got = by_id(quality_rules.judge(odd), "doc_id", "n_words", "base_failed", "kept")
    assert got == sorted(
        [(1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (4, 60, False, True), (4, 60, False, True), (None, 60, False, True), (5, 2, True, False)], key=str
    )
    assert quality_rules.judge(nothing).count() == 0
    cleaned = quality_rules.clean(odd)
    assert cleaned.columns == odd.columns and by_id(cleaned, "doc_id") == [(4,), (4,), (None,)]


def test_repeated_windows(spark):
    texts = ["a b c", "a b c d a b c", "a a a a", "a a a", "x a b c y a b c a b c", " ".join(["k l m"] * 50)]
    got = quality_rules.judge(frame(spark, [(i, t, "a") for i, t in enumerate(texts)]))

    def by_hand(text):
        w = text.split()
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        return len({i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)})

    assert by_id(got, "doc_id", "n_repeat_words") == [(i, by_hand(t)) for i, t in enumerate(texts)]


def test_depleted_documents_go_and_the_first_holder_stays(spark):
    line = " ".join(f"common{i}" for i in range(50))
    rows = [(i, f"{line}\nown words {i}", "hot") for i in range(8)] + [(100, f"{line}\nother host", "cold")]
    rules = quality_rules.QualityRules(max_line_docs=5)
    docs = frame(spark, rows)
    assert by_id(quality_rules.judge(docs, rules).where("kept"), "doc_id", "n_lost_lines") == [(0, 0), (100, 0)]
    long = frame(spark, [(i, f"{line}\n{LONG} x{i}", "hot") for i in range(8)])
    texts = {r.doc_id: r.text for r in quality_rules.clean(long, rules).collect()}
    assert texts == {0: f"{line}\n{LONG} x0"} | {i: f"{LONG} x{i}" for i in range(1, 8)}


def test_exact_copies_make_no_line_frequent(spark):
    docs = frame(spark, [(i, LONG, "hot") for i in range(9)])
    assert quality_rules.judge(docs, quality_rules.QualityRules(max_line_docs=5)).where("kept").count() == 9


# Line dedup


def test_lines_on_many_sites(spark, odd, nothing):
    rows = [(i, f"own {i}\nShared  Line\n\nshared line", f"s{i % 5}") for i in range(10)]
    got = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(frame(spark, rows), 5).collect()}
    assert got == {0: rows[0][1]} | {i: f"own {i}\n" for i in range(1, 10)}
    assert {r.text for r in line_dedup.remove_boilerplate(frame(spark, rows), 6).collect()} == {r[1] for r in rows}
    left = line_dedup.remove_boilerplate(odd)
    assert left.columns == odd.columns and by_id(left, "doc_id", "text") == by_id(odd, "doc_id", "text")
    assert line_dedup.remove_boilerplate(nothing).count() == 0


def test_sketch_and_exact_counts_agree(spark):
    rng = random.Random(5)
    lines = {f"line {k}": n for k, n in enumerate([1, 3, 98, 99, 100, 101, 102, 120, 400])}
    rows, doc = [], 0
    for line, n in lines.items():
        for site in rng.sample(range(500), n):
            rows.append((doc, line, f"site{site}"))
            doc += 1
    sites = line_dedup.line_sites(frame(spark, rows))
    wide = line_dedup.widespread(sites, 100).count()
    assert wide == sum(n >= 100 for n in lines.values())


# SimHash


def test_simhash_of_odd_rows(odd, nothing):
    got = by_id(simhash.near_duplicates(odd), "doc_id", "component_id")
    assert got == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (None, 4), (5, 5)], key=str)
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and by_id(kept, "doc_id") == [(1,), (4,), (5,)]


def test_links_in_crowded_cells_join_the_same_fingerprints(spark):
    rng = random.Random(7)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    prints = {0}
    for seed in seeds:
        for _ in range(150):
            prints.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    label = {r.node: r.label for r in components(simhash.links(fps, block=16)).collect()}
    root = {p: p for p in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(signed):
        for b in signed[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert {p: label.get(p, p) for p in signed} == {p: find(p) for p in signed}


def test_grids_miss_no_pair():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << k for k in rng.sample(range(64), 3))
        cells = simhash.grid_cells(np.array([a, b], np.uint64))
        assert (cells[:, 0] == cells[:, 1]).any()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r.node: r.label for r in components(edges).collect()} == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# Packing


def test_packing_of_odd_rows(odd, nothing):
    path = tokenizer_file("word_bpe_49k.json")
    got = packing.pack_documents(odd, path, capacity=50)
    rows = got.collect()
    assert sorted(r.length for r in rows if r.doc_id in (1, 2, 3)) == [1, 1, 1]
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert all(r.offset + r.length <= 50 for r in rows)
    assert packing.pack_documents(nothing, path).count() == 0


def test_ranks_in_parts_fill_each_slot_once(spark, monkeypatch):
    rng = random.Random(2)
    items = spark.createDataFrame([(i, rng.choice([3, 3, 3, 10, 7])) for i in range(200)], "item long, length long")
    whole = by_id(packing.pack(items, ["item"], 10), "item", "sequence_id", "offset")
    monkeypatch.setattr(packing, "RANK_ROWS", 7)
    rows = packing.pack(items, ["item"], 10).collect()
    assert sorted(((r.item, r.sequence_id, r.offset) for r in rows), key=str) == whole
    used = {}
    for r in rows:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in s) <= 10 and sorted(o for o, _ in s) == list(np.cumsum([0] + [n for _, n in sorted(s)])[:-1]) for s in used.values())


def test_words_tokenise_as_texts():
    path = tokenizer_file("word_bpe_49k.json")
    store = packing.WordIds(path)
    texts = ["á e\u0301x ΣΑΣ İI don't 's <|endoftext|>x\x1c\x85q\xa0r 12½３ ﬁ Å", "\u0301 a\n\u0327b", "", None, "'s't're x'll"]
    rng = random.Random(9)
    texts += ["".join(rng.choice(["a", "B", ".", ",", " ", "\n", "'s", "é", "K", "!", "1", "_", "<|", "ß.", "\u0301"]) for _ in range(30)) for _ in range(2000)]
    texts += ["<|EndOfText|> Ab. <|endoftext|>, c", "Ab, <| c.", "end."]
    whole = [np.array(store.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert store.of(texts) == whole


def test_words_with_and_without_closing_signs_are_stored_once(monkeypatch):
    store = packing.WordIds(tokenizer_file("word_bpe_49k.json"))
    stems = [f"{a}{b}wort{c}" for a in "abcdeéß" for b in "xyzöü" for c in ("", "ñ", "ing")]
    signs = ["", ".", ",", "%%%", "***", "###", "<|", "!!", ">=", "'", "'s", "÷", "\u0301", "…", "½"]
    texts = [" ".join(w + s for w in stems) for s in signs] + [" ".join(w.title() + s for w in stems for s in signs)]
    encoded = []
    encode = store._encode
    monkeypatch.setattr(store, "_encode", lambda words: encoded.extend(words) or encode(words))
    whole = [np.array(store.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert store.of(texts) == whole
    closed = store.of(texts[:9])
    assert closed == whole[:9] and sum(w in set(stems) for w in encoded) == len(stems)
    assert not any(w[:-1] in set(stems) for w in encoded if w.endswith((".", ",")))
    # Another tokenizer's steps are not taken for granted.
    store.letters = None
    store.clear()
    assert store.of(texts) == whole


# URL filter


def test_url_parts_and_rules(spark):
    urls = [
        ("HTTP://User@WWW.Example.ORG:80/en/12?x", "user@www.example.org:80", "/en/12", None),
        ("http://a.example.org/en/12#f", "a.example.org", "/en/12", "example.org/en/1"),
        ("http://example.org/fr", "example.org", "/fr", "org/"),
        ("http://badexample.org/es/", "badexample.org", "/es/", "org/"),
        ("http://org", "org", "", None),
        ("no scheme", "", "", None),
        (None, "", "", None),
        ("x://h.com/de/a\nb", "h.com", "/de/a\nb", "com/de/"),
    ]
    pages = spark.createDataFrame([(i, u[0], "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string, block string")
    listed = spark.createDataFrame([("h.com/de/a",), (None,), ("example.org/fr",)], "canonical string")
    rows = {r.page_id: r for r in url_filter.judge_urls(pages, listed).collect()}
    assert [(rows[i].host, rows[i].path, rows[i].rule) for i in range(len(urls))] == [u[1:] for u in urls]
    assert {i: r.verdict for i, r in rows.items()} == {0: "allow", 1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block"}
    assert rows[0].block == "clash"
    assert url_filter.judge_urls(pages.limit(0), listed).count() == 0


def test_list_decides_where_no_rule_fits(spark):
    pages = spark.createDataFrame([(i, f"http://www.h{i % 40}.net/p{i}.html?q") for i in range(400)], "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i % 40}.net/p{i}",) for i in range(0, 400, 3)], "canonical string")
    got = {r.page_id for r in url_filter.judge_urls(pages, listed).where("verdict = 'block'").collect()}
    assert got == set(range(0, 400, 3))
    assert url_filter.judge_urls(pages, listed.limit(0)).where("verdict = 'block'").count() == 0


# SentencePiece


def test_pieces_of_odd_texts():
    path = tokenizer_file("piece_bpe_32k.model")
    model, library = sentencepiece_bpe.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    letters = "ab ▁ é中文日本😀\t\n  eth the ing<s>0x"
    words = [p.replace("▁", " ") for p in model.ids]
    texts = ["", "  ", "▁▁a▁", "<s> <0x41>", "a" * 3000, "日本語" * 300, " " * 500 + "x", "\x00\x01", "def f(x):\n        return x"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(500)]
    texts += ["".join(rng.choice(words) for _ in range(20)) for _ in range(500)]
    for text, data in zip(texts, model.encode(texts)):
        ids = np.frombuffer(data, "<i4")
        assert ids.tolist() == library.encode(text)
        assert model.decode(ids, np.array([len(ids)])) == [library.decode(ids.tolist())]
    for _ in range(500):
        ids = [rng.choice([rng.randint(0, 300), rng.randint(0, 31999)]) for _ in range(12)]
        assert model.decode(np.array(ids), np.array([12])) == [library.decode(ids)]


def test_piece_frames(odd, nothing):
    path = tokenizer_file("piece_bpe_32k.model")
    tokens = sentencepiece_bpe.encode(odd, path)
    texts = by_id(sentencepiece_bpe.decode(tokens, path), "doc_id", "text")
    assert texts == sorted([(1, ""), (2, ""), (3, " \n\t"), (4, LONG), (4, LONG), (None, LONG), (5, "one two")], key=str)
    assert sentencepiece_bpe.decode(sentencepiece_bpe.encode(nothing, path), path).count() == 0


def test_pieces_in_one_pass_and_small_portions(odd, nothing, monkeypatch):
    path = tokenizer_file("piece_bpe_32k.model")
    both = sentencepiece_bpe.encode_and_decode(odd, path)
    # One worker a task: a second one would hold a second model and store in the executor's memory.
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = sentencepiece_bpe.decode(sentencepiece_bpe.encode(odd, path), path)
    assert by_id(both, "doc_id", "ids", "text") == by_id(apart, "doc_id", "ids", "text")
    assert sentencepiece_bpe.encode_and_decode(nothing, path).count() == 0
    model, library, most = sentencepiece_bpe.PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path), []
    encode_words = model._encode_words
    monkeypatch.setattr(model, "_encode_words", lambda words: most.append(sum(map(len, words)) - max(map(len, words))) or encode_words(words))
    monkeypatch.setattr(sentencepiece_bpe, "WORD_CHARS", 50)
    texts = [" ".join(f"word{i}x{k}" for i in range(40)) for k in range(5)] + ["", None, "y" * 300]
    assert [np.frombuffer(f, "<i4").tolist() for f in model.encode(texts)] == [library.encode(t or "") for t in texts]
    assert len(most) > 10 and max(most) < 100


# WARC


def test_archive_of_odd_rows(spark, tmp_path):
    html = "<p>" + "é" * 60
    pages = spark.createDataFrame([(1, None, None, 9), (2, "u\nv", html, 9), (3, "w", html, 9), (3, "w", html, 9), (None, "n", html, 9), (4, "s", "short", 9), (5, "s", "short", 9)], "page_id long, url string, html string, payload int")
    for wide in (False, True):
        packages = warc_zip.archive(pages, str(tmp_path / f"wide{wide}"), wide=wide, package_bytes=500)
        assert packages.count() >= 2
        rows = warc_zip.read_records(packages, read_bytes=300, with_payload=True).collect()
        n = len(html.encode())
        assert sorted([(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in rows], key=str) == sorted(
            [(1, 0, "response", None), (2, n, "response", None), (3, n, "revisit", 2), (3, n, "revisit", 2), (None, n, "revisit", 2), (4, 5, "response", None), (5, 5, "response", None)], key=str
        )
        assert {r.page_id: r.payload for r in rows}[2] == html.encode() and {r.page_id: r.url for r in rows}[2] == "u%0Av"
    assert warc_zip.read_records(warc_zip.archive(pages.limit(0), str(tmp_path / "none"))).count() == 0


def test_reader_takes_ranges_of_any_stored_zip(tmp_path, monkeypatch):
    data = random.Random(1).randbytes(400_000)
    for limit, count in ((zipfile.ZIP64_LIMIT, zipfile.ZIP_FILECOUNT_LIMIT), (1000, 2)):  # the second writes ZIP64 ends
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", count)
        path = tmp_path / f"z{limit}.zip"
        with zipfile.ZipFile(path, "w") as z:
            z.comment = b"PK\5\6 in a note"
            z.writestr("first.bin", data)
            z.writestr("packed.bin", b"x" * 1000, zipfile.ZIP_DEFLATED)
            z.writestr("third/é.bin", b"third")
        reader = warc_zip.RangeReader(str(path))
        members = warc_zip.stored_members(reader)
        assert set(members) == {"first.bin", "third/é.bin"}
        assert reader.bytes_read < 70_000
        assert reader.read(members["first.bin"].start + 77, 50) == data[77:127]
        assert reader.read(*members["third/é.bin"][1:]) == b"third"
    (tmp_path / "cut.zip").write_bytes(path.read_bytes()[:-40])
    with pytest.raises(ValueError):
        warc_zip.stored_members(warc_zip.RangeReader(str(tmp_path / "cut.zip")))


def test_records_are_standard(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x")], "page_id long, url string, html string")
    uri = warc_zip.archive(pages, str(tmp_path / "one")).first().uri
    with zipfile.ZipFile(uri) as z:
        record = gzip.GzipFile(fileobj=io.BytesIO(z.read(warc_zip.RECORDS))).read()
    assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n<p>x\r\n\r\n") and b"WARC-Target-URI: http://a/\r\n" in record


# Top-k


def test_search_with_ties_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 5.0]), (2, [1.0, 0.0]), (3, [0.5]), (4, None), (5, []), (6, [None, 1.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (None, [1.0, 1.0]), (2, [1.0, 0.0]), (50, [0.0, -0.001])]
    vectors = topk_search.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = [tuple(r) for r in topk_search.search(vectors, k=6).orderBy("query_id", "rank").collect()]
    one = 256 * 256
    assert got[:6] == [(0, 1, 1, one), (0, 2, 2, one), (0, 3, 2, one), (0, 4, None, one), (0, 5, 3, one // 2), (0, 6, 50, 0)]
    assert [(r[2], r[3]) for r in got[6:]] == [(0, 0), (2, 0), (2, 0), (3, 0), (None, -256), (1, -1280)]
    assert topk_search.search(vectors.limit(0)).count() == 0


def test_search_in_blocks(spark):
    rng = np.random.default_rng(4)
    data = rng.integers(-3, 4, (300, 8))
    vectors = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(data)], "id long, weights array<long>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk_search.search(vectors, every=10, query_block=7).collect()}
    for q in range(0, 300, 10):
        best = sorted((-int(data[q] @ data[c]), c) for c in range(300) if c != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(c, -s) for s, c in best]
    with pytest.raises(OverflowError):
        topk_search.scores_by_term(np.array([[1 << 40]]), np.array([[1 << 40]]))


# Suffix dedup


def test_index_gives_the_neighbours_of_each_suffix():
    rng = random.Random(3)
    for n, letters in ((0, b"a"), (1, b"a"), (60, b"a"), (300, b"ab"), (900, b"abcd\xff")):
        text = bytes(rng.choice(letters) for _ in range(n))
        text += text[: n // 2]
        index = run_index.RunIndex(np.frombuffer(text, np.uint8))
        suffixes = sorted((text[i:], i) for i in range(len(text) + 1))
        patterns = [bytes(rng.choice(letters + b"z") for _ in range(rng.randint(1, 40))) for _ in range(10)] + ([text[3:40]] if n > 40 else [])
        sizes = np.array([len(p) for p in patterns])
        starts = np.cumsum(sizes) - sizes
        above, below = index.stream(np.frombuffer(b"".join(patterns), np.uint8), starts, sizes)
        for p, s in zip(patterns, starts):
            for i in range(len(p)):
                k = sum(x < p[i:] for x, _ in suffixes)
                assert above[s + i] == (suffixes[k][1] if k < len(suffixes) else -1)
                assert below[s + i] == (suffixes[k - 1][1] if k else -1)


def removed_by_hand(rows, width):
    seen, removed = set(), {}
    for doc_id, text in sorted(rows):
        data, covered = text.encode(), set()
        for s in range(len(data) - width + 1):
            if data[s : s + width] in seen:
                covered |= set(range(s, s + width))
            seen.add(data[s : s + width])
        removed[doc_id] = bytes(x for i, x in enumerate(data) if i not in covered)
    return removed


def test_repeats_by_hand(spark, monkeypatch):
    rng = random.Random(11)
    passage = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(80, 400))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passage) if rng.random() < 0.6 else "".join(rng.choice("xyz ") for _ in range(150)) for _ in range(3)]
        text = "".join(parts)
        if rng.random() < 0.5:  # an edit that makes variants of variants
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("qrs") + text[at:]
        rows.append((i, text))
    rows += [(70, "ab" * 400), (71, "ab" * 200), (72, rows[3][1]), (73, "short")]
    for crowded in (100_000, 20):
        monkeypatch.setattr(suffix_dedup, "TARGET_LINKS", crowded)
        got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(frame(spark, [(i, t, "s") for i, t in rows])).collect()}
        assert got == removed_by_hand(rows, 100)


def test_marking_takes_a_bounded_multiple_of_the_texts():
    rng = np.random.default_rng(5)
    firsts, width = suffix_dedup._Firsts(), suffix_dedup.WIDTH
    text = rng.integers(97, 123, 1 << 16, dtype=np.uint8)
    firsts.add(0, 1, 0, text.tobytes())
    n, rows = 1 << 20, []
    for doc in (2, 3):
        data = rng.integers(97, 123, n, dtype=np.uint8)
        data[1000:1500] = text[70:570]
        rows.append((0, doc, 0, data.tobytes(), [0], [n - width], [0], [True], 1))
    firsts.build()
    suffix_dedup._POWERS.clear()
    tracemalloc.start()
    marked, opened = suffix_dedup._mark(firsts, rows, width)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert marked.to_pydict() == {"doc": [2, 3], "low": [1000] * 2, "high": [1400] * 2, "h1": [None] * 2, "h2": [None] * 2}
    flat = np.frombuffer(rows[1][3], np.uint8)[-width:]
    assert opened.shape[1] == 2 * (n - width + 1 - 401)
    assert opened[:, -1].tolist() == [3, n - width, *(int(suffix_dedup.window_hashes(flat, width, k).view(np.int64)[0]) for k in (0, 1)), 0]
    # All windows here stay open, which is the worst case; their hashes are made block by block.
    assert max(len(up) for up, _ in suffix_dedup._POWERS.values()) <= suffix_dedup.TEXT_BLOCK + width
    assert peak < 160 * 2 * n


def test_long_texts_are_cut_into_blocks(spark, monkeypatch):
    text = "".join(random.Random(2).choice("abcdefgh ") for _ in range(3000))
    text = text + text[500:1400] + "tail"
    for block in (700, 1 << 19):
        monkeypatch.setattr(suffix_dedup, "TEXT_BLOCK", block)
        data = np.frombuffer(text.encode(), np.uint8)
        held = []
        for start, part in suffix_dedup._blocks(data, 100):
            _, at, first, last = suffix_dedup.anchors(part)
            assert (at >= last).all() and (at - first <= 80).all()
            held += [w + start for a, b in zip(first, last) for w in range(a, b + 1)]
        assert held == list(range(len(text) - 99))


def test_repeats_of_odd_rows(odd, nothing, spark):
    got = by_id(suffix_dedup.remove_repeats(odd), "doc_id", "n_bytes", "n_removed")
    n = len(LONG)
    assert got == sorted([(1, 0, 0), (2, 0, 0), (3, 3, 0), (4, n, 0), (4, n, 0), (None, n, n), (5, 7, 0)], key=str)
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    copies = suffix_dedup.remove_repeats(frame(spark, [(2, LONG, "a"), (1, LONG, "a"), (3, LONG, "b")]))
    assert by_id(copies, "doc_id", "n_removed", "n_spans") == [(1, 0, 0), (2, n, 1), (3, n, 1)]


def test_repeats_among_shared_ids(spark):
    rng = random.Random(5)
    made = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    passage, a, b, c = made(150, "abcdef "), made(120, "ghijkl"), made(130, "mnopqr"), made(140, "stuvwx")
    rows = [(1, passage), (7, a + passage), (7, passage + b + passage), (8, c + passage), (8, c + passage), (None, a), (None, c + "tail")]
    got = by_id(suffix_dedup.remove_repeats(frame(spark, [(i, t, "s") for i, t in rows])), "doc_id", "kept", "n_removed")
    kept = [(1, passage, 0), (7, a, 150), (7, b, 300), (8, c, 150), (8, c, 150), (None, "", 120), (None, "tail", 140)]
    assert [(i, bytes(k).decode(), n) for i, k, n in got] == sorted(kept, key=lambda r: str((r[0], r[1].encode(), r[2])))


def test_ids_of_any_size(spark):
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = [(-(1 << 62), passage), ((1 << 62) + 1, "x" + passage), (5, passage + "y")]
    got = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.remove_repeats(frame(spark, [(i, t, "s") for i, t in rows])).collect()}
    assert got == {rows[0][0]: passage, rows[1][0]: "x", 5: "y"}


def test_steps_free_their_shuffle_files(spark, tmp_path):
    files = lambda: sum(len([n for n in names if n.startswith("shuffle_")]) for _, _, names in os.walk(blocks))
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    rows = spark.range(1000).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    before = files()
    land(rows, "freed", free_shuffles=True)
    assert files() == before and spark.conf.get(FREE_SHUFFLES) == "false"
    land(rows, "kept")
    assert files() > before


# Surrogates


def test_entities_and_formats():
    text = (
        "Mr. John Smith met Frau Müller and Mrs Smith. John Smith, Г-жа Иванова и Г-н Иванов. Mail A.b-1@Mail7.example.com. "
        "+1 (017) 555-7713 or +1 017 555 7713; 192.168.4.5, 4111 1111 1111 1111 123-45-6789 GB82 WEST 1234 5698 7654 32 "
        "not: 3.14159265 2024-01-02 v1.2.3.4.5 12345678 x@y 04dbebab91ab85687d33eeaaf9ac699e1188f962"
    )
    found = mentions(text)
    assert [m.kind.split("-")[0] for m in found] == ["given", "family", "family", "family", "given", "family", "family", "family", "email", "phone", "phone", "ip", "card", "ssn", "iban"]
    new = [rendered(m, text[m.start : m.end], surrogate(b"k", m.kind, m.value)) for m in found]
    by = dict(zip((text[m.start : m.end] for m in found), new))
    assert new[0] == new[4] and new[1] == new[5] == new[3]  # John, Smith, Mrs Smith
    assert by["Иванова"] == by["Иванов"] + "а" and all("а" <= c.lower() <= "я" for c in by["Иванова"])
    assert [c for c in by["+1 (017) 555-7713"] if c.isdigit()] == [c for c in by["+1 017 555 7713"] if c.isdigit()]
    assert by["+1 (017) 555-7713"][:4] == "+1 (" and by["192.168.4.5"].startswith("192.168.")
    assert luhn(by["4111 1111 1111 1111"].replace(" ", "")) and by["GB82 WEST 1234 5698 7654 32"][:2] == "GB"
    assert surrogate(b"k", "email", "a@b.com") != surrogate(b"other", "email", "a@b.com")


def test_clashes_get_other_attempts(spark):
    values = [f"{a}{d}@b.com" for a in "abcdefghijklmnopqrstuvwxyz" for d in range(10)]
    entities = spark.createDataFrame([("email", v) for v in values] + [("ssn", "123456789")], "kind string, value string")
    later = {(r.kind, r.value): r.attempt for r in surrogates.later_attempts(entities, b"k").collect()}
    assert later
    made = [surrogate(b"k", "email", v, later.get(("email", v), 0)) for v in values]
    assert len(set(made)) == len(values) and not set(made) & set(values)


def test_later_attempts_reach_the_texts(spark):
    values = [f"{a}{d}@b.com" for a in "abcdefghijklmnopqrstuvwxyz" for d in range(10)]
    docs = frame(spark, [(i, f"Write to {v} or {v.upper()}, please.", "s") for i, v in enumerate(values)])
    rows = surrogates.replace_entities(docs, b"k").collect()
    found = [[m.value for m in mentions(r.text)] for r in rows]
    assert all(len(f) == 2 and f[0] == f[1] for f in found) and len({f[0] for f in found}) == len(values)


def test_surrogates_of_odd_rows(odd, nothing, spark):
    left = surrogates.replace_entities(odd, b"k")
    assert left.columns == odd.columns and by_id(left, "doc_id", "text") == by_id(odd, "doc_id", "text")
    assert surrogates.replace_entities(nothing, b"k").count() == 0
    rows = surrogates.replace_entities(frame(spark, [(None, "call +1 (017) 555-7713", "a"), (1, "call 1.2.3.4", "a"), (1, "call 1.2.3.4", "a")]), b"k", "kinds").collect()
    assert sorted(str(r.kinds) for r in rows) == ["['ip']", "['ip']", "['phone']"] and len({r.text for r in rows}) == 2
    assert isinstance(mentions("x 1.2.3.4 y")[0], Mention)


# Similar texts


def _shingles_by_hand(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_similar_texts_are_all_found_and_no_others(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([60, 150, 400]))]
        texts.append(" ".join(base))
        for _ in range(7):  # edits around the bound, some on top of other edits
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, int(len(copy) * rng.choice([0.005, 0.01, 0.02, 0.025, 0.03])))):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
            base = copy if rng.random() < 0.3 else base
    texts = list(dict.fromkeys(texts))
    sets = [_shingles_by_hand(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        low, high = sorted((find(i), find(j)))
        root[high] = low
    got = {r.doc_id: r.component_id for r in simhash.similar_texts(frame(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    far = [simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[j]) for i, j in pairs]
    assert pairs and len(set(got.values())) > 12 and any(bits.bit_count() > 3 for bits in far)
    kept = simhash.keep_one(frame(spark, [(i, t, "a") for i, t in enumerate(texts)]))
    assert by_id(kept, "doc_id") == sorted(((i,) for i in set(got.values())), key=str)


def test_crowded_cells_lose_no_pair(spark):
    """One passage in every text, near copies of it at a similarity around the bound, in blocks of three."""
    rng = random.Random(12)
    shared = [f"s{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        words = list(shared)
        for at in rng.sample(range(60), rng.choice([0, 1, 1, 2])):
            words[at] = f"x{rng.randrange(50)}"
        texts.append(" ".join(words + [f"y{rng.randrange(9)}" for _ in range(rng.choice([0, 3, 30]))]))
    texts = list(dict.fromkeys(texts))
    sets = [_shingles_by_hand(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    docs = frame(spark, [(i, t, "a") for i, t in enumerate(texts)])
    for block in (3, 4096):
        got = {r.doc_id: r.component_id for r in simhash.similar_texts(docs, block).collect()}
        assert got == dict(enumerate(group)) and 1 < len(set(group)) < len(group)


# Names, by hand


def named(text):
    return [(text[m.start : m.end], m.kind.split("-")[0], m.value) for m in mentions(text)]


def test_titles_after_capitalised_words():
    for text, name in [("Dear Mr. Smith", "Smith"), ("Dear Mrs Jones,", "Jones"), ("Hello Mr. Smith", "Smith"), ("Für Frau Müller", "Müller"), ("Для Г-н Иванов", "Иванов")]:
        assert named(text) == [(name, "family", name.casefold())]
    assert named("From Dr. Ann Lee") == [("Ann", "given", "ann"), ("Lee", "family", "lee")]


def test_names_are_whole():
    assert named("Mr. John Fitzgerald Kennedy spoke.") == [("John", "given", "john"), ("Fitzgerald", "given", "fitzgerald"), ("Kennedy", "family", "kennedy")]
    assert named("Dr. John F. Kennedy") == [("John", "given", "john"), ("F.", "initial", "f"), ("Kennedy", "family", "kennedy")]
    assert named("Mrs J.K. Rowling") == [("J.K.", "initial", "jk"), ("Rowling", "family", "rowling")]
    assert named("Herr Dr. Schmidt") == [("Schmidt", "family", "schmidt")] and mentions("Herr Dr. Schmidt")[0].kind == "family-latin-m"
    assert named("Prof. Dr. Anna Schmidt kam.") == [("Anna", "given", "anna"), ("Schmidt", "family", "schmidt")]
    assert named("Mr. John Smith Sr. left") == [("John", "given", "john"), ("Smith", "family", "smith")]
    new = surrogates._replaced(b"k", "Dr. John F. Kennedy", {})[0]
    assert new.startswith("Dr. ") and new.split()[2] != "F." and new.split()[2][1:] == "." and "Kennedy" not in new


def test_names_are_followed_through_their_text():
    assert named("Mr. Smith came. Later Smith left, and SMITH's dog too.") == [("Smith", "family", "smith"), ("Smith", "family", "smith"), ("SMITH", "family", "smith")]
    text = "Dr. Ann Lee met Ann Leeds. Ann Lee, Lee and Ann stayed; Lee-Jones, O'Lee and Annex are others."
    ann, lee = ("Ann", "given", "ann"), ("Lee", "family", "lee")
    assert named(text) == [ann, lee, ann, ann, lee, lee, ann]
    assert surrogates._replaced(b"k", text, {})[0].endswith("stayed; Lee-Jones, O'Lee and Annex are others.")
    assert "Leeds" in surrogates._replaced(b"k", text, {})[0]
    assert named("Mrs. Smith's house, Smith says") == [("Smith", "family", "smith")] * 2
    assert named("Г-жа Иванова и Г-н Иванов. Иванова, Иванов") == [(n, "family", "иванов") for n in ("Иванова", "Иванов") * 2]
    assert named("Mr. John Thomas met Mr. Thomas Hill. Thomas left")[-1] == ("Thomas", "family", "thomas")
    assert named("Smith, without a title") == []


def test_ip6_in_all_forms():
    found = lambda text: [(text[m.start : m.end], m.kind, m.value) for m in mentions(text)]
    doc = "2001:db8:0:0:0:0:0:1"
    for form in ("2001:db8::1", "2001:DB8::1", "2001:0db8:0000:0000:0000:0000:0000:0001", "2001:db8:0:0::1"):
        for text in ("From {} today", "{}", "at [{}]:443", "{}.", "see {}: down", "ip:{}", "Source:{}, {}/64"):
            assert found(text.replace("{}", form)) == [(form, "ip6", doc)] * text.count("{}"), text
    assert found("fe80::1%eth0 ::1") == [("fe80::1", "ip6", "fe80:0:0:0:0:0:0:1"), ("::1", "ip6", "0:0:0:0:0:0:0:1")]
    assert found("::ffff:192.168.4.5 192.168.4.5 ::FFFF:c0a8:405") == [(f, "ip", "192.168.4.5") for f in ("::ffff:192.168.4.5", "192.168.4.5", "::FFFF:c0a8:405")]
    assert found("12:30:45 std::vector a :: b 00:1a:2b:3c:4d:5e Foo::add 1:2:3 x::1 2001:db8::1::2 2001:db8::12345") == []
    new = surrogates._replaced(b"k", "2001:db8::1 2001:db8:0:0:0:0:0:1 fe80::1 ::ffff:192.168.4.5 192.168.4.5", {})[0].split()
    assert new[0] == new[1] != "2001:db8::1" and new[2].startswith("fe80:") and new[3] == "::ffff:" + new[4] and new[4].startswith("192.168.")


#: Text and what must be found in it, in order: written down by hand.
WRITTEN = [
    ("Mr. O'Brien's dog saw O’Brien.", ["O'Brien"]),
    ("Mr. van der Berg met Berg.", ["Berg", "Berg"]),
    ("Yesterday M. de Gaulle spoke; de Gaulle left.", ["Gaulle", "Gaulle"]),
    ("Видел г-н Иванов и г-жа Иванова.", ["Иванов", "Иванова"]),
    ("the señor García and madame Bovary", ["García", "Bovary"]),
    ("seen by dr. Ann Lee, not by Ann Leeds", ["Ann", "Lee", "Ann"]),
    ("Mr. J. R. O'Neil", ["J.", "R.", "O'Neil"]),
    ("herr Müller, hm. Dr", ["Müller"]),
    ("a drama Smith wrote, 5 m. Dupont", []),
    ("ring +49 30 123456 or 030 123456", ["+49 30 123456", "030 123456"]),
    ("mail a.b@c.example.org from 10.1.2.3, fe80::1", ["a.b@c.example.org", "10.1.2.3", "fe80::1"]),
]


def test_written_entities_are_found():
    for text, expected in WRITTEN:
        assert [text[m.start : m.end] for m in mentions(text)] == expected, text


def test_replaced_texts_keep_their_frame(spark):
    docs = frame(spark, [(i, text, "a") for i, (text, _) in enumerate(WRITTEN)])
    got = {r.doc_id: r.text for r in surrogates.replace_entities(docs, b"k").collect()}
    for i, (text, expected) in enumerate(WRITTEN):
        # What stands between the entities is there, in order, and the entities are not.
        rest, at = [], 0
        for entity in expected:
            found = text.index(entity, at)
            rest.append(text[at:found])
            at = found + len(entity)
        rest.append(text[at:])
        place = 0
        for part in rest:
            place = got[i].index(part, place) + len(part)
        assert (got[i] == text) == (not expected)
        whole = [e for e in expected if len(e) > 2]
        assert not any(f" {e} " in f" {got[i]} " for e in whole)
    assert got[9].startswith("ring +49 ") and len(got[9]) == len(WRITTEN[9][0])


@pytest.mark.parametrize("value, code", [("+4930123456", "+49"), ("+15550109999", "+1"), ("+35312345678", "+353"), ("+79161234567", "+7")])
def test_country_codes_stay(value, code):
    for attempt in (0, 1, 5, RANKED, RANKED + 77):
        new = surrogate(b"k", "phone", value, attempt)
        assert new.startswith(code) and len(new) == len(value) and new != value


def test_a_full_network_gets_distinct_replacements(spark):
    """All addresses of a /16 and most numbers of a short form: nothing of the form is left, so lists of wider forms follow."""
    nets = [f"192.168.{a}.{b}" for a in range(256) for b in range(256)]
    rows = [(i, "hosts " + " and ".join(nets[i : i + 512]), "a") for i in range(0, len(nets), 512)]
    docs = frame(spark, rows + [(i + 1, t, "b") for i, t, _ in rows[:2]])
    texts = {r.doc_id: r.text for r in surrogates.replace_entities(docs, b"k").collect()}
    new = {i: t.removeprefix("hosts ").split(" and ") for i, t in texts.items()}
    first = [a for i in range(0, len(nets), 512) for a in new[i]]
    assert len(first) == len(set(first)) == len(nets) and not set(first) & set(nets)
    assert all(a.startswith("10.") for a in first) and new[1] == new[0] and new[513] == new[512]


def test_lists_of_replacements_have_no_repeats():
    for kind, value in (("ip", "192.168.3.4"), ("ip", "10.0.0.1"), ("ip", "8.8.8.8"), ("ssn", "123456789"), ("phone", "+4912")):
        made = [ranked(b"k", kind, value, rank) for rank in range(70_000)]
        assert len(set(made)) == len(made)
    assert ranked(b"k", "ip", "192.168.3.4", 65_536).startswith("10.") and len(ranked(b"k", "phone", "+4912", 90)) == 6


# Host-relative limits, and the list of the URL filter


def test_lines_of_small_and_large_hosts(spark):
    shared = " ".join(f"c{i}" for i in range(9))
    rows = [(i, f"{shared}\n{LONG} x{i}", "small") for i in range(7)] + [(100 + i, LONG + f" y{i}" + (f"\n{shared}" if i < 7 else ""), "large") for i in range(80)]
    lost = {r.doc_id for r in quality_rules.judge(frame(spark, rows)).where("n_lost_lines > 0").collect()}
    assert lost == set(range(1, 7))
    every = quality_rules.QualityRules(max_line_percent=5)
    assert {r.doc_id for r in quality_rules.judge(frame(spark, rows), every).where("n_lost_lines > 0").collect()} == {*range(1, 7), *range(101, 107)}


def test_rules_and_list_have_work_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    judged = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    assert judged.where("n_lost_lines > 0").count() > 0
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    listed = url_filter.named_urls(pages)
    verdicts = url_filter.judge_urls(pages.select("page_id", "url"), listed)
    blocked = verdicts.where("rule IS NULL AND verdict = 'block'")
    assert 0 < blocked.count() < verdicts.count() and blocked.select("canonical").distinct().count() <= listed.count()
    # A filter that is too full lets unlisted URLs pass; the exact join takes them out again.
    half = pages.where("page_id % 3 = 0").select(url_filter.canonical_url(F.col("url")).alias("canonical"))
    roomy, tight = (by_id(url_filter.judge_urls(pages.select("page_id", "url"), half, bits_per_url=n), "page_id", "verdict") for n in (16, 2))
    assert roomy == tight
    one_block = [df.withColumn("block", F.lit(0).cast("long")) for df in (half, pages.select(url_filter.canonical_url(F.col("url")).alias("canonical")))]
    probed = url_filter.possible_hits(one_block[1], url_filter.bloom_blocks(one_block[0], 1)).where("maybe")
    assert probed.join(half, "canonical", "left_anti").count() > 0 and probed.join(half, "canonical", "left_semi").count() == half.count()
