"""Token alignment, periodic runs and the source curriculum against brute force, and their defined results for odd input."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_text_cases import LONG, by_id, frame
from tokenizers import Tokenizer

from farelane.llm import curriculum, periodic_runs, token_alignment
from farelane.llm.common import land
from farelane.llm.queries import QUERIES, tokenizer_file

FOLDER = "/root/testdata/sf0.001"
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (4, LONG), (None, LONG), (5, "x " * 4000), (6, "▁ <|endoftext|></s> ﬁ é́ 日本\U0001f600")]
    return frame(spark, [(i, t, "a") for i, t in texts])


# Token alignment


def aligned_by_hand(texts: list[str | None]) -> list[tuple]:
    """The contract's columns for each text, by plain loops over whole lists."""
    left = Tokenizer.from_file(tokenizer_file(A))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(B))
    letters = {v: k for k, v in _byte_to_letter().items()}
    rows, holders = [], Counter()
    for text in texts:
        a = left.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        spelled_a = [bytes(letters[c] for c in left.id_to_token(i)) for i in a]
        pieces = [right.id_to_piece(i) for i in b]
        spelled_b = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or not b"".join(spelled_a) == b"".join(spelled_b) == f" {text}".encode():
            rows.append(([], [], [], Counter()))
            continue
        ends_a, ends_b = (list(accumulate(map(len, s))) for s in (spelled_a, spelled_b))
        common = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for high in common:
            inside = [[i for i, e in zip(ids, ends) if low < e <= high] for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append(inside)
            low = high
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        holders.update(links.keys())
        rows.append((a, b, groups, links))
    highest: dict[int, int] = defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    out = []
    for a, b, groups, links in rows:
        shown = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        best = sum(n for (x, y), n in links.items() if holders[x, y] == highest[x])
        total = sum(n * holders[p] for p, n in links.items())
        out.append((len(a), len(b), len(groups), sum(links.values()), best, total, hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    return out


def _byte_to_letter() -> dict[int, str]:
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return {b: chr(b if b in kept else next(rest)) for b in range(256)}


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_of_all_documents(spark, docs):
    expected = dict(zip(docs, aligned_by_hand(list(docs.values()))))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_token_alignment"](spark, FOLDER).collect()}
    assert got == expected and sum(r[3] > r[2] for r in got.values()) > 100


def test_alignment_of_odd_rows(spark, odd):
    def run(docs, **how):
        found = token_alignment.align(docs, tokenizer_file(A), tokenizer_file(B), **how)
        written = land(found.withColumn("groups_sha256", F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")).drop("groups"), "odd")
        return sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in token_alignment.with_counts(written).collect()), key=str)

    rows = [(r.doc_id, r.text) for r in odd.collect()]
    expected = sorted(((i, *row) for (i, _), row in zip(rows, aligned_by_hand([t for _, t in rows]))), key=str)
    assert run(odd) == expected == run(odd, block_chars=1)
    assert run(odd.limit(0)) == []


def test_stretches_and_irregular_groups():
    rng = random.Random(2)
    for _ in range(3000):
        n = rng.randrange(1, 60)
        a = sorted({*rng.sample(range(1, n + 1), rng.randrange(n)), n})
        b = a if rng.random() < 0.2 else sorted({n, *(x for x in range(1, n + 1) if (x in a) != (rng.random() < 0.2))})
        common = sorted(set(a) & set(b))
        assert token_alignment.group_ends(a, b) == tuple([s.index(x) + 1 for x in common] for s in (a, b))


def test_large_groups_are_linked_whole(monkeypatch):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 5, 300), rng.integers(0, 7, 200)
    cuts = np.array([1, 250, 300]), np.array([1, 199, 200])
    found = token_alignment.linked_pairs(a, b, *cuts)
    monkeypatch.setattr(token_alignment, "_LINKS", 10)
    expected = Counter()
    for (s, e), (t, f) in zip([(0, 1), (1, 250), (250, 300)], [(0, 1), (1, 199), (199, 200)]):
        expected.update((int(x) << 32) | int(y) for x in a[s:e] for y in b[t:f])
    for pairs, times in (found, token_alignment.linked_pairs(a, b, *cuts)):
        assert dict(zip(pairs.tolist(), times.tolist())) == expected


def aligned_words(pair, texts: list[str]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups, links of each pair) for each text, by the operator's worker."""
    out = [None] * len(texts)
    for part in pair.align(texts):
        for i, row in enumerate(part.rows.tolist()):
            span = slice(part.ends[i - 1] if i else 0, part.ends[i])
            out[row] = (*(int(c[i]) for c in part.counts), part.groups[i].as_py(), dict(zip(part.pairs[part.links[span]].tolist(), part.times[span].tolist())))
    return out


def test_words_are_aligned_once(monkeypatch):
    given, real = [], token_alignment.group_ends
    monkeypatch.setattr(token_alignment, "group_ends", lambda a, b: given.append(len(a)) or real(a, b))
    pair = token_alignment.TokenPair(tokenizer_file(A), tokenizer_file(B))
    words = [f"{w}{s}" for w in ("unbelievable", "Größe", "aiaiai", "tokenization") for s in ("", ",", ".", "###", "\nThe")]
    once = sum(r[0] for r in aligned_words(pair, words))
    rng = random.Random(5)
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(40)]
    # Every text was aligned token by token before.
    assert sum(r[0] for r in aligned_words(pair, texts)) > 100 * once and sum(given) <= once


def test_texts_of_words_as_whole_texts(monkeypatch):
    pair = token_alignment.TokenPair(tokenizer_file(A), tokenizer_file(B))
    atoms = ["the", "don't", "aiaiai", "a\nb", "\n", "—", "“q”", "ﬁ", "é", "日本語", "\U0001f600", "<|endoftext|>", "</s>", "", "###", "\u3000", "Ж·", "x" * 60, "▁"]
    rng = random.Random(6)
    texts = ["", " ", "a  b", "the end ", *(" ".join(rng.choices(atoms, k=rng.randrange(1, 20))) for _ in range(200))]
    texts += [f"a {w} b a" for w in ("ab" * 700, "日本" * 600, "€" * 1000, "é" * 1001)]

    def by_hand(text: str) -> tuple:
        ids = [pair.a.tokenizer.encode(f" {text}", add_special_tokens=False).ids, pair.b.model.encode(text)] if text else [[], []]
        spelled = [[s.spelled[i] for i in x] for s, x in zip((pair.a, pair.b), ids)]
        if not text or any(b"".join(s) != f" {text}".encode() for s in spelled):
            return 0, 0, 0, 0, "", {}
        ends = [list(accumulate(map(len, s))) for s in spelled]
        groups, low = [], 0
        for high in sorted(set(ends[0]) & set(ends[1])):
            groups.append([[i for i, e in zip(x, own) if low < e <= high] for x, own in zip(ids, ends)])
            low = high
        links = Counter((x << 32) | y for a, b in groups for x in a for y in b)
        return *map(len, ids), len(groups), links.total(), ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups), dict(links)

    expected = [by_hand(t) for t in texts]
    assert sum(r[0] > 0 for r in expected) > 50 and sum(r[0] == 0 for r in expected) > 50
    assert aligned_words(pair, texts) == expected
    # Small stores, and few links of a word that is kept.
    monkeypatch.setattr(token_alignment, "_MOST_WORDS", 2)
    monkeypatch.setattr(token_alignment, "_WORD_LINKS", 3)
    pair.store, pair.before = {}, {}
    assert [r for at in range(0, len(texts), 3) for r in aligned_words(pair, texts[at : at + 3])] == expected


# Periodic runs


def runs_by_hand(words: list, least: int = 6, periods: int = 4) -> list[tuple[int, int, int]]:
    """Every period over the whole sequence, smallest first; a longer period of the same words is none."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x, found = np.array([numbers[w] for w in words]), []
    for p in range(1, len(words) // periods + 1):
        same = np.r_[False, x[p:] == x[:-p], False]
        edges = np.flatnonzero(np.diff(same.astype(int)))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e - s + p >= max(least, periods * p) and not any(q[0] <= s and s + e - s + p <= q[0] + q[1] and p % q[2] == 0 for q in found):
                found.append((s, e - s + p, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_lyndon_words_and_runs():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randrange(40), rng.choice([1, 2, 3, 4])
        s = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randrange(1, 6)
            s = [s[i] if i < a else s[min(n - 1, a + (i - a) % p)] for i in range(n)]
        longest = []
        for i in range(n):
            j = i + 1
            while j < n and s[j:] > s[i:]:
                j += 1
            longest.append(j - i)
        assert periodic_runs.lyndon_lengths(s) == longest
        for least, periods in ((6, 4), (2, 2), (3, 3), (6, 2)):
            assert periodic_runs.text_runs(" ".join(map(str, s)), least, periods)[0] == runs_by_hand(s, least, periods)


def periodic_by_hand(doc_id, text, planted: bool = True) -> tuple:
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_hand(words)
    best = min(((-length, s, p) for s, length, p in runs), default=None)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    shown = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return len(runs), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()


def test_periodic_runs_of_all_documents(spark, docs):
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {r.doc_id: tuple(r[c] for c in names) for r in QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    assert got == {i: periodic_by_hand(i, t) for i, t in docs.items()}
    assert sum(r[0] > 0 for r in got.values()) > 10


def test_periodic_runs_of_odd_rows(odd):
    got = by_id(periodic_runs.collapse_runs(odd), "doc_id", "runs", "collapsed")
    mixed_ = "▁ <|endoftext|></s> ﬁ é́ 日本\U0001f600"
    plain = [(1, [], ""), (2, [], ""), (3, [], ""), (4, [], LONG), (4, [], LONG), (None, [], LONG), (5, [(0, 4000, 1)], "x"), (6, [], mixed_)]
    assert [(i, [tuple(r) for r in runs], c) for i, runs, c in got] == sorted(plain, key=str)
    assert periodic_runs.collapse_runs(odd.limit(0)).collect() == []


# Curriculum


def mixed_rows(spark, rows):
    return frame(spark, [(i, None if n is None else " ".join(["w"] * n), s) for i, n, s in rows])


def test_targets_share_the_excess(spark):
    rows = [(i, n, s) for i, (n, s) in enumerate([(10, "a"), (300, "b"), (40, "c"), (90, None), (0, "d")])]
    got = {r.source: (r.source_size, r.target) for r in curriculum.targets(curriculum.sized(mixed_rows(spark, rows), "x")).collect()}
    # By rounds: share by weight, stop the full, share what they leave.
    size, weight = {"a": 10, "b": 300, "c": 40, "d": 0, None: 90}, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    aims, total = {}, 1.5 * 440
    while True:
        left = {s for s in size if s not in aims}
        even = (total - sum(aims.values())) / sum(weight[s] for s in left)
        full = {s for s in left if even * weight[s] > 2 * size[s]}
        aims |= {s: 2.0 * size[s] for s in full}
        if not full:
            aims |= {s: even * weight[s] for s in left}
            break
    assert {s: t[0] for s, t in got.items()} == size and {s: t[1] for s, t in got.items()} == pytest.approx(aims)


def test_curriculum_meets_targets_in_any_slicing(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0, 1, 5, 30, 200]), rng.choice(["hot"] * 6 + ["b", "c", None])) for i in range(300)]
    docs = mixed_rows(spark, rows)
    found = {}
    for size in (1, 7, 20_000):
        mixed = curriculum.curriculum(docs, curriculum.Mix(slice_rows=size))
        found[size] = by_id(mixed, "doc_id", "size", "source_size", "target", "copies")
        taken = defaultdict(int)
        for r in mixed.collect():
            used = sum(c.taken for c in r.copies)
            taken[r.source, r.target] += used
            assert used <= 2 * r.size and all(0 <= c.position <= 1 for c in r.copies)
        assert all(t == int(target) for (_, target), t in taken.items())
    assert found[1] == found[7] == found[20_000]


def test_positions_follow_the_schedules(spark):
    """At each time, a source has given the share of its target that the integral of its weight has reached."""
    mix = curriculum.Mix()
    rows = [(i, 3, f"s{i % 3}") for i in range(900)]
    order = curriculum.training_order(curriculum.curriculum(mixed_rows(spark, rows), mix)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    for k, schedule in enumerate(mix.schedules):
        knots, levels = zip(*schedule)
        grid = np.linspace(0, 1, 20001)
        done = np.cumsum(np.interp(grid, knots, levels))
        own = [r for r in order if r.source == f"s{k}"]
        before = np.cumsum([0] + [r.taken for r in own])[:-1] / sum(r.taken for r in own)
        at = np.interp([r.position for r in own], grid, done / done[-1])
        assert np.abs(at - before).max() < 2e-3


def test_curriculum_of_odd_rows(spark, odd):
    got = by_id(curriculum.curriculum(odd).withColumn("taken", curriculum.taken_words(F.col("copies"))), "doc_id", "size", "taken")
    assert len(got) == 8 and {r[:2] for r in got} == {(1, 0), (2, 0), (3, 0), (4, 60), (None, 60), (5, 4000), (6, 5)}
    assert sum(r[2] for r in got) == 3 * sum(r[1] for r in got) // 2
    assert curriculum.curriculum(odd.limit(0)).collect() == []
    assert {r[2] for r in by_id(curriculum.curriculum(odd.where("doc_id < 4")).withColumn("t", F.size("copies")), "doc_id", "size", "t")} == {0}
