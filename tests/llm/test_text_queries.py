"""Every registered text query over the smallest tables: against its twin, or against brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from checks.compare import difference
from farelane.llm.oracle import ORACLE_SQL
from farelane.llm.queries import QUERIES, tokenizer_file

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    expected = connection.sql(ORACLE_SQL[name]).df()
    actual = QUERIES[name](spark, FOLDER).toPandas()
    for column in set(actual.columns) & set(expected.columns):
        expected[column] = expected[column].astype(actual[column].dtype)
    assert len(actual) and difference(actual, expected) is None


def test_every_number_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_pieces_are_the_librarys(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    expected = {}
    for doc_id, text in docs:
        ids = library.encode(text or "")
        texts = ",".join(map(str, ids)), library.decode(ids)
        expected[doc_id] = (len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in texts))
    actual = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op3_sentencepiece"](spark, FOLDER).collect()}
    assert actual == expected


def simhash_by_hand(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components_by_hand(prints: dict) -> dict:
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, docs):
    prints = {i: simhash_by_hand(t) for i, t in docs}
    labels = components_by_hand(prints)
    actual = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash_near_dedup"](spark, FOLDER).collect()}
    assert actual == {i: (f"{prints[i]:016x}", labels[i]) for i in prints}
    assert len(set(labels.values())) < len(labels)


def test_packing(spark, docs):
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    expected = {}
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected[doc_id, piece] = (start, len(part), zlib.crc32(part.tobytes()))
    rows = QUERIES["op6_best_fit_packing"](spark, FOLDER).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    # Best-fit decreasing over the pieces themselves needs as many sequences.
    rooms = Counter()
    for length in sorted((v[1] for v in expected.values()), reverse=True):
        room = min((r for r in rooms if r >= length and rooms[r]), default=None)
        if room is not None:
            rooms[room] -= 1
        rooms[(room or 4096) - length] += 1
    assert len(places) == sum(rooms.values())


def test_repeats(spark, docs):
    seen, expected = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                covered[s : s + 100] = b"x" * 100
            seen.add(window)
        kept = bytes(x for x, c in zip(data, covered) if not c)
        spans = len(bytes(covered).replace(b"\0", b" ").split())
        expected[doc_id] = (len(data), sum(map(bool, covered)), spans, hashlib.sha256(kept).hexdigest())
    actual = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op9_suffix_dedup"](spark, FOLDER).collect()}
    assert actual == expected
    assert sum(v[1] for v in expected.values()) > 10_000


def test_surrogates_leave_no_entity_and_touch_nothing_else(spark, docs):
    from farelane.llm.entities import mentions

    before = dict(docs)
    rows = QUERIES["op1_pii_surrogates"](spark, FOLDER).collect()
    new_of, found = {}, 0
    for r in rows:
        old = mentions(before[r.doc_id])
        assert r.n_mentions == len(old)
        if not old:
            assert r.text == before[r.doc_id]
            continue
        new = mentions(r.text)
        assert [m.kind for m in new] == [m.kind for m in old]
        for a, b in zip(old, new):
            found += 1
            assert before[r.doc_id][a.start : a.end] not in r.text
            assert new_of.setdefault((a.kind, a.value), b.value) == b.value
        outside = lambda text, ms: [text[s:e] for s, e in zip([0, *(m.end for m in ms)], [*(m.start for m in ms), len(text)])]
        assert outside(r.text, new) == outside(before[r.doc_id], old)
    assert found > 5 and len(set(new_of.values())) == len(new_of)
    assert not set(new_of.values()) & {v for _, v in new_of}
