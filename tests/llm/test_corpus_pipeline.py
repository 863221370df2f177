"""The stages in their order, each on what the one before kept, against the operators' rules by hand."""

from __future__ import annotations

from collections import Counter

import pytest
from test_text_queries import FOLDER
from tokenizers import Tokenizer

import corpus_pipeline
from farelane.llm.common import land
from farelane.llm.entities import mentions
from farelane.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(land(stage(spark, found[-1], FOLDER), "stage"))
    assert all(f.columns == docs.columns for f in found[1:-1])
    return [{r.doc_id: r.text for r in f.collect()} for f in found[:-1]], found[-1].collect()


def similar_groups(texts: dict[int, str]) -> dict[int, int]:
    """The least id each text is joined to by five-word shingles with a Jaccard similarity of 0.8 or more, over all pairs."""

    def shingles(text):
        words = text.encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in texts}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if g == old else g for k, g in group.items()}
    return group


def test_stages_keep_and_change_what_they_should(steps):
    (raw, good, cleaned, distinct, private), packed = steps
    # Quality: what has 50 words and is not made of repeated windows stays (no host has a frequent line here).
    def fails(text):
        words = (text or "").encode().split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        return len(words) < 50 or 2 * len(covered) > len(words)

    assert good == {i: t for i, t in raw.items() if not fails(t)} and len(good) < len(raw)
    # Lines: rows stay, texts lose whole lines only.
    assert cleaned.keys() == good.keys()
    assert all(not Counter(cleaned[i].split("\n")) - Counter(good[i].split("\n")) for i in good)
    # Near-duplicates: the smallest id of each group of similar texts stays.
    assert distinct == {i: cleaned[i] for i in set(similar_groups(cleaned).values())} and len(distinct) < len(cleaned)
    # Surrogates: no entity of a text is left, texts without one are untouched.
    assert private.keys() == distinct.keys()
    for i, text in distinct.items():
        old = mentions(text)
        assert old or private[i] == text
        assert not any(text[m.start : m.end] in private[i] for m in old)
    # Packing: every token of what is left has its place.
    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    sizes = Counter()
    for r in packed:
        sizes[r.doc_id] += r.length
    assert sizes == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in private.items()}


def test_run_gives_the_last_stage(spark, steps):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    place = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(place, rows)) == sorted(map(place, steps[1]))
