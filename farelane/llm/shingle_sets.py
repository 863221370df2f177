"""Texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, all of them.

Three steps, each exact in what it joins; the last one misses nothing.

1. SimHash fingerprints of the sets, searched by segment counts in grids (``simhash.links``): near-identical
   texts. At similarity 0.8 fingerprints of 64 bits differ in ten bits on average and in 17 now and then, and grids for
   17 bits would have more cells than there are texts, so the rest is looked for on the sets themselves.
2. Sets a, b with |a & b| / |a | b| >= 0.8 share 0.8 of the larger one, so in any common order of all
   shingles their first n - ceil(0.8 n) + 1 meet. Rare shingles come first; how rare is estimated on a sample of
   texts, which changes the number of candidates but no result. Texts that share a shingle form a cell; its
   least and greatest text are compared with its others.
3. Cells of one group are done with, however large. In the others (of crowded ones first the nearest pairs, which join most
   of a group of near copies) texts of different groups are compared through the
   same embedding as fingerprints: a set is a long bit string, cut into segments by hash, and the Manhattan distance of
   the segments' bit counts never exceeds the number of bits in which two sets differ, a ninth of
   both sizes at similarity 0.8. Few pairs pass that are not similar. A crowded cell is dealt as pairs of blocks.

Pairs that share enough shingles of both prefixes are then verified on the whole sets.

Sets hold 64-bit hashes. Texts of fewer than five words are one shingle, and so are texts without
words, which equal each other. Of a very long text, a task holds the set of shingles, eight bytes each, once per
side of a candidate pair; segment counts stop at 255, which only weakens the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import land, map_batches
from farelane.llm.components import components

WORDS = 5
#: Texts on which shingle counts are estimated, and most counts that are kept.
SAMPLE = 20_000
COUNTS = 200_000
#: Segments of a set's bit string.
SEGMENTS = 128
#: Most texts of one cell that one block holds, and from how many on the nearest pairs of a cell go first.
BLOCK = 4096
CROWD = 16
_SEED = 42
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ROWS = 1 << 19
#: Pairs whose segment counts are compared at a time.
_PAIRS = 1 << 15


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    hashes = np.array([xxhash.xxh64_intdigest(w, _SEED) for w in words] or [0], np.uint64)
    n = max(1, len(hashes) - WORDS + 1)
    mixed = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(hashes))):
        mixed = (mixed ^ hashes[k : k + n]) * _MIX
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a similarity of 0.8 or more."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    place = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return bool(9 * np.count_nonzero(a[place] == b) >= 4 * (len(a) + len(b)))


def prefix(shingles: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles of which at least one is shared with every similar set, rare ones first."""
    n = len(shingles)
    often = np.zeros(n, np.int64)
    if len(known):
        place = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        often = np.where(known[place] == shingles, counts[place], 0)
    return shingles[np.lexsort((shingles, often))[: n - (4 * n + 4) // 5 + 1]]


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns.values()], list(columns))


def _frequent(texts: DataFrame, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several sampled texts hold, and in how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                yield _batch({"h": shingle_set(text.as_py()).view(np.int64)})

    part = F.pmod(F.xxhash64("text_key"), F.lit(1_000_000)) < int(1_000_000 * min(1, SAMPLE / max(1, n_texts)))
    found = map_batches(texts.where(part).select("text"), run, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 2")
    rows = found.orderBy(F.desc("n"), "h").limit(COUNTS).toArrow()
    known, counts = rows["h"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(known)
    return known[order], counts[order]


def _prefixes(texts: DataFrame, known: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(h, key, size): the prefix of each text, with the size of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0

        def out() -> pa.RecordBatch:
            h, key, size = zip(*kept)
            lengths = [len(x) for x in h]
            repeated = [np.repeat(np.array(x, t), lengths) for x, t in ((key, np.int64), (size, np.int32))]
            return _batch({"h": np.concatenate(h).view(np.int64), "key": repeated[0], "size": repeated[1]})

        for batch in batches:
            for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text")):
                shingles = shingle_set(text.as_py())
                first = prefix(shingles, known, counts)
                kept.append((first, key, len(shingles)))
                rows += len(first)
                if rows >= _ROWS:
                    yield out()
                    kept, rows = [], 0
        if kept:
            yield out()

    return map_batches(texts, run, "h long, key long, size int")


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of a stream sorted by its first one, cut between its values."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        before = np.flatnonzero(columns[0] != columns[0][-1])
        cut = int(before[-1]) + 1 if len(before) else 0
        if not cut and kept and kept[0][0][-1] != columns[0][0]:
            yield [np.concatenate(c) for c in zip(*kept)]
            kept = []
        if cut:
            yield [np.concatenate(c) for c in zip(*kept, [c[:cut] for c in columns])]
            kept = []
        kept.append([c[cut:] for c in columns])
    if kept:
        yield [np.concatenate(c) for c in zip(*kept)]


def _ranges(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.r_[0, np.flatnonzero(h[1:] != h[:-1]) + 1]
    return starts, np.r_[starts[1:], len(h)]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, key, size) of cells of several texts, with the least and greatest text of the cell."""
    for h, key, size in _by_cell(batches):
        starts, ends = _ranges(h)
        n = ends - starts
        several = np.repeat(n > 1, n)
        low, high = np.repeat(starts, n)[several], np.repeat(ends - 1, n)[several]
        columns = {"h": h[several], "key": key[several], "size": size[several]}
        yield _batch(columns | {"low": key[low], "low_size": size[low], "high": key[high], "high_size": size[high]})


def sketches(texts: DataFrame) -> DataFrame:
    """(key, fp, counts) per text: fingerprint of its set, and the set's bits per segment, at most 255 each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, counts = [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py())
                ones = np.zeros(64, np.int64)
                for at in range(0, len(shingles), 1 << 16):
                    part = shingles[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
                    ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                prints.append(int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<i8")[0]))
                inside = np.bincount((shingles % np.uint64(SEGMENTS)).astype(np.int64), minlength=SEGMENTS)
                counts.append(np.minimum(inside, 255).astype(np.uint8).tobytes())
            columns = [batch.column("text_key"), pa.array(prints, pa.int64()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "fp", "counts"])

    return map_batches(texts.select("text_key", "text"), run, "key long, fp long, counts binary")


def _distances(i: np.ndarray, j: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Manhattan distances of the segment counts of pairs."""
    parts = [np.abs(counts[i[at : at + _PAIRS]] - counts[j[at : at + _PAIRS]]).sum(axis=1, dtype=np.int32) for at in range(0, len(i), _PAIRS)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _across(batches: Iterator[pa.RecordBatch], nearest: int | None) -> Iterator[pa.RecordBatch]:
    """Rows (cell, home, label, key, size, counts) sorted by cell; pairs of different labels that may be alike, with the sum and the larger of their sizes.

    A cell is a shingle and two blocks of its texts; of two different blocks only pairs across are looked at. May be alike: the
    Manhattan distance is at most a ninth of both sizes. With ``nearest``, each text passes on so many pairs of a cell at most, those of least distance.
    A pair that several cells of the task have is one row, with their number.
    """
    waiting: list[np.ndarray] = []
    held = 0

    def out() -> pa.RecordBatch:
        a, b, both, larger = np.concatenate(waiting, axis=1)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        n = np.diff(np.r_[first, len(a)])
        return _batch({"a": a[first], "b": b[first], "n": n, "both": both[order][first], "larger": larger[order][first]})

    for cell, home, label, key, size, counts in _by_cell(batches):
        for start, end in zip(*_ranges(cell)):
            own, blocks, keys, n = (c[start:end] for c in (label, home, key, size.astype(np.int64)))
            if (own == own[0]).all():
                continue
            bits = np.frombuffer(b"".join(counts[start:end]), np.uint8).reshape(-1, SEGMENTS).astype(np.int16)
            two = blocks.min() != blocks.max()
            rows = np.flatnonzero(blocks == blocks[0]) if two else np.arange(len(own))
            step = max(1, (1 << 19) // len(own))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                open_ = own[some, None] != own[None, :]
                open_ &= 5 * np.minimum(n[some, None], n) >= 4 * np.maximum(n[some, None], n)
                open_ &= (blocks[some, None] != blocks) if two else (some[:, None] < np.arange(len(own)))
                i, j = np.nonzero(open_)
                i = some[i]
                distance = _distances(i, j, bits)
                passed = 9 * distance <= n[i] + n[j]
                i, j, distance = i[passed], j[passed], distance[passed]
                if nearest is not None and len(i):
                    order = np.lexsort((distance, i))
                    i, j = i[order], j[order]
                    first = np.maximum.accumulate(np.where(np.r_[True, i[1:] != i[:-1]], np.arange(len(i)), 0))
                    kept = np.arange(len(i)) - first < nearest
                    i, j = i[kept], j[kept]
                if len(i):
                    a, b = keys[i], keys[j]
                    waiting.append(np.stack([np.minimum(a, b), np.maximum(a, b), n[i] + n[j], np.maximum(n[i], n[j])]))
                    held += len(i)
                if held >= _ROWS:
                    yield out()
                    waiting, held = [], 0
    if held:
        yield out()


def _enough(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) with enough shared shingles of their prefixes, the sum of n.

    What two sets share outside both prefixes lies behind the prefix that ends first, so it is
    less than 0.8 of the larger set; four ninths of both sizes must be shared.
    """
    counted = pairs.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("both").alias("both"), F.max("larger").alias("larger"))
    return counted.where(9 * (F.col("n") + F.ceil(F.col("larger") * 4 / 5) - 1) >= 4 * F.col("both")).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of similar sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(made, pa.binary())], ["key", "held"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c) for c in ("left", "right"))
            same = [alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    keys = land(pairs.select(F.col("a").alias("text_key")).unionByName(pairs.select(F.col("b").alias("text_key"))).distinct(), "candidates")
    held = land(map_batches(texts.join(keys, "text_key", "left_semi").select("text_key", "text"), sets, "key long, held binary"), "candidate-sets", free_shuffles=True)
    both = pairs.join(held.withColumnsRenamed({"key": "a", "held": "left"}), "a").join(held.withColumnsRenamed({"key": "b", "held": "right"}), "b")
    return land(map_batches(both.select("a", "b", "left", "right"), compare, "a long, b long"), "similar-pairs", free_shuffles=True)


def _open_pairs(shared: DataFrame, found: DataFrame, drawn: DataFrame, block: int, nearest: int | None = None) -> DataFrame:
    """(a, b, n, both, larger): pairs of texts in different groups of the links ``found`` that share n shingles and may be alike, in parts."""
    labels = land(components(found).select(F.col("node").alias("key"), "label"), "set-labels")
    labelled = shared.join(labels, "key", "left").select("h", F.coalesce("label", "key").alias("label"), "key", "size")
    labelled = land(labelled, "labelled-shingles", free_shuffles=True)
    mixed = labelled.groupBy("h").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    if nearest is not None:
        mixed = mixed.where(F.col("n") >= CROWD)
    mixed = land(mixed.select("h", F.ceil(F.col("n") / block).alias("blocks")), "mixed-cells", free_shuffles=True)
    placed = labelled.join(mixed, "h").withColumn("home", F.pmod(F.xxhash64("key"), F.col("blocks")))
    placed = placed.join(drawn.select("key", "counts"), "key")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    spread = placed.select("h", "home", other, "label", "key", "size", "counts")
    cell = F.xxhash64("h", F.least("home", "other"), F.greatest("home", "other")).alias("cell")
    dealt = spread.select(cell, "home", "label", "key", "size", "counts").repartition("cell").sortWithinPartitions("cell")
    return map_batches(dealt, lambda batches: _across(batches, nearest), "a long, b long, n long, both long, larger long")


def links(texts: DataFrame, n_texts: int, near: DataFrame, drawn: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): keys of similar texts, joining all that are similar; ``texts`` has each text_key once.

    ``near`` has pairs that fingerprints led to, not yet verified; ``drawn`` is the written result of ``sketches``.
    """
    cells = _prefixes(texts.select("text_key", "text"), *_frequent(texts, n_texts)).repartition("h").sortWithinPartitions("h", "key")
    shared = land(map_batches(cells, _shared, "h long, key long, size int, low long, low_size int, high long, high_size int"), "shared-shingles", free_shuffles=True)

    def ends(side: str) -> DataFrame:
        other = F.col(f"{side}_size")
        alike_in_size = 5 * F.least("size", other) >= 4 * F.greatest("size", other)
        pairs = shared.where((F.col("key") != F.col(side)) & alike_in_size)
        sizes = F.lit(1).alias("n"), (F.col("size") + other).alias("both"), F.greatest("size", other).alias("larger")
        return pairs.select(F.least("key", side).alias("a"), F.greatest("key", side).alias("b"), *sizes)

    # A pair that is passed over here, or in the step after, is met again among those no link has joined.
    first = _enough(ends("low").unionByName(ends("high")))
    tried = land(first.unionByName(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct(), "first-pairs", free_shuffles=True)
    found = _verified(tried, texts)
    nearest = _open_pairs(shared, found, drawn, block, nearest=1).select("a", "b").distinct()
    nearest = land(nearest.join(tried, ["a", "b"], "left_anti"), "nearest-pairs", free_shuffles=True)
    found, tried = found.unionByName(_verified(nearest, texts)), tried.unionByName(nearest)
    rest = land(_enough(_open_pairs(shared, found, drawn, block)).join(tried, ["a", "b"], "left_anti"), "other-pairs", free_shuffles=True)
    return found.unionByName(_verified(rest, texts))
