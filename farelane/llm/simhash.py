"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint of 64 bits is cut into 32 segments of two bits. Its counts of set bits per
segment are a point; the Manhattan distance of two points never exceeds the number of
bits in which the fingerprints differ. The points within distance 3 are found with
grids: the axes form six groups, of which at least three agree whole if the distance is 3
or less. Each choice of three groups is a grid, and its cells are the counts on
these axes. Pairs that share a cell pass the Manhattan bound and then the exact
comparison of bits.

Only distinct fingerprints enter the search. Cells with many of them are cut into
blocks, so that no task holds more than two blocks, and a block pair passes on links that
join its fingerprints, not every pair of a group.

Cases, by definition:

* null and empty texts and texts without words have fingerprint zero, linked like others;
* texts of fewer words than a shingle are one shingle;
* rows with equal text share a fingerprint and a component; repeated rows stay repeated;
* the component of rows without any id is null; ids need not be unique;
* ties of bits (set in exactly half the shingles) are 0; an empty table stays empty;
* very long texts are hashed in blocks; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm import shingle_sets
from farelane.llm.common import land, map_batches
from farelane.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Most fingerprints of one cell that one block holds.
BLOCK = 2048
_HASH_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _HASH_BLOCK):
        part = words[at : min(at + _HASH_BLOCK, n) + shingle - 1]
        rows = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [words]
        hashes = np.array([digest(b" ".join(row), SEED) for row in rows], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp) with the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])

    narrow = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return map_batches(narrow, run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, text_key long, fp long")


def _segment_counts(fps: np.ndarray) -> np.ndarray:
    """Set bits in each of the 32 two-bit segments, one row per fingerprint."""
    ones = np.uint64(0x5555555555555555)
    pairs = (fps & ones) + ((fps >> np.uint64(1)) & ones)
    return ((pairs[:, None] >> np.arange(0, 64, 2, dtype=np.uint64)) & np.uint64(3)).astype(np.int64)


def grid_cells(fps: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """The cell of each fingerprint in each grid, as (grid, fingerprint) longs."""
    groups = 2 * max_bits
    counts = _segment_counts(fps)
    axes = np.arange(32) % groups
    cells = []
    for grid, chosen in enumerate(combinations(range(groups), groups - max_bits)):
        cell = np.full(len(fps), grid, np.int64)
        for axis in np.flatnonzero(np.isin(axes, chosen)):
            cell = cell * 3 + counts[:, axis]
        cells.append(cell)
    return np.array(cells)


def _cells(fps: DataFrame, max_bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            cells = grid_cells(values.view(np.uint64), max_bits)
            for cell in cells:
                yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column("fp")], ["cell", "fp"])

    return map_batches(fps.select("fp"), run, "cell long, fp long")


def _links(left: np.ndarray, right: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``max_bits``: the Manhattan bound of the segment counts first, then the bits."""
    a, b = _segment_counts(left).astype(np.int8), _segment_counts(right).astype(np.int8)
    found = []
    step = max(1, (1 << 22) // max(1, 32 * len(right)))
    for at in range(0, len(left), step):
        near = np.abs(a[at : at + step, None, :] - b[None, :, :]).sum(axis=2, dtype=np.int16) <= max_bits
        i, j = np.nonzero(near)
        same = np.bitwise_count(left[at + i] ^ right[j]) <= max_bits
        found.append((at + i[same], j[same]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _spanning(fps: np.ndarray, home: np.ndarray, block: int, max_bits: int) -> np.ndarray:
    """Links that join what lies within ``max_bits`` among the fingerprints of one block pair.

    A link of two rows with one label adds nothing, so labels are spread until they rest and
    each row passes on one link to its least neighbour chain.
    """
    n = len(fps)
    own = np.flatnonzero(home == block)
    i, j = _links(fps[own], fps, max_bits)
    i = own[i]
    keep = i != j
    i, j = i[keep], j[keep]
    label = np.arange(n)
    while len(i):
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(n))
    return np.stack([fps[moved].view(np.int64), fps[label[moved]].view(np.int64)], axis=1)


def _pairs_of(rows: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside small groups, all groups of a batch at once; rows are (group start, group end, fp)."""
    start, end, fps = rows
    n = len(fps)
    later = end - np.arange(n) - 1
    i = np.repeat(np.arange(n), later)
    j = i + 1 + (np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later))
    counts = _segment_counts(fps.view(np.uint64)).astype(np.int8)
    near = np.abs(counts[i] - counts[j]).sum(axis=1, dtype=np.int16) <= max_bits
    i, j = i[near], j[near]
    same = np.bitwise_count(fps[i].view(np.uint64) ^ fps[j].view(np.uint64)) <= max_bits
    return fps[i[same]], fps[j[same]]


def _join_cells(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (cell, low, high, home, fp) sorted by their first three columns; links out."""
    kept: list[np.ndarray] = []

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def work(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
        starts, ends = np.r_[0, cut], np.r_[cut, rows.shape[1]]
        sizes = ends - starts
        small = (sizes > 1) & (sizes <= 16)
        if small.any():
            chosen = np.repeat(small, sizes)
            ends_of = np.repeat(np.cumsum(sizes[small]), sizes[small])
            yield out(*_pairs_of((None, ends_of, rows[4][chosen]), max_bits))
        for s, e in zip(starts[sizes > 16], ends[sizes > 16]):
            block = rows[:, s:e]
            links = _spanning(block[4].view(np.uint64), block[3], block[1, 0], max_bits)
            yield out(links[:, 0].copy(), links[:, 1].copy())

    for batch in batches:
        rows = np.stack([c.to_numpy() for c in batch.columns])
        if not rows.shape[1]:
            continue
        whole = np.concatenate([*kept, rows], axis=1)
        last = (whole[:3] != whole[:3, -1:]).any(axis=0)
        done = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if done:
            yield from work(whole[:, :done])
        kept = [np.ascontiguousarray(whole[:, done:])]
    if kept and kept[0].shape[1]:
        yield from work(kept[0])


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that join all within ``max_bits`` bits."""
    cells = _cells(fps, max_bits)
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    sizes = land(sizes.select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "grid-cells")
    placed = cells.join(sizes, "cell").select("cell", "blocks", "fp", F.pmod(F.xxhash64("fp"), F.col("blocks")).alias("home"))
    spread = placed.select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("other"), "home", "fp"
    ).select("cell", F.least("home", "other").alias("low"), F.greatest("home", "other").alias("high"), "home", "fp")
    dealt = spread.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high")
    return map_batches(dealt, lambda batches: _join_cells(batches, max_bits), "a long, b long")


def _grouped(prints: DataFrame, distinct: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``prints`` with component_id, the least id of what the edges between values of ``key`` join."""
    found = components(edges)
    linked = distinct.join(found.withColumnRenamed("node", key), key)
    lowest = linked.groupBy("label").agg(F.min("least_id").alias("component_id"))
    linked = linked.join(lowest, "label").select(key, "component_id")
    alone = distinct.where("n > 1").join(linked.select(key), key, "left_anti").select(key, F.col("least_id").alias("component_id"))
    groups = land(linked.unionByName(alone), "print-groups")
    return (
        prints.join(groups.withColumn("grouped", F.lit(True)), key, "left")
        .select(*prints.columns, F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_key, fp, component_id) per row of ``docs`` (columns doc_id, text)."""
    prints = land(fingerprints(docs, shingle), "fingerprints")
    distinct = land(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "distinct-prints")
    return _grouped(prints, distinct, links(distinct, max_bits), "fp")


def similar_texts(docs: DataFrame, block: int = shingle_sets.BLOCK) -> DataFrame:
    """(doc_id, text_key, component_id) per row of ``docs``: components of Jaccard similarity 0.8 of five-word shingles.

    Fingerprints of the shingle sets lead to near-identical texts by segment counts and grids; ``shingle_sets`` verifies
    them and finds the others. Cells of more than ``block`` texts are dealt as block pairs.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    prints = land(keyed.select("doc_id", "text_key"), "text-keys")
    distinct = land(prints.groupBy("text_key").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "distinct-texts")
    again = land(distinct.where("n > 1").select("text_key"), "repeated-texts")
    texts = keyed.select("text_key", "text")
    once = texts.join(again, "text_key", "left_anti")
    texts = once.unionByName(texts.join(again, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text")))
    drawn = land(shingle_sets.sketches(texts), "sketches", free_shuffles=True)
    first = land(drawn.groupBy("fp").agg(F.min("key").alias("key")), "set-prints")
    same = drawn.join(first.withColumnRenamed("key", "a"), "fp").where("key <> a").select("a", F.col("key").alias("b"))
    ends = [first.select(F.col("fp").alias(side), F.col("key").alias(f"{side}_key")) for side in ("a", "b")]
    near = links(first).where("a <> b").join(ends[0], "a").join(ends[1], "b").select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))
    return _grouped(prints, distinct, shingle_sets.links(texts, distinct.count(), same.unionByName(near), drawn, block), "text_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of similar texts, that with the smallest id; same columns.

    Similar are texts with a Jaccard similarity of 0.8 of their five-word shingles, not those of
    ``near_duplicates``. Rows that repeat both id and text leave one. Rows without an id stay
    only where no row of their group has one.
    """
    groups = land(similar_texts(docs), "near-groups")
    named = [F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")]
    drop = land(groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(*named).distinct(), "near-drops")
    again = groups.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select(*named)
    again = land(again, "repeated-rows")

    def on(side: DataFrame):
        return docs["doc_id"].eqNullSafe(side["_id"]) & (F.xxhash64(docs["text"]) == side["_text"])

    kept = docs.join(drop, on(drop), "left_anti")
    once = kept.join(again, on(again), "left_anti")
    return once.unionByName(kept.join(again, on(again), "left_semi").dropDuplicates(["doc_id", "text"]))
