"""Removal of passages that occur earlier in the corpus, with run-length indexes.

Each window of ``width`` bytes has an anchor, the least-hashed short string in it, so equal
windows have equal anchors at equal places. Anchors that occur once rule their windows out.
For the others, the text around the first occurrence goes to a task with the text of later
occurrences. There the first occurrences are indexed as a run-compressed Burrows-Wheeler transform
with sampled run ends, the later texts are streamed through it, and windows whose match is
long enough and lies earlier are marked. What differs from the first occurrence of its
anchor can still equal another later one; these few windows are compared by hash over the cluster.

Cases, by definition:

* null and empty texts have no bytes; texts shorter than ``width`` lose nothing;
* order is by id, then place; matches never cross documents;
* rows that share an id are ordered by a hash of their text, and rows without an id come last, in that order too; rows with
  equal id and text are one document, so none of them is earlier than the other;
* exact copies after the first lose all bytes; an empty table stays empty;
* very long texts are cut into overlapping blocks, so memory is bounded;
* ``kept`` is bytes, as a cut may fall inside a character; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from farelane.llm.common import land, map_batches, ship
from farelane.llm.run_index import RunIndex

WIDTH = 100
#: Long enough that few anchors repeat by chance, short enough that anchors stay sparse.
ANCHOR = 40
#: Bytes of a text handled at once, of first occurrences in one index (small enough for a processor cache), and of later
#: texts streamed at once.
TEXT_BLOCK = 1 << 19
INDEX_BYTES = 1 << 18
STREAM_BYTES = 1 << 21
STREAM_PIECE = 1 << 10
#: First occurrences are dealt by blocks of a document; blocks with more links are dealt to several tasks.
TARGET_BLOCK = 1 << 16
TARGET_LINKS = 100_000
#: Windows that a task holds back to see whether they repeat in it at all.
OPEN_WINDOWS = 2_000_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_BASES = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def window_hashes(data: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each window of ``size`` bytes: a polynomial by prefix sums, mixed."""
    if len(data) < size:
        return np.empty(0, np.uint64)
    if which not in _POWERS or len(_POWERS[which][0]) < len(data):
        _POWERS[which] = _powers(_BASES[which], max(len(data), TEXT_BLOCK + WIDTH))
    up, down = _POWERS[which]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    found = (sums[size:] - sums[:-size]) * down[: len(data) - size + 1]
    for m in _MIX:
        found ^= found >> np.uint64(32)
        found *= m
    return found ^ (found >> np.uint64(29))


def anchors(data: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of the anchors of a block of fewer than 2^20 bytes."""
    hashes = window_hashes(data, anchor)
    windows = len(data) - width + 1
    if windows < 1:
        return (np.empty(0, np.int64),) * 4
    # High bits rank, low bits tell the place: the least is the leftmost of the least-ranked.
    low = np.uint64((1 << 20) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span, reach = width - anchor + 1, 1
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    place = (least & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    at = place[first]
    return hashes[at].view(np.int64), at, first, np.r_[first[1:], windows] - 1


def _blocks(data: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Overlapping blocks, each with windows of its own."""
    for start in range(0, max(1, len(data) - width + 1), TEXT_BLOCK):
        yield start, data[start : start + TEXT_BLOCK + width - 1]


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def corpus_anchors(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """(h, doc, pos, before, after): each anchor, and how far before it its first and last windows begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
                for start, block in _blocks(_bytes(text.as_py()), width):
                    h, at, first, last = anchors(block, width, anchor)
                    parts.append(np.stack([h, np.full(len(h), doc), at + start, at - first, at - last]))
                    size += len(h)
                if size > 100_000:
                    yield out(parts)
                    parts, size = [], 0
            if parts:
                yield out(parts)

    def out(parts: list[np.ndarray]) -> pa.RecordBatch:
        h, doc, pos, before, after = np.concatenate(parts, axis=1)
        columns = [pa.array(h), pa.array(doc), pa.array(pos), pa.array(before.astype(np.int16)), pa.array(after.astype(np.int16))]
        return pa.RecordBatch.from_arrays(columns, ["h", "doc", "pos", "before", "after"])

    return map_batches(docs.select("doc", "text"), run, "h long, doc long, pos long, before smallint, after smallint")


def _intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals; touching ones are joined."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    opens = np.r_[True, starts[1:] > ends[:-1]]
    return starts[opens], ends[np.r_[np.flatnonzero(opens)[1:], len(starts)] - 1]


_TASK_ROW = "doc0 long, block long, role int, doc long, start long, data binary, low array<bigint>, high array<bigint>, shift array<bigint>, more array<boolean>"
_TASK_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_())]
_TASK_NAMES = [f.split()[0] for f in _TASK_ROW.split(", ")]


def _regions(joined: DataFrame, width: int) -> DataFrame:
    """Rows for the tasks: text around first occurrences (role 0) and later texts with their windows (role 1)."""

    def of(doc: int, data: np.ndarray, firsts: pa.Array | None, links: pa.StructArray | None) -> Iterator[tuple]:
        if firsts is not None:
            at = np.unique(firsts.to_numpy())
            block = at // TARGET_BLOCK
            for b in np.unique(block).tolist():
                own = at[block == b]
                for s, e in zip(*_intervals(np.maximum(own - width, 0), np.minimum(own + width, len(data)))):
                    yield doc, b, 0, doc, int(s), data[s:e].tobytes(), [], [], [], []
        if links is not None:
            pos, before, after, doc0, pos0, more = (links.field(k).to_numpy(zero_copy_only=False) for k in ("pos", "before", "after", "doc0", "pos0", "more"))
            block = pos0 // TARGET_BLOCK
            order = np.lexsort((pos - before, block, doc0))
            pos, before, after, doc0, pos0, more, block = (x[order] for x in (pos, before, after, doc0, pos0, more, block))
            low, high, shift = pos - before, pos - after, pos0 - pos
            end = high + width
            part = low // TARGET_BLOCK
            cut = (doc0[1:] != doc0[:-1]) | (block[1:] != block[:-1]) | (low[1:] > end[:-1]) | (part[1:] != part[:-1])
            opens = np.flatnonzero(np.r_[True, cut])
            for a, b in zip(opens, np.r_[opens[1:], len(pos)]):
                s, e = int(low[a]), int(end[a:b].max())
                yield int(doc0[a]), int(block[a]), 1, doc, s, data[s:e].tobytes(), low[a:b].tolist(), high[a:b].tolist(), shift[a:b].tolist(), more[a:b].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for k in range(batch.num_rows):
                doc, text = (batch.column(c)[k].as_py() for c in ("doc", "text"))
                for row in of(doc, _bytes(text), batch.column("firsts")[k].values, batch.column("links")[k].values):
                    rows.append(row)
                    size += len(row[5]) + 32 * len(row[6])
                    if size > STREAM_BYTES:
                        yield out(rows)
                        rows, size = [], 0
            if rows:
                yield out(rows)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TASK_TYPES)], _TASK_NAMES)

    return map_batches(joined.select("doc", "text", "firsts", "links"), run, _TASK_ROW)


class _Firsts:
    """First occurrences gathered for one index."""

    def __init__(self) -> None:
        self.parts: list[tuple[int, int, int, bytes]] = []  # group, doc, start, data
        self.size, self.index = 0, None

    def add(self, group: int, doc: int, start: int, data: bytes) -> None:
        self.parts.append((group, doc, start, data))
        self.size += len(data) + 1

    def build(self) -> None:
        if self.index is None:
            # 0xFF is in no UTF-8 text, so no match crosses it.
            self.index = RunIndex(np.frombuffer(b"\xff".join(p[3] for p in self.parts) + b"\xff", np.uint8))
            sizes = np.array([len(p[3]) + 1 for p in self.parts])
            self.at = np.cumsum(sizes) - sizes
            self.group, self.doc, self.start = (np.array([p[k] for p in self.parts], np.int64) for k in range(3))

    def where(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document and place of positions in the index."""
        part = np.maximum(np.searchsorted(self.at, at, "right") - 1, 0)
        return self.doc[part], self.start[part] + at - self.at[part]

    def position(self, group: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Positions in the index of places of a group's document; parts are in the order of group and place."""
        part = np.maximum(np.searchsorted(self.group * (1 << 44) + self.start, group * (1 << 44) + place, "right") - 1, 0)
        return np.where(self.group[part] == group, self.at[part] + place - self.start[part], -1)


def _mark(firsts: _Firsts, rows: list[tuple], width: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """Marks windows of the later texts; rows are (group, doc, start, data, low, high, shift, more, salts).

    Returns the marked ranges, and (doc, place, hash, hash, whether other tasks have the anchor too) of the open windows.
    """
    firsts.build()
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    sizes = np.array([len(r[3]) for r in rows])
    base = np.cumsum(sizes) - sizes
    # What a row says of its bytes is looked up where it is needed: one number a byte tells the row.
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    group, doc, start, salts = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2, 8))
    to_place = start - base
    limit = (base + sizes).astype(np.int32)[owner]
    # Windows whose anchor is linked: their shift to the first occurrence, and whether there are others.
    counts = [len(r[4]) for r in rows]
    low, high, shift, more = (np.concatenate([np.array(r[k]) for r in rows]) for k in (4, 5, 6, 7))
    to_flat = np.repeat(to_place, counts)
    low, high = low - to_flat, high - to_flat
    lengths = high - low + 1
    windows = np.repeat(low - (np.cumsum(lengths) - lengths), lengths)
    windows += np.arange(len(windows))
    marked = np.zeros(len(data), bool)
    for at in firsts.index.stream(data, *_pieces(base, sizes, width)):
        hit = np.flatnonzero(firsts.index.long_matches(data, limit, at, width))
        at_doc, at_place = firsts.where(at[hit])
        own, place = doc[owner[hit]], hit + to_place[owner[hit]]
        marked[hit] |= (at_doc < own) | ((at_doc == own) & (at_place < place))
    left = ~marked[windows]
    # A match that lies later may hide the first occurrence: it is compared itself.
    rest, rest_shift, rest_more = windows[left], np.repeat(shift, lengths)[left], np.repeat(more, lengths)[left]
    place = rest + to_place[owner[rest]]
    at = np.full(len(data), -1, np.int32)
    at[rest] = np.minimum(firsts.position(group[owner[rest]], place + rest_shift), len(firsts.index.text))
    equal = firsts.index.long_matches(data, limit, at, width)
    marked |= equal
    keep = np.zeros(len(data), bool)
    keep[windows] = marked[windows]
    found = np.flatnonzero(keep)
    found_doc, found_place = doc[owner[found]], found + to_place[owner[found]]
    opens = np.flatnonzero(np.r_[True, (found[1:] != found[:-1] + 1) | (found_doc[1:] != found_doc[:-1]) | (found_place[1:] != found_place[:-1] + 1)]) if len(found) else found
    closes = np.r_[opens[1:], len(found)] - 1 if len(found) else found
    none = pa.nulls(len(opens), pa.int64())
    marked_ranges = pa.RecordBatch.from_arrays([pa.array(found_doc[opens]), pa.array(found_place[opens]), pa.array(found_place[closes]), none, none], _FOUND_NAMES)
    still = ~equal[rest] & rest_more
    rest, place = rest[still], place[still]
    keys = [_hashes_at(data, rest, width, which) for which in (0, 1)]
    return marked_ranges, np.stack([doc[owner[rest]], place, *keys, salts[owner[rest]] > 1])


def _hashes_at(data: np.ndarray, places: np.ndarray, width: int, which: int) -> np.ndarray:
    """The hashes of some windows, block by block: those of all windows take dozens of bytes for each byte."""
    found = np.empty(len(places), np.int64)
    for start, block in _blocks(data, width):
        own = np.flatnonzero((places >= start) & (places < start + TEXT_BLOCK))
        if len(own):
            found[own] = window_hashes(block, width, which)[places[own] - start].view(np.int64)
    return found


def _pieces(base: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of overlapping pieces of the texts, so that many short ones are streamed side by side.

    A piece ends ``width`` bytes inside the next, which so decides on all windows that begin there.
    """
    counts = -(-sizes // STREAM_PIECE)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    shift = STREAM_PIECE * (np.arange(counts.sum()) - first)
    starts, left = np.repeat(base, counts) + shift, np.repeat(sizes, counts) - shift
    return starts, np.minimum(left, STREAM_PIECE + width)


def _open(parts: list[np.ndarray], whole: bool) -> Iterator[pa.RecordBatch]:
    """Open windows that need the comparison over the cluster: where all of an anchor's texts were
    here (``whole``, and not dealt to several tasks), only those met twice."""
    doc, place, h1, h2, elsewhere = np.concatenate(parts, axis=1)
    if whole:
        _, back, count = np.unique(h1, return_inverse=True, return_counts=True)
        need = (count[back] > 1) | (elsewhere > 0)
        doc, place, h1, h2 = doc[need], place[need], h1[need], h2[need]
    if len(doc):
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (doc, place, place, h1, h2)], _FOUND_NAMES)


_FOUND = "doc long, low long, high long, h1 long, h2 long"
_FOUND_NAMES = [f.split()[0] for f in _FOUND.split(", ")]


def _match(dealt: DataFrame, width: int) -> DataFrame:
    """Rows sorted by (doc0, block, salt, role, start): marked ranges of windows, and windows to compare by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, later, size = _Firsts(), [], 0
        held: list[np.ndarray] = []
        key, group, whole = None, -1, True

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal later, size, held, whole
            if later:
                marked, left = _mark(firsts, later, width)
                yield marked
                held.append(left)
                later, size = [], 0
            too_many = sum(h.shape[1] for h in held) > OPEN_WINDOWS
            whole = whole and not too_many
            if held and (last or too_many):
                yield from _open(held, whole)
                held = []

        for batch in batches:
            names = ["doc0", "block", "salt", "role", "doc", "start", "data", "low", "high", "shift", "more", "salts"]
            for k in range(batch.num_rows):
                doc0, block, salt, role, doc, start, data, low, high, shift, more, salts = (batch.column(c)[k].as_py() for c in names)
                if (doc0, block, salt) != key:
                    key = (doc0, block, salt)
                    if firsts.size > INDEX_BYTES or firsts.index is not None:
                        yield from flush(True)
                        firsts, whole = _Firsts(), True
                    group += 1
                if role == 0:
                    firsts.add(group, doc, start, data)
                    continue
                later.append((group, doc, start, data, low, high, shift, more, salts))
                size += len(data)
                if size > STREAM_BYTES:
                    yield from flush(False)
        yield from flush(True)

    return map_batches(dealt, run, _FOUND)


def _numbers(docs: DataFrame) -> DataFrame | None:
    """(doc, doc_id, text_key): numbers in the order of id, then text hash, null ids last; None where ids can serve themselves.

    A range sort numbers the rows of each part; the parts' sizes give where each begins.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    if rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return None
    distinct = rows.distinct()
    order = (F.col("doc_id").asc_nulls_last(), F.col("text_key"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            columns = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, ["part", "place", "doc_id", "text_key"])
            at += n

    id_type = rows.schema["doc_id"].dataType.simpleString()
    sorted_ = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = land(map_batches(sorted_, number, f"part int, place long, doc_id {id_type}, text_key long"), "document-places", free_shuffles=True)
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0).cast("long")).alias("start"))
    return land(placed.join(starts, "part").select((F.col("start") + F.col("place")).alias("doc"), "doc_id", "text_key"), "document-numbers", free_shuffles=True)


def _same_text(docs: DataFrame, numbers: DataFrame):
    return docs["doc_id"].eqNullSafe(numbers["_id"]) & (F.xxhash64(docs["text"]) == numbers["_text"])


#: Bits of a place in a document (texts have fewer bytes), where document and place fit one number.
_PLACE_BITS = 31


def _first_places(found: DataFrame, named: DataFrame) -> DataFrame:
    """(h, first, n): the first document and place of each anchor, and how often it is there.

    Ids that leave room for the place are compared as one number with it, which Spark aggregates by hashing; others as a pair,
    by sorting. The result is the same.
    """
    least, most = named.agg(F.min("doc"), F.max("doc")).first()
    count = F.count("*").alias("n")
    limit = 1 << (62 - _PLACE_BITS)
    if least is None or least < -limit or most >= limit:
        return found.groupBy("h").agg(F.min(F.struct("doc", "pos")).alias("first"), count)
    place = F.col("doc") * (1 << _PLACE_BITS) + F.col("pos")
    packed = found.groupBy("h").agg(F.min(place).alias("packed"), count)
    parts = F.shiftright("packed", _PLACE_BITS).alias("doc"), F.col("packed").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("pos")
    return packed.select("h", F.struct(*parts).alias("first"), "n")


def repeated_ranges(named: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc, ranges): per document of ``named`` (doc, text; distinct numbers) the first and last begin of each run of windows that occur earlier."""
    # Made anew for both uses: cheaper than to keep the anchors of the whole corpus on disk.
    found = corpus_anchors(named, width)
    first = _first_places(found, named).where("n > 1")
    links = found.join(first, "h").where((F.col("doc") != F.col("first.doc")) | (F.col("pos") != F.col("first.pos")))
    links = land(
        links.select("doc", "pos", "before", "after", F.col("first.doc").alias("doc0"), F.col("first.pos").alias("pos0"), (F.col("n") > 2).alias("more")),
        "anchor-links", free_shuffles=True)
    block = F.expr(f"pos0 div {TARGET_BLOCK}")
    crowded = links.groupBy("doc0", block.alias("block")).agg(F.count("*").alias("n")).where(F.col("n") > TARGET_LINKS)
    crowded = land(crowded.select("doc0", "block", F.ceil(F.col("n") / TARGET_LINKS).alias("salts")), "crowded-blocks", free_shuffles=True)
    later = links.groupBy("doc").agg(F.collect_list(F.struct("pos", "before", "after", "doc0", "pos0", "more")).alias("links"))
    firsts = links.select(F.col("doc0").alias("doc"), "pos0").distinct().groupBy("doc").agg(F.collect_list("pos0").alias("firsts"))
    regions = land(_regions(named.join(later.join(firsts, "doc", "full"), "doc"), width), "regions", free_shuffles=True)
    one = F.lit(1).cast("long")
    salted = regions.join(crowded, ["doc0", "block"], "left").withColumn("salts", F.coalesce("salts", one))
    own = F.array(F.pmod(F.xxhash64("doc", "start"), F.col("salts")))
    salted = salted.withColumn("salt", F.explode(F.when(F.col("role") == 0, F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).otherwise(own)))
    dealt = salted.repartition("doc0", "block", "salt").sortWithinPartitions("doc0", "block", "salt", "role", "start")
    marked = land(_match(dealt, width), "marked", free_shuffles=True)
    open_windows = marked.where("h1 IS NOT NULL")
    least = open_windows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "low")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = open_windows.join(least, ["h1", "h2"]).where((F.col("doc") != F.col("first.doc")) | (F.col("low") != F.col("first.low")))
    ranges = marked.where("h1 IS NULL").select("doc", "low", "high").unionByName(again.select("doc", "low", "high"))
    return land(ranges.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("ranges")), "ranges", free_shuffles=True)


def _cutter(width: int):
    kind = T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())])

    @F.arrow_udf(kind)
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        kept, numbers = [], []
        # All ranges of the batch at once, as numbers; a null list has none.
        sizes = ranges.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        low, high = (ranges.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(2))
        for text, size, end in zip(texts, sizes.tolist(), ends.tolist()):
            if not size:
                kept.append(None)
                numbers.append((0, 0, 0))
                continue
            data = text.as_py().encode()
            starts, stops = _intervals(low[end - size : end], high[end - size : end] + width)
            bounds = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
            numbers.append((len(data), len(data) - len(kept[-1]), len(starts)))
        columns = [pa.array([n[k] for n in numbers], pa.int64()) for k in range(3)]
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), *columns], ["kept", "n_bytes", "n_removed", "n_spans"])

    return cut


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) per row of ``docs`` (columns doc_id, text); ``kept`` is the bytes left."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    numbers = _numbers(docs)
    if numbers is None:
        ranges = repeated_ranges(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), width)
        joined = docs.join(ranges, F.col("doc_id").cast("long") == F.col("doc"), "left")
    else:
        numbers = numbers.withColumnsRenamed({"doc_id": "_id", "text_key": "_text"})
        # Rows with equal id and text are one document.
        named = land(docs.join(numbers, _same_text(docs, numbers)).select("doc", "text").dropDuplicates(["doc"]), "numbered-texts", free_shuffles=True)
        ranges = repeated_ranges(named, width).join(numbers, "doc")
        joined = docs.join(ranges, _same_text(docs, ranges), "left")
    # Only texts that lose something cross to Python.
    touched = F.col("ranges").isNotNull()
    whole = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = joined.select("doc_id", touched.alias("touched"), whole.alias("whole"), _cutter(width)(F.when(touched, F.col("text")), "ranges").alias("x"))
    none = F.lit(0).cast("long")
    return rows.select(
        "doc_id",
        F.when(F.col("touched"), F.col("x.kept")).otherwise(F.col("whole")).alias("kept"),
        F.length("whole").cast("long").alias("n_bytes"),
        F.when(F.col("touched"), F.col("x.n_removed")).otherwise(none).alias("n_removed"),
        F.when(F.col("touched"), F.col("x.n_spans")).otherwise(none).alias("n_spans"),
    )
