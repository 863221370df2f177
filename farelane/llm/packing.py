"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are cut into pieces of at most one sequence. Only the number of pieces of each
length reaches the driver, at most ``capacity`` numbers. Best-fit decreasing is planned
over these counts: bins with the same room are one group, and a step fills as many bins of
a group as there are pieces of the length. Pieces then take the planned slots by their
rank within their length.

Cases, by definition:

* null and empty texts are documents of the end token alone;
* tokens of a text follow the library on the whole text; only documents of more tokens
  than a sequence are cut, at multiples of the capacity;
* equal lengths rank by a hash of id, piece and ids, then by these; which of equal rows takes which slot is open;
* rows that repeat an id are documents of their own; an empty table gives no pieces;
* other columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.llm.common import land, map_batches

CAPACITY = 4096
END_ID = 1
#: Rows of one length that one task ranks, on average.
RANK_ROWS = 50_000
#: Words in each of the two halves of a worker's store; some 90 MB each.
_MOST_WORDS = 400_000


#: What the quick way below takes for granted: it is left out for a file with other steps before its model.
_STEPS = ["NFC", "Replace", "Lowercase"], r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Small letters that no step before the model changes, and the signs that may close such a word: those of ASCII but the apostrophe.
_LETTERS, _SIGNS = "[a-zß-öø-ÿ]+", r"[!-&(-/:-@\[-`{-~]+"
_SPECIAL = "<|"


class WordIds(dict):
    """Little-endian ids of each word met lately, by the tokenizer.

    Neither the tokenizer's normaliser nor its pattern joins anything across ASCII white
    space, so a text's ids are those of its words. It lowers letters, so a text may come in small ones, unless it
    holds what may be a special token. When the store is full, the words used
    since the last time stay at hand in ``before`` and the rest are forgotten.
    """

    #: A special token of the file, cut out before all else: it keeps words apart in one call.
    BETWEEN, BETWEEN_ID = "<|endoftext|>", 49407

    def __init__(self, path: str):
        # The tasks are the threads here; a pool of its own in each worker would only wait and spin.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.before: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = self.tokenizer.token_to_id(self.BETWEEN) == self.BETWEEN_ID
        self.letters = self._letters()

    def _letters(self):
        """The same model for words of small letters alone, which the steps before it leave as they are; None for a file with other steps."""
        from tokenizers import Tokenizer, pre_tokenizers

        file = json.loads(self.tokenizer.to_str())
        steps = [s["type"] for s in (file["normalizer"] or {}).get("normalizers", [])]
        cuts = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        suffix = file["model"].get("end_of_word_suffix")
        if not suffix or (steps, cuts[0].get("pattern", {}).get("Regex")) != _STEPS or [c["type"] for c in cuts[1:]] != ["ByteLevel"]:
            return None
        letters = Tokenizer(self.tokenizer.model)
        letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.closes = np.zeros(max(letters.get_vocab().values()) + 1, bool)
        self.closes[[i for token, i in letters.get_vocab().items() if token.endswith(suffix)]] = True
        return letters

    def _whole(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        plain = [w for w in words if self.parts and _SPECIAL not in w]
        for at in range(0, len(plain), 1000):
            some = plain[at : at + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([self.BETWEEN.join(some)], add_special_tokens=False)[0].ids, "<u4")
            yield from _apart(some, ids, np.flatnonzero(ids == self.BETWEEN_ID), 1)
        for word in set(words).difference(plain):
            yield word, np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        small = np.zeros(len(words), bool)
        if self.letters:
            small = pc.match_substring_regex(pa.array(words, pa.string()), f"^{_LETTERS}$").to_numpy(zero_copy_only=False)
        letters = list(compress(words, small.tolist()))
        for at in range(0, len(letters), 1000):
            some = letters[at : at + 1000]
            ids = np.array(self.letters.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            yield from _apart(some, ids, np.flatnonzero(self.closes[ids])[:-1] + 1, 0)
        yield from self._whole(list(compress(words, (~small).tolist())))

    def _known(self, words: pa.Array) -> list[bytes]:
        """The ids of distinct words."""
        words = words.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.get, words))
        new = {w for w, ids in zip(words, found) if ids is None}
        if new:
            if self.before:
                self.update((w, self.before[w]) for w in new.intersection(self.before))
                new.difference_update(self)
            self.update(self._encode(list(new)))
            found = list(map(self.__getitem__, words))
        return found

    def _of_words(self, words: pa.Array) -> list[bytes]:
        if not self.letters:
            return self._known(words)
        # A token ends between a letter and such a sign, so both are words of their own, of which there are fewer.
        closed = pc.extract_regex(words, f"^(?P<stem>{_LETTERS})(?P<signs>{_SIGNS})$")
        stems = pc.coalesce(pc.struct_field(closed, 0), words).dictionary_encode()
        signs = pc.coalesce(pc.struct_field(closed, 1), "").dictionary_encode()
        first, second = self._known(stems.dictionary), self._known(signs.dictionary)
        return [first[i] + second[k] for i, k in zip(stems.indices.to_numpy().tolist(), signs.indices.to_numpy().tolist())]

    def of(self, texts: list[str | None]) -> list[bytes]:
        if len(self) >= _MOST_WORDS:
            self.before = dict(self)
            self.clear()
        given = pa.array([t or "" for t in texts], pa.string())
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(given, _SPECIAL), given, pc.ascii_lower(given)))
        coded = split.flatten().dictionary_encode()
        found = self._of_words(coded.dictionary)
        # The ids of all words behind each other, taken for each place of a word.
        word = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        lengths = sizes[word]
        ends = np.r_[0, np.cumsum(lengths)]
        at = np.repeat((np.cumsum(sizes) - sizes)[word] - ends[:-1], lengths)
        at += np.arange(len(at))
        ids = np.frombuffer(b"".join(found), "<u4")[at]
        bounds = ends[split.offsets.to_numpy()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def _apart(words: list[str], ids: np.ndarray, cuts: np.ndarray, skip: int) -> Iterator[tuple[str, bytes]]:
    """Each word with its ids; a word ends at a cut, the next begins ``skip`` ids later."""
    data, starts, ends = ids.tobytes(), [0, *(4 * (cuts + skip)).tolist()], [*(4 * cuts).tolist(), 4 * len(ids)]
    return zip(words, (data[s:e] for s, e in zip(starts, ends, strict=True)), strict=True)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def portions(texts: pa.Array, most: int = 1 << 22) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about ``most`` characters; one text is never cut."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_py())
        size += len(part[-1] or "")
        if size >= most:
            yield part
            part, size = [], 0
    yield part


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) per piece of each row of ``docs``; ids are little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = word_ids(tokenizer_path)
        end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows, found = [], []
            documents = (ids for part in portions(batch.column("text")) for ids in store.of(part))
            for row, ids in enumerate(documents):
                ids += end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        found.append(part)
            row, piece, start, length, crc = np.array(rows, np.int64).reshape(-1, 5).T
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(found, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    narrow = docs.select("doc_id", "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return map_batches(narrow, run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Best-fit decreasing over counts of lengths.

    Returns slots (length, first rank, number of ranks, first sequence, offset), each for
    consecutive ranks in consecutive sequences, and the number of sequences. The number of
    slots depends on the capacity, not on the number of pieces: a step either uses up a
    length or a group of bins, and groups arise only where a length ends.
    """
    slots: list[tuple[int, int, int, int, int]] = []
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, number)
    rooms: list[int] = []  # sorted
    sequences = 0

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in groups:
                groups[room] = []
                at = np.searchsorted(rooms, room)
                rooms.insert(int(at), room)
            groups[room].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = int(np.searchsorted(rooms, length))
            if at == len(rooms):
                # New sequences: as many as the pieces need if each takes all that fit.
                fits = capacity // length
                number = -(-left // fits)
                put(capacity, sequences, number)
                sequences += number
                continue
            room = rooms[at]
            first, number = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            used = min(number, left)
            slots.append((length, rank, used, first, capacity - room))
            put(room, first + used, number - used)
            put(room - length, first, used)
            rank, left = rank + used, left - used
    return np.array(slots, np.int64).reshape(-1, 5), sequences


def pack(items: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``items`` (column ``length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``; a hash of ``order`` ranks equal lengths.

    ``items`` is read several times, so it should be a written table.
    """
    spark = items.sparkSession
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, _ = plan(counts, capacity)
    # The order is that of a hash, so a length of many rows is ranked in ranges of it, each after those before it, and the ranks are
    # the same however many ranges there are.
    parts = max(1, -(-max(counts.values(), default=1) // RANK_ROWS))
    hashed = items.withColumn("_hash", F.shiftrightunsigned(F.xxhash64(*order), 32))
    parted = hashed.withColumn("_part", F.shiftright(F.col("_hash") * F.lit(parts), 32).cast("int"))
    sizes = parted.groupBy("length", "_part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("length", "_part", F.coalesce(before, F.lit(0).cast("long")).alias("_before"))
    in_part = F.row_number().over(Window.partitionBy("length", "_part").orderBy("_hash", *order)) - 1
    ranked = parted.withColumn("_in_part", in_part).join(starts, ["length", "_part"])
    ranked = ranked.select(*items.columns, (F.col("_before") + F.col("_in_part")).alias("_rank"))
    shared = spark.sparkContext.broadcast(slots[np.lexsort((slots[:, 1], slots[:, 0]))])

    names = items.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = table[:, 0] * (1 << 40) + table[:, 1]
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            slot = table[np.searchsorted(keys, batch.column("length").to_numpy() * (1 << 40) + rank, "right") - 1].reshape(-1, 5)
            columns = [batch.column(c) for c in names] + [pa.array(slot[:, 3] + rank - slot[:, 1]), pa.array(slot[:, 4].copy())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return map_batches(ranked, run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` (columns doc_id, text) with their places, as by ``pieces`` and ``pack``."""
    cut = land(pieces(docs, tokenizer_path, capacity, end_id, with_ids), "pieces")
    return pack(cut, ["doc_id", "piece", "ids_crc32"], capacity)
