"""SentencePiece BPE in vectorised merge rounds, and its decoding.

The distinct words of a batch are merged together: all symbols lie in one flat array, the
pair of least rank is taken per word by a segmented minimum, all its occurrences from the
left are merged at once, and the array is compacted, until no pair is left. Merging all
occurrences at once equals merging them one after the other unless a merge makes a pair of
the same or a lower rank; words where that happens are merged pair by pair.

Cases, by definition:

* null and empty texts have no ids and decode to the empty text;
* characters outside the vocabulary become byte ids; byte ids that are no UTF-8
  decode to U+FFFD each, unknown ids to the library's sign, control ids to nothing;
* very long words are cut where no piece of the vocabulary spans two neighbouring
  characters, so rounds depend on the vocabulary, not on the length;
* rows that repeat an id are rows of their own; an empty table stays empty.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from farelane.llm.common import map_batches
from farelane.llm.packing import portions

SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Field numbers and piece types of the public model format.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_FAR = np.iinfo(np.int32).max
#: Words in each of the two halves of a worker's store; some 60 MB each.
_MOST_WORDS = 250_000
#: Characters of texts and of new words, and tokens, handled at once; the work space of each is up to a hundred times as many bytes.
TEXT_CHARS = 1 << 20
WORD_CHARS = 1 << 18
TOKENS = 1 << 18

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield field, data[at : at + size]
            at += size


def _cuts(sizes: np.ndarray, most: int) -> list[int]:
    """Bounds of groups of about ``most`` in size; one item is never cut."""
    part = np.cumsum(sizes) // most
    return [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)] if len(sizes) else [0]


class PieceModel:
    """Vocabulary of a BPE model file with identity normalisation and byte fallback."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            top = list(_fields(file.read()))
        trainer = dict(_fields(next(v for f, v in top if f == 2)))
        normal = dict(_fields(next(v for f, v in top if f == 3)))
        rows = [dict(_fields(v)) for f, v in top if f == 1]
        types = np.array([r.get(3, _NORMAL) for r in rows])
        # trainer 3: model type, 35: byte fallback; normaliser 2: character map, 3: prefix, 4: extra spaces, 5: escaping
        plain = trainer.get(3) == 2 and trainer.get(35) and not normal.get(2) and normal.get(3, 1) and not normal.get(4, 1) and normal.get(5, 1)
        if not plain or not np.isin(types, (_NORMAL, _UNKNOWN, _CONTROL, _BYTE)).all():
            raise ValueError("needs a BPE model with byte fallback, identity normalisation and a prefixed space")
        texts = [r[1].decode() for r in rows]
        scores = [struct.unpack("<f", r.get(2, bytes(4)))[0] for r in rows]
        self.size = len(rows)
        self.ids = {t: i for i, t in enumerate(texts) if types[i] == _NORMAL}
        order = {s: k for k, s in enumerate(sorted(set(scores), reverse=True))}
        self.rank = np.array([order[s] for s in scores], np.int32)
        self.byte_ids = np.zeros(256, np.int32)
        for i in np.flatnonzero(types == _BYTE):
            self.byte_ids[int(texts[i][1:-1], 16)] = i
        pairs, self.bigrams = {}, set()
        for text, i in self.ids.items():
            for cut in range(1, len(text)):
                left, right = self._symbol(text[:cut]), self._symbol(text[cut:])
                self.bigrams.add(ord(text[cut - 1]) << 21 | ord(text[cut]))
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ids = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.bigram_keys = np.array(sorted(self.bigrams), np.int64)
        self.cuts_at_space = not any(k & ((1 << 21) - 1) == ord(SPACE) and k >> 21 != ord(SPACE) for k in self.bigrams)
        # Bytes of each id, spaces shown, for decoding.
        shown = [b"" if t == _CONTROL else trainer.get(44, " ⁇ ".encode()) if t == _UNKNOWN else bytes([int(x[1:-1], 16)]) if t == _BYTE else x.replace(SPACE, " ").encode() for x, t in zip(texts, types)]
        self.shown_size = np.array([len(b) for b in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.is_control = types == _CONTROL
        self.opens_with_space = np.array([x.startswith(SPACE) for x in texts])
        self.store: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _symbol(self, text: str) -> int | None:
        """A piece, or a single character outside the vocabulary."""
        return self.ids.get(text, self.size + ord(text) if len(text) == 1 else None)

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, or -1."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ids[at], -1)

    def _ranks(self, merged: np.ndarray) -> np.ndarray:
        return np.where(merged >= 0, self.rank[merged], _FAR)

    def _one_by_one(self, symbols: list[int]) -> list[int]:
        """The library's order: least rank first, then leftmost."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        live: list[int | None] = list(symbols)
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < n and (found := self.pairs.get(live[i] << 32 | live[j])) is not None:
                heapq.heappush(heap, (int(self.rank[found]), i, j, found))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, found = heapq.heappop(heap)
            if live[i] is None or live[j] is None or after[i] != j or self.pairs.get(live[i] << 32 | live[j]) != found:
                continue
            live[i], live[j] = found, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in live if s is not None]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        kinds, back = np.unique(codes, return_inverse=True)
        symbol = np.array([self._symbol(chr(c)) for c in kinds.tolist()], np.int64)[back]
        place = np.arange(len(codes))
        joined = np.isin(codes[:-1] << 21 | codes[1:], self.bigram_keys) & (word[:-1] == word[1:])
        segment = np.concatenate([[0], np.cumsum(~joined)]) if len(codes) else codes
        first_segment = segment
        done_symbol, done_place, apart = [], [], []
        last = np.full(int(segment[-1]) + 1 if len(codes) else 0, -1, np.int64)  # rank merged last, where several were
        # merged and ranks belong to the pair of a symbol and the next; only pairs of new symbols are looked up.
        merged = np.full(len(symbol), -1, np.int64)
        fresh = np.flatnonzero(segment[:-1] == segment[1:])
        merged[fresh] = self._merged(symbol[fresh], symbol[fresh + 1])
        ranks = self._ranks(merged)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            sizes = np.diff(np.r_[starts, len(segment)])
            least = np.minimum.reduceat(ranks, starts)
            owner = np.repeat(np.arange(len(starts)), sizes)
            names = segment[starts]
            unsure = (least < _FAR) & (least <= last[names])
            hit = (ranks == least[owner]) & (ranks < _FAR)
            # Of overlapping hits every second one, from the left of their run.
            at = np.flatnonzero(hit)
            opens = np.ones(len(at), bool)
            opens[1:] = at[1:] != at[:-1] + 1
            run = at[np.flatnonzero(opens)][np.cumsum(opens) - 1]
            at = at[(at - run) % 2 == 0]
            count = np.bincount(owner[at], minlength=len(starts))
            # A merged symbol may pair with the left part of the next merge before that is merged.
            near = at[:-1][(at[1:] == at[:-1] + 2) & (owner[at[1:]] == owner[at[:-1]])]
            between = self._ranks(self._merged(merged[near], symbol[near + 2]))
            unsure[owner[near[between <= least[owner[near]]]]] = True
            apart.append(names[unsure])
            last[names] = np.where(count > 1, least, -1)
            rest = (least == _FAR)[owner]
            done_symbol.append(symbol[rest])
            done_place.append(place[rest])
            symbol[at] = merged[at]
            changed = np.zeros(len(symbol), bool)
            changed[at] = True
            stays = ~(rest | unsure[owner])
            stays[at + 1] = False
            symbol, place, segment, merged, ranks = (x[stays] for x in (symbol, place, segment, merged, ranks))
            new = np.flatnonzero(changed[stays])
            redo = np.union1d(new, new[new > 0] - 1)
            merged[redo], ranks[redo] = -1, _FAR
            redo = redo[redo + 1 < len(symbol)]
            redo = redo[segment[redo] == segment[redo + 1]]
            merged[redo] = self._merged(symbol[redo], symbol[redo + 1])
            ranks[redo] = self._ranks(merged[redo])
        for name in np.concatenate(apart).tolist() if apart else ():
            start, end = np.searchsorted(first_segment, [name, name + 1])
            found = self._one_by_one([self._symbol(chr(c)) for c in codes[start:end].tolist()])
            done_symbol.append(np.array(found, np.int64))
            # Any rising places inside the segment keep the order.
            done_place.append(np.arange(start, start + len(found)))
        symbol, place = np.concatenate(done_symbol or [codes]), np.concatenate(done_place or [codes])
        order = np.argsort(place)
        symbol, place = symbol[order], place[order]
        own = np.r_[0, np.cumsum(np.bincount(word[place], minlength=len(words)))] if len(place) else np.zeros(len(words) + 1, np.int64)
        unknown = symbol >= self.size
        ids = symbol.astype("<i4")
        if not unknown.any():
            return [ids[a:b].tobytes() for a, b in zip(own[:-1].tolist(), own[1:].tolist())]
        parts = [self.byte_ids[list(chr(s - self.size).encode())].astype("<i4").tobytes() if u else i.tobytes() for s, u, i in zip(symbol.tolist(), unknown.tolist(), ids)]
        return [b"".join(parts[a:b]) for a, b in zip(own[:-1].tolist(), own[1:].tolist())]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = []
        for text in texts:
            text = f"{SPACE}{text}".replace(" ", SPACE) if text else ""
            split.append(_WORD.findall(text) if self.cuts_at_space or not text else [text])
        if len(self.store) >= _MOST_WORDS:
            # Words used since the last time stay at hand, the rest are forgotten.
            self.before, self.store = self.store, {}
        wanted = set().union(*split).difference(self.store)
        self.store.update((w, self.before[w]) for w in wanted.intersection(self.before))
        new = list(wanted.difference(self.store))
        cuts = _cuts(np.fromiter(map(len, new), np.int64, len(new)), WORD_CHARS)
        for a, b in zip(cuts[:-1], cuts[1:]):
            self.store.update(zip(new[a:b], self._encode_words(new[a:b])))
        return [b"".join(map(self.store.__getitem__, words)) for words in split]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of id lists that lie behind each other in ``ids``."""
        lengths = self.shown_size[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.shown_start[ids] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        data = self.shown[at].tobytes()
        found, first = [], 0
        bounds = np.r_[0, ends]
        for size in sizes.tolist():
            start, end = int(bounds[first]), int(bounds[first + size])
            head = first
            while head < first + size and self.is_control[ids[head]]:
                head += 1
            if head < first + size and self.opens_with_space[ids[head]]:
                start += 1
            found.append(data[start:end].decode("utf-8", "each-byte"))
            first += size
        return found


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def _ids(model: PieceModel, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) of a batch of texts, in portions, so that work space stays bounded."""
    at = 0
    for part in portions(batch.column("text"), TEXT_CHARS):
        found = model.encode(part)
        ends = np.cumsum([0] + [len(f) // 4 for f in found], dtype=np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), ids], ["doc_id", "ids"])
        at += len(part)


def _texts(model: PieceModel, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids, text) of a batch of ids, in portions too."""
    ids = batch.column("ids")
    sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    cuts = _cuts(sizes, TOKENS)
    for a, b in zip(cuts[:-1], cuts[1:]):
        rows = batch.slice(a, b - a)
        flat = rows.column("ids").flatten().to_numpy(zero_copy_only=False)
        texts = pa.array(model.decode(flat, sizes[a:b]), pa.string())
        yield pa.RecordBatch.from_arrays([*rows.columns, texts], ["doc_id", "ids", "text"])


def _id_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids) with the ids of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            yield from _ids(model, batch)

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {_id_type(docs)}, ids array<int>")


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """``tokens`` (columns doc_id, ids) with the decoded ``text``; null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            yield from _texts(model, batch)

    return map_batches(tokens.select("doc_id", "ids"), run, f"doc_id {_id_type(tokens)}, ids array<int>, text string")


def encode_and_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """``decode(encode(docs))``, both in the same worker: half the workers, one model each, and ids cross once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for tokens in _ids(model, batch):
                yield from _texts(model, tokens)

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {_id_type(docs)}, ids array<int>, text string")
