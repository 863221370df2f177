"""Alignment of the tokens of two tokenizers, and corpus counts of the pairs it links.

Both sides spell the same bytes, so the running sums of their token lengths are two rising lists
of ends. Ends common to both cut the text into groups. While tokens match one to one, both lists
agree at a fixed shift of their indexes: probes of doubling size compare slices at that shift and
jump over the whole stretch. Where they disagree, the side that is behind moves on until both
ends meet; that is one irregular group, and the shift is taken anew behind it.

Both sides end a token at a single space inside text, so a group never spans two words. New words are aligned
many at a time, as one text; the alignment of a document is put together from those of its words.

All token pairs of a group are linked. Documents are aligned in blocks of bounded text; a
block writes its distinct pairs once, and its documents refer to them by number, so corpus
counts are summed over the pairs of blocks instead of documents, and come back to the blocks the
same way. A pair that every document holds is one row per block.

Cases, by definition:

* null and empty texts have no tokens, and neither have texts whose tokens of either side do not spell them;
* texts are never cut; a group of any size is linked whole, large ones by their distinct tokens;
* special tokens inside texts are plain text;
* each row is a document of its own, also where ids repeat or are null; an empty table stays empty;
* other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.llm.common import land, map_batches
from farelane.llm.packing import portions

#: Text of one block, in characters, and links counted at a time.
BLOCK_CHARS = 1 << 23
_LINKS = 1 << 20
_PART = 1 << 20
#: Words in each of the two halves of a worker's store; some 100 MB each.
_MOST_WORDS = 300_000
#: Characters and links of the words it keeps; wider ones are aligned wherever they come.
_WORD_CHARS = 1000
_WORD_LINKS = 1000
#: Numbers of tokens and groups of such a word stand side by side in one; no tokens mark a wide word.
_HEAD = (1 << 20) - 1
_WIDE = b"", bytes(8)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteLevelTokens:
    """A byte-level vocabulary; the space before the text is part of what it is given."""

    def __init__(self, path: str):
        # The tasks are the threads here.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        size = self.tokenizer.get_vocab_size()
        named = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.spelled = [bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode() for name in named]
        self.quick = self._quick(named)

    def _quick(self, named: list[str]):
        """The same vocabulary in a faster library, where the file's merges stand in the order of their ids; it is given plain words only."""
        import tiktoken

        model = json.loads(self.tokenizer.to_str())["model"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if model.get("ignore_merges") or [model["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
            return None
        ranks = {s: i for i, s in enumerate(self.spelled[: 256 + len(merged)])}
        return tiktoken.Encoding("words", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(merged) else None

    def encode_plain(self, text: str) -> list[int]:
        """Ids of words of ``_PLAIN``, a space before each."""
        return self.quick.encode_ordinary(f" {text}") if self.quick else self.encode([text])[0]

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        return [e.ids for e in found]


class PieceTokens:
    """A piece vocabulary, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.spelled = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def encode_plain(self, text: str) -> list[int]:
        return self.model.encode(text)


#: A space at which both vocabularies always end a token: between characters that are no white space in any reading.
_CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
#: Texts with a space at either end or beside a character that may be another; in the rest every space is such a cut.
_OTHER = "[^!-~À-ÖØ-öø-ſА-я]"
_UNSURE = f"(?:^|{_OTHER}) | (?:{_OTHER}|$)"
#: Words of letters, digits and signs that all libraries class alike, also with single line ends between them.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ſΆ-ώЁА-яё]+(?:\n[!-~À-ÖØ-öø-ſΆ-ώЁА-яё]+)*")
# Fixed value: the pattern by which byte-level vocabularies of this kind part a text.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


class Aligned(NamedTuple):
    """Alignments of some rows: their places, counts and groups as text; the distinct pairs of them all (a in the upper 32 bits), and, by
    number and one row after another, those that each row links, how often, and up to where they go."""

    rows: np.ndarray
    counts: list[np.ndarray]
    groups: pa.Array
    pairs: np.ndarray
    links: np.ndarray
    times: np.ndarray
    ends: np.ndarray


class TokenPair:
    """Alignments of texts by both vocabularies, through a store of the words met lately.

    Neither vocabulary joins anything across a single space inside text: the first one's pattern starts a new part there, and
    no piece of the second has a space behind another character (where one has, texts are not cut). So ids are those
    of words with the space before them, a group ends with every word, and a text's groups are those of its words in order.
    """

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevelTokens(path_a), PieceTokens(path_b)
        for tokens in (self.a, self.b):
            tokens.lengths = np.array([len(s) for s in tokens.spelled], np.int64)
        self.digits = Digits(max(len(self.a.spelled), len(self.b.spelled)))
        self.cuts = not any(b" " in s.lstrip(b" ") for s in self.b.spelled)
        # Of each word its groups as text, and as little-endian numbers its tokens, groups and every link; ``_WIDE``, or with it what the ids spell instead.
        # The same of the words used before the store was full.
        self.store: dict[str, tuple[bytes, ...]] = {}
        self.before = self.store

    def _spelled(self, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        return b"".join(map(self.a.spelled.__getitem__, a)), b"".join(map(self.b.spelled.__getitem__, b))

    def _keep(self, words: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> None:
        """Align words that both vocabularies spell, as one text whose groups are dealt to the words."""
        ends = [np.cumsum(n) for n in sizes]
        cuts_a, cuts_b = (np.array(c, np.int64) for c in group_ends(*(np.cumsum(s.lengths[x]).tolist() for s, x in zip((self.a, self.b), ids))))
        groups = np.searchsorted(cuts_a, ends[0]) + 1
        n_groups = np.diff(groups, prepend=0)
        starts_a, starts_b = np.r_[0, cuts_a[:-1]], np.r_[0, cuts_b[:-1]]
        sizes_b = cuts_b - starts_b
        links = (cuts_a - starts_a) * sizes_b
        n_links = np.diff(np.cumsum(links)[groups - 1], prepend=0)
        narrow = n_links <= _WORD_LINKS
        g = np.flatnonzero(np.repeat(narrow, n_groups))
        n, wide = links[g], np.repeat(sizes_b[g], links[g])
        inside = spans(np.zeros(len(g), np.int64), n)
        found = (ids[0][np.repeat(starts_a[g], n) + inside // wide] << 32) | ids[1][np.repeat(starts_b[g], n) + inside % wide]
        stops = np.cumsum(np.where(narrow, n_links, 0) + 1)
        heads = np.r_[0, stops[:-1]]
        records = np.empty(stops[-1], "<i8")
        records[heads] = sizes[0] | sizes[1] << 20 | n_groups << 40
        records[_others(heads, len(records))] = found
        data, stops = records.tobytes(), (8 * stops).tolist()
        # A sign stands behind every id.
        shown = self.digits.rendered(*ids, cuts_a, cuts_b).encode()
        places = sum(np.cumsum(self.digits.length[x] + 1)[e - 1] for x, e in zip(ids, ends)).tolist()
        made = zip([shown[s : e - 1] for s, e in zip([0, *places], places)], [data[s:e] for s, e in zip([0, *stops], stops)])
        self.store.update(zip(words, made))
        self.store.update((words[w], _WIDE) for w in np.flatnonzero(~narrow).tolist())

    def _learn_plain(self, words: list[str]) -> None:
        """Encode words in one text and cut the ids at the words' ends; where they do not spell the text, each word is encoded."""
        text = " ".join(words)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        ids, sizes = [], []
        for side in (self.a, self.b):
            found = side.encode_plain(text)
            if b"".join(map(side.spelled.__getitem__, found)) != f" {text}".encode():
                return self._learn(words)
            ids.append(np.array(found, np.int64))
            cut = np.searchsorted(np.cumsum(side.lengths[ids[-1]]), ends, "left") + 1
            sizes.append(np.diff(cut, prepend=0))
        self._keep(words, ids, sizes)

    def _learn(self, words: list[str]) -> None:
        good = []
        for word, *ids in zip(words, self.a.encode(words), self.b.encode(words)):
            made = self._spelled(*ids)
            if made == (f" {word}".encode(),) * 2:
                good.append((word, *ids))
            else:
                self.store[word] = (*_WIDE, *made)
        if good:
            words, *found = zip(*good)
            self._keep(words, [np.array([i for ids in x for i in ids], np.int64) for x in found], [np.array([len(ids) for ids in x]) for x in found])

    def _known(self, words: list[str]) -> list[tuple[bytes, ...]]:
        """What the store has of distinct words."""
        found = list(map(self.store.get, words))
        new = [k for k, record in enumerate(found) if record is None]
        if new:
            own = {words[k] for k in new if len(words[k]) <= _WORD_CHARS}
            if self.before:
                self.store.update((w, self.before[w]) for w in own.intersection(self.before))
                own.difference_update(self.store)
            plain, other = [], []
            for word in own:
                (plain if _PLAIN.fullmatch(word) else other).append(word)
            for some, learn in ((plain, self._learn_plain), (other, self._learn)):
                for at in range(0, len(some), 1000):
                    learn(some[at : at + 1000])
            for k in new:
                found[k] = self.store.get(words[k], _WIDE)
        return found

    def _parted(self, texts: list[str]) -> tuple[np.ndarray, pa.ListArray]:
        """The texts' order in what follows, and the words of each."""
        given = pa.array(texts, pa.string())
        easy = np.zeros(len(texts), bool)
        if self.cuts:
            easy = ~pc.match_substring_regex(given, _UNSURE).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(given.filter(pa.array(easy)), " ")
        if not easy.all():
            rest = [_CUT.split(t) if self.cuts else [t] for t in compress(texts, (~easy).tolist())]
            split = pa.concat_arrays([split, pa.array(rest, split.type)])
        return np.argsort(~easy, kind="stable"), split

    def _single(self, text: str, records: list[tuple[bytes, ...]]) -> tuple:
        """``aligned_text`` of a text with words that are wide, which are aligned here, or not spelled."""
        if not text:
            return aligned_text(None, self)
        words = _CUT.split(text) if self.cuts else [text]
        wide = [k for k, r in enumerate(records) if r is _WIDE]
        ids = [[side.encode_plain(w) if _PLAIN.fullmatch(w) else side.encode([w])[0] for side in (self.a, self.b)] for w in map(words.__getitem__, wide)]
        own = [(f" {w}".encode(),) * 2 for w in words]
        made = [r[2:] or o for r, o in zip(records, own)]
        for k, x in zip(wide, ids):
            made[k] = self._spelled(*x)
        if made != own:
            # Where the words make up for each other, the text is taken as it is.
            if all(b"".join(side) == f" {text}".encode() for side in zip(*made)):
                ids = self.a.encode([text])[0], self.b.encode([text])[0]
                if self._spelled(*ids) == (f" {text}".encode(),) * 2:
                    return aligned_text([np.array(x, np.int64) for x in ids], self)
            return aligned_text(None, self)
        parts = [aligned_text([np.array(y, np.int64) for y in x], self) for x in ids]
        shown = [r[0].decode() for r in records]
        for k, part in zip(wide, parts):
            shown[k] = part[4]
        counts, codes = _unpacked([r[1] for r in records])
        counts = [int(c.sum()) + sum(part[k] for part in parts) for k, c in enumerate(counts)]
        return *counts, ";".join(shown), *_merged([np.unique(codes, return_counts=True), *(part[5:] for part in parts)])

    def align(self, texts: list[str]) -> Iterator[Aligned]:
        """The alignments of the texts; of no tokens where these do not spell the text, or it is empty."""
        if len(self.store) >= _MOST_WORDS:
            self.before, self.store = self.store, {}
        order, split = self._parted(texts)
        coded = split.flatten().dictionary_encode()
        word, lengths = coded.indices.to_numpy(), split.value_lengths().to_numpy().astype(np.int64)
        records = self._known(coded.dictionary.to_pylist())
        counts, codes = _unpacked([r[1] for r in records])
        n_links = counts[3]
        rows = np.repeat(np.arange(len(lengths)), lengths)
        single = np.zeros(len(lengths), bool)
        single[rows[counts[0][word] == 0]] = True
        single |= np.array([not texts[k] for k in order.tolist()], bool)
        if single.any():
            ends = np.cumsum(lengths)
            found = [self._single(texts[order[k]], [records[w] for w in word[ends[k] - lengths[k] : ends[k]].tolist()]) for k in np.flatnonzero(single).tolist()]
            pairs, links = np.unique(np.concatenate([f[5] for f in found]), return_inverse=True)
            yield Aligned(
                order[single],
                [np.array([f[k] for f in found], np.int64) for k in range(4)],
                pa.array([f[4] for f in found], pa.string()),
                pairs,
                links.astype(np.int32),
                np.concatenate([f[6] for f in found]),
                np.cumsum([len(f[5]) for f in found]),
            )
            kept = ~single
            word, lengths, order = word[kept[rows]], lengths[kept], order[kept]
            rows = np.repeat(np.arange(len(lengths)), lengths)
        if not len(lengths):
            return
        firsts = np.cumsum(lengths) - lengths
        shown = pa.array([r[0] for r in records], pa.string()).take(pa.array(word))
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[firsts, len(word)].astype(np.int32)), shown), ";")
        # All links of each text in order, as numbers of pairs.
        pairs, number = np.unique(codes, return_inverse=True)
        n = n_links[word]
        keys = number[spans((np.cumsum(n_links) - n_links)[word], n)]
        keys += np.repeat(rows * len(pairs), n)
        keys.sort()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        times = np.diff(starts, append=len(keys))
        keys = keys[starts]
        ends = np.searchsorted(keys, np.arange(1, len(lengths) + 1) * len(pairs))
        links = (keys % len(pairs)).astype(np.int32)
        yield Aligned(order, [np.add.reduceat(c[word], firsts) for c in counts], groups, pairs, links, times, ends)


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places from each start on, as many as its size, one span after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _unpacked(records: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Numbers of tokens of either side, groups and links of each word of a store, and all links."""
    sizes = np.fromiter(map(len, records), np.int64, len(records)) // 8
    flat = np.frombuffer(b"".join(records), "<i8")
    heads = np.cumsum(sizes) - sizes
    return [*((flat[heads] >> at) & _HEAD for at in (0, 20, 40)), sizes - 1], flat[_others(heads, len(flat))]


def _others(places: np.ndarray, size: int) -> np.ndarray:
    """Which of so many places are none of these."""
    found = np.ones(size, bool)
    found[places] = False
    return found


@lru_cache(maxsize=2)
def token_pair(path_a: str, path_b: str) -> TokenPair:
    return TokenPair(path_a, path_b)


def group_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Tokens of each side up to the end of each group; both lists rise to the same last end."""
    n, cuts_a, cuts_b, i, j = len(ends_a), [], [], 0, 0
    # Behind the ends nothing is equal.
    ends_a, ends_b = [*ends_a, -1], [*ends_b, -2]
    while i < n:
        a, b = ends_a[i], ends_b[j]
        if a == b:
            start_a, start_b = i, j
            i += 1
            j += 1
            if ends_a[i] == ends_b[j]:
                # A one-to-one stretch at shift j - i: probes double until one fails, then halve.
                i += 1
                j += 1
                step, grows = 2, True
                while step:
                    if i + step <= n and ends_a[i : i + step] == ends_b[j : j + step]:
                        i += step
                        j += step
                        step = 2 * step if grows else step // 2
                    else:
                        grows = False
                        step //= 2
            cuts_a += range(start_a + 1, i + 1)
            cuts_b += range(start_b + 1, j + 1)
        else:
            while a != b:
                if a < b:
                    i += 1
                    a = ends_a[i]
                else:
                    j += 1
                    b = ends_b[j]
            i += 1
            j += 1
            cuts_a.append(i)
            cuts_b.append(j)
    return cuts_a, cuts_b


class Digits:
    """Decimal digits of the ids below a size, for writing many at once."""

    def __init__(self, size: int):
        width = len(str(size)) + 1
        names = [str(i).encode() for i in range(size)]
        self.length = np.array([len(n) for n in names], np.int64)
        self.rows = np.frombuffer(b"".join(n.ljust(width) for n in names), np.uint8).reshape(size, width)
        self.column = np.arange(width)

    def rendered(self, ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group in order."""
        sizes_a, sizes_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
        ids = np.empty(len(ids_a) + len(ids_b), np.int64)
        end = np.full(len(ids), ord(","), np.uint8)
        # In front of a token of a group stand the tokens of the groups before, and those of a before those of b.
        ids[np.arange(len(ids_a)) + np.repeat(cuts_b - sizes_b, sizes_a)] = ids_a
        ids[np.arange(len(ids_b)) + np.repeat(cuts_a, sizes_b)] = ids_b
        end[cuts_a + cuts_b - sizes_b - 1] = ord("|")
        end[cuts_a + cuts_b - 1] = ord(";")
        parts = []
        for at in range(0, len(ids), _LINKS):
            some = ids[at : at + _LINKS]
            length, shown = self.length[some], self.rows[some]
            shown[np.arange(len(some)), length] = end[at : at + _LINKS]
            parts.append(shown[self.column <= length[:, None]].tobytes())
        return b"".join(parts)[:-1].decode()


_NO_PAIRS = np.zeros(0, np.int64), np.zeros(0, np.int64)


def linked_pairs(ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (a in the upper 32 bits) linked by the groups, sorted, and the links of each."""
    starts_a, starts_b = np.r_[0, cuts_a[:-1]], np.r_[0, cuts_b[:-1]]
    sizes_b = cuts_b - starts_b
    links = (cuts_a - starts_a) * sizes_b
    found, waiting, size = [], [], 0

    def count() -> None:
        nonlocal waiting, size
        found.append(np.unique(np.concatenate(waiting), return_counts=True))
        waiting, size = [], 0

    # Most groups have one link.
    single = np.flatnonzero(links == 1)
    for at in range(0, len(single), _LINKS):
        some = single[at : at + _LINKS]
        waiting.append((ids_a[starts_a[some]] << 32) | ids_b[starts_b[some]])
        if (size := size + len(some)) >= _LINKS:
            count()
    several = np.flatnonzero((links > 1) & (links <= _LINKS))
    part = np.cumsum(links[several]) // _LINKS
    for groups in np.split(several, np.flatnonzero(np.diff(part)) + 1):
        ends = np.cumsum(links[groups])
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - links[groups], links[groups])
        wide = np.repeat(sizes_b[groups], links[groups])
        a = ids_a[np.repeat(starts_a[groups], links[groups]) + inside // wide]
        waiting.append((a << 32) | ids_b[np.repeat(starts_b[groups], links[groups]) + inside % wide])
        if (size := size + len(inside)) >= _LINKS:
            count()
    if size:
        count()
    for g in np.flatnonzero(links > _LINKS).tolist():
        a, n_a = np.unique(ids_a[starts_a[g] : cuts_a[g]], return_counts=True)
        b, n_b = np.unique(ids_b[starts_b[g] : cuts_b[g]], return_counts=True)
        found.append((((a[:, None] << 32) | b).ravel(), (n_a[:, None] * n_b).ravel()))
    return _merged(found)


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, and the links of each in all."""
    if len(found) < 2:
        return found[0] if found else _NO_PAIRS
    codes, where = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    times = np.zeros(len(codes), np.int64)
    np.add.at(times, where, np.concatenate([n for _, n in found]))
    return codes, times


def aligned_text(ids: tuple[np.ndarray, np.ndarray] | None, tokens: TokenPair) -> tuple:
    """(n_a, n_b, n_groups, n_links, groups, pairs, times) of the ids of one text."""
    if ids is None:
        return 0, 0, 0, 0, "", *_NO_PAIRS
    cuts = group_ends(*(np.cumsum(s.lengths[x]).tolist() for s, x in zip((tokens.a, tokens.b), ids)))
    cuts = [np.array(c, np.int64) for c in cuts]
    pairs, times = linked_pairs(*ids, *cuts)
    return len(ids[0]), len(ids[1]), len(cuts[0]), int(times.sum()), tokens.digits.rendered(*ids, *cuts), pairs, times


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def align(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text): (doc_id, n_a, n_b, n_groups, n_links, groups, block, links, times, pairs, held).

    ``groups`` is the alignment as text. ``links`` numbers the document's distinct pairs within its block and ``times``
    says how often each is linked; the first row of a block also has the block's ``pairs`` (a in the upper 32 bits) and in how
    many of its documents each is ``held``.
    """

    def block_of(ids: list[pa.Array], parts: list[Aligned], place: int) -> Iterator[pa.RecordBatch]:
        found, where = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
        where = np.split(where, np.cumsum([len(p.pairs) for p in parts])[:-1])
        held = sum(np.bincount(w[p.links], minlength=len(found)) for p, w in zip(parts, where))
        # Frequent pairs get small numbers.
        order = np.argsort(-held, kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        own = [found[order], held[order]]
        for part_ids, part, own_number in zip(ids, parts, where):
            ends, links = pa.array(np.r_[0, part.ends].astype(np.int32)), number[own_number][part.links]
            columns = [
                part_ids,
                *[pa.array(c) for c in part.counts],
                part.groups,
                pa.array(np.full(len(part_ids), place, np.int64)),
                pa.ListArray.from_arrays(ends, pa.array(links)),
                pa.ListArray.from_arrays(ends, pa.array(part.times)),
                *[pa.array([x] + [None] * (len(part_ids) - 1), pa.list_(pa.int64())) for x in own],
            ]
            own = [None, None]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", *_COUNTS, "groups", "block", "links", "times", "pairs", "held"]
    narrow = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = token_pair(path_a, path_b)
        ids, parts, size, place = [], [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for part in portions(batch.column("text"), _PART):
                texts = [t or "" for t in part]
                for found in tokens.align(texts):
                    ids.append(batch.column("doc_id").take(pa.array(at + found.rows)))
                    parts.append(found)
                at += len(texts)
                size += sum(map(len, texts))
                if size >= block_chars:
                    yield from block_of(ids, parts, place)
                    ids, parts, size, place = [], [], 0, place + 1
        if parts:
            yield from block_of(ids, parts, place)

    schema = f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in _COUNTS)}, groups string, block long, links array<int>, times array<long>, pairs array<long>, held array<long>"
    return map_batches(narrow, run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n_docs, is_best): in how many documents each pair is linked, and whether no pair of its a has more."""
    entries = aligned.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "held")).alias("e")).select("e.*")
    counts = entries.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n_docs"))
    # A token of one side has at most as many partners as the other side's vocabulary.
    most = F.max("n_docs").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "n_docs", (F.col("n_docs") == most).alias("is_best"))


def with_counts(aligned: DataFrame) -> DataFrame:
    """``aligned``, a written result of ``align``, with n_best and count_sum per document in place of its pair columns."""
    counts = land(pair_counts(aligned), "pair-counts")
    entries = aligned.where("pairs is not null").select("block", F.posexplode("pairs").alias("number", "pair"))
    answers = entries.join(counts, "pair").select(F.col("block").alias("place"), "number", "n_docs", "is_best")
    kept = [c for c in aligned.columns if c not in ("links", "times", "pairs", "held")]
    own = aligned.select(*kept, "links", "times")

    def weigh(rows: pa.Table, answered: pa.Table) -> pa.Table:
        number = answered["number"].to_numpy()
        n_docs, best = np.zeros((2, len(number)), np.int64)
        n_docs[number], best[number] = answered["n_docs"].to_numpy(), answered["is_best"].to_numpy()
        links, times = (rows[c].combine_chunks() for c in ("links", "times"))
        ends = np.cumsum(links.value_lengths().to_numpy())
        links, times = links.flatten().to_numpy(), times.flatten().to_numpy()
        made = rows.select(kept)
        for name, value in (("n_best", best), ("count_sum", n_docs)):
            sums = np.r_[0, np.cumsum(value[links] * times)]
            made = made.append_column(name, pa.array(sums[ends] - sums[np.r_[0, ends[:-1]]]))
        return made

    fields = {f.name: f.dataType.simpleString() for f in own.schema}
    schema = ", ".join(f"{c} {fields[c]}" for c in kept) + ", n_best long, count_sum long"
    return own.groupBy("block").cogroup(answers.groupBy("place")).applyInArrow(weigh, schema)
