"""Periodic runs of words: maximal stretches that repeat a period, found from Lyndon roots.

Every run holds, under one of two opposite orders of the words, a longest Lyndon word of its
period's length. For each order the first phase of a grouping suffix sort gives the length of the
longest Lyndon word at each place directly: suffixes start in one group per word; groups are
taken from the greatest down; each member leads to the nearest place before it that is not yet
taken, and those places move to a new group right behind their old one, one per number of
members that led there, their prefix lengthened by as many copies of the group's. When a group is
taken, its prefix is the longest Lyndon word of its members. Each such word is then extended to both
sides as far as words one period apart agree (longest common extension), and gives a run if that
is long enough.

A word that is in a run begins or continues triples of words that the text holds three times or
more, so a text is first cut into stretches made of such triples alone; neither a run
nor the word that ends it is lost by that. Ordinary prose mostly ends there.

Cases, by definition:

* null and empty texts and texts without words have no runs and collapse to the empty text;
* texts of fewer words than the least length have no runs; texts are never cut or capped;
* words are compared exactly, as they are written; runs of different periods may overlap;
* rows that repeat an id are texts of their own; an empty table stays empty; other columns
  are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from farelane.llm.common import map_batches
from farelane.llm.packing import portions

#: Least words of a run, and least number of its periods.
MIN_WORDS = 6
MIN_PERIODS = 4


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each place of a sequence of numbers."""
    members: dict[int, list[int]] = {}
    for place, symbol in enumerate(symbols):
        members.setdefault(symbol, []).append(place)
    groups = [members[symbol] for symbol in sorted(members)]
    # The groups in ascending order, as a list linked both ways.
    below, above = list(range(-1, len(groups) - 1)), list(range(1, len(groups) + 1))
    prefix = [1] * len(groups)
    group = [0] * len(symbols)
    for number, places in enumerate(groups):
        for place in places:
            group[place] = number
    # A place not yet taken points at itself, a taken one at some place before it; -1 is before all.
    towards = list(range(len(symbols)))
    lengths = [1] * len(symbols)
    now = len(groups) - 1
    while now >= 0:
        length = prefix[now]
        places = [p for p in groups[now] if group[p] == now]
        for place in places:
            lengths[place] = length
            towards[place] = place - 1
        led: Counter[int] = Counter()
        for place in places:
            at = place
            while at >= 0 and towards[at] != at:
                at = towards[at]
            while place > at:
                towards[place], place = at, towards[place]
            if at >= 0:
                led[at] += 1
        moved: dict[tuple[int, int], list[int]] = {}
        for place, times in led.items():
            moved.setdefault((times, group[place]), []).append(place)
        # A prefix followed by more copies is greater: those go behind the old group first, and are then pushed up.
        for times, old in sorted(moved, reverse=True):
            number, upper = len(groups), above[old]
            groups.append(moved[times, old])
            prefix.append(prefix[old] + times * length)
            below.append(old)
            above.append(upper)
            above[old] = below[upper] = number
            for place in moved[times, old]:
                group[place] = number
        now = below[now]
    return lengths


def _agreeing(data: bytes, i: int, j: int, most: int, back: bool) -> int:
    """How many numbers of ``data`` (four bytes each) agree from places i and j on, or before them; at most ``most``.

    Steps double while whole blocks agree, and halve from the first block that does not.
    """
    done, step, grows = 0, 1, True
    while done < most and step:
        size = min(step, most - done)
        a, b = (i - done - size, j - done - size) if back else (i + done, j + done)
        if data[4 * a : 4 * (a + size)] == data[4 * b : 4 * (b + size)]:
            done += size
            step = 2 * step if grows else step // 2
        else:
            grows = False
            step //= 2
    return done


def runs_of(symbols: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of non-negative numbers."""
    n, data, found = len(symbols), symbols.astype(np.int32).tobytes(), set()
    for order in (symbols, -symbols):
        periods = np.array(lyndon_lengths(order.tolist()), np.int64)
        roots = np.flatnonzero(min_periods * periods <= n)
        # The first root of a run has a whole copy behind it.
        roots = roots[roots + periods[roots] < n]
        roots = roots[symbols[roots] == symbols[roots + periods[roots]]]
        last: dict[int, tuple[int, int]] = {}
        for i, p in zip(roots.tolist(), periods[roots].tolist()):
            start, end = last.get(p, (0, 0))
            if start <= i and i + p <= end:
                continue
            end = i + p + _agreeing(data, i, i + p, n - i - p, back=False)
            start = i - _agreeing(data, i, i + p, i, back=True)
            last[p] = start, end
            if end - start >= max(min_words, min_periods * p):
                found.add((start, end - start, p))
    return found


def stretches(symbols: np.ndarray, min_words: int, min_periods: int) -> Iterator[tuple[int, int]]:
    """Places (start, end) outside of which no word is in a run.

    A run of period q has min_periods * q words or more, so each of its triples is there at least min_periods - 1 times
    (for q = 1, once per word but two).
    """
    often = min(max(min_words, min_periods) - 2, min_periods - 1)
    if often < 2:
        yield 0, len(symbols)
        return
    if len(symbols) < max(min_words, min_periods):
        return
    frequent = np.bincount(symbols)[symbols] >= often
    at = np.flatnonzero(frequent[:-2] & frequent[1:-1] & frequent[2:])
    if len(at) < often:
        return
    # Pairs are numbered first, so that the key of a triple stays small.
    size = int(symbols.max()) + 1
    _, pair = np.unique(symbols[at] * size + symbols[at + 1], return_inverse=True)
    _, triple, counts = np.unique(pair * size + symbols[at + 2], return_inverse=True, return_counts=True)
    at = at[counts[triple] >= often]
    cut = np.flatnonzero(np.diff(at) > 1) + 1
    for part in np.split(at, cut):
        if len(part) + 2 >= max(min_words, min_periods):
            yield int(part[0]), int(part[-1]) + 3


def text_runs(text: str | None, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> tuple[list[tuple[int, int, int]], str]:
    """The runs of a whole text in order of start and period, and its words without repetitions, joined by a space.

    Of a run the first period stays; a word that any run repeats goes.
    """
    words = (text or "").encode().split()  # bytes: ASCII white space only
    numbers: dict[bytes, int] = {}
    symbols = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found = sorted(
        (start + s, length, p)
        for start, end in stretches(symbols, min_words, min_periods)
        for s, length, p in runs_of(symbols[start:end], min_words, min_periods)
    )
    found.sort(key=lambda run: (run[0], run[2]))
    if found:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, p in found:
            change[start + p] += 1
            change[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return found, b" ".join(words).decode()


def collapse_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, runs, collapsed) per row of ``docs`` (columns doc_id, text).

    ``runs`` has start, length and period of each run, in words, by start, then period.
    """
    run_type = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in portions(batch.column("text")):
                made = [text_runs(text, min_words, min_periods) for text in part]
                ends = np.cumsum([0] + [len(runs) for runs, _ in made], dtype=np.int32)
                flat = np.array([r for runs, _ in made for r in runs], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in flat.T], fields=list(run_type))
                columns = [batch.column("doc_id").slice(at, len(part)), pa.ListArray.from_arrays(pa.array(ends), structs)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([c for _, c in made], pa.string())], ["doc_id", "runs", "collapsed"])
                at += len(part)

    narrow = docs.select("doc_id", "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_batches(narrow, run, schema)
