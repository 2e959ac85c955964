"""Periodic runs of words, by uniting suffix classes in order of falling LCP.

Two places of a document belong to one class at level L if the words from there
on agree for L words or more. The suffixes are sorted, so that neighbours in
the order carry the longest common prefixes (LCP), and the classes are united
as Kruskal would, longest LCP first, with a union-find whose classes keep their
places in order. Where a union at level L makes places i < j neighbours in
their class and j - i <= L, the words from i on have period j - i for
j - i + L words, which is at least two periods: a seed. The first place s of a
run of smallest period p always gives one: its suffix and the one at s + p
agree for exactly the rest of the run, and a place between them in that class
would give the run a smaller period. For the same reason the distance of a seed
is the smallest period there. All seeds of a run share its period and its end,
so the run begins at the first of them.

Every document stands by itself: nothing is shuffled. Suffixes are sorted by
prefix doubling over a batch of documents at once, and only the places whose
next words occur a second time in their document are looked at further.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

# A run has at least so many words, and at least so many periods.
LEAST_LENGTH, LEAST_PERIODS = 12, 2

# Words of documents that are sorted together; a longer document goes alone.
WORDS_AT_ONCE = 500_000
BUCKET = 1_000


class Places:
    """Places in order, in buckets, so that a large class takes a new one fast."""

    __slots__ = ("buckets", "firsts", "size")

    def __init__(self, place: int):
        self.buckets, self.firsts, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        for bucket in self.buckets:
            yield from bucket

    def add(self, place: int) -> tuple[int, int]:
        """Take a new place; the places before and after it, -1 if there is none."""
        firsts, buckets = self.firsts, self.buckets
        b = max(bisect_left(firsts, place) - 1, 0)
        bucket = buckets[b]
        at = bisect_left(bucket, place)
        before = bucket[at - 1] if at else -1
        if at < len(bucket):
            after = bucket[at]
        else:
            after = firsts[b + 1] if b + 1 < len(firsts) else -1
        bucket.insert(at, place)
        if not at:
            firsts[b] = place
        if len(bucket) > BUCKET:
            half = len(bucket) // 2
            buckets.insert(b + 1, bucket[half:])
            firsts.insert(b + 1, bucket[half])
            del bucket[half:]
        self.size += 1
        return before, after


def suffix_order(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of suffixes, and their ranks by the first 1, 2, 4 ... symbols.

    ``first`` holds symbols of which every document's last one occurs nowhere
    else. Suffixes with equal ranks agree in so many symbols; a rank is the
    place in the order where its class begins. Doubling ends when all differ,
    and a suffix that is alone in its class is not sorted again.
    """
    order = np.argsort(first, kind="stable")
    sorted_keys = first[order]
    opens = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])
    starts = np.flatnonzero(opens)
    rank = np.empty(len(first), np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, len(first))))
    ranks, width = [rank], 1
    slots = np.arange(len(first))
    while True:
        # Slots of classes with two members or more.
        alone = opens & np.append(opens[1:], True)
        slots, opens = slots[~alone], opens[~alone]
        if not len(slots):
            return order, ranks
        members = order[slots]
        own, following = rank[members], rank[members + width]
        by = np.lexsort((following, own))
        members, own, following = members[by], own[by], following[by]
        order[slots] = members
        opens = np.concatenate([[True], (own[1:] != own[:-1]) | (following[1:] != following[:-1])])
        starts = np.flatnonzero(opens)
        rank = rank.copy()
        rank[members] = np.repeat(slots[starts], np.diff(np.append(starts, len(slots))))
        ranks.append(rank)
        width *= 2


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray], least: int) -> tuple[np.ndarray, ...]:
    """Neighbours ``a, b`` in the order with a common prefix of ``least`` or more
    symbols, and its length."""
    a, b = order[:-1], order[1:]
    for level in range(min(least.bit_length(), len(ranks))):
        same = ranks[level][a] == ranks[level][b]
        a, b = a[same], b[same]
    x, y, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        step = (ranks[level][x] == ranks[level][y]).astype(np.int64) << level
        x, y, length = x + step, y + step, length + step
    enough = length >= least
    return a[enough], b[enough], length[enough]


def seeds(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> list[tuple[int, int, int]]:
    """``place, distance, level`` of places that become neighbours in a class at a
    level of at least their distance, when classes are united by falling level."""
    by = np.argsort(-length, kind="stable")
    parent: dict[int, int] = {}
    classes: dict[int, Places] = {}
    found = []

    def root(x: int) -> int:
        if x not in parent:
            parent[x], classes[x] = x, Places(x)
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for x, y, level in zip(a[by].tolist(), b[by].tolist(), length[by].tolist()):
        x, y = root(x), root(y)
        if classes[x].size < classes[y].size:
            x, y = y, x
        large, small = classes[x], list(classes.pop(y))
        parent[y] = x
        previous = -1
        for place, following in zip(small, [*small[1:], -1]):
            before, after = large.add(place)
            # Places of the smaller class that are neighbours were so before.
            if before >= 0 and before != previous and place - before <= level:
                found.append((before, place - before, level))
            if after >= 0 and (following < 0 or after < following) and after - place <= level:
                found.append((place, after - place, level))
            previous = place
    return found


def runs_of(documents: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of every run of each document, by start and period.

    A document is a list of word numbers, 0 or more, the same number for the
    same word within a document.
    """
    lengths = np.array([len(d) for d in documents], np.int64)
    total = int(lengths.sum())
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not total:
        return out
    # Every document's words, then a symbol of its own; a document's symbols
    # are unlike any other's.
    most = max((max(d) for d in documents if d), default=0) + 2
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    first = np.empty(total + len(documents), np.int64)
    for n, d in enumerate(documents):
        first[begins[n] : begins[n + 1] - 1] = np.array(d, np.int64) + (n * most + 1)
        first[begins[n + 1] - 1] = n * most
    order, ranks = suffix_order(first)
    # A run's start agrees with the place a period on for its length less that.
    least = -(-LEAST_LENGTH // LEAST_PERIODS) * (LEAST_PERIODS - 1)
    a, b, length = common_prefixes(order, ranks, least)
    if not len(a):
        return out
    starts: dict[tuple[int, int], int] = {}
    for place, period, level in seeds(a, b, length):
        key = place + period + level, period
        if starts.get(key, place) >= place:
            starts[key] = place
    ends = np.array([key[0] for key in starts], np.int64)
    owner = np.searchsorted(begins, ends - 1, "right") - 1
    for (end, period), start, n in zip(starts, starts.values(), owner.tolist()):
        if end - start >= max(LEAST_LENGTH, LEAST_PERIODS * period):
            out[n].append((int(start - begins[n]), end - start, period))
    for found in out:
        found.sort(key=lambda run: (run[0], run[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change[:-1]) > 0
    return [w for w, gone in zip(words, dropped.tolist()) if not gone]


def _split(text: str | None) -> list[bytes]:
    # Splits at space and tab to carriage return, as bytes do.
    return (text or "").encode("utf-8", "surrogatepass").split()


def _in_portions(texts: list[str | None]) -> Iterator[list[list[bytes]]]:
    """The words of texts, so many texts together as hold WORDS_AT_ONCE words."""
    held, size = [], 0
    for text in texts:
        words = _split(text)
        if held and size + len(words) > WORDS_AT_ONCE:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed_text`` of every row.

    Words are runs of characters other than space and tab to carriage return,
    numbered from 0. ``runs`` lists ``start, length, period`` of every stretch of
    words with that smallest period, of LEAST_LENGTH words and LEAST_PERIODS
    periods or more, that no neighbouring word extends; by start, then period.
    ``collapsed_text`` joins the words by a space, without those that a run holds
    behind its first period.

    A NULL, empty or blank text has no words and no runs. Rows that repeat an
    id, or have none, are each answered; an empty table gives an empty result.
    A document is one task's work: about 100 bytes a word, and for words that
    repeat 8 bytes more for every doubling of their longest repeat.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for portion in _in_portions(batch["text"].tolist()):
                numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
                for words, runs in zip(portion, runs_of([[numbers[w] for w in d] for d in portion])):
                    kept = b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass")
                    listed = [{"start": s, "length": n, "period": p} for s, n, p in runs]
                    rows.append((len(words), listed, kept))
            columns = ["n_words", "runs", "collapsed_text"]
            yield pd.DataFrame({"doc_id": batch["doc_id"]} | dict(zip(columns, map(list, zip(*rows)))))

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(
        rows, run, "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed_text string"
    )


def longest(runs: Column) -> Column:
    """The run with the greatest length, of equal ones the first by start and
    period; NULL where there is none."""
    return F.reduce(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))),
        F.get(runs, F.lit(0)),
        lambda best, run: F.when(run["length"] > best["length"], run).otherwise(best),
    )


def digest_of_runs(runs: Column) -> Column:
    """SHA-256 of ``start,length,period`` and a line feed for every run."""
    lines = F.transform(
        runs, lambda r: F.concat_ws(",", *[r[part].cast("string") for part in ("start", "length", "period")])
    )
    return F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")), 256)
