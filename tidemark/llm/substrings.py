"""Removal of passages that occur earlier in the corpus, by seed and extend.

A window is ``WINDOW`` = 20 consecutive words. Of the ``SEED`` = 9-word seeds in
it, the one with the smallest hash is its anchor (winnowing; of equal ones the
first). The anchor depends on the window's words alone, so equal windows have
equal anchors at equal places, and consecutive windows mostly share one: a text
has an anchor about every six words.

*Seed.* Anchors are dealt by hash. One that occurs once decides nothing.

*Extend.* An anchor is extended both ways over all windows it is the anchor of;
the hash of that stretch is its extension. If anchor and extension both occur
in an earlier document, all those windows are repeats. Where an anchor occurs
with different extensions, at the edge of a repeat, its windows are *open*: they
are compared one by one, again under their anchor. Both comparisons are on 128
bits, the anchor's hash and the other.

*Maximal repeats.* A document's repeated windows, those it repeats from itself
included, are united to maximal stretches.

Only the first document of a window is kept in mind, never pairs of documents,
so a passage that many documents share costs one row for each of them. Anchors
that a sample shows to be frequent are dealt by (anchor, salt) and settled in a
second round among the first documents per salt. The sample only chooses the
way; the outcome is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, stored

WINDOW = 20
SEED = 9

# Documents looked at for frequent anchors: one in SAMPLE_STEP.
SAMPLE_STEP = 64
FREQUENT_IN_SAMPLE = 20
FREQUENT_ANCHORS = 1_000
SALTS = 64

_M = np.uint64(0x9E3779B97F4A7C15)
_M_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(hashes: np.ndarray, length: int, factor: int) -> np.ndarray:
    """Polynomial hash of every run of ``length`` words."""
    power, total = np.uint64(1), np.zeros(len(hashes) - length + 1, np.uint64)
    for j in range(length):
        total += hashes[j : len(hashes) - length + 1 + j] * power
        power = np.uint64(int(power) * factor & (1 << 64) - 1)
    return total


def _power_tables(count: int, tables: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """Powers 0..count of the factor and of its inverse, kept between texts."""
    if len(tables.get("up", ())) <= count:
        size = max(2 * count, 4_096)
        for name, factor in (("up", _M), ("down", _M_INVERSE)):
            steps = np.full(size, factor)
            steps[0] = 1
            tables[name] = np.cumprod(steps, dtype=np.uint64)
    return tables["up"][: count + 1], tables["down"][: count + 1]


class Anchored:
    """A text's windows, and the stretches of them that share an anchor."""

    def __init__(self, words: list[bytes], window: int, seed: int):
        self.windows = max(len(words) - window + 1, 0)
        if not self.windows:
            return
        digest = xxhash.xxh3_64_intdigest
        hashes = np.array([digest(w) for w in words], np.uint64)
        seeds = _mix(_sums(hashes, seed, 0xD6E8FEB86659FD93))
        width = window - seed + 1
        views = np.lib.stride_tricks.sliding_window_view(seeds, width)
        starts = np.arange(self.windows)
        place = starts + views.argmin(axis=1)
        changes = np.flatnonzero(place[1:] != place[:-1]) + 1
        self.first = np.concatenate([[0], changes])
        self.last = np.concatenate([changes, [self.windows]]) - 1
        self.anchor = seeds[place[self.first]]
        # Hash of words first..last + window - 1 from sums over all words.
        up, down = _power_tables(len(words))
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(hashes * up[:-1], out=sums[1:])
        end = self.last + window
        stretch = (sums[end] - sums[self.first]) * down[self.first]
        shape = (place[self.first] - self.first) * 4096 + (end - self.first)
        self.extension = _mix(stretch + _mix(shape.astype(np.uint64)))
        self.hashes, self.window = hashes, window

    def window_hashes(self) -> np.ndarray:
        return _mix(_sums(self.hashes, self.window, 0xA24BAED4963EE407))

    def window_anchors(self) -> np.ndarray:
        return np.repeat(self.anchor, self.last - self.first + 1)


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _once(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where a text's pairs (a, b) occur first. Within one text 64 bits do."""
    return np.unique(_mix(a) ^ b, return_index=True)[1]


def _within(a: np.ndarray, b: np.ndarray, known_a, known_b) -> np.ndarray:
    """Which of the pairs (a, b) are among the known pairs."""
    known = set(zip(np.asarray(known_a, np.int64).tolist(), np.asarray(known_b, np.int64).tolist()))
    pairs = zip(a.view(np.int64).tolist(), b.view(np.int64).tolist())
    return np.fromiter((p in known for p in pairs), bool, len(a))


def _spans(repeated: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal stretches of words that repeated windows cover, ends excluded."""
    spans: list[list[int]] = []
    for start in np.flatnonzero(repeated).tolist():
        if spans and start <= spans[-1][1]:
            spans[-1][1] = start + window
        else:
            spans.append([start, start + window])
    return [tuple(s) for s in spans]


def _anchors(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """``anchor, extension, doc_id``, each once per row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            anchors, extensions, ids = [], [], []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                found = Anchored(_split(text), window, seed)
                if found.windows:
                    once = _once(found.anchor, found.extension)
                    anchors.append(found.anchor[once])
                    extensions.append(found.extension[once])
                    ids += [doc] * len(once)
            if ids:
                yield pd.DataFrame(
                    {
                        "anchor": np.concatenate(anchors).view(np.int64),
                        "extension": np.concatenate(extensions).view(np.int64),
                        "doc_id": ids,
                    }
                )

    return map_rows(rows, run, "anchor bigint, extension bigint")


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by anchor, salt, extension and document, to marks.

    ``state`` is "repeat" where the document is not the first of its extension,
    "open" where it is and the anchor has several extensions, and "salted"
    where a frequent anchor's first documents per salt are still to be compared.
    Rows that share the first document's id are all of the first document.
    Only the row before and one row that waits are remembered.
    """
    before: tuple | None = None
    classes, waiting = 0, None
    for batch in batches:
        anchor = batch["anchor"].to_numpy()
        salt = batch["salt"].to_numpy()
        extension = batch["extension"].to_numpy()
        if not len(anchor):
            continue
        new_run = np.r_[True, (anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])]
        new_class = new_run | np.r_[True, extension[1:] != extension[:-1]]
        if before is not None:
            new_run[0] = (anchor[0], salt[0]) != before[:2]
            new_class[0] = new_run[0] or extension[0] != before[2]
        # The document that each row's class begins with, maybe in the batch before.
        ids = batch["doc_id"].to_numpy()
        start = np.maximum.accumulate(np.where(new_class, np.arange(len(ids)), -1))
        heads = ids[np.maximum(start, 0)]
        own = ids == heads
        if before is not None:
            own = np.where(start < 0, ids == before[3], own)
        run = np.cumsum(new_run)  # run 0 goes on from the batch before
        count = np.bincount(run[new_class], minlength=run[-1] + 1)
        count[0] += classes
        state = np.where(~new_class & ~own, "repeat", np.where(salt >= 0, "salted", np.where(count[run] > 1, "open", "")))
        marks = batch[["doc_id", "anchor", "extension"]].assign(state=state)
        if waiting is not None and count[0] > 1:
            yield waiting.assign(state="open")
        if waiting is not None and (count[0] > 1 or run[-1] > 0):
            waiting = None
        yield marks[marks["state"] != ""]
        classes = int(count[run[-1]])
        if classes == 1 and salt[-1] < 0 and (lone := np.flatnonzero((run == run[-1]) & new_class)).size:
            waiting = marks.iloc[lone[:1]]
        before = (anchor[-1], salt[-1], extension[-1], heads[-1] if start[-1] >= 0 else before[3])


def _marks(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """``doc_id, anchor, extension, open`` where an anchor decides something."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_STEP)) == 0)
    frequent = (
        _anchors(sample, window, seed)
        .groupBy("anchor")
        .agg(F.count("*").alias("times"))
        .where(F.col("times") >= FREQUENT_IN_SAMPLE)
        .orderBy(F.desc("times"), "anchor")
        .limit(FREQUENT_ANCHORS)
        .select("anchor", F.lit(True).alias("frequent"))
    )
    dealt = (
        _anchors(rows, window, seed)
        .join(F.broadcast(stored(frequent, "frequent-anchors")), "anchor", "left")
        .withColumn(
            "salt",
            F.when(F.col("frequent"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(-1).cast("int"),
        )
        .drop("frequent")
        .repartition("anchor", "salt")
        .sortWithinPartitions("anchor", "salt", "extension", "doc_id")
    )
    marks = dealt.mapInPandas(_settle, f"doc_id {kind}, anchor bigint, extension bigint, state string")
    marks = stored(marks, "anchor-marks")
    salted = marks.where("state = 'salted'").drop("state")
    firsts = salted.groupBy("anchor", "extension").agg(F.min("doc_id").alias("first_id"))
    settled = salted.join(firsts, ["anchor", "extension"]).select(
        "doc_id", "anchor", "extension", (F.col("doc_id") == F.col("first_id")).alias("open")
    )
    return marks.where("state <> 'salted'").select(
        "doc_id", "anchor", "extension", (F.col("state") == "open").alias("open")
    ).unionByName(settled)


def _packed(rows: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle by document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [pack((t or "").encode("utf-8", "surrogatepass")) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "packed": texts})

    return map_rows(rows, run, "packed binary")


def _unpacked_words(unpack, packed: bytes) -> list[bytes]:
    return unpack(packed).split()


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, spans, n_removed, kept_text`` of every row.

    ``spans`` are the maximal stretches of words (start, end excluded) covered
    by windows whose words also start earlier: in a document with a smaller id,
    or earlier in the same one. They are judged on the input. ``kept_text`` is
    the other words, joined by one space. Words are runs of characters other
    than space and tab to carriage return.

    A NULL text has no words; a text shorter than a window keeps all. Rows that
    share an id are not compared with each other. A row without an id is only
    compared with itself. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    marks = stored(_marks(rows.where("doc_id IS NOT NULL"), window, seed), "repeat-marks")
    texts = _packed(rows)

    by_doc = marks.groupBy("doc_id").agg(
        *[
            F.collect_set(F.when(F.col("open") == is_open, F.struct("anchor", "extension"))).alias(name)
            for name, is_open in (("open", True), ("repeat", False))
        ]
    )
    by_doc = by_doc.select(
        "doc_id",
        *[
            F.col(f"{state}.{part}").alias(f"{state}_{part}")
            for state in ("open", "repeat")
            for part in ("anchor", "extension")
        ],
    )
    by_doc = stored(by_doc, "marks-by-document")

    def open_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            anchors, windows, ids = [], [], []
            for doc, packed, a, x in zip(batch["doc_id"], batch["packed"], batch["open_anchor"], batch["open_extension"]):
                found = Anchored(_unpacked_words(unpack, packed), window, seed)
                if not found.windows:
                    continue
                chosen = np.repeat(_within(found.anchor, found.extension, a, x), found.last - found.first + 1)
                own_anchors, own_windows = found.window_anchors()[chosen], found.window_hashes()[chosen]
                once = _once(own_anchors, own_windows)
                anchors.append(own_anchors[once])
                windows.append(own_windows[once])
                ids += [doc] * len(once)
            if ids:
                yield pd.DataFrame(
                    {
                        "anchor": np.concatenate(anchors).view(np.int64),
                        "window": np.concatenate(windows).view(np.int64),
                        "doc_id": ids,
                    }
                )

    opened = by_doc.where(F.size("open_anchor") > 0).select("doc_id", "open_anchor", "open_extension")
    firsts = (
        texts.join(opened, "doc_id")
        .mapInPandas(open_windows, f"anchor bigint, window bigint, doc_id {kind}")
        .groupBy("anchor", "window")
        .agg(F.min("doc_id").alias("doc_id"))
    )
    first_lists = firsts.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "window")).alias("first"))
    first_lists = stored(
        first_lists.select(
            "doc_id", *[F.col(f"first.{part}").alias(f"first_{part}") for part in ("anchor", "window")]
        ),
        "first-windows",
    )

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        names = ("repeat_anchor", "repeat_extension", "open_anchor", "open_extension", "first_anchor", "first_window")
        for batch in batches:
            out = []
            for row in zip(batch["doc_id"], batch["packed"], *[batch[n] for n in names]):
                words = _unpacked_words(unpack, row[1])
                lists = [() if v is None else v for v in row[2:]]
                spans = _repeats(Anchored(words, window, seed), lists, window)
                kept, at = [], 0
                for start, end in spans:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                out.append((row[0], len(words), spans, len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "spans", "n_removed", "kept_text"])

    joined = texts.join(by_doc, "doc_id", "left").join(first_lists, "doc_id", "left")
    return map_rows(
        joined,
        finish,
        "n_words bigint, spans array<struct<start:bigint,end:bigint>>,"
        " n_removed bigint, kept_text string",
    )


def _repeats(found: Anchored, lists: list, window: int) -> list[tuple[int, int]]:
    """Maximal repeats of a text: those inside it, of marked anchors, and of
    open anchors' windows that are not the first."""
    if not found.windows:
        return []
    size = found.last - found.first + 1
    anchors, hashes = found.window_anchors(), found.window_hashes()
    repeated = np.ones(found.windows, bool)
    repeated[_once(anchors, hashes)] = False
    if len(lists[0]):
        repeated |= np.repeat(_within(found.anchor, found.extension, lists[0], lists[1]), size)
    if len(lists[2]):
        opened = np.repeat(_within(found.anchor, found.extension, lists[2], lists[3]), size)
        at = np.flatnonzero(opened & ~repeated)
        repeated[at] = ~_within(anchors[at], hashes[at], lists[4], lists[5])
    return _spans(repeated, window)
