"""Alignment of two tokenizers' tokens by merging their byte offsets in lockstep.

Tokenizer A is a byte-level BPE, tokenizer B a SentencePiece model; both spell
the same bytes. Where tokens of both end at one byte, the text is cut; the
tokens between two cuts are a group, and every A token of a group is linked to
every B token of it.

All documents of a batch are merged at once: one NumPy state vector holds, for
every document, the pointer to its current A and B token and the tokens its
open group began with. A step compares the ends of all current tokens, moves the
pointer of whichever ends first, or both and then emits the cut and the group's
links, and leaves finished documents out of the vector. So that one long
document does not go on alone for ever, documents are entered in stretches of
about ``STRETCH`` tokens, from one common end of tokens to a later one.

How many documents link a pair of ids is counted over the whole corpus. A batch
is a *block* with a dictionary of its distinct pairs, and documents refer to
places in it, so the count shuffles each pair once per block and not once per
document; a block's dictionary gets its counts back by block. The blocks are
bounded by bytes of text, a pair that most blocks hold is looked up by
broadcast of the ``HOT_KEYS`` most common ones, and nothing else is broadcast.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, map_rows, stored
from tidemark.llm.tokens import PATTERN

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"

# A tokens in a stretch, and how many ends behind it may be tried for a cut.
STRETCH, TRIES = 256, 8
# Bytes of text merged together; a longer document goes alone.
BYTES_AT_ONCE = 2_000_000
# A group with more links than this is linked by distinct ids and their counts.
WIDE_GROUP = 4_096
# A pair of ids in one number: an id is below this.
ID_SPAN = 1 << 31


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Bytes that print as Latin-1 stand for themselves; the others are numbered
    on from 256 in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizer:
    """A tokenizer's ids and the bytes of each."""

    def __init__(self, encode, spelled: list[bytes]):
        self.encode, self.spelled = encode, spelled
        self.sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))


@lru_cache(maxsize=2)
def byte_level(path: str = BYTE_LEVEL) -> Tokenizer:
    """Byte pairs of a byte-level vocabulary, merged by falling rank as its file
    says; a token's number is its rank. Special tokens are left out: their
    strings in a text are plain text."""
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    alphabet = byte_alphabet()
    special = {token["content"] for token in described["added_tokens"]}
    ranks = {bytes(map(alphabet.__getitem__, t)): n for t, n in described["model"]["vocab"].items() if t not in special}
    library = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    spelled = [b""] * (max(ranks.values()) + 1)
    for token, number in ranks.items():
        spelled[number] = token
    return Tokenizer(lambda texts: [library.encode_ordinary(" " + t) for t in texts], spelled)


@lru_cache(maxsize=2)
def pieces(path: str = PIECES) -> Tokenizer:
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for number in range(library.get_piece_size()):
        piece = library.id_to_piece(number)
        single = library.is_byte(number)
        spelled.append(bytes([int(piece[3:5], 16)]) if single else piece.replace("▁", " ").encode())
    return Tokenizer(lambda texts: library.encode(texts, num_threads=1), spelled)


def encoded(texts: list[str | None], first: Tokenizer, second: Tokenizer) -> list[tuple[list[int], list[int]]]:
    """A and B ids of each text; none for a NULL or empty text, and where the
    tokens do not spell a space and the text."""
    filled = [i for i, t in enumerate(texts) if t]
    wanted = [texts[i] for i in filled]
    found: list[tuple[list[int], list[int]]] = [([], [])] * len(texts)
    for i, text, a, b in zip(filled, wanted, first.encode(wanted), second.encode(wanted)):
        content = b" " + text.encode("utf-8", "surrogatepass")
        spells = [b"".join(map(t.spelled.__getitem__, ids)) == content for t, ids in ((first, a), (second, b))]
        if all(spells):
            found[i] = a, b
    return found


def stretches(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
    """Where the merge begins and stops: rows ``a, b, stop of a``.

    ``last_a`` and ``last_b`` are, per document with tokens, one more than its
    last token. Besides, documents are split where an A and a B token end
    together, at the first such place after every STRETCH tokens, if there is
    one among the next TRIES.
    """
    ahead = np.arange(STRETCH, len(ends_a), STRETCH)[:, None] + np.arange(TRIES)
    ahead = np.minimum(ahead, max(len(ends_a) - 1, 0))
    at = np.searchsorted(ends_b, ends_a[ahead])
    common = ends_b[np.minimum(at, max(len(ends_b) - 1, 0))] == ends_a[ahead]
    split = common.any(axis=1)
    column = common.argmax(axis=1)[split]
    rows = np.flatnonzero(split)
    a = np.concatenate([ahead[rows, column] + 1, last_a])
    b = np.concatenate([at[rows, column] + 1, last_b])
    a, where = np.unique(a, return_index=True)
    b = b[where]
    return np.stack([np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]]), a])


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, begin: np.ndarray) -> Iterator[np.ndarray]:
    """Groups in the order they close: rows ``a from, a to, b from, b to``.

    ``begin`` is of :func:`stretches`. One state vector per stretch: the current
    A and B token, the first ones of the open group, and where A stops.
    """
    state = np.stack([begin[0], begin[1], begin[0], begin[1], begin[2]])
    while state.shape[1]:
        end_a, end_b = ends_a[state[0]], ends_b[state[1]]
        state[0] += end_a <= end_b
        state[1] += end_b <= end_a
        cut = end_a == end_b
        if cut.any():
            closed = state[:, cut]
            yield closed[[2, 0, 3, 1]]
            state[2:4, cut] = closed[0:2]
            live = state[0] < state[4]
            if not live.all():
                state = state[:, live]


def links(groups: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked ids of closed groups: the group's first A token, the pair as one
    number, and how many links it stands for."""
    from_a, to_a, from_b, to_b = groups
    size = (to_a - from_a) * (to_b - from_b)
    single, wide = size == 1, size > WIDE_GROUP
    alone_a, alone_b = from_a[single], from_b[single]
    out = [
        (alone_a, ids_a[alone_a] * ID_SPAN + ids_b[alone_b], np.ones(len(alone_a), np.int64)),
        _each_link(groups[:, ~single & ~wide], ids_a, ids_b),
    ]
    for a0, a1, b0, b1 in groups[:, wide].T:
        a, times_a = np.unique(ids_a[a0:a1], return_counts=True)
        b, times_b = np.unique(ids_b[b0:b1], return_counts=True)
        pair = (a[:, None] * ID_SPAN + b).ravel()
        out.append((np.full(len(pair), a0), pair, np.outer(times_a, times_b).ravel()))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def _each_link(groups: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, ...]:
    from_a, to_a, from_b, to_b = groups
    across = to_b - from_b
    size = (to_a - from_a) * across
    ahead = np.cumsum(size) - size
    within = np.arange(size.sum()) - np.repeat(ahead, size)
    across = np.repeat(across, size)
    a = np.repeat(from_a, size) + within // across
    b = np.repeat(from_b, size) + within % across
    return np.repeat(from_a, size), ids_a[a] * ID_SPAN + ids_b[b], np.ones(len(a), np.int64)


class Merged:
    """The groups and links of a batch of encoded documents."""

    def __init__(self, found: list[tuple[list[int], list[int]]], first: Tokenizer, second: Tokenizer):
        self.count_a = np.array([len(a) for a, _ in found], np.int64)
        self.count_b = np.array([len(b) for _, b in found], np.int64)
        self.ids_a = np.fromiter(chain.from_iterable(a for a, _ in found), np.int64, self.count_a.sum())
        self.ids_b = np.fromiter(chain.from_iterable(b for _, b in found), np.int64, self.count_b.sum())
        ends_a, ends_b = np.cumsum(first.sizes[self.ids_a]), np.cumsum(second.sizes[self.ids_b])
        self.last_a, self.last_b = np.cumsum(self.count_a), np.cumsum(self.count_b)
        some = self.count_a > 0
        begin = stretches(ends_a, ends_b, self.last_a[some], self.last_b[some])
        closed = np.concatenate([np.zeros((4, 0), np.int64), *lockstep(ends_a, ends_b, begin)], axis=1)
        at = np.full(len(self.ids_a), -1)
        at[closed[0]] = np.arange(closed.shape[1])
        self.groups = closed[:, at[at >= 0]]
        # What each step emits is a range of A and of B tokens, all linked.
        at, self.pairs, self.times = links(self.groups, self.ids_a, self.ids_b)
        self.link_owner = self.owner(at)
        self.n_groups = np.bincount(self.owner(self.groups[0]), minlength=len(found))
        self.n_links = _sums(self.link_owner, self.times, len(found))

    def owner(self, tokens: np.ndarray) -> np.ndarray:
        """The documents that A tokens belong to."""
        return np.searchsorted(self.last_a, tokens, "right")

    def spelled_groups(self) -> Iterator[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
        from_a, to_a, from_b, to_b = self.groups
        tokens = np.zeros(len(self.ids_a) + len(self.ids_b), np.int64)
        sign = np.full(len(tokens), 0)
        # A group's A tokens follow the B tokens of the groups before it.
        tokens[np.arange(len(self.ids_a)) + np.repeat(from_b, to_a - from_a)] = self.ids_a
        tokens[np.arange(len(self.ids_b)) + np.repeat(to_a, to_b - from_b)] = self.ids_b
        sign[to_a + from_b - 1] = 1
        sign[to_a + to_b - 1] = 2
        words = _with_signs(int(tokens.max(initial=0)) + 1)
        parts = list(map(words.__getitem__, (tokens * 3 + sign).tolist()))
        end = 0
        for size in (self.count_a + self.count_b).tolist():
            yield "".join(parts[end : end + size])[:-1]
            end += size

    def dictionary(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """The distinct pairs and how many documents hold each, then per
        document the places of its pairs among them and their links."""
        place, pairs = pd.factorize(self.pairs)
        where, keys = pd.factorize(self.link_owner * max(len(pairs), 1) + place)
        times = _sums(where, self.times, len(keys))
        by = np.argsort(keys)
        times = times[by]
        owner, place = np.divmod(keys[by], max(len(pairs), 1))
        bounds = np.searchsorted(owner, np.arange(1, len(self.count_a)))
        return pairs, np.bincount(place, minlength=len(pairs)), np.split(place, bounds), np.split(times, bounds)


def _sums(where: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Whole-number sums of ``values`` by their places."""
    out = np.zeros(size, np.int64)
    np.add.at(out, where, values)
    return out


@lru_cache(maxsize=4)
def _with_signs_of(size: int) -> list[str]:
    return [str(i) + sign for i in range(size) for sign in ",|;"]


def _with_signs(size: int) -> list[str]:
    """Decimal ids below ``size``, each with the sign that may follow it."""
    return _with_signs_of(1 << max(size - 1, 1).bit_length())


def _portions(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list]]:
    """Ids and texts, so many together as hold BYTES_AT_ONCE bytes."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for number, text in zip(batch["doc_id"], batch["text"]):
            length = len(text.encode("utf-8", "surrogatepass")) if text else 0
            if ids and size + length > BYTES_AT_ONCE:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(number)
            texts.append(text)
            size += length
    if ids:
        yield ids, texts


def aligned(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    first: str = BYTE_LEVEL,
    second: str = PIECES,
) -> DataFrame:
    """``doc_id, a_ids, b_ids, groups`` of every row.

    A group has ``a`` and ``b``, how many tokens of each it spans, in order. A
    NULL or empty text, and one that the two tokenizers do not both spell byte
    by byte (SentencePiece changes some characters), has no tokens and no
    groups. Rows that repeat an id or have none are each answered.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = byte_level(first), pieces(second)
        for batch in batches:
            found = encoded(batch["text"].tolist(), *tables)
            merged = Merged(found, *tables)
            from_a, to_a, from_b, to_b = merged.groups
            bounds = np.searchsorted(merged.owner(from_a), np.arange(1, len(found)))
            spans = np.split(np.stack([to_a - from_a, to_b - from_b], axis=1), bounds)
            groups = [[{"a": a, "b": b} for a, b in span.tolist()] for span in spans]
            columns = {"a_ids": [a for a, _ in found], "b_ids": [b for _, b in found], "groups": groups}
            yield pd.DataFrame({"doc_id": batch["doc_id"]} | columns)

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(rows, run, "a_ids array<int>, b_ids array<int>, groups array<struct<a:int,b:int>>")


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _merged_blocks(rows: DataFrame, first: str, second: str) -> DataFrame:
    """Two kinds of rows: a block's dictionary (``pairs`` and ``holders``), and a
    document's counts, digest, and its ``places`` in it with their ``times``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = byte_level(first), pieces(second)
        for number, (ids, texts) in enumerate(_portions(batches)):
            block = f"{TaskContext.get().partitionId()}-{number}"
            merged = Merged(encoded(texts, *tables), *tables)
            pairs, holders, places, times = merged.dictionary()
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in merged.spelled_groups()]
            counts = (merged.count_a, merged.count_b, merged.n_groups, merged.n_links)
            yield pd.DataFrame(
                {"block": block, "doc_id": ids}
                | dict(zip(_COUNTS, counts))
                | {"groups_sha256": digests, "places": places, "times": times, "pairs": None, "holders": None}
            )
            empty = {c: [None] for c in ("doc_id", *_COUNTS, "groups_sha256", "places", "times")}
            yield pd.DataFrame({"block": [block]} | empty | {"pairs": [pairs], "holders": [holders]})

    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    return rows.mapInPandas(
        run,
        f"block string, doc_id string, {counts}, groups_sha256 string, places array<int>, times array<int>,"
        " pairs array<bigint>, holders array<int>",
    )


def pair_counts(dictionaries: DataFrame) -> DataFrame:
    """``pair, documents, blocks, is_best``: in how many documents a pair of ids
    is linked, and whether no pair with its A id is linked in more.

    ``dictionaries`` has a row ``pair, holders`` for every block and pair.
    """
    counts = dictionaries.groupBy("pair").agg(
        F.sum("holders").alias("documents"), F.count("*").alias("blocks")
    )
    counts = stored(counts.withColumn("a", F.expr(f"pair div {ID_SPAN}")), "pair-counts")
    # As many rows as tokenizer A has tokens at most.
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(most, "a").select(
        "pair", "documents", "blocks", (F.col("documents") == F.col("most")).alias("is_best")
    )


def alignment_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    first: str = BYTE_LEVEL,
    second: str = PIECES,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    of every row.

    A pair's count is the number of rows whose text holds it linked. ``n_best``
    counts the links whose count is the highest that their A id has with any B
    id, ties included; ``count_sum`` sums the counts of a row's links. The digest
    is of ``a1,a2|b1;a3|b2,b3``. A text without tokens (see :func:`aligned`) has
    zeros and an empty digest. Rows that repeat an id or have none are each
    counted and answered; an empty table gives an empty result.
    """
    kind = docs.schema[id_column].dataType
    rows = docs.select(F.col(id_column).cast("string").alias("doc_id"), F.col(text_column).alias("text"))
    blocks = stored(_merged_blocks(rows, first, second), "alignment-blocks")
    entries = blocks.where(F.col("pairs").isNotNull()).select(
        "block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "entry")
    )
    entries = entries.select("block", "place", F.col("entry.pairs").alias("pair"), F.col("entry.holders").alias("holders"))
    counted = stored(pair_counts(entries), "pair-best")
    valued = attach(entries.drop("holders"), counted, ["pair"], "blocks").select(
        F.col("block").alias("in_block"), "place", "documents", "is_best"
    )
    fields = ("doc_id", *_COUNTS, "groups_sha256")

    def summed(held: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        documents, is_best = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
        documents[values["place"]] = values["documents"]
        is_best[values["place"]] = values["is_best"]
        links_at = np.array([len(p) for p in held["places"]], np.int64)
        owner = np.repeat(np.arange(len(held)), links_at)
        places, times = (np.concatenate([np.zeros(0, np.int64), *held[c]]).astype(np.int64) for c in ("places", "times"))
        return held[list(fields)].assign(
            n_best=_sums(owner, times * is_best[places], len(held)),
            count_sum=_sums(owner, times * documents[places], len(held)),
        )

    held = blocks.where(F.col("pairs").isNull()).select("block", *fields, "places", "times")
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    found = (
        held.groupBy("block")
        .cogroup(valued.groupBy("in_block"))
        .applyInPandas(summed, f"doc_id string, {counts}, groups_sha256 string, n_best bigint, count_sum bigint")
    )
    return found.select(
        F.col("doc_id").cast(kind).alias("doc_id"), *_COUNTS, "n_best", "count_sum", "groups_sha256"
    )
