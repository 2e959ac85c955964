"""Near-duplicate detection by SimHash with a byte-position index.

Two 64-bit fingerprints that differ in at most ``BITS`` = 4 bits agree in at
least four of their eight bytes. An inverted index over single (position, byte)
pairs would have only 2,048 lists, each a fixed share of all fingerprints, so
tallying shared bytes list by list is quadratic in the corpus. The index here
has one list per *three* positional bytes, for a fixed system of 20 triples of
positions such that every four positions contain a triple: any pair that
reaches the guaranteed minimum of four shared bytes meets in a list, and a list
holds one fingerprint in 2^24. In a list the shared positional bytes of a pair
are tallied, pairs with the guaranteed minimum are kept, and those are verified.

No list emits all its pairs. A list is searched for a spanning forest of its
links: members already reached are not compared again. A list longer than
``BLOCK`` is cut into blocks, and each pair of blocks is searched by itself, so
no task holds more than two blocks however many fingerprints share their bytes.

Equal fingerprints are one node, so copies never multiply.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, map_rows, stored
from tidemark.llm.components import connected_components

# Fixed values of the fingerprint.
SEED = 42
BITS = 4

BLOCK = 4_096


def position_triples() -> list[tuple[int, int, int]]:
    """The 20 triples out of 8 positions that every 4 positions contain one of.

    Positions are dealt into rings of 3, 3 and 2. A triple counts if it lies in
    one ring, or has two members in a ring and one in the next. Four positions
    always contain such a triple, by the pigeonhole principle on three rings.
    """
    ring = [p % 3 for p in range(8)]

    def counts(triple):
        a, b, c = sorted(ring[p] for p in triple)
        if a == c:
            return True
        if a == b:
            return c == (a + 1) % 3
        return b == c and a == (b + 1) % 3

    return [t for t in combinations(range(8), 3) if counts(t)]


TRIPLES = position_triples()


def shingle_hashes(text: str | None, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle in order, repeats included.

    Words are runs of characters other than space and tab to carriage return;
    A-Z are lower-cased. A text of fewer words is one shingle; one of none has
    none.
    """
    folded = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not folded:
        return np.zeros(0, np.uint64)
    joined = b" ".join(folded)
    if len(folded) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    lengths = np.fromiter(map(len, folded), np.int64, len(folded))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(folded) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[s:e], seed) for s, e in zip(starts, ends[words - 1 :].tolist())], np.uint64
    )


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; no hash, no bit."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65_536):
        block = hashes[i : i + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0]) if len(hashes) else 0


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 4
) -> DataFrame:
    """``doc_id, digest`` (SHA-256 of the text) and ``fingerprint`` (a signed 64-bit
    number) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t, words)) for t in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "digest": batch["digest"], "fingerprint": _signed(found)}
            )

    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("digest"))
    return map_rows(rows, run, "digest string, fingerprint bigint")


def postings(nodes: DataFrame, node: str, lane: str) -> DataFrame:
    """One row per list a fingerprint is in: ``node, list``."""

    def byte(position: int):
        return F.shiftright(lane, 8 * position).bitwiseAND(F.lit(255))

    keys = []
    for number, triple in enumerate(TRIPLES):
        key = F.lit(number).cast("bigint")
        for position in triple:
            key = key * 256 + byte(position)
        keys.append(key)
    return nodes.select(F.col(node).alias("node"), F.explode(F.array(*keys)).alias("list"))


def blocks_of(members: DataFrame, key: str, node: str, block: int) -> DataFrame:
    """Members of every key with two or more, dealt into pairs of blocks.

    ``key, node, i, j``: a member of block b is in the pairs (b, j) and (i, b),
    so every two members of a key meet in a pair, and a pair has at most about
    two blocks of members.
    """
    sizes = members.groupBy(key).agg(F.count("*").alias("members")).where("members > 1")
    # A block is a tenth smaller on average, for it is filled by hash.
    cuts = F.ceil(F.col("members") / F.lit(block * 0.9)).cast("int")
    cut = F.pmod(F.xxhash64(node), F.col("cuts")).cast("int")
    return (
        members.join(sizes.select(key, cuts.alias("cuts")), key)
        .withColumn("cut", cut)
        .select(key, node, "cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other"))
        .select(key, node, F.least("cut", "other").alias("i"), F.greatest("cut", "other").alias("j"))
    )


def forest(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Spanning forest of the links among 0..count-1.

    ``near(x, others)`` is the part of ``others`` that x is linked to. What has
    been reached is not compared again.
    """
    left = np.arange(count)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            found = near(x, left)
            if len(found):
                yield from ((x, y) for y in found)
                queue.extend(found)
                left = np.setdiff1d(left, found, assume_unique=True)


def shared_bytes(difference: np.ndarray) -> np.ndarray:
    """How many of a 64-bit difference's bytes are zero."""
    folded = difference | (difference >> np.uint64(4))
    folded |= folded >> np.uint64(2)
    folded |= folded >> np.uint64(1)
    return 8 - np.bitwise_count(folded & np.uint64(0x0101010101010101)).astype(np.int64)


def _near_fingerprints(values: np.ndarray, bits: int):
    least = 8 - bits

    def near(x: int, others: np.ndarray) -> np.ndarray:
        difference = values[others] ^ values[x]
        some = shared_bytes(difference) >= least
        return others[some][np.bitwise_count(difference[some]) <= bits]

    return near


def fingerprint_links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Links ``a, b`` that connect distinct fingerprints as all links within
    ``bits`` bits would. ``nodes`` has them once each, as ``fingerprint``."""
    if not 0 <= bits <= 4:
        raise ValueError("the index guarantees links of at most 4 bits")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links = []
            for members in batch["members"]:
                values = np.asarray(members, np.int64)
                near = _near_fingerprints(values.view(np.uint64), bits)
                links += [(values[x], values[y]) for x, y in forest(len(values), near)]
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    lists = blocks_of(postings(nodes, "fingerprint", "fingerprint"), "list", "node", BLOCK)
    groups = lists.groupBy("list", "i", "j").agg(F.collect_list("node").alias("members"))
    return groups.select("members").mapInPandas(run, "a bigint, b bigint")


def simhash_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 4,
    bits: int = BITS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    The component is the smallest id that links of at most ``bits`` bits reach.
    A NULL or empty text, or one of white space, has fingerprint zero and is
    linked like any other. Rows that repeat an id or a text are listed as often
    as they occur. An empty table gives an empty result.
    """
    return _components(docs, id_column, text_column, words, bits).drop("digest")


def _components(docs: DataFrame, id_column: str, text_column: str, words: int, bits: int) -> DataFrame:
    """``doc_id, digest, fingerprint, component_id`` of every row."""
    rows = stored(fingerprints(docs, id_column, text_column, words), "fingerprints")
    nodes = stored(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("head"), F.count("*").alias("copies")),
        "fingerprint-nodes",
    )
    found = connected_components(fingerprint_links(nodes, bits))
    return _labelled(rows, nodes, found, "fingerprint")


def _labelled(rows: DataFrame, nodes: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Give every row the smallest id of its node's component."""
    rooted = stored(
        nodes.join(found, nodes[key] == found["node"], "left").select(
            key, "head", "copies", F.coalesce("root", key).alias("root")
        ),
        "rooted",
    )
    heads = stored(
        rooted.groupBy("root").agg(
            F.min("head").alias("component_id"), F.count("*").alias("members")
        ),
        "component-heads",
    )
    classes = attach(rooted.drop("head"), heads, ["root"], "members").select(
        key, "copies", "component_id"
    )
    return attach(rows, stored(classes, "component-classes"), [key], "copies").drop("copies")


def keep_one_of_group(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 4,
    bits: int = BITS,
) -> DataFrame:
    """Rows of ``docs``, unchanged, with the smallest id of their component.

    Of rows that share an id those go whose text is in the component of a smaller
    one. A row without an id stays only if no row of its component has one.
    """
    digest = F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)
    groups = _components(docs, id_column, text_column, words, bits)
    gone = (
        groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest"))
        .distinct()
    )
    match = F.col(id_column).eqNullSafe(gone["gone_id"]) & (digest == gone["gone_digest"])
    return docs.join(gone, match, "left_anti")
