"""Exact, near and substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import exact_dedup, simhash, substrings
from tidemark.llm.components import connected_components

CLASHING = ", digest string, node string, root bigint, copies int, gone_id int, salt string, anchor int, packed string"


def table(spark, rows, more: bool = True):
    """Documents with columns named as the operators name theirs."""
    tail = ("d", "n", 1, 2, 3, "s", 4, "p") if more else ()
    return spark.createDataFrame([(*r, *tail) for r in rows], "doc_id bigint, text string" + CLASHING * more)


def prose(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(4000)}" for _ in range(n)]


EDGES = [
    (1, None), (2, ""), (3, "  \t\n"), (4, "One two"), (5, "ONE TWO"), (6, "one  two"), (7, "Été"), (8, "été"),
    (9, "One two"), (9, "One two"), (10, "x " * 5_000), (11, "y" * 100_000), (12, "y" * 100_000), (13, " one two"),
]


@pytest.fixture(scope="module")
def mixed(spark):
    """Prose, near copies of various distance, and passages that documents share."""
    draw = random.Random(5)
    rows = list(EDGES)
    passage = prose(99, 70)
    for i in range(40):
        words = prose(i % 12, 150)
        for _ in range(draw.choice((0, 0, 1, 2, 8, 30))):
            words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
        if i % 4 == 0:
            at = draw.randrange(len(words))
            words[at:at] = passage[draw.randrange(30) :]
        if i % 10 == 0:
            words += words[20:60]
        rows.append((100 + i, " ".join(words)))
    draw.shuffle(rows)
    return rows


def united(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_exact_groups(spark, mixed):
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups: dict[str, list[int]] = {}
    for i, t in mixed:
        groups.setdefault(fold(t), []).append(i)
    expected = sorted(
        (i, max(groups[fold(t)]), len(groups[fold(t)]), i == max(groups[fold(t)]), hashlib.sha256(fold(t).encode()).hexdigest())
        for i, t in mixed
    )
    docs = table(spark, mixed)
    assert sorted(tuple(r) for r in exact_dedup.exact_groups(docs).collect()) == expected
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, *_, k, _ in expected if k)


def test_simhash_components(spark, mixed):
    prints = {i: simhash.fingerprint(simhash.shingle_hashes(t, 4)) for i, t in mixed}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = united(ids, links)
    rows = simhash.simhash_components(table(spark, mixed)).collect()
    assert sorted((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in rows) == sorted(
        (i, prints[i], expected[i]) for i, _ in mixed
    )
    assert prints[1] == prints[2] == prints[3] == 0


def test_dense_lists_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 4)
    draw = random.Random(2)
    values = sorted({sum(1 << b for b in draw.sample(range(64), draw.randrange(5))) for _ in range(150)})
    values += [draw.getrandbits(64) for _ in range(50)]
    signed = [v - (v >> 63 << 64) for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    found = [(r.a, r.b) for r in simhash.fingerprint_links(nodes).collect()]
    links = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 4]
    assert all((a ^ b) % 2**64 and ((a ^ b) % 2**64).bit_count() <= 4 for a, b in found)
    assert united(signed, found) == united(signed, links)


def test_every_four_positions_contain_a_triple():
    from itertools import combinations

    assert len(simhash.TRIPLES) == 20
    assert all(any({*t} <= {*four} for t in simhash.TRIPLES) for four in combinations(range(8), 4))
    x = np.array([0, 1, 1 << 63, 0xFF << 8 | 1], np.uint64)
    assert simhash.shared_bytes(x).tolist() == [8, 7, 7, 6]


def test_one_of_each_component_stays(spark, mixed):
    prints = {i: simhash.fingerprint(simhash.shingle_hashes(t, 4)) for i, t in mixed}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = united(ids, links)
    docs = table(spark, mixed)
    kept = simhash.keep_one_of_group(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in ids if expected[i] == i}
    assert len(ids) > kept.count() > 5


def test_near_copies_go_row_by_row(spark):
    a, b, c = (" ".join(prose(i, 200)) for i in range(3))
    rows = [(1, a), (2, a.upper()), (2, b), (None, a + " "), (None, b + "  "), (None, c), (3, None), (4, "")]
    kept = simhash.keep_one_of_group(table(spark, rows)).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(1, a), (2, b), (None, c), (3, None)}


def removed(rows, window):
    """Brute force: per row (id, words, removed words, kept text)."""
    seen: dict[bytes, int] = {}
    result = []
    for i, t in sorted(rows, key=lambda r: r[0]):
        words, own = (t or "").encode().split(), set()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            content = b" ".join(words[s : s + window])
            if seen.get(content, i) != i or content in own:
                gone[s : s + window] = [True] * window
            own.add(content)
            seen.setdefault(content, i)
        kept = [w for w, g in zip(words, gone) if not g]
        result.append((i, len(words), sum(gone), b" ".join(kept).decode()))
    return sorted(result)


@pytest.mark.parametrize("salted", [False, True])
def test_repeats_are_removed(spark, mixed, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(substrings, "SAMPLE_STEP", 1)
        monkeypatch.setattr(substrings, "FREQUENT_IN_SAMPLE", 2)
    found = substrings.remove_repeats(table(spark, mixed)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == removed(mixed, 20)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)
    assert sum(r.n_removed for r in found) > 1_000


@pytest.mark.parametrize("salted", [False, True])
def test_rows_that_share_an_id_keep_their_passage(spark, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(substrings, "SAMPLE_STEP", 1)
        monkeypatch.setattr(substrings, "FREQUENT_IN_SAMPLE", 2)
    own, shared = " ".join(prose(1, 60)), " ".join(prose(2, 60))
    rows = [(5, own), (5, own), (6, shared + " " + own), (6, shared), (6, shared), (7, "a " + shared), (7, "a " + shared)]
    found = substrings.remove_repeats(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == removed(rows, 20)
    assert [r.kept_text for r in found if r.doc_id == 5] == [own, own]


def test_a_shared_id_is_remembered_over_batches():
    import pandas as pd

    rows = [(1, 5), (1, 5), (1, 6), (2, 4), (2, 4), (2, 7)]
    frame = pd.DataFrame([(9, -1, x, d) for x, d in rows], columns=["anchor", "salt", "extension", "doc_id"])
    for cuts in range(2**5):
        edges = [0, *[i + 1 for i in range(5) if cuts >> i & 1], 6]
        marks = pd.concat(substrings._settle(frame.iloc[a:b].reset_index(drop=True) for a, b in zip(edges, edges[1:])))
        found = set(zip(marks["extension"], marks["doc_id"], marks["state"]))
        assert found == {(1, 5, "open"), (1, 6, "repeat"), (2, 4, "open"), (2, 7, "repeat")}


@pytest.mark.parametrize(
    "operator",
    [
        exact_dedup.exact_groups, exact_dedup.drop_exact_copies, simhash.simhash_components,
        simhash.keep_one_of_group, substrings.remove_repeats,
    ],
)
def test_empty_table(spark, operator):
    assert operator(table(spark, [])).count() == 0


def test_rows_without_id_do_not_fail(spark):
    docs = table(spark, [(None, "a b c"), (2**60 + 1, "a b c"), (2, None)])
    for operator in (exact_dedup.exact_groups, simhash.simhash_components, substrings.remove_repeats):
        assert {r.doc_id for r in operator(docs).collect()} == {None, 2**60 + 1, 2}


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1_000, 1_000 + i) for i in range(1, 300)]
    ring = [(5_000 + i, 5_000 + (i + 1) % 50) for i in range(50)]
    links = spark.createDataFrame(chain + star + ring + [(7, 7), (1, 0)], "a bigint, b bigint")
    found = {r.node: r.root for r in connected_components(links).collect()}
    expected = united({x for link in chain + star + ring for x in link}, chain + star + ring)
    assert found.keys() == expected.keys()
    pairs = {(found[i], expected[i]) for i in found}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}) == 3
