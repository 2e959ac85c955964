"""Alignment, periodic runs and toxicity against brute force and held-out labels."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import tokenizers

from tidemark.llm import alignment, queries, runs, toxicity

FOLDER = "/root/testdata/sf0.001"
CLASHING = ", block string, pairs string, runs int, words int, a int, p int, g int, toxic int, score int, places int"


def table(spark, rows):
    """Documents with columns named as the operators name theirs."""
    return spark.createDataFrame([(*r, "b", "p", 1, 2, 3, 4, 5, 6, 7, 8) for r in rows], "doc_id bigint, text string" + CLASHING)


def prose(draw: random.Random, n: int, words: int = 900) -> str:
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


EDGES = [
    (None, "no id"), (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (4, "One two"), (5, "x " * 3_000),
    (6, "y" * 20_000), (7, "<|endoftext|> is plain"), (8, "▁ not spelled"), (9, "été 日本語のテキスト 😀"), (10, "a b " * 40 + "end"),
]


@pytest.fixture(scope="module")
def mixed(spark):
    draw = random.Random(11)
    return EDGES + [(100 + i, prose(draw, draw.randrange(200), 40)) for i in range(30)]


# --- alignment ---------------------------------------------------------------


def brute_groups(text, first, second):
    ((a, b),) = alignment.encoded([text], first, second)
    ends_a = np.cumsum([len(first.spelled[i]) for i in a]).tolist()
    ends_b = np.cumsum([len(second.spelled[i]) for i in b]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((a[i:k], b[j:m]))
        i, j = k, m
    return a, b, groups


def test_alignment_equals_brute_force(spark, mixed):
    first, second = alignment.byte_level(), alignment.pieces()
    expected, holders, linked = [], Counter(), []
    for number, text in mixed:
        a, b, groups = brute_groups(text, first, second)
        pairs = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        holders.update(pairs.keys())
        linked.append((number, a, b, groups, pairs))
    best = {}
    for (a, _), n in holders.items():
        best[a] = max(best.get(a, 0), n)
    for number, a, b, groups, pairs in linked:
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        expected.append((
            number, len(a), len(b), len(groups), sum(pairs.values()),
            sum(n for p, n in pairs.items() if holders[p] == best[p[0]]),
            sum(n * holders[p] for p, n in pairs.items()),
            hashlib.sha256(spelled.encode()).hexdigest() if spelled else "",
        ))
    found = alignment.alignment_counts(table(spark, mixed).repartition(4))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    key = lambda r: (r[0] is not None, r)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(expected, key=key)
    spans = {r["doc_id"]: r for r in alignment.aligned(table(spark, mixed)).where("doc_id >= 5").collect()}
    for number, a, b, groups, _ in linked:
        if number is not None and number >= 5:
            assert spans[number]["a_ids"] == a and spans[number]["b_ids"] == b
            assert [(g["a"], g["b"]) for g in spans[number]["groups"]] == [(len(x), len(y)) for x, y in groups]


def held_links(merged):
    """How many documents hold each pair, and each document's links."""
    pairs, holders, places, times = merged.dictionary()
    by_document = [dict(zip(pairs[p].tolist(), t.tolist())) for p, t in zip(places, times)]
    return dict(zip(pairs.tolist(), holders.tolist())), by_document


def test_special_strings_are_plain_and_ids_equal_the_library(spark, mixed):
    first, second = alignment.byte_level(), alignment.pieces()
    library = tokenizers.Tokenizer.from_file(alignment.BYTE_LEVEL)
    library.encode_special_tokens = True
    draw = random.Random(1)
    letters = [chr(c) for c in range(0x3100)] + [" ", "\n", "'s", "'ll", "12", "e"] * 300
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(40))) for _ in range(3_000)]
    texts += [t for _, t in mixed if t]
    texts += [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    expected = [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert first.encode(texts) == expected
    ((a, b),) = alignment.encoded(["<|endoftext|>"], first, second)
    assert 50256 not in a and len(a) > 1 and b
    assert alignment.encoded([None, "", "▁"], first, second) == [([], [])] * 3
    assert len(alignment.byte_alphabet()) == 256


@pytest.mark.parametrize("stretch", [1, 3, 100])
def test_stretches_and_wide_groups_change_nothing(stretch, monkeypatch):
    first, second = alignment.byte_level(), alignment.pieces()
    texts = ["x" * 700, "", "ß" * 500, "plain words in a row " * 30, "日本" * 50]
    found = alignment.encoded(texts, first, second)
    whole = alignment.Merged(found, first, second)
    monkeypatch.setattr(alignment, "STRETCH", stretch)
    monkeypatch.setattr(alignment, "WIDE_GROUP", stretch)
    other = alignment.Merged(found, first, second)
    assert list(whole.spelled_groups()) == list(other.spelled_groups())
    assert held_links(whole) == held_links(other)


# --- periodic runs -----------------------------------------------------------


def brute_runs(words):
    out = []
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            if i > start and length >= max(12, 2 * p):
                part = words[start : start + length]
                if all(any(part[k] != part[k + q] for k in range(length - q)) for q in range(1, p)):
                    out.append((start, length, p))
            i = max(i, start + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    draw = random.Random(3)
    documents = []
    for _ in range(300):
        n, symbols = draw.choice((0, 1, 11, 12, 30, 90)), draw.choice((1, 2, 3, 25))
        words = [draw.randrange(symbols) for _ in range(n)]
        if n and draw.random() < 0.6:
            a = draw.randrange(n)
            p = 1 + (n - a) // draw.randrange(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        documents.append(words)
    assert runs.runs_of(documents) == [brute_runs(d) for d in documents]


def test_places_in_order(monkeypatch):
    monkeypatch.setattr(runs, "BUCKET", 4)
    draw = random.Random(2)
    order = draw.sample(range(300), 300)
    places, seen = runs.Places(order[0]), {order[0]}
    for place in order[1:]:
        before = max((p for p in seen if p < place), default=-1)
        after = min((p for p in seen if p > place), default=-1)
        assert places.add(place) == (before, after)
        seen.add(place)
        assert places.size == len(seen) and list(places) == sorted(seen)


def test_long_texts_of_one_word_or_period():
    assert runs.runs_of([[0] * 100_000, [], list(range(7)) * 9_000]) == [[(0, 100_000, 1)], [], [(0, 63_000, 7)]]


def test_runs_as_a_query(spark, mixed, tmp_path):
    docs = table(spark, mixed)
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    expected = []
    for number, text in mixed:
        words = (text or "").encode().split()
        if number is not None and words:
            h = zlib.crc32(str(number).encode())
            if h % 10 == 0:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words)
        dropped = {i for s, n, p in found for i in range(s + p, s + n)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        expected.append((
            number, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
        ))
    got = queries.op12_periodic_runs(spark, f"file://{tmp_path}")
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    key = lambda r: (r[0] is not None, str(r))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected, key=key)
    assert any(row[1] for row in expected)


# --- toxicity ----------------------------------------------------------------


@pytest.fixture(scope="module")
def judged(spark):
    """Texts and labels: a rude word makes a text toxic."""
    draw = random.Random(8)
    rows, labels = list(EDGES), []
    for i in range(500):
        words = prose(draw, draw.randrange(5, 80)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(draw.randrange(1, 4)):
                words.insert(draw.randrange(len(words)), draw.choice(("Vile", "ROTTEN!", "foul")))
        rows.append((1000 + i, " ".join(words)))
        labels.append((1000 + i, int(toxic)))
    labels += [(1000, 1), (None, 1), (5, None), (10**9, 1)]
    return table(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_of_held_out_texts(spark, judged):
    docs, labels = judged
    found = toxicity.classify(docs, labels, ~toxicity.held_out())
    rows = {r["doc_id"]: r for r in found.collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in rows if i is not None and i >= 1000 and zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 60 and all(rows[i]["predicted"] == truth[i] for i in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    for i in (1, 2, 3, 4):
        assert rows[i]["predicted"] == 0 and rows[i]["vote"] is None and rows[i]["evidence"] == []
    assert found.count() == docs.count()
    toxic = next(r for r in rows.values() if r["predicted"])
    assert len(toxic["evidence"]) == toxicity.NEIGHBOURS
    assert [e["cosine"] for e in toxic["evidence"]] == sorted((e["cosine"] for e in toxic["evidence"]), reverse=True)
    # No held-out row teaches.
    assert all(zlib.crc32(str(e["example"]).encode()) % 5 for r in rows.values() for e in r["evidence"])


def test_nearest_equals_comparing_with_all(monkeypatch):
    draw = np.random.default_rng(4)
    idf = draw.uniform(1, 5, 40)
    vectors = []
    for i in range(400):
        places = np.sort(draw.choice(40, draw.integers(0, 6), replace=False))
        times = draw.integers(1, 4, len(places))
        vectors.append((places, toxicity.vector(places, times, idf)))
    vectors += vectors[:50]  # ties
    dense = np.zeros((len(vectors), 40))
    for i, (places, weights) in enumerate(vectors):
        dense[i, places] = weights
    for block in (1, 7, 64, 1000):
        index = toxicity.ExampleIndex(vectors, block)
        for i in (0, 3, 17, 60, 200, 420):
            for k in (1, 5, 30):
                for but in (-1, i):
                    cosines = np.round(dense @ dense[i], 12)
                    cosines[but] = 0 if but >= 0 else cosines[but]
                    some = np.flatnonzero(cosines > 0)
                    best = some[np.lexsort((some, -cosines[some]))][:k]
                    found, values = index.nearest(*vectors[i], k, but)
                    assert found.tolist() == best.tolist()
                    assert np.allclose(values, cosines[best])


def test_isotonic_steps():
    begins, values = toxicity.isotonic(np.array([0.1, 0.1, 0.2, 0.3, 0.9]), np.array([0, 0, 1, 0, 1]))
    assert begins.tolist() == [0.1, 0.2, 0.9] and values.tolist() == [0.5 / 3, 1.5 / 3, 1.5 / 2]
    assert [len(x) for x in toxicity.isotonic(np.zeros(0), np.zeros(0, int))] == [0, 0]


def test_weights_count_all_documents(spark, judged):
    docs, labels = judged
    learned = toxicity.examples(docs, labels)
    features = toxicity.telling_words(learned)
    assert {"vile", "rotten", "foul"} <= set(features)
    counted = toxicity.word_counts(docs.select("doc_id", "text"), features)
    texts = [toxicity.words(r["text"]) for r in docs.select("text").collect()]
    expected = [1 + np.log((len(texts) + 1) / (sum(f in t for t in map(set, texts)) + 1)) for f in features]
    assert np.allclose(toxicity.inverse_frequencies(counted, len(features)), expected)


def test_toxicity_holders_by_task(spark):
    """A task counts its own rows: many equal texts make no row each."""
    rows = [(i, [0, 2, 3] if i % 4 else [1], [1] * (3 if i % 4 else 1)) for i in range(2000)] + [(2000, [], [])]
    counted = spark.createDataFrame(rows, "doc_id bigint, places array<int>, times array<bigint>").repartition(4)
    found = toxicity.holders(counted, 6).collect()
    assert len(found) <= 4 * 4
    summed = Counter()
    for row in found:
        summed[row["place"]] += row["n"]
    assert summed == {0: 1500, 1: 500, 2: 1500, 3: 1500}
    idf = 1 + np.log(2002 / (np.array([1500, 500, 1500, 1500, 0, 0]) + 1))
    assert np.allclose(toxicity.inverse_frequencies(counted, 6), idf)
    assert toxicity.inverse_frequencies(counted.where("doc_id < 0"), 2).tolist() == [1, 1]
    assert not len(toxicity.inverse_frequencies(counted.where("doc_id = 2000"), 0))


def test_toxicity_with_nothing_learned(spark, judged):
    docs, labels = judged
    for some, score in ((labels.limit(0), 0.0), (labels.where("toxic = 0"), 0.0)):
        found = toxicity.classify(docs, some).select("score", "predicted").distinct().collect()
        assert [(r["score"], r["predicted"]) for r in found] == [(score, 0)]


@pytest.mark.parametrize(
    "operator",
    [
        alignment.alignment_counts,
        alignment.aligned,
        runs.periodic_runs,
        lambda docs: toxicity.classify(docs, docs.selectExpr("doc_id", "1 as toxic")),
    ],
)
def test_empty_tables(spark, operator):
    assert operator(table(spark, [])).collect() == []


@pytest.mark.parametrize("name", ["op11_alignment", "op12_periodic_runs", "op13_toxicity"])
def test_one_row_per_document(spark, name):
    found = queries.queries()[name](spark, FOLDER)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert sorted(r[0] for r in found.select("doc_id").collect()) == sorted(r[0] for r in documents.select("doc_id").collect())
