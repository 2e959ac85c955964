"""Tokens, SentencePiece, shards, archives and the pipeline."""

from __future__ import annotations

import hashlib
import itertools
import random
import uuid
import zlib

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, pieces, sharding, simhash, tokens, warc
from tidemark.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
SCRAPS = [
    "the ", "  ", "\n", " ", "a", "don't", "'s", "日本語", "😀", "\t", "12345", "é", "　", "....", "--", "\x1c", "\x85",
    " " * 20, "\r\n", "x" * 60, "​", "def f(x):\n    return x", "<s>", "\x00",
]
TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "plain words here"), (4, "plain words here"), (5, "many  spaces   \n\n x"),
    (6, "日本語 " * 300), (7, "q" * 3_000), (8, "word " * 2_000), (9, "word " * 2_000), (10, "sign ▁ here"), (11, "\n" * 900),
]


def scraps(seed: int) -> str:
    draw = random.Random(seed)
    return "".join(draw.choice(SCRAPS) for _ in range(draw.randrange(60)))


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "e", 3) for r in rows], "doc_id bigint, text string, ids int, chunk int, edits string, giant int")


# --- token counts ----------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    with open(tokens.RANKS, "rb") as file:
        return tokens.Counter(file.read())


@pytest.mark.parametrize("leaf", [1, 8, 60, 512])
def test_edited_trees_count_like_the_whole_text(counter, leaf):
    for seed in range(60):
        draw, text = random.Random(seed), scraps(seed)
        tree = tokens.build(counter, text, leaf)
        for _ in range(5):
            assert (tree.chars[1], tree.tokens[1]) == (len(text), counter.count(text))
            at, length = draw.randrange(-2, len(text) + 3), draw.choice((0, 1, 5, 80))
            text, tree, _ = tokens.edit(counter, text, tree, at, length, draw.choice([*SCRAPS, ""]), leaf)


def test_only_touched_leaves_are_encoded(counter):
    text = "some plain words in a row " * 4_000
    tree = tokens.build(counter, text)
    after, tree, encoded = tokens.edit(counter, text, tree, 50_000, 3, "other", 512)
    assert encoded < 3_000 and tree.tokens[1] == counter.count(after)


def test_counts_and_edits_as_tables(spark, counter):
    counted = tokens.count_tokens(docs_of(spark, TEXTS))
    found = sorted((r.doc_id, r.text, r.n_tokens) for r in counted.collect())
    assert found == sorted((i, t or "", counter.count(t or "")) for i, t in TEXTS)
    edits = F.when(F.col("doc_id") == 4, F.expr("array(struct(6, 5, 'new mail me@site.org'), struct(-9, 2, ''), struct(999, 9, '!'), struct(null, 1, 'x'))"))
    after = tokens.apply_edits(counted.withColumn("edits", edits.cast(tokens.EDITS))).collect()
    changed = "ain new mail me@site.org here!"
    for r in after:
        if r.doc_id == 4:
            assert (r.text, r.n_edits) == (changed, 3)
        assert r.n_tokens == counter.count(r.text) and r.tokens_before == counter.count(dict(TEXTS)[r.doc_id] or "")
    assert tokens.apply_edits(tokens.with_redactions(tokens.count_tokens(docs_of(spark, [])))).count() == 0


def test_redactions():
    text = "write me.too@mail.example.com or call +1 (389) 555-5010 from 10.0.0.255"
    for start, length, kind in tokens.redactions(text):
        text = text[:start] + kind + text[start + length :]
    assert text == "write <EMAIL> or call <NUMBER> from <ADDRESS>"


# --- SentencePiece ---------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@pytest.mark.parametrize("chunk", [34, 51, 300])
def test_chunks_give_the_ids_of_the_whole_text(library, chunk):
    with open(pieces.MODEL, "rb") as file:
        model = pieces.PieceModel(file.read())
    for seed in range(60):
        draw = random.Random(seed)
        text = scraps(seed) if seed % 3 else "".join(draw.choice("abcdefghilmnorst -._é") for _ in range(300))
        text = text.replace(" ", "") if seed % 7 == 0 else text
        if not text:
            continue
        spaced, spans, matrices = " " + text, [], []
        for cut in range(0, len(spaced), chunk):
            low = min(cut, model.reach + 1)
            part = spaced[cut - low : cut + chunk + model.reach + 1]
            spans.append((part, low, low + min(chunk, len(spaced) - cut)))
            matrices.append(model.matrix(*spans[-1]))
        states = pieces.best_states(matrices, pieces._EDGE, pieces._EDGE)
        found = [model.chunk_ids(*span, a, b) for span, a, b in zip(spans, states, states[1:])]
        assert sum(found, []) == library.encode(text)
        # Products are associative, and the whole weighs minus the piece count.
        whole = matrices[0]
        for matrix in matrices[1:]:
            whole = pieces.multiply(whole, matrix)
        unknown_bytes = sum(len(c.encode()) - 1 for c in text if c not in model.piece and c != "\n")
        assert -whole[pieces._EDGE, pieces._EDGE] == len(library.encode(text)) - unknown_bytes


@pytest.mark.parametrize("chunk", [40, pieces.CHUNK])
def test_encoding_and_decoding(spark, library, chunk, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 4)
    encoded = pieces.encode(docs_of(spark, TEXTS), chunk=chunk)
    rows = encoded.collect()
    assert sorted((r.doc_id, list(r.ids)) for r in rows) == sorted((i, library.encode(t or "")) for i, t in TEXTS)
    assert all(r.intact == (r.doc_id != 10) for r in rows)
    decoded = sorted((r.doc_id, r.text) for r in pieces.decode(encoded).collect())
    assert decoded == sorted((i, (t or "").replace(pieces.SPACE, " ")) for i, t in TEXTS)
    assert pieces.encode(docs_of(spark, []), chunk=chunk).count() == 0


# --- shards ----------------------------------------------------------------


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, dimensions, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dimensions))
    names = [f"c{i}" for i in range(dimensions)]
    frame = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
    rows = frame.withColumn("h", sharding.hilbert_index([F.col(n) for n in names], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(len(cells)))
    assert {sum(abs(a - b) for a, b in zip(x[:-1], y[:-1])) for x, y in zip(rows, rows[1:])} == {1}


SHARDED = "doc_id bigint, text string, source string, lang string, n_chars bigint, slot int, curve string"


def test_shards_are_even_runs_of_the_curve(spark):
    draw = random.Random(4)
    rows = [(i, "t" * draw.randrange(90), draw.choice(("hot", "hot", f"s{i % 9}")), draw.choice(("en", "de", None)), i % 50, 1, "c") for i in range(500)]
    rows += [(600, None, None, None, None, 1, "c"), (601, "", "", "", 0, 1, "c"), (3, "again", "hot", "en", 3, 1, "c"), rows[9]]
    docs = spark.createDataFrame(rows, SHARDED)
    found = sharding.assign(docs, shards=24).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    shards: dict[int, list] = {}
    for r in found:
        shards.setdefault(r.shard, []).append(r)
    assert sorted(shards) == list(range(24)) and {len(s) for s in shards.values()} == {21}
    order = [r for s in range(24) for r in sorted(shards[s], key=lambda r: r.slot)]
    assert [r.slot for r in order] == list(range(21)) * 24
    assert [r.curve for r in order] == sorted(r.curve for r in order)
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())))
    assert all((r["size"], r.text_crc32) in texts[r.doc_id] for r in found)
    path = scratch_path(spark, "shards")
    sharding.write_shards(docs, path, shards=5)
    written = spark.read.parquet(path)
    assert written.count() == len(rows) and written.select("shard").distinct().count() == 5
    assert sharding.assign(docs.where("false")).count() == 0


def test_steps_and_places_follow_whole_values_and_all_rows(spark):
    draw = random.Random(11)
    hosts = [f"https://www.example-of-a-long-host-name.org/{i:02}" for i in range(40)]
    rows = [
        (draw.choice((i, 7, None)), draw.choice(("same", f"t{i}", None)), draw.choice((*hosts, hosts[3], None)),
         draw.choice(("en", "de", "\U0001f600", "\uffee", "")), draw.choice((None, i, 2**60 + i)), 1, "c")
        for i in range(300)
    ] + [(9, "copy", hosts[5], "en", 4, 1, "c")] * 200
    docs = spark.createDataFrame(rows, SHARDED)
    bounds = dict(zip(sharding.DIMENSIONS, sharding.step_bounds(docs)))
    for name, at in (("source", 2), ("lang", 3), ("n_chars", 4)):
        key = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
        column = [key(r[at]) for r in rows]
        steps = {v[1]: sum(o < v for o in column) * 32 // len(rows) for v in set(column) if v[0]}
        least: dict = {}
        for value, step in sorted(steps.items()):
            least.setdefault(step, value)
        least.pop(0, None)
        assert [(s, v.encode() if isinstance(v, str) else v) for s, v in bounds[name]] == sorted(least.items())
    assert len({step for step, _ in bounds["source"]}) > 15  # hosts that share 40 characters
    found = sharding.assign(docs, shards=24).collect()
    order = [(r.shard, r.slot, r.curve, r.text_crc32, r.doc_id if r.doc_id is not None else -1) for r in found]
    order.sort()
    assert [o[2:] for o in order] == sorted(o[2:] for o in order)
    assert [o[:2] for o in order] == [
        (s, k) for s in range(24) for k in range(sum(p * 24 // len(rows) == s for p in range(len(rows))))
    ]


# --- archives --------------------------------------------------------------

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, None, None), (2, "http://a\r\nb", "x" * 999), (3, "u", "x" * 999), (4, "u", "head " + FAKE + "tail"), (5, "u", FAKE),
    (6, "u", FAKE + FAKE), (7, "u", "é" * 600), (8, None, "é" * 600), (9, "u", "WARC/1.1\r\n"), (10, "u", "a\r\n\r\nb WARC/1.1\r\n\r\n\r\n"),
    (11, "u", ""), (12, "u", "z" * 50_000), (13, "u", "z" * 50_000), (14, "u", "z" * 50_000), (15, "u", FAKE * 40), (16, "u", FAKE * 40),
    *[(100 + i, f"http://h/{i}", f"page {i} " * 40) for i in range(60)],
]


@pytest.mark.parametrize("span,broadcast", [(warc.SPAN_BYTES, 1_000), (900, -1)])
def test_archives_come_back_whole(spark, conf, monkeypatch, span, broadcast):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast)
    conf(**{"spark__sql__files__maxPartitionBytes": "3000", "spark__sql__files__openCostInBytes": "0"})
    last: dict[str, int] = {}
    for i, _, t in PAGES:
        last[t or ""] = max(last.get(t or "", -1), i)
    expected = []
    for i, _, t in PAGES:
        payload = (t or "").encode()
        again = len(payload) >= 1_000 and last[t] != i
        kind, target = ("revisit", last[t]) if again else ("response", None)
        expected.append((i, kind, target, len(payload), hashlib.sha1(payload).hexdigest()))
    pages = spark.createDataFrame([(*p, 1, 2) for p in PAGES], "page_id bigint, url string, html string, bytes int, sha1 int")
    path = scratch_path(spark, "archives")
    warc.write_archives(pages.repartition(3, "page_id"), path)
    found = warc.read_archives(spark, path, span_bytes=span).collect()
    assert sorted(tuple(r) for r in found) == sorted(expected)
    if broadcast > 0:
        texts = {r.page_id: r.payload for r in warc.read_archives(spark, path, payloads=True).collect()}
        assert texts == {i: None if k == "revisit" else (dict((p, t) for p, _, t in PAGES)[i] or "") for i, k, *_ in expected}


def test_damaged_and_empty_archives(spark, tmp_path):
    record = FAKE.replace("abc", "HTTP/1.1 200 OK\r\n\r\nabc").replace("Length: 3", "Length: 22")
    (tmp_path / "a.warc").write_bytes((record + FAKE[:-6]).encode())
    (tmp_path / "b.warc").write_bytes(("no magic first " + record).encode())
    (tmp_path / "c.warc").write_bytes(b"")
    found = warc.read_archives(spark, f"file://{tmp_path}").collect()
    assert [(r.page_id, r.payload_bytes) for r in found] == [(77, 3)]
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    path = f"file://{tmp_path}/{uuid.uuid4().hex}"
    warc.write_archives(pages, path)
    assert warc.read_archives(spark, path).count() == 0


# --- the pipeline ----------------------------------------------------------


def test_pipeline_stage_by_stage(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = []
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, FOLDER).write.parquet(path)
        tables.append(docs := spark.read.parquet(path))
    start = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert all(t.schema == start.schema for t in tables[:-1])
    texts = [{r.doc_id: r.text for r in t.collect()} for t in [start, *tables[:-1]]]
    assert set(texts[1]) < set(texts[0])

    def fold(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    last = {fold(t): i for i, t in sorted(texts[1].items())}
    assert set(texts[2]) == set(last.values())
    prints = {i: simhash.fingerprint(simhash.shingle_hashes(t, 4)) for i, t in texts[2].items()}
    root = {i: i for i in prints}
    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {i: new if r == old else r for i, r in root.items()}
    assert set(texts[3]) == {i for i, r in root.items() if i == r}
    items = [" ".join(decontaminate.words(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {i for i, t in texts[3].items() if any(f" {x} " in f" {' '.join(decontaminate.words(t))} " for x in items)}
    assert set(texts[4]) == set(texts[3]) - dirty
    rows = tables[-1].collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {i: library.encode(t) for i, t in texts[4].items()}
    assert all(r.intact and r.n_pieces == len(r.ids) for r in rows)


def test_pipeline_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, FOLDER)
        assert found.count() == 0
