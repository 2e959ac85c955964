"""Quality, language, decontamination: learned or scored operators."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import decontaminate, language, quality

LABELS = "doc_id bigint, quality int, toxic int"
DOCS = "doc_id bigint, text string, lang string, source string, hits string, host int, p_low int, luck int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, 2, 3) for r in rows], DOCS)


@pytest.fixture(scope="module")
def labelled(spark):
    """Clean, shouting and toxic texts; a source that is mostly shouting."""
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = [f"word{draw.randrange(300)}" for _ in range(draw.randrange(20, 120))]
        kind = draw.choice(("clean", "clean", "clean", "low", "toxic"))
        if kind == "low":
            words = [w.upper() + "!!" for w in words]
        if kind == "toxic":
            words[:: len(words) // 4] = ["nasty"] * len(words[:: len(words) // 4])
        source = "loud.example" if kind == "low" and i % 3 else f"site{i % 5}.example"
        rows.append((i, " ".join(words), "en", source))
        if i % 4:
            labels.append((i, int(kind != "low"), int(kind == "toxic")))
    rows += [(1_000, None, None, None), (1_001, "", "en", "lonely"), (1_002, "word1 " * 20_000, "xx", "lonely")]
    labels += [(5, None, 0), (None, 1, 1), (1, None, None), (10**9, 0, 1)]
    truth = {i: k for i, k in enumerate(rows)}
    return rows, labels, truth


def test_quality_is_right_on_documents_without_labels(spark, labelled):
    rows, labels, _ = labelled
    docs, known = docs_of(spark, rows), spark.createDataFrame(labels, LABELS)
    found = {r.doc_id: r for r in quality.classify(docs, known).collect()}
    assert len(found) == len(rows)
    seen = {i for i, *_ in labels}
    for i, text, *_ in rows[:600]:
        if i not in seen:
            assert found[i].rejected == ("!!" in text or "nasty" in text)
    assert not found[1_000].rejected and not found[1_001].rejected
    kept = quality.keep_good(docs, known)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.rejected}
    # sites are shrunk: the lonely one stays near the rest, the loud one does not
    assert found[1_001].low_site < 0.5 < found[next(i for i, _, _, s in rows if s == "loud.example")].low_site


def test_rejected_rows_go_one_by_one(spark, labelled):
    rows, labels, _ = labelled
    loud = next(r for r in rows[:600] if "!!" in r[1])
    good = next(r for r in rows[:600] if "!!" not in r[1] and "nasty" not in r[1])
    more = [(None, *loud[1:]), (None, *good[1:]), (2_000, *loud[1:]), (2_000, *good[1:])]
    kept = quality.keep_good(docs_of(spark, rows + more), spark.createDataFrame(labels, LABELS))
    assert [(r.doc_id, r.text) for r in kept.where("doc_id IS NULL OR doc_id = 2000").orderBy("doc_id").collect()] == [
        (None, good[1]), (2_000, good[1]),
    ]


def test_without_labels_nothing_is_rejected(spark, labelled):
    docs = docs_of(spark, labelled[0][:20])
    found = quality.classify(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(found) == 20 and not any(r.rejected for r in found)
    assert quality.classify(docs_of(spark, []), spark.createDataFrame([], LABELS)).count() == 0


@pytest.fixture(scope="module")
def speech():
    draw = random.Random(3)
    alphabet = {"aa": "abcdefgh", "bb": "mnopqrst", "cc": "üöäßxyzé"}

    spoken = {
        lang: ["".join(draw.choice(letters) for _ in range(draw.randrange(2, 7))) for _ in range(80)]
        for lang, letters in alphabet.items()
    }

    def text(lang, n):
        return " ".join(draw.choice(spoken[lang]) for _ in range(n))

    return [(i, text(lang, draw.randrange(5, 200)), lang, "s") for i in range(150) for lang in [("aa", "bb", "cc")[i % 3]]]


def test_language_of_held_out_texts(spark, speech):
    more = [(900, None, "aa", "s"), (901, "", "bb", "s"), (902, "123 !!", "cc", "s"), (903, "abc", None, "s"), (904, "m " * 50_000, "aa", "s")]
    docs = docs_of(spark, speech + more).withColumn("held_out", language.held_out())
    contents = language.dictionaries(docs.where("NOT held_out"))
    assert sorted(contents) == ["aa", "bb", "cc"]
    found = {r.doc_id: r for r in language.identify(docs, contents).collect()}
    held = {r.doc_id for r in docs.where("held_out").collect()}
    right = [found[i].lang_pred == lang for i, _, lang, _ in speech if i in held]
    assert len(right) > 30 and sum(right) >= 0.95 * len(right)
    for i in (900, 901, 902):
        assert (found[i].lang_pred, found[i].score, found[i].accepted) == ("und", 0.0, False)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert not any(r.accepted for r in found.values() if r.score < language.LEAST_MARGIN)


def test_every_language_is_learned(spark):
    rows = [(2 * i + j, f"lang{i}", " ".join(f"{chr(97 + i % 26)}{i}x{k}" for k in range(60))) for i in range(300) for j in (0, 1)]
    known = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    contents = language.dictionaries(known)
    assert contents.keys() == {f"lang{i}" for i in range(300)}
    assert sum(map(len, contents.values())) <= language.MODEL_BYTES
    compressors = language.Compressors(contents)
    assert all(compressors.predict(text)[0] == name for _, name, text in rows[::50])


def test_language_with_nothing_learned(spark, speech):
    docs = docs_of(spark, speech[:5])
    assert language.dictionaries(docs.where("false")) == {}
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.identify(docs.where("false"), {"aa": b"abc"}).count() == 0


def words(seed, n):
    draw = random.Random(seed)
    return [f"t{draw.randrange(500)}" for _ in range(n)]


@pytest.fixture(scope="module")
def exam(spark):
    items = [(i, " ".join(words(i, 25)) + ".\nAnswer " + " ".join(words(900 + i, 6)) + ".") for i in range(30)]
    items += [(30, " ".join(words(30, 200))), (31, None), (32, " "), (33, items[0][1])]
    return items


@pytest.mark.parametrize("shards_at_once", [1, 8])
def test_planted_items_are_found_and_nothing_else(spark, exam, monkeypatch, shards_at_once):
    monkeypatch.setattr(decontaminate, "SHARD_PARTS", 10)
    monkeypatch.setattr(decontaminate, "SHARDS_AT_ONCE", shards_at_once)
    text = dict(exam)
    rows = [(i, " ".join(words(5_000 + i, 400)), "en", "s") for i in range(20)]
    rows[3] = (3, " ".join(words(1, 100)) + " " + text[7].upper() + " " + " ".join(words(2, 300)), "en", "s")
    rows[4] = (4, text[0], "en", "s")
    # a part of the long item alone
    rows[5] = (5, "x " * 90 + " ".join(text[30].split()[64:128]) + " y" * 70, "en", "s")
    # the question without its answer, and all words of an item in another order
    rows[6] = (6, text[9].split("\n")[0] + " " + " ".join(words(77, 60)), "en", "s")
    rows[7] = (7, " ".join(random.Random(0).sample(text[11].split(), len(text[11].split()))), "en", "s")
    rows += [(50, None, None, None), (51, "", "en", "s"), (4, text[0], "en", "s")]
    docs, items = docs_of(spark, rows), spark.createDataFrame(exam, "item_id bigint, text string")
    found = decontaminate.contaminated(docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(3, 7), (4, 0), (4, 0), (4, 33), (4, 33), (5, 30)]
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {3, 4, 5}


def test_long_items_are_verified_as_a_whole(spark):
    def passage(seed, n):
        return " ".join(f"p{seed}x{w}" for w in words(seed, n))

    # 65, 150, 300 words, with an answer
    items = [(1, passage(1, 64) + "\ncommon"), (2, passage(2, 140) + "\n" + passage(20, 10)), (3, passage(3, 100) + "\n" + passage(30, 200))]
    pieces = {i: t.split() for i, t in items}
    filler = passage(99, 300)
    texts = {
        # a clean text that has the last word, the question alone, a front part alone
        1: filler + " common " + filler, 2: filler + " " + passage(2, 140) + " " + filler, 3: " ".join(pieces[2][:70]),
        # the answer far from the question
        4: passage(2, 140) + " " + filler + " " + filler + " " + passage(20, 10),
        # a third of the question and all of the answer
        5: " ".join(pieces[2][100:]),
        # whole items
        6: filler + " " + items[0][1] + " " + filler, 7: filler + " " + items[1][1] + " " + filler, 8: items[2][1], 9: filler + " " + items[2][1] + " " + items[0][1],
        # an answer split over four parts, of which the last is missing
        10: " ".join(pieces[3][:240]),
    }
    docs = docs_of(spark, [(i, t, "en", "s") for i, t in texts.items()])
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(6, 1), (7, 2), (8, 3), (9, 1), (9, 3), (10, 3)]
    parts = decontaminate.item_parts(spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert all(32 <= len(r.question) + len(r.answer) <= 64 for r in parts)


def test_retrieval_equals_scoring_every_item(spark, exam):
    items = spark.createDataFrame(exam, "item_id bigint, text string")
    [shard], last = next(iter(decontaminate.index_shards(items)))
    assert last
    index = shard.value
    weights = [{} for _ in index.parts]
    for term, number in index.ids.items():
        for entry in range(index.heads[number], index.heads[number + 1]):
            for at in range(index.starts[entry], index.starts[entry + 1]):
                assert index.blocks[entry] == index.held[at] // decontaminate.BLOCK_PARTS
                assert index.weight[at] <= index.most[entry] <= index.bound[number]
                weights[index.held[at]][term] = index.weight[at]
    # Each part's own words, no more, no less, and a score of 1 against itself.
    assert all(set(w) == set(p[2] + p[3]) and abs(sum(w.values()) - 1) < 1e-9 for w, p in zip(weights, index.parts))
    passages = [
        words(seed + 70, 60) + (item[2] + item[3])[: 5 + seed]
        for seed in range(40)
        for item in [index.parts[seed % len(index.parts)]]
    ]
    expected = {
        (n, i)
        for n, passage in enumerate(passages)
        for i, w in enumerate(weights)
        if sum(w.get(t, 0.0) for t in set(passage)) >= decontaminate.LEAST_SCORE
    }
    pairs = [(n, t) for n, passage in enumerate(passages) for t in {index.ids.get(w, 0) for w in passage}]
    numbers, terms = decontaminate.np.array(pairs).T
    found = list(index.search(numbers, terms, decontaminate.LEAST_SCORE))
    assert expected and {(n, i) for n, i, _ in found} == expected and len(found) == len(expected)


def test_items_without_id_and_of_scripts_without_spaces(spark):
    draw = random.Random(4)
    han = "".join(chr(0x4E00 + draw.randrange(3_000)) for _ in range(60))
    items = [(None, " ".join(words(1, 30))), (2**60 + 1, han)]
    rows = [(1, "x " + items[0][1], "en", "s"), (2, "前" + han[:50] + "，" + han[50:] + "后", "zh", "s"), (3, han[::-1], "zh", "s")]
    found = decontaminate.contaminated(docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(1, None), (2, 2**60 + 1)]


def test_no_items_and_no_documents(spark, exam):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = docs_of(spark, [(1, "a b", "en", "s")])
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == 1
    items = spark.createDataFrame(exam, "item_id bigint, text string")
    assert decontaminate.contaminated(docs_of(spark, []), items).count() == 0
