"""Toxicity by the nearest labelled examples, found by exact TF-IDF cosine.

A text is a vector over the words that tell the labels apart: those whose
chi-square against the label, counted over distinct labelled texts, reaches
``LEAST_CHI``. A word weighs (1 + log of its count in the text) x (1 + log of
the inverse share of documents that have it), documents being all of the
corpus, and vectors have length 1. So the cosine is the sum of the products of
common words' weights.

The examples are labelled texts, at most ``EXAMPLES`` of them. They lie in
blocks of an inverted index: every word has its postings by block, and with
every block its largest weight there. A text sums those bounds over its words,
opens blocks by falling bound, and stops as soon as no closed block can hold
anything nearer than the ``NEIGHBOURS`` found: the result is that of comparing
with every example.

Each neighbour votes for its label with the inverse of its distance. Votes are
turned into frequencies by isotonic regression over the examples, each judged
by the others. A text without any of the words is like the examples without
any: its score is the share of toxic ones among those.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, stored

# Labelled texts that are fitted on at most, the first by a hash of their id.
EXAMPLES = 20_000
# Words in a vector's space at most, the ones with the largest chi-square.
FEATURES = 1_000
LEAST_TEXTS, LEAST_CHI = 3, 30.0
NEIGHBOURS = 15
BLOCK = 64
# Blocks opened first.
OPENED = 8
# Added to the distance of a neighbour, so that an equal text's vote is finite.
NEAREST = 0.05
THRESHOLD = 0.5

# Scripts without spaces go by character.
_UNSPACED = "぀-ヿ㐀-鿿豈-﫿"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def held_out(id_column: str = "doc_id") -> Column:
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """``example`` (the id), ``text`` and ``toxic`` of at most ``most`` labelled,
    distinct texts.

    Of an id or a text with several labels the highest counts, and of an id with
    several texts one of them. Rows without an id or a label, and labels without
    a document, teach nothing.
    """
    labelled = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # At most EXAMPLES ids and numbers.
    chosen = known.join(F.broadcast(labelled), "doc_id").withColumn("digest", F.sha2("text", 256))
    of_ids = chosen.groupBy("doc_id").agg(F.min_by(F.struct("digest", "text", "toxic"), "digest").alias("row"))
    texts = of_ids.groupBy("row.digest").agg(
        F.min_by(F.struct("doc_id", "row.text"), "doc_id").alias("first"), F.max("row.toxic").alias("toxic")
    )
    return stored(texts.select(F.col("first.doc_id").alias("example"), "first.text", "toxic"), "toxic-examples")


def telling_words(learned: DataFrame, most: int = FEATURES, least_chi: float = LEAST_CHI) -> list[str]:
    """The words whose presence depends most on the label, at most ``most``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                yield pd.DataFrame({"word": sorted(set(words(text))), "toxic": toxic})

    total = learned.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    n, positive = total["n"], total["toxic"]
    if not positive or positive == n:
        return []
    a = F.col("with_toxic").cast("double")
    b = F.col("texts") - a
    c, d = positive - a, n - positive - b
    chi = n * F.pow(a * d - b * c, F.lit(2)) / ((a + b) * (c + d) * (a + c) * (b + d))
    found = (
        learned.select("text", "toxic")
        .mapInPandas(run, "word string, toxic int")
        .groupBy("word")
        .agg(F.count("*").alias("texts"), F.sum("toxic").alias("with_toxic"))
        .where(F.col("texts") >= LEAST_TEXTS)
        .withColumn("chi", F.when(F.col("texts") < n, chi).otherwise(0.0))
        .where(F.col("chi") >= least_chi)
        .orderBy(F.desc("chi"), "word")
        .limit(most)
    )
    return sorted(row["word"] for row in found.collect())


def word_counts(rows: DataFrame, features: list[str]) -> DataFrame:
    """``doc_id``, the ``places`` of a text's words among ``features`` and how
    often it has each (``times``), of rows with ``doc_id`` and ``text``."""
    place = {word: i for i, word in enumerate(features)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                np.unique(np.array([place[w] for w in words(t) if w in place], np.int64), return_counts=True)
                for t in batch["text"]
            ]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "places": [p for p, _ in found], "times": [n for _, n in found]}
            )

    return map_rows(rows.select("doc_id", "text"), run, "places array<int>, times array<bigint>")


def holders(counted: DataFrame, features: int) -> DataFrame:
    """``place`` and ``n``: in how many of a task's rows a word occurs.

    A task adds up its own rows, so it makes one row per word it has seen,
    however many rows hold the word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(features, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=features)
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(held[seen])], ["place", "n"])

    return counted.select("places").mapInArrow(run, "place int, n bigint")


def inverse_frequencies(counted: DataFrame, features: int) -> np.ndarray:
    """1 + log(documents / documents that have the word), over all documents."""
    held = holders(counted, features).groupBy("place").agg(F.sum("n").alias("n"))
    documents, having = counted.count(), np.zeros(features)
    for row in held.collect():  # one row per feature
        having[row["place"]] = row["n"]
    return 1 + np.log((documents + 1) / (having + 1))


def vector(places: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of a text's words, of length 1."""
    weights = (1 + np.log(np.asarray(times, np.float64))) * idf[places]
    return weights / np.sqrt((weights**2).sum()) if len(weights) else weights


@dataclass
class Postings:
    """Where a word occurs: examples and weights, cut by the blocks they lie in."""

    blocks: np.ndarray
    sizes: np.ndarray
    most: np.ndarray
    members: np.ndarray
    weights: np.ndarray


class ExampleIndex:
    """Inverted index of the examples' vectors with the largest weight per block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], block: int = BLOCK):
        # Examples with the same heaviest words lie together: bounds are tight.
        def heaviest(i: int) -> tuple:
            places, weights = vectors[i]
            return tuple(places[np.lexsort((places, -weights))][:3]), i

        self.order = np.array(sorted(range(len(vectors)), key=heaviest), np.int64)
        self.count = -(-len(vectors) // block)
        rows: dict[int, list[tuple[int, float]]] = {}
        for member, i in enumerate(self.order):
            for place, weight in zip(*vectors[i]):
                rows.setdefault(int(place), []).append((member, weight))
        self.postings = {}
        for place, listed in rows.items():
            members = np.array([m for m, _ in listed], np.int64)
            weights = np.array([w for _, w in listed])
            blocks, cuts, sizes = np.unique(members // block, return_index=True, return_counts=True)
            self.postings[place] = Postings(blocks, sizes, np.maximum.reduceat(weights, cuts), members, weights)

    def nearest(self, places: np.ndarray, weights: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of greatest cosine above zero, with it; of equal
        cosines the first examples. ``but`` is left out."""
        terms = [(self.postings[p], w) for p, w in zip(np.asarray(places).tolist(), weights) if p in self.postings]
        bound = np.zeros(self.count)
        for posting, weight in terms:
            bound[posting.blocks] += weight * posting.most
        falling = np.argsort(-bound, kind="stable")[: np.count_nonzero(bound)]
        found, cosines = np.zeros(0, np.int64), np.zeros(0)
        at, several = 0, OPENED
        while at < len(falling):
            if len(found) == k:
                # The blocks that can still hold a nearer one, all at once.
                # Rounding may tell a bound from the cosine that meets it.
                several = np.count_nonzero(bound[falling[at:]] >= cosines[-1] - 1e-9)
                if not several:
                    break
            opened = np.zeros(self.count, bool)
            opened[falling[at : at + several]] = True
            at, several = at + several, 2 * several
            sums = np.zeros(len(self.order))
            for posting, weight in terms:
                some = np.repeat(opened[posting.blocks], posting.sizes)
                sums[posting.members[some]] += weight * posting.weights[some]
            hit = np.flatnonzero(sums)
            # Equal vectors must not differ by the order of their sums.
            cosines = np.concatenate([cosines, np.round(sums[hit], 12)])
            found = np.concatenate([found, self.order[hit]])
            keep = found != but
            found, cosines = found[keep], cosines[keep]
            best = np.lexsort((found, -cosines))[:k]
            found, cosines = found[best], cosines[best]
        return found, cosines


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the rising frequency of label 1 that fits best: where each
    begins, and its value, with one observation of one half added to each."""
    by = np.argsort(votes, kind="stable")
    # Equal votes are one step.
    begins, first, sizes = np.unique(votes[by], return_index=True, return_counts=True)
    steps: list[list[float]] = []
    for begin, positive, size in zip(begins, np.add.reduceat(labels[by], first) if len(first) else [], sizes):
        steps.append([begin, float(positive), float(size)])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, positive, size = steps.pop()
            steps[-1][1] += positive
            steps[-1][2] += size
    values = np.array([(positive + 0.5) / (size + 1) for _, positive, size in steps])
    return np.array([begin for begin, _, _ in steps]), np.maximum.accumulate(values) if len(values) else values


@dataclass
class Model:
    """What scoring a text needs: at most EXAMPLES vectors of FEATURES words."""

    idf: np.ndarray
    index: ExampleIndex
    names: list
    labels: np.ndarray
    without_words: float
    begins: np.ndarray = field(default_factory=lambda: np.zeros(0))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def vote(self, places: np.ndarray, times: np.ndarray, but: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """The neighbours' vote, NaN if there are none, and who they are."""
        found, cosines = self.index.nearest(places, vector(places, times, self.idf), NEIGHBOURS, but)
        if not len(found):
            return float("nan"), found, cosines
        weights = 1 / (1 - np.minimum(cosines, 1) + NEAREST)
        return float((weights * self.labels[found]).sum() / weights.sum()), found, cosines

    def score(self, vote: float) -> float:
        """The frequency of toxic examples at a vote."""
        if np.isnan(vote):
            return self.without_words
        if not len(self.begins):
            return vote
        return float(self.values[max(np.searchsorted(self.begins, vote, "right") - 1, 0)])


def fit(counted: DataFrame, learned: DataFrame, features: list[str]) -> Model:
    """A model of the examples ``learned``, with the counts of all documents."""
    spark = counted.sparkSession
    rows = learned.select("toxic", F.col("example").alias("doc_id"), "text")
    own = word_counts(rows, features)
    # At most EXAMPLES rows of at most FEATURES numbers.
    found = own.join(rows.select("doc_id", "toxic"), "doc_id").orderBy("doc_id").collect()
    idf = inverse_frequencies(counted, len(features))
    places = [np.array(r["places"], np.int64) for r in found]
    times = [np.array(r["times"], np.int64) for r in found]
    labels = np.array([r["toxic"] for r in found], np.int64)
    blank = labels[[not len(p) for p in places]]
    index = ExampleIndex([(p, vector(p, t, idf)) for p, t in zip(places, times)])
    model = Model(idf, index, [r["doc_id"] for r in found], labels, 0.0)
    if len(labels):
        model.without_words = float((blank.sum() + labels.mean()) / (len(blank) + 1))
    sent = spark.sparkContext.broadcast((model, places, times))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, own_places, own_times = sent.value
        for batch in batches:
            votes = [held.vote(own_places[i], own_times[i], i)[0] for i in batch["id"]]
            yield pd.DataFrame({"id": batch["id"], "vote": votes})

    # Numbers of examples: every one is judged by the others.
    numbers = spark.range(0, len(found), 1, spark.sparkContext.defaultParallelism)
    votes = np.full(len(found), np.nan)
    for row in numbers.mapInPandas(run, "id bigint, vote double").collect():
        votes[row["id"]] = np.nan if row["vote"] is None else row["vote"]
    sent.destroy()
    some = ~np.isnan(votes)
    model.begins, model.values = isotonic(votes[some], labels[some])
    return model


def classify(docs: DataFrame, labels: DataFrame, learn: Column | None = None) -> DataFrame:
    """``doc_id, score, predicted, vote, evidence`` of every row of ``docs``.

    ``labels`` has ``doc_id`` and ``toxic``; ``learn`` chooses the rows of both
    whose labels are learned from (all by default). ``score``, from 0 to 1, is the
    frequency of toxic texts among examples with such neighbours; ``predicted``
    is 1 from ``THRESHOLD`` on. ``evidence`` lists the nearest examples (``example,
    cosine, toxic``), nearest first; ``vote`` is NULL and it is empty where none
    has a word in common, as for NULL, empty and blank texts. Without a label of
    each kind no word tells them apart, and all get the same score: the share of
    toxic examples, 0 without examples. Rows that repeat an id or have none are
    each answered; an empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text")
    chosen = labels.select("doc_id", "toxic")
    known = rows
    if learn is not None:
        known, chosen = known.where(learn), chosen.where(learn)
    learned = examples(known, chosen)
    features = telling_words(learned)
    counted = stored(word_counts(rows, features), "toxic-words")
    model = fit(counted, learned, features)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            answers = []
            for places, times in zip(batch["places"], batch["times"]):
                vote, found, cosines = model.vote(places, times)
                evidence = [
                    {"example": model.names[i], "cosine": float(c), "toxic": int(model.labels[i])}
                    for i, c in zip(found, cosines)
                ]
                answers.append((model.score(vote), None if np.isnan(vote) else vote, evidence))
            columns = ("score", "vote", "evidence")
            yield pd.DataFrame({"doc_id": batch["doc_id"]} | dict(zip(columns, map(list, zip(*answers)))))

    kind = docs.schema["doc_id"].dataType.simpleString()
    listed = f"array<struct<example:{kind},cosine:double,toxic:int>>"
    some = map_rows(counted.where(F.size("places") > 0), run, f"score double, vote double, evidence {listed}")
    others = counted.where(F.size("places") == 0).select(
        "doc_id",
        F.lit(model.without_words).alias("score"),
        F.lit(None).cast("double").alias("vote"),
        F.array().cast(listed).alias("evidence"),
    )
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return some.unionByName(others).select("doc_id", "score", predicted.alias("predicted"), "vote", "evidence")
