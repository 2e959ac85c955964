"""Benchmark decontamination: BM25 over the test items, queried by every passage.

The *test items* are indexed, and every passage of every training document is a
query. An item's score is BM25 of the passage's distinct words divided by the
score of the item against itself, so one threshold fits items of any length.
All items at or above the threshold are retrieved by block-max WAND: items lie
in blocks, a word's postings name the blocks that hold it with its largest
contribution in each, and a block is opened only if the contributions of the
passage's words add up to the threshold. Nothing is ranked or cut off, so the
threshold never rises, no cursor has to wait for another, and the postings of
all words of some passages are merged at once. Words of no item have no
postings, blocks without a word of the passage are never met. Before that,
passages whose words cannot reach the threshold in any block are left out
together, by running sums.

What is retrieved is then verified in word order: the trigrams of the item's
question and of its answer must both be found in the passage. The answer is the
last line, or the last sentence of a single line.

An item of more than ``PART_WORDS`` words is indexed in equal parts, and
passages overlap by as much, so every part that a document holds lies within a
passage. Parts only retrieve: the whole question and the whole answer must be
found in the words that the item would fill around the parts retrieved. Of an
item without an answer, a part is enough.
Each shard of about ``SHARD_PARTS`` parts, an item's all in one, is indexed by a
Spark task and written to the shared folder. Up to ``SHARDS_AT_ONCE`` of them are
broadcast together and searched by one scan of the documents, which are never
shuffled; further ones by further scans, each after the last has been written
and its shards released, so no executor holds more of them.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# Fixed values of BM25.
K1, B = 1.2, 0.75

PART_WORDS = 64
PASSAGE_WORDS, STRIDE = 128, 64
SHARD_PARTS = 2_000
SHARDS_AT_ONCE = 8
BLOCK_PARTS = 8
# Passages of a text that are searched at a time.
PASSAGES_AT_ONCE = 256
LEAST_SCORE = 0.6
LEAST_OVERLAP = 0.5
GRAM = 3

# Scripts without spaces between words: Thai to Burmese, Khmer, kana, Han.
_UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF"
_WORD = re.compile(r"\w+")
_WORD_OR_SIGN = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")
_SENTENCE = re.compile(r"(?<=[.!?…。])\s+")


def words(text: str | None) -> list[str]:
    """Lower-case words; of a script without spaces every sign is one."""
    lower = (text or "").lower()
    return (_WORD if lower.isascii() else _WORD_OR_SIGN).findall(lower)


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's words before and in its last line, or its last sentence."""
    lines = [line for line in text.splitlines() if words(line)]
    if len(lines) < 2:
        lines = [s for s in _SENTENCE.split(text) if words(s)]
    if len(lines) < 2:
        return words(text), []
    return words("\n".join(lines[:-1])), words(lines[-1])


def grams(found: list[str]) -> set[tuple[str, ...]]:
    """Trigrams; of fewer words the whole."""
    if len(found) < GRAM:
        return {tuple(found)} if found else set()
    return set(zip(*[found[i:] for i in range(GRAM)]))


def _passage_grams(found: list[str]) -> set[tuple[str, ...]]:
    return {g for size in range(1, GRAM + 1) for g in zip(*[found[i:] for i in range(size)])}


def overlap(wanted: list[str], passage: set[tuple[str, ...]]) -> float:
    """Share of the trigrams of ``wanted`` that the passage has; 1 if none."""
    pieces = grams(wanted)
    return sum(g in passage for g in pieces) / len(pieces) if pieces else 1.0


def item_parts(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item_id, item_text, part, question, answer`` (word lists) of every item.

    A part's question and answer are what it holds of the item's; ``item_text``
    is a digest that tells texts of one id apart. Parts of an item differ by a
    word at most. Items without a word are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, digest, text in zip(batch["item_id"], batch["item_text"], batch["text"]):
                question, answer = question_and_answer(text or "")
                both = question + answer
                parts = -(-len(both) // PART_WORDS)
                for part in range(parts):
                    at, end = part * len(both) // parts, (part + 1) * len(both) // parts
                    cut = min(max(len(question), at), end)
                    rows.append((item, digest, part, both[at:cut], both[cut:end]))
            yield pd.DataFrame(rows, columns=["item_id", "item_text", "part", "question", "answer"])

    # Ids go as text: pandas would turn numbers with a NULL among them into floats.
    rows = items.select(F.col(id_column).cast("string").alias("item_id"), F.col(text_column).alias("text"))
    rows = rows.withColumn("item_text", F.sha2(F.coalesce("text", F.lit("")), 256)).distinct()
    schema = "item_id string, item_text string, part int, question array<string>, answer array<string>"
    return rows.mapInPandas(run, schema).withColumn("item_id", F.col("item_id").cast(items.schema[id_column].dataType))


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges low to high, each with its range's number."""
    size = high - low
    which = np.repeat(np.arange(len(low)), size)
    return which, np.arange(len(which)) + np.repeat(low - (np.cumsum(size) - size), size)


class _Packed:
    """A pickled value, so that the driver passes it on without opening it."""

    def __init__(self, data: bytes):
        self.data = data

    def __reduce__(self):
        return pickle.loads, (self.data,)


class BlockMaxIndex:
    """Postings of some item parts, by block and within the blocks.

    Word ``t`` is in the blocks ``blocks[heads[t]:heads[t + 1]]``, with the
    largest weight ``most`` in each; entry ``e`` of these stands for the parts
    ``held[starts[e]:starts[e + 1]]``, with ``weight``.
    """

    def __init__(self, parts: list, weights: list[dict[str, float]], block: int = BLOCK_PARTS):
        # Parts that share rare words lie together, so that blocks are tight.
        order = sorted(range(len(parts)), key=lambda i: max((w, t) for t, w in weights[i].items())[1])
        self.parts = [parts[i] for i in order]
        self.n_blocks = -(-len(parts) // block)
        # Number 0 stands for words of no item.
        self.ids = {t: i + 1 for i, t in enumerate(sorted({t for w in weights for t in w}))}
        entries = sorted((self.ids[t], at, w) for at, i in enumerate(order) for t, w in weights[i].items())
        term = np.array([e[0] for e in entries], np.int64)
        self.held = np.array([e[1] for e in entries], np.int64)
        self.weight = np.array([e[2] for e in entries], np.float64)
        run = term * max(self.n_blocks, 1) + self.held // block
        first = np.flatnonzero(np.diff(run, prepend=-1))
        self.starts = np.append(first, len(run))
        self.blocks = self.held[first] // block
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        self.heads = np.searchsorted(term[first], np.arange(len(self.ids) + 2))
        self.bound = np.zeros(len(self.ids) + 1)
        np.maximum.at(self.bound, term, self.weight)
        # Per item of several parts its question and answer, and per part of it
        # how many of the item's words lie ahead of it.
        self.whole: dict[tuple, tuple[list[str], list[str]]] = {}
        self.ahead: dict[tuple, int] = {}
        split = {p[4:] + p[:1] for p in parts if p[1] > 0}
        for item, part, question, answer, text in sorted(parts, key=lambda p: p[1]):
            if (text, item) in split:
                asked, answered = self.whole.setdefault((text, item), ([], []))
                self.ahead[text, item, part] = len(asked) + len(answered)
                asked += question
                answered += answer

    def search(self, passage: np.ndarray, term: np.ndarray, least: float) -> Iterator[tuple[int, int, float]]:
        """All (passage, part, score) of ``least`` or more, in that order.

        ``passage`` and ``term`` are distinct pairs: passages are numbered from 0.
        """
        at, entry = _spread(self.heads[term], self.heads[term + 1])
        block = passage[at] * self.n_blocks + self.blocks[entry]
        opened = np.bincount(block, self.most[entry]) >= least - 1e-4
        inside = opened[block]
        passage, entry = passage[at[inside]], entry[inside]
        at, posting = _spread(self.starts[entry], self.starts[entry + 1])
        pair, place = np.unique(passage[at] * len(self.parts) + self.held[posting], return_inverse=True)
        score = np.bincount(place, self.weight[posting], len(pair))
        for i in np.flatnonzero(score >= least):
            yield *map(int, divmod(pair[i], len(self.parts))), float(score[i])

    def hits(self, text: str | None, least: float, least_overlap: float) -> list[tuple]:
        """Verified items in a text: (item, part, passage start, score, question
        overlap, answer overlap), each with its best passage and its part there."""
        found = words(text)
        if not found or not self.parts:
            return []
        ids = np.fromiter(map(self.ids.get, found, repeat(0)), np.int64, len(found))
        starts = np.arange(0, max(len(found) - PASSAGE_WORDS + STRIDE, 1), STRIDE)
        ends = np.minimum(starts + PASSAGE_WORDS, len(found))
        sums = np.concatenate([[0.0], np.cumsum(self.bound[ids])])
        open_passages = np.flatnonzero(sums[ends] - sums[starts] >= least - 1e-4)
        best: dict[tuple, tuple] = {}
        long: dict[tuple, list[tuple]] = {}
        for low in range(0, len(open_passages), PASSAGES_AT_ONCE):
            chosen = open_passages[low : low + PASSAGES_AT_ONCE]
            at, word = _spread(starts[chosen], ends[chosen])
            pairs = np.unique(at * len(self.bound) + ids[word])
            passage, term = np.divmod(pairs, len(self.bound))
            there, last = set(), -1
            for at, i, score in self.search(passage, term, least):
                start, end = int(starts[chosen[at]]), int(ends[chosen[at]])
                if at != last:
                    there, last = _passage_grams(found[start:end]), at
                item, part, question, answer, text_digest = self.parts[i]
                asked = overlap(question, there)
                if (text_digest, item) in self.whole:
                    long.setdefault((text_digest, item), []).append((part, start, score, asked))
                    continue
                answered = overlap(answer, there)
                if min(asked, answered) >= least_overlap:
                    hit = (item, part, start, score, asked, answered)
                    if item not in best or best[item][3] < score:
                        best[item] = hit
        for key, retrieved in long.items():
            hit = self._verified(key, retrieved, found, least_overlap)
            if hit and (hit[0] not in best or best[hit[0]][3] < hit[3]):
                best[hit[0]] = hit
        return list(best.values())

    def _verified(self, key: tuple, retrieved: list[tuple], found: list[str], least_overlap: float) -> tuple | None:
        """The hit of an item of several parts, some of them retrieved."""
        question, answer = self.whole[key]
        if not answer:
            good = [r for r in retrieved if r[3] >= least_overlap]
            if not good:
                return None
            part, start, score, asked = max(good, key=lambda r: (r[2], -r[1]))
            return key[1], part, start, score, asked, 1.0
        # The words that the item would fill around the parts retrieved.
        size, there, done = len(question) + len(answer), set(), 0
        for low, high in sorted(
            (max(start - self.ahead[*key, part], 0), start + PASSAGE_WORDS + size - self.ahead[*key, part])
            for part, start, _, _ in retrieved
        ):
            if high > done:
                # A trigram may begin in the words of the stretch before.
                there |= _passage_grams(found[max(low, done - GRAM + 1) : high])
                done = high
        asked, answered = overlap(question, there), overlap(answer, there)
        if min(asked, answered) < least_overlap:
            return None
        part, start, score, _ = max(retrieved, key=lambda r: (r[2], -r[1]))
        return key[1], part, start, score, asked, answered


def stored_indexes(
    items: DataFrame, id_column: str = "item_id", text_column: str = "text", shard_parts: int | None = None
) -> DataFrame:
    """``shard, index``: BM25 indexes of all items, each of about ``shard_parts``
    parts of at most ``PART_WORDS`` words; parts of one item are not separated.

    A task makes an index, which is one binary row in the shared folder. Item
    ids are text in an index. Without items there is no row.
    """
    parts = item_parts(items, id_column, text_column).withColumn("item_id", F.col("item_id").cast("string"))
    parts = stored(parts, "item-parts")
    total = parts.agg(F.count("*").alias("parts"), F.avg(F.size("question") + F.size("answer")).alias("words")).first()
    key = F.struct("item_id", "item_text", "part").alias("key")
    terms = parts.select(
        key,
        (F.size("question") + F.size("answer")).alias("words"),
        F.explode(F.concat("question", "answer")).alias("term"),
    )
    counted = terms.groupBy("key", "term", "words").agg(F.count("*").alias("times"))
    held_by = counted.groupBy("term").agg(F.count("*").alias("holders"))
    idf = F.log(1 + (total["parts"] - F.col("holders") + 0.5) / (F.col("holders") + 0.5))
    times = F.col("times") * (K1 + 1) / (
        F.col("times") + K1 * (1 - B + B * F.col("words") / F.lit(total["words"] or 1.0))
    )
    weighted = (
        counted.join(held_by, "term")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("term", (idf * times).alias("weight")))).alias("weights"))
    )
    shards = max(-(-total["parts"] // (shard_parts or SHARD_PARTS)), 1)
    ready = (
        parts.withColumn("key", key)
        .join(weighted, "key")
        .select(
            F.pmod(F.xxhash64("key.item_id", "key.item_text"), F.lit(shards)).cast("int").alias("shard"),
            "key.*", "question", "answer", F.col("weights.term").alias("terms"), F.col("weights.weight").alias("weights"),
        )
    )

    def indexed(rows: pd.DataFrame) -> pd.DataFrame:
        own, held = [], []
        for row in sorted(rows.itertuples(), key=lambda r: (r.item_id or "", r.item_text, r.part)):
            whole = sum(row.weights)
            own.append({term: weight / whole for term, weight in zip(row.terms, row.weights)})
            held.append((row.item_id, row.part, list(row.question), list(row.answer), row.item_text))
        index = pickle.dumps(BlockMaxIndex(held, own))
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "index": [index]})

    return stored(ready.groupBy("shard").applyInPandas(indexed, "shard int, index binary"), "item-indexes")


def index_shards(
    items: DataFrame, id_column: str = "item_id", text_column: str = "text", shard_parts: int | None = None
) -> Iterator[tuple[list[Broadcast], bool]]:
    """Up to ``SHARDS_AT_ONCE`` broadcast indexes at a time, and whether they are
    the last ones. The driver reads one row after another and opens none."""
    indexes = stored_indexes(items, id_column, text_column, shard_parts)
    numbers = sorted(row["shard"] for row in indexes.select("shard").collect())
    for at in range(0, len(numbers), SHARDS_AT_ONCE):
        rows = (indexes.where(F.col("shard") == n).first() for n in numbers[at : at + SHARDS_AT_ONCE])
        shards = [items.sparkSession.sparkContext.broadcast(_Packed(bytes(row["index"]))) for row in rows]
        yield shards, at + SHARDS_AT_ONCE >= len(numbers)


_HIT = (
    "array<struct<item_id:{kind},part:int,passage_start:bigint,score:double,"
    "question_overlap:double,answer_overlap:double>>"
)


def _with_hits(
    docs: DataFrame,
    shards: list[Broadcast],
    name: str,
    text_column: str,
    kind: str,
    least_score: float = LEAST_SCORE,
    least_overlap: float = LEAST_OVERLAP,
) -> DataFrame:
    """``docs`` with a column ``name``: the items of some shards found in each text."""
    fields = ("item_id", "part", "passage_start", "score", "question_overlap", "answer_overlap")

    def searching(shard: Broadcast):
        def search(texts: pd.Series) -> pd.Series:
            found = [shard.value.hits(text, least_score, least_overlap) for text in texts]
            return pd.Series([[dict(zip(fields, h)) for h in hits] for hits in found], dtype=object)

        search.__annotations__ = {"texts": pd.Series, "return": pd.Series}
        return F.pandas_udf(search, _HIT.format(kind="string"))

    columns = [searching(shard)(docs[text_column]) for shard in shards]
    hits = F.concat(*columns) if columns else F.array()
    return docs.withColumn(name, hits.cast(_HIT.format(kind=kind)))


def _release(shards: list[Broadcast]) -> None:
    for shard in shards:
        shard.destroy()


def _fresh(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_score: float = LEAST_SCORE,
    least_overlap: float = LEAST_OVERLAP,
) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, part,
    passage_start (word number), score, question_overlap, answer_overlap.

    ``part``, ``passage_start`` and ``score`` are of the part that scores most.
    Documents without such a passage have no row. A NULL or blank text or item
    holds nothing; an item without an id is found like others; two equal items
    are both found; a repeated document is listed as often as it occurs.
    """
    kind = items.schema[item_id].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def found_by(shards: list[Broadcast]) -> DataFrame:
        found = _with_hits(rows, shards, "hits", "text", kind, least_score, least_overlap)
        return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")

    written = []
    for shards, last in index_shards(items, item_id, item_text):
        if last and not written:
            return found_by(shards)
        written.append(stored(found_by(shards), "hits"))
        _release(shards)
    return reduce(DataFrame.unionByName, written) if written else found_by([])


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Rows of ``docs``, unchanged, that hold no test item.

    A pass over further shards reads what the passes before have kept.
    """
    name, columns, kind = _fresh(docs, "hits"), docs.columns, items.schema[item_id].dataType.simpleString()
    for shards, last in index_shards(items, item_id, item_text):
        found = _with_hits(docs, shards, name, text_column, kind)
        docs = found.where(F.size(name) == 0).select(*[found[c] for c in columns])
        if not last:
            docs = stored(docs, "no-hits")
            _release(shards)
    return docs
