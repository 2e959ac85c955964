"""Token counts that follow edits.

A document keeps a segment tree over its pre-tokens: a leaf is a run of them
with its characters and its byte-pair tokens, and every node above has the sums
of its two children. The pre-token pattern never lets tokens cross, so a
document's count is the sum at the root.

An edit is located by walking down the tree. Only the leaves it touches are
encoded again, with as much context on both sides as it takes to reach *safe*
places: a space between two visible ASCII characters, ahead of which a
pre-token always ends, whatever stands elsewhere. Their sums, and those on the
way to the root, are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text ahead of the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LEAF_CHARS = 512

_SAFE = re.compile(r"(?<=[!-~]) (?=[!-~])")
_PRETOKEN = regex.compile(PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

# What the built-in redaction replaces, in this order of preference.
REDACTED = re.compile(
    r"(?P<EMAIL>[\w.+-]+@[\w-]+\.[\w.-]*\w)"
    r"|(?P<ADDRESS>\b\d{1,3}(?:\.\d{1,3}){3}\b)"
    r"|(?P<SECRET>\b[0-9a-f]{32,}\b)"
    r"|(?P<NUMBER>\+?\(?\d[\d() .-]{7,}\d)"
)


def encoding(ranks: bytes) -> tiktoken.Encoding:
    """The tokenizer of a rank file."""
    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def is_safe(text: str, at: int) -> bool:
    """Whether a pre-token ends at this place whatever stands elsewhere."""
    return at <= 0 or at >= len(text) or _SAFE.match(text, at) is not None


class Counter:
    def __init__(self, ranks: bytes):
        self.encoding = encoding(ranks)

    def count(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def leaves(self, text: str, low: int, high: int, leaf_chars: int) -> list[tuple[int, int]]:
        """``(characters, tokens)`` of the leaves of ``text[low:high]``, both
        ends of which are safe. Leaves end at a safe place where one comes
        soon, and else after a pre-token."""
        found, at = [], low
        while at < high:
            if high - at <= leaf_chars:
                end = high
            else:
                safe = _SAFE.search(text, at + leaf_chars, min(at + 4 * leaf_chars, high))
                end = safe.start() if safe else None
            if end is not None:
                found.append((end - at, self.count(text[at:end])))
                at = end
                continue
            # No safe place soon: go by pre-tokens, each counted alone, up to
            # the next safe place that ends a leaf.
            chars = tokens = 0
            for match in _PRETOKEN.finditer(text, at, high):
                chars += match.end() - match.start()
                tokens += self.count(match.group())
                if chars >= leaf_chars:
                    found.append((chars, tokens))
                    at, chars, tokens = match.end(), 0, 0
                    if is_safe(text, at):
                        break
            if chars:
                found.append((chars, tokens))
                at += chars
        return found


class Tree:
    """A segment tree in an array: node i has the children 2i and 2i + 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens
        self.half = len(chars) // 2

    @classmethod
    def of(cls, leaves: list[tuple[int, int]]) -> Tree:
        half = 1
        while half < len(leaves):
            half *= 2
        empty = [0] * (half - len(leaves))
        tree = cls([0] * half + [c for c, _ in leaves] + empty, [0] * half + [t for _, t in leaves] + empty)
        tree._sum(half, 2 * half - 1)
        return tree

    def _sum(self, low: int, high: int) -> None:
        """Renew the sums above the leaves ``low..high`` (node numbers)."""
        while low > 1:
            low, high = low // 2, high // 2
            for i in range(low, high + 1):
                self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
                self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def locate(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins."""
        node, begin = 1, 0
        while node < self.half:
            node *= 2
            if at >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.half, begin

    def leaf_list(self) -> list[tuple[int, int]]:
        return list(zip(self.chars[self.half :], self.tokens[self.half :]))

    def replace(self, first: int, last: int, leaves: list[tuple[int, int]]) -> Tree:
        """The tree with other leaves in place of ``first..last``. Spare places
        stay empty; only if there are too few is the tree laid out anew."""
        room = last - first + 1
        if len(leaves) > room:
            old = self.leaf_list()
            return Tree.of([x for x in old[:first] + leaves + old[last + 1 :] if x[0]])
        for i in range(room):
            chars, tokens = leaves[i] if i < len(leaves) else (0, 0)
            self.chars[self.half + first + i], self.tokens[self.half + first + i] = chars, tokens
        self._sum(self.half + first, self.half + last)
        return self


def build(counter: Counter, text: str, leaf_chars: int = LEAF_CHARS) -> Tree:
    return Tree.of(counter.leaves(text, 0, len(text), leaf_chars))


def edit(
    counter: Counter,
    text: str,
    tree: Tree,
    start: int,
    length: int,
    replacement: str,
    leaf_chars: int = LEAF_CHARS,
) -> tuple[str, Tree, int]:
    """Text and tree after an edit, and how many characters were encoded.

    The place is clipped to the text.
    """
    start = min(max(start, 0), len(text))
    end = min(start + max(length, 0), len(text))
    after = text[:start] + replacement + text[end:]
    if not text:
        return after, build(counter, after, leaf_chars), len(after)
    grown = len(after) - len(text)
    first, begin = tree.locate(start)
    last, last_begin = tree.locate(max(end - 1, start))
    stop = last_begin + tree.chars[tree.half + last]
    # A place counts as safe only if it is so before and after the edit.
    while begin > 0 and not (begin < start and is_safe(text, begin) and is_safe(after, begin)):
        first, begin = tree.locate(begin - 1)
    while stop < len(text) and not (stop >= end and is_safe(text, stop) and is_safe(after, stop + grown)):
        last, last_begin = tree.locate(stop)
        stop = last_begin + tree.chars[tree.half + last]
    leaves = counter.leaves(after, begin, stop + grown, leaf_chars)
    return after, tree.replace(first, last, leaves), stop + grown - begin


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that replace personal data and secrets by their kind, the last
    first, so that earlier places stay as they are."""
    found = [(m.start(), m.end() - m.start(), f"<{m.lastgroup}>") for m in REDACTED.finditer(text)]
    return found[::-1]


_COUNTERS: dict[bytes, Counter] = {}


def _counter(ranks: bytes) -> Counter:
    """The tokenizer, once per Python process."""
    if ranks not in _COUNTERS:
        _COUNTERS[ranks] = Counter(ranks)
    return _COUNTERS[ranks]


def _ranks(frame: DataFrame, path: str):
    with open(path, "rb") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())


_TREE = "node_chars array<int>, node_tokens array<int>"
EDITS = "array<struct<start:int,length:int,replacement:string>>"


def count_tokens(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    ranks_path: str = RANKS,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """``doc_id, text, n_tokens, node_chars, node_tokens``: every row's count and
    segment tree. A NULL text counts as empty and has no tokens."""
    ranks = _ranks(docs, ranks_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(ranks.value)
        for batch in batches:
            trees = [build(counter, t, leaf_chars) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "text": batch["text"],
                    "n_tokens": [t.tokens[1] for t in trees],
                    "node_chars": [t.chars for t in trees],
                    "node_tokens": [t.tokens for t in trees],
                }
            )

    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    return map_rows(rows, run, f"text string, n_tokens bigint, {_TREE}")


def with_redactions(counted: DataFrame) -> DataFrame:
    """Add ``edits``: those of :func:`redactions` for each text."""

    def found(texts: pd.Series) -> pd.Series:
        names = ("start", "length", "replacement")
        return pd.Series([[dict(zip(names, e)) for e in redactions(t)] for t in texts], dtype=object)

    found.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return counted.withColumn("edits", F.pandas_udf(found, EDITS)("text"))


def apply_edits(
    counted: DataFrame, ranks_path: str = RANKS, leaf_chars: int = LEAF_CHARS
) -> DataFrame:
    """Rows of :func:`count_tokens` with a column ``edits``, after the edits.

    ``doc_id, text, n_tokens, node_chars, node_tokens, tokens_before, n_edits,
    encoded_chars``. Edits are applied in their order; places are those of the
    text at that moment, clipped to it. NULL edits, and NULLs in one, change
    nothing. ``encoded_chars`` is what had to be encoded for them.
    """
    ranks = _ranks(counted, ranks_path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(ranks.value)
        for batch in batches:
            out = []
            rows = zip(batch["doc_id"], batch["text"], batch["node_chars"], batch["node_tokens"], batch["edits"])
            for doc, text, chars, tokens, edits in rows:
                # Trees that nothing changes are passed on as they are.
                tree = Tree(list(map(int, chars)), list(map(int, tokens)))
                before, encoded, done = tree.tokens[1], 0, 0
                for e in () if edits is None else edits:
                    text, tree, chars_encoded = edit(
                        counter, text, tree, e["start"], e["length"], e["replacement"], leaf_chars
                    )
                    encoded, done = encoded + chars_encoded, done + 1
                out.append((doc, text, tree.tokens[1], tree.chars, tree.tokens, before, done, encoded))
            names = ("doc_id", "text", "n_tokens", "node_chars", "node_tokens", "tokens_before", "n_edits", "encoded_chars")
            yield pd.DataFrame(out, columns=names)

    # A NULL would turn a batch's numbers into floats.
    given = F.filter(
        "edits", lambda e: e["start"].isNotNull() & e["length"].isNotNull() & e["replacement"].isNotNull()
    )
    rows = counted.select("doc_id", "text", "node_chars", "node_tokens", given.alias("edits"))
    return map_rows(
        rows,
        run,
        f"text string, n_tokens bigint, {_TREE}, tokens_before bigint, n_edits int, encoded_chars bigint",
    )
