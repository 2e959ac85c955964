"""SentencePiece encoding and decoding, giant documents in parallel.

The model is byte-pair encoding. A segmentation is the one byte-pair encoding
finds exactly if every two neighbouring pieces are *compatible*: encoding their
concatenation gives the two pieces back. So encoding is the best path through a
lattice whose nodes are (position, last piece), whose steps between compatible
pieces weigh -1, and whose other steps weigh minus infinity; that is a product
of max-plus matrices, and the weight of the whole is minus the piece count.

A document of more than ``CHUNK`` characters is cut at fixed places, whatever
stands there. The state at a cut is how far the last piece reaches past it, and
which piece it is; a model's pieces are short, so there are few states.

1. Every chunk by itself yields its transfer matrix between the states at its
   two cuts. It needs a few characters of context, no other chunk.
2. Matrices are multiplied per block of ``BLOCK`` chunks, and the blocks of a
   document are run through from its first to its last state; max-plus products
   are associative. This fixes the states between blocks, then, again per
   block, those between chunks.
3. Every chunk is traced by itself between its two states, which gives its ids.

No piece runs over the start of a run of spaces or beside a line feed. Between
two such places a *unit* is encoded on its own by the library; units repeat, so
their ids are remembered. A chunk that holds such a place has a matrix of rank one, for all
states meet there.

Other documents are one chunk, which the library encodes where it is: nothing
is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, stored

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 32_768
BLOCK = 64
REMEMBERED_UNITS = 50_000

# Fixed values of the format: the sign for a space.
SPACE = "▁"

_UNIT = re.compile(r"\n| *[^ \n]+| +")
_FRESH, _UNKNOWN = -1, -2
_BASE = 1 << 20  # more than any vocabulary


def _state(reach: int, piece: int) -> int:
    return reach * _BASE + piece + 2


class PieceModel:
    """A SentencePiece model of the byte-pair kind, its lattice and its units."""

    def __init__(self, proto: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        count = self.model.get_piece_size()
        self.bytes: list[bytes] = []
        self.piece: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        for i in range(count):
            text = self.model.id_to_piece(i).replace(SPACE, " ")
            if self.model.is_byte(i):
                value = int(text[3:5], 16)
                self.byte_ids[value] = i
                self.bytes.append(bytes([value]))
            elif self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i):
                self.bytes.append(b"")
            else:
                self.piece[text] = i
                self.bytes.append(text.encode())
        if any(" " in p.lstrip(" ") or "\n" in p for p in self.piece):
            raise ValueError("pieces with a space inside or a line feed are not supported")
        self.text = {i: p for p, i in self.piece.items()}
        self.score = {p: self.model.get_score(i) for p, i in self.piece.items()}
        self.reach = max(map(len, self.piece))
        self.single = self.model.piece_to_id(SPACE)
        self.units: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    # --- whole units -------------------------------------------------------

    def unit(self, unit: str, at_start: bool = False) -> tuple[int, ...]:
        """Ids of a unit. The library puts a space ahead of every text."""
        known = self.units.get(unit)
        if known is not None:
            return known
        if unit == " ":
            ids = [self.single]
        elif unit[0] == " ":
            ids = self.model.encode(unit[1:])
        elif unit == "\n":
            ids = [self.byte_ids[10]]
        else:
            ids = self.model.encode("\n" + unit)[2:]
        if len(self.units) >= REMEMBERED_UNITS:
            self.units.clear()
        self.units[unit] = known = tuple(ids)
        return known

    def encode(self, text: str | None) -> list[int]:
        return self.model.encode(text) if text else []

    def decode(self, ids) -> str:
        """Text of a document's ids, without the space put ahead of it."""
        table = self.bytes
        joined = b"".join([table[i] for i in ids])
        return joined[joined[:1] == b" " :].decode("utf-8", "replace")

    # --- the lattice -------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Byte-pair encoding of a short text: the best merge first, of equal
        ones the leftmost."""
        parts = list(text)
        while True:
            scores = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
            known = [s for s in scores if s is not None]
            if not known:
                return parts
            at = scores.index(max(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may follow; at a fresh place or after a character
        the model does not know it only has to be its own encoding."""
        if piece == _UNKNOWN:
            return True
        before = max(before, _FRESH) if before < 0 else before
        key = (before, piece)
        known = self.pairs.get(key)
        if known is None:
            own = self.text[piece]
            if before < 0:
                known = self.merged(own) == [own]
            else:
                known = self.merged(self.text[before] + own) == [self.text[before], own]
            self.pairs[key] = known
        return known

    @staticmethod
    def is_fresh(text: str, at: int) -> bool:
        """Whether a unit starts at this place of the text."""
        if at <= 0 or at >= len(text):
            return True
        here, before = text[at], text[at - 1]
        return here == "\n" or before == "\n" or (here == " " and before != " ")

    def steps(self, text: str, at: int) -> Iterator[tuple[int, int]]:
        """``(end, piece)`` of all pieces that start here."""
        known = False
        for end in range(at + 1, min(at + self.reach, len(text)) + 1):
            piece = self.piece.get(text[at:end])
            if piece is not None:
                known = known or end == at + 1
                yield end, piece
        if not known:
            yield at + 1, _UNKNOWN

    def entries(self, text: str, cut: int) -> list[tuple[int, int]]:
        """States ``(position, last piece)`` a path can be in when it reaches
        ``cut``: the last piece starts ahead of it and ends on or after it."""
        if self.is_fresh(text, cut):
            return [(cut, _FRESH)]
        found = set()
        for start in range(max(cut - self.reach, 0), cut):
            for end, piece in self.steps(text, start):
                if end >= cut:
                    found.add((end, _FRESH if self.is_fresh(text, end) else piece))
        return sorted(found)

    def walk(self, text: str, entry: tuple[int, int], stop: int) -> tuple[dict, dict]:
        """Best weight of every state at or past ``stop`` that a path from
        ``entry`` reaches, and where every state was best reached from."""
        best: dict[int, dict[int, int]] = {entry[0]: {entry[1]: 0}}
        came: dict[tuple[int, int], tuple[int, int, int]] = {}
        for at in range(entry[0], stop):
            here = best.pop(at, None)
            if not here:
                continue
            ahead = list(self.steps(text, at))
            for last, weight in here.items():
                for end, piece in ahead:
                    if self.compatible(last, piece):
                        state = _FRESH if self.is_fresh(text, end) else piece
                        there = best.setdefault(end, {})
                        if weight - 1 > there.get(state, -(1 << 60)):
                            there[state] = weight - 1
                            came[end, state] = (at, last, piece)
        return {(at, last): w for at, states in best.items() for last, w in states.items()}, came

    def trace(self, text: str, entry: tuple[int, int], leave: tuple[int, int]) -> list[int]:
        """Ids of the path from one state to another."""
        _, came = self.walk(text, entry, leave[0] if leave[1] == _FRESH else max(entry[0], leave[0]))
        ids: list[int] = []
        state = leave
        while state != entry:
            at, last, piece = came[state]
            if piece == _UNKNOWN:
                ids += [self.byte_ids[b] for b in reversed(text[at : state[0]].encode())]
            else:
                ids.append(piece)
            state = (at, last)
        return ids[::-1]

    def _fresh_places(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """First and last fresh place in ``low..high``, if there is one."""
        first = next((i for i in range(low, high + 1) if self.is_fresh(text, i)), None)
        if first is None:
            return None
        return first, next(i for i in range(high, first - 1, -1) if self.is_fresh(text, i))

    def matrix(self, text: str, low: int, high: int) -> dict[tuple[int, int], int]:
        """Transfer matrix of ``text[low:high]``: weight by (state in, state out)."""
        between = self._fresh_places(text, low, high)
        found: dict[tuple[int, int], int] = {}

        def code(state: tuple[int, int], cut: int) -> int:
            return _state(state[0] - cut, state[1])

        if between is None:
            for entry in self.entries(text, low):
                for leave, weight in self.walk(text, entry, high)[0].items():
                    found[code(entry, low), code(leave, high)] = weight
            return found
        first, last = between
        inner = -sum(len(self.unit(u)) for u in _UNIT.findall(text[first:last]))
        tail = self.walk(text, (last, _FRESH), high)[0]
        for entry in self.entries(text, low):
            head = self.walk(text, entry, first)[0].get((first, _FRESH))
            if head is not None:
                for leave, weight in tail.items():
                    found[code(entry, low), code(leave, high)] = head + inner + weight
        return found

    def chunk_ids(self, text: str, low: int, high: int, entry: int, leave: int) -> list[int]:
        """Ids of a chunk between two states."""
        come = (low + entry // _BASE, entry % _BASE - 2)
        go = (high + leave // _BASE, leave % _BASE - 2)
        between = self._fresh_places(text, low, high)
        if between is None or come[0] > between[0]:
            return self.trace(text, come, go)
        first, last = between
        ids = self.trace(text, come, (first, _FRESH))
        for unit in _UNIT.findall(text[first:last]):
            ids += self.unit(unit)
        return ids + self.trace(text, (last, _FRESH), go)


_LOADED: dict[str, PieceModel] = {}


def _model(proto: bytes) -> PieceModel:
    """The model, once per Python process."""
    name = hashlib.sha256(proto).hexdigest()
    if name not in _LOADED:
        _LOADED[name] = PieceModel(proto)
    return _LOADED[name]


Matrix = dict[tuple[int, int], int]


def multiply(left: Matrix, right: Matrix) -> Matrix:
    """Max-plus product."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for (a, b), weight in right.items():
        rows.setdefault(a, []).append((b, weight))
    found: Matrix = {}
    for (a, b), weight in left.items():
        for c, more in rows.get(b, ()):
            if weight + more > found.get((a, c), -(1 << 60)):
                found[a, c] = weight + more
    return found


def best_states(matrices: list[Matrix], entry: int, leave: int) -> list[int]:
    """States before, between and after the matrices on the best path."""
    reached = [{entry: 0}]
    for matrix in matrices:
        ahead: dict[int, int] = {}
        for (a, b), weight in matrix.items():
            if a in reached[-1]:
                ahead[b] = max(ahead.get(b, -(1 << 60)), reached[-1][a] + weight)
        reached.append(ahead)
    states = [leave]
    for matrix, before in zip(reversed(matrices), reversed(reached[:-1])):
        sources = [(before[a] + w, a) for (a, b), w in matrix.items() if b == states[-1] and a in before]
        states.append(max(sources)[1])
    return states[::-1]


_EDGE = _state(0, _FRESH)


def _packed(matrix: Matrix) -> list[int]:
    return [n for (a, b), w in matrix.items() for n in (a, b, w)]


def _unpacked(numbers) -> Matrix:
    table = np.asarray(numbers, np.int64).reshape(-1, 3).tolist()
    return {(a, b): w for a, b, w in table}


def _encode_giants(giants: DataFrame, proto, chunk: int, context: int) -> DataFrame:
    """``giant, ids`` of texts cut into chunks; ``giants`` has (giant, text)."""
    # The lattice reads the text with a space ahead of it.
    spaced = F.concat(F.lit(" "), F.replace("text", F.lit(SPACE), F.lit(" ")))
    # One pass cuts a text into parts; a chunk takes its context from the parts
    # around it, so no chunk is looked for from the start of the text.
    around = -(-context // chunk)
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))

    def piece(number: Column) -> Column:
        begin = F.greatest(number - around, F.lit(0))
        first = F.greatest(number * chunk - context, F.lit(0))
        near = F.array_join(F.slice(F.col("parts"), begin + 1, F.lit(2 * around + 1)), "")
        return F.struct(
            number.alias("chunk"),
            first.alias("first"),
            (number * chunk - first).alias("low"),
            F.length(F.get(F.col("parts"), number)).alias("length"),
            F.substr(near, first - begin * chunk + 1, F.lit(chunk + 2 * context)).alias("text"),
        )

    cut = F.transform(F.sequence(F.lit(0), F.size("parts") - 1), piece)
    pieces = (
        giants.select("giant", spaced.alias("text"))
        .select("giant", parts.alias("parts"))
        .select("giant", F.explode(cut).alias("piece"))
        .select("giant", "piece.*")
    )
    pieces = stored(pieces, "chunks")

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(proto.value)
        for batch in batches:
            rows = zip(batch["text"], batch["low"], batch["length"])
            found = [_packed(model.matrix(t, low, low + n)) for t, low, n in rows]
            yield pd.DataFrame({"giant": batch["giant"], "chunk": batch["chunk"], "matrix": found})

    steps = stored(
        pieces.mapInPandas(matrices, "giant string, chunk int, matrix array<bigint>").withColumn(
            "block", F.floor(F.col("chunk") / BLOCK).cast("int")
        ),
        "transfer-matrices",
    )

    def in_order(batch: pd.DataFrame, key: str) -> tuple[list[int], list[Matrix]]:
        batch = batch.sort_values(key)
        return batch[key].tolist(), [_unpacked(m) for m in batch["matrix"]]

    def product(batch: pd.DataFrame) -> pd.DataFrame:
        _, found = in_order(batch, "chunk")
        whole = found[0]
        for matrix in found[1:]:
            whole = multiply(whole, matrix)
        return pd.DataFrame(
            {"giant": batch["giant"][:1], "block": batch["block"][:1], "matrix": [_packed(whole)]}
        )

    # A text is at most 2 GB, so it has at most some thousand blocks.
    def run_through(batch: pd.DataFrame) -> pd.DataFrame:
        blocks, found = in_order(batch, "block")
        states = best_states(found, _EDGE, _EDGE)
        return pd.DataFrame(
            {"giant": batch["giant"].iloc[0], "block": blocks, "entry": states[:-1], "leave": states[1:]}
        )

    def within(batch: pd.DataFrame) -> pd.DataFrame:
        chunks, found = in_order(batch, "chunk")
        states = best_states(found, batch["entry"].iloc[0], batch["leave"].iloc[0])
        return pd.DataFrame(
            {"giant": batch["giant"].iloc[0], "chunk": chunks, "entry": states[:-1], "leave": states[1:]}
        )

    products = steps.groupBy("giant", "block").applyInPandas(
        product, "giant string, block int, matrix array<bigint>"
    )
    ends = products.groupBy("giant").applyInPandas(
        run_through, "giant string, block int, entry bigint, leave bigint"
    )
    states = (
        steps.join(ends, ["giant", "block"])
        .groupBy("giant", "block")
        .applyInPandas(within, "giant string, chunk int, entry bigint, leave bigint")
    )

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(proto.value)
        for batch in batches:
            rows = zip(batch["text"], batch["low"], batch["length"], batch["entry"], batch["leave"])
            found = [model.chunk_ids(t, low, low + n, a, b) for t, low, n, a, b in rows]
            yield pd.DataFrame({"giant": batch["giant"], "chunk": batch["chunk"], "ids": found})

    ids = pieces.join(states, ["giant", "chunk"]).mapInPandas(
        traced, "giant string, chunk int, ids array<int>"
    )
    in_turn = F.sort_array(F.collect_list(F.struct("chunk", "ids")))
    return ids.groupBy("giant").agg(
        F.flatten(F.transform(in_turn, lambda c: c["ids"])).alias("ids"),
        F.count("*").cast("int").alias("chunks"),
    )


def encode(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    model_path: str = MODEL,
    chunk: int = CHUNK,
) -> DataFrame:
    """``doc_id, ids, chunks, intact`` of every row.

    The ids are those of the SentencePiece library for the whole text, and
    ``intact`` says whether they decode to it. A NULL or empty text has none
    and is intact. Rows that repeat an id or a text are encoded as often as they
    occur. Other columns are not looked at.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as file:
        proto = spark.sparkContext.broadcast(file.read())
    context = PieceModel(proto.value).reach + 1
    if chunk < 2 * context:
        raise ValueError(f"a chunk takes {2 * context} characters or more")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(proto.value)
        for batch in batches:
            found = [model.encode(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "ids": [np.array(ids, np.int32) for ids in found],
                    "chunks": 1,
                    "intact": [model.decode(ids) == t for ids, t in zip(found, batch["text"])],
                }
            )

    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    is_giant = F.length("text") >= chunk
    small = map_rows(rows.where(~is_giant), whole, "ids array<int>, chunks int, intact boolean")
    # Equal giant texts are encoded once.
    giant_rows = rows.where(is_giant).withColumn("giant", F.sha2("text", 256))
    giants = giant_rows.groupBy("giant").agg(F.first("text").alias("text"))
    encoded = _encode_giants(giants, proto, chunk, context)
    # Decoded from the joined ids, and compared by the digest of the text.
    decoded = decode(encoded.withColumnRenamed("giant", "doc_id").withColumn("pieces", F.col("ids")), ("pieces", "chunks"), model_path)
    found = decoded.select(
        F.col("doc_id").alias("giant"),
        F.col("pieces").alias("ids"),
        "chunks",
        (F.sha2("text", 256) == F.col("doc_id")).alias("intact"),
    )
    large = giant_rows.select("doc_id", "giant").join(found, "giant").drop("giant")
    return small.unionByName(large)


def decode(
    encoded: DataFrame, keep: tuple[str, ...] = (), model_path: str = MODEL
) -> DataFrame:
    """``doc_id, text`` and the columns ``keep`` of rows that have ``ids``.

    NULL ids give an empty text. The sign for a space comes back as a space;
    all else comes back as it was.
    """
    spark = encoded.sparkSession
    with open(model_path, "rb") as file:
        proto = spark.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(proto.value)
        for batch in batches:
            texts = [model.decode(() if i is None else i.tolist()) for i in batch["ids"]]
            yield batch.drop(columns="ids").assign(text=texts)

    kinds = "".join(f"{c} {encoded.schema[c].dataType.simpleString()}, " for c in keep)
    return map_rows(encoded.select("doc_id", *keep, "ids"), run, f"{kinds}text string")
