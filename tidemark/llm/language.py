"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of some learned
texts. A text is compressed with every dictionary, and the language with the
smallest output is chosen: what resembles the dictionary is copied from it.
Long texts are compressed in blocks, each with the dictionary alone behind it,
so that a text's own repetitions do not drown the dictionary. A narrow margin
between the two smallest outputs rejects the choice.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

UNDETERMINED = "und"

# The model is fitted on a bounded sample: of every language about SAMPLE_TEXTS
# texts, of a text at most EXCERPT_BYTES bytes, and DICTIONARY_BYTES in all, or
# less where more languages share MODEL_BYTES. LEAST_BYTES are left to each.
MODEL_BYTES, LEAST_BYTES = 8 * 1024 * 1024, 512
SAMPLE_TEXTS = 400
EXCERPT_BYTES = 2_000
DICTIONARY_BYTES = 32_768

LEVEL = 12
BLOCK_BYTES = 2_048
LEAST_MARGIN = 0.01


def normal(text: str) -> bytes:
    """Lower-cased words, immediate repetitions left out."""
    return " ".join(word for word, _ in groupby(text.lower().split())).encode("utf-8", "surrogatepass")


def dictionaries(
    known: DataFrame, text_column: str = "text", language_column: str = "lang", id_column: str = "doc_id"
) -> dict[str, bytes]:
    """Dictionary content per language of ``known``.

    Rows without a language, a text or a letter teach nothing. Which rows are
    taken depends on a hash of their id.
    """
    rows = known.select(
        F.col(id_column).alias("doc_id"),
        F.col(language_column).cast("string").alias("lang"),
        F.col(text_column).alias("text"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    # One row per language.
    languages = rows.groupBy("lang").agg(F.count("*").alias("texts"))
    size = max(min(DICTIONARY_BYTES, MODEL_BYTES // max(languages.count(), 1)), LEAST_BYTES)
    luck = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_000))
    wanted = F.lit(2 * SAMPLE_TEXTS * 1_000_000) / F.col("texts")
    sample = (
        rows.withColumn("luck", luck)
        .join(languages, "lang")
        .where(F.col("luck") <= wanted)
        .select("lang", "luck", "text")
    )

    def excerpts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for luck, text in zip(batch["luck"], batch["text"]):
                content = normal(text)
                at = luck % max(len(content) - EXCERPT_BYTES + 1, 1)
                parts.append(content[at : at + EXCERPT_BYTES])
            yield pd.DataFrame({"lang": batch["lang"], "luck": batch["luck"], "part": parts})

    def joined(batch: pd.DataFrame) -> pd.DataFrame:
        parts = batch.sort_values(["luck", "part"])["part"]
        content = b"\n".join(parts)[:size]
        return pd.DataFrame({"lang": batch["lang"][:1], "content": [content]})

    parts = sample.mapInPandas(excerpts, "lang string, luck bigint, part binary")
    found = parts.groupBy("lang").applyInPandas(joined, "lang string, content binary")
    # About MODEL_BYTES.
    return {row["lang"]: bytes(row["content"]) for row in found.collect() if row["content"].strip()}


class Compressors:
    """One compressor per language, in the order of the names."""

    def __init__(self, contents: dict[str, bytes]):
        self.names = sorted(contents)
        self.each = []
        for name in self.names:
            data = zstandard.ZstdCompressionDict(contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.each.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and margin: by how much of the second smallest output the
        smallest is smaller. Equal sizes go to the first name."""
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        content = normal(text)
        blocks = [content[i : i + BLOCK_BYTES] for i in range(0, len(content), BLOCK_BYTES)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.each]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        margin = 1.0 if len(order) == 1 else 1 - sizes[order[0]] / sizes[order[1]]
        return self.names[order[0]], margin


def identify(
    docs: DataFrame,
    contents: dict[str, bytes],
    id_column: str = "doc_id",
    text_column: str = "text",
    least_margin: float = LEAST_MARGIN,
) -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` of every row, from its text alone.

    ``score`` is the margin, 0 to 1; ``accepted`` is false where it is below
    ``least_margin``. A text that is NULL or has no letter is ``und`` with
    score 0 and not accepted, and so is all if nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(contents)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressors = Compressors(shared.value)
        for batch in batches:
            found = [compressors.predict(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "lang_pred": [f[0] for f in found],
                    "score": [f[1] for f in found],
                    "accepted": [f[0] != UNDETERMINED and f[1] >= least_margin for f in found],
                }
            )

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return map_rows(rows, run, "lang_pred string, score double, accepted boolean")


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from learning: a third, by CRC-32 of the id."""
    remainder = F.crc32(F.encode(F.col(id_column).cast("string"), "UTF-8")) % 3
    return F.coalesce(remainder == 1, F.lit(False))
