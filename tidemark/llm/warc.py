"""WARC archives: writing pages, and reading them back by verified chains.

*Writing.* A record is a text that ends with two line breaks, so Spark's text
writer, told to end lines that way, writes archives: many files in one job, with
Spark's commit. Pages with equal payloads of ``REVISIT_BYTES`` or more are
stored once; the others become revisit records, which hold no payload.

*Reading.* Files are split at every occurrence of the record magic, also in the
middle of a file, by Spark's text reader. Each piece is a *candidate*: it may be
a record or the inside of a payload. Its offset is the sum of the lengths before
it, and its header says where the next record starts. Only what a chain from
the start of the file reaches is a record:

1. in every span of ``SPAN_BYTES`` pointers are doubled until each candidate
   knows where its chain leaves the span;
2. the few candidates at which a chain enters a span are joined with each other,
   doubling the distance each time, from the start of the file to its end;
3. in every span the chain is followed from where it is entered.

A record in whose payload the magic occurs comes in several pieces, which are
put together again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import attach, stored

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
BREAK = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:x-page:"

REVISIT_BYTES = 1_000
SPAN_BYTES = 4 * 1024 * 1024
# A list of revisits of at most so many rows is broadcast; a longer one is joined
# by shuffle.
BROADCAST_ROWS = 100_000


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is NULL."""
    clean = F.regexp_replace(value.cast("string"), "[\\r\\n]+", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def revisits(pages: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``revisit_id, revisit_sha1, refers_to`` of pages whose payload of
    ``REVISIT_BYTES`` or more another page with a larger id has too."""
    payload = F.coalesce(F.col(text_column), F.lit(""))
    keys = ["sha1", "second_digest"]
    rows = pages.select(
        F.col(id_column).alias("revisit_id"),
        F.octet_length(payload).alias("bytes"),
        F.sha1(payload).alias("sha1"),
        F.xxhash64(payload).alias("second_digest"),
    ).where(F.col("bytes") >= REVISIT_BYTES)
    rows = stored(rows.drop("bytes"), "payload-digests")
    groups = rows.groupBy(*keys).agg(F.max("revisit_id").alias("refers_to"), F.count("*").alias("copies"))
    groups = stored(groups.where("copies > 1"), "payload-groups")
    return (
        attach(rows, groups, keys, "copies")
        .where("revisit_id < refers_to")
        .select("revisit_id", F.col("sha1").alias("revisit_sha1"), "refers_to")
        .distinct()
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    text_column: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record per page. Of records with equal payloads of
    ``REVISIT_BYTES`` or more, that with the largest id is the response and the
    others are revisits of it; smaller ones are all responses.

    A NULL text is an empty payload; a NULL url or id leaves its line out.
    Repeated pages are written as often as they occur. No page, no file.
    """
    found = stored(revisits(pages, id_column, text_column), "revisits")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    payload = F.coalesce(pages[text_column], F.lit(""))
    rows = pages.select(
        pages[id_column].alias("page_id"),
        (pages[url_column] if url_column in pages.columns else F.lit(None)).alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).alias("bytes"),
    )
    rows = rows.join(
        found, (rows["page_id"] == found["revisit_id"]) & (rows["sha1"] == found["revisit_sha1"]), "left"
    )
    again = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.lit("Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(BREAK),
    )
    rows = rows.withColumn("http", http).withColumn(
        "length", F.octet_length("http") + F.when(again, 0).otherwise(F.col("bytes"))
    )
    urn = F.lit(PAGE_URN)
    record = F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), urn, F.col("page_id").cast("string"), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(again, PROFILE)),
        _line("WARC-Refers-To", F.concat(F.lit("<"), urn, F.col("refers_to").cast("string"), F.lit(">"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.col("length")),
        F.lit("\r\n"),
        F.col("http"),
        F.when(again, "").otherwise(F.col("payload")),
    )
    rows.select(record.alias("value")).write.option("lineSep", BREAK).text(path)


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between magics: ``file, block, piece`` (its number) and ``value``."""
    pieces = spark.read.option("lineSep", MAGIC).text(path)
    return pieces.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"),
        "value",
    )


def _header_value(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)
    return F.when(found != "", found)


def _parsed(value: Column) -> dict[str, Column]:
    """What a record's text says, the magic left out."""
    header = F.substring_index(value, BREAK, 1)
    block = F.substr(value, F.length(header) + len(BREAK) + 1)
    http = F.substring_index(block, BREAK, 1)
    body = F.substr(block, F.length(http) + len(BREAK) + 1)
    body = F.substr(body, F.lit(1), F.greatest(F.length(body) - len(BREAK), F.lit(0)))
    page = _header_value(header, "WARC-Record-ID")
    refers = _header_value(header, "WARC-Refers-To")
    number = rf"^<{PAGE_URN}(-?\d+)>$"
    is_revisit = F.lower(_header_value(header, "WARC-Type")) == "revisit"
    digest = F.regexp_extract(_header_value(header, "WARC-Payload-Digest"), "^sha1:([0-9a-f]{40})$", 1)
    return {
        "page_id": F.regexp_extract(page, number, 1).try_cast("bigint"),
        "record_type": F.lower(_header_value(header, "WARC-Type")),
        "refers_to": F.regexp_extract(refers, number, 1).try_cast("bigint"),
        "payload_bytes": F.when(is_revisit, _header_value(http, "Content-Length").try_cast("bigint"))
        .otherwise(F.octet_length(body))
        .cast("bigint"),
        "payload_digest": F.when(is_revisit, digest).otherwise(F.sha1(body)),
        "payload": F.when(~is_revisit, body),
    }


_FIELDS = ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")


def _offsets(spark: SparkSession, path: str) -> DataFrame:
    """Candidates without their text: file, block, piece, start, stop (where the
    next record must start), whole (it ends where the piece ends), file_bytes,
    and what it says of itself."""
    value = F.col("value")
    header = F.substring_index(value, BREAK, 1)
    has_header = F.instr(value, BREAK) > 0
    length = _header_value(header, "Content-Length").try_cast("bigint")
    said = len(MAGIC) + F.octet_length(header) + len(BREAK) + length + len(BREAK)
    parsed = _parsed(value)
    rows = _candidates(spark, path).select(
        "file",
        "block",
        "piece",
        (F.octet_length("value") + len(MAGIC)).cast("bigint").alias("bytes"),
        F.when(has_header, said).alias("said"),
        *[parsed[f].alias(f) for f in _FIELDS],
    )
    rows = stored(rows, "candidates")
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.sum("bytes").alias("block_bytes"), F.min("piece").alias("first_piece"))
    blocks = blocks.select(
        "file",
        "block",
        "first_piece",
        F.coalesce(F.sum("block_bytes").over(in_file), F.lit(0)).alias("before"),
        (F.sum("block_bytes").over(Window.partitionBy("file")) - len(MAGIC)).alias("file_bytes"),
    )
    in_block = Window.partitionBy("file", "block").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("ahead", F.coalesce(F.sum("bytes").over(in_block), F.lit(0)))
    # The piece ahead of a file's first magic is empty or no record at all; the
    # magic of every other piece lies just ahead of it.
    start = F.col("before") + F.col("ahead") - len(MAGIC)
    return (
        placed.join(blocks, ["file", "block"])
        .withColumn("start", start)
        .where("start >= 0")
        .select(
            "file",
            "block",
            (F.col("piece") - F.col("first_piece")).alias("piece"),
            "start",
            (F.col("start") + F.col("said")).alias("stop"),
            (F.col("said") == F.col("bytes")).alias("whole"),
            "file_bytes",
            *_FIELDS,
        )
        .where(F.col("file_bytes") > 0)
    )


def _leaving(batch: pd.DataFrame) -> pd.DataFrame:
    """Where the chain of every candidate leaves its span, by pointer doubling."""
    start, leave = _chains(batch)
    return pd.DataFrame({"file": batch["file"].iloc[0], "start": start, "leave": leave})


def _pointers(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Index of each candidate's successor in the span, or its own."""
    at = np.minimum(np.searchsorted(start, stop), len(start) - 1)
    return np.where((stop > start) & (start[at] == stop), at, np.arange(len(start)))


def _sorted(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    batch = batch.sort_values("start")
    return batch["start"].to_numpy(np.int64), batch["stop"].fillna(-1).to_numpy(np.int64)


def _chains(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    start, stop = _sorted(batch)
    jump = _pointers(start, stop)
    while not np.array_equal(jump, onward := jump[jump]):
        jump = onward
    return start, stop[jump]


def _followed(batch: pd.DataFrame) -> pd.DataFrame:
    """The candidates on the chain from the span's entry, by pointer doubling."""
    start, stop = _sorted(batch)
    jump = _pointers(start, stop)
    reached = start == batch["entry"].iloc[0]
    while True:
        more = reached.copy()
        more[jump[reached]] = True
        onward = jump[jump]
        if np.array_equal(more, reached) and np.array_equal(onward, jump):
            break
        reached, jump = more, onward
    return pd.DataFrame({"file": batch["file"].iloc[0], "start": start[reached]})


def _reached(offsets: DataFrame, span_bytes: int) -> DataFrame:
    """``file, start`` of the candidates that a chain from the file's start reaches."""
    span = F.floor(F.col("start") / span_bytes).alias("span")
    nodes = stored(offsets.select("file", span, "start", "stop"), "chain-nodes")
    leaving = nodes.groupBy("file", "span").applyInPandas(_leaving, "file string, start bigint, leave bigint")
    leaving = stored(leaving, "chain-leaving")
    # Where a span can be entered: at the file's start, or where a chain leads.
    targets = leaving.select("file", F.col("leave").alias("start")).unionByName(
        leaving.select("file", F.lit(0).cast("bigint").alias("start"))
    )
    hops = stored(leaving.join(targets.distinct(), ["file", "start"]), "chain-hops")
    reached = hops.where("start = 0").select("file", "start")
    known = -1
    while (count := (reached := stored(reached, "chain-reached")).count()) > known:
        known = count
        ahead = hops.join(reached, ["file", "start"]).select("file", F.col("leave").alias("start"))
        reached = reached.unionByName(ahead.join(hops.select("file", "start"), ["file", "start"], "left_semi")).distinct()
        onward = hops.select("file", F.col("start").alias("leave"), F.col("leave").alias("further"))
        hops = stored(
            hops.join(onward, ["file", "leave"], "left").select(
                "file", "start", F.coalesce("further", "leave").alias("leave")
            ),
            "chain-hops",
        )
    entries = reached.select("file", span, F.col("start").alias("entry"))
    # A chain enters a span once: at its first place there.
    entries = entries.groupBy("file", "span").agg(F.min("entry").alias("entry"))
    return (
        nodes.join(entries, ["file", "span"])
        .groupBy("file", "span")
        .applyInPandas(_followed, "file string, start bigint")
    )


def read_archives(
    spark: SparkSession, path: str, payloads: bool = False, span_bytes: int = SPAN_BYTES
) -> DataFrame:
    """``page_id, record_type, refers_to, payload_bytes, payload_digest`` of all
    records, and with ``payloads`` their ``payload`` (NULL for a revisit).

    Of a revisit, bytes and digest are those of the full payload, as its record
    states them. Magic inside a payload starts no record. A record that runs
    past the end of its file is left out, and so is all that lies behind a
    record whose header is damaged: no chain leads there. Files must hold UTF-8.
    """
    offsets = stored(_offsets(spark, path), "offsets")
    real = stored(
        offsets.join(_reached(offsets, span_bytes), ["file", "start"]).where("stop <= file_bytes"),
        "records",
    )
    if payloads:
        return _assembled(spark, path, offsets, real, True)
    broken = real.where(~F.col("whole"))
    whole = real.where("whole").select(*_FIELDS)
    if broken.isEmpty():
        return whole
    return whole.unionByName(_assembled(spark, path, offsets, broken, False))


def _assembled(
    spark: SparkSession, path: str, offsets: DataFrame, records: DataFrame, payloads: bool
) -> DataFrame:
    """Records put together from all their pieces."""
    spans = records.select("file", "start", "stop")
    own = Window.partitionBy("file").orderBy("start", F.desc("record"))
    marked = (
        offsets.join(
            spans.select("file", "start", F.col("start").alias("record"), F.col("stop").alias("record_stop")),
            ["file", "start"],
            "left",
        )
        .select("file", "block", "piece", "start", "record", "record_stop")
        .withColumn("record", F.last("record", ignorenulls=True).over(own))
        .withColumn("record_stop", F.last("record_stop", ignorenulls=True).over(own))
        .where("record IS NOT NULL AND start < record_stop")
    )
    texts = _candidates(spark, path)
    firsts = texts.groupBy("file", "block").agg(F.min("piece").alias("first_piece"))
    pieces = (
        texts.join(firsts, ["file", "block"])
        .withColumn("piece", F.col("piece") - F.col("first_piece"))
        .join(marked, ["file", "block", "piece"])
        .groupBy("file", "record")
        .agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("pieces"))
    )
    whole = F.array_join(F.transform("pieces", lambda p: p["value"]), MAGIC)
    pieces = pieces.select(whole.alias("value"))
    parsed = _parsed(F.col("value"))
    names = (*_FIELDS, "payload") if payloads else _FIELDS
    return pieces.select(*[parsed[f].alias(f) for f in names])
