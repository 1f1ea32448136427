"""WARC archives: written by Spark's text sink, read back by boundary chains.

Writing: a payload of at least `min_revisit` bytes that several records share is stored once, by the record with the smallest
id; the others are revisit records that refer to it.

Reading: every occurrence of the version line is a candidate record, also one inside a payload. Each task turns its part of a
file into candidates with the offset of the record that would follow. A candidate is a record only if the chain of successors
from the start of its file reaches it. Pointer jumping finds these: first within each part, then over the parts' entries, in
as many rounds as the logarithm of the parts of a file. A payload that holds version lines is put together again from its
pieces.

Defined results: a null payload is empty; a null id or address leaves its header out and reads back as null; null ids never
are referred to, and a group without any other id holds responses only; rows that share the smallest id of their payload are
all responses; line breaks in an address are percent-encoded; an empty table gives an archive without records; columns other
than the three named ones are ignored. A damaged record ends the chain of its file.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from isobar.llm.staging import join_counted, staged

VERSION = "WARC/1.1\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GAP = "\r\n\r\n"


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", page.cast("string"), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def with_record_type(pages: DataFrame, page_id: str, url: str, payload: str, min_revisit: int) -> DataFrame:
    """(page, address, payload, digest, first): `first` is the id that a revisit refers to, else null."""
    rows = pages.select(
        F.col(page_id).alias("page"), F.col(url).alias("address"), F.coalesce(F.col(payload), F.lit("")).alias("payload")
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload")})
    repeated = (
        rows.filter(F.col("size") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page").alias("least"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("least").isNotNull())
        .select("digest", "least")
    )
    joined = join_counted(rows, repeated, ["digest"])
    refers = F.when(F.col("least").isNotNull() & ~F.col("least").eqNullSafe(F.col("page")), F.col("least"))
    return joined.withColumn("first", refers).drop("least", "size")


def write_warc(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit: int = 100,
    date: str = "2024-01-01T00:00:00Z",
    records_per_file: int = 200_000,
) -> None:
    """Writes one record per row. Text sinks end each row with a line feed, the last byte of a record."""
    rows = with_record_type(pages, page_id, url, payload, min_revisit)
    again = F.col("first").isNotNull()
    block = F.concat(F.lit(HTTP), F.when(again, F.lit("")).otherwise(F.col("payload")))
    address = F.replace(F.replace("address", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit(VERSION),
        _header("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("page"), F.col("digest"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", address),
        _header("X-Page-Id", F.col("page")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Profile", F.when(again, REVISIT)),
        _header("WARC-Refers-To", F.when(again, _record_id(F.col("first"), F.col("digest")))),
        _header("X-Refers-To-Page-Id", F.col("first")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
    )
    record = rows.select(F.concat(head, block, F.lit(GAP[:-1])).alias("value"))
    record.write.mode("overwrite").option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(folder)


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"(?:^|\n){name}: *([^\r\n]*)", 1)
    return F.when(found != "", found)


def _parse(value: Column) -> dict[str, Column]:
    """Columns of a record whose text after the version line is `value`; made in this order."""
    raw = F.col("value").cast("binary")
    return {
        "head": F.substring_index(value, GAP, 1),
        "head_size": F.octet_length("head"),
        "length": F.expr("try_cast(regexp_extract(head, '(?:^|\\n)Content-Length: *([0-9]{1,18})\\r?(?:\\n|$)', 1) AS BIGINT)"),
        "whole": F.octet_length(value) >= F.col("head_size") + len(GAP) + F.col("length"),
        "block": F.substring(raw, F.col("head_size") + len(GAP) + 1, F.col("length").cast("int")),
        "cover": F.when(
            _field(F.col("head"), "Content-Type").startswith("application/http"),
            F.octet_length(F.substring_index(F.col("block").cast("string"), GAP, 1)) + len(GAP),
        ).otherwise(0),
        "payload": F.substring(F.col("block"), F.col("cover") + 1, F.greatest(F.octet_length("block") - F.col("cover"), F.lit(0))),
        "payload_bytes": F.octet_length("payload").cast("long"),
        "payload_digest": F.sha2("payload", 256),
        "record_type": _field(F.col("head"), "WARC-Type"),
        "url": _field(F.col("head"), "WARC-Target-URI"),
        "page": _field(F.col("head"), "X-Page-Id").cast("long"),
        "refers": _field(F.col("head"), "X-Refers-To-Page-Id").cast("long"),
        "stated": F.regexp_replace(_field(F.col("head"), "WARC-Payload-Digest"), "^sha256:", ""),
    }


def _with(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    for name, column in columns.items():
        df = df.withColumn(name, column)
    return df


FIELDS = ("record_type", "url", "page", "refers", "stated", "payload_bytes", "payload_digest")


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """The text between version lines, with the part of the file it was read in and its order there."""
    read = spark.read.option("lineSep", VERSION).text(folder)
    return read.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("row"),
    )


def _hop(offset: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Place of each candidate's successor in the same sorted part, itself if there is none."""
    at = np.searchsorted(offset, following)
    inside = (at < len(offset)) & (offset[np.minimum(at, len(offset) - 1)] == following)
    return np.where(inside, at, np.arange(len(offset)))


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """Where the chain from each candidate leaves its part."""
    pdf = pdf.sort_values("offset")
    offset, following = pdf["offset"].to_numpy(), pdf["following"].to_numpy()
    jump = _hop(offset, following)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    return pd.DataFrame({"file": pdf["file"], "part": pdf["part"], "offset": offset, "leaves": following[jump]})


def _marked(pdf: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a part that its entries reach."""
    pdf = pdf.sort_values("offset")
    offset = pdf["offset"].to_numpy()
    jump, reached = _hop(offset, pdf["following"].to_numpy()), pdf["entry"].to_numpy().astype(bool)
    while True:
        further = reached.copy()
        further[jump[reached]] = True
        beyond = jump[jump]
        if (further == reached).all() and (beyond == jump).all():
            break
        reached, jump = further, beyond
    return pdf.loc[reached, ["file", "offset"]]


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from offset 0 of their file reaches.

    `candidates` has file, part, offset and following (the offset after the record). A part is what one task read.
    """
    edges = candidates.select("file", "part", "offset", "following").filter("following > offset")
    starts = edges.filter("offset = 0").select("file", "offset")
    parts = edges.groupBy("file").agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()[0] or 0
    if parts > 1:
        exits = (
            edges.groupBy("file", "part")
            .applyInPandas(_exits, "file string, part long, offset long, leaves long")
            .transform(staged)
        )
        targets = exits.select("file", F.col("leaves").alias("offset")).distinct()
        jump = exits.join(targets.union(starts).distinct(), ["file", "offset"], "left_semi").select("file", "offset", "leaves")
        reached = starts
        rounds = math.ceil(math.log2(parts)) + 1
        for k in range(rounds):
            step = jump.join(reached, ["file", "offset"], "left_semi").select("file", F.col("leaves").alias("offset"))
            reached = reached.union(step).distinct()
            if k + 1 < rounds:
                after = jump.select("file", F.col("offset").alias("leaves"), F.col("leaves").alias("beyond"))
                jump = jump.join(after, ["file", "leaves"]).select("file", "offset", F.col("beyond").alias("leaves")).transform(staged)
                reached = reached.transform(staged)
        entries = reached.withColumn("entry", F.lit(True))
        entered = edges.join(entries, ["file", "offset"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    else:
        entered = edges.withColumn("entry", F.col("offset") == 0)
    return entered.groupBy("file", "part").applyInPandas(_marked, "file string, offset long")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: file, offset, type, address, ids, the stated digest, and length and digest of the payload read."""
    size = len(VERSION)
    pieces = _with(_segments(spark, folder), _parse(F.col("value"))).select(
        "file", "part", "row", F.octet_length("value").alias("size"), "head_size", "length", "whole", *FIELDS
    )
    within = Window.partitionBy("file", "part").orderBy("row")
    pieces = pieces.withColumn("before", F.sum(F.col("size") + size).over(within) - F.col("size") - size).transform(staged)
    totals = pieces.groupBy("file", "part").agg(F.sum(F.col("size") + size).alias("total"))
    along = Window.partitionBy("file").orderBy("part")
    base = totals.withColumn("base", F.sum("total").over(along) - F.col("total")).drop("total")
    placed = (
        pieces.join(base, ["file", "part"])
        .withColumn("offset", F.col("base") + F.col("before") - size)
        .filter("offset >= 0")
        .withColumn("following", F.col("offset") + size + F.col("head_size") + 2 * len(GAP) + F.col("length"))
    )
    chain = reachable(placed).withColumn("record", F.lit(True)).transform(staged)
    placed = placed.join(chain, ["file", "offset"], "left")
    records = placed.filter("record").select("file", "offset", "whole", *FIELDS).transform(staged)
    out = records.filter("whole").drop("whole")
    if records.filter("NOT whole").isEmpty():
        return out
    # Pieces after a broken record's first one belong to the last record before them, in this part or an earlier one.
    own = F.max(F.when(F.col("record"), F.col("offset"))).over(Window.partitionBy("file", "part").orderBy("offset"))
    carried = placed.groupBy("file", "part").agg(F.max(F.when(F.col("record"), F.col("offset"))).alias("last"))
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.withColumn("carried", F.max("last").over(earlier)).drop("last")
    broken = records.filter("NOT whole").select("file", F.col("offset").alias("owner"))
    owned = (
        placed.withColumn("own", own)
        .join(carried, ["file", "part"])
        .withColumn("owner", F.coalesce("own", "carried"))
        .join(broken, ["file", "owner"])
        .select("file", "part", "row", "offset", "owner")
    )
    mended = (
        _segments(spark, folder)
        .join(owned, ["file", "part", "row"])
        .groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("pieces"))
        .select(
            "file",
            F.col("owner").alias("offset"),
            F.array_join(F.col("pieces.value"), VERSION).alias("value"),
        )
    )
    mended = _with(mended, _parse(F.col("value"))).filter("whole")
    return out.unionByName(mended.select("file", "offset", *FIELDS))


def pages_from_records(records: DataFrame) -> DataFrame:
    """One row per record, revisits with the length and digest of the payload they refer to."""
    responses = records.filter("record_type = 'response'")
    stored = responses.groupBy(F.col("page").alias("refers"), F.col("payload_digest").alias("stated")).agg(
        F.first("payload_bytes").alias("full")
    )
    revisits = records.filter("record_type = 'revisit'").join(stored, ["refers", "stated"], "left")
    plain = responses.select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "url"
    )
    again = revisits.select(
        F.col("page").alias("page_id"),
        F.col("full").alias("payload_bytes"),
        F.when(F.col("full").isNotNull(), F.col("stated")).alias("payload_digest"),
        "record_type",
        F.col("refers").alias("refers_to"),
        "url",
    )
    return plain.unionByName(again)
