"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

Writing: one record per page. Of pages with equal payloads the one with the least id becomes a
response, the others revisits that refer to it. A record ends in an empty line, which the writer
adds as its line separator; files are as large as the input's partitions.

Reading: archives are split at every occurrence of the version line, wherever it stands, so any
part of a file can be read by any task. Each piece that parses as a header is a candidate record
and points to the offset where its successor must start. From offset 0 of each file the candidates
are followed by pointer jumping: in round k every candidate knows its 2^k-th successor, and the
reached set doubles. What is not reached is text inside a payload and is put back into the record
that holds it.

Payloads never meet in a shuffle: only offsets do, and the pieces of records that hold the version
line. Lists that are joined to payloads are broadcast when the plan proves them small.

Defined cases: null html is an empty payload; a null id is written empty and read back as null;
null urls are empty, line ends in urls are dropped; rows that repeat the least id of a payload are
all responses; an empty table gives no rows. A chain that breaks (a damaged file) ends there.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import in_batches, table
from tidemart.operators.relational import broadcast_if_small
from tidemart.session import shared_dir, written

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*(\d{1,18})[ \t]*\r?$")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each 5 hex digits make 4 characters."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               body_col: str = "html", least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row. Payloads below `least_bytes` are never revisits."""
    rows = pages.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(body_col), F.lit("")).alias("body"))
    rows = rows.withColumn("digest", base32_sha1(F.col("body").cast("binary"))).withColumn(
        "bytes", F.octet_length("body"))
    copies = written(
        rows.where(F.col("bytes") >= least_bytes).groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("id").alias("first"), F.count("*").alias("_n")).where("_n > 1").drop("_n"), "copies")
    rows = rows.join(
        broadcast_if_small(copies),
        (F.col("digest") == F.col("_digest")) & (F.col("bytes") >= least_bytes), "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    line = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.regexp_replace("url", "[\r\n]", ""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nWARC-Payload-Length: "), F.col("bytes").cast("string"),
        F.when(again, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  "\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">")))
        .otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(again, "0").otherwise(F.col("bytes").cast("string")), F.lit(END),
        F.when(again, "").otherwise(F.col("body")))
    rows.select(line.alias("value")).write.option("lineSep", END).text(path)


def _pieces(keep_bytes: bool):
    """Header and extent of every piece, in the order of its split."""
    names = ["file", "block", "local", "size", "reach", "header", "body"]

    def run(batches):
        at, where = 0, None
        for batch in batches:
            rows = []
            for file, block, value in zip(*(batch.column(n).to_pylist() for n in ("file", "block", "value"))):
                if (file, block) != where:
                    at, where = 0, (file, block)
                value = value or b""
                head = value.find(b"\r\n\r\n")
                found = _LENGTH.search(value, 0, head + 2) if head >= 0 else None
                reach = len(MAGIC) + head + 4 + int(found[1]) + 4 if found else None
                whole = reach == len(MAGIC) + len(value) and value.endswith(b"\r\n\r\n")
                rows.append((
                    file, block, at, len(value), reach, value[:head] if keep_bytes and whole else None,
                    (value[head + 4:-4] if whole else value) if keep_bytes else None))
                at += len(value) + len(MAGIC)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return run


def _read(spark: SparkSession, path: str, keep_bytes: bool) -> DataFrame:
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))
    return in_batches(raw).mapInArrow(
        _pieces(keep_bytes), "file long, block long, local long, size long, reach long, header binary, body binary")


def reached(candidates: DataFrame) -> DataFrame:
    """file, offset, next -> file, offset of the candidates on the chain from offset 0."""
    jump = candidates.select("file", "offset", F.col("next").alias("to"))
    found = candidates.where(F.col("offset") == 0).select("file", "offset")
    while True:
        ends = jump.select(F.col("file").alias("_f"), F.col("offset").alias("_o"), F.col("to").alias("_to"))
        found = written(found.union(
            found.join(ends, (F.col("file") == F.col("_f")) & (F.col("offset") == F.col("_o")))
            .select("file", F.col("_to").alias("offset"))), "reached")
        jump = written(jump.join(ends, (F.col("file") == F.col("_f")) & (F.col("to") == F.col("_o"))).select(
            "file", "offset", F.col("_to").alias("to")), "jumps")
        if jump.isEmpty():
            break
    return found.join(candidates.select("file", "offset"), ["file", "offset"], "left_semi").distinct()


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """header (string), body (binary) of every verified record."""
    tune_pieces = _read(spark, path, False).drop("header", "body")
    pieces = written(tune_pieces, "warc-pieces")
    size = F.col("size") + len(MAGIC)
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = written(  # one row per split
        pieces.groupBy("file", "block").agg(F.sum(size).alias("bytes"))
        .select(F.col("file").alias("_file"), F.col("block").alias("_block"),
                F.coalesce(F.sum("bytes").over(upto), F.lit(0)).alias("_before")), "warc-blocks")
    placed = pieces.join(
        broadcast_if_small(blocks), (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    ).select("file", "block", "local", "size", "reach", (F.col("_before") + F.col("local") - len(MAGIC)).alias("offset"))
    candidates = written(
        placed.where((F.col("offset") >= 0) & F.col("reach").isNotNull())
        .withColumn("next", F.col("offset") + F.col("reach")), "warc-candidates")
    true = written(reached(candidates).select(
        F.col("file").alias("_f"), F.col("offset").alias("_o"), F.lit(True).alias("_true")), "warc-true")
    # Pieces that are not a whole verified record: inside payloads, or cut by the version line.
    odd = written(
        placed.where(F.col("offset") >= 0)
        .join(true, (F.col("file") == F.col("_f")) & (F.col("offset") == F.col("_o")), "left")
        .where(F.col("_true").isNull() | (F.col("reach") != F.col("size") + len(MAGIC)))
        .select(F.col("file").alias("_f"), F.col("block").alias("_b"), F.col("local").alias("_l"),
                F.col("offset").alias("_o"), F.coalesce("_true", F.lit(False)).alias("_starts"), "reach"), "warc-odd")
    full = _read(spark, path, True).drop("reach").join(
        broadcast_if_small(odd),
        (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")) & (F.col("local") == F.col("_l")), "left")
    whole = full.where(F.col("_o").isNull() & F.col("header").isNotNull()).select(
        F.col("header").cast("string").alias("header"), "body")
    end = F.lit(END).cast("binary")
    parts = full.where(F.col("_o").isNotNull()).select(
        "file", "_o", "_starts", "reach",
        F.when(F.col("header").isNull(), F.col("body")).otherwise(
            F.concat("header", end, "body", end)).alias("bytes"))
    owner = Window.partitionBy("file").orderBy("_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = (
        parts.withColumn("_owner", F.max(F.when(F.col("_starts"), F.col("_o"))).over(owner))
        .where(F.col("_owner").isNotNull()).groupBy("file", "_owner")
        .agg(F.max(F.when(F.col("_starts"), F.col("reach"))).alias("reach"),
             F.sort_array(F.collect_list(F.struct("_o", "bytes"))).alias("all"))  # one record's pieces
        .select((F.col("reach") - len(MAGIC)).cast("int").alias("length"), F.aggregate(
            F.slice("all", F.lit(2), F.size("all")), F.get("all", F.lit(0))["bytes"],
            lambda a, x: F.concat(a, F.lit(MAGIC).cast("binary"), x["bytes"])).alias("bytes"))
    )

    def cut(batches):
        for batch in batches:
            rows = [(b[:n].split(b"\r\n\r\n", 1)) for n, b in zip(
                batch.column("length").to_pylist(), batch.column("bytes").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0].decode("utf-8", "replace") for r in rows], pa.string()),
                 pa.array([r[1][:-4] for r in rows], pa.binary())], ["header", "body"])

    return whole.union(joined.mapInArrow(cut, "header string, body binary"))


def field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = shared_dir(spark, "warc")
    write_warc(pages, path)
    id_type = pages.schema["page_id"].dataType
    records = read_warc(spark, path).withColumn("_type", field("WARC-Type"))
    revisit = F.col("_type") == "revisit"

    def page(name: str) -> Column:
        return F.nullif(F.regexp_extract(field(name), "^<urn:page:(.*)>$", 1), F.lit("")).cast(id_type)

    return records.select(
        page("WARC-Record-ID").alias("page_id"),
        F.when(revisit, field("WARC-Payload-Length").cast("long"))
        .otherwise(F.octet_length("body").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", ""))
        .otherwise(base32_sha1(F.col("body"))).alias("payload_digest"),
        F.col("_type").alias("record_type"),
        F.when(revisit, page("WARC-Refers-To")).alias("refers_to"))


OP4_SQL = """
WITH d AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), b AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(32),
    lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(hex, 5 * (k // 4) + 1, 5) AS BIGINT)
      >> (15 - 5 * (k % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = min(page_id) OVER p THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = min(page_id) OVER p THEN NULL ELSE min(page_id) OVER p END AS refers_to
FROM b WINDOW p AS (PARTITION BY payload_digest)
"""
