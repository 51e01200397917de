"""A content-addressed WARC archive: payload bytes once by digest, exact record headers beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm.common import join_groups, shuffle_partitions
from shelfline.session import materialize

# RFC 4648 base32 letters, and the digits that conv() writes in base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

# Fixed value: the revisit profile of WARC 1.1.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_sha1(hexed: Column) -> Column:
    """Upper-case base32 of a SHA-1 given in hex: five hex digits are four base32 digits."""
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), CONV32, BASE32)


def _record_id(page_id: Column, row: Column) -> Column:
    """An id of its own for every record, also of pages that share their page_id."""
    h = F.md5(F.concat_ws(":", F.lit("page"), F.coalesce(page_id.cast("string"), F.lit("null")), row.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(date: str) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    # a line break inside a URL would end the header line
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\r\n]", "")
    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("row"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit(REVISIT_PROFILE)),
            line("WARC-Refers-To", _record_id(F.col("first_id"), F.col("first.row"))),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit("\r\n"),
    )


def write_archive(pages: DataFrame, archive: str, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes the tables ``<archive>_headers`` and ``<archive>_payloads``.

    Payloads are the html in UTF-8.  Equal means equal SHA-256, SHA-1 and length.
    Of equal payloads of ``min_revisit_bytes`` or more, the record of the largest
    page_id is a response and the others revisit it; smaller ones are all
    responses.  A payload is reduced to one copy per task before it moves, so
    thousands of copies, or an empty page that a third of all rows share, do not
    meet in one task.  Payloads are bucketed by digest as they leave that shuffle; headers hold the page's own facts.

    Null html is the empty payload and null url the empty address.  A null
    page_id is smaller than all others; rows that repeat give a record each, with an
    id of its own, of which one stays the response.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", html.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    (
        keyed.groupBy("digest").agg(F.first("payload").alias("payload"))
        .write.format("parquet").option("compression", "zstd")
        .bucketBy(shuffle_partitions(spark), "digest").sortBy("digest").saveAsTable(f"{archive}_payloads")
    )
    rows = materialize(keyed.select(
        "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_of_sha1(F.sha1("payload")).alias("payload_digest"), F.monotonically_increasing_id().alias("row"),
    ))
    same = ["digest", "payload_digest", "payload_bytes"]
    first = materialize(rows.groupBy(*same).agg(F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("copies")))
    small = F.col("payload_bytes") < min_revisit_bytes
    records = join_groups(rows, first, same, "copies").withColumns({
        "first_id": F.col("first.page_id"),
        "record_type": F.when(small | (F.col("row") == F.col("first.row")), "response").otherwise("revisit"),
    })
    records.select(
        "page_id", F.when(F.col("record_type") == "revisit", F.col("first_id")).alias("refers_to"),
        "digest", _header(date).alias("header"),
    ).write.format("parquet").option("compression", "zstd").saveAsTable(f"{archive}_headers")


def _with_payloads(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """Headers with their payloads, whatever share of them has one digest.

    Most meet in the buckets of the payloads, which do not move.  Digests with more than a thousandth of all
    headers (fewer than 1,000) are dealt into parts of about that many headers, and their payloads are copied for each part.
    """
    sizes = headers.groupBy("digest").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = materialize(sizes.filter(F.col("n") * 1000 > total).select(
        "digest", F.ceil(F.col("n") * 1000 / F.lit(max(total, 1))).cast("int").alias("parts")))
    hot = F.broadcast(hot)
    cold = headers.join(hot, "digest", "left_anti").join(payloads.hint("merge"), "digest", "left")
    dealt = headers.join(hot, "digest").withColumn("part", F.pmod(F.xxhash64("header"), F.col("parts")).cast("int")).drop("parts")
    copied = payloads.join(hot, "digest").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    # not broadcast: a payload may be of any size
    return dealt.join(copied.hint("merge"), ["digest", "part"]).drop("part").unionByName(cold)


def read_archive(spark: SparkSession, archive: str) -> DataFrame:
    """Every record again: page_id, header, payload, record, and what the header says.

    ``record`` is the exact WARC record; ``payload`` is the full payload, of
    revisits too.  A payload that does not have the header's digest raises an error.
    """
    headers, payloads = spark.table(f"{archive}_headers"), spark.table(f"{archive}_payloads")
    rows = _with_payloads(headers, payloads)

    def field(name: str) -> Column:
        return F.regexp_extract("header", f"\r\n{name}: ([^\r\n]*)\r\n", 1)

    rows = rows.withColumns({
        "record_type": field("WARC-Type"), "payload_digest": F.substring(field("WARC-Payload-Digest"), 6, 32),
        "block_bytes": field("Content-Length").cast("long"),
    })
    sound = F.coalesce(base32_of_sha1(F.sha1("payload")) == F.col("payload_digest"), F.lit(False)) & (
        (F.col("record_type") == "revisit") | (F.col("block_bytes") == F.octet_length("payload")))
    block = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    checked = F.when(sound, F.octet_length("payload").cast("long")).otherwise(
        F.raise_error(F.lit("a payload of the archive does not match its header")).cast("long"))
    return rows.select(
        "page_id", "header", "payload", F.concat(F.col("header").cast("binary"), block, F.lit("\r\n\r\n").cast("binary")).alias("record"),
        checked.alias("payload_bytes"), "payload_digest", "record_type", "refers_to",
    )
