"""Content-addressed web archive: payloads once by digest, record headers apart.

An archive is two Parquet tables in one folder. ``payloads`` has each payload once, under its
SHA-256; ``headers`` has a row per record with the exact bytes of its WARC header and the
digest that it points to. Records are put together again by a join on the digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
CONVERTED_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex_digest: Column) -> Column:
    """Base-32 text of a 40-digit hexadecimal digest; 10 hex digits make 8 of base 32."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 1 + at, 10), 16, 32), 8, "0")
             for at in range(0, 40, 10)]
    return F.translate(F.concat(*parts), CONVERTED_DIGITS, BASE32_DIGITS)


def page_order() -> Column:
    """Sorts pages by id, those without one last; ties by address."""
    return F.struct(F.col("page_id").isNull().alias("unnamed"), F.col("page_id"),
                    F.coalesce("url", F.lit("")).alias("at"))


def one_line(text: Column) -> Column:
    """Line ends of an address percent-encoded, so that it stays one header field."""
    return F.replace(F.replace(text, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def record_header() -> Column:
    """WARC header block of a row with digests, type and length."""
    lines = [F.lit("WARC/1.1"),
             F.concat(F.lit("WARC-Type: "), F.col("record_type")),
             F.concat(F.lit("WARC-Record-ID: <urn:page:"),
                      F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">")),
             F.concat(F.lit("WARC-Target-URI: "), one_line(F.col("url"))),
             F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to"), F.lit(">")),
             F.when(F.col("record_type") == "revisit", F.lit(
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                 "identical-payload-digest")),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
             F.lit("Content-Type: text/html; charset=utf-8"),
             F.concat(F.lit("Content-Length: "), F.when(
                 F.col("record_type") == "revisit", F.lit(0)).otherwise(
                     F.col("payload_bytes")).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF)).cast("binary")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Archive every row of ``pages(page_id, url, html)`` under ``path``.

    The payload is the html in UTF-8, a null one empty. Of records with equal payloads of at
    least ``min_bytes`` bytes the one with the smallest page_id (null last, ties by url) is a
    response and the others refer to it; smaller payloads are all responses. Rows equal in id,
    url and html are all responses. Extra columns are ignored; no rows make empty tables.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        payload.alias("payload"))
    keyed = rows.withColumns({"sha256": F.sha2("payload", 256),
                              "sha1": F.sha1("payload"),
                              "payload_bytes": F.octet_length("payload").cast("long")})
    key = ["sha256", "sha1", "payload_bytes"]
    keyed.groupBy(*key).agg(F.first("payload").alias("payload")).write.parquet(
        f"{path}/payloads")
    heads = keyed.drop("payload")
    firsts = (heads.where(F.col("payload_bytes") >= min_bytes).groupBy("sha256")
              .agg(F.min(page_order()).alias("first")))
    typed = (heads.join(firsts, "sha256", "left")
             .withColumn("again", F.col("first").isNotNull() & (F.col("first") != page_order()))
             .select("page_id", "url", "sha256", "payload_bytes",
                     base32(F.col("sha1")).alias("payload_digest"),
                     F.when(F.col("again"), "revisit").otherwise("response")
                     .alias("record_type"),
                     F.when(F.col("again"), F.col("first.page_id")).cast("string")
                     .alias("refers_to")))
    typed.select("page_id", "url", "sha256", record_header().alias("header")).write.parquet(
        f"{path}/headers")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads; one whose bytes do not have the digest it is stored under ends the
    job with an error."""
    stored = spark.read.parquet(f"{path}/payloads")
    return stored.withColumn("payload", F.when(
        F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256")))))


def header_field(name: str) -> Column:
    return F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per archived record, from the stored headers and the stored payloads:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    found = read_payloads(spark, path).select(
        "sha256", F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"))
    refers = F.regexp_extract(header_field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1)
    heads = spark.read.parquet(f"{path}/headers").select(
        "page_id", "sha256", header_field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"))
    return heads.join(found, "sha256").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, record, payload``: the exact record bytes, and the full payload also
    of a revisit."""
    rows = spark.read.parquet(f"{path}/headers").join(read_payloads(spark, path), "sha256")
    body = F.when(header_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(
        F.col("payload"))
    end = F.lit((CRLF + CRLF).encode())
    return rows.select("page_id", "url", F.concat("header", body, end).alias("record"),
                       "payload")
