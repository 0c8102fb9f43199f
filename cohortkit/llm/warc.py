"""Content-addressed WARC archive.

``write_archive`` keeps two tables: ``blobs`` (digest, payload), every payload
once under its SHA-256, and ``headers`` (header, digest), the exact header
block of every record.  ``read_archive`` joins them back, recomputes each
digest and fails on the first payload that does not match.  ``export_warc``
writes the records as ordinary ``.warc.gz`` text parts.

Shuffles: ids and digests once to find the first record of each digest; the
payloads of first records only (the others never leave their scan); and the
stored payloads once when read.  A digest that very many records share is
one row of ``blobs`` and skews only the small header side, which adaptive
execution splits.

Defined cases: a null payload is empty; a null id gives a record without an
id (and never a smaller one than any id); repeated rows give one record each
and all rows with the smallest id are responses; a null URL leaves its header
line out; line breaks in a URL become spaces; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_key, stored

#: Fixed values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def _header(first_id: str, revisit: Column, date: str) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    uri = F.translate("url", "\r\n", "  ")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        F.when(F.col("id").isNotNull(), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("id"), F.lit(">")))).otherwise(""),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", uri)).otherwise(""),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                                 line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col(first_id), F.lit(">"))))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    )


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages``.  Of records with equal payloads of
    at least ``min_revisit_bytes``, the one with the smallest id is a response
    and the others are revisits of it; shorter ones are all responses."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("bigint"), "row_key": id_key("id")})
    first = stored(rows.groupBy("digest").agg(F.min("id").alias("first_id")), "warc-first")

    # The join and the removal of repeated rows share one dealing of the payloads by (digest, id).
    keep = first.select("digest", id_key("first_id").alias("row_key"))
    (rows.select("digest", "row_key", "payload").join(keep, ["digest", "row_key"]).dropDuplicates(["digest", "row_key"])
     .select("digest", "payload").write.option("compression", "zstd").parquet(f"{path}/blobs"))

    revisit = (F.col("bytes") >= min_revisit_bytes) & F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    (rows.select("id", "url", "digest", "bytes").join(first, "digest")
     .select("digest", F.col("bytes"), _header("first_id", revisit, date).alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``header, payload, digest`` of every record, payloads joined back and verified."""
    headers = spark.read.parquet(f"{path}/headers")
    blobs = spark.read.parquet(f"{path}/blobs")
    ok = F.col("payload").isNotNull() & (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("bytes"))
    whole = headers.join(blobs, "digest", "left")
    return whole.select("header", F.when(ok, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("payload"))


def header_field(name: str, header: str = "header") -> Column:
    """The value of one header line, null where the line is absent."""
    return F.nullif(F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)", 1), F.lit(""))


def parse_records(records: DataFrame) -> DataFrame:
    """Per record of ``read_archive``: its id, type and reference from the header, size and digest from the payload."""
    urn = lambda name: F.regexp_extract("header", rf"\r\n{name}: <urn:page:([^>]*)>", 1)
    return records.select(
        F.nullif(urn("WARC-Record-ID"), F.lit("")).cast("bigint").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        F.nullif(urn("WARC-Refers-To"), F.lit("")).cast("bigint").alias("refers_to"),
        header_field("WARC-Target-URI").alias("target_uri"))


def export_warc(records: DataFrame, out: str) -> None:
    """The records as gzipped WARC parts: header, blank line, payload (none for a revisit), blank lines."""
    body = F.when(header_field("WARC-Type") == "revisit", F.lit("")).otherwise(F.col("payload").cast("string"))
    (records.select(F.concat("header", F.lit(CRLF), body).alias("value"))
     .write.option("lineSep", CRLF * 2).option("compression", "gzip").text(out))
