"""Content-addressed WARC archive.

``write_archive`` stores every distinct payload once, in a table keyed by its SHA-256,
and the exact header block of every record in a second table.  ``read_archive`` parses
the stored header blocks, verifies each stored payload once against its digest and joins
the two; ``record_bytes`` rebuilds the original records byte for byte.

Of records with equal payloads of at least ``min_revisit`` bytes the one with the
smallest id is a ``response`` and the others are ``revisit`` records that refer to it;
records with smaller payloads are all responses.

Digests are verified strongly: rows that share a SHA-256 must agree in length and
SHA-512, else the write fails; on reading, each payload is hashed again.

Defined cases: null payloads are empty; null urls give an empty target URI; repeated
rows with the smallest id are all responses (they are the same record); a null id is
written as an empty record id, sorts last and reads back as null; an empty table gives
two empty tables.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import cut_table

MIN_REVISIT = 100
CRLF = "\r\n"
_URN = "urn:page:"


def _header(kind, page, refers, url, date, digest, length):
    """The header block up to and with its empty line; a revisit has no block of its own."""
    def line(name, value):
        return F.concat(F.lit(name + ": "), value, F.lit(CRLF))

    # A line break inside a url would end the header field: it is percent-encoded.
    uri = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<" + _URN), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", date), line("WARC-Target-URI", uri), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(kind == "revisit", F.concat(
            line("WARC-Refers-To", F.concat(F.lit("<" + _URN), refers.cast("string"), F.lit(">"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(kind == "revisit", F.lit(0).cast("long")).otherwise(length).cast("string")),
        F.lit(CRLF))


def write_archive(records: DataFrame, path: str, record_id: str = "page_id", url: str = "url",
                  payload: str = "html", min_revisit: int = MIN_REVISIT, date: str | None = None) -> None:
    """Write ``path/payloads`` (digest, payload) and ``path/headers`` (digest, header).

    ``date`` names a timestamp column for WARC-Date; without it, or where it is null, the time of writing stands.
    """
    raw = F.coalesce(F.encode(F.col(payload), "UTF-8"), F.to_binary(F.lit(""), F.lit("utf-8")))
    at = F.coalesce(F.col(date), F.current_timestamp()) if date else F.current_timestamp()
    at = F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rec = records.select(F.col(record_id).alias("id"), F.col(url).alias("url"), at.alias("date"), raw.alias("payload"))
    rec = rec.withColumns({"digest": F.sha2("payload", 256), "check": F.sha2("payload", 512),
                           "bytes": F.length("payload").cast("long")})
    narrow = cut_table(rec.drop("payload"), "warc-records")
    # Pre-aggregated map-side: a hot payload costs one row per task.
    groups = narrow.groupBy("digest").agg(
        F.min("id").alias("first_id"), F.min("bytes").alias("bytes"),
        (F.min(F.struct("check", "bytes")) == F.max(F.struct("check", "bytes"))).alias("same"))
    groups = cut_table(groups, "warc-groups")
    if not groups.where(~F.col("same")).isEmpty():
        raise ValueError("two payloads share a SHA-256 digest")
    # One copy of each payload: the row of the first id.  Digest and id are the join keys, so the copies of a hot
    # payload are spread by their ids, and the same shuffle serves the choice of one row per key.
    def keyed(df, id_):
        return df.withColumns({"key": F.coalesce(F.col(id_).cast("string"), F.lit("")), "no_id": F.col(id_).isNull()})

    keys = ["digest", "key", "no_id"]
    keep = keyed(rec.select("id", "digest", "payload"), "id").drop("id").join(
        keyed(groups.select("digest", "first_id"), "first_id").select(*keys), keys)
    keep.dropDuplicates(keys).select("digest", "payload").write.parquet(f"{path}/payloads")
    h = narrow.join(groups.select("digest", "first_id"), "digest")
    revisit = (F.col("bytes") >= min_revisit) & ~F.col("id").eqNullSafe(F.col("first_id"))
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    h.select("digest", _header(kind, F.col("id"), F.col("first_id"), F.col("url"), F.col("date"), F.col("digest"), F.col("bytes"))
             .alias("header")).write.parquet(f"{path}/headers")


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    h = spark.read.schema("digest string, header string").parquet(f"{path}/headers")
    def field(name, pattern="([^\\r\\n]*)"):
        return F.regexp_extract("header", rf"(?m)^{name}: {pattern}\r?$", 1)

    def page(name):
        return F.nullif(field(name, f"<{_URN}([^>]*)>"), F.lit("")).cast("long")

    return h.select("digest", "header", page("WARC-Record-ID").alias("page_id"), field("WARC-Target-URI").alias("url"),
                    field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
                    field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("payload_digest"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, header.

    Length and digest come from the stored payload, hashed again once per payload; a
    record whose payload is missing or differs from its digest raises.
    """
    stored = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads").select(
        F.col("digest").alias("d"), F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("found"))
    j = _parsed(spark, path).join(stored, F.col("payload_digest") == F.col("d"), "left")
    ok = F.col("found").eqNullSafe(F.col("payload_digest"))
    digest = F.when(ok, F.col("found")).otherwise(F.raise_error(F.lit("payload missing or damaged")))
    return j.select("page_id", "url", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to", "header")


def record_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record): each record as stored in a WARC file; revisits have an empty block."""
    p = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    j = _parsed(spark, path).join(p.withColumnRenamed("digest", "d"), F.col("payload_digest") == F.col("d"), "left")
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    end = F.lit((CRLF * 2).encode())
    return j.select("page_id", F.concat(F.encode("header", "UTF-8"), body, end).alias("record"))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload) of every record, revisits resolved through the payload table."""
    p = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    j = _parsed(spark, path).join(p.withColumnRenamed("digest", "d"), F.col("payload_digest") == F.col("d"))
    return j.select("page_id", "payload")
