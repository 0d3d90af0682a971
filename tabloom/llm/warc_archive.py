"""Content-addressed WARC archive.

A payload is stored once, under a SHA-256 digest that is computed again on reading; the exact header of every
record is kept in a table of its own. Reading joins headers with payloads and puts the records back together byte by byte.
Records with equal payloads of at least ``min_bytes`` have one response, the others are revisits that refer to it; shorter ones are all responses.
Grouping is an aggregation over (SHA-256, SHA-1, length) with one number per group, so a payload with any number
of copies collapses before the shuffle.

Defined cases: a null html is the empty payload; a null url leaves ``WARC-Target-URI`` out; whatever may pass for a line break in a url is
percent-encoded in the header; a null id never becomes the response of a group that has another id, and a group of null ids only is all responses; of
rows that repeat id and payload one is the response and the others are revisits of it; empty tables give an
empty archive; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
#: Characters that some reader takes for the end of a line.
BREAKS = "\n\v\f\r\x1c\x1d\x1e\x85\u2028\u2029"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: four groups of 40 bits, eight digits each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write ``path``/headers and ``path``/payloads."""
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "utf-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    facts = rows.select(
        "id", "url", F.sha2("payload", 256).alias("sha256"), base32_sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes")
    )
    key = ["sha256", "sha1", "n_bytes"]
    # one row per payload; repeated (id, url) rows travel as a count
    first = facts.groupBy(*key).agg(F.max(F.struct("id", "url")).alias("first"))
    told = facts.groupBy(*key, "id", "url").agg(F.count("*").alias("copies")).join(first, key)
    leads = (F.col("id") == F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url"))
    told = told.withColumn("response", F.col("first.id"))
    records = told.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    answer = (F.col("n_bytes") < min_bytes) | F.col("response").isNull() | (leads & (F.col("copy") == 1))
    records = records.withColumn("kind", F.when(F.coalesce(answer, F.lit(False)), "response").otherwise("revisit"))
    records.select("id", "sha256", _header(date).alias("header")).write.parquet(f"{path}/headers")
    rows.select(F.sha2("payload", 256).alias("sha256"), "payload").dropDuplicates(["sha256"]).write.parquet(f"{path}/payloads")


def _record_id(value: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), value.cast("string"), F.lit(">"))


def _header(date: str) -> Column:
    clean = F.col("url")
    for c in BREAKS:
        clean = F.replace(clean, F.lit(c), F.lit("".join(f"%{b:02X}" for b in c.encode())))
    revisit = F.col("kind") == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("kind")),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(_record_id(F.col("id")), F.lit("<urn:page:>"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), clean),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("response")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("Content-Length: "), F.col("n_bytes").cast("string")),
    ]
    return F.concat(F.array_join(F.array(*lines), CRLF), F.lit(CRLF + CRLF))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records put back together: id, header, payload, record (the exact bytes). A payload that its digest doesn't fit ends the read."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    sound = F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not fit its digest "), F.col("sha256"))).cast("binary")
    )
    joined = headers.join(payloads.select("sha256", sound.alias("payload")), "sha256")
    record = F.concat(F.encode("header", "utf-8"), F.col("payload"), F.encode(F.lit(CRLF + CRLF), "utf-8"))
    return joined.select("id", "header", "payload", record.alias("record"))


def header_field(name: str, header: Column) -> Column:
    """A field's value, null if there is none or it is empty; lines end at CRLF and nowhere else."""
    start = f"{name}: "
    line = F.get(F.filter(F.split(header, CRLF), lambda x: x.startswith(start)), F.lit(0))
    return F.nullif(F.substring(line, F.lit(len(start) + 1), F.length(line)), F.lit(""))


def page_of(record_id: Column) -> Column:
    return F.nullif(F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1), F.lit("")).cast("long")


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Per record, from its reconstructed bytes: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    whole = read_archive(spark, path)
    # the payload is cut out of the record by its Content-Length
    length = header_field("Content-Length", F.col("header")).cast("int")
    cut = F.substring(F.col("record"), F.octet_length(F.encode("header", "utf-8")) + 1, length)
    got = whole.select("header", cut.alias("payload"))
    digest = base32_sha1(F.col("payload"))
    stated = F.regexp_replace(header_field("WARC-Payload-Digest", F.col("header")), "^sha1:", "")
    return got.select(
        page_of(header_field("WARC-Record-ID", F.col("header"))).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(digest == stated, digest).otherwise(F.raise_error(F.lit("a record's digest does not fit its payload")).cast("string")).alias("payload_digest"),
        header_field("WARC-Type", F.col("header")).alias("record_type"),
        page_of(header_field("WARC-Refers-To", F.col("header"))).alias("refers_to"),
    )
