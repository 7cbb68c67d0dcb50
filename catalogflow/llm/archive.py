"""Content-addressed web archive: payload bytes once, record headers apart.

``write_archive`` stores each distinct payload under its SHA-256 and the exact
header bytes of every record in a second table; ``read_archive`` joins them
back to whole records and checks every payload against its digest.
``export_warc`` writes plain WARC files and ``read_warc`` parses such files.
"""

import re

from pyspark.sql import functions as F

from catalogflow.session import scratch_path

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _uuid(*parts):
    h = F.md5(F.concat_ws("\n", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _line(name, value):
    """A header line, or nothing for null; line ends in the value are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _described(pages, id_col, url_col, payload_col):
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), F.length(payload).cast("long").alias("bytes"),
    )


def records(pages, least=100, date="2024-01-01T00:00:00Z", id_col="page_id", url_col="url", payload_col="html"):
    """The header of each page's record, without payloads.

    Of equal payloads of at least ``least`` bytes the record of the smallest id
    is the response and the others revisit it; smaller ones are all responses.
    A null payload is empty, a null id counts as the largest and a null url
    leaves out its line. Of repeated rows (equal id and payload) one is the
    response. Groups of any size are combined in the map tasks.
    """
    rows = _described(pages, id_col, url_col, payload_col).drop("payload").withColumn(
        "copy", F.monotonically_increasing_id())
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "copy")
    first = rows.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min(order).alias("head"))
    name = _uuid(F.lit("record"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("copy").cast("string"),
                 F.col("digest"))
    head = _uuid(F.lit("record"), F.coalesce(F.col("head.page_id").cast("string"), F.lit("")),
                 F.col("head.copy").cast("string"), F.col("digest"))
    joined = rows.join(first, "digest", "left")
    again = F.col("head.copy").isNotNull() & (F.col("head.copy") != F.col("copy"))
    lines = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", name), _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(again, head)), _line("WARC-Profile", F.when(again, F.lit(REVISIT))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", (F.lit(len(HTTP_HEAD)) + F.when(again, F.lit(0)).otherwise(F.col("bytes"))).cast("string")),
        F.lit("\r\n"), F.lit(HTTP_HEAD),
    )
    return joined.select("digest", (~again).alias("has_payload"), lines.alias("header"))


def write_archive(pages, path=None, least=100, **columns):
    """Write the tables ``headers`` and ``payloads`` of the archive; returns its path."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archive")
    names = {"id_col": "page_id", "url_col": "url", "payload_col": "html"} | columns
    records(pages, least, **names).write.parquet(f"{path}/headers")
    # one row per digest: equal payloads meet before the shuffle
    rows = _described(pages, **names)
    rows.groupBy("digest").agg(F.min("payload").alias("payload")).write.parquet(f"{path}/payloads")
    return path


def read_archive(spark, path):
    """Whole records out of an archive: (digest, header, record bytes)."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    own, other = headers.filter("has_payload"), headers.filter("not has_payload")
    whole = own.join(payloads, "digest").select(
        "digest", F.concat(F.col("header").cast("binary"), F.col("payload")).alias("record"))
    return whole.unionByName(other.select("digest", F.col("header").cast("binary").alias("record")))


def parse_records(found):
    """Fields of record bytes (column ``record``), each payload checked against its digest.

    Returns page_id, record_id, record_type, refers_id, payload_digest, payload
    and payload_bytes; a revisit has no payload of its own.
    """
    end = F.expr("position(X'0D0A0D0A' IN record)")
    rows = found.withColumn("_end", end).withColumn("_head", F.expr("cast(substring(record, 1, _end + 1) as string)"))

    def field(name):
        got = F.regexp_extract("_head", rf"(?md)^{name}: (.*?)\r$", 1)
        return F.when(got != "", got)

    length = field("Content-Length").cast("int")
    rows = rows.withColumns({"_block": F.expr("substring(record, _end + 4)"), "_length": length})
    payload = F.expr(f"substring(_block, {len(HTTP_HEAD) + 1})")
    rows = rows.select(
        field("WARC-Page-ID").cast("long").alias("page_id"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Type").alias("record_type"), field("WARC-Refers-To").alias("refers_id"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("payload_digest"),
        F.when(F.length("_block") == F.col("_length"), payload).alias("payload"),
    )
    whole = (F.col("record_type") != "response") | (F.sha2("payload", 256) == F.col("payload_digest"))
    checked = F.when(F.coalesce(whole, F.lit(False)), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record "), F.col("record_id"))).cast("binary"))
    return rows.withColumn("payload", checked).withColumn("payload_bytes", F.length("payload").cast("long"))


def resolved(parsed):
    """One row per record; a revisit gets the length of the payload that it refers to, and the page that holds it."""
    own = parsed.filter("record_type = 'response'")
    heads = own.select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), "payload_bytes")
    kept = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    again = parsed.filter("record_type = 'revisit'").drop("payload_bytes").join(heads, "refers_id")
    return own.withColumn("refers_to", F.lit(None).cast("long")).select(*kept).unionByName(again.select(*kept))


def export_warc(found, path):
    """Write records as WARC files; the records are text, as their payloads are UTF-8."""
    found.select(F.col("record").cast("string")).write.option("lineSep", "\r\n\r\n").text(path)


def _split(batches):
    import pyarrow as pa

    for batch in batches:
        for content in batch.column("content").to_pylist():
            at, out = 0, []
            while at < len(content):
                end = content.index(b"\r\n\r\n", at)
                size = int(re.search(rb"(?mi)^Content-Length: (\d+)", content[at:end])[1])
                out.append(content[at : end + 4 + size])
                at = end + 4 + size + 4
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def read_warc(spark, path):
    """Record bytes of all WARC files below a path; a file is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_split, "record binary")
