"""WARC archives: writing, reading, and replacing repeated payloads by revisit records.

Archives are folders of gzip files. Spark's text writer writes them, one row per record,
with the two line ends that close a WARC record as its line separator; so retried tasks
and any file system are Spark's business. They are read as whole files and cut by
Content-Length, a record at a time, so payloads may contain anything.

Revisit resolution: only headers (place, page, digest, length) are shuffled by payload
digest to find the original of each digest; only the revisits are joined back to the
records. A digest that a third of all records share is one row per task after the
pre-aggregation, and its revisits are the split side of a skewed join.

Defined results: a null payload is empty; payloads of fewer than ``MIN_BYTES`` bytes stay
responses. Of equal payloads the smallest page id is the original, null ids last, then
the first place in the archives; so of repeated rows one is the original. A null URL has
no header line; control characters in a URL are percent-encoded. Extra columns are not
archived. A table without rows gives archives without records and a result without rows.
"""

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlens.session import fresh_dir

MIN_BYTES = 100
FILE_RECORDS = 10_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"

RECORD_SCHEMA = (
    "file string, ordinal long, record_type string, record_id string, page_id long, target_uri string, "
    "refers_to_id string, payload_digest string, payload_bytes long, payload binary"
)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def _uri(url: Column) -> Column:
    clean = url
    for code in (13, 10, 9, 0):
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return clean


def _record(kind: Column, record_id: Column, page_id: Column, url: Column, digest: Column,
            refers_to: Column, refers_uri: Column, payload: Column) -> Column:
    """The text of one record without its two closing line ends."""
    revisit = kind == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}"),
        _line("Content-Length", F.octet_length(payload)), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(payload))
    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", kind), _line("WARC-Record-ID", record_id), _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", url), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        _line("WARC-Page-ID", page_id),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, refers_to)),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, refers_uri)),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _line("Content-Length", F.octet_length(block)), F.lit(END), block)


def _write(records: DataFrame, path: str) -> None:
    (records.write.option("lineSep", END * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))


def write_responses(pages: DataFrame, path: str) -> None:
    """A response record for each row of (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    nothing = F.lit(None).cast("string")
    made = pages.select(
        F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")).alias("id"), "page_id",
        _uri(F.col("url")).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    _write(made.select(_record(
        F.lit("response"), F.col("id"), F.col("page_id"), F.col("url"), F.col("digest"), nothing, nothing,
        F.col("payload")).alias("value")), path)


def _parsed(stream) -> Iterator[tuple[dict, bytes, bytes]]:
    """(headers, HTTP header block, payload) of each record of an open archive file."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:60]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.decode().lower()] = value.strip().decode()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} does not end where it says")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield headers, http, payload


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of an archive folder as `RECORD_SCHEMA`; digest and length are those of
    the payload found, for revisits the digest is the declared one and the length null."""

    def parse(batches):
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, RECORD_SCHEMA.split(", "))])

        def flush(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                rows, held = [], 0
                name = file.as_py()
                for at, (h, _, payload) in enumerate(_parsed(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))):
                    revisit = h["warc-type"] == "revisit"
                    page = h.get("warc-page-id")
                    rows.append((
                        name, at, h["warc-type"], h["warc-record-id"], None if page is None else int(page),
                        h.get("warc-target-uri"), h.get("warc-refers-to"),
                        h["warc-payload-digest"].partition(":")[2] if revisit else hashlib.sha256(payload).hexdigest(),
                        None if revisit else len(payload), payload if payloads else None))
                    held += len(payload)
                    if held > 4_000_000 or len(rows) >= 2_000:
                        yield flush(rows)
                        rows, held = [], 0
                if rows:
                    yield flush(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(parse, RECORD_SCHEMA)


def find_revisits(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(file, ordinal) of the records that repeat an earlier payload, with the id and URI of
    the record that holds it."""
    large = headers.filter((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes))
    rank = F.struct(F.col("page_id").isNull().alias("no_page"), "page_id", "file", "ordinal")
    originals = large.groupBy("payload_digest").agg(
        F.count("*").alias("copies"), F.min(F.struct(rank.alias("rank"), "record_id", "target_uri")).alias("first"))
    originals = originals.filter("copies > 1").select(
        F.col("payload_digest").alias("digest"), F.col("first.record_id").alias("original_id"),
        F.col("first.target_uri").alias("refers_uri"))
    same = (F.col("payload_digest") == F.col("digest")) & (F.col("record_id") != F.col("original_id"))
    return large.join(originals, same).select("file", "ordinal", "original_id", "refers_uri")


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES) -> None:
    """Write the archives of ``source`` to ``target``, repeated payloads as revisit records.

    Record ids stay; all other headers are written anew. Revisits of the source stay as they are.
    """
    revisits = find_revisits(read_records(spark, source, payloads=False), min_bytes).select(
        F.col("file").alias("_file"), F.col("ordinal").alias("_ordinal"), F.col("original_id").alias("_refers"),
        "refers_uri")
    records = read_records(spark, source)
    joined = records.join(
        revisits, (F.col("file") == F.col("_file")) & (F.col("ordinal") == F.col("_ordinal")), "left")
    kind = F.when(F.col("_refers").isNotNull(), F.lit("revisit")).otherwise(F.col("record_type"))
    _write(joined.select(_record(
        kind, F.col("record_id"), F.col("page_id"), F.col("target_uri"), F.col("payload_digest"),
        F.coalesce("_refers", "refers_to_id"), F.col("refers_uri"), F.col("payload").cast("string")).alias("value")), target)


def resolve(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to (a page id) of each
    record; a revisit gets its payload's length from the response it refers to."""
    responses = records.filter("record_type = 'response'")
    found = responses.select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("payload_bytes").alias("_bytes"))
    revisits = records.filter("record_type = 'revisit'").join(found, F.col("refers_to_id") == F.col("_id"), "left")
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(revisits.select(
        "page_id", F.col("_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("_page").alias("refers_to")))


def archive_pages(spark: SparkSession, pages: DataFrame) -> str:
    """Archive ``pages``, deduplicate the archives, and return the folder of the latter."""
    plain, lean = fresh_dir(spark, "warc"), fresh_dir(spark, "warc-lean")
    write_responses(pages, plain)
    deduplicate(spark, plain, lean)
    return lean
