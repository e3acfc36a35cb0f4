"""WARC archives whose repeated payloads are revisit records."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import small, written

#: Originals of repeated payloads (a digest and an id each) are broadcast up to this count, else joined by a shuffle.
BROADCAST_ORIGINALS = 200_000
#: Files have records_per_file records of up to SMALL_BYTES each; of larger ones, as many fewer as they are larger.
SMALL_BYTES = 64 << 10
#: Payloads under this many bytes are never made revisits.
LEAST_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_type string, page_id long, target_uri string, payload_digest string, payload_bytes long, refers_to_id string, record_id string, intact boolean, payload binary"


def record_id(page_id: Column, digest: Column) -> Column:
    """A URN made from the page and its payload alone, so that a revisit can name its original without a lookup."""
    h = F.md5(F.concat_ws("|", page_id.cast("string"), digest))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))


def resolve_revisits(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(payload_digest, original): of payloads that several rows of headers share, the largest page_id.

    headers: page_id, payload_digest, payload_bytes. Counts are combined before the shuffle, so a digest that
    many rows share is a row for each task.
    """
    return (
        headers.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1 and original is not null")
        .drop("n")
    )


def write_warc(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", records_per_file: int = 2000, least_bytes: int = LEAST_BYTES) -> None:
    """Write a WARC/1.1 record for each row of pages (page_id, url, html) to files in the folder `path`.

    Of payloads of least_bytes or more that are equal, the one with the largest page_id is a response record, the
    others are revisit records without payload, with fresh headers that name it; all rows that share that largest
    page_id are responses, and so is a row with a null page_id. A null html is an empty payload, a null url gives
    no WARC-Target-URI, line breaks in a url are percent-encoded. Spark's text writer writes the files, so any
    store it reaches will do; headers alone are shuffled by digest. A file has records_per_file * SMALL_BYTES bytes
    of payload at most, or one record: pages are written by classes of size, each in a folder of its own.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumns(
        {"payload_digest": F.sha1("html"), "payload_bytes": F.octet_length("html").cast("long")}
    )
    originals = small(written(resolve_revisits(rows.select("page_id", "payload_digest", "payload_bytes"), least_bytes), "originals"), BROADCAST_ORIGINALS)
    rows = rows.join(originals, "payload_digest", "left").withColumn(
        "revisit", F.coalesce((F.col("payload_bytes") >= least_bytes) & (F.col("page_id") != F.col("original")), F.lit(False))
    )
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, "html"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))),
        line("WARC-Date", F.lit(date)),
        optional("WARC-Target-URI", url),
        optional("WARC-Page-ID", F.col("page_id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(F.col("revisit"), F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_id(F.col("original"), F.col("payload_digest"))))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
    )
    size_class = F.greatest(F.ceil(F.log2(F.col("payload_bytes") / SMALL_BYTES)), F.lit(0)).cast("int")
    out = rows.select(F.when(F.col("payload_bytes") > 0, size_class).otherwise(0).alias("size"), F.concat(head, block).alias("value"))
    sizes = pages.select(F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("payload_bytes")).agg(F.max("payload_bytes")).first()[0] or 0
    # Sizes are below 2 ** 31, so there are 16 classes at most, and one where all pages are small.
    for k in range(1 + max(0, math.ceil(math.log2(max(sizes, 1) / SMALL_BYTES)))):
        writer = out.where(F.col("size") == k).select("value").write.option("lineSep", "\r\n\r\n")
        writer.option("maxRecordsPerFile", max(1, records_per_file >> k)).text(f"{path}/size={k}")


def parsed(data: bytes) -> Iterator[tuple]:
    """The records of one uncompressed WARC file, in the order of RECORD."""
    at, end = 0, len(data)
    while at < end:
        stop = data.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in data[at:stop].decode().split("\r\n")[1:])
        at = stop + 4
        block, at = data[at : at + int(fields["Content-Length"])], at + int(fields["Content-Length"]) + 4
        revisit = fields["WARC-Type"] == "revisit"
        payload = None if revisit else block[block.index(b"\r\n\r\n") + 4 :]
        said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        page_id = fields.get("WARC-Page-ID")
        yield (
            fields["WARC-Type"], None if page_id is None else int(page_id), fields.get("WARC-Target-URI"), said, None if revisit else len(payload),
            fields.get("WARC-Refers-To"), fields["WARC-Record-ID"], revisit or hashlib.sha1(payload).hexdigest() == said, payload,
        )


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row of RECORD for each record of the WARC files in a folder that write_warc wrote.

    intact: the payload has the digest that its header states (always true of revisits). payloads=False leaves
    the payloads out of the result, but still hashes each.
    """
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in RECORD.split(", ")])

    def read(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = list(parsed(data.as_py()))
                columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
                if not payloads:
                    columns[-1] = [None] * len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(read, RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Records with payload_bytes of revisits filled in from their originals, and refers_to, the original's page_id.

    Joins the headers of revisits to those of responses by payload digest. A revisit without an original in the
    archives keeps nulls.
    """
    originals = (
        records.where("record_type = 'response'")
        .groupBy("payload_digest", F.col("record_id").alias("refers_to_id"))
        .agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("original_bytes"))
    )
    revisits = records.where("record_type = 'revisit'").join(originals, ["payload_digest", "refers_to_id"], "left")
    revisits = revisits.withColumn("payload_bytes", F.col("original_bytes")).drop("original_bytes")
    return records.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisits)
