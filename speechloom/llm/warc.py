"""WARC archives through a chunked record table.

A payload is streamed as rows of record identifier and chunk number, each with the digest of all
bytes so far. Chunks become WARC segments: the first is the record, the others are continuations.
Which records repeat an earlier payload is found from one slim row per record. A bitmap of fixed size
then tells chunks that certainly belong to no such record: they go from the chunk table straight into
archives. Only the others meet the exact list in a shuffle. On reading, only segments of records that
have several are shuffled.
Spark's text writer and reader carry the archives, so any file system that Spark knows will do. No
chunk holds the line that begins a record or ends in that line without its break, which the writer
would add; so that line safely separates records on reading.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechloom.llm.common import let_go, settled, slices

CHUNK_BYTES = 32_768
LEAST_REVISIT = 100
VERSION = "WARC/1.0"
SEPARATOR = VERSION + "\r\n"
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"

# bits that tell which records may be revisits, and how many of them a row holds
BITS = 1 << 26
ROW_BITS = 1 << 15

CHUNKS = ("record_id string, page_id bigint, url string, chunk int, data string, running_digest string, "
          "running_bytes bigint, last boolean, digest string, bytes bigint, n_chunks int")


def chunk_ends(payload: memoryview, most: int) -> list[int]:
    """Where chunks of at most ``most`` bytes end: between characters, and inside every separator.

    No chunk ends in a separator without its line break, because a line break follows each chunk.
    """
    version = VERSION.encode()
    forced = [found.start() + 4 for found in re.finditer(re.escape(SEPARATOR.encode()), payload)]
    out, at, f = [], 0, 0
    while at < len(payload):
        end = min(at + most, len(payload))
        while end < len(payload) and payload[end] & 0xC0 == 0x80:
            end -= 1
        if f < len(forced) and forced[f] <= end:
            end = forced[f]
            f += 1
        elif end - at >= len(version) and payload[end - len(version):end] == version:
            end -= len(version) - 4
        out.append(end)
        at = end
    return out or [0]


def chunk_table(pages: DataFrame, most: int = CHUNK_BYTES) -> DataFrame:
    """Rows ``record_id, page_id, url, chunk, data, running_digest, running_bytes, last, digest, bytes,
    n_chunks``, the last three of the whole payload; null html is empty.

    Payloads are read in place: of each, only chunks of one batch and their digests are ever copied.
    """

    def run(batches):
        for batch in slices(batches, "html"):
            pages_of, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            for page_id, url, html in zip(pages_of, urls, batch.column("html")):
                payload = memoryview(html.as_buffer() if html.is_valid else b"").cast("B")
                ends = chunk_ends(payload, most)
                digest, name, running = hashlib.sha256(), str(uuid.uuid4()), []
                for at, end in zip([0, *ends], ends):
                    digest.update(payload[at:end])
                    running.append(digest.hexdigest())
                whole = (running[-1], len(payload), len(ends))
                for first in range(0, len(ends), 64):
                    rows = [
                        (name, page_id, url, i + 1, str(payload[ends[i - 1] if i else 0:ends[i]], "utf-8"), running[i],
                         ends[i], i + 1 == len(ends), *whole)
                        for i in range(first, min(first + 64, len(ends)))
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(),
                            pa.bool_(), pa.string(), pa.int64(), pa.int32()))],
                        ["record_id", "page_id", "url", "chunk", "data", "running_digest", "running_bytes", "last",
                         "digest", "bytes", "n_chunks"])

    return pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(run, CHUNKS)


def revisits(chunks: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``record_id, refers`` of every record with an earlier one of equal payload, which refers names."""
    finals = chunks.filter(F.col("last") & (F.col("bytes") >= least)).select("record_id", "page_id", "digest")
    # payloads may be equal in a third of all rows: minima on the way, then a join that Spark can split
    order = F.struct(F.col("page_id").isNull().alias("x"), "page_id", "record_id")
    first = settled(
        finals.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
        .select("digest", F.col("first.record_id").alias("first")), "first")
    return finals.join(first, "digest").filter("record_id <> first").select("record_id", F.col("first").alias("refers"))


def doubtful(chunks: DataFrame, again: DataFrame) -> DataFrame:
    """Add ``doubt``: false only where ``record_id`` is certainly not in ``again``.

    The bitmap has ``BITS`` bits in rows of ``ROW_BITS``, 8 MB whatever the number of records; the more
    of them there are, the more chunks are in doubt.
    """
    spot = F.pmod(F.xxhash64("record_id"), F.lit(BITS))
    place = spot % ROW_BITS
    bitmap = again.groupBy(F.floor(spot / ROW_BITS).alias("row")).agg(F.bitmap_construct_agg(place).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    doubt = F.floor(byte / F.pow(F.lit(2), place % 8)).cast("int").bitwiseAND(F.lit(1)) == 1
    return chunks.withColumn("row", F.floor(spot / ROW_BITS)).join(F.broadcast(bitmap), "row", "left").withColumn(
        "doubt", F.coalesce(doubt, F.lit(False))).drop("row", "bits")


def _line(name: str, value: F.Column) -> F.Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def write_warc(pages: DataFrame, path: str, *, most: int = CHUNK_BYTES, least: int = LEAST_REVISIT) -> None:
    """Write a record per row to gzip archives in ``path``; equal payloads of ``least`` bytes are kept once.

    Null html is an empty payload; a row without page_id or url leaves that header out, and among equal
    payloads it comes last. Repeated rows are records of their own. An empty table gives archives without
    a record; other columns are not looked at.
    """
    chunks = settled(chunk_table(pages, most), "chunks", codec="zstd")
    repeats = settled(revisits(chunks, least), "repeats")
    told = doubtful(chunks, repeats)
    # segments of a record come in order, out of the chunk table as well as out of the join
    alone = told.filter(~F.col("doubt")).withColumn("refers", F.lit(None).cast("string"))
    met = told.filter("doubt").join(repeats, "record_id", "left").filter(
        F.col("refers").isNull() | (F.col("chunk") == 1)).sortWithinPartitions("record_id", "chunk")
    rows = alone.unionByName(met)
    again = F.col("refers").isNotNull()
    data = F.when(again, "").otherwise(F.col("data"))
    split = ~again & (F.col("n_chunks") > 1)
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    first = F.col("chunk") == 1
    urn = F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))
    part = F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit("-"), F.col("chunk").cast("string"), F.lit(">"))
    value = F.concat(
        F.lit(SEPARATOR),
        _line("WARC-Type", F.when(~first, "continuation").when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.when(first, urn).otherwise(part)),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.concat(F.lit("<"), url, F.lit(">"))),
        _line("WARC-Page-ID", F.col("page_id")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), F.col("refers"), F.lit(">"))),
        _line("WARC-Segment-Number", F.when(split, F.col("chunk"))),
        _line("WARC-Segment-Origin-ID", F.when(~first, urn)),
        _line("WARC-Segment-Total-Length", F.when(split & F.col("last"), F.col("bytes"))),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.octet_length(data)),
        F.lit(CRLF), data, F.lit(CRLF),
    )
    # the writer ends each row with the second line break of the record
    rows.select(value.alias("value")).write.option("lineSep", CRLF).option("compression", "gzip").text(path)
    let_go(pages.sparkSession, (chunks, repeats))


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives: ``record_id, segment, split, type, page_id, url, digest, refers, total,
    data``; split tells that its payload comes in several.

    A record whose data is not as long as its header says ends the job.
    """
    text = spark.read.option("lineSep", SEPARATOR).text(path).filter("value <> ''")
    split = text.select(
        F.substring_index("value", CRLF + CRLF, 1).alias("head"),
        F.expr(r"substring(value, instr(value, '\r\n\r\n') + 4, char_length(value) - instr(value, '\r\n\r\n') - 7)")
        .alias("data"),
    )

    def field(name: str, form: str) -> F.Column:
        found = F.regexp_extract("head", rf"(?:^|\n){name}: {form}", 1)
        return F.when(found != "", found)

    name = r"<urn:uuid:([0-9a-f-]{36})"
    told = F.coalesce(field("Content-Length", "([0-9]+)").cast("bigint"), F.lit(-1))
    checked = F.when(told == F.octet_length("data"), F.col("data")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record: "), F.col("head"))))
    return split.select(
        field("WARC-Record-ID", name).alias("record_id"),
        F.coalesce(field("WARC-Segment-Number", "([0-9]+)").cast("int"), F.lit(1)).alias("segment"),
        (field("WARC-Segment-Number", "([0-9]+)").isNotNull() | F.coalesce(
            field("WARC-Type", "([a-z]+)") == "continuation", F.lit(False))).alias("split"),
        field("WARC-Type", "([a-z]+)").alias("type"),
        field("WARC-Page-ID", "(-?[0-9]+)").cast("bigint").alias("page_id"),
        field("WARC-Target-URI", "<([^\r]*)>").alias("url"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]+)").alias("digest"),
        field("WARC-Refers-To", name).alias("refers"),
        field("WARC-Segment-Total-Length", "([0-9]+)").cast("bigint").alias("total"),
        checked.alias("data"),
    )


RECORDS = ("record_id string, page_id bigint, type string, refers string, payload_bytes bigint, payload_digest string, "
           "told_digest string")


def read_records(segments: DataFrame) -> DataFrame:
    """One row per record. A payload in one piece is digested where it is read; segments of others are
    digested one after the other as they stream by.

    Only the digest's state is kept between segments; missing segments end the job.
    """

    def run(batches):
        now, digest, n, told, segment = None, None, 0, -1, 0

        def done():
            if segment > 1 and told != n:
                raise ValueError(f"record {now[0]} has {n} of {told} bytes")
            return (*now[:4], n, digest.hexdigest(), now[4])

        def batch_of(rows):
            columns = zip(*rows) if rows else [[]] * 7
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [
                "record_id", "page_id", "type", "refers", "payload_bytes", "payload_digest", "told_digest"])

        for batch in slices(batches, "data"):
            rows = []
            columns = [batch.column(c).to_pylist() for c in (
                "record_id", "page_id", "type", "refers", "digest", "segment", "total")]
            for record_id, page_id, kind, refers, named, number, total, data in zip(*columns, batch.column("data")):
                if now is None or record_id != now[0]:
                    if now is not None:
                        rows.append(done())
                    now, digest, n, told, segment = (record_id, page_id, kind, refers, named), hashlib.sha256(), 0, -1, 0
                segment += 1
                if number != segment:
                    raise ValueError(f"record {record_id} lacks segment {segment}")
                data = data.as_buffer()
                digest.update(data)
                n += data.size
                told = total if total is not None else told
            yield batch_of(rows)
        if now is not None:
            yield batch_of([done()])

    streamed = segments.filter("split").repartition("record_id").sortWithinPartitions("record_id", "segment")
    return segments.filter("not split").select(
        "record_id", "page_id", "type", "refers", F.octet_length("data").cast("bigint").alias("payload_bytes"),
        F.sha2("data", 256).alias("payload_digest"), F.col("digest").alias("told_digest"),
    ).unionByName(streamed.mapInArrow(run, RECORDS))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record of the archives.

    Lengths and digests are of the full payload; a revisit has those of the response it names. A
    payload whose digest is not the one in its header ends the job. Archives without a record give no rows.
    """
    records = settled(read_records(read_segments(spark, path)), "records")
    good = F.when(F.col("payload_digest") == F.col("told_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("wrong digest: "), F.col("record_id"))))
    whole = records.filter("type = 'response'").select(
        "record_id", "page_id", "payload_bytes", good.alias("payload_digest"))
    named = whole.select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"),
                         "payload_bytes", "payload_digest")
    again = records.filter("type = 'revisit'").select("page_id", "refers").join(named, "refers", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")
    return whole.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
                        F.lit(None).cast("bigint").alias("refers_to")).unionByName(again)
