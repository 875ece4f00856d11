"""WARC archives as a chunked record table.

Writing: each page becomes a response record, or a revisit of the record with the
smallest page_id among equal payloads of at least MIN_SHARED bytes. A payload of
more than CHUNK_BYTES is written as WARC segments (a first record and
continuations). Pages are cut into rows of a chunk before anything is shuffled;
which ones are revisits is decided on digests alone and joined to the chunks, which
are put in order again. A task that cuts holds the page it reads and its bytes, as
Spark hands out whole values; every later row holds a chunk at most. Records end
with two line breaks, and so do headers; the writer therefore only emits text rows
with that separator, and Spark's own writer makes the files. Files are compressed
whole, so one task reads a file from its start.

Reading: a file's bytes run through a small state machine that keeps a chunk and a
digest, never a record, and gives a row per record identifier and chunk number,
with the length and the SHA-256 of the payload up to there.

Null html is an empty payload. Null urls leave out the target. Rows with the
smallest page_id of equal payloads are all responses, also if repeated; a null
page_id never is the smallest unless there is no other. Other columns are ignored,
and an empty table makes an empty archive.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import text as T
from gaugeflow.session import materialize, shared_dir

#: Payload bytes in one record or chunk row.
CHUNK_BYTES = 1 << 20
#: Shorter payloads are always written out.
MIN_SHARED = 100

BREAK = "\r\n"
END = BREAK + BREAK
DATE = "1970-01-01T00:00:00Z"

CHUNKS = ("record_id string, chunk_no long, page_id long, record_type string, refers_to long, "
          "payload_bytes long, payload_digest string, last boolean, stated_bytes long, "
          "stated_digest string, payload binary")


def _lines(*lines: Column) -> Column:
    """Header lines; null ones are left out."""
    return F.concat_ws(BREAK, *lines)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def _pages(pages: DataFrame) -> DataFrame:
    """Payload, its size and digest."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"))


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the pages that refer to another one; holds no payload."""
    rows = materialize(_pages(pages).where(F.col("payload_bytes") >= MIN_SHARED)
                       .select("page_id", "payload_digest"), "warc-digests")
    shared = (rows.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("copies"))
              .where("copies > 1 AND refers_to IS NOT NULL").drop("copies"))
    return materialize(rows.join(shared, "payload_digest").where("NOT page_id <=> refers_to")
                       .select("page_id", "payload_digest", "refers_to").distinct(), "warc-revisits")


def chunk_rows(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row per chunk of what is written, in the order of the archive within each partition."""
    # tells equal rows apart, which all come to one task whatever their numbers are
    rows = _pages(pages).withColumn("row", F.monotonically_increasing_id()).withColumn(
        "chunks", F.greatest(F.ceil(F.col("payload_bytes") / chunk_bytes), F.lit(1)).cast("int"))
    part = F.substring(F.col("payload"), (F.col("no") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes))
    cut = (rows.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("no"))
           .select("page_id", F.when(F.col("no") == 0, F.col("url")).alias("url"), "payload_bytes",
                   "payload_digest", "row", "chunks", "no", part.alias("part")))
    known = revisits(pages).select(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"),
                                   "refers_to")
    return (cut.join(known, F.col("page_id").eqNullSafe(F.col("_page"))
                     & (F.col("payload_digest") == F.col("_digest")), "left").drop("_page", "_digest")
            .where("no = 0 OR refers_to IS NULL")
            .sortWithinPartitions("page_id", "payload_digest", "row", "no"))


def record_rows(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The archive as text rows, each to be followed by END."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    http = _lines(F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=UTF-8"),
                  _field("Content-Length", F.col("payload_bytes")))
    df = chunk_rows(pages, chunk_bytes).select(
        "*", http.alias("http"), urn(F.col("page_id")).alias("urn"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("part")).alias("written"))
    size = F.octet_length("written")
    total = F.octet_length("http") + F.lit(len(END)) + F.col("payload_bytes")
    segment = F.when(~revisit & (F.col("chunks") > 1), F.lit("WARC-Segment-Number: 1"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = _lines(
        F.lit("WARC/1.1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        _field("WARC-Record-ID", F.col("urn")), F.lit(f"WARC-Date: {DATE}"),
        _field("WARC-Target-URI", uri), _field("Page-ID", F.col("page_id")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        _field("WARC-Refers-To", F.when(revisit, urn(F.col("refers_to")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        segment, F.lit("Content-Type: application/http; msgtype=response"),
        _field("Content-Length", F.octet_length("http") + F.lit(len(END)) + size))
    more = _lines(
        F.lit("WARC/1.1"), F.lit("WARC-Type: continuation"),
        F.concat(F.lit("WARC-Record-ID: "), F.regexp_replace("urn", ">$", ""), F.lit(":"),
                 F.col("no").cast("string"), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"), _field("WARC-Segment-Origin-ID", F.col("urn")),
        _field("WARC-Segment-Number", F.col("no") + 1),
        F.when(F.col("no") + 1 == F.col("chunks"), _field("WARC-Segment-Total-Length", total)),
        _field("Content-Length", size))
    first = F.col("no") == 0
    # one text row at a time: header, then http header of a first record, then the chunk
    line = F.explode(F.when(first, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0), F.lit(2))))
    return (df.select("*", line.alias("line")).select(
        F.when(F.col("line") == 2, F.col("written").cast("string")).when(F.col("line") == 1, F.col("http"))
        .when(first, head).otherwise(more).alias("value")))


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    (record_rows(pages, chunk_bytes).write.option("lineSep", END).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


class ChunkParser:
    """Cuts a stream of archive bytes into chunk rows; holds one header or one chunk."""

    def __init__(self, chunk_bytes: int, keep_payload: bool) -> None:
        self.chunk_bytes, self.keep = chunk_bytes, keep_payload
        self.held = bytearray()
        self.state, self.need = "header", 0
        self.rows: list[tuple] = []
        self.record: dict = {}

    def feed(self, data: bytes) -> None:
        self.held += data
        while self._step():
            pass

    def _step(self) -> bool:
        if self.state == "header":
            at = self.held.find(END.encode())
            if at < 0:
                return False
            if at == 0:  # the line reader ends a file's last line as if it had had a break
                self._take(len(END))
                return True
            self._header(self._take(at + len(END))[:at].decode("utf-8", "replace"))
        elif self.state == "http":
            at = self.held.find(END.encode())
            if at < 0:
                return False
            head = self._take(at + len(END))
            self.need -= len(head)
            fields = _fields(head[:at].decode("utf-8", "replace"))
            self.record["stated"] = int(fields.get("content-length", 0))
            self.state = "block"
        elif self.state == "block":
            part = self._take(min(len(self.held), self.need, self.chunk_bytes))
            self.need -= len(part)
            self.record["part"] += part
            self.record["digest"].update(part)
            self.record["bytes"] += len(part)
            if not self.need:
                self._chunk(last=self.record["segments_end"])
                self.state = "end"
            elif len(self.record["part"]) >= self.chunk_bytes:
                self._chunk(last=False)
            else:
                return bool(self.held)
        else:
            if len(self.held) < len(END):
                return False
            self._take(len(END))
            self.state = "header"
        return True

    def _take(self, size: int) -> bytes:
        part = bytes(self.held[:size])
        del self.held[:size]
        return part

    def _header(self, text: str) -> None:
        fields = _fields(text)
        self.need = int(fields["content-length"])
        if fields["warc-type"] == "continuation":
            self.record["segments_end"] = "warc-segment-total-length" in fields
            self.state = "block"
            return
        page = lambda value: int(value) if value not in (None, "null") else None
        refers = fields.get("warc-refers-to", "")[len("<urn:page:"):-1] or None
        self.record = {
            "id": fields["warc-record-id"], "page": page(fields.get("page-id")),
            "type": fields["warc-type"], "refers": page(refers), "no": 0, "bytes": 0,
            "digest": hashlib.sha256(), "part": bytearray(),
            "stated_digest": fields["warc-payload-digest"].removeprefix("sha256:"),
            "segments_end": "warc-segment-number" not in fields}
        self.state = "http"

    def _chunk(self, last: bool) -> None:
        r = self.record
        if last or r["part"]:
            self.rows.append((r["id"], r["no"], r["page"], r["type"], r["refers"], r["bytes"],
                              r["digest"].hexdigest(), last, r["stated"], r["stated_digest"],
                              bytes(r["part"]) if self.keep else None))
            r["no"] += 1
            r["part"] = bytearray()


def _fields(text: str) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in text.split(BREAK)[1:])
    return {p[0].lower(): p[1] for p in pairs if len(p) == 2}


def read_chunks(spark: SparkSession, path: str, keep_payload: bool = True,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per record and chunk; the digest and length are of the payload up to the chunk's end."""

    def run(batches):
        parser = ChunkParser(chunk_bytes, keep_payload)
        schema = pa.schema([
            ("record_id", pa.string()), ("chunk_no", pa.int64()), ("page_id", pa.int64()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("last", pa.bool_()), ("stated_bytes", pa.int64()),
            ("stated_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            data, offsets = T.utf8(batch.column(0))
            view = memoryview(data)
            held = 0
            for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                parser.feed(view[a:b])
                parser.feed(END.encode())
                held += b - a
                if held >= 8 * chunk_bytes:
                    yield _batch(parser, schema)
                    held = 0
            yield _batch(parser, schema)

    lines = spark.read.schema("value string").option("lineSep", END).text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(run, CHUNKS)


def _batch(parser: ChunkParser, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*parser.rows)) or [[]] * len(schema)
    parser.rows = []
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives, read them back, and describe each record.

    A revisit holds no payload; its size and digest are those its record states.
    """
    path = shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path)
    revisit = F.col("record_type") == "revisit"
    return (read_chunks(pages.sparkSession, path, keep_payload=False).where("last").select(
        "page_id", F.when(revisit, F.col("stated_bytes")).otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("payload_digest"))
        .alias("payload_digest"), "record_type", "refers_to"))
