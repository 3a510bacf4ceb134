"""Web archives: pages as WARC records in files, and the pages read back from them.

A page is a ``response`` record, or a ``revisit`` of the response that holds the same payload. The payload travels in a chunked
HTTP message. A record whose block is longer than ``SEGMENT`` is written as a first segment and ``continuation`` records, which
may stand in later files. The reader takes records as they come from any file; those of one origin meet by the origin's id, are
put in the order of their numbers, held against the total length of the last one, and decoded from chunk to chunk, so that no
payload has to fit into memory. Only segmented records are shuffled.

Each record is a gzip member of its own. Tasks write files under a name of their own per attempt; the manifest, a Parquet table
committed by Spark, lists those that count, so a lost executor leaves at worst an unlisted file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.shared import blocks_by_key, lanes, shared_folder, slices, stored

#: Payloads from this size on are stored once.
LEAST = 1000
#: Bytes of a record's block, of a chunk of its HTTP message, and of a file before the next one is begun.
SEGMENT, CHUNK, FILE = 8 << 10, 4 << 10, 256 << 20
LEVEL = 1
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_MANIFEST = "path string, records long, bytes long"


# Records ----------------------------------------------------------------------


def record(kind: str, headers: dict[str, object], block: bytes) -> bytes:
    """One record as a gzip member; headers that are None are left out."""
    lines = [b"WARC/1.1", b"WARC-Type: " + kind.encode()]
    lines += [f"{k}: {v}".encode("utf-8", "surrogatepass") for k, v in headers.items() if v is not None]
    lines.append(b"Content-Length: %d" % len(block))
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload as an HTTP message in chunked transfer framing."""
    parts = [HTTP]
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join(parts) + b"0\r\n\r\n"


class Message:
    """Takes an HTTP message piece by piece; ``digest`` and ``size`` are those of its payload so far.

    ``fault`` says what is wrong with the framing. Pieces of the payload are kept only if ``keep`` is true.
    """

    LONGEST_LINE = 1 << 16

    def __init__(self, keep: bool = False):
        self.digest, self.size, self.fault = hashlib.sha1(), 0, None
        self.kept = [] if keep else None
        self._rest, self._state, self._left, self._framed = b"", "head", 0, False

    def _payload(self, part: bytes) -> None:
        self.digest.update(part)
        self.size += len(part)
        if self.kept is not None:
            self.kept.append(part)

    def feed(self, data: bytes) -> None:
        data, self._rest, at = self._rest + data, b"", 0
        while at < len(data) and self.fault is None and self._state != "end":
            if self._state == "body":
                part = data[at:at + self._left] if self._framed else data[at:]
                self._payload(part)
                at += len(part)
                self._left -= len(part)
                if self._framed and not self._left:
                    self._state = "gap"
                continue
            end = b"\r\n\r\n" if self._state == "head" else b"\r\n"
            stop = data.find(end, at)
            if stop < 0:
                self._rest = data[at:]
                if len(self._rest) > self.LONGEST_LINE:
                    self.fault = "endless line"
                return
            line, at = data[at:stop], stop + len(end)
            self._line(line)

    def _line(self, line: bytes) -> None:
        if self._state == "head":
            self._framed = re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", line) is not None
            self._state = "size" if self._framed else "body"
        elif self._state == "gap":  # the line end behind a chunk
            self._state, self.fault = "size", "chunk too long" if line else None
        elif self._state == "size":
            text = line.split(b";")[0].strip()
            if not re.fullmatch(rb"[0-9A-Fa-f]+", text):
                self.fault = "chunk size"
                return
            self._left = int(text, 16)
            self._state = "body" if self._left else "trailer"
        elif not line:  # trailers end with an empty line
            self._state = "end"

    def close(self) -> None:
        complete = self._state == "end" or (self._state == "body" and not self._framed)
        if self.fault is None and not complete:
            self.fault = "message cut off"


def bare_digest(value: str | None) -> str | None:
    """``sha1:BASE32`` as lower-case hex."""
    if not value or not value.startswith("sha1:"):
        return None
    return base64.b32decode(value[5:]).hex()


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an open archive."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("the archive ends within a record")
        yield headers, block


# Writing ----------------------------------------------------------------------


def payload(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def _classes(pages: DataFrame) -> DataFrame:
    """``key, page_id, url, copies, n``: payloads that several rows share, with the row that keeps the response.

    ``copies`` counts rows equal to that row. Rows are counted before they are shuffled; no payload is moved.
    """
    body = payload(F.col("html"))
    rows = pages.where(F.octet_length(body) >= LEAST).select(F.sha2(body, 256).alias("key"), "page_id", "url")
    each = rows.groupBy("key", "page_id", "url").agg(F.count("*").alias("copies"))
    top = F.max(F.struct("page_id", "url", "copies")).alias("top")
    return each.groupBy("key").agg(top, F.sum("copies").alias("n")).where("n > 1").select("key", "top.*", "n")


def roles(pages: DataFrame) -> DataFrame:
    """``page_id, url, body, own_id, refers_to``: a row per record; one that refers to another needs no body.

    ``own_id`` names a response that others refer to. The rows are joined to the shared payloads alone; Spark broadcasts those
    where they are few, and splits a hot payload where they are not.
    """
    shared = stored(_classes(pages), "payloads")
    body = payload(F.col("html"))
    # A short payload gets a key of its own row, so that no common one gathers its rows.
    key = F.when(F.octet_length(body) >= LEAST, F.sha2(body, 256)).otherwise(F.concat(F.lit("~"), F.xxhash64("page_id", "url")))
    names = {"page_id": "top_page", "url": "top_url"}
    joined = pages.select("page_id", "url", body.alias("body"), key.alias("key")).join(shared.withColumnsRenamed(names), "key", "left")
    top = F.col("page_id").eqNullSafe(F.col("top_page")) & F.col("url").eqNullSafe(F.col("top_url"))
    name = F.when(F.col("n").isNotNull(), F.concat(F.lit("response-"), F.substring("key", 1, 32)))
    again = F.col("n").isNotNull() & ~top
    columns = [
        "page_id", "url", F.when(~again, F.col("body")).alias("body"), F.when(~again, name).alias("own_id"), F.when(again, name).alias("refers_to")
    ]
    twins = shared.where("copies > 1")
    if twins.isEmpty():
        return joined.select(*columns)
    # Equal rows at the top: one of them is the response, the others are made from their count.
    twin = F.col("n").isNotNull() & top & (F.col("copies") > 1)
    first = joined.where(twin).groupBy("key", "page_id", "url", "n", "top_page", "top_url", "copies").agg(F.first("body").alias("body"))
    step = 10_000
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 2) / step))).alias("part")
    parts = twins.select("key", "page_id", "url", "copies", part).repartition(lanes(pages.sparkSession))
    size = F.least(F.lit(step), F.col("copies") - 1 - F.col("part") * step).cast("int")
    others = parts.select("page_id", "url", name_of("key"), F.explode(F.array_repeat(F.lit(0), size)))
    others = others.select("page_id", "url", F.lit(None).cast("binary").alias("body"), F.lit(None).cast("string").alias("own_id"), "refers_to")
    return joined.where(~twin).select(*columns).unionByName(first.select(*columns)).unionByName(others)


def name_of(key: str) -> Column:
    return F.concat(F.lit("response-"), F.substring(key, 1, 32)).alias("refers_to")


def write(pages: DataFrame, folder: str, segment: int = SEGMENT) -> DataFrame:
    """Write a record for every row of ``pages(page_id, url, html)`` and return the manifest.

    A NULL ``html`` is an empty payload; a NULL ``url`` or ``page_id`` leaves out its header. Of rows with equal payloads of at
    least ``LEAST`` bytes, that with the largest ``page_id`` (then ``url``; NULL is smallest) is the response, all others refer to
    it, equal rows included. Very long payloads are cut into segments. An empty table gives an empty manifest; further columns
    are not looked at.
    """
    rows = roles(pages).select("page_id", "url", "body", "own_id", "refers_to")
    made = rows.withColumn("page_id", F.col("page_id").cast("string")).mapInArrow(partial(_written, folder, segment), _MANIFEST)
    return stored(made, "archives")


def _urn(name: str | None) -> str:
    return f"<urn:uuid:{uuid.UUID(name.removeprefix('response-')) if name else uuid.uuid4()}>"


def _written(folder: str, segment: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, path, count, size = None, None, 0, 0

    def done() -> pa.RecordBatch:
        out.close()
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

    for batch in slices(batches):
        for page_id, url, body, own, refers in zip(*(c.to_pylist() for c in batch.columns)):
            for data in _records(page_id, url, body, own, refers, segment):
                if out is not None and size >= FILE:
                    yield done()
                    out = None
                if out is None:
                    path, count, size = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    fs, place = pa.fs.FileSystem.from_uri(path)
                    fs.create_dir(place.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(place, compression=None, buffer_size=1 << 20)
                out.write(data)
                count, size = count + 1, size + len(data)
    if out is not None:
        yield done()


def _records(page_id, url, body, own, refers, segment) -> Iterator[bytes]:
    target = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = {
        "WARC-Record-ID": _urn(own), "WARC-Date": DATE, "WARC-Target-URI": target, "X-Page-ID": page_id,
        "Content-Type": "application/http; msgtype=response",
    }
    if refers is not None:
        yield record("revisit", head | {"WARC-Profile": PROFILE, "WARC-Refers-To": _urn(refers)}, HTTP)
        return
    block = chunked(body)
    head["WARC-Payload-Digest"] = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    if len(block) <= segment:
        yield record("response", head, block)
        return
    yield record("response", head | {"WARC-Segment-Number": 1}, block[:segment])
    for number, at in enumerate(range(segment, len(block), segment), 2):
        total = len(block) if at + segment >= len(block) else None
        yield record("continuation", {
            "WARC-Record-ID": _urn(None), "WARC-Date": DATE, "WARC-Segment-Origin-ID": head["WARC-Record-ID"],
            "WARC-Segment-Number": number, "WARC-Segment-Total-Length": total,
        }, block[at:at + segment])


# Reading ----------------------------------------------------------------------

#: ``kind`` is response, revisit or segment. A segment holds its block; a whole response what was decoded from it.
_PARSED = (
    "kind string, id string, page_id string, url string, refers_to string, digest string, size long, payload binary, fault string, "
    "segment int, total long, block binary"
)
_PARSED_NAMES = [f.split()[0] for f in _PARSED.split(", ")]
_PARSED_TYPES = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[f.split()[1]] for f in _PARSED.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PARSED_TYPES)], _PARSED_NAMES)


def _judged(message: Message, promised: str | None) -> tuple[str, int, bytes | None, str | None]:
    """Digest, size, payload and fault of a message that has ended."""
    message.close()
    digest = message.digest.hexdigest()
    fault = message.fault or ("digest" if promised and promised != digest else None)
    return digest, message.size, None if message.kept is None else b"".join(message.kept), fault


def _parsed(keep: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            fs, place = pa.fs.FileSystem.from_uri(path)
            with fs.open_input_stream(place, compression=None, buffer_size=1 << 20) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for h, block in parse(stream):
                    kind, number = h["warc-type"], h.get("warc-segment-number")
                    own, page_id, url = h.get("warc-record-id", ""), h.get("x-page-id"), h.get("warc-target-uri")
                    refers, promised = h.get("warc-refers-to"), bare_digest(h.get("warc-payload-digest"))
                    if number is not None and kind in ("response", "continuation"):
                        total = h.get("warc-segment-total-length")
                        origin = h.get("warc-segment-origin-id", own)
                        rows.append(("segment", origin, page_id, url, None, promised, None, None, None, int(number), total and int(total), block))
                        held += len(block)
                    elif kind == "response":
                        message = Message(keep)
                        message.feed(block)
                        rows.append(("response", own, page_id, url, None, *_judged(message, promised), None, None, None))
                        held += len(block) if keep else 0
                    elif kind == "revisit":
                        rows.append(("revisit", own, page_id, url, refers, promised, None, None, None, None, None, None))
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
    if rows:
        yield _batch(rows)


def _reassembled(keep: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of one origin after the other, in the order of their numbers, as whole responses."""
    state = None

    def ended() -> pa.RecordBatch:
        origin, page_id, url, promised, message, last, length, total, fault = state
        digest, size, body, wrong = _judged(message, promised)
        if fault is None and total is None:
            fault = "last segment missing"
        elif fault is None and total != length:
            fault = "total length"
        return _batch([("response", origin, page_id, url, None, digest, size, body, fault or wrong, None, None, None)])

    for fresh, cols in blocks_by_key(batches, ["id"]):
        if fresh:
            if state:
                yield ended()
            state = (cols["id"][0], None, None, None, Message(keep), 0, 0, None, None)
        for page_id, url, promised, number, total, block in zip(*(cols[c] for c in ("page_id", "url", "digest", "segment", "total", "block"))):
            origin, p, u, d, message, last, length, known, fault = state
            if number == last:  # a copy of a segment, from a file that was taken twice
                continue
            if number != last + 1 or known is not None:
                fault = fault or "segment missing"
            message.feed(block)
            state = (origin, page_id or p, url or u, promised or d, message, number, length + len(block), known if total < 0 else total, fault)
    if state:
        yield ended()


def read(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, fault`` of every page in the archives.

    ``payloads`` adds the decoded payload (NULL for revisits, whose payload is that of the response they refer to). ``fault``
    names what does not hold: a missing segment, the total length, the chunk framing, the digest, or a response that is not there.
    """
    spark = manifest.sparkSession
    files = manifest.select("path").repartitionByRange(lanes(spark), "path")
    found = stored(files.mapInArrow(partial(_parsed, payloads), _PARSED), "records")
    segments = found.where("kind = 'segment'").select("id", "page_id", "url", "digest", "segment", F.coalesce("total", F.lit(-1)).alias("total"), "block")
    segments = segments.repartition(lanes(spark), "id").sortWithinPartitions("id", "segment")
    whole = segments.mapInArrow(partial(_reassembled, payloads), _PARSED).unionByName(found.where("kind = 'response'"))
    names = ["page_id", "url", "id", "refers_to", "digest", "size", "payload", "fault"]
    whole = stored(whole.select(*names), "responses")
    target = whole.select(
        F.col("id").alias("refers_to"), F.col("page_id").alias("response_page"), F.col("digest").alias("d"), F.col("size").alias("s"),
        F.col("fault").alias("f"),
    )
    again = found.where("kind = 'revisit'").select(*names).drop("digest", "size", "fault").join(target, "refers_to", "left")
    fault = F.coalesce("f", F.when(F.col("d").isNull(), F.lit("response missing")))
    out = whole.withColumns({"record_type": F.lit("response"), "response_page": F.lit(None).cast("string")}).unionByName(
        again.withColumns({"record_type": F.lit("revisit"), "digest": F.col("d"), "size": F.col("s"), "fault": fault}).drop("d", "s", "f")
    )
    return out.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.col("response_page").cast("long").alias("refers_to"), "fault", *(["payload"] if payloads else []),
    )


def archived(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The pages as they come back from archives written for them; see ``write`` and ``read``."""
    return read(write(pages, shared_folder(pages.sparkSession, "warc"), segment))
