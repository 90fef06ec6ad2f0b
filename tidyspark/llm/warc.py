"""WARC archives: writer, and a salvage reader that survives damage.

Writing: one record per row, each a gzip member of its own. Spark's text sink
writes the members' bytes as they are, so any store Spark can write to works,
and Spark's commit protocol copes with lost executors. The sink puts a
separator after every row; here it is an empty gzip member, which readers of
concatenated members skip.

Reading: archives come whole through Spark's binary source (the writer bounds
the records and bytes of an archive). The reader walks a file record by record and
checks each one: the gzip checksum, the version line, the header block, the
declared length, the end of record, and the SHA-1 digests of block and payload
(of an HTTP message the payload is the entity body). When a check fails it
searches for the next gzip member or version line from which a record passes
all checks, goes on from there, and logs the byte gap in between with the reason.

A member may hold many records and may be damaged: the search also goes through
what inflates of it. A gap between records of one member has the member's bytes,
and its reason tells which inflated bytes are lost; where a member breaks off,
the gap begins behind the bytes of its last good record; a wrong checksum behind
good records is logged as a gap of no bytes. A member of one record that breaks
off is a gap as a whole.

Of records with equal payloads of at least ``revisit_bytes`` the one with the
largest id is the response and the others are revisits that refer to it;
smaller payloads are always responses. Defined results: a null payload is
empty; rows with a null id take part, and are responses of a payload only if
all its ids are null; repeated rows with the largest id are all responses; an
empty table gives no archives and no records; payloads of any length are
written whole. Other columns of the input are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyspark.llm.common import ship_code, write_stage

EMPTY_MEMBER = gzip.compress(b"", mtime=0)
VERSION = b"WARC/1.1"
RECORD_END = b"\r\n\r\n"
BROADCAST_GROUPS = 500_000          # rows of about 60 bytes each
WRITTEN = "2000-01-01T00:00:00Z"    # the rows have no date; a fixed one keeps archives reproducible


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode("ascii")


def _urn(number) -> str:
    return f"<urn:record:{'' if number is None else number}>"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, is_response: bool) -> bytes:
    """One record, uncompressed. A revisit carries the digest and length but no payload."""
    fields = [("WARC-Type", "response" if is_response else "revisit"),
              ("WARC-Record-ID", _urn(page_id)),
              ("WARC-Date", WRITTEN), ("Content-Type", "text/html"),
              ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", url or "")),
              ("WARC-Payload-Digest", f"sha1:{_base32(digest)}"),
              ("X-Payload-Length", str(len(payload)))]
    if not is_response:
        fields.append(("WARC-Refers-To", _urn(refers_to)))
        fields.append(("WARC-Profile", "identical-payload-digest"))
    body = payload if is_response else b""
    fields.append(("Content-Length", str(len(body))))
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + body + RECORD_END


def plan_records(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html",
                 revisit_bytes: int = 1000) -> DataFrame:
    """Rows (id, url, payload, bytes, digest, refers_to, is_response), by two joins on small rows.

    Digests are counted before the join, and only payloads that occur more than
    once take part in it; a group of copies of any size is one row on that side.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("record_id"), F.col(url).cast("string").alias("url"),
                        body.alias("payload"), F.length(body).cast("long").alias("payload_bytes"),
                        F.sha1(body).alias("payload_digest"))
    large = rows.where(F.col("payload_bytes") >= revisit_bytes)
    groups = (large.groupBy("payload_digest")
              .agg(F.max("record_id").alias("newest"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1").select(F.col("payload_digest").alias("of_digest"), "newest"))
    groups = write_stage(groups, "warc-copies")
    if groups.count() <= BROADCAST_GROUPS:     # then the payloads needn't be shuffled
        groups = F.broadcast(groups)
    joined = rows.join(groups, (rows.payload_digest == groups.of_digest)
                       & (rows.payload_bytes >= revisit_bytes), "left")
    is_response = F.col("of_digest").isNull() | F.col("record_id").eqNullSafe(F.col("newest"))
    return joined.select("record_id", "url", "payload", "payload_bytes", "payload_digest",
                         F.when(~is_response, F.col("newest")).alias("refers_to"),
                         is_response.alias("is_response"))


PARTS = 8                        # rows of the text sink in one archive, at most


def write_archives(records: DataFrame, path: str, records_per_archive: int = 2000,
                   archive_bytes: int = 64 << 20) -> None:
    """Write planned records below ``path``, as archives of at most that many records and about that many bytes.

    A row of the text sink holds the members of one part of an archive, so its rows bound
    both; a single larger record is a part of its own.
    """
    ship_code(records.sparkSession)
    columns = ["record_id", "url", "payload", "payload_digest", "refers_to", "is_response"]
    parts = min(PARTS, records_per_archive)
    most_records, most_bytes = max(1, records_per_archive // parts), max(1, archive_bytes // parts)

    def members(batches):
        held, size = [], 0

        def part():
            return pa.RecordBatch.from_arrays([pa.array([EMPTY_MEMBER.join(held)], pa.binary())], names=["member"])

        for b in batches:
            for start in range(0, b.num_rows, 200):
                for r in zip(*(b.column(i).slice(start, 200).to_pylist() for i in range(len(columns)))):
                    member = gzip.compress(record_bytes(*r), 6, mtime=0)
                    if held and (size + len(member) > most_bytes or len(held) == most_records):
                        yield part()
                        held, size = [], 0
                    held.append(member)
                    size += len(member) + len(EMPTY_MEMBER)
        if held:
            yield part()

    (records.select(*columns).mapInArrow(members, "member binary")
     .select(F.col("member").cast("string").alias("value"))     # the bytes as they are
     .write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
     .option("maxRecordsPerFile", parts).text(path))


class BadRecord(Exception):
    pass


class Places:
    """Where byte strings occur next in one buffer; an occurrence found once serves every start before it.

    Starts only go on through the file, so all searches together read it once.
    """

    def __init__(self, data: bytes):
        self.data, self.known = data, {}

    def next(self, needle: bytes, at: int) -> int:
        """The first place from ``at`` on, or the buffer's length."""
        if at >= len(self.data):
            return len(self.data)
        start, found = self.known.get(needle, (0, -1))
        if not start <= at <= found:
            found = self.data.find(needle, at)
            found = len(self.data) if found < 0 else found
            self.known[needle] = (at, found)
        return found


MOST_HEADERS = 1 << 16            # bytes of a record's or a gzip member's header
_MEMBER = re.compile(rb"\x1f\x8b\x08")
_RESYNC = re.compile(rb"\x1f\x8b\x08|WARC/1\.[0-9]\r?\n")
_VERSION = re.compile(rb"WARC/1\.[0-9]\r?\n")


def _dechunked(body: bytes) -> bytes:
    """A chunked HTTP body without its chunk lines, as far as they are in order."""
    out, at = [], 0
    while m := re.compile(rb"([0-9A-Fa-f]{1,15})[^\r\n]*\r\n").match(body, at):
        size = int(m[1], 16)
        out.append(body[m.end():m.end() + size])
        at = m.end() + size + 2
        if not size:
            break
    return b"".join(out)


def _payloads(headers: dict, block: bytes) -> Iterator[bytes]:
    """What the payload digest may cover: the block, of an HTTP message its body as sent or as put together."""
    if not headers.get("content-type", "").lower().startswith("application/http"):
        yield block
        return
    end = re.search(rb"\r?\n\r?\n", block)
    body = block[end.end():] if end else b""
    yield body
    if end and re.search(rb"(?im)^transfer-encoding:.*chunked", block[:end.start()]):
        yield _dechunked(body)


def _has_digest(stated: str, data: bytes) -> bool:
    found = hashlib.sha1(data).hexdigest()
    return stated[5:].upper() == _base32(found) or stated[5:].lower() == found


def parse_record(data: bytes, at: int, places: Places | None = None) -> tuple[dict, bytes, int]:
    """The record that begins at ``data[at]``: headers, body, and the position behind it.

    Header lines are read one by one up to MOST_HEADERS bytes, so a version line that begins
    no record costs no more than the lines that look like headers behind it.
    """
    places = places or Places(data)
    version = _VERSION.match(data, at)
    if not version:
        raise BadRecord("no version line")
    end = places.next(RECORD_END, at)
    if end == len(data):
        raise BadRecord("headers not ended")
    if end - at > MOST_HEADERS:
        raise BadRecord("headers too long")
    headers, begin = {}, at
    while begin < end:
        stop = min(places.next(b"\r\n", begin), end)
        if begin > at:
            name, colon, value = data[begin:stop].partition(b":")
            if not colon:
                raise BadRecord("header without a colon")
            headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        begin = stop + 2
    if not re.fullmatch(r"\d{1,15}", headers.get("content-length", "")):
        raise BadRecord("no valid length")
    start = end + len(RECORD_END)
    stop = start + int(headers["content-length"])
    if data[stop:stop + len(RECORD_END)] != RECORD_END:
        raise BadRecord("no end of record at the declared length")
    body = data[start:stop]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and not _has_digest(digest, body):
        raise BadRecord("block digest differs")
    digest = headers.get("warc-payload-digest", "")
    # a revisit has no payload, a segment only a part of it
    if (headers.get("warc-type") != "revisit" and "warc-segment-number" not in headers
            and digest.startswith("sha1:") and not any(_has_digest(digest, x) for x in _payloads(headers, body))):
        raise BadRecord("payload digest differs")
    return headers, body, stop + len(RECORD_END)


def _check_member_header(data: bytes, at: int, places: Places) -> None:
    """A gzip header that ends within MOST_HEADERS bytes; its strings are looked up, not inflated."""
    if len(data) < at + 10:
        raise BadRecord("gzip member cut off")
    flags, pos = data[at + 3], at + 10
    if flags & 0xE0:
        raise BadRecord("gzip: reserved flags")
    if flags & 4:                                            # extra fields with their length
        pos += 2 + int.from_bytes(data[pos:pos + 2], "little")
    for bit in (8, 16):                                      # name and comment, each up to a zero
        if flags & bit:
            pos = places.next(b"\0", pos) + 1
    if pos > len(data):
        raise BadRecord("gzip member cut off")
    if pos - at > MOST_HEADERS + (1 << 16):
        raise BadRecord("gzip header too long")


def member_at(data: bytes, at: int, window: int = 1 << 16) -> tuple[bytes, int]:
    """The gzip member at ``data[at]`` and the position behind it, read window by window."""
    unpack, parts, view, pos = zlib.decompressobj(31), [], memoryview(data), at
    try:
        while not unpack.eof and pos < len(data):
            chunk = view[pos:pos + window]
            parts.append(unpack.decompress(chunk))
            pos += len(chunk)
    except zlib.error as e:
        raise BadRecord(f"gzip: {e}") from None
    if not unpack.eof:
        raise BadRecord("gzip member cut off")
    return b"".join(parts), pos - len(unpack.unused_data)


def partial_member(data: bytes, at: int, window: int = 1 << 16) -> tuple[bytes, list[tuple[int, int]], int | None]:
    """What inflates of a damaged gzip member, window by window and byte by byte in the last one.

    Returns the content, marks (bytes inflated, position behind their source), and the
    position behind the member if only its checksum or length is wrong.
    """
    unpack, content, marks, view, pos = zlib.decompressobj(31), bytearray(), [], memoryview(data), at
    while not unpack.eof and pos < len(data):
        try:
            piece = unpack.decompress(view[pos:pos + window])
            if window > 1 and pos + window >= len(data) and not unpack.eof:
                raise zlib.error("cut off")
            content += piece
        except zlib.error as e:
            if window == 1:
                behind = {"incorrect data check": 5, "incorrect length check": 1}.get(str(e).rpartition(": ")[2])
                return bytes(content), marks, behind and min(pos + behind, len(data))
            unpack, window = zlib.decompressobj(31), 1
            unpack.decompress(view[at:pos])
            continue
        pos = min(pos + window, len(data))
        marks.append((len(content), pos))
    return bytes(content), marks, None


def _records(content: bytes) -> Iterator[tuple]:
    """('record', start, end, headers, body) and ('gap', start, end, reason, None) of inflated bytes."""
    at, bad_from, reason = 0, None, ""
    places = Places(content)
    while at < len(content):
        try:
            headers, body, end = parse_record(content, at, places)
        except BadRecord as e:
            if bad_from is None:
                bad_from, reason = at, str(e)
            following = _VERSION.search(content, at + 1)
            at = following.start() if following else len(content)
            continue
        if bad_from is not None:
            yield "gap", bad_from, at, reason, None
            bad_from = None
        yield "record", at, end, headers, body
        at = end
    if bad_from is not None:
        yield "gap", bad_from, len(content), reason, None


def _of_member(data: bytes, at: int, places: Places) -> tuple[list[tuple], int, str | None]:
    """Records and gaps of the gzip member at ``data[at]``, the position behind them, and why it breaks off there.

    Raises BadRecord if there is content but no record in it, or a single record
    and nothing else in a member without an end.
    """
    error, behind = None, None
    _check_member_header(data, at, places)
    try:
        content, behind = member_at(data, at)
    except BadRecord as e:
        error = str(e)
        content, marks, behind = partial_member(data, at)
    inner = list(_records(content))
    good = [f[2] for f in inner if f[0] == "record"]
    broken = error if behind is None else None
    if not good and (error or inner) or broken and len(inner) == 1 and good[-1] == len(content):
        raise BadRecord(error or inner[0][3])
    if broken:                                          # the rest belongs to the gap behind
        inner = [f for f in inner if f[1] < good[-1]]
        behind = next(pos for made, pos in marks if made >= good[-1])
    found = [(kind, at, behind, what if kind == "record" else f"{what}, inflated bytes {a} to {b}", body)
             for kind, a, b, what, body in inner]
    if error and not broken:
        found.append(("gap", behind, behind, error, None))
    return found, behind, broken and f"{broken}, behind inflated byte {good[-1]}"


def salvage(data: bytes) -> Iterator[tuple]:
    """('record', start, end, headers, body) and ('gap', start, end, reason, None) in file order."""
    at, bad_from, reason = 0, None, ""
    places = Places(data)
    while at < len(data):
        broken = None
        try:
            if _MEMBER.match(data, at):
                found, end, broken = _of_member(data, at, places)
            else:
                headers, body, end = parse_record(data, at, places)
                found = [("record", at, end, headers, body)]
        except BadRecord as e:
            if bad_from is None:
                bad_from, reason = at, str(e)
            following = _RESYNC.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if bad_from is not None:
            yield "gap", bad_from, at, reason, None
            bad_from = None
        yield from found
        at = end
        if broken and (at == len(data) or _MEMBER.match(data, at)):
            yield "gap", at, at, broken, None
        elif broken:
            bad_from, reason = at, broken
            following = _RESYNC.search(data, at)
            at = following.start() if following else len(data)
    if bad_from is not None:
        yield "gap", bad_from, len(data), reason, None


READ = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("start_byte", T.LongType()), T.StructField("end_byte", T.LongType()),
    T.StructField("reason", T.StringType()), T.StructField("record_id", T.LongType()),
    T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("payload", T.BinaryType())])


def _number(text: str | None) -> int | None:
    m = re.fullmatch(r"(?:<urn:record:)?(-?\d{1,19})>?", text or "")
    return int(m[1]) if m else None


def _row(archive: str, found: tuple, with_payload: bool) -> tuple:
    kind, start, end, what, body = found
    if kind == "gap":
        return archive, kind, start, end, what, *[None] * 7
    digest = what.get("warc-payload-digest", "")
    hex_digest = (base64.b32decode(digest[5:]).hex() if re.fullmatch(r"sha1:[A-Z2-7]{32}", digest)
                  else hashlib.sha1(body).hexdigest())
    size = _number(what.get("x-payload-length")) if what.get("warc-type") == "revisit" else len(body)
    return (archive, kind, start, end, None, _number(what.get("warc-record-id")), what.get("warc-target-uri"),
            what.get("warc-type"), size, hex_digest, _number(what.get("warc-refers-to")),
            body if with_payload else None)


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records (kind ``record``) and quarantined gaps (kind ``gap``) of the archives at ``path``."""
    ship_code(spark)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*").load(path).select("path", "content"))
    names = READ.fieldNames()

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                archive, data = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                rows, size = [], 0
                for found in salvage(data):
                    rows.append(_row(archive, found, with_payload))
                    size += len(found[4] or b"") if with_payload else 0
                    if len(rows) >= 2000 or size > 8 << 20:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    return files.mapInArrow(run, READ)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(),
             pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
