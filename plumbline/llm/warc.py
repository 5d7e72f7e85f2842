"""WARC archives compressed with Zstandard: one frame for each record, a dictionary in the leading skippable frame.

Writing: records with equal payloads (SHA-1 and length) of at least ``least`` bytes share one ``response``, that of the largest
``page_id``; the others are ``revisit`` records that name it.  Each task writes archives of bounded size into the folder it is
given, under names never used twice, and returns their paths; only the paths of the attempt that counted are read, so a repeated or
lost attempt leaves at worst an unread file.

Reading: the dictionary is taken from the leading skippable frame (plain, or itself a Zstandard frame), each further frame is decoded
alone and must be one whole record: version line, well-formed headers, the mandatory ones once each, a ``Content-Length`` equal to the block's,
the closing line breaks and nothing after them, and block digest.  Records of other types (``warcinfo``, ``request``, ``metadata`` and unknown ones) are
checked so far and passed over; of responses and revisits the HTTP head, its length and the payload digest are checked as well.  Frames are streamed; one record
is in memory at a time.

A null ``html`` is the empty payload.  A null ``page_id`` counts as smaller than any other.  Repeated rows are written each; rows that share a
``page_id`` and a payload have the same record type.  An empty table gives no archive and no rows.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, sliced

DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
RECORDS = (
    "archive string, record_id string, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if name == f"<urn:page:{number}>" and number.lstrip("-").isdigit() and number.isascii() else None


def build(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record: a response with its payload, or a revisit that holds the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_frame(samples: list[bytes], size: int) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """The leading frame and its dictionary; nothing where the samples are too few to train one."""
    try:
        trained = zstandard.train_dictionary(size, samples)
    except zstandard.ZstdError:
        return b"", None
    body = zstandard.ZstdCompressor().compress(trained.as_bytes())
    return DICTIONARY_FRAME.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body, trained


def write_archives(
    pages: DataFrame, folder: str, least: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = 64 << 20, sample_bytes: int = 1 << 20, dictionary: int = 16 << 10
) -> DataFrame:
    """(archive, records, bytes) of the archives written for (page_id, url, html) rows.

    Lazy: write the result to a table before reading the archives.  A dictionary is trained in each task on its first
    ``sample_bytes`` of records, which affects sizes only.  ``folder`` is any address that Arrow's file systems reach.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload")})
    firsts = rows.where(F.col("size") >= least).groupBy("sha", "size").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1").drop("n")
    # a hot payload is spread by the adaptive skew join
    typed = rows.join(firsts, ["sha", "size"], "left").select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        done: list[tuple[str, int, int]] = []
        records = (
            build(*values, date)
            for batch in sliced(batches, "payload")
            for values in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")))
        )
        samples: list[bytes] = []
        size = 0
        for r in records:
            samples.append(r)
            size += len(r)
            if size >= sample_bytes:
                break
        lead, trained = dictionary_frame(samples, dictionary)
        packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)

        def rest() -> Iterator[bytes]:
            yield from samples
            samples.clear()
            yield from records

        out, name, n, size = None, "", 0, 0
        for r in rest():
            if out is None:
                name, n, size = f"{top}/{uuid.uuid4().hex}.warc.zst", 0, len(lead)
                out = store.open_output_stream(name, compression=None)
                out.write(lead)
            frame = packer.compress(r)
            out.write(frame)
            n, size = n + 1, size + len(frame)
            if size >= archive_bytes:
                out.close()
                done.append((name, n, size))
                out = None
        if out is not None:
            out.close()
            done.append((name, n, size))
        names = [folder.rstrip("/") + "/" + x[0].rpartition("/")[2] for x in done]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())], ["archive", "records", "bytes"])

    return typed.mapInArrow(run, "archive string, records long, bytes long")


def frames(read: Callable[[int], bytes], chunk: int = 64 << 10) -> Iterator[bytes]:
    """The decoded frames of one archive."""
    held, trained, leading = b"", None, True

    def have(n: int) -> bool:
        nonlocal held
        while len(held) < n:
            more = read(chunk)
            if not more:
                return False
            held += more
        return True

    while have(1):
        if not have(4):
            raise ValueError("cut off inside a frame's magic number")
        magic = int.from_bytes(held[:4], "little")
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if not have(8) or not have(8 + int.from_bytes(held[4:8], "little")):
                raise ValueError("skippable frame is cut off")
            n = 8 + int.from_bytes(held[4:8], "little")
            body, held = held[8:n], held[n:]
            if magic == DICTIONARY_FRAME and leading:
                if body[:4] == FRAME.to_bytes(4, "little"):
                    body = zstandard.ZstdDecompressor().decompress(body)
                trained = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_FULLDICT)
        elif magic == FRAME:
            decoder = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
            out = [decoder.decompress(held)]
            while not decoder.eof:
                more = read(chunk)
                if not more:
                    raise ValueError("frame is cut off")
                out.append(decoder.decompress(more))
            held = decoder.unused_data
            yield b"".join(out)
        else:
            raise ValueError(f"no frame starts with {magic:08x}")
        leading = False


def _fields(lines: list[str]) -> list[tuple[str, str]]:
    """(name in lower case, value) of header lines; a line that begins with white space goes on with the one before."""
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = out[-1][0], f"{out[-1][1]} {line.strip()}".strip()
            continue
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad header line {line[:80]!r}")
        out.append((name.lower(), value.strip()))
    return out


def _length(value: str) -> int:
    if not value.isascii() or not value.isdigit():
        raise ValueError("Content-Length is no number")
    return int(value)


def _differs(named: str, data: bytes) -> bool:
    """Whether a digest ``algorithm:value`` (base 32 or 16) is of other data; one of an unknown algorithm says nothing."""
    algorithm, _, value = named.partition(":")
    if algorithm.lower() not in ("md5", "sha1", "sha256", "sha512"):
        return False
    raw = hashlib.new(algorithm.lower(), data).digest()
    return value.upper().rstrip("=") not in (base64.b32encode(raw).decode().rstrip("="), raw.hex().upper())


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block) of one record of any type; ValueError says what is wrong with it.

    Names ignore case.  A header may stand once, but for ``WARC-Concurrent-To``, of which the last is kept.
    """
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version line or no end of headers")
    fields = _fields(lines[1:])
    headers = dict(fields)
    again = {n for n in headers if n != "warc-concurrent-to" and sum(x == n for x, _ in fields) > 1}
    if again:
        raise ValueError(f"headers repeated: {', '.join(sorted(again))}")
    lost = [x for x in MANDATORY if x.lower() not in headers]
    if lost:
        raise ValueError(f"headers missing: {', '.join(lost)}")
    n = _length(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, Content-Length says {n}")
    block = rest[:n]
    if _differs(headers.get("warc-block-digest", ""), block):
        raise ValueError("block digest differs")
    return headers, block


def _payload(headers: dict[str, str], block: bytes) -> tuple[bytes, int | None]:
    """(payload, length that its HTTP head states) of a block; without an HTTP head the block is the payload."""
    if not headers.get("content-type", "").lower().startswith("application/http"):
        return block, None
    http, gap, payload = block.partition(b"\r\n\r\n")
    lines = http.decode("latin-1").split("\r\n")
    if not gap or not lines[0].startswith("HTTP/"):
        raise ValueError("the block has no HTTP head")
    fields = _fields(lines[1:])
    sizes = {v for n, v in fields if n == "content-length"}
    if len(sizes) > 1:
        raise ValueError("the HTTP head has several lengths")
    if not sizes or any(n == "transfer-encoding" for n, _ in fields):
        return payload, None  # the stored bytes are the payload as it was sent
    return payload, _length(sizes.pop())


def page_record(record: bytes) -> tuple | None:
    """(record id, type, page id, url, full payload's length, its digest, page referred to) of a response or revisit, None of any other type.

    The HTTP length and the payload digest are optional and must be right where they stand (but for a record marked as truncated); a missing digest is computed.
    The length of a revisit's payload is null where its HTTP head does not state it.
    """
    headers, block = parse(record)
    kind, name = headers["warc-type"].lower(), headers["warc-record-id"]
    if kind not in ("response", "revisit"):
        return None
    payload, stated = _payload(headers, block)
    named, whole = headers.get("warc-payload-digest"), "warc-truncated" not in headers
    if kind == "revisit":
        if payload or named is None:
            raise ValueError("a revisit needs a digest and holds no payload")
        refers = page_of(headers.get("warc-refers-to", ""))
        return name, kind, page_of(name), headers.get("warc-target-uri"), stated, named.removeprefix("sha1:"), refers
    if whole and (stated not in (None, len(payload)) or (named is not None and _differs(named, payload))):
        raise ValueError("the payload's length or digest differs")
    return name, kind, page_of(name), headers.get("warc-target-uri"), len(payload), digest(payload) if named is None else named.removeprefix("sha1:"), None


def read_archives(archives: DataFrame, strict: bool = True) -> DataFrame:
    """The response and revisit records of the archives named in column ``archive``, one archive for each task at a time.

    Not ``strict``: what cannot be decoded or validated becomes a row with its reason in ``error`` instead of a failure; reading goes on
    behind a bad record, not behind a bad frame.
    """

    def of(name: str) -> Iterator[tuple]:
        store, path = fs.FileSystem.from_uri(name)
        with store.open_input_stream(path, compression=None) as stream:
            found = frames(stream.read)
            while True:
                try:
                    record = next(found)
                except StopIteration:
                    return
                except (ValueError, zstandard.ZstdError) as wrong:
                    if strict:
                        raise ValueError(f"{name}: {wrong}") from wrong
                    yield (name, *[None] * 7, str(wrong))
                    return
                try:
                    row = page_record(record)
                except ValueError as wrong:
                    if strict:
                        raise ValueError(f"{name}: {wrong}") from wrong
                    yield (name, *[None] * 7, str(wrong))
                    continue
                if row is not None:
                    yield (name, *row, None)

    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    names = [*(x.split()[0] for x in RECORDS.split(", ")), "error"]

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                for row in of(name):
                    rows.append(row)
                    if len(rows) >= 4096:
                        yield flush(rows)
                        rows = []
        yield flush(rows)

    return archives.select("archive").mapInArrow(run, RECORDS + ", error string")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write every page, then read the archives back; the archives lie in the work folder."""
    work = Scratch(pages.sparkSession, "warc")
    made = work.write(write_archives(pages, f"{work.at}/archives", least), "manifest")
    spread = made.repartition(2 * pages.sparkSession.sparkContext.defaultParallelism, "archive")
    return read_archives(spread)
