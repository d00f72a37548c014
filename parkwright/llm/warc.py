"""WARC archives: a writer, and a reader that splits them at any byte.

The writer puts one gzip member per record into one file per task. Of pages with
equal payloads, that with the largest id is a response; the others are revisits of
it, without its payload but with its length and digest in their headers. Nothing
in a compressed record looks like the start of another: a record in which the
gzip magic followed by a decodable record header occurs is compressed anew, at last
with fixed codes in blocks of a few bytes, until none does.

The reader takes (file, start, end) splits. A task looks for the gzip magic in
its range, tries each candidate by decoding its first bytes, and owns the records
whose member starts inside, reading past its end to finish the last. A split's
cost is that of its bytes; hot files need no care. Splits are dealt out to as many
tasks as there are splits, TASKS at most, whatever the few bytes of their rows weigh.

Files are reached through pyarrow.fs by URI, in the shared folder. A task writes
under a name of its own attempt and renames it when whole, so a rerun leaves one
file for each partition. Payloads are not shuffled: revisits are found on
(page_id, digest) rows and joined back, by broadcast where their number was
checked.

Defined cases: a null html is an empty payload, and equal to other empty ones.
Repeated rows of the largest id of a payload are all responses. A null id never
is a revisit's target unless all ids are null, when all are responses; null urls
become urn:page:ID. Broken or foreign members are skipped. Very long pages are one
member each, held in memory compressed and whole, in time that grows with their
length. Columns beyond page_id, url and html are not looked at, whatever their names.
No rows in: no records.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parkwright.llm.shared import BROADCAST_ROWS, cut, new_path

SPLIT_BYTES, STEP, HEAD, MAGIC, TASKS = 4 << 20, 1 << 18, 64, b"\x1f\x8b\x08", 20_000
_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _deflate(data: bytes, strategy: int, block: int = 0) -> bytes:
    """``data`` as a gzip member; with ``block``, flushed after so many bytes each time."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31, 8, strategy)
    if not block:
        return c.compress(data) + c.flush()
    parts = [c.compress(data[i : i + block]) + c.flush(zlib.Z_SYNC_FLUSH) for i in range(0, len(data), block)]
    return b"".join(parts) + c.flush()


def starts_record(data: bytes | bytearray, at: int) -> bool:
    """Whether a gzip member at ``at`` decodes to the header of a record."""
    try:
        return zlib.decompressobj(31).decompress(data[at : at + 4096], HEAD).startswith(b"WARC/1.")
    except zlib.error:
        return False


def seems_to_hold_another(packed: bytes) -> bool:
    at = 0
    while (at := packed.find(MAGIC, at + 1)) > 0:
        if starts_record(packed, at):
            return True
    return False


def member(data: bytes) -> bytes:
    """``data`` as a gzip member, inside which no other record seems to start.

    What gets through every strategy (only literal bytes at byte boundaries could) is
    broken up by flushes at ever other places, so some way of writing it is found.
    """
    whole = ((s, 0) for s in (zlib.Z_DEFAULT_STRATEGY, zlib.Z_HUFFMAN_ONLY, zlib.Z_RLE, zlib.Z_FIXED))
    flushed = ((zlib.Z_FIXED, 7 + 2 * i) for i in itertools.count())
    for way in itertools.chain(whole, flushed):
        if not seems_to_hold_another(packed := _deflate(data, *way)):
            return packed
    raise AssertionError("unreachable: the ways don't end")


def _line(value: object) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in str(value))


def encode(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.0 record of an HTTP response, or of a revisit of ``refers_to``."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {_line(name(page_id)[1:-1] if url is None else url)}", f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def decode(record: bytes) -> dict | None:
    """The fields of a record; None if it isn't whole."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    if not fields.get("Content-Length", "").isdigit() or len(rest) < int(fields["Content-Length"]):
        return None
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    revisit = fields.get("WARC-Type") == "revisit"
    number = lambda key: int(x) if (x := fields.get(key, "").removeprefix("<urn:page:").rstrip(">")).lstrip("-").isdigit() else None
    lengths = [x[15:].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(lengths[0]) if revisit and lengths else len(payload),
        "payload_digest": fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") if revisit else digest(payload),
        "record_type": "revisit" if revisit else "response", "refers_to": number("WARC-Refers-To") if revisit else None, "payload": None if revisit else payload,
    }


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``; return their (file, bytes)."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    groups = own.select("page_id", F.sha1("payload").alias("sha")).groupBy("sha").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = cut(groups.where("n > 1 and last is not null"), "equal")
    digests = own.select("page_id", F.sha1("payload").alias("sha")).alias("p")
    # copies of one payload can be many rows of one digest: both sides come from an exchange, which adaptive execution splits
    copies = digests.join(groups.alias("g"), "sha").where("page_id is null or page_id <> last")
    revisits = cut(copies.select("page_id", "sha", "last").distinct(), "revisits")
    n = revisits.count()
    tagged = own.withColumn("sha", F.sha1("payload")).alias("o")
    on = F.col("o.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("o.sha") == F.col("r.sha"))
    if n:
        tagged = tagged.join((F.broadcast(revisits) if n <= BROADCAST_ROWS else revisits).alias("r"), on, "left").select("o.page_id", "url", "payload", "last", F.col("r.sha").isNotNull().alias("revisit"))
    else:
        tagged = tagged.select("page_id", "url", "payload", F.expr("cast(null as long)").alias("last"), F.lit(False).alias("revisit"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        final = f"{root}/part-{context.partitionId():06d}.warc.gz"
        draft, size = f"{final}.{context.taskAttemptId()}.tmp", 0
        with store.open_output_stream(draft, compression=None) as out:
            for b in batches:
                for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                    page_id, url, payload, last, revisit = row
                    size += out.write(packed := member(encode(page_id, url, payload, last, revisit))) or len(packed)
        store.move(draft, final)
        yield pa.RecordBatch.from_pydict({"file": [final], "bytes": [size]})

    written = tagged.mapInArrow(work, "file string, bytes long")
    return cut(written, "archives")


class _Window:
    """Bytes of a file by position, read in steps."""

    def __init__(self, file, start: int):
        # grows at one end and shrinks at the other without copying what is between
        self.file, self.start, self.data = file, start, bytearray()
        file.seek(start)

    def more(self) -> bool:
        got = self.file.read(STEP)
        self.data += got
        return bool(got)

    def skip(self, n: int) -> None:
        del self.data[:n]
        self.start += n


def records(file, start: int, end: int) -> Iterator[dict]:
    """The records of the open ``file`` whose gzip members start in [start, end)."""
    w = _Window(file, start)
    while w.start < end:
        at = w.data.find(MAGIC)
        if at < 0:
            w.skip(max(0, len(w.data) - 2))
            if not w.more():
                return
            continue
        w.skip(at)
        while len(w.data) < 4096 and w.more():
            pass
        if w.start >= end:
            return
        if not starts_record(w.data, 0):
            w.skip(1)
            continue
        d, parts, fed = zlib.decompressobj(31), [], 0
        try:
            while not d.eof:
                if fed == len(w.data) and not w.more():
                    break
                parts.append(d.decompress(bytes(memoryview(w.data)[fed:])))
                fed = len(w.data)
        except zlib.error:
            w.skip(1)
            continue
        if not d.eof or (found := decode(b"".join(parts))) is None:
            w.skip(1)
            continue
        yield found
        w.skip(len(w.data) - len(d.unused_data))


def read(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of archives (file, bytes), by byte ranges of ``split_bytes``."""
    splits = files.where("bytes > 0").select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    # a stated number of partitions is kept by adaptive execution, which would join them by the size of the splits' rows
    tasks = min(splits.count(), TASKS)
    scheme = shared_scheme(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(scheme)
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held, size = [], 0
                with store.open_input_file(path) as file:
                    for r in records(file, start, start + split_bytes):
                        held.append(r)
                        size += len(r["payload"] or b"") + 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return splits.repartition(max(tasks, 1)).mapInArrow(work, _RECORD)


def shared_scheme(spark: SparkSession) -> str:
    from parkwright.llm.shared import shared_root

    return shared_root(spark)


def round_trip(pages: DataFrame) -> DataFrame:
    """The records of ``pages`` written as archives to the shared folder and read back."""
    spark = pages.sparkSession
    return read(spark, write(pages, new_path(spark, "warc")))
