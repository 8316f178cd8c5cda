"""WARC archives of web pages: written, normalised to one gzip member a record, indexed and read back.

Archives often come as one gzip stream over the whole file, which can only be
read from its start.  The normaliser inflates such a stream once, cuts it at
the records' own lengths, writes each record as a gzip member of its own and
puts a sidecar beside the new file: a line per record with the place of its
member.  With it any record is read by one range request.  Nothing is held but
a chunk: a record's block goes from the one stream to the other in pieces.

Pages with equal payloads share one: the page with the largest id is written
as a response, the others as revisits that name it.  A revisit keeps the HTTP
head (with the payload's length) and the digest, not the payload.

Files are written by the tasks, under names that hold the attempt, and are
known by the rows that the tasks return: what a lost or repeated attempt left
behind is in no row, so it is never read.  The folder must be one that every
executor can open through ``pyarrow.fs`` (a mounted path, HDFS or an object
store); by default it lies in the session's shared scratch space.

Defined results: a null payload is empty; an empty payload is a record like any
other.  A null id is a record without an id: it revisits an equal page that has
one, and is a response if none has.  Rows that repeat both id and payload are
responses or revisits alike.  An empty table gives no archive and no row.
Only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import shared_dir

from .common import stored

#: Inflated bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
#: Bytes that are read at a time.
CHUNK = 1 << 20
GZIP = 31  # zlib's window bits for a gzip member
# Fixed values of the format.
VERSION, END, GAP = b"WARC/1.1", b"\r\n\r\n", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_ID = "<urn:page:{}>"
_ARCHIVES = "archive string, records long, bytes long"
_NORMAL = "archive string, sidecar string, records long, bytes long"
_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, at long, length long"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def head(fields: list[tuple[str, str]]) -> bytes:
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: its head, its block and the gap behind it."""
    own = "" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    uri = urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~") if url else f"urn:page:{own}"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _ID.format(own)),
              ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", _ID.format(refers_to)), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return head(fields) + block + GAP


def decided(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): of equal payloads of at least ``least`` bytes all but the largest id refer to that.

    Only (digest, id) pairs are shuffled for the choice.  The chosen ids of payloads that several rows share are
    stored first, so the join sees their real size: where they are small they are broadcast and the pages stay in place.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"),
                     (F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("same", F.sha2("html", 256))
    several = (p.where(F.octet_length("html") >= least).groupBy("same").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("rows"))
               .where("rows > 1 and keep is not null").select("same", "keep"))
    j = p.join(stored(several, "payloads"), "same", "left")
    return j.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep")).alias("refers_to"))


class _Writer:
    """An archive being written: records are packed as one stream, or each as a member of its own."""

    def __init__(self, path: str, level: int, members: bool):
        fs, at = _open(path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.path, self.level, self.members = path, level, members
        self.out = fs.open_output_stream(at, compression=None)
        self.packer = None if members else self._packer()
        self.records = self.raw = self.at = 0
        self.start, self.entries = 0, []

    def _packer(self):
        return zlib.compressobj(self.level, zlib.DEFLATED, GZIP)

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.at += len(data)

    def begin(self) -> None:
        self.start = self.at
        if self.members:
            self.packer = self._packer()

    def add(self, data: bytes) -> None:
        self.raw += len(data)
        self._put(self.packer.compress(data))

    def end(self, about: str = "") -> None:
        self.records += 1
        if self.members:
            self._put(self.packer.flush())
            self.entries.append(f"{self.start}\t{self.at - self.start}\t{about}\n")

    def close(self) -> None:
        if not self.members:
            self._put(self.packer.flush())
        self.out.close()


def _attempt() -> str:
    t = TaskContext.get()
    return f"{t.partitionId():05d}-{t.taskAttemptId()}"


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


def write(chosen: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 1) -> DataFrame:
    """Write ``decided`` pages as monolithic archives under ``root``; (archive, records, inflated bytes), a row each."""

    def run(batches):
        made, seq = None, 0
        for batch in batches:
            names = ("page_id", "url", "html", "refers_to")
            for page_id, url, html, refers_to in zip(*[batch.column(n).to_pylist() for n in names]):
                if made is None:
                    made = _Writer(f"{root}/whole/{_attempt()}-{seq}.warc.gz", level, members=False)
                    seq += 1
                made.add(record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to))
                made.end()
                if made.raw >= archive_bytes:
                    made.close()
                    yield _table([(made.path, made.records, made.raw)], _ARCHIVES)
                    made = None
        if made is not None:
            made.close()
            yield _table([(made.path, made.records, made.raw)], _ARCHIVES)

    return stored(chosen.mapInArrow(run, _ARCHIVES), "archives")


def inflated(path: str) -> Iterator[bytes]:
    """The inflated stream of a gzip file of one or many members, in chunks."""
    fs, at = _open(path)
    with fs.open_input_stream(at, compression=None) as src:
        unpack, data = zlib.decompressobj(GZIP), b""
        while True:
            data = data or src.read(CHUNK)
            if not data:
                if unpack is not None:
                    if rest := unpack.flush():  # what the last call had no room for
                        yield rest
                    if not unpack.eof:
                        raise ValueError(f"{path}: the gzip stream is cut off")
                return
            if unpack is None:
                unpack = zlib.decompressobj(GZIP)
            out = unpack.decompress(data, CHUNK)
            data = unpack.unconsumed_tail
            if unpack.eof:
                data, unpack = unpack.unused_data, None
            if out:
                yield out


def fields_of(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not the head of a record: {lines[0][:40]!r}")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def pieces(chunks: Iterator[bytes]) -> Iterator[tuple[str, object]]:
    """Cut a stream of records: ("head", fields and bytes), ("block", bytes) in pieces, ("end", None), again and again."""
    buffer = b""
    for chunk in chunks:
        buffer += chunk
        while (cut := buffer.find(END)) >= 0:
            raw, buffer = buffer[:cut + len(END)], buffer[cut + len(END):]
            fields = fields_of(raw.lstrip(b"\r\n"))
            yield "head", (fields, raw.lstrip(b"\r\n"))
            left = int(fields["content-length"])
            while left:
                if not buffer:
                    buffer = next(chunks, b"")
                    if not buffer:
                        raise ValueError("the archive ends within a record")
                piece, buffer = buffer[:left], buffer[left:]
                left -= len(piece)
                yield "block", piece
            yield "end", None
            while len(buffer) < len(GAP) and (more := next(chunks, b"")):
                buffer += more
            if buffer[:len(GAP)] == GAP:
                buffer = buffer[len(GAP):]
    if buffer.strip(b"\r\n"):
        raise ValueError("the archive ends within a head")


def normalise_one(path: str, target: str, level: int) -> tuple[str, str, int, int]:
    out, about = _Writer(target, level, members=True), ""
    for kind, value in pieces(inflated(path)):
        if kind == "head":
            fields, raw = value
            about = f"{fields.get('warc-type', '')}\t{fields.get('warc-record-id', '')}"
            out.begin()
            out.add(raw)
        elif kind == "block":
            out.add(value)
        else:
            out.add(GAP)
            out.end(about)
    out.close()
    fs, at = _open(f"{target}.idx")
    with fs.open_output_stream(at, compression=None) as sidecar:
        sidecar.write("".join(out.entries).encode())
    return target, f"{target}.idx", out.records, out.at


def normalise(archives: DataFrame, root: str, level: int = 6) -> DataFrame:
    """Rewrite each gzip archive record by record, with a sidecar; (archive, sidecar, records, bytes), a row each.

    A gzip stream has one reader, so an archive is a task's work; the archives are dealt out one by one.
    """
    def run(batches):
        for batch in batches:
            for i, path in enumerate(batch.column("archive").to_pylist()):
                name = path.rsplit("/", 1)[-1].removesuffix(".warc.gz")
                yield _table([normalise_one(path, f"{root}/records/{name}-{_attempt()}-{i}.warc.gz", level)], _NORMAL)

    n = max(1, archives.count())
    return stored(archives.select("archive").repartition(n).mapInArrow(run, _NORMAL), "normalised")


def _number(record_id: str | None) -> int | None:
    text = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    cut = raw.index(END) + len(END)
    fields = fields_of(raw[:cut])
    return fields, raw[cut:cut + int(fields["content-length"])]


def read(normalised: DataFrame) -> DataFrame:
    """Every record of the normalised archives, by range reads of its member at the place that the sidecar gives.

    A response's length and digest are those of the payload read (a digest that its head does not give is refused);
    a revisit's are those that its heads give.
    """
    def one(fs, src, archive, line):
        at, length, _, record_id = line.rstrip("\n").split("\t")
        fields, block = parsed(zlib.decompress(src.read_at(int(length), int(at)), GZIP))
        if fields["warc-record-id"] != record_id:
            raise ValueError(f"{archive}: the sidecar gives another record at {at}")
        cut = block.index(END) + len(END)
        said = fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "response":
            payload = block[cut:]
            if digest(payload) != said:
                raise ValueError(f"{archive}: the payload at {at} has another digest")
            size = len(payload)
        else:
            http = dict(x.split(": ", 1) for x in block[:cut].decode().split("\r\n")[1:] if x)
            size = int(http["Content-Length"])
        return (_number(record_id), size, said, fields["warc-type"], _number(fields.get("warc-refers-to")), archive, int(at), int(length))

    def run(batches):
        for batch in batches:
            for archive, sidecar in zip(batch.column("archive").to_pylist(), batch.column("sidecar").to_pylist()):
                fs, at = _open(sidecar)
                with fs.open_input_stream(at, compression=None) as f:
                    lines = f.read().decode().splitlines()
                fs, at = _open(archive)
                with fs.open_input_file(at) as src:
                    for i in range(0, len(lines), 4096):
                        yield _table([one(fs, src, archive, x) for x in lines[i:i + 4096]], _RECORDS)

    n = max(1, normalised.count())
    return normalised.select("archive", "sidecar").repartition(n).mapInArrow(run, _RECORDS)


def archive_pages(pages: DataFrame, root: str | None = None, least: int = 0) -> DataFrame:
    """Write, normalise and index ``pages``; the normalised archives, a row each."""
    root = root or shared_dir(pages.sparkSession, "warc")
    return normalise(write(decided(pages, least), root), root)


def report(pages: DataFrame) -> DataFrame:
    return read(archive_pages(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
