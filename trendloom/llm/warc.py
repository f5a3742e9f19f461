"""WARC archives: writing, and the normaliser of monolithic gzip files.

A monolithic archive is one gzip stream over all its records, so no record can be read on its own. The
normaliser inflates such a file once, as a stream, rewrites every record as its own gzip member, and
writes a sidecar index with the offset and length of each member; a record is then one ranged read.
A file is one task (a gzip stream has no inner entry points) and is read in pieces: records pass through
in pieces too, so memory does not depend on the size of the file or of a record. The writer closes an
archive at ``ARCHIVE_BYTES``.

Of the records with equal payloads of at least ``REVISIT_BYTES`` bytes that with the smallest page id is the
response; the others are revisits with no payload. Only payloads that occur more than once are
joined back, so html is not shuffled unless Spark finds that table too large to send around.

Files go to the shared folder through its file system, under a name of the attempt, and are renamed when
complete: a task that runs again, or twice, leaves the same file. Null html is empty, and empty or
short payloads are always responses. Pages that repeat the id of a response are responses as well;
equal payloads without any page id are all responses. Other columns are ignored.
"""
from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.session import materialize, scratch_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20            # inflated bytes after which the writer starts another archive
_BLOCK = 1 << 20
_GZIP = 31                           # zlib window bits of a gzip stream
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "archive string, records long"
INDEX = "archive string, offset long, length long, record_id string, type string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def _open(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(folder)


class _Output:
    """A file under an attempt's name that gets its own name when it is complete."""

    def __init__(self, folder: str, name: str) -> None:
        self.fs, base = _open(folder)
        self.fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        attempt = context.taskAttemptId() if context else 0
        self.path, self.hidden = f"{base}/{name}", f"{base}/_{name}.{attempt}"
        self.stream, self.at = self.fs.open_output_stream(self.hidden, compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.hidden, self.path)


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else int(page_id)}>"


def page_of_name(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A response record, or a revisit of ``refers_to`` with the header of its payload only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url or "about:blank")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_name(page_id)),
            ("WARC-Date", date), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", "sha256:" + hashlib.sha256(payload).hexdigest())]
    if revisit:
        head += [("WARC-Refers-To", record_name(refers_to)), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    """Fields of a record's or an HTTP header, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines) if k}


def with_reference(pages: DataFrame, id_col: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """``page_id, url, html, refers_to``: the response each page revisits, null for responses."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    long_enough = F.octet_length("html") >= REVISIT_BYTES
    digest = F.when(long_enough, F.sha2(F.encode("html", "UTF-8"), 256))
    repeated = materialize(
        rows.select("page_id", digest.alias("digest")).where("digest is not null").groupBy("digest")
        .agg(F.min("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("digest", "response"), "warc-repeated")
    joined = rows.withColumn("digest", digest).join(repeated, "digest", "left")
    return joined.select("page_id", "url", "html", F.when(
        ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias("refers_to"))


def write_monolithic(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``with_reference`` into monolithic archives; gives ``archive, records``."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, n, out, packer, held, records = TaskContext.get().partitionId(), 0, None, None, 0, 0

        def close() -> pd.DataFrame:
            out.write(packer.flush())
            out.close()
            return pd.DataFrame({"archive": [out.path.rpartition("/")[2]], "records": [records]})
        for batch in batches:
            for page_id, url, html, refers_to in batch.itertuples(index=False, name=None):
                if out is None:
                    out, packer, held, records = _Output(folder, f"part-{part:06d}-{n:04d}.warc.gz"), \
                        zlib.compressobj(6, zlib.DEFLATED, _GZIP), 0, 0
                    n += 1
                record = record_bytes(_whole(page_id), url, html.encode("utf-8", "surrogatepass"), _whole(refers_to))
                out.write(packer.compress(record))
                held, records = held + len(record), records + 1
                if held >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    return materialize(pages.mapInPandas(write, MANIFEST), "warc-manifest")


def _whole(x) -> int | None:
    return None if x is None or pd.isna(x) else int(x)


def inflate(stream) -> Iterator[bytes]:
    """The bytes of a gzip file, whether it is one stream or several members."""
    opener, fresh = zlib.decompressobj(_GZIP), True
    while data := stream.read(_BLOCK):
        while data:
            fresh = False
            yield opener.decompress(data, _BLOCK)
            while opener.unconsumed_tail:
                yield opener.decompress(opener.unconsumed_tail, _BLOCK)
            data = opener.unused_data
            if opener.eof:
                opener, fresh = zlib.decompressobj(_GZIP), True
    if not fresh:
        raise ValueError("the archive is cut off")


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Header fields and the raw bytes of each record, in pieces; the pieces must be used up in turn."""
    held = b""
    while True:
        while b"\r\n\r\n" not in held:
            piece = next(pieces, None)
            if piece is None:
                if held.strip():
                    raise ValueError("a record is cut off")
                return
            held += piece
        head, _, held = held.partition(b"\r\n\r\n")
        fields = parse_head(head)
        left = int(fields["content-length"]) + 4

        def body(head=head, left=left) -> Iterator[bytes]:
            nonlocal held
            yield head + b"\r\n\r\n"
            while left:
                if not held:
                    held = next(pieces, None)
                    if held is None:
                        raise ValueError("a record is cut off")
                taken, held = held[:left], held[left:]
                left -= len(taken)
                yield taken
        yield fields, body()


def normalise_file(source: str, folder: str, name: str) -> int:
    """Rewrite one archive member by member into ``folder`` with its sidecar index; gives the records."""
    fs, base = _open(source)
    out, index, n = _Output(folder, name), _Output(folder, name + ".index.json"), 0
    with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
        for fields, raw in split_records(inflate(stream)):
            start, packer = out.at, zlib.compressobj(6, zlib.DEFLATED, _GZIP)
            for piece in raw:
                out.write(packer.compress(piece))
            out.write(packer.flush())
            index.write((json.dumps({
                "archive": name, "offset": start, "length": out.at - start,
                "record_id": fields.get("warc-record-id"), "type": fields.get("warc-type")}) + "\n").encode())
            n += 1
    out.close()
    index.close()
    return n


def normalise(manifest: DataFrame, source: str, folder: str) -> DataFrame:
    """Normalise every archive of a manifest, one task each; gives ``archive, records`` as rewritten."""
    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["archive"]:
                yield pd.DataFrame({"archive": [name], "records": [normalise_file(source, folder, name)]})
    spread = manifest.select("archive").repartition(
        int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "archive")
    return materialize(spread.mapInPandas(rewrite, MANIFEST), "warc-normalised")


def read_record(member: bytes) -> dict:
    """One record from its own member. A response's digest is that of the payload read back, and ``intact``
    says whether its header states the same; a revisit has no payload, so its header's digest stands."""
    (fields, raw), = ((f, b"".join(b)) for f, b in split_records(iter([zlib.decompress(member, _GZIP)])))
    _, _, block = raw.partition(b"\r\n\r\n")
    http, _, payload = block[:-4].partition(b"\r\n\r\n")
    kind, stated = fields["warc-type"], fields["warc-payload-digest"].partition(":")[2]
    if kind == "response":
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        intact = digest == stated
    else:
        size, digest, intact = int(parse_head(http)["content-length"]), stated, True
    return {"page_id": page_of_name(fields["warc-record-id"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": page_of_name(fields.get("warc-refers-to")), "intact": intact}


def read_archives(spark, folder: str) -> DataFrame:
    """All records of normalised archives, found through their sidecar indexes by ranged reads. A record
    that is not intact is an error."""
    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(folder)
        name, source = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in batch[["archive", "offset", "length"]].itertuples(index=False, name=None):
                if archive != name:
                    name, source = archive, fs.open_input_file(f"{base}/{archive}")
                source.seek(offset)
                rows.append(read_record(source.read(length)))
                if not rows[-1]["intact"]:
                    raise ValueError(f"the payload of the record at {offset} of {archive} is damaged")
            frame = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"])
            yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})
    index = spark.read.schema(INDEX).json(f"{folder}/*.index.json")
    return index.mapInPandas(fetch, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", html: str = "html",
                  url: str = "url", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as monolithic archives, normalise them, and read every record back."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    manifest = write_monolithic(with_reference(pages, id_col, html, url), f"{folder}/whole", archive_bytes)
    rewritten = normalise(manifest, f"{folder}/whole", f"{folder}/normal")
    wanted, made = (df.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0] for df in (manifest, rewritten))
    if wanted != made:
        raise RuntimeError(f"{wanted} records written, {made} normalised")
    if not wanted:
        return spark.createDataFrame([], RECORDS).withColumnRenamed("page_id", id_col)
    return read_archives(spark, f"{folder}/normal").withColumnRenamed("page_id", id_col)
