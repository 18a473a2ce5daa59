"""WARC archives of pages: a deterministic sharded writer and its reader.

Pages are range-sorted by page_id; each task writes its range as WARC 1.1 files, one gzip
member per record, and starts a new file when the compressed size passes a limit.  A file
begins with a warcinfo record.  The block of a response is an HTTP message: a status line and
headers made anew, and the html as its body; the payload digest is that of the html, the block
digest that of the whole block.  A URL stands in its header percent-encoded where a header
can't hold it as it is, and as written in WARC-Source-URL then.  Record
ids, lengths and digests are worked out anew from the payload; nothing depends on the
clock, so a repeated task writes the same bytes.  Files appear under their final names
when complete; the manifest lists those that count, and readers go by the manifest.

A payload of at least LEAST_SHARED bytes is stored once, with the smallest page_id that
has it; the others become revisit records that refer to it.  Which ones those are is
found from digests alone, so pages are shuffled once, for the range sort: the small
revisit rows are sorted along and each meets its page in the writer.

Defined cases: a null html is an empty payload; a null url leaves the header out; pages
without id sort first, never are referred to by number, and revisit a numbered page with
the same payload if there is one; rows that repeat page_id and payload are all responses
if that id is the smallest; other columns are ignored; no pages give no files."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import CommittedFile, file_per_task, keep, store
from marketlake.session import scratch_path

LEAST_SHARED = 100
ROLL_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6f1f3c1a-5d53-4c0e-9a55-0d6f3f6f2b11")
_READ = 1 << 20
_IN_URLS = ":/?#[]@!$&()*+,;=%~"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def _header_block(lines: list[str], body: bytes) -> bytes:
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _info(name: str) -> bytes:
    body = "software: marketlake\r\nformat: WARC File Format 1.1\r\n".encode()
    return _header_block(
        [
            "WARC/1.1",
            "WARC-Type: warcinfo",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_SPACE, name)}>",
            f"WARC-Date: {DATE}",
            f"WARC-Filename: {name}",
            "Content-Type: application/warc-fields",
            f"Content-Length: {len(body)}",
        ],
        body,
    )


def _message(payload: bytes) -> bytes:
    head = (
        "HTTP/1.1 200 OK\r\n"
        "Content-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    )
    return head.encode() + payload


def _record(page_id, url, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    body = _message(payload) if refers_to is None else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:
        target = quote(url, safe=_IN_URLS)
        lines.append(f"WARC-Target-URI: {target}")
        if target != url:
            lines.append(f"WARC-Source-URL: {quote(url, safe='')}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is None:
        lines.append(f"WARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}")
    else:
        lines.append(f"WARC-Profile: {PROFILE}")
        lines.append(f"WARC-Refers-To: {_record_id(refers_to, digest)}")
        lines.append(f"WARC-Refers-To-Page: {refers_to}")
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    lines += [
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return _header_block(lines, body)


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest, refers_to of the pages whose payload an earlier page has."""
    keys = keep(
        pages.select("page_id", F.coalesce("html", F.lit("")).alias("html"))
        .select("page_id", F.sha2("html", 256).alias("digest"), F.octet_length("html").alias("n"))
        .filter(F.col("n") >= LEAST_SHARED)
        .select("page_id", "digest"),
        "page-digests",
    )
    first = keys.groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")
    )
    return (
        keys.join(first.filter("n > 1 AND refers_to IS NOT NULL").drop("n"), "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def write_warc(
    pages: DataFrame, folder: str | None = None, roll_bytes: int = ROLL_BYTES
) -> tuple[str, DataFrame]:
    """Write pages (page_id, url, html); returns the folder and the manifest (file,
    records, bytes)."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.lit(1).alias("kind"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.lit(None).cast("long").alias("refers_to"),
    )
    marks = revisits(pages.withColumn("page_id", F.col("page_id").cast("long"))).select(
        "page_id",
        F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("url"),
        F.col("digest").alias("html"),
        "refers_to",
    )

    def write(batches):
        task = TaskContext.get().partitionId()
        out, files, records, known, current = None, [], 0, {}, None

        def close():
            size = out.tell()
            out.commit()
            files.append((name, records, size))

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for page_id, kind, url, html, refers_to in zip(*columns):
                if page_id != current:
                    known, current = {}, page_id
                if kind == 0:  # ahead of the page's own rows
                    known[html] = refers_to
                    continue
                payload = html.encode()
                digest = hashlib.sha256(payload).hexdigest()
                if out is None:
                    name = f"part-{task:06d}-{len(files):04d}.warc.gz"
                    out, records = CommittedFile(folder, name), 0
                    out.write(_member(_info(name)))
                out.write(_member(_record(page_id, url, payload, digest, known.get(digest))))
                records += 1
                if out.tell() >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if files:
            yield pa.RecordBatch.from_pydict(
                dict(zip(("file", "records", "bytes"), map(list, zip(*files))))
            )

    manifest = (
        rows.unionByName(marks)
        .repartitionByRange(F.col("page_id"))
        .sortWithinPartitions("page_id", "kind")
        .mapInArrow(write, "file string, records long, bytes long")
    )
    return folder, keep(manifest, "warc-manifest")


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of each record of a gzip stream, member by member."""
    unzip, raw, text = zlib.decompressobj(31), b"", b""
    while True:
        raw = raw or source.read(_READ)
        if not raw:
            break
        text += unzip.decompress(raw)
        raw = unzip.unused_data
        if not unzip.eof:
            continue
        head, _, rest = text.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        if not version.startswith("WARC/") or rest[length:] != b"\r\n\r\n":
            raise ValueError("broken WARC record")
        yield headers, rest[:length]
        unzip, text = zlib.decompressobj(31), b""
    if text:
        raise ValueError("WARC file ends inside a record")


def _payload_of(headers: dict[str, str], body: bytes) -> bytes | None:
    """The html in a response's message, its digests checked; None for a revisit."""
    if headers["WARC-Type"] != "response":
        return None
    head, _, payload = body.partition(b"\r\n\r\n")
    for name, data in (("WARC-Payload-Digest", payload), ("WARC-Block-Digest", body)):
        if headers[name] != f"sha256:{hashlib.sha256(data).hexdigest()}":
            raise ValueError(f"{name} of {headers['WARC-Record-ID']} doesn't match")
    if not head.startswith(b"HTTP/1.1 200 "):
        raise ValueError(f"no HTTP message in {headers['WARC-Record-ID']}")
    return payload


def _url_of(headers: dict[str, str]) -> str | None:
    written = headers.get("WARC-Source-URL")
    return headers.get("WARC-Target-URI") if written is None else unquote(written)


def read_warc(folder: str, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to; and payload (null for revisits) if asked for.  Digests are checked."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = (
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long"
    )
    if with_payload:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]
        schema += ", payload binary"

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def batch_of(rows):
        columns = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
        )

    def read(batches):
        fs, inner = store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{inner}/{name}", compression=None) as source:
                    for headers, body in read_records(source):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        payload = _payload_of(headers, body)
                        row = [
                            number(headers.get("WARC-Page-ID")),
                            _url_of(headers),
                            int(headers["WARC-Payload-Length"]),
                            headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                            headers["WARC-Type"],
                            number(headers.get("WARC-Refers-To-Page")),
                        ]
                        if with_payload:
                            row.append(payload)
                            held += len(body)
                        rows.append(row)
                        if len(rows) == 10_000 or held > 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    return file_per_task(manifest.select("file")).mapInArrow(read, schema)
