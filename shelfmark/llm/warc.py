"""WARC records in seekable Zstandard bundles: write, index, and read single frames back."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import lookup

#: Payloads of fewer bytes are written again instead of referred to.
REVISIT_BYTES = 1000
#: A frame is closed once its records reach this size, a bundle once its frames do.
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 64 * 1024 * 1024

#: Fixed values of the seekable format: a skippable frame that ends with a footer.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1

INDEX = "page_id long, bundle string, frame int, offset long, length long"
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string,"
    " refers_to long, payload binary"
)


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    revisit = refers_to is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}")
    target = " ".join((url or "about:blank").split()) or "about:blank"
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        fields.append(f"X-Page-ID: {page_id}")
    if url is None:
        fields.append("X-Page-URL: none")
    if revisit:
        fields += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


class _Bundle:
    """One file being written: frames, then the seek table."""

    def __init__(self, folder: str, part: int) -> None:
        import zstandard

        self.uri = f"{folder}/bundle-{part:06d}-{uuid.uuid4().hex}.warc.zst"
        self.files, self.path = _open(self.uri)
        self.files.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.files.open_output_stream(self.path, compression=None)
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.bytes = 0

    def add(self, frame: bytes) -> None:
        data = self.zstd.compress(frame)
        self.out.write(data)
        self.frames.append((len(data), len(frame)))
        self.bytes += len(data)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        head = struct.pack("<II", SKIPPABLE, len(table) + len(footer))
        self.out.write(head + table + footer)
        self.out.close()


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write a record per row (`page_id, url, html, digest, refers_to`); INDEX rows as they go.

    Each task writes files of its own under names of its own attempt, and only the rows of the
    attempt that counts name them, so a lost task leaves a file that nothing refers to. A frame
    holds whole records, so a reader needs no other frame.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        bundle: _Bundle | None = None
        rows: list[tuple] = []
        frame: list[bytes] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if frame:
                bundle.add(b"".join(frame))
                frame.clear()
                size = 0

        def found() -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            names = [f.split()[0] for f in INDEX.split(", ")]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (c[i].as_py() for c in batch.columns)
                if bundle is None:
                    bundle = _Bundle(folder, part)
                record = _record(page_id, url, (html or "").encode(), digest, refers_to)
                rows.append((page_id, bundle.uri, len(bundle.frames), size, len(record)))
                frame.append(record)
                size += len(record)
                if size >= frame_bytes:
                    flush()
                    if bundle.bytes >= BUNDLE_BYTES:
                        bundle.close()
                        bundle = None
            # A bundle's rows leave the task while it is still open; readers start after the write.
            if rows:
                yield found()
        if bundle is not None:
            flush()
            bundle.close()

    chosen = pages.select(
        F.col("page_id").cast("long"), "url", F.col("html").cast("string"), "digest", "refers_to"
    )
    return chosen.mapInArrow(write, INDEX)


def _parse(record: bytes) -> tuple:
    import hashlib

    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (
        len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
    ):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    url = None if "X-Page-URL" in fields else fields["WARC-Target-URI"]
    return (
        number("X-Page-ID"),
        url,
        kind,
        size,
        digest,
        number("X-Refers-To-Page"),
        payload if kind == "response" else None,
    )


def read_records(index: DataFrame) -> DataFrame:
    """RECORD rows of the given INDEX rows: only the frames they lie in are read.

    A frame's place comes from the seek table at the end of its bundle. Index rows of one frame
    meet in one row, bounded by the size of a frame. A response's payload is checked against its
    digest; a revisit has the size and digest of the payload it refers to, and no payload.
    """
    frames = index.groupBy("bundle", "frame").agg(
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        zstd = zstandard.ZstdDecompressor()
        kinds = (
            pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()
        )
        names = [f.split()[0] for f in RECORD.split(", ")]
        tables: dict[str, list[tuple[int, int, int]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                files, path = _open(row["bundle"])
                with files.open_input_file(path) as f:
                    if row["bundle"] not in tables:
                        tables = {row["bundle"]: _seek_table(f)}
                    at, packed, size = tables[row["bundle"]][row["frame"]]
                    f.seek(at)
                    frame = zstd.decompress(f.read(packed), max_output_size=size)
                rows = [_parse(frame[r["offset"] : r["offset"] + r["length"]]) for r in row["records"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )

    return frames.mapInArrow(read, RECORD)


def _seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, packed size, size) of each frame."""
    end = f.size()
    f.seek(end - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    f.seek(end - 9 - 8 * n)
    places, at = [], 0
    for packed, size in struct.iter_unpack("<II", f.read(8 * n)):
        places.append((at, packed, size))
        at += packed
    return places


def with_revisits(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """`page_id, url, html, digest, refers_to`: pages, and which other page's payload each repeats.

    Only payloads that occur more than once are joined back, counted with partial sums first; the
    rows of a payload that many pages share are dealt to many tasks.

    Null html is an empty payload. Of the pages with one payload those with the largest page_id are
    responses (several, if rows repeat); a null page_id never refers and is never referred to.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    digest = F.sha1(F.encode(html, "UTF-8"))
    plain = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        digest.alias("digest"),
        (F.octet_length(html) >= revisit_bytes).alias("_large"),
    )
    firsts = (
        plain.where("_large and page_id is not null")
        .groupBy("digest")
        .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    joined = lookup(plain, firsts, "digest")
    refers = F.when(F.col("_large") & (F.col("page_id") < F.col("_first")), F.col("_first"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))
