"""WARC records in seekable Zstandard bundles, and the way back.

A bundle is a file of independent frames, each with some whole records, and a last
skippable frame with a seek table: every frame's compressed and plain size. The index
maps a record to its bundle, its frame and its place inside the frame, so one record
costs one ranged read. Tasks write bundles of bounded size under names of their own
attempt; only bundles named in the stored index count, so a task that ran twice, or was
lost half way, leaves nothing behind that a reader would take.

Of records with equal payloads the one with the largest page_id is a response, the
others are revisits that refer to it.
"""

import base64
import hashlib
import struct
import uuid

from pyspark.sql import functions as F

from ..session import shared_folder
from .rows import map_slices

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 6
#: Compressed bytes that one task reads back.
READ_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(uri):
    """A file system and a path in it, for any store that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def digest_of(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id):
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(value):
    text = value.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def record_bytes(page_id, url, payload, digest, refers_to):
    """One WARC/1.1 record; a revisit, if it refers to another page, has no payload."""
    revisit = refers_to is not None
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data, at=0):
    """Headers (lower case), payload and end of the record that starts at ``at``."""
    split = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:split].decode("utf-8").split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    head = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    start = split + 4
    end = start + int(head["content-length"])
    block = data[start:end]
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"record {head['warc-record-id']} does not end where its length says")
    return head, block[block.index(b"\r\n\r\n") + 4 :], end + 4


class BundleWriter:
    """Frames of whole records, and the seek table at the end."""

    def __init__(self, folder, frame_bytes=FRAME_BYTES):
        import zstandard

        self.frame_bytes = frame_bytes
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        store, path = open_store(self.uri)
        self.out = store.open_output_stream(path, compression=None)
        self.pack = zstandard.ZstdCompressor(level=LEVEL).compress
        self.frames, self.held, self.size, self.written = [], [], 0, 0

    def add(self, record):
        """The record's frame and place in the frame."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self.flush()
        place = (len(self.frames), self.size)
        self.held.append(record)
        self.size += len(record)
        return place

    def flush(self):
        if self.held:
            frame = self.pack(b"".join(self.held))
            self.out.write(frame)
            self.frames.append((len(frame), self.size))
            self.written += len(frame)
            self.held, self.size = [], 0

    def close(self):
        """Start of every frame in the file."""
        self.flush()
        table = b"".join(ENTRY.pack(*f) for f in self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table) + FOOTER.size) + table)
        self.out.write(FOOTER.pack(len(self.frames), 0, SEEKABLE))
        self.out.close()
        starts, at = [], 0
        for size, _ in self.frames:
            starts.append(at)
            at += size
        return starts


def seek_table(file):
    """(start, compressed size, plain size) of each frame, from the end of an open bundle."""
    total = file.size()
    count, _, magic = FOOTER.unpack(file.read_at(FOOTER.size, total - FOOTER.size))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    raw = file.read_at(count * ENTRY.size, total - FOOTER.size - count * ENTRY.size)
    out, at = [], 0
    for packed, plain in ENTRY.iter_unpack(raw):
        out.append((at, packed, plain))
        at += packed
    return out


def with_references(pages, id_col="page_id", payload_col="html", url_col="url", least_bytes=0):
    """page_id, url, payload and refers_to (null for responses).

    A null payload is empty. Payloads shorter than ``least_bytes`` are never revisits.
    Rows that repeat the largest page_id are responses all; pages without an id never
    stand for others. Only digests that occur more than once are looked up: they are counted
    with a partial sum before the shuffle and stored, so that few of them are broadcast and no
    payload moves. Many are joined by a shuffle, where adaptive execution splits a hot digest.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.unhex(F.sha1(payload.cast("binary"))).alias("_digest"),
    )
    repeated = rows.groupBy("_digest").agg(F.max("page_id").alias("_largest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    path = shared_folder(spark, "warc-digests")
    repeated.write.parquet(path)
    other = (F.octet_length("payload") >= least_bytes) & (
        F.col("page_id").isNull() | (F.col("page_id") != F.col("_largest"))
    )
    return rows.join(spark.read.parquet(path), "_digest", "left").select(
        "page_id", "url", "payload", F.when(other, F.col("_largest")).alias("refers_to")
    )


INDEX_DDL = (
    "page_id long, bundle string, frame int, frame_start long, frame_bytes long, record_start long, record_bytes long"
)


def write_bundles(pages, folder, frame_bytes=FRAME_BYTES, **columns):
    """Write all pages below ``folder``; returns the stored index, one row per record."""
    spark = pages.sparkSession
    rows = with_references(pages, **columns)

    def work(slices):
        writer, placed = None, []

        def finish():
            starts = writer.close()
            return {
                "page_id": [p[0] for p in placed],
                "bundle": [writer.uri] * len(placed),
                "frame": [p[1] for p in placed],
                "frame_start": [starts[p[1]] for p in placed],
                "frame_bytes": [writer.frames[p[1]][0] for p in placed],
                "record_start": [p[2] for p in placed],
                "record_bytes": [p[3] for p in placed],
            }

        for batch in slices:
            for row in batch.to_pylist():
                payload = row["payload"].encode("utf-8")
                record = record_bytes(row["page_id"], row["url"], payload, digest_of(payload), row["refers_to"])
                writer = writer or BundleWriter(f"{folder}/bundles", frame_bytes)
                placed.append((row["page_id"], *writer.add(record), len(record)))
                if writer.written >= BUNDLE_BYTES:
                    yield finish()
                    writer, placed = None, []
        if writer:
            yield finish()

    store, path = open_store(f"{folder}/bundles")
    store.create_dir(path)
    map_slices(rows, work, INDEX_DDL).write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


RECORD_DDL = "page_id long, payload string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(index, with_payload=True, read_bytes=READ_BYTES):
    """Records of an index, or of any rows filtered from it, read frame by frame.

    Each frame is read once, by its range in the bundle. A response is checked against
    its length and digest. The bytes behind the index, not the small index itself, say how
    many tasks read: each takes neighbouring frames of some bundles.
    """
    frames = index.groupBy("bundle", "frame", "frame_start", "frame_bytes").agg(
        F.collect_list("record_start").alias("places")  # bounded by the records of one frame
    )
    total = index.select("bundle", "frame", "frame_bytes").distinct().agg(F.coalesce(F.sum("frame_bytes"), F.lit(0))).first()[0]
    frames = frames.repartitionByRange(max(1, -(-total // read_bytes)), "bundle", "frame_start")

    def work(slices):
        import zstandard

        unpack, name, file = zstandard.ZstdDecompressor().decompress, None, None
        for batch in slices:
            out = {k: [] for k in ("page_id", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    name = row["bundle"]
                    store, path = open_store(name)
                    file = store.open_input_file(path)
                plain = unpack(file.read_at(row["frame_bytes"], row["frame_start"]))
                for place in row["places"]:
                    head, payload, _ = parse_record(plain, place)
                    size, digest = int(head["warc-payload-length"]), head["warc-payload-digest"].removeprefix("sha1:")
                    revisit = head["warc-type"] == "revisit"
                    if not revisit and (len(payload), digest_of(payload)) != (size, digest):
                        raise ValueError(f"payload of {head['warc-record-id']} is damaged")
                    out["page_id"].append(page_of(head["warc-record-id"]))
                    out["payload"].append(None if revisit or not with_payload else payload.decode("utf-8"))
                    out["payload_bytes"].append(size)
                    out["payload_digest"].append(digest)
                    out["record_type"].append(head["warc-type"])
                    out["refers_to"].append(page_of(head["warc-refers-to"]) if revisit else None)
            yield out

    return map_slices(frames, work, RECORD_DDL)


def archive(pages, **columns):
    """Write pages into a fresh folder of the shared storage and return the index."""
    return write_bundles(pages, shared_folder(pages.sparkSession, "warc"), **columns)
