"""WARC archives as seekable Zstandard bundles.

Pages become WARC/1.1 records. Records are grouped into independent
Zstandard frames, each bundle ends with a seek table (the public seekable
format: a skippable frame with the sizes of all frames), and an index maps
every record to its frame and its offset inside that frame, so one record is
read by decompressing one frame.

Equal payloads are stored once: the record with the largest page id is the
response, the others are revisits of it. Payloads below ``min_payload`` bytes
are always responses. The choice is an aggregate by digest (combined before
the shuffle, so thousands of copies of one page cost one row a task); only
the revisits, not the pages, are joined on the digest.

Defined results: null html is an empty payload; a null page id never wins
over a real one, and where all are null all are responses; repeated rows of
the largest page id are all responses; a null url leaves the URI header out;
an empty table gives no bundle; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.llm.common import materialise
from gable.llm.files import reading, writing
from gable.session import scratch_path

# fixed values of the public seekable format
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records ---------------------------------------------------------------

def record_urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def format_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit carries the headers of the payload only."""
    revisit = refers_to is not None
    body = _HTTP + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(
            f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: {record_urn(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}",
                 f"WARC-Profile: {_REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers and payload of one record; the payload's digest is verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and payload_digest(payload) != digest:
        raise ValueError(f"digest of {fields['WARC-Record-ID']} does not match its payload")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload": payload,
            "payload_bytes": number("X-Payload-Length"), "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID")}


# --- bundles ---------------------------------------------------------------

class BundleWriter:
    """Collects records into frames; holds one frame and the seek table."""

    def __init__(self, out, frame_bytes: int, level: int):
        self.out, self.frame_bytes = out, frame_bytes
        self.zip = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)
        self.held, self.frames = bytearray(), []

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame number, offset inside the frame) of the record."""
        place = len(self.frames), len(self.held)
        self.held += record
        if len(self.held) >= self.frame_bytes:
            self._flush()
        return place

    def _flush(self) -> None:
        data = self.zip.compress(bytes(self.held))
        self.out.write(data)
        self.frames.append((len(data), len(self.held)))
        self.held.clear()

    def close(self) -> None:
        if self.held:
            self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack(
            "<IBI", len(self.frames), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)


def seek_table(src) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of every frame, from the footer."""
    end = src.size()
    src.seek(end - 9)
    n, flags, magic = struct.unpack("<IBI", src.read(9))
    if magic != _SEEKABLE or flags:
        raise ValueError("no seek table")
    src.seek(end - 9 - 8 * n)
    raw, at, out = src.read(8 * n), 0, []
    for packed, size in struct.iter_unpack("<II", raw):
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(src, frame: tuple[int, int, int]) -> bytes:
    src.seek(frame[0])
    return zstandard.ZstdDecompressor().decompress(src.read(frame[1]), max_output_size=frame[2])


def records_in(data: bytes) -> Iterator[bytes]:
    """Cut the bytes of a frame into records."""
    at = 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        key = data.rindex(b"Content-Length: ", at, body) + 16
        stop = body + int(data[key:data.index(b"\r\n", key)]) + 4
        yield data[at:stop]
        at = stop


def read_record(bundle: str, frame: int, offset: int) -> dict:
    """One record by its place in the index; decompresses one frame."""
    with reading(bundle) as src:
        data = read_frame(src, seek_table(src)[frame])
    return parse_record(next(records_in(data[offset:])))


# --- Spark -----------------------------------------------------------------

def revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_payload: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload another page holds."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = materialise(pages.where(F.octet_length(payload) >= min_payload)
                       .select(F.col(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("digest")))
    held = (rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
            .where("n > 1 and refers_to is not null").drop("n"))
    return materialise(rows.join(held, "digest")
                       .where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct())


_INDEX = "page_id long, bundle string, frame int, offset long, length long"


def write_bundles(pages: DataFrame, out_dir: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_payload: int = 0, frame_bytes: int = 1 << 18, level: int = 3,
                  date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one bundle a partition; return the record index."""
    out_dir = out_dir or scratch_path(pages.sparkSession, "warc")
    refs = revisits(pages, id_col, payload_col, min_payload).alias("r")
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload")).alias("p")
    # the planner broadcasts the revisits when they are small, else it shuffles both
    rows = p.join(refs, F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.digest") == F.col("r.digest")),
                  "left").select("p.page_id", "p.url", "p.payload", "r.refers_to")

    def write(batches):
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        uri = f"{out_dir}/pages-{TaskContext.get().partitionId():06d}.warc.zst"
        places = []
        with writing(uri) as out:
            bundle = BundleWriter(out, frame_bytes, level)
            for batch in (b for part in ([first], batches) for b in part):
                for k in range(batch.num_rows):
                    page_id, url, payload, ref = (c[k].as_py() for c in batch.columns)
                    record = format_record(page_id, url, payload, ref, date)
                    places.append((page_id, *bundle.add(record), len(record)))
            bundle.close()
        for k in range(0, len(places), 10_000):
            ids, frames, offsets, sizes = zip(*places[k:k + 10_000])
            yield pa.RecordBatch.from_pydict({
                "page_id": pa.array(ids, pa.int64()), "bundle": [uri] * len(ids), "frame": pa.array(frames, pa.int32()),
                "offset": pa.array(offsets, pa.int64()), "length": pa.array(sizes, pa.int64())})

    return materialise(rows.mapInArrow(write, _INDEX))


def read_bundles(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the indexed bundles, read from the archives frame by frame."""
    bundles = index.select("bundle").distinct()
    bundles = bundles.repartition(max(1, bundles.count()))  # a task for each bundle
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + (
        ", url string, payload binary" if with_payload else "")
    arrow = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64()} | (
        {"url": pa.string(), "payload": pa.binary()} if with_payload else {})

    def read(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with reading(uri) as src:
                    for frame in seek_table(src):
                        got = [parse_record(r) for r in records_in(read_frame(src, frame))]
                        yield pa.RecordBatch.from_pydict({n: pa.array([g[n] for g in got], t) for n, t in arrow.items()})

    return bundles.mapInArrow(read, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gable.llm.common import table
    return read_bundles(write_bundles(table(spark, sf_dir, "pages")))


# base32 of the digest, 5 bits a character
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x FROM p),
g AS (SELECT x, max(page_id) AS m FROM d GROUP BY x)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((('0x' || substr(d.x, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31 AS INT) + 1, 1)
           FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN m IS NULL OR page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN m IS NULL OR page_id = m THEN NULL ELSE m END AS refers_to
FROM d JOIN g ON d.x = g.x
"""
