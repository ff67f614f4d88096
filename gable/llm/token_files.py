"""Token-ID / binary output by bit-plane shuffling.

Texts are encoded, ordered by document id and written to binary files: ids
are cut into blocks of a fixed size, each block is transposed into byte (or
bit) planes, each plane is compressed with Zstandard on its own, and a chunk
index at the end of the file tells where every plane of every block lies.
High planes are almost constant and nearly vanish.

File layout (little endian)::

    magic | planes of block 0 | planes of block 1 | ...
          | documents: flags, ids, lengths (zstd) | chunk index (zstd)
          | footer: offset and size of both, counts, block size, planes, magic

Order and files: Spark range-partitions the rows by id and sorts each
partition; every partition writes one file. Nothing whole passes through the
driver: the manifest has one row per file.

Defined results: null text counts as empty (only the end id); a null id comes
first; rows with equal ids are neighbours, in text order; an empty table
gives no file and no row; other columns are ignored whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gable.llm.common import materialise, runs
from gable.llm.files import reading, writing
from gable.session import scratch_path

MAGIC = b"GBLPLAN1"
_FOOTER = "<QQQQQQII8s"
_INDEX = np.dtype([("offset", "<u8"), ("n_ids", "<u4"), ("sizes", "<u4", (32,))])
# only ASCII white space: the tokenizers' own splitters never join across it
_PIECES = re.compile(r"[^ \t-\r]+")
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch


# --- planes ----------------------------------------------------------------

def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Transpose a block of uint32 ids into 4 byte planes or 32 bit planes."""
    cells = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [cells[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(cells, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """Inverse of :func:`to_planes`."""
    if kind == "byte":
        cells = np.empty((n, 4), dtype=np.uint8)
        for k, plane in enumerate(planes):
            cells[:, k] = np.frombuffer(plane, dtype=np.uint8)
    else:
        bits = np.empty((n, 32), dtype=np.uint8)
        for k, plane in enumerate(planes):
            bits[:, k] = np.unpackbits(np.frombuffer(plane, dtype=np.uint8), count=n, bitorder="little")
        cells = np.packbits(bits, axis=1, bitorder="little")
    return cells.view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one token file; holds one block and the document table."""

    def __init__(self, out, block_ids: int, kind: str, level: int = 3):
        self.out, self.block, self.kind = out, block_ids, kind
        self.zip = zstandard.ZstdCompressor(level=level)
        self.at = out.write(MAGIC) or len(MAGIC)
        self.pending = bytearray()
        self.index: list[tuple] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian uint32 of one document."""
        self.docs.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.pending += ids
        size = 4 * self.block
        if len(self.pending) >= size:
            whole = len(self.pending) // size * size
            for k in range(0, whole, size):
                self._flush(bytes(self.pending[k:k + size]))
            del self.pending[:whole]

    def _flush(self, raw: bytes) -> None:
        ids = np.frombuffer(raw, dtype="<u4")
        sizes = [0] * 32
        start = self.at
        for k, plane in enumerate(to_planes(ids, self.kind)):
            data = self.zip.compress(plane)
            self.out.write(data)
            sizes[k] = len(data)
            self.at += len(data)
        self.index.append((start, len(ids), sizes))

    def close(self) -> None:
        if self.pending:
            self._flush(bytes(self.pending))
        table = (np.array([d is None for d in self.docs], dtype=np.uint8).tobytes()
                 + np.array([d or 0 for d in self.docs], dtype="<i8").tobytes()
                 + np.array(self.lengths, dtype="<u8").tobytes())
        docs = self.zip.compress(table)
        index = self.zip.compress(np.array(self.index, dtype=_INDEX).tobytes())
        self.out.write(docs)
        self.out.write(index)
        self.out.write(struct.pack(_FOOTER, self.at, len(docs), self.at + len(docs), len(index), len(self.docs),
                                    len(self.index), self.block, self.kind == "bit", MAGIC))


class PlaneReader:
    """Random and sequential access to one token file."""

    def __init__(self, src):
        self.src = src
        end = src.size()
        src.seek(end - struct.calcsize(_FOOTER))
        (docs_at, docs_n, index_at, index_n, n_docs, n_blocks, self.block, bit,
         magic) = struct.unpack(_FOOTER, src.read(struct.calcsize(_FOOTER)))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.kind, self.unzip = "bit" if bit else "byte", zstandard.ZstdDecompressor()
        src.seek(docs_at)
        table = self.unzip.decompress(src.read(docs_n))
        self.null = np.frombuffer(table, np.uint8, n_docs)
        self.docs = np.frombuffer(table, "<i8", n_docs, n_docs)
        self.lengths = np.frombuffer(table, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        src.seek(index_at)
        self.index = np.frombuffer(self.unzip.decompress(src.read(index_n)), _INDEX, n_blocks)

    def read_block(self, k: int) -> np.ndarray:
        at, n, sizes = self.index[k]
        self.src.seek(int(at))
        sizes = sizes[:32 if self.kind == "bit" else 4].astype(np.int64)
        raw = self.src.read(int(sizes.sum()))
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        planes = [self.unzip.decompress(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
        return from_planes(planes, int(n), self.kind)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop) of the file; touches only the blocks they lie in."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        part = np.concatenate([self.read_block(k) for k in range(first, last + 1)])
        return part[start - first * self.block:stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, start in the file, id bytes) in file order, block by block."""
        held, blocks, at = bytearray(), iter(range(len(self.index))), 0
        for null, doc, n in zip(self.null.tolist(), self.docs.tolist(), self.lengths.tolist()):
            while len(held) < 4 * n:
                held += self.read_block(next(blocks)).tobytes()
            yield None if null else doc, at, bytes(held[:4 * n])
            del held[:4 * n]
            at += n


# --- encoding --------------------------------------------------------------

def _byte_letters() -> dict[int, int]:
    """Byte to the letter that byte-level vocabularies write for it."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


class Pieces(dict):
    """Ids of pieces as bytes, encoded when first asked for.

    A word of lower-case Latin letters passes the tokenizer's normaliser and
    splitter unchanged, so it goes to the tokenizer's model at once; all other
    pieces take the tokenizer's whole way, and so do all if the model does not
    give the tokenizer's ids for the probe words.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.old = tokenizer, tokenizer.model, {}
        self.letters = _byte_letters()
        for word in ("a", "zebra", "qxzvjk", "straße", "àéîõüÿ", "internationalisierung"):
            if self.model and self.ids(word) != self.tokenizer.encode(word, add_special_tokens=False).ids:
                self.model = None

    def ids(self, piece: str) -> list[int]:
        if self.model and _PLAIN(piece):
            if not piece.isascii():
                piece = piece.encode().decode("latin-1").translate(self.letters)
            return [t.id for t in self.model.tokenize(piece)]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            if len(piece) > 1 and piece[-1] in ".," and piece[-2].isalpha():
                found = self[piece[:-1]] + self[piece[-1]]
            else:
                found = np.array(self.ids(piece), dtype="<u4").tobytes()
        self[piece] = found
        return found

    def turn(self) -> None:
        """The remembered pieces become the old generation."""
        self.old = dict(self)
        self.clear()


def cuts_at_blanks(description: dict) -> bool:
    """Whether a tokenizer lower-cases, drops white space and splits a closing point or comma off a word.

    Read from its own description (the JSON it is saved as). Every step has to be a known
    one; anything else, like a splitter that keeps blanks or a model that sees more than a
    word, means no.
    """
    normal, split = description.get("normalizer") or {}, description.get("pre_tokenizer") or {}
    steps = normal.get("normalizers", [normal]) if normal else []
    kinds = [s.get("type") for s in steps]
    blanks = all(s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " " for s in steps if s.get("type") == "Replace")
    first, *rest = split.get("pretokenizers", [split])
    words = (first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed"
             and first.get("pattern", {}).get("Regex", "").endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"))
    plain = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex") for s in rest)
    special = all(t.get("special") and t.get("content", "").startswith("<|") and not t.get("lstrip") and not t.get("rstrip")
                  for t in description.get("added_tokens", ()))
    return bool("Lowercase" in kinds and set(kinds) <= {"NFC", "Replace", "Lowercase"} and blanks and words and plain and special)


class Encoder:
    """Encodes texts, piece by piece where the tokenizer's description allows it.

    If :func:`cuts_at_blanks` holds, a piece is a run without white space: the tokenizer drops white space and
    never merges across it, so the ids of a text are the ids of its pieces in
    order. It also lower-cases, and cuts a closing point or comma off a word,
    so pieces are looked up lower-cased and words share their ids with and
    without one. Two generations of up to ``limit`` pieces are remembered: when
    the young one is full it becomes the old one, so frequent pieces stay.
    Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, end_id: int, limit: int = 100_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.by_piece = cuts_at_blanks(json.loads(self.tokenizer.to_str()))
        self.known = Pieces(self.tokenizer) if self.by_piece else {}
        self.end = struct.pack("<I", end_id)
        self.limit = limit

    def pieces(self, text: str) -> list[str]:
        # special tokens are matched as written; the others lower-case by context in one library only
        if not ("<|" in text or "\u03a3" in text or "\u0130" in text):
            text = text.lower()
        # str.split also takes the ASCII separators for white space, the tokenizer does not
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return _PIECES.findall(text)
        return text.split()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.by_piece:
            return [self.whole(text) + self.end if text else self.end for text in texts]
        out = []
        for text in texts:
            out.append(b"".join(map(self.known.__getitem__, self.pieces(text))) + self.end if text else self.end)
            if len(self.known) > self.limit:
                self.known.turn()
        return out


def worker_encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this Python worker; its memory outlives a task."""
    held = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders")).__dict__
    if (path, end_id) not in held:
        held[path, end_id] = Encoder(path, end_id)
    return held[path, end_id]


# --- Spark -----------------------------------------------------------------

_MANIFEST = "file_no int, file string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, out_dir: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text", block_ids: int = 65_536,
                      planes: str = "byte") -> DataFrame:
    """Encode ``docs`` and write token files in ascending id order.

    Returns the manifest (one row per file, in id order). ``block_ids`` is the
    fixed block size, ``planes`` is "byte" or "bit".
    """
    out_dir = out_dir or scratch_path(docs.sparkSession, "token-files")
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text"))

    def write(batches):
        no = TaskContext.get().partitionId()
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encoder = worker_encoder(tokenizer_path, end_id)
        uri = f"{out_dir}/tokens-{no:06d}.gbp"
        with writing(uri) as out:
            writer = PlaneWriter(out, block_ids, planes)
            for batch in _then(first, batches):
                ids, texts = batch.column(0).to_pylist(), batch.column(1)
                sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
                for a, b in runs(sizes, 1 << 20):
                    for doc_id, data in zip(ids[a:b], encoder.encode(texts.slice(a, b - a).to_pylist())):
                        writer.add(doc_id, data)
            writer.close()
        yield pa.RecordBatch.from_pydict({"file_no": pa.array([no], pa.int32()), "file": [uri],
                                          "n_docs": pa.array([len(writer.docs)], pa.int64()),
                                          "n_ids": pa.array([writer.n_ids], pa.int64())})

    return materialise(ordered.mapInArrow(write, _MANIFEST))


def _then(first, rest):
    yield first
    yield from rest


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document, read from the files alone.

    Columns: doc_id, start (ids of all documents before it, over all files),
    n_tokens, ids_crc32 (unsigned crc32 of the little-endian uint32 ids) and,
    with ``with_ids``, the ids.
    """
    # one row per file: a running sum over them is small
    base = F.sum("n_ids").over(Window.orderBy("file_no")) - F.col("n_ids")
    files = manifest.select("file", base.alias("base")).repartition(max(1, manifest.count()))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches):
        for batch in batches:
            for uri, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with reading(uri) as src:
                    rows = PlaneReader(src).documents()
                    while part := list(islice(rows, 2_000)):
                        cols = {"doc_id": pa.array([r[0] for r in part], pa.int64()),
                                "start": pa.array([offset + r[1] for r in part], pa.int64()),
                                "n_tokens": pa.array([len(r[2]) // 4 for r in part], pa.int64()),
                                "ids_crc32": pa.array([zlib.crc32(r[2]) for r in part], pa.int64())}
                        if with_ids:
                            cols["ids"] = pa.array([np.frombuffer(r[2], "<u4").astype(np.int64) for r in part],
                                                   pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_pydict(cols)

    return files.mapInArrow(read, schema)


def token_files(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the files and return what a reader finds in them."""
    return read_token_files(write_token_files(docs, tokenizer_path, **options))


def default_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gable.llm.common import table
    return token_files(table(spark, sf_dir, "documents"), default_tokenizer(), end_id=1)
