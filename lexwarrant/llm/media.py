"""Media columns: payloads as images in tar shards, addressed by content.

Each task writes its payloads as 8-bit grey PNG images into tar shards in the shared folder, one member
per digest and shard, and returns rows with digest, shard, offset and length. Columns of metadata are
filled by reading the first bytes of a member only; features read the member itself by its range.
A shard's name holds a random part, so a task that runs again writes shards of its own, and rows only
ever name shards that were complete when they were made.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..storage import fresh_path, write_table
from .arrow import columns_of, slices, spread, texts

UNIT = 576
FILL = b"\xff"
#: Bytes after which a task begins another shard.
SHARD_BYTES = 256 << 20
LEVEL = 6
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Signature, and the header chunk with its length, name, 13 bytes and checksum.
HEADER = len(_SIGNATURE) + 25


def payload_of(text: str) -> bytes:
    """UTF-8, filled up with bytes 255 to a positive multiple of the unit."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + FILL * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def _chunk(name: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def encode_image(payload: bytes) -> bytes:
    """A grey image of 8-bit samples, ``UNIT`` wide."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    lines = np.zeros((len(rows), UNIT + 1), np.uint8)  # each line begins with filter type 0
    lines[:, 1:] = rows
    header = struct.pack(">IIBBBBB", UNIT, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def read_header(first: bytes) -> tuple[int, int, int]:
    """(width, height, bits) from the first ``HEADER`` bytes of an image."""
    if first[: len(_SIGNATURE)] != _SIGNATURE or first[12:16] != b"IHDR":
        raise ValueError("not an image of this format")
    return struct.unpack(">IIB", first[16:25])


def decode_image(stored: bytes) -> bytes:
    """The samples, line after line."""
    width, height, _ = read_header(stored[:HEADER])
    at, data = HEADER, []
    while at < len(stored):
        n = struct.unpack(">I", stored[at : at + 4])[0]
        if stored[at + 4 : at + 8] == b"IDAT":
            data.append(stored[at + 8 : at + 8 + n])
        at += 12 + n
    return np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Average hash: which of 64 equal stretches are brighter than the mean, then mean and deviation."""
    samples = np.frombuffer(payload, np.uint8)
    means = samples.reshape(64, -1).mean(axis=1)
    bits = np.packbits(means > means.mean()).tobytes().hex()
    return f"{bits}:{samples.mean():.4f}:{samples.std():.4f}"


class ShardWriter:
    """Tar shards of one task."""

    def __init__(self, folder: str, limit: int = SHARD_BYTES):
        self._files, self._folder = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        self._files.create_dir(self._folder, recursive=True)
        self._limit, self._out, self._at, self._places = limit, None, 0, {}

    def add(self, digest: str, image: bytes) -> tuple[str, int, int]:
        """(shard, offset, length) of the member that holds this image."""
        self._name = self._name if self._out else f"{uuid.uuid4().hex}.tar"
        if self._out is None:
            self._out, self._at, self._places = self._files.open_output_stream(f"{self._folder}/{self._name}", compression=None), 0, {}
        info = tarfile.TarInfo(f"{digest}.png")
        info.size = len(image)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        place = self._places[digest] = (self._name, self._at + len(head), len(image))
        self._out.write(head + image + bytes(-len(image) % tarfile.BLOCKSIZE))
        self._at += len(head) + len(image) + -len(image) % tarfile.BLOCKSIZE
        return place

    def place(self, digest: str) -> tuple[str, int, int] | None:
        return self._places.get(digest)

    @property
    def full(self) -> bool:
        return self._at >= self._limit

    def close(self) -> None:
        if self._out:
            self._out.write(bytes(2 * tarfile.BLOCKSIZE))
            self._out.close()
            self._out = None


#: Digests that several rows share, up to which they are broadcast; more are joined by shuffle.
BROADCAST_DIGESTS = 500_000


def digest_of_payload(text: Column) -> Column:
    """sha256 of a text's payload, as ``payload_of`` makes it."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    filled = F.greatest(F.lit(1), F.ceil(F.octet_length(raw) / UNIT)).cast("int") * UNIT
    return F.sha2(F.concat(raw, F.unhex(F.repeat(F.lit("FF"), filled - F.octet_length(raw)))), 256)


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is small enough."""
    return F.broadcast(df) if df.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS else df


def store(docs: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, digest, n_bytes, shard, offset and length of every row of ``docs`` (doc_id, digest, text);
    shards are written as rows are made.

    Write the result before reading shards, so that each row comes from a task that ended.
    """
    fields = [T.StructField(n, T.StringType() if n in ("digest", "shard") else T.LongType()) for n in ("digest", "n_bytes", "shard", "offset", "length")]
    schema = T.StructType([docs.schema["doc_id"], *fields])
    kinds = [pa.string() if f.name in ("digest", "shard") else pa.int64() for f in fields]

    def write(batches) -> Iterator[pa.RecordBatch]:
        writer, held = ShardWriter(folder, shard_bytes), []
        for batch in slices(batches, 256):
            rows = []
            for digest, text in zip(batch.column("digest").to_pylist(), texts(batch)):
                place = writer.place(digest) or writer.add(digest, encode_image(payload_of(text)))
                rows.append((digest, len(text.encode("utf-8", "surrogatepass")), *place))
            if rows:
                held.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=schema.names))
            if writer.full:
                writer.close()
                yield from held
                held = []
        writer.close()
        yield from held

    return docs.select("doc_id", "digest", "text").mapInArrow(write, schema)


class ShardReader:
    """Ranges of shards, the last shard kept open."""

    def __init__(self, folder: str):
        self._files, self._folder = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        self._name, self._file = None, io.BytesIO()

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self._name:
            self._file.close()
            self._name, self._file = shard, self._files.open_input_file(f"{self._folder}/{shard}")
        self._file.seek(offset)
        return self._file.read(length)


def with_metadata(index: DataFrame, folder: str) -> DataFrame:
    """``index`` with width, height and bits, from reads of headers only."""
    schema = T.StructType([*index.schema, *(T.StructField(n, T.IntegerType()) for n in ("width", "height", "bits"))])

    def fill(batches):
        reader = ShardReader(folder)
        for batch in batches:
            heads = [read_header(reader.read(s, o, HEADER)) for s, o in zip(batch.column("shard").to_pylist(), batch.column("offset").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([h[i] for h in heads], pa.int32()) for i in range(3))], names=schema.names)

    return index.mapInArrow(fill, schema)


def with_features(index: DataFrame, folder: str) -> DataFrame:
    """``index`` with sizes, digests and the feature of every payload, read back by its range."""
    schema = T.StructType([
        *index.schema,
        *(T.StructField(n, T.StringType() if n in ("payload_sha256", "media_sha256", "feature") else T.LongType()) for n in
          ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")),
    ])
    kinds = [pa.string() if n in ("payload_sha256", "media_sha256", "feature") else pa.int64() for n in schema.names[-6:]]

    def measure(batches):
        reader = ShardReader(folder)
        for batch in slices(batches, 512):
            rows = []
            for digest, shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("digest", "shard", "offset", "length"))):
                stored = reader.read(shard, offset, length)
                payload = decode_image(stored)
                found = hashlib.sha256(payload).hexdigest()
                if found != digest:
                    raise ValueError(f"member {digest} of {shard} holds {found}")
                rows.append((len(payload), found, zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature_of(payload)))
            if rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=schema.names)

    return index.mapInArrow(measure, schema)


_COLUMNS = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "shard", "offset", "length")


def media_columns(docs: DataFrame, folder: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Store every text as an image, fill in metadata by header reads, and compute features of what is read back.

    A payload is stored once, whatever task its copies are in: digests that several rows have are known
    before anything is written, the row with the least id stores, and the others are given its place and
    values. Only ids and digests are shuffled, never texts, unless more than ``BROADCAST_DIGESTS``
    payloads have copies. shard, offset and length name the place in ``folder``, which stays; left
    out, it is a folder of the shared one that goes when the application ends.

    A null or empty text is one unit of fill bytes. Null and repeated ids are rows of their own; equal
    texts get equal values (rows of one id and one text may be stored more than once, and name one
    place); an empty table gives an empty result; further columns are ignored.
    """
    folder = folder or fresh_path(docs.sparkSession, "media")
    rows = spread(columns_of(docs, "doc_id", "text")).withColumn("digest", digest_of_payload(F.col("text")))
    digests = write_table(rows.select("doc_id", "digest"), "media-digests")
    copied = digests.groupBy("digest").agg(F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("copied"), "owner")
    copied = write_table(copied, "media-copied")
    marked = rows.join(_small(copied), F.col("digest") == F.col("copied"), "left")
    owns = F.col("copied").isNull() | F.col("doc_id").eqNullSafe(F.col("owner"))
    index = write_table(store(marked.where(owns), folder, shard_bytes), "media-index")
    # rows that agree in id and text have all been given; the first place holds
    twice = index.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("shard", "offset", "length", "n_bytes", "doc_id")).alias("first")).where("n > 1").select("digest", "first.*")
    twice = write_table(twice, "media-twice").select(*index.columns)
    single = index.join(_small(twice.select("digest")), "digest", "left_anti").select(*index.columns).union(twice)
    found = with_features(with_metadata(single, folder), folder)
    alike = digests.join(_small(copied), F.col("digest") == F.col("copied")).select(F.col("digest").alias("_digest"), F.col("doc_id").alias("_id"))
    given = found.join(_small(write_table(alike, "media-alike")), F.col("digest") == F.col("_digest"), "left")
    return given.select(F.when(F.col("_digest").isNull(), F.col("doc_id")).otherwise(F.col("_id")).alias("doc_id"), *_COLUMNS)
