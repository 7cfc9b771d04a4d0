"""Token ids in length-delimited binary records, as a Spark data source.

A record is, all little-endian::

    u64 length | u32 masked crc32c of these 8 bytes | payload | u32 masked crc32c of the payload

with a payload of one byte (1 if there is a key, plus 2 if ids take two bytes each), an i64 key and the
ids: as u16 if all of a record are below 65,536, else as u32. Every data file has an index file of two
u64 per record: offset, and number of ids times two, plus one if they are u16. ``_manifest.json`` lists the
files in the order of their records and is written when all tasks have ended, so files that lost
or repeated tasks leave behind are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from grainfold.llm.tokens import slices, word_ids
from grainfold.llm.words import small_batches
from grainfold.session import new_path

MANIFEST = "_manifest.json"
FRAME, HEAD = 16, 9
#: Bytes read, checked and handed on at a time.
CHUNK = 8_000_000
#: Cells of the checksum table of a group of records.
CELLS = 2_000_000

# fixed values of the checksum and its mask
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8


# --- checksums ----------------------------------------------------------------------------


def _shift(tables: tuple[np.ndarray, np.ndarray], crc: np.ndarray) -> np.ndarray:
    halves = crc.view(np.uint16).reshape(*crc.shape, 2)
    return tables[0][halves[..., 0]] ^ tables[1][halves[..., 1]]


@cache
def _pairs() -> np.ndarray:
    """The checksum, started at 0, of every two bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    first, second = np.arange(65536) & 255, np.arange(65536) >> 8
    crc = table[first]
    return table[(crc ^ second.astype(np.uint32)) & 255] ^ (crc >> 8)


@cache
def _behind(power: int) -> tuple[np.ndarray, np.ndarray]:
    """What a checksum becomes by ``2 ** power`` zero bytes, by its lower and upper 16 bits."""
    low = np.arange(65536, dtype=np.uint32)
    if power == 1:
        # two zero bytes: the low half meets the table of pairs, the high half moves down
        return _pairs()[low], low.copy()
    half = _behind(power - 1)
    return tuple(_shift(half, _shift(half, values)) for values in (low, low << 16))


@cache
def _placed() -> list[np.ndarray]:
    """The table of pairs with 14, 12, ... 0 zero bytes behind each pair."""
    tables = [_pairs()]
    for _ in range(7):
        tables.append(_shift(_behind(1), tables[-1]))
    return tables[::-1]


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of byte strings of four bytes or more.

    Strings of similar length form a matrix, zeros in front. Sixteen bytes at a time come from
    tables, and neighbours are joined pairwise until one value a string is left; the checksum is
    linear, so zeros in front change nothing.
    """
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    classes = np.maximum(np.ceil(np.log2(np.maximum(sizes, 2))).astype(int), 4)
    out = np.zeros(len(parts), np.uint32)
    for power in np.unique(classes):
        members, width = np.flatnonzero(classes == power), 1 << power
        for at in range(0, len(members), step := max(1, CELLS // width)):
            some = members[at : at + step]
            cells = np.frombuffer(b"".join([parts[i].rjust(width, b"\0") for i in some]), np.uint8)
            cells = cells.reshape(len(some), width).copy()
            starts = width - sizes[some]
            cells[np.arange(len(some))[:, None], starts[:, None] + np.arange(4)] ^= 0xFF
            pairs = cells.view("<u2").reshape(len(some), -1, 8)
            crc = np.zeros(pairs.shape[:2], np.uint32)
            for j, table in enumerate(_placed()):
                crc ^= table[pairs[..., j]]
            for level in range(4, power):
                crc = _shift(_behind(level), np.ascontiguousarray(crc[:, 0::2])) ^ crc[:, 1::2]
            out[some] = ~crc[:, 0]
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK)


# --- files --------------------------------------------------------------------------------


def _store(path: str) -> tuple[fs.FileSystem, str]:
    path = path.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _manifest(path: str) -> list[dict]:
    store, folder = _store(path)
    at = f"{folder}/{MANIFEST}"
    if store.get_file_info(at).type == fs.FileType.NotFound:
        return []
    with store.open_input_stream(at) as stream:
        return json.loads(stream.read())


def _framed(payloads: list[bytes]) -> bytes:
    heads = [len(p).to_bytes(8, "little") for p in payloads]
    head_sums = masked(crc32c(heads)).astype("<u4").tobytes()
    body_sums = masked(crc32c(payloads)).astype("<u4").tobytes()
    parts = []
    for i, (head, payload) in enumerate(zip(heads, payloads)):
        parts += head, head_sums[4 * i : 4 * i + 4], payload, body_sums[4 * i : 4 * i + 4]
    return b"".join(parts)


def _checked(block: bytes, sizes: np.ndarray, place: str) -> list[bytes]:
    """The payloads of records of the given whole sizes, after a look at both checksums of each."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if not len(sizes):
        return []
    if len(block) != ends[-1]:
        raise ValueError(f"{place}: the file ends within a record")
    heads = [block[a : a + 8] for a in starts]
    payloads = [block[a + 12 : b - 4] for a, b in zip(starts, ends)]
    head_sums = np.frombuffer(b"".join(block[a + 8 : a + 12] for a in starts), "<u4")
    body_sums = np.frombuffer(b"".join(block[b - 4 : b] for b in ends), "<u4")
    right = np.frombuffer(b"".join(heads), "<u8").astype(np.int64) == sizes - FRAME
    right &= (masked(crc32c(heads)) == head_sums) & (masked(crc32c(payloads)) == body_sums)
    if not right.all():
        raise ValueError(f"{place}: record {int(np.argmin(right))} of the block is damaged")
    return payloads


def _keys(payloads: list[bytes]) -> pa.Array:
    return pa.array([int.from_bytes(p[1:HEAD], "little", signed=True) if p[0] & 1 else None for p in payloads], pa.int64())


def _payload(key: int | None, ids: bytes | None) -> bytes:
    values = np.frombuffer(ids or b"", "<u4")
    short = not len(values) or values.max() < 1 << 16
    head = bytes([(key is not None) + 2 * short]) + (key or 0).to_bytes(8, "little", signed=True)
    return head + (values.astype("<u2").tobytes() if short else ids)


def _ids(payload: bytes) -> bytes:
    return np.frombuffer(payload, "<u2", offset=HEAD).astype("<u4").tobytes() if payload[0] & 2 else payload[HEAD:]


def _record_sizes(numbers: np.ndarray) -> np.ndarray:
    """Whole sizes of records, from the second number of their index rows."""
    return (numbers >> 1) * np.where(numbers & 1, 2, 4) + HEAD + FRAME


@dataclass
class Part(WriterCommitMessage):
    order: int
    name: str
    records: int
    ids: int


@dataclass
class File(InputPartition):
    name: str
    ids_before: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        order = TaskContext.get().partitionId()
        name = f"part-{order:05d}-{uuid.uuid4().hex}"
        offset = records = ids = 0
        with store.open_output_stream(f"{folder}/{name}.records") as data, \
                store.open_output_stream(f"{folder}/{name}.index") as index:
            for batch in iterator:
                for start, own in slices(batch.column("ids"), CHUNK):
                    keys = batch.column("key").slice(start, len(own)).to_pylist()
                    payloads = [_payload(key, value) for key, value in zip(keys, own.to_pylist())]
                    short = np.fromiter((p[0] >> 1 for p in payloads), np.int64, len(payloads))
                    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
                    ends = offset + np.cumsum(sizes + FRAME)
                    numbers = (sizes - HEAD) // np.where(short, 2, 4)
                    data.write(_framed(payloads))
                    index.write(np.stack([ends - sizes - FRAME, 2 * numbers + short], 1).astype("<u8").tobytes())
                    offset, records, ids = int(ends[-1]), records + len(payloads), ids + int(numbers.sum())
        return Part(order, name, records, ids)

    def commit(self, messages: list[Part | None]) -> None:
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        done = sorted((m for m in messages if m is not None and m.records), key=lambda m: m.order)
        listed = [] if self.overwrite else _manifest(self.path)
        listed += [{"name": m.name, "records": m.records, "ids": m.ids} for m in done]
        with store.open_output_stream(f"{folder}/{MANIFEST}.new") as stream:
            stream.write(json.dumps(listed).encode())
        store.move(f"{folder}/{MANIFEST}.new", f"{folder}/{MANIFEST}")

    def abort(self, messages: list[Part | None]) -> None:
        store, folder = _store(self.path)
        for message in messages:
            for end in ("records", "index") if message is not None else ():
                store.delete_file(f"{folder}/{message.name}.{end}")


class _Reader(DataSourceReader):
    def __init__(self, path: str, index_only: bool):
        self.path, self.index_only = path, index_only

    def partitions(self) -> list[File]:
        before, parts = 0, []
        for entry in _manifest(self.path):
            parts.append(File(entry["name"], before))
            before += entry["ids"]
        return parts or [File("", 0)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, folder = _store(self.path)
        with store.open_input_stream(f"{folder}/{partition.name}.index") as stream:
            offsets, numbers = np.frombuffer(stream.read(), "<u8").astype(np.int64).reshape(-1, 2).T
        starts = partition.ids_before + np.cumsum(numbers >> 1) - (numbers >> 1)
        sizes = _record_sizes(numbers)
        if self.index_only:
            for at in range(0, len(offsets), 100_000):
                to = slice(at, at + 100_000)
                names = pa.array([partition.name] * len(offsets[to]))
                yield pa.RecordBatch.from_arrays(
                    [names, *map(pa.array, (offsets[to], numbers[to], starts[to]))], ["file", "at", "n", "start"])
            return
        with store.open_input_stream(f"{folder}/{partition.name}.records") as stream:
            done = 0
            while done < len(sizes):
                stop = max(done + 1, int(np.searchsorted(offsets + sizes, offsets[done] + CHUNK, "right")))
                payloads = _checked(stream.read(int(sizes[done:stop].sum())), sizes[done:stop], partition.name)
                yield _batch(payloads, starts[done:stop])
                done = stop


def _batch(payloads: list[bytes], starts: np.ndarray) -> pa.RecordBatch:
    ids = pa.array([_ids(p) for p in payloads], pa.binary())
    return pa.RecordBatch.from_arrays([_keys(payloads), pa.array(starts, pa.int64()), ids], ["key", "start", "ids"])


READ = "key long, start long, ids binary"
INDEX = "file string, at long, n long, start long"


class TokenRecords(DataSource):
    """``format("token_records")``: written from ``key long, ids binary``, read as those and ``start``."""

    @classmethod
    def name(cls) -> str:
        return "token_records"

    def _index_only(self) -> bool:
        return self.options.get("index", "false").lower() == "true"

    def schema(self) -> str:
        return INDEX if self._index_only() else READ

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self._index_only())

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], overwrite)


def write_records(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``key, ids`` in the order of the rows; ids are little-endian u32 in a binary."""
    records.sparkSession.dataSource.register(TokenRecords)
    records.select(F.col("key").cast("long"), "ids").write.format("token_records").mode(mode).save(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``key, start, ids`` in the order they were written; damaged records raise an error.

    ``start`` counts the ids of all records before.
    """
    spark.dataSource.register(TokenRecords)
    return spark.read.format("token_records").load(path)


def shuffled_records(spark: SparkSession, path: str, seed: int = 0) -> DataFrame:
    """The same rows in an order that ``seed`` decides.

    Only the index is shuffled; each task then fetches its records by their offsets.
    """
    spark.dataSource.register(TokenRecords)
    index = spark.read.format("token_records").option("index", "true").load(path)
    index = index.sort(F.xxhash64("file", "at", F.lit(seed)), "file", "at")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(path)
        files = {}
        for batch in batches:
            sizes = _record_sizes(batch.column("n").to_numpy())
            ends = np.cumsum(sizes)
            done = 0
            while done < len(sizes):
                base = ends[done - 1] if done else 0
                stop = max(done + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
                rows = batch.slice(done, stop - done)
                blocks = []
                names, offsets = rows.column("file").to_pylist(), rows.column("at").to_pylist()
                for name, offset, size in zip(names, offsets, sizes[done:stop]):
                    if name not in files:
                        if len(files) >= 64:
                            files.popitem()[1].close()
                        files[name] = store.open_input_file(f"{folder}/{name}.records")
                    blocks.append(files[name].read_at(int(size), offset))
                payloads = _checked(b"".join(blocks), sizes[done:stop], folder)
                yield _batch(payloads, rows.column("start").to_numpy())
                done = stop
        for file in files.values():
            file.close()

    return index.mapInArrow(fetch, READ)


# --- documents ----------------------------------------------------------------------------


def encoded(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """``key, ids`` of documents in ascending order of doc_id, each ended by the id ``end``.

    Null ids come first. Rows of one id follow by length and hash of the text; null text counts
    as empty. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    # the last column parts copies of one row, however many there are
    rows = rows.sort("key", F.octet_length("text"), F.xxhash64("text"), F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for batch in batches:
            for start, texts in slices(batch.column("text")):
                values, sizes = words.ids(texts)
                ends = np.cumsum(sizes + 1)
                ids = np.full(int(ends[-1]), end, "<u4")
                ids[np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes)] = values
                offsets = pa.py_buffer((4 * np.append(0, ends)).astype(np.int32))
                own = pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(start, len(sizes)), own], ["key", "ids"])

    return rows.mapInArrow(run, "key long, ids binary")


def stored_documents(docs: DataFrame, tokenizer: str, end: int, path: str | None = None) -> DataFrame:
    """Write all documents as records and read them back: ``doc_id, start, ids``."""
    spark = docs.sparkSession
    path = path or new_path(spark, "records")
    write_records(encoded(docs, tokenizer, end), path)
    return read_records(spark, path).withColumnRenamed("key", "doc_id")


def record_report(stored: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of documents as read from the files."""
    return stored.select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
