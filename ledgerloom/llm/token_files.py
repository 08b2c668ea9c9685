"""Token ids as raw binary shards with a minimal perfect hash index.

Documents are sorted by key over all shards. A shard is two files: the payload,
nothing but ids one after the other, and the index, which maps a key to the
place of its ids in constant time. The index holds no key of its slots, only a
fingerprint of each, which turns away keys that are not in the shard (but for
one in four billion). The keys themselves are listed for reading a whole shard.

The hash is built level by level: keys that fall alone into a bit of a level
own it, the others go on to the next; the slot of a key is the rank of its bit.

Every attempt of a task writes files of new names, and only those named in the
manifest, which Spark commits, count. So a task may run twice.

NULL and empty texts are the end id alone. Rows that share a key lie side by
side, in order of a hash of their texts, and share a slot; a NULL key is a key like any other and comes
first; an empty table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import pieces, stored, texts_of
from ledgerloom.llm.vocabulary import BYTE_BPE, TEXTS_AT_ONCE, encoded

END_ID = 2
# Bits per key and level of the hash: more bits, fewer levels.
BITS_PER_KEY = 2
# Ids of a shard: the task begins another one there. Its keys and lengths are held in memory until then.
SHARD_IDS = 1 << 27
# Bytes of a payload that are read together.
READ_BYTES = 8 << 20
_MAGIC = b"MPHIDX01"

MANIFEST = "payload string, index string, documents long, ids long, roll int"


def _hashes(keys: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each key."""
    raw = b"".join(xxhash.xxh128_digest(b"\x00" if k is None else b"\x01" + str(k).encode()) for k in keys)
    both = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _places(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = first + second * np.uint64(2 * level + 1)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)


class PerfectHash:
    """Maps n distinct keys to 0 .. n-1; other keys to any of these or to -1."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int64)

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray) -> PerfectHash:
        sizes, words = [], [np.zeros(0, "<u8")]
        while len(first):
            size = -(-BITS_PER_KEY * len(first) // 64) * 64
            place = _places(first, second, len(sizes), size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = ~alone[place]
            first, second = first[rest], second[rest]
        return cls(np.array(sizes, "<i8"), np.concatenate(words))

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        found, left, base = np.full(len(first), -1), np.arange(len(first)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = _places(first[left], second[left], level, size) + np.uint64(base)
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            own = self.words[word] >> bit & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[own]] = (self.ranks[word] + np.bitwise_count(below))[own]
            left, base = left[~own], base + size
        return found


def index_bytes(keys: pa.Array, offsets: np.ndarray, id_bytes: int) -> bytes:
    """The index file of a shard whose document i has the ids from ``offsets[i]`` up to ``offsets[i + 1]``."""
    first, second = _hashes(keys.to_pylist())
    # equal keys lie side by side, but what counts is the hash
    _, start, copies = np.unique(np.stack([first, second]), axis=1, return_index=True, return_counts=True)
    hashed = PerfectHash.build(first[start], second[start])
    slot = hashed.slots(first[start], second[start])
    fingerprints, records, counts = np.zeros(len(slot), "<u4"), np.zeros(len(slot), "<u8"), np.zeros(len(slot), "<u4")
    fingerprints[slot], records[slot], counts[slot] = second[start] >> np.uint64(32), start, copies
    listed = pa.BufferOutputStream()
    with pa.ipc.new_stream(listed, pa.schema([("key", keys.type)])) as out:
        out.write_batch(pa.record_batch([keys], names=["key"]))
    arrays = {
        "sizes": hashed.sizes, "words": hashed.words, "fingerprints": fingerprints, "records": records,
        "counts": counts, "offsets": offsets.astype("<u8"), "keys": np.frombuffer(listed.getvalue(), np.uint8),
    }
    header = json.dumps({"id_bytes": id_bytes, "arrays": [[k, v.dtype.str, len(v)] for k, v in arrays.items()]}).encode()
    return _MAGIC + struct.pack("<Q", len(header)) + header + b"".join(v.tobytes() for v in arrays.values())


class Shard:
    """Keyed access to one shard; the payload is read at the place of the key only."""

    def __init__(self, payload: str, index: str):
        system, path = pyarrow.fs.FileSystem.from_uri(index)
        with system.open_input_file(path) as file:
            raw = file.read()
        if raw[:8] != _MAGIC:
            raise ValueError(f"{index} is no index")
        at = 16 + struct.unpack("<Q", raw[8:16])[0]
        header = json.loads(raw[16:at])
        self.id_bytes, arrays = header["id_bytes"], {}
        for name, kind, n in header["arrays"]:
            arrays[name] = np.frombuffer(raw, kind, n, at)
            at += arrays[name].nbytes
        self.hash = PerfectHash(arrays["sizes"], arrays["words"])
        self.fingerprints, self.records, self.counts = (arrays[k] for k in ("fingerprints", "records", "counts"))
        self.offsets = arrays["offsets"].astype(np.int64)
        self.keys = pa.ipc.open_stream(arrays["keys"].tobytes()).read_all().column(0).combine_chunks()
        system, path = pyarrow.fs.FileSystem.from_uri(payload)
        self.file = system.open_input_file(path)

    def find(self, keys: Sequence) -> list[range]:
        """The records of every key, none for a key that the fingerprint turns away."""
        first, second = _hashes(keys)
        slot = self.hash.slots(first, second)
        if not len(self.fingerprints):
            return [range(0)] * len(keys)
        known = (slot >= 0) & (self.fingerprints[slot] == second >> np.uint64(32))
        start, n = self.records[slot].astype(np.int64), np.where(known, self.counts[slot], 0)
        return [range(i, i + k) for i, k in zip(start.tolist(), n.tolist())]

    def ids(self, record: int) -> np.ndarray:
        return next(self.several([record]))

    def several(self, records: Sequence[int]) -> Iterator[np.ndarray]:
        """The ids of some records; those that lie side by side are read in one piece, up to ``READ_BYTES``."""
        at = 0
        while at < len(records):
            first, stop = records[at], at + 1
            begin = int(self.offsets[first])
            while (
                stop < len(records)
                and records[stop] == first + stop - at
                and (self.offsets[records[stop] + 1] - begin) * self.id_bytes <= READ_BYTES
            ):
                stop += 1
            bounds = self.offsets[first : first + stop - at + 1] - begin
            raw = self.file.read_at(int(bounds[-1]) * self.id_bytes, begin * self.id_bytes)
            found = np.frombuffer(raw, f"<u{self.id_bytes}").astype("<u4")
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield found[i:j]
            at = stop


class Store:
    """Keyed access to all shards from one process, for instance a training job's loader."""

    def __init__(self, manifest: DataFrame):
        self.rows = manifest.orderBy("shard").collect()
        self.opened: dict[int, Shard] = {}
        self.lasts = [(r["last_key"] is not None, r["last_key"]) for r in self.rows]

    def get(self, key) -> list[np.ndarray]:
        """The ids of every document with this key."""
        place, found = (key is not None, key), []
        for i in range(bisect_left(self.lasts, place), len(self.rows)):
            row = self.rows[i]
            if (row["first_key"] is not None, row["first_key"]) > place:
                break
            shard = self.opened.get(i) or self.opened.setdefault(i, Shard(row["payload"], row["index"]))
            found += [shard.ids(record) for record in shard.find([key])[0]]
        return found


def write(
    df: DataFrame,
    folder: str,
    text: str = "text",
    key: str = "doc_id",
    path: str = BYTE_BPE,
    end_id: int = END_ID,
    id_bytes: int = 2,
    shards: int | None = None,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Encode, write shards below ``folder`` in ascending order of ``key``, return the manifest.

    ``folder`` is a place that all executors reach through pyarrow's file systems. There are as many ranges of keys as shuffle
    partitions unless ``shards`` says otherwise, and a shard for every ``shard_ids`` ids of a range, or a little more. ``id_bytes`` is 2 for
    vocabularies up to 65,536 ids and 4 beyond. The manifest has a row per shard: ``shard``,
    ``first_key``, ``last_key``, the file names, numbers of ``documents`` and ``ids`` and
    ``start``, the ids of all shards before it.
    """
    spark = df.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_type = df.schema[key].dataType
    names = ["first_key", "last_key"]
    schema = StructType([StructField(k, key_type) for k in names] + _parse_datatype_string(MANIFEST).fields)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    most = 1 << 8 * id_bytes

    def run(batches):
        system, root = pyarrow.fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        rolls = 0

        def closed(name: str, file, keys: list, lengths: list) -> pa.RecordBatch:
            file.close()
            listed = pa.array(keys, arrow.field(0).type)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            with system.open_output_stream(f"{root}/{name}.idx") as out:
                out.write(index_bytes(listed, offsets, id_bytes))
            row = [keys[0], keys[-1], f"{folder}/{name}.ids", f"{folder}/{name}.idx", len(keys), int(offsets[-1]), rolls]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        name, file, keys, lengths, written = "", None, [], [], 0
        for part in pieces(batches, TEXTS_AT_ONCE):
            for one, raw in zip(part.column(0).to_pylist(), encoded(texts_of(part.column(1)), path)):
                if file is None:
                    name, keys, lengths, written = f"shard-{uuid.uuid4().hex}", [], [], 0
                    file = system.open_output_stream(f"{root}/{name}.ids")
                ids = np.append(np.frombuffer(raw, "<u4"), end_id)
                if ids.max() >= most:
                    raise ValueError(f"id {ids.max()} does not fit in {id_bytes} bytes")
                file.write(ids.astype(f"<u{id_bytes}").tobytes())
                keys.append(one)
                lengths.append(len(ids))
                written += len(ids)
                if written >= shard_ids:
                    yield closed(name, file, keys, lengths)
                    file, rolls = None, rolls + 1
        if file is not None:
            yield closed(name, file, keys, lengths)

    chosen = df.select(as_column(key).alias("_key"), as_column(text).cast("string").alias("_text"))
    # rows of one key may fill several shards; rows alike in all are told apart by their place
    order = ["_key", "_hash", "_row"]
    chosen = chosen.select("*", F.xxhash64("_text").alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    in_order = chosen.repartitionByRange(n, *order).sortWithinPartitions(*order)
    written = in_order.mapInArrow(run, schema).withColumn("part", F.spark_partition_id())
    in_turn = Window.orderBy("part", "roll")  # a row per shard
    manifest = stored(written, "manifest").withColumn("shard", F.row_number().over(in_turn) - 1).drop("part", "roll")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")))


def read(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document, from the files: ``key``, ``start`` (ids of all documents before it) and ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers. Every key is looked up through the index.
    """
    key_type = manifest.schema["first_key"].dataType
    schema = StructType([StructField("_key", key_type), *_parse_datatype_string("start long, ids binary").fields])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches):
        for part in pieces(batches, 1):
            payload, index, start = (part.column(i)[0].as_py() for i in range(3))
            shard = Shard(payload, index)
            keys = list(dict.fromkeys(shard.keys.to_pylist()))
            for at in range(0, len(keys), 1024):
                some = keys[at : at + 1024]
                rows = [(k, r) for k, records in zip(some, shard.find(some)) for r in records]
                columns = [
                    [k for k, _ in rows],
                    [start + int(shard.offsets[r]) for _, r in rows],
                    [ids.tobytes() for ids in shard.several([r for _, r in rows])],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("payload", "index", "start").repartition(n)
    return files.mapInArrow(run, schema).toDF(key, "start", "ids")
