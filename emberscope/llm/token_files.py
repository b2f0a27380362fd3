"""Token ids as binary blocks with a minimal perfect hash index for keyed access.

A block is one row of a Parquet table: the raw little-endian unsigned 32-bit ids of whole
documents in ascending key order, and an index over their keys. The index hashes each key
to a slot of its own (a pilot per small bucket of keys makes the hash perfect, as many slots
as keys make it minimal); a slot holds a fingerprint of the key and where its documents
lie. A key outside the block is told by its fingerprint. Blocks know how many ids their
shard has before them, so the start of a document over all files follows from the totals
of the shards. Spark's writer commits blocks, so a lost task leaves nothing behind.

Null and empty texts hold only the end id. Rows with the same key lie next to each other
and share a slot; null keys come first, under a key of their own and in blocks of their
own. A text of any length is one document. Extra columns are ignored, and an empty table
gives files without blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberscope.llm.pretokens import library_encoder
from emberscope.llm.storage import text_of
from emberscope.session import broadcast_if_small, ship_package

# Characters of text in a shard, ids in a block; a longer document is a block by itself.
SHARD_CHARS = 24_000_000
BLOCK_IDS = 250_000
# Rows in a block, which bounds the work for its index where texts are short.
BLOCK_ROWS = 8_192
# Bounds of the encoder, beside the texts and blocks that a worker holds.
CACHE_WORDS = 300_000
CHUNK_CHARS = 400_000

BLOCK = (
    "shard int, block int, before long, n_ids long, first_key string, last_key string, keys array<string>,"
    " pilots binary, fingerprints binary, rows binary, lengths binary, ids binary"
)
_NULL_KEY, _WORD = "\x00null", (1 << 64) - 1
_NAMES = [c.split()[0] for c in BLOCK.split(", ")]


def _mix(x: int) -> int:
    x = (x ^ x >> 31) * 0x7FB5D329728EA185 & _WORD
    x = (x ^ x >> 27) * 0x81DADEF4BC2DD44D & _WORD
    return x ^ x >> 33


def _hash(key: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))


def _slot(h: int, pilot: int, n: int) -> int:
    return _mix(h ^ _mix(pilot + 1)) % n


def _mix_all(x: np.ndarray) -> np.ndarray:
    """``_mix`` of many numbers."""
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ x >> np.uint64(33)


def build_index(keys: list[str]) -> tuple[list[int], list[int]]:
    """Pilots by bucket, and the slot of each of the distinct ``keys``.

    A bucket takes the first pilot that sends its keys to free slots; pilots are tried side by side.
    """
    n = len(keys)
    hashes = np.fromiter(map(_hash, keys), np.uint64, n)
    n_buckets = n // 4 + 1
    bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
    members, sizes = np.argsort(bucket, kind="stable"), np.bincount(bucket, minlength=n_buckets)
    ends = np.cumsum(sizes)
    pilots, slots, taken = [0] * n_buckets, np.zeros(n, np.int64), np.zeros(n, bool)
    salts = np.zeros(0, np.uint64)
    for b in np.argsort(-sizes, kind="stable").tolist():
        own = members[ends[b] - sizes[b] : ends[b]]
        first, tries = 0, 32
        while len(own):
            while len(salts) < first + tries:
                more = np.arange(len(salts) + 1, 2 * len(salts) + tries + 1, dtype=np.uint64)
                salts = np.append(salts, _mix_all(more))
            at = (_mix_all(hashes[own] ^ salts[first : first + tries, None]) % np.uint64(n)).astype(np.int64)
            good = ~taken[at].any(axis=1)
            if len(own) > 1:
                apart = np.sort(at, axis=1)
                good &= (apart[:, 1:] != apart[:, :-1]).all(axis=1)
            found = int(good.argmax())
            if good[found]:
                pilots[b] = first + found
                slots[own] = at[found]
                taken[at[found]] = True
                break
            first, tries = first + tries, min(2 * tries, 4096)
    return pilots, slots.tolist()


class Block:
    """One block read back: views of the buffers of its row, no copies."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        view = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)
        self.start = batch.column("start")[i].as_py()
        self.pilots, self.fingerprints = view("pilots", "<u4"), view("fingerprints", "<u4")
        self.rows = view("rows", "<i8").reshape(-1, 2)
        self.lengths = view("lengths", "<i8")
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.ids = view("ids", "<u4")

    def find(self, key: str) -> list[tuple[int, int]]:
        """(start in the block, number of ids) of each row under ``key``."""
        n = len(self.fingerprints)
        h = _hash(key)
        s = _slot(h, int(self.pilots[h % len(self.pilots)]), n)
        if int(self.fingerprints[s]) != h >> 32:
            return []
        first, count = self.rows[s].tolist()
        return [(int(self.starts[i]), int(self.lengths[i])) for i in range(first, first + count)]

    def payload(self, start: int, length: int) -> np.ndarray:
        return self.ids[start : start + length]


def _block(shard: int, block: int, before: int, keys: list[str], parts: list[np.ndarray]) -> pa.RecordBatch:
    distinct, first, count = [], [], []
    for i, k in enumerate(keys):
        if distinct and distinct[-1] == k:
            count[-1] += 1
        else:
            distinct.append(k)
            first.append(i)
            count.append(1)
    pilots, slots = build_index(distinct)
    fingerprints, rows = np.zeros(len(distinct), "<u4"), np.zeros((len(distinct), 2), "<i8")
    fingerprints[slots] = [_hash(k) >> 32 for k in distinct]
    rows[slots] = np.column_stack([first, count])
    lengths = np.array([len(p) for p in parts], "<i8")
    values = [
        shard, block, before, int(lengths.sum()), distinct[0], distinct[-1], distinct,
        np.array(pilots, "<u4").tobytes(), fingerprints.tobytes(), rows.tobytes(), lengths.tobytes(),
        np.concatenate(parts).astype("<u4").tobytes(),
    ]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]
    kinds += [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=_NAMES)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, key: str = "doc_id") -> None:
    """Encode whole texts, end each with ``end_id`` and write the blocks in ascending key order.

    The range shuffle moves texts, not ids. Its order includes a hash of the text, so a
    key that many rows share is spread over shards as well.
    """
    ship_package(docs.sparkSession)
    kept = docs.select(F.col(key).alias("key"), text_of().alias("text"))
    chars = kept.agg(F.sum(F.length("text"))).first()[0] or 0
    ordered = (
        kept.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(max(1, -(-chars // SHARD_CHARS)), "key", "tie")
        .sortWithinPartitions("key", "tie")
        .select(F.coalesce(F.col("key").cast("string"), F.lit(_NULL_KEY)).alias("key"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard = library_encoder(vocabulary, CACHE_WORDS, CHUNK_CHARS), TaskContext.get().partitionId()
        block = before = size = 0
        keys: list[str] = []
        parts: list[np.ndarray] = []
        end = np.array([end_id], np.uint32)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for a, b, ids, counts in encoder.chunks(batch.column(1)):
                at = 0
                for k, n in zip(names[a:b], counts.tolist()):
                    if len(keys) >= BLOCK_ROWS or (keys and keys[-1] == _NULL_KEY != k):
                        yield _block(shard, block, before, keys, parts)
                        block, before, size, keys, parts = block + 1, before + size, 0, [], []
                    keys.append(k)
                    parts.append(np.concatenate([ids[at : at + n], end]))
                    at, size = at + n, size + n + 1
                    if size >= BLOCK_IDS:
                        yield _block(shard, block, before, keys, parts)
                        block, before, size, keys, parts = block + 1, before + size, 0, [], []
        if keys:
            yield _block(shard, block, before, keys, parts)

    ordered.mapInArrow(run, BLOCK).write.parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks, each with ``start``, the ids of all blocks before it.

    Two numbers a shard are broadcast as long as the shards are measured to be few, so
    blocks are not moved.
    """
    table = spark.read.schema(BLOCK).parquet(path)
    totals = table.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    base = totals.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("_base"))
    return table.join(broadcast_if_small(base), "shard").withColumn("start", F.col("_base") + F.col("before")).drop("_base")


def _answers(batches: Iterator[pa.RecordBatch], wanted: str, key_type: pa.DataType, keep_ids: bool):
    for batch in batches:
        for i in range(batch.num_rows):
            block = Block(batch, i)
            found = [(k, s, n) for k in batch.column(wanted)[i].as_py() for s, n in block.find(k)]
            raw = [block.payload(s, n) for _, s, n in found]
            keys = pa.array([None if k == _NULL_KEY else k for k, _, _ in found], pa.string())
            columns = [
                keys.cast(key_type),
                pa.array([block.start + s for _, s, _ in found], pa.int64()),
                pa.array([n for _, _, n in found], pa.int64()),
                pa.array([zlib.crc32(x) for x in raw], pa.int64()),
            ]
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array([x.view("<i4") for x in raw], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


_ANSWER = "doc_id {}, start long, n_tokens long, ids_crc32 long"
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def read_documents(spark: SparkSession, path: str, key_type: str = "bigint", keep_ids: bool = False) -> DataFrame:
    """Every document, found by its key through the index of its block."""
    ship_package(spark)
    kind = _KINDS[key_type]
    return blocks(spark, path).mapInArrow(
        lambda batches: _answers(batches, "keys", kind, keep_ids),
        _ANSWER.format(key_type) + (", ids array<int>" if keep_ids else ""),
    )


def look_up(keys: DataFrame, path: str, key: str = "doc_id", keep_ids: bool = True) -> DataFrame:
    """The documents under the given keys; keys without documents give no row.

    A key is a candidate of the blocks whose range holds it; keys are gathered per block,
    so a block is read once. Keys must be of an integer type and are taken once each; a null
    among them finds nothing.
    """
    spark = keys.sparkSession
    ship_package(spark)
    table = blocks(spark, path)
    kind = keys.schema[key].dataType.simpleString()
    fences = table.filter(F.col("first_key") != _NULL_KEY).select("shard", "block", *(F.col(c).cast("long").alias(c) for c in ("first_key", "last_key")))
    asked = keys.select(F.col(key).alias("_key")).distinct()
    # Blocks are sorted by key: give each key the widest ranges it can lie in by a coarse grid.
    spans = fences.agg(F.min("first_key"), F.max("last_key"), F.count("*")).first()
    if not spans[2] or spans[0] is None:
        return spark.createDataFrame([], _ANSWER.format(kind) + (", ids array<int>" if keep_ids else ""))
    step = max(1, (spans[1] - spans[0]) // spans[2])
    cell = lambda c: F.floor(F.col(c) / step)
    by_cell = fences.withColumn("_cell", F.explode(F.sequence(cell("first_key"), cell("last_key"))))
    hits = (
        asked.withColumn("_cell", cell("_key"))
        .join(by_cell, "_cell")
        .filter(F.col("_key").between(F.col("first_key"), F.col("last_key")))
        .groupBy("shard", "block")
        .agg(F.collect_set(F.col("_key").cast("string")).alias("asked"))
    )
    arrow = _KINDS[kind]
    return table.join(hits, ["shard", "block"]).mapInArrow(
        lambda batches: _answers(batches, "asked", arrow, keep_ids),
        _ANSWER.format(kind) + (", ids array<int>" if keep_ids else ""),
    )
