"""Spelling variants: generated edits probed against Bloom filters, verified by a join.

Words are counted once over all texts; what follows works on the vocabulary. Its words go
into blocked Bloom filters, one per word length: a word picks a block of 512 bits and sets
one bit in each of its eight 64-bit parts. The filters are broadcast, ``FILTER_BYTES`` at
most at a time; a larger vocabulary is split by hash and probed in as many passes. Every
word generates its edits in numpy, lengths together: one code point deleted, or replaced by
a later one of the alphabet (insertions are the deletions of the longer word, replacements
by earlier ones those of the other word). Only edits that the filter of their length admits
are spelt out and shuffled to the vocabulary, where an equality join removes the false ones.

Hashes of edits are sums of code points times powers, so an edit is a difference; they
choose bits only, and never stand for a word.

Odd input: null and empty texts hold no words. Rows sharing an id, or without one, are all
counted; in the edit rule a null id reads "null". Very long texts are read whole. Ties of
count go to the word that is smallest in code-point order. Other columns are ignored. An
empty vocabulary gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.storage import stored, text_of
from emberscope.session import ship_package

RUN = re.compile("[A-Za-zÀ-ÿ]+")
# Fixed value: one run in so many is misspelt by rule.
MISSPELT = 199

# Bounds; none changes a result.
FILTER_BYTES = 64 << 20  # of all filters of one pass
BITS_PER_WORD = 16
SLICE_BLOCKS = 4096  # blocks of a filter built by one group, 256 KB
COUNTS_MAX = 400_000  # distinct words a task holds before it passes its counts on
PROBES = 4_000_000  # edits in memory at once

_POWER = np.uint64(0x9E3779B97F4A7C15)


def runs_of(doc_id: object, text: str, least: int) -> Counter:
    """Counts of the runs of a text, after the deletion rule, of ``least`` code points or more."""
    start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        if len(run) < least:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % MISSPELT == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """word and n of the words that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.update(runs_of(doc_id, text.as_py(), least_length))
                if len(held) >= COUNTS_MAX:
                    yield passed_on()
                    held.clear()
        yield passed_on()

    ship_package(docs.sparkSession)
    counted = docs.select("doc_id", text_of().alias("text")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _powers(length: int) -> np.ndarray:
    out = np.full(length + 1, _POWER)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64)


def word_keys(words: list[str], length: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (_codes(words, length) * _powers(length)[length - 1 :: -1][:length]).sum(1, dtype=np.uint64)


def _block(mixed: np.ndarray, blocks: int) -> np.ndarray:
    return (((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def _bit(mixed: np.ndarray, part: int) -> np.ndarray:
    """Bit of one of the eight 64-bit parts of the block."""
    with np.errstate(over="ignore"):
        again = mixed * _powers(part + 1)[part + 1]
    return np.uint64(1) << (again >> np.uint64(58))


def set_bits(mixed: np.ndarray, block: np.ndarray, blocks: int) -> np.ndarray:
    """A filter of ``blocks`` blocks holding the given keys; ``block`` is the place of each."""
    bits = np.zeros(blocks * 8, np.uint64)
    for part in range(8):
        np.bitwise_or.at(bits, block * 8 + part, _bit(mixed, part))
    return bits


def admitted(bits: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold, as places in ``mixed``."""
    left = np.arange(len(mixed))
    block = _block(mixed, len(bits) // 8) * 8
    for part in range(8):
        hit = (bits[block + part] & _bit(mixed, part)) != 0
        left, mixed, block = left[hit], mixed[hit], block[hit]
        if not len(left):
            break
    return left


def _by_length(words: list[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return out


def admitted_edits(words: list[str], filters: dict[int, np.ndarray], alphabet: np.ndarray) -> Iterator[tuple[str, str]]:
    """(word, edit) of the edits that the filter of their length admits.

    ``alphabet`` is sorted. Deleting either of two equal neighbours gives the same word, so
    only the first of such a run is deleted.
    """
    for length, every in _by_length(words).items():
        shorter, same = filters.get(length - 1), filters.get(length)
        power = _powers(length)
        step = max(1, PROBES // (length * max(1, len(alphabet))))
        for a in range(0, len(every), step):
            some = every[a : a + step]
            codes = _codes(some, length)
            with np.errstate(over="ignore"):
                terms = codes * power[length - 1 :: -1][:length]
                whole = terms.sum(1, dtype=np.uint64)
                # Sums without the place: what stands before it has one power less, what follows stays.
                before, after = np.zeros(len(some), np.uint64), whole.copy()
                for at in range(length):
                    after -= terms[:, at]
                    if shorter is not None:
                        new = np.flatnonzero(codes[:, at] != codes[:, at - 1]) if at else np.arange(len(some))
                        for i in new[admitted(shorter, _mixed((before + after)[new]))].tolist():
                            yield some[i], some[i][:at] + some[i][at + 1 :]
                        before += codes[:, at] * power[length - 2 - at]
                    if same is not None:
                        row, letter = np.nonzero(alphabet[None, :] > codes[:, at, None])
                        by = alphabet[letter]
                        keys = whole[row] + (by - codes[row, at]) * power[length - 1 - at]
                        for i in admitted(same, _mixed(keys)).tolist():
                            w = some[row[i]]
                            yield w, w[:at] + chr(int(by[i])) + w[at + 1 :]


def _filters(words: DataFrame, sizes: dict[int, int], part: int, parts: int) -> dict[int, np.ndarray]:
    """Bloom filters by word length of one part of the vocabulary, built slice by slice."""
    blocks = {n: max(1, -(-c * BITS_PER_WORD // (512 * parts))) for n, c in sizes.items()}

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, some in _by_length(batch.column(0).to_pylist()).items():
                mixed = _mixed(word_keys(some, length))
                mixed = mixed[mixed % np.uint64(parts) == part]
                block = _block(mixed, blocks[length])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(mixed), length, np.int32)),
                        pa.array((block // SLICE_BLOCKS).astype(np.int32)),
                        pa.array(mixed.view(np.int64)),
                    ],
                    ["length", "slice", "mixed"],
                )

    def built(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        length, at = key[0].as_py(), key[1].as_py()
        mixed = table["mixed"].to_numpy().view(np.uint64)
        size = min(SLICE_BLOCKS, blocks[length] - at * SLICE_BLOCKS)
        bits = set_bits(mixed, _block(mixed, blocks[length]) - at * SLICE_BLOCKS, size)
        return pa.table({"length": [length], "slice": pa.array([at], pa.int32()), "bits": [bits.tobytes()]}).cast(
            pa.schema([("length", pa.int32()), ("slice", pa.int32()), ("bits", pa.binary())])
        )

    slices = (
        words.select("word")
        .mapInArrow(keyed, "length int, slice int, mixed long")
        .groupBy("length", "slice")
        .applyInArrow(built, "length int, slice int, bits binary")
    )
    out = {n: np.zeros(b * 8, np.uint64) for n, b in blocks.items()}
    for r in slices.toLocalIterator():
        bits = np.frombuffer(bytes(r["bits"]), np.uint64)
        at = r["slice"] * SLICE_BLOCKS * 8
        out[r["length"]][at : at + len(bits)] = bits
    return out


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: both directions of all pairs one edit apart. ``words`` is stored."""
    spark = words.sparkSession
    sizes = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    letters = words.select(F.explode(F.split("word", "")).alias("c")).distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.collect() if r["c"]), np.uint64)
    parts = max(1, -(-sum(sizes.values()) * BITS_PER_WORD // (8 * FILTER_BYTES)))
    found = None
    for part in range(parts):
        shared = spark.sparkContext.broadcast(_filters(words, sizes, part, parts))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held = list(admitted_edits(batch.column(0).to_pylist(), shared.value, alphabet))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in held], pa.string()), pa.array([e for _, e in held], pa.string())],
                    ["word", "other"],
                )

        positives = stored(words.select("word").mapInArrow(probe, "word string, other string"), "positives")
        shared.destroy()
        found = positives if found is None else found.unionByName(positives)
    true = found.distinct() if parts > 1 else found
    one_way = (
        true.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
        .join(words, "word")
        .select("word", "n", "other", "other_n")
    )
    one_way = stored(one_way, "near")
    back = one_way.selectExpr("other AS word", "other_n AS n", "word AS other", "n AS other_n")
    return one_way.unionByName(back)


def _roots(forms: DataFrame) -> DataFrame:
    """word and the last of its forms; every step doubles the way already followed.

    Counts rise at least fivefold from word to form, so chains are short and have no loops.
    """
    ways = stored(forms.selectExpr("word", "form AS root"), "roots")
    while True:
        onward = ways.selectExpr("word AS root", "root AS further")
        longer = ways.join(onward, "root", "left").selectExpr(
            "word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved"
        )
        longer = stored(longer, "roots")
        ways = longer.select("word", "root")
        if not longer.filter("moved").limit(1).count():
            return ways


def group_variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the vocabulary."""
    words = stored(vocabulary(docs, least_length, least_count), "vocabulary")
    near = near_pairs(words).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best")
    )
    big = f"-best.m >= {ratio} * n"
    near = near.selectExpr(
        "word", "n_near", f"IF({big}, best.other, NULL) AS form", f"IF({big}, -best.m, NULL) AS form_n"
    )
    near = stored(near, "forms")
    roots = _roots(near.filter("form IS NOT NULL"))
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .selectExpr(
            "word", "n", "coalesce(n_near, 0L) AS n_near", "form", "form_n", "coalesce(root, word) AS root"
        )
    )
