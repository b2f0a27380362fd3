"""Best-fit packing of token sequences by minimum bin slack.

Each bin starts with the longest length left; a bitset subset-sum over the lengths still
available finds the fullest combination that goes with it, which is then removed. Equal
bins are taken together: a combination is repeated while all its lengths last. The planner
only sees the histogram of lengths (one row per length, at most ``capacity`` of them), so
its work does not depend on the number of pieces. Pieces find their place by their rank
among pieces of their length.

Null and empty texts are one piece holding only the end id. Repeated rows are packed once
each. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.llm.pretokens import library_encoder
from emberscope.llm.storage import stored, text_of
from emberscope.session import ship_package

# Pieces of one length that are ranked in one group.
RANKED_TOGETHER = 50_000


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, keep_ids: bool = True) -> DataFrame:
    """Token pieces of whole texts: ``doc_id, piece, start, length, ids_crc32`` and, if kept, ``ids``.

    A text's ids are followed by ``end_id``; only what is longer than ``capacity`` is cut.
    """
    ship_package(docs.sparkSession)
    kept = docs.select("doc_id", text_of().alias("text"))
    key_type = kept.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        for batch in batches:
            for a, _, ids, counts in encoder.chunks(batch.column(1)):
                ends = np.cumsum(counts)
                rows: list[int] = []
                piece: list[int] = []
                parts: list[np.ndarray] = []
                for i, (e, n) in enumerate(zip(ends.tolist(), counts.tolist())):
                    own = np.append(ids[e - n : e], np.uint32(end_id)).astype("<u4")
                    for k in range(0, n + 1, capacity):
                        rows.append(a + i)
                        piece.append(k // capacity)
                        parts.append(own[k : k + capacity])
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array([p * capacity for p in piece], pa.int64()),
                    pa.array(map(len, parts), pa.int64()),
                    pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {key_type}, piece int, start long, length long, ids_crc32 long"
    return kept.mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best; ``available`` is (length, count), longest first."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length, count in available:
        if length > room:
            continue
        steps.append((length, reach))
        left, power = min(count, room // length), 1
        while left:
            take = min(power, left)
            reach |= (reach << take * length) & mask
            left, power = left - take, power * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        while not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + 1
            total -= length
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how often each is used, until the histogram is used up."""
    left = {k: v for k, v in histogram.items() if v > 0}
    plan = []
    lengths = sorted(left, reverse=True)
    while lengths:
        longest = lengths[0]
        rest = [(k, left[k] - (k == longest)) for k in lengths if left[k] - (k == longest) > 0]
        chosen = fullest(rest, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        plan.append((chosen, times))
        for k, n in chosen.items():
            left[k] -= n * times
        lengths = [k for k in lengths if left[k] > 0]
    return plan


def _slots(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, per bin, first sequence, offset) for each use of a length."""
    used: dict[int, int] = {}
    sequence, out = 0, []
    for chosen, times in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n, rank = chosen[length], used.get(length, 0)
            out.append((length, rank, rank + n * times, n, sequence, offset))
            used[length] = rank + n * times
            offset += n * length
        sequence += times
    return out


def pack(pieces: DataFrame, capacity: int, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (a stored table with ``length``) with ``sequence_id`` and ``offset``.

    Full pieces are sequences of their own, with negative numbers. The others are ranked
    within their length in groups of about ``RANKED_TOGETHER``, so a very common length is
    not one task's work. The list of places is broadcast: lengths of one combination sum
    to at most ``capacity``, and every combination but the repeats at its end uses up a
    length, so it has at most about ``capacity ** 1.5`` rows.
    """
    spark = pieces.sparkSession
    if pieces.filter(~F.col("length").between(1, capacity)).limit(1).count():
        raise ValueError("every piece needs a length from 1 to the capacity")
    whole = pieces.filter(F.col("length") == capacity).select(
        *pieces.columns, (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    part = pieces.filter(F.col("length") < capacity)
    histogram = {int(r["length"]): r["n"] for r in part.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(plan_bins(histogram, capacity))
    salts = spark.createDataFrame(
        [(k, -(-n // RANKED_TOGETHER)) for k, n in histogram.items()], "length long, _groups long"
    )
    places = spark.createDataFrame(
        slots, "_length long, _first long, _after long, _per long, _sequence long, _offset long"
    )
    salted = part.join(F.broadcast(salts), "length").withColumn(
        "_salt", F.expr(f"pmod(xxhash64({', '.join(f'`{c}`' for c in order)}), _groups)")
    )
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = sizes.select(
        "length",
        "_salt",
        (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"),
    )
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order))
    ranked = salted.withColumn("_own", own).join(before, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_own") - 1)
    placed = ranked.join(
        F.broadcast(places),
        (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_after")),
    )
    at = F.col("_rank") - F.col("_first")
    return placed.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(at / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (at % F.col("_per")) * F.col("length")).alias("offset"),
    ).unionByName(whole)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """Tokenise, cut and pack whole texts; the pieces are stored once and read from there."""
    return pack(stored(cut_pieces(docs, vocabulary, capacity, end_id, keep_ids), "pieces"), capacity)
