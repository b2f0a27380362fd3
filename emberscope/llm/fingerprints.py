"""Document fingerprints from prefix polynomial hashes.

``PrefixHashes`` holds, for one text, the sums of its code points times the powers of two
bases modulo 2^31 - 1 up to every place. A difference of two sums, freed of the power of
its start, is the hash of the span between them, so any two spans, of one text or of two,
are compared in a few steps, and how far they agree from two places on is found by binary
search (``common_extension``).

A fingerprint holds what is needed to compare documents without their texts: length and
hash of the whole; the hashes of its first and last ``s, 2s, 3s ..`` code points, where the
step ``s`` is the power of two that gives ``MARKS`` at most; and the ``SPANS`` smallest
distinct hashes of its spans of ``WINDOW`` code points. ``likeness`` is 1 for equal wholes,
else the larger of two shares: how much of the longer text is covered by the beginning and
the end on which both agree, found by binary search over the marks, and the share of equal
spans (twice the common ones over all), estimated from the smallest. Both are 0 to 1.

Odd input: null text counts as empty. Two empty texts are alike, an empty and another one
are not. A text shorter than a span is one span. Rows sharing an id, or without one, are
documents of their own, ordered by a hash of their text within the id (null ids last).
Very long texts are hashed whole, in blocks. Other columns are ignored. Of an empty table
no rows come, and a single document follows itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.llm.storage import stored, text_of
from emberscope.session import ship_package

PRIME = (1 << 31) - 1
BASES = (1_204_657_873, 1_779_033_703)
BLOCK = 1 << 16  # code points hashed at once; also the size of the tables of powers

MARKS = 16
SPANS = 24
WINDOW = 32


def _folded(x: np.ndarray) -> np.ndarray:
    """Equal to ``x`` modulo 2^31 - 1, and smaller: below 2^33 for any ``x`` up to 2^63."""
    return (x & np.uint64(PRIME)) + (x >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo 2^31 - 1, for ``x`` up to 2^63."""
    x = _folded(_folded(x))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


@lru_cache(8)
def _powers(base: int) -> np.ndarray:
    """The first ``BLOCK`` powers of a base."""
    out = np.ones(BLOCK, np.uint64)
    done = 1
    while done < BLOCK:
        out[done : 2 * done] = _reduced(out[:done] * np.uint64(pow(base, done, PRIME)))
        done *= 2
    return out


@lru_cache(4)
def _inverse(base: int) -> int:
    return pow(base, -1, PRIME)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHashes:
    """Sums of code points times powers up to every place of a text, for two bases."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.sums = [np.zeros(self.n + 1, np.uint32) for _ in BASES]
        for base, sums in zip(BASES, self.sums):
            total, shift = 0, 1
            for a in range(0, self.n, BLOCK):
                part = codes[a : a + BLOCK].astype(np.uint64) + np.uint64(1)
                if shift != 1:
                    part = _reduced(part * np.uint64(shift))
                part = np.cumsum(_folded(part * _powers(base)[: len(part)])) + np.uint64(total)
                sums[a + 1 : a + 1 + len(part)] = part = _reduced(part)
                total, shift = int(part[-1]), shift * pow(base, BLOCK, PRIME) % PRIME

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the spans from ``starts`` to ``ends``, the same wherever their texts stand."""
        out = np.zeros(len(starts), np.uint64)
        for base, sums in zip(BASES, self.sums):
            back = _inverse(base)
            part = sums[ends].astype(np.uint64) + np.uint64(PRIME) - sums[starts]
            part = _reduced(part * _powers(back)[starts % BLOCK])
            if self.n >= BLOCK:
                far = [pow(back, BLOCK * k, PRIME) for k in range(self.n // BLOCK + 1)]
                part = _reduced(part * np.array(far, np.uint64)[starts // BLOCK])
            out = out << np.uint64(31) | part
        return out

    def span(self, start: int, end: int) -> int:
        return int(self.hashes(np.array([start]), np.array([end]))[0])

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of one length by the first base, by their start."""
        sums, back = self.sums[0], _inverse(BASES[0])
        out = np.zeros(max(0, self.n - length + 1), np.uint64)
        far = 1
        for a in range(0, len(out), BLOCK):
            b = min(a + BLOCK, len(out))
            part = sums[a + length : b + length].astype(np.uint64) + np.uint64(PRIME) - sums[a:b]
            part = _reduced(part * _powers(back)[: b - a])
            out[a:b] = part if far == 1 else _reduced(part * np.uint64(far))
            far = far * pow(back, BLOCK, PRIME) % PRIME
        return out


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How many code points agree from place ``i`` of one text and ``j`` of another on."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            low = mid
        else:
            high = mid - 1
    return low


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (h ^ (h >> np.uint64(31))) >> np.uint64(32)


def step_of(n: int) -> int:
    """The smallest power of two that divides ``n`` code points by ``MARKS`` steps at most."""
    return 1 << max(0, (max(n, 1) - 1).bit_length() - (MARKS.bit_length() - 1))


def smallest(values: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` smallest distinct values, sorted."""
    take = 4 * k
    while take < len(values):
        low = np.unique(np.partition(values, take)[:take])
        if len(low) >= k:
            return low[:k]
        take *= 4
    return np.unique(values)[:k]


def fingerprint_of(text: str) -> str:
    h = PrefixHashes(code_points(text))
    n, step = h.n, step_of(h.n)
    ends = np.arange(step, n + 1, step)
    none, every = np.zeros(len(ends) + 1, np.int64), np.full(len(ends), n)
    marks = h.hashes(np.concatenate([none, n - ends]), np.concatenate([[n], ends, every]))
    spans = h.spans(WINDOW) if n >= WINDOW else h.spans(n)[: min(n, 1)]
    held = np.concatenate([_mixed(marks[1:]), smallest(_mixed(spans), SPANS)]).astype("<u4")
    return f"{n:x}.{int(marks[0]):016x}.{base64.b64encode(held.tobytes()).decode()}"


def _parts(fingerprint: str) -> tuple[int, str, np.ndarray, np.ndarray, np.ndarray]:
    """Length, hash, marks from the beginning, marks from the end, smallest spans."""
    length, whole, held = fingerprint.split(".")
    n = int(length, 16)
    held, marks = np.frombuffer(base64.b64decode(held), "<u4"), n // step_of(n)
    return n, whole, held[:marks], held[marks : 2 * marks], held[2 * marks :]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many marks agree; those beyond the first difference all differ."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[mid - 1] == b[mid - 1] else (low, mid - 1)
    return low


def likeness(one: str, other: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if one == other:
        return 1.0
    (n, _, head, tail, low), (m, _, head2, tail2, low2) = _parts(one), _parts(other)
    if not n or not m:
        return 0.0
    step, step2 = step_of(n), step_of(m)
    wide = max(step, step2)  # marks of both lengths
    every, every2 = slice(wide // step - 1, None, wide // step), slice(wide // step2 - 1, None, wide // step2)
    outer = wide * (_agree(head[every], head2[every2]) + _agree(tail[every], tail2[every2]))
    low, low2 = set(low.tolist()), set(low2.tolist())
    both = sorted(low | low2)[: SPANS if max(len(low), len(low2)) == SPANS else None]
    share = sum(x in low and x in low2 for x in both) / len(both)
    return max(min(outer, n, m) / max(n, m), 2 * share / (1 + share))


_ROW = (
    "part int, edge int, doc_id long, n_chars long, text string, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)
_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _followed(text: str, mark: str, after: str, after_mark: str) -> tuple:
    """What the edited text and the next document add to a document."""
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    edited_mark = fingerprint_of(edited)
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return digest, mark, edited_mark, likeness(mark, edited_mark), likeness(mark, after_mark)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with two likenesses; a row each.

    The edited text has its last half replaced by the beginning of the next document in
    descending order of ids; the last document is followed by the first. Documents are
    sorted by ranges, so the next one mostly stands in the same part. The last row of a
    part is finished from a stored table that holds the first and last text of every part.
    """
    spark = docs.sparkSession
    order = [F.desc_nulls_last("doc_id"), F.asc("_tie")]
    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    schema = pa.schema(
        [
            ("part", pa.int32()), ("edge", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
            ("text", pa.string()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ]
    )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = None, []

        def edge(which: int) -> tuple:
            at, doc_id, text, mark = held
            return at, which, doc_id, len(text), text, None, mark, None, None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for doc_id, text, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = text.as_py()
                new = at, doc_id, text, fingerprint_of(text)
                if held is None:
                    held = new
                    rows.append(edge(0))
                else:
                    done = _followed(*held[2:], *new[2:])
                    rows.append((at, None, held[1], len(held[2]), None, *done))
                    held = new
                if len(rows) >= 1000:
                    yield out()
                    rows.clear()
        if held is not None:
            rows.append(edge(1))
            yield out()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                done = _followed(r["text"], r["fingerprint"], r["next_text"], r["next_fingerprint"])
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(_RESULT, (r["doc_id"], r["n_chars"], *done)))],
                    schema=pa.schema([schema.field(c) for c in _RESULT]),
                )

    ship_package(spark)
    both = stored(ranged.mapInArrow(follow, _ROW), "fingerprints")
    edges = both.filter("edge IS NOT NULL")
    firsts = edges.filter("edge = 0").selectExpr("part", "text AS next_text", "fingerprint AS next_fingerprint")
    # One row per part: the part that follows each, and after the last the first one.
    parts = firsts.select("part")
    whole = Window.orderBy("part")
    following = parts.select(
        "part", F.coalesce(F.lead("part").over(whole), F.min("part").over(Window.partitionBy())).alias("next_part")
    )
    lasts = edges.filter("edge = 1").select("part", "doc_id", "n_chars", "text", "fingerprint")
    paired = lasts.join(following, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")
    result = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    finished = paired.select("doc_id", "n_chars", "text", "fingerprint", "next_text", "next_fingerprint").mapInArrow(
        finish, f"{result} near_edited double, near_next double"
    )
    return both.filter("edge IS NULL").select(*_RESULT).unionByName(finished)
