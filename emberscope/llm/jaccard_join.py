"""Near duplicates by exact Jaccard similarity of word shingles, at 0.8 or more.

Universe-partition pigeonhole. Sizes fall into bands such that similar sets lie in the
same or neighbouring bands; a set joins its own band and the one below. In a band, at most
``H`` shingles are in one set of a similar pair and not in the other. Hashes are cut into
``G`` groups of two segments, ``H < 2 * (G - spare)``: at least ``spare + 1`` groups differ
by one shingle at most. Signatures are the non-empty segments. Cost decides the rest: an
empty segment would meet everything, so it gets none, and the other segment of its group
gets its one-deletion neighbourhood instead. In a group of one shingle or none neither
helps; a set with more than ``spare`` of those is left over.

Sets that share a signature are not paired with each other. Each is verified against the
least of them; components follow; only where a signature still joins sets of several
components, pairs across components are verified. A signature shared by more than ``HOT``
components says little, such as one made of a common passage: its sets are left over.
Left-over sets (and those below ``SMALL`` shingles) meet by prefixes: their shingles are
ordered by how many left-over sets have them, rarest first, and similar sets share one of
the first ``n - ceil(0.8 n) + 1``. Shingles of one set only come first and need no row. The place
``r`` of a shingle also bounds the partner: where it is the first one shared, the sets have
``n - r + 1`` shingles in common at most, so the partner has ``(9 (n - r + 1) - 4 n) / 4`` at
most. Across components, sets meet by signature and by sizes that so reach each other;
copies with edits of their own in one text, whose rare shingles are theirs alone, do not.
A pair that the first way misses has both its sets left over, so no link is lost and
nothing is capped. Every candidate is verified on its texts.

Shingles are compared by 64-bit hash. Null and empty texts have no shingles and no links.
Rows without an id, or sharing one, are told apart by a row number. Equal sets are linked
by a 128-bit digest and only the first goes on. An empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.llm.components import components
from emberscope.llm.shingles import CHUNK_BYTES, mix, shingle_sets
from emberscope.llm.storage import stored, text_of
from emberscope.session import broadcast_if_small, ship_package

# Least size in the partition join; similar sets of a smaller one have up to SMALL_PARTNER.
SMALL, SMALL_PARTNER = 24, 28
HOT = 4
MEMBERS_TOGETHER = 2_000
# Signatures that are laid together before they are shuffled, 16 bytes each.
SIGNATURES_TOGETHER = 1_000_000

_U = np.uint64


@lru_cache(1)
def bands() -> list[int]:
    """The least size of each band."""
    edges = [SMALL]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] * 5 // 4 + 1)
    return edges


@lru_cache(None)
def shape(band: int) -> tuple[int, int]:
    """(groups, spare) of a band: sets of up to ``top`` and 1.25 ``top`` differ by ``top / 4``."""
    top = bands()[band + 1] - 1
    base = (top // 4 + 2) // 2
    spare = 2 + base // 24
    return base + spare, spare


def _segments(tokens: np.ndarray, groups: int) -> np.ndarray:
    return ((tokens >> _U(32)) * _U(2 * groups) >> _U(32)).astype(np.int64)


def left_over(tokens: np.ndarray, band: int) -> bool:
    """Whether too many groups of a set hold one shingle or none for its signatures to suffice."""
    groups, spare = shape(band)
    size = np.bincount(_segments(tokens, groups), minlength=2 * groups)
    return int((size.reshape(-1, 2).sum(1) <= 1).sum()) > spare


def signatures(tokens: np.ndarray, mixed: np.ndarray, band: int) -> np.ndarray:
    """Signatures of a sorted set in a band."""
    groups, _ = shape(band)
    segment = _segments(tokens, groups)
    size = np.bincount(segment, minlength=2 * groups)
    full = np.flatnonzero(size)
    sums = np.zeros(2 * groups, np.uint64)
    sums[full] = np.add.reduceat(mixed, (np.cumsum(size) - size)[full])
    pair = size.reshape(-1, 2)
    name = np.arange(2 * groups, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U((band + 1) * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1)
    out = [mix(sums[full] + name[full])]
    lonely = np.zeros(2 * groups, bool)
    lonely[1::2] = (pair[:, 0] == 0) & (pair[:, 1] > 1)
    lonely[0::2] = (pair[:, 1] == 0) & (pair[:, 0] > 1)
    if lonely.any():
        own = lonely[segment]
        out.append(mix(sums[segment[own]] - mixed[own] + name[segment[own]]))
    return np.concatenate(out)


def sketch(tokens: np.ndarray) -> bytes:
    """Counts of the set by leading bits of the hash, about two to a bucket, up to 255 each."""
    bits = max(5, (len(tokens) // 2).bit_length())
    counts = np.bincount((tokens >> _U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def can_be_similar(a: np.ndarray, b: np.ndarray, n: int) -> bool:
    """Whether two sets of ``n`` shingles together may differ by a ninth of them at most."""
    buckets = min(len(a), len(b))
    x, y = a.reshape(buckets, -1).sum(1, dtype=np.int64), b.reshape(buckets, -1).sum(1, dtype=np.int64)
    return 9 * int(np.abs(x - y).sum()) <= n


def _bands_of(n: int) -> tuple[int, ...]:
    """The bands that a set of ``n`` shingles joins."""
    if n < SMALL:
        return ()
    own = bisect.bisect_right(bands(), n) - 1
    return (own, own - 1)[: 1 + (own > 0)]


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(ids, shingle sets) of the rows (id, text), taken out of Arrow a few texts at a time."""
    texts = batch.column(1).cast(pa.binary())
    a = size = 0
    for b, n in enumerate(pc.binary_length(texts).to_numpy().tolist(), 1):
        size += n
        if size >= CHUNK_BYTES or b == len(texts):
            yield batch.column(0).slice(a, b - a), list(shingle_sets(texts.slice(a, b - a).to_pylist()))
            a, size = b, 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, sets in _sets(batch):
            digests = [hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() for tokens in sets]
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            rest = [
                0 < len(tokens) <= SMALL_PARTNER or any(left_over(tokens, band) for band in _bands_of(len(tokens)))
                for tokens in sets
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows,
                    pa.array([len(tokens) for tokens in sets], pa.int64()),
                    pa.array(np.ascontiguousarray(halves[:, 0])),
                    pa.array(np.ascontiguousarray(halves[:, 1])),
                    pa.array(rest, pa.bool_()),
                    pa.array([sketch(tokens) for tokens in sets], pa.binary()),
                ],
                names=["id", "n", "d1", "d2", "rest", "sketch"],
            )


def _signed(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, sigs, ids): the signatures of many sets, laid together by bucket of the signature."""
    sigs: list[np.ndarray] = []
    ids: list[np.ndarray] = []
    held = 0

    def packed() -> pa.RecordBatch:
        sig, owner = np.concatenate(sigs), np.concatenate(ids)
        bucket = ((sig >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        offsets = pa.array(np.concatenate([first, [len(bucket)]]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (sig.view(np.int64), owner)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *lists], names=["bucket", "sigs", "ids"])

    for batch in batches:
        for rows, sets in _sets(batch):
            for i, tokens in zip(rows.to_pylist(), sets):
                mixed = mix(tokens + _U(0x2545F4914F6CDD1D))
                for band in _bands_of(len(tokens)):
                    sigs.append(signatures(tokens, mixed, band))
                    ids.append(np.full(len(sigs[-1]), i, np.int64))
                    held += len(sigs[-1])
            if held >= SIGNATURES_TOGETHER:
                yield packed()
                sigs, ids, held = [], [], 0
    if held:
        yield packed()


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, least id, id) for sorted (sig, id); only the last signature is carried along."""
    last, pivot = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.concatenate([[last is None or sig[0] != last], sig[1:] != sig[:-1]])
        at = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
        least = np.where(at >= 0, ids[np.maximum(at, 0)], pivot if pivot is not None else 0)
        last, pivot = sig[-1], least[-1]
        keep = ids != least
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[keep]), pa.array(least[keep]), pa.array(ids[keep])], names=["sig", "pivot", "id"]
            )


def stars(entries: DataFrame) -> DataFrame:
    """Every (sig, id) but the least of its signature, with that least id."""
    return _ordered_stars(entries.repartition("sig"))


def _ordered_stars(entries: DataFrame) -> DataFrame:
    """As ``stars``, over entries whose equal signatures are in one partition."""
    return entries.sortWithinPartitions("sig", "id").mapInArrow(_stars, "sig long, pivot long, id long")


def signature_stars(rows: DataFrame) -> DataFrame:
    """The stars of the signatures of all sets, ``rows`` being (id, text).

    Nearly all signatures belong to one set and serve only to find that out, so they are
    never stored, and cross the shuffle in lists by bucket, without a row for each.
    """
    buckets = 8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists = rows.mapInArrow(lambda batches: _signed(batches, buckets), "bucket int, sigs array<long>, ids array<long>")
    moved = lists.repartition("bucket").select(F.inline(F.arrays_zip("sigs", "ids"))).toDF("sig", "id")
    return _ordered_stars(moved)


def _pairs_of(batches: Iterator[pa.RecordBatch], read, similar) -> Iterator[pa.RecordBatch]:
    """Pairs that pass, among (pivot, group, member?, id, n, payload) rows, each pivot's own row first."""
    pivot, size, held = None, 0, None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4)]
        a, b = [], []
        for p, member, i, n, own in zip(*columns, read(batch.column(5).to_pylist())):
            if not member:
                pivot, size, held = p, n, own
            elif pivot == p and similar(held, own, size + n):
                a.append(p)
                b.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _pairs_of(batches, lambda raw: (np.frombuffer(r, np.uint8) for r in raw), can_be_similar)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def similar(a: np.ndarray, b: np.ndarray, _: int) -> bool:
        both = len(a) + len(b) - len(np.union1d(a, b))
        return both > 0 and 100 * both >= 80 * (len(a) + len(b) - both)

    return _pairs_of(batches, lambda raw: shingle_sets([t.encode("utf-8", "surrogatepass") for t in raw]), similar)


def _by_pivot(pairs: DataFrame, payload: DataFrame, judge) -> DataFrame:
    """The pairs (a, b) that ``judge`` passes on the payload (id, n, x) of both.

    Members travel to their ``a``, whose own payload is sent once for each few members and
    kept while they stream by.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS_TOGETHER).cast("int").alias("groups"))
    heads = groups.join(payload.withColumnRenamed("id", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), F.lit(False).alias("member"),
        F.col("a").alias("id"), "n", "x",
    )
    members = (
        pairs.join(groups, "a")
        .select("a", F.expr("int(pmod(xxhash64(b), groups))").alias("salt"), F.lit(True).alias("member"), F.col("b").alias("id"))
        .join(payload, "id")
        .select("a", "salt", "member", "id", "n", "x")
    )
    ordered = heads.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", "member")
    return ordered.mapInArrow(judge, "a long, b long")


def _part(pairs: DataFrame, table: DataFrame, label: str) -> DataFrame:
    """The rows of ``table`` whose id is in some pair."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    return stored(table.join(broadcast_if_small(stored(ids, "needed")), "id"), label)


def verify(pairs: DataFrame, rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar: by size, then by bucket counts, then by their texts."""
    one, two = (sizes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
    sized = pairs.join(one, "a").join(two, "b").filter("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)").select("a", "b")
    sized = stored(sized, "sized")
    counts = _part(sized, sizes.withColumnRenamed("sketch", "x"), "counts")
    possible = stored(_by_pivot(sized, counts, _filtered), "possible")
    texts = _part(possible, rows.select("id", F.lit(0).cast("long").alias("n"), F.col("text").alias("x")), "texts")
    return _by_pivot(possible, texts, _verified)


def _labelled(df: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    known = labels.select(F.col("id").alias(column), F.col("component").alias(name))
    return df.join(known, column, "left").withColumn(name, F.coalesce(name, column))


def _across(held: DataFrame, reach: DataFrame | None) -> DataFrame:
    """Pairs (a, b) of different components in ``held`` (sig, id, component).

    ``reach`` (sig, id, n, most) bounds the size of a partner by ``most``. Sizes are matched
    first, one row per signature and size, so sets out of each other's reach never meet.
    """
    sides = [[F.col("id").alias(x), F.col("component").alias(f"c{x}")] for x in "ab"]
    if reach is None:
        x, y = (held.select("sig", *side) for side in sides)
        return x.join(y, "sig").filter("a < b and ca != cb").select("a", "b").distinct()
    sized = stored(held.join(reach, ["sig", "id"]), "sized")
    kinds = sized.groupBy("sig", "n").agg(F.max("most").alias("most"))
    i, j = (kinds.select("sig", F.col("n").alias(f"n{x}"), F.col("most").alias(f"m{x}")) for x in "ab")
    meet = i.join(j, "sig").filter("na <= nb and nb <= ma and na <= mb").select("sig", "na", "nb")
    x, y = (
        sized.select("sig", *side, F.col("n").alias(f"n{name}"), F.col("most").alias(f"m{name}"))
        for name, side in zip("ab", sides)
    )
    near = meet.join(x, ["sig", "na"]).filter("nb <= ma")
    both = near.join(y, ["sig", "nb"]).filter("a != b and ca != cb and na <= mb")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def resolve(
    star: DataFrame, links: DataFrame, rows: DataFrame, sizes: DataFrame, copies: DataFrame, hot: int | None,
    reach: DataFrame | None = None,
):
    """Links among sets that share a signature, and ids of sets with a hot one.

    ``star`` is what ``stars`` gives; ``links`` are known already; ``copies`` lists ids whose set an earlier id has;
    ``reach`` is as in ``_across``.
    """
    star = stored(star.join(copies, "id", "left_anti").select("sig", "pivot", "id"), "stars")
    pairs = stored(star.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    links = stored(links.unionByName(verify(pairs, rows, sizes)), "links")
    labels = stored(components(links), "labels")
    apart = _labelled(_labelled(pairs, labels, "a", "ca"), labels, "b", "cb").filter("ca != cb").select("a", "b")
    apart = stored(apart, "apart")
    mixed = star.join(apart.select(F.col("a").alias("pivot"), F.col("b").alias("id")), ["pivot", "id"], "left_semi")
    mixed = stored(mixed.select("sig").distinct(), "mixed")
    open_stars = star.join(mixed, "sig", "left_semi")
    held = open_stars.select("sig", F.col("pivot").alias("id")).distinct().unionByName(open_stars.select("sig", "id").distinct())
    held = stored(_labelled(held, labels, "id", "component"), "open")
    spread = held.select("sig", "component").distinct().groupBy("sig").count()
    common = stored(spread.filter(F.col("count") > hot) if hot else spread.filter("false"), "common")
    few = held.join(common, "sig", "left_anti") if hot else held
    across = _across(few, reach).join(apart, ["a", "b"], "left_anti")
    links = links.unionByName(verify(stored(across, "across"), rows, sizes))
    return stored(links, "links"), held.join(common, "sig", "left_semi").select("id").distinct()


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
        sets = list(shingle_sets(texts))
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["id", "tokens"]
        )


def prefixes(texts: DataFrame) -> DataFrame:
    """(sig, id, n, most): the rarest shingles of each text that a similar set must share one of.

    ``most`` is the size that a partner may have if this is the first shingle shared.
    """
    tokens = stored(texts.select("id", "text").mapInArrow(_tokens, "id long, tokens array<long>"), "tokens")
    star = stored(stars(tokens.select(F.explode("tokens").alias("sig"), "id")), "shared")
    shared = star.select("sig", F.col("pivot").alias("id")).distinct().unionByName(star.select("sig", "id"))
    often = star.groupBy("sig").agg(F.count("*").alias("often"))
    sizes = tokens.select("id", F.size("tokens").alias("n"))
    common = shared.groupBy("id").agg(F.count("*").alias("common"))
    room = (
        sizes.join(common, "id")
        .withColumn("room", F.expr("n - ceil(0.8D * n - 1e-9D) + 1 - (n - common)"))
        .filter("room > 0")
        .select("id", "n", "room", F.expr("n - common").alias("own"))
    )
    ranked = shared.join(room, "id").join(often, "sig").withColumn(
        "rank", F.row_number().over(Window.partitionBy("id").orderBy("often", "sig"))
    )
    most = F.expr("cast(floor((9 * (n - own - rank + 1) - 4 * n) / 4) as long)")
    return ranked.filter("rank <= room").select("sig", "id", F.col("n").cast("long").alias("n"), most.alias("most"))


def link_documents(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the least id reachable by links, the row's own included.
    """
    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = kind in ("bigint", "int") and not docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").limit(1).count()
    if plain:
        rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))
    else:
        kept = stored(docs.select("doc_id", text_of().alias("text"), F.monotonically_increasing_id().alias("id")), "rows")
        rows = kept.select("id", "text")
    table = stored(
        rows.mapInArrow(_fingerprints, "id long, n long, d1 long, d2 long, rest boolean, sketch binary"), "sets"
    )
    sizes = table.select("id", "n", "sketch")
    worded = table.filter("n > 0")
    firsts = stored(worded.groupBy("d1", "d2").agg(F.min("id").alias("a"), F.count("*").alias("times")).filter("times > 1"), "equal")
    equal = stored(
        worded.select("id", "d1", "d2").join(firsts, ["d1", "d2"]).filter("id != a").select("a", F.col("id").alias("b")), "copies"
    )
    copies = equal.select(F.col("b").alias("id"))
    none = spark.createDataFrame([], "a long, b long")
    links, hot = resolve(signature_stars(rows), none, rows, sizes, copies, HOT)
    over = stored(
        table.filter("rest").select("id").unionByName(hot).distinct().join(copies, "id", "left_anti"), "rest"
    )
    rest_rows = stored(rows.join(broadcast_if_small(over), "id"), "rest")
    rare = stored(prefixes(rest_rows), "rare")
    links, _ = resolve(stars(rare.select("sig", "id")), links, rest_rows, sizes, none.select(F.col("a").alias("id")), None, rare)
    labels = components(links.unionByName(equal))
    out = _labelled(table.select("id", "n"), labels, "id", "component")
    if plain:
        return out.select(F.col("id").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").cast(kind).alias("component_id"))
    named = stored(out.join(kept.select("id", "doc_id"), "id"), "named")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
