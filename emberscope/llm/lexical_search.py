"""Ranked lexical search without random access: impact-sorted lists read from the top.

One pass over the documents keeps, per document, its length and the counts of the terms
that some query asks for, in a stored table. Document frequencies and the two totals are
aggregated from that table. A second pass takes the stored rows in blocks of ``BLOCK_DOCS``
documents: in a block the postings of every term are sorted by what they add to a score,
and each query reads its lists from the top, all in step. A document read so far has a
lower bound, the sum of what was read for it, and an upper bound, which adds the next
unread entry of every list it has not been met in. Reading ends when no unread document
can reach the ``k``-th lower bound, nor any read one below it, and the bounds of all others
have met; equal scores are then known to be equal. Blocks return at most ``k`` rows a
query, which one ranking merges.

``floors`` come from the first stored rows: the ``k``-th score of any documents is a
lower bound of the ``k``-th score of all, so later blocks stop sooner. They change no
result.

Odd input: null text and text without a term hold no term, count nowhere and are never
found. Every row is a document of its own, so rows sharing an id, or without one, are all
ranked; equal scores go by id (null last), then by place in the stored table. A query
without terms, or with none that a document holds, has no rows. Queries sharing an id are
told apart. Very long texts are read whole, one at a time. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.llm.storage import stored, text_of
from emberscope.session import ship_package

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(TERM)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bounds; none changes a result.
BLOCK_DOCS = 16_384  # documents, and
BLOCK_POSTINGS = 2_000_000  # postings whose lists are sorted at once
VOCABULARY_MAX = 500_000  # query terms sent to every task; beyond, all terms are kept
QUERY_TERMS_MAX = 500_000  # terms of the queries answered in one pass
FIRST_READ = 64  # entries of a list in the first step; each step reads twice as many


def terms_of(text: str) -> list[str]:
    return _TERM.findall(text.encode().lower().decode())


def query_terms(queries: DataFrame, query_id: str = "item_id", text: str = "text") -> DataFrame:
    """query (number), the id, and the distinct terms of every query; one row each."""
    lowered = F.translate(text_of(text), _UPPER, _LOWER)
    found = F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"({TERM})"), F.lit(1)))
    numbered = queries.select(F.col(query_id).alias("query_id"), found.alias("terms"))
    return numbered.withColumn("query", F.monotonically_increasing_id())


def term_counts(docs: DataFrame, wanted: set[str] | None) -> DataFrame:
    """doc_id, n (terms with repeats) and the counts of the wanted terms, a row per document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = shared.value
        for batch in batches:
            ids, sizes, terms, counts, ends = batch.column(0), [], [], [], [0]
            for text in batch.column(1):
                found = terms_of(text.as_py())
                sizes.append(len(found))
                held = Counter(found if keep is None else filter(keep.__contains__, found))
                terms.extend(held.keys())
                counts.extend(held.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.string())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    ship_package(spark)
    counted = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(
        count, "doc_id long, n long, terms array<string>, counts array<long>"
    )
    return counted.filter("n > 0").withColumn("row", F.monotonically_increasing_id())


def read_lists(
    lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, floor: int
) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block that can be among the best ``k``, with their scores.

    Each list has places of documents and what they add, largest first. All documents
    whose score equals that of the ``k``-th are returned, so that ties can be settled.
    """
    lower = np.zeros(size, np.int64)
    met = np.zeros(size, bool)
    read = [0] * len(lists)
    heads = [int(adds[0]) for _, adds in lists]
    step = FIRST_READ
    while True:
        for i, (places, adds) in enumerate(lists):
            a, b = read[i], min(read[i] + step, len(places))
            if a == b:
                continue
            lower[places[a:b]] += adds[a:b]
            met[places[a:b]] = True
            read[i], heads[i] = b, int(adds[b]) if b < len(places) else 0
        step *= 2
        reach = sum(heads)  # what a document in none of the parts read can still have
        seen = np.flatnonzero(met)
        bar = max(floor, 1)
        if len(seen) >= k:
            bar = max(bar, int(np.partition(lower[seen], len(seen) - k)[len(seen) - k]))
        if reach >= bar:
            continue
        to_come = np.full(size, reach, np.int64)
        for i, (places, _) in enumerate(lists):
            if heads[i]:
                to_come[places[: read[i]]] -= heads[i]
        able = seen[lower[seen] + to_come[seen] >= bar]
        if not to_come[able].any():
            return able, lower[able]


def search_block(
    ids: np.ndarray, rows: np.ndarray, places: np.ndarray, terms: np.ndarray, adds: np.ndarray,
    queries: list[np.ndarray], floors: dict[int, int], k: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, places, scores) of the best documents of a block; at most ``k`` a query.

    ``terms`` are numbers; ``queries`` have the numbers of theirs. ``ids`` hold the largest
    number where an id is null.
    """
    order = np.lexsort((-adds, terms))
    places, terms, adds = places[order], terms[order], adds[order]
    cut = np.flatnonzero(np.diff(terms, prepend=-1)) if len(terms) else np.zeros(0, np.int64)
    start = dict(zip(terms[cut].tolist(), cut.tolist()))
    end = dict(zip(terms[cut].tolist(), [*cut[1:].tolist(), len(terms)]))
    for q, wanted in enumerate(queries):
        lists = [(places[start[t] : end[t]], adds[start[t] : end[t]]) for t in wanted.tolist() if t in start]
        if not lists:
            continue
        found, scores = read_lists(lists, len(ids), k, floors.get(q, 0))
        best = np.lexsort((rows[found], ids[found], -scores))[:k]
        best = best[scores[best] > 0]
        if len(best):
            yield q, found[best], scores[best]


def _weights(counted: DataFrame) -> tuple[DataFrame, int, int]:
    """term and weight, and the two totals."""
    n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").count()
    weight = F.floor(1000 * F.ln((2.0 * n_docs + 2.0) / (2.0 * F.col("count") + 1.0)))
    return df.select("term", weight.cast("long").alias("weight")), n_docs, n_terms


def _passes(terms: DataFrame) -> Iterator[list]:
    """Queries with their terms and weights, ``QUERY_TERMS_MAX`` terms at a time."""
    held, size = [], 0
    for q in terms.toLocalIterator():
        held.append(q)
        size += len(q["weighted"])
        if size >= QUERY_TERMS_MAX:
            yield held
            held, size = [], 0
    if held:
        yield held


def _answer(counted: DataFrame, queries: list, n_docs: int, n_terms: int, k: int, floors: dict[int, int]) -> DataFrame:
    """query, doc_id, row and score: the best ``k`` of every block for every query."""
    spark = counted.sparkSession
    number: dict[str, int] = {}
    wanted = [np.array([number.setdefault(w["term"], len(number)) for w in q["weighted"]], np.int64) for q in queries]
    weight = np.zeros(len(number), np.int64)
    for q in queries:
        for w in q["weighted"]:
            weight[number[w["term"]]] = w["weight"]
    shared = spark.sparkContext.broadcast((number, weight, wanted, floors))
    schema = "place int, doc_id long, row long, score long"

    def block(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, weight, wanted, floors = shared.value
        table = pa.Table.from_batches(batches).combine_chunks()
        ids = table["doc_id"].to_numpy(zero_copy_only=False) if not table["doc_id"].null_count else None
        if ids is None:
            ids = table["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
        rows, sizes = table["row"].to_numpy(), table["n"].to_numpy()
        listed = table["terms"].combine_chunks()
        names = listed.flatten().dictionary_encode()
        codes = np.array([number.get(t, -1) for t in names.dictionary.to_pylist()], np.int64)
        terms = codes[names.indices.to_numpy()] if len(codes) else np.zeros(0, np.int64)
        counts = table["counts"].combine_chunks().flatten().to_numpy()
        places = np.repeat(np.arange(len(ids)), np.diff(listed.offsets.to_numpy()))
        m = _lengths(sizes, n_docs, n_terms)
        asked = terms >= 0
        asked[asked] = weight[terms[asked]] > 0
        places, terms, counts = places[asked], terms[asked], counts[asked]
        adds = weight[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * m[places]))
        nulls = table["doc_id"].is_null().to_numpy()
        for q, found, scores in search_block(ids, rows, places, terms, adds, wanted, floors, k):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), q, np.int32)),
                    pa.array(ids[found], mask=nulls[found]),
                    pa.array(rows[found]),
                    pa.array(scores),
                ],
                ["place", "doc_id", "row", "score"],
            )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, postings = [], 0, 0
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                held.append(part)
                docs += len(part)
                postings += len(part.column(3).flatten())
                if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield from block(held)
                    held, docs, postings = [], 0, 0
        if held:
            yield from block(held)

    return counted.select("doc_id", "row", "n", "terms", "counts").mapInArrow(answer, schema)


def _lengths(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``100 - 50 + 50 * n * N div L``; beyond 64 bits on the way with Python's integers."""
    if len(sizes) and 50 * int(sizes.max()) * n_docs >= 1 << 63:
        return np.array([100 - 50 + 50 * n * n_docs // n_terms for n in sizes.tolist()], np.int64)
    return 100 - 50 + 50 * sizes * n_docs // n_terms


def _floors(counted: DataFrame, queries: list, n_docs: int, n_terms: int, k: int) -> dict[int, int]:
    """The ``k``-th score over the first rows of the first stored part, where it has so many."""
    block = counted.filter(F.col("row") < BLOCK_DOCS)
    found = _answer(block, queries, n_docs, n_terms, k, {})
    kth = _ranked(found, k).filter(F.col("rank") == k).select("place", "score")
    return {r["place"]: r["score"] for r in kth.toLocalIterator()}


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 50, query_id: str = "item_id") -> DataFrame:
    """query id, rank, doc_id and score of the ``k`` best documents of every query.

    The queries are answered in passes of ``QUERY_TERMS_MAX`` terms, each against all
    documents; the passes are stored one after the other.
    """
    spark = docs.sparkSession
    asked = stored(query_terms(queries, query_id), "queries")
    vocabulary = asked.select(F.explode("terms").alias("term")).distinct()
    few = vocabulary.limit(VOCABULARY_MAX + 1).count() <= VOCABULARY_MAX
    wanted = {r[0] for r in vocabulary.toLocalIterator()} if few else None
    counted = stored(term_counts(docs, wanted), "term-counts")
    weights, n_docs, n_terms = _weights(counted)
    exploded = asked.select("query", "query_id", F.explode("terms").alias("term"))
    weighted = exploded.join(weights, "term").groupBy("query", "query_id").agg(
        F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("weighted")
    )
    out = None
    for batch in _passes(stored(weighted.orderBy("query"), "weighted")):
        floors = _floors(counted, batch, n_docs, n_terms, k)
        ranked = _ranked(_answer(counted, batch, n_docs, n_terms, k, floors), k)
        names = spark.createDataFrame(
            [(i, q["query_id"]) for i, q in enumerate(batch)], f"place int, {query_id} {_type(queries, query_id)}"
        )
        done = ranked.join(F.broadcast(names), "place").select(query_id, "rank", "doc_id", "score")
        done = stored(done, "ranked")
        out = done if out is None else out.unionByName(done)
    if out is None:
        out = spark.createDataFrame([], f"{query_id} {_type(queries, query_id)}, rank int, doc_id long, score long")
    return out


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
