"""Line deduplication by winnowing.

Lines with a word are numbered within each document; lines without one are kept and not
counted. Of every window of ``run`` consecutive lines the least line hash (the last such
line) is its fingerprint, so a run of that length that occurs twice has the same
fingerprint at the same place in both. Only windows whose fingerprint occurs at more than
one position are joined, by a 128-bit key of the whole window; matches extend both ways as
the union of the matching windows around them. A window that occurs earlier, in order of
document id and line, is a repeat, and its lines are deleted. The first occurrence of
every run stays. No occurrences are paired with each other: each is compared to the first
by an aggregate, so a passage in a third of all documents costs its own rows only.

Runs of fewer lines are windows too if they hold more than ``words`` words, and so are
whole documents of fewer than ``run`` lines, which are only compared with each other: a
short line that many documents share stays. ``words=None`` leaves both out.

Null text counts as empty. Rows of the same id are told apart by a row number; a null id
comes after all others. Columns named ``n_lines`` and ``n_removed`` are replaced. Texts without a word and an empty table give no windows; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.storage import fresh, placed, stored, text_of
from emberscope.session import broadcast_if_small

RUN = 3
WORDS = 50
_SPACE = r"\\x20\\x09-\\x0D"
_WORD = f"[^{_SPACE}]"


def _windows(rows: DataFrame, run: int, words: int | None) -> DataFrame:
    """(_row, kind, n, at, fingerprint, own, a, b): a row for each window of a document.

    ``kind`` is the number of lines ``n``, or 0 for a whole document. ``own`` marks the first
    window of each fingerprint position, so that positions, not windows, are counted; of
    the windows held against ``words`` each counts, as the first may not be there.
    """
    lines = rows.select(
        "_row", "_order", F.expr(rf"filter(split(_text, '\n', -1), x -> x rlike '{_WORD}')").alias("_lines")
    ).filter(F.size("_lines") >= (run if words is None else 1))
    hashed = lines.withColumn("_hashes", F.expr("transform(_lines, x -> xxhash64(x))"))
    lengths = [run] if words is None else [*range(1, run + 1)]
    if words is not None:
        hashed = hashed.withColumn(
            "_sizes", F.expr(rf"transform(_lines, x -> size(array_remove(split(x, '[{_SPACE}]+'), '')))")
        )
    picked = hashed.withColumns(
        {
            f"_picks{n}": F.expr(
                f"if(size(_hashes) < {n}, array(), transform(sequence(0, size(_hashes) - {n}),"
                f" i -> array_max(transform(sequence(0, {n - 1}),"
                " j -> struct(-(get(_hashes, i + j) div 2) as least, i + j as position))).position))"
            )
            for n in lengths
        }
    )

    def of_length(n: int) -> str:
        own = f"p != get(_picks{n}, i - 1) or i = 0" if n == run else "true"
        every = (
            f"transform(_picks{n}, (p, i) -> struct({n} as kind, {n} as n, i as at, get(_hashes, p) as fingerprint,"
            f" {own} as own, xxhash64(slice(_lines, i + 1, {n})) as a,"
            f" xxhash64('second', slice(_lines, i + 1, {n})) as b))"
        )
        if n == run:
            return every
        size = " + ".join(f"get(_sizes, w.at + {j})" for j in range(n))
        return f"filter({every}, w -> {size} > {words})"

    whole = (
        f"if(size(_lines) < {run}, array(struct(0 as kind, size(_lines) as n, 0 as at, xxhash64(_lines) as fingerprint,"
        " true as own, xxhash64(_lines) as a, xxhash64('second', _lines) as b)), array())"
    )
    kinds = [of_length(n) for n in lengths] + ([] if words is None else [whole])
    return picked.select("_row", "_order", F.inline(F.expr(f"concat({', '.join(kinds)})")))


def repeated_windows(rows: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """(_row, at, n) of the windows that occur earlier; ``rows`` has ``_row, _order, _text``."""
    windows = stored(_windows(rows, run, words), "windows")
    repeated = (
        windows.groupBy("kind", "fingerprint")
        .agg(F.sum(F.col("own").cast("int")).alias("_times"))
        .filter("_times > 1")
        .select("kind", "fingerprint")
    )
    candidates = windows.join(repeated, ["kind", "fingerprint"], "left_semi").select("_row", "_order", "kind", "n", "at", "a", "b")
    candidates = stored(candidates, "candidates")
    first = (
        candidates.groupBy("kind", "a", "b")
        .agg(F.min(F.struct("_order", "_row", "at")).alias("first"), F.count("*").alias("_times"))
        .filter("_times > 1")
        .select("kind", "a", "b", "first")
    )
    return (
        candidates.join(first, ["kind", "a", "b"])
        .filter((F.col("_row") != F.col("first._row")) | (F.col("at") != F.col("first.at")))
        .select("_row", "at", "n")
    )


def drop_repeated_lines(docs: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """``docs`` with repeated runs cut from ``text``, and ``n_lines``, ``n_removed``.

    Only the numbers of deleted lines are gathered, per document, and joined to the texts
    they belong to; as long as those are measured to be few, no other text is moved. Rows are
    told apart by their place in the stored files, which every scan finds the same.
    """
    docs = docs.drop("n_lines", "n_removed")
    at = fresh(docs, "_row")
    rows = placed(docs, at)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    texts = rows.select(F.col(at).alias("_row"), order.alias("_order"), text_of().alias("_text"))
    repeats = stored(repeated_windows(texts, run, words), "repeats")
    gone = repeats.select("_row", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("_line")).distinct()
    touched = broadcast_if_small(stored(repeats.select("_row").distinct(), "touched"))
    cuts = gone.groupBy("_row").agg(F.collect_list("_line").alias("_gone"))
    full = rf"filter(transform(_strings, (x, k) -> if(x rlike '{_WORD}', k, null)), k -> k is not null)"
    cut = (
        texts.join(touched, "_row", "left_semi")
        .join(cuts, "_row")
        .select("_row", "_gone", F.split("_text", "\n", -1).alias("_strings"))
        .select("_row", "_gone", "_strings", F.expr(full).alias("_places"))
        .select(
            "_row",
            F.expr(
                "array_join(transform(array_except(sequence(0, size(_strings) - 1),"
                " transform(_gone, g -> get(_places, g))), k -> get(_strings, k)), '\n')"
            ).alias("text"),
            F.size("_places").cast("long").alias("n_lines"),
            F.size("_gone").cast("long").alias("n_removed"),
        )
    )
    count = F.expr(rf"size(filter(split(coalesce(cast(text as string), ''), '\n', -1), x -> x rlike '{_WORD}'))")
    others = [c for c in docs.columns if c != "text"]
    columns = [*others, "text", "n_lines", "n_removed"]
    touched, cut = touched.withColumnRenamed("_row", at), cut.withColumnRenamed("_row", at)
    whole = rows.join(touched, at, "left_anti").withColumns(
        {"n_lines": count.cast("long"), "n_removed": F.lit(0).cast("long")}
    )
    changed = rows.select(at, *others).join(touched, at, "left_semi").join(cut, at)
    return whole.select(*columns).unionByName(changed.select(*columns))
