"""Connected burnt regions of every scene pair (4-neighbourhood)."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberscope.session import cut_lineage, ship_package

PAIR = ["before_scene", "after_scene"]
# Scene pairs of up to this many runs are labelled in one go, larger ones in rounds.
FEW_RUNS = 10_000


def row_runs(burnt: DataFrame) -> DataFrame:
    """Neighbouring burnt pixels of a pixel row as one run (py, px_from, px_to).

    A run is named by its row and first pixel. Rows of an image have a fixed
    length, so the window partitions are bounded.
    """
    along = Window.partitionBy(*PAIR, "py").orderBy("px")
    return (
        burnt.select(*PAIR, "px", "py")
        .withColumn("island", F.col("px") - F.row_number().over(along))
        .groupBy(*PAIR, "py", "island")
        .agg(
            F.min("px").alias("px_from"),
            F.max("px").alias("px_to"),
            F.count("*").alias("n_pixels"),
        )
        .selectExpr(*PAIR, "py", "px_from", "px_to", "n_pixels", "struct(py, px_from) AS run")
    )


def _touching_runs(runs: DataFrame, block: int = 64) -> DataFrame:
    """Runs of adjacent rows that overlap, both directions.

    Joined per block of columns; an overlap is kept in the block where it starts.
    """
    spread = runs.selectExpr(
        "*", f"explode(sequence(px_from DIV {block}, px_to DIV {block})) AS blk"
    )
    upper = spread.selectExpr(
        *PAIR, "py + 1 AS py", "blk", "run AS u", "px_from AS u_from", "px_to AS u_to"
    )
    down = (
        spread.join(upper, [*PAIR, "py", "blk"])
        .filter(
            "px_from <= u_to AND px_to >= u_from"
            f" AND greatest(px_from, u_from) DIV {block} = blk"
        )
        .select(*PAIR, F.col("run").alias("a"), F.col("u").alias("b"))
    )
    return down.unionByName(down.select(*PAIR, F.col("b").alias("a"), F.col("a").alias("b")))


@F.udf(T.ArrayType(T.IntegerType()))
def _first_runs(runs):
    """Per run the place of the first run of its region; ``runs`` are sorted by row and first pixel."""
    root = list(range(len(runs)))

    def first(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    placed = [i for i, (py, px_from, _) in enumerate(runs) if py is not None and px_from is not None]
    above, py_above = [], None
    for py, row in groupby(placed, key=lambda i: runs[i][0]):
        row, near = list(row), 0
        for i in row if py_above == py - 1 else ():
            _, px_from, px_to = runs[i]
            while near < len(above) and runs[above[near]][2] < px_from:
                near += 1
            k = near
            while k < len(above) and runs[above[k]][1] <= px_to:
                one, two = first(i), first(above[k])
                root[max(one, two)] = min(one, two)
                k += 1
        above, py_above = row, py
    return [first(i) for i in range(len(runs))]


def label_regions(burnt: DataFrame) -> DataFrame:
    """Runs with the region they belong to, named by its first run.

    The runs of a scene pair meet in one row and are labelled there; pairs with more than
    ``FEW_RUNS`` runs go by rounds over all of them.
    """
    ship_package(burnt.sparkSession)
    runs = cut_lineage(row_runs(burnt).filter(" AND ".join(f"{c} IS NOT NULL" for c in PAIR)))
    many = cut_lineage(
        runs.groupBy(*PAIR).agg(F.count("*").alias("n")).filter(F.col("n") > FEW_RUNS).select(*PAIR)
    )
    some = many.limit(1).count() > 0
    few = runs.join(many, PAIR, "left_anti") if some else runs
    listed = few.groupBy(*PAIR).agg(
        F.sort_array(F.collect_list(F.struct("py", "px_from", "px_to", "n_pixels"))).alias("runs")
    )
    labelled = listed.withColumn(
        "firsts", _first_runs(F.expr("transform(runs, r -> struct(r.py, r.px_from, r.px_to))"))
    ).selectExpr(
        *PAIR,
        "inline(zip_with(runs, firsts, (r, i) -> struct(struct(r.py, r.px_from) AS run, r.py, r.px_from, r.px_to,"
        " r.n_pixels, struct(runs[i].py, runs[i].px_from) AS region)))",
    )
    if not some:
        return labelled
    return labelled.unionByName(_label_in_rounds(runs.join(many, PAIR, "left_semi")))


def _label_in_rounds(runs: DataFrame) -> DataFrame:
    """Runs with the region they belong to, for pairs of any size.

    Labels shrink to the smallest neighbour's label and then jump to the label of
    their label, so a long region settles in far fewer rounds than it has rows.
    Rounds end when nothing changes.
    """
    runs = cut_lineage(runs)
    edges = cut_lineage(_touching_runs(runs))
    labels = runs.select(*PAIR, "run", F.col("run").alias("region"))
    while True:
        offers = (
            edges.join(labels.withColumnRenamed("run", "b"), [*PAIR, "b"])
            .groupBy(*PAIR, F.col("a").alias("run"))
            .agg(F.min("region").alias("offer"))
        )
        lowered = labels.join(offers, [*PAIR, "run"], "left").select(
            *PAIR, "run", F.col("region").alias("old"), F.least("region", "offer").alias("region")
        )
        lowered = cut_lineage(lowered)
        jump = lowered.select(*PAIR, F.col("run").alias("region"), F.col("region").alias("next"))
        jumped = cut_lineage(
            lowered.join(jump, [*PAIR, "region"], "left").select(
                *PAIR, "run", "old", F.coalesce("next", "region").alias("region")
            )
        )
        changed = jumped.filter("old != region").limit(1).count()
        labels = jumped.select(*PAIR, "run", "region")
        if not changed:
            return runs.join(labels, [*PAIR, "run"])


def region_summary(burnt: DataFrame) -> DataFrame:
    """One row per region: pixel count and pixel bounds."""
    return (
        label_regions(burnt)
        .groupBy(*PAIR, "region")
        .agg(
            F.sum("n_pixels").alias("n_pixels"),
            F.min("px_from").alias("px_min"),
            F.max("px_to").alias("px_max"),
            F.min("py").alias("py_min"),
            F.max("py").alias("py_max"),
        )
        .drop("region")
    )
