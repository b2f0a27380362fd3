"""Quality rules: fixed limits, then robust multivariate outliers.

Statistics of each whole text become a vector of transformed values. For each language and
source, the minimum-covariance-determinant estimate of centre and scatter comes from three
starts side by side (medians with quartiles, plain moments, correlations of squashed
values). In each, the three quarters of documents nearest to the last estimate give the
next one, until the determinant stops falling; the least determinant of all is kept. A document is rejected when its Mahalanobis distance is beyond a bound
that clean documents do not reach.

Null text has no words and fails the fixed limits. Null language or source is a group of
its own. Groups with fewer than ``MIN_GROUP`` documents within the fixed limits take the
estimate of their language, and languages with fewer that of all documents, with word
lengths taken from the language's median. If all documents are fewer, the bound grows by
the F distribution, and up to six have none. Repeated rows count as often as they appear; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberscope.llm.storage import stored, text_of
from emberscope.session import broadcast_if_small

# Documents a group needs for its own estimate of 5 centres and 15 covariances.
MIN_GROUP = 50
KEPT_SHARE = 0.75
# Steps go on while the logarithm of the determinant falls by more than this.
FALL = 0.01
# Quantiles are exact over bins of fixed width, so they do not depend on the order of rows.
VALUE_BINS, DISTANCE_BINS = 1000, 100
# The bound on the squared distance is the chi-squared quantile that one clean document in
# so many would pass.
ONE_IN = 1e9
GROUPS_MAX = 20_000
# The vector, with the least standard deviation each value is taken to have: most
# documents have no symbols or repeats at all, and a spread of zero would reject the rest.
VECTOR = {
    "x_words": ("ln(1 + n_words)", 0.3),
    "x_length": ("ln(word_chars / n_words)", 0.1),
    "x_symbols": ("ln(1 + 10 * n_symbols / n_words)", 0.1),
    "x_lines": ("n_dup_lines / n_lines", 0.08),
    "x_repeats": ("n_repeat_words / n_words", 0.08),
}
GROUP = ("_lang", "_source")


def _chi2_cdf(x: float, d: int) -> float:
    a, z = d / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= z / n
        total += term
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(p: float, d: int) -> float:
    low, high = 1e-9, 500.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, d) < p else (low, mid)
    return low


def _f_tail(x: float, d1: int, d2: int) -> float:
    a, b = d2 / 2, d1 / 2
    y = d2 / (d2 + d1 * x)
    term, total, n = 1.0, 1 / a, 0
    while abs(term) > 1e-17:
        n += 1
        term *= (n - b) / n * y
        total += term / (a + n)
    return total * math.exp(a * math.log(y) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))


def distance_bound(n: int, d: int) -> float:
    """The bound for an estimate from ``n`` documents; of few, only larger distances tell."""
    if n >= MIN_GROUP:
        return chi2_quantile(1 - 1 / ONE_IN, d)
    h = math.ceil(KEPT_SHARE * n)
    if h <= d:
        return math.inf
    low, high = 1.0, 1e60
    for _ in range(300):
        mid = math.sqrt(low * high)
        low, high = (mid, high) if _f_tail(mid, d, h - d) > 1 / ONE_IN else (low, mid)
    return low * d * (h * h - 1) / (h * (h - d))


def statistics(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Per row: ``doc_id, lang, source, row`` and the counts, from DataFrame functions alone.

    ``row`` names a column that tells the rows apart; by default they are numbered.

    Repeated three-word windows are found by hash: their hashes are sorted with their
    positions, and equal neighbours mark the words they cover. Only texts in which some
    hash occurs twice are sorted.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    base = docs.select("doc_id", "lang", "source", number.alias("row"), text_of().alias("_text"))
    split = base.select(
        "doc_id", "lang", "source", "row",
        F.expr(r"array_remove(split(_text, '[\\x20\\x09-\\x0D]+'), '')").alias("_words"),
        F.expr(r"filter(split(_text, '\n', -1), x -> x rlike '[^\\x20\\x09-\\x0D]')").alias("_lines"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    grams = split.select(
        "doc_id", "lang", "source", "row", "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "if(size(_words) < 3, array(), transform(sequence(0, size(_words) - 3),"
            " i -> xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2))))"
        ).alias("_grams"),
    )
    ordered = grams.withColumn(
        "_sorted",
        F.expr(
            "if(size(array_distinct(_grams)) = size(_grams), null,"
            " sort_array(transform(_grams, (h, i) -> struct(h as h, i as i))))"
        ),
    )
    covered = F.expr(
        "if(_sorted is null, 0, size(array_distinct(flatten(transform("
        "filter(_sorted, (x, k) -> x.h <=> get(_sorted, k - 1).h or x.h <=> get(_sorted, k + 1).h),"
        " x -> array(x.i, x.i + 1, x.i + 2))))))"
    )
    return ordered.select(
        "doc_id", "lang", "source", "row", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        covered.cast("long").alias("n_repeat_words"),
    )


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance by forward substitution with the joined factor."""
    d, y = len(names), []
    total = F.lit(0.0)
    for i in range(d):
        value = F.col(names[i]) - F.col(f"_m{i}")
        for k in range(i):
            value = value - F.col(f"_l{i}{k}") * y[k]
        y.append(value / F.col(f"_l{i}{i}"))
        total = total + y[i] * y[i]
    return total


def _bin(x: str) -> Column:
    return F.floor(F.col(x) * VALUE_BINS)


def _middle(quantile: Column) -> Column:
    return (quantile + 0.5) / VALUE_BINS


def _estimates(within: DataFrame, names: list[str], floors: list[float], keys: list[str], least: int) -> DataFrame:
    """The estimate of each group by ``keys`` of at least ``least`` rows.

    Each step has one row per group and start still falling, stored, and broadcast only up to
    ``GROUPS_MAX`` rows; beyond, the join shuffles and skewed groups are split at run time.
    Every step is two aggregations with partial results.
    """
    d = len(names)
    chi = chi2_quantile(KEPT_SHARE, d)
    consistent = KEPT_SHARE / _chi2_cdf(chi, d + 2)
    triangle = [(i, j) for i in range(d) for j in range(i + 1)]
    each = [*keys, "_start"]
    fitted = [*(f"_m{i}" for i in range(d)), *(f"_l{i}{j}" for i, j in triangle)]

    def factor(df: DataFrame, scale: float) -> DataFrame:
        cov = {
            (i, j): F.coalesce(F.col(f"_c{i}{j}"), F.lit(0.0)) * scale + F.lit(floors[i] ** 2 if i == j else 0.0)
            for i, j in triangle
        }
        # One entry of the factor at a time keeps the expressions small.
        low: dict[tuple[int, int], Column] = {}
        for i, j in triangle:
            rest = cov[i, j]
            for k in range(j):
                rest = rest - low[i, k] * low[j, k]
            df = df.withColumn(
                f"_l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / low[j, j]
            )
            low[i, j] = F.col(f"_l{i}{j}")
        det = sum((2.0 * F.log(f"_l{i}{i}") for i in range(d)), F.lit(0.0))
        return df.select(*each, det.alias("_det"), *fitted)

    usual = within.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        *(F.percentile(_bin(x), [0.25, 0.5, 0.75]).alias(f"_q{i}") for i, x in enumerate(names)),
    )
    usual = usual.filter(F.col("_n") >= least).select(
        *keys,
        *(_middle(F.col(f"_q{i}")[1]).alias(f"_mid{i}") for i in range(d)),
        *(((F.col(f"_q{i}")[2] - F.col(f"_q{i}")[0]) / VALUE_BINS / 1.349).alias(f"_s{i}") for i in range(d)),
    )
    usual = stored(usual, "medians")
    seen = within.select(*keys, *names).join(broadcast_if_small(usual, GROUPS_MAX), keys)
    # Far values count little once squashed; the least spread keeps the quotient finite.
    squashed = [F.tanh((F.col(x) - F.col(f"_mid{i}")) / F.greatest(F.col(f"_s{i}"), F.lit(floors[i]))) for i, x in enumerate(names)]
    seen = seen.select(*seen.columns, *(t.alias(f"_t{i}") for i, t in enumerate(squashed)))
    plain = seen.groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in usual.columns if c not in keys),
        *(F.avg(x).alias(f"_avg{i}") for i, x in enumerate(names)),
        *(F.covar_pop(names[i], names[j]).alias(f"_p{i}{j}") for i, j in triangle),
        *(F.covar_pop(f"_t{i}", f"_t{j}").alias(f"_r{i}{j}") for i, j in triangle),
    )

    def related(i: int, j: int) -> Column:
        spread = F.sqrt(F.col(f"_r{i}{i}") * F.col(f"_r{j}{j}"))
        return F.when(spread > 0, F.col(f"_r{i}{j}") / spread * F.col(f"_s{i}") * F.col(f"_s{j}")).otherwise(0.0)

    def start(centre: str, cov) -> Column:
        return F.struct(
            *(F.col(f"{centre}{i}").alias(f"_m{i}") for i in range(d)), *(cov(i, j).alias(f"_c{i}{j}") for i, j in triangle)
        )

    starts = F.array(
        start("_mid", lambda i, j: F.pow(f"_s{i}", F.lit(2.0)) if i == j else F.lit(0.0)),
        start("_avg", lambda i, j: F.col(f"_p{i}{j}")),
        start("_mid", lambda i, j: F.pow(f"_s{i}", F.lit(2.0)) if i == j else related(i, j)),
    )
    first = plain.select(*keys, F.posexplode(starts).alias("_start", "_first")).select(*each, "_first.*")
    active = stored(factor(first, 1.0).withColumn("_det", F.lit(math.inf)), "estimate")
    every = []
    while True:
        near = within.select(*keys, *names).join(broadcast_if_small(active, GROUPS_MAX), keys)
        near = near.withColumn("_d", F.floor(F.log(F.greatest(_distance(names), F.lit(1e-9))) * DISTANCE_BINS))
        bound = stored(near.groupBy(*each).agg(F.percentile("_d", KEPT_SHARE).alias("_bound")), "bounds")
        core = near.select(*each, *names, "_d").join(broadcast_if_small(bound, GROUPS_MAX), each).filter("_d <= _bound")
        moments = core.groupBy(*each).agg(
            *(F.avg(x).alias(f"_m{i}") for i, x in enumerate(names)),
            *(F.covar_pop(names[i], names[j]).alias(f"_c{i}{j}") for i, j in triangle),
        )
        found = stored(factor(moments, consistent), "estimate")
        every.append(found)
        falling = found.join(active.select(*each, F.col("_det").alias("_before")), each).filter(
            F.col("_det") < F.col("_before") - FALL
        )
        active = stored(falling.select(*found.columns), "falling")
        if active.isEmpty():
            break
    tried = every[0]
    for more in every[1:]:
        tried = tried.unionByName(more)
    kept = tried.groupBy(*keys).agg(F.min_by(F.struct(*fitted), F.struct("_det", "_start")).alias("_kept"))
    return stored(kept.select(*keys, "_kept.*"), "estimate")


def robust_distances(vectors: DataFrame, names: list[str], floors: list[float]) -> DataFrame:
    """``vectors`` with ``distance`` and its ``bound``, null in groups without a row within the limits.

    Small groups have the estimate of a coarser key, which is made only if there are any,
    from the rows of their languages or, for small languages, from all rows.
    """
    d = len(names)
    within = vectors.filter(~F.col("base_failed"))
    groups = stored(within.groupBy(*GROUP).agg(F.count("*").alias("_n")), "groups")
    plain = F.lit(distance_bound(MIN_GROUP, d))
    found = _estimates(within, names, floors, list(GROUP), MIN_GROUP).withColumn("bound", plain)
    small = groups.filter(F.col("_n") < MIN_GROUP).select(*GROUP)
    if not small.isEmpty():
        languages = small.select("_lang").distinct()
        by_language = within.join(broadcast_if_small(languages, GROUPS_MAX), "_lang", "left_semi")
        coarse = _estimates(by_language, names, floors, ["_lang"], MIN_GROUP)
        found = found.unionByName(small.join(coarse, "_lang").withColumn("bound", plain))
        small = stored(small.join(coarse, "_lang", "left_anti"), "groups")
    if not small.isEmpty():
        # Words of some languages are longer: only lengths beside the language's own tell.
        i = names.index("x_length")
        usual = stored(within.groupBy("_lang").agg(_middle(F.percentile(_bin("x_length"), 0.5)).alias("_usual")), "lengths")
        shifted = within.join(broadcast_if_small(usual, GROUPS_MAX), "_lang").select(
            F.lit(0).alias("_all"), *(F.col(x) - F.col("_usual") if x == "x_length" else F.col(x) for x in names)
        ).toDF("_all", *names)
        every = _estimates(stored(shifted, "shifted"), names, floors, ["_all"], 1).drop("_all")
        n = groups.agg(F.sum("_n")).first()[0]
        last = small.join(usual, "_lang").crossJoin(F.broadcast(every)).withColumn(f"_m{i}", F.col(f"_m{i}") + F.col("_usual"))
        found = found.unionByName(last.drop("_usual").withColumn("bound", F.lit(distance_bound(n, d))))
    found = stored(found, "estimates")
    joined = vectors.join(broadcast_if_small(found, GROUPS_MAX), list(GROUP), "left")
    return joined.withColumn("distance", _distance(names)).select(*vectors.columns, "distance", "bound")


def judge(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Per row: the statistics, ``base_failed``, ``distance`` and ``kept``."""
    counts = statistics(docs, row).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    vectors = counts.select(
        *counts.columns,
        *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(f"_{c}") for c in ("lang", "source")),
        *(
            F.when(F.col("n_words") > 0, F.expr(formula)).otherwise(0.0).cast("double").alias(x)
            for x, (formula, _) in VECTOR.items()
        ),
    )
    judged = robust_distances(stored(vectors, "statistics"), list(VECTOR), [f for _, f in VECTOR.values()])
    far = F.coalesce(F.col("distance") > F.col("bound"), F.lit(False))
    return judged.select(*counts.columns, "distance", (~F.col("base_failed") & ~far).alias("kept"))
