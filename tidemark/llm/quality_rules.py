"""Quality rules: fixed limits, then robust multivariate outliers.

For each language and source the minimum-covariance-determinant estimate describes the bulk
of the documents that pass the limits; those whose transformed statistics lie too far from it
by Mahalanobis distance are rejected. DataFrame operations only.
"""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import all_of, let
from tidemark.session import store

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT = 20  # percent of the words

#: Statistics are whole numbers of 1/GRID, so that their sums do not depend on the order.
GRID = 512
#: Share of a group's different vectors that the determinant is minimised over, and the part
#: by which a concentration step must lower it for another to follow.
COVER, FALL = 0.5, 1e-4
#: Probability of a normal vector to lie in the part that the last estimate is taken from.
INSIDE = 0.975
#: Products of directions are whole numbers of 1/FINE, for the same reason as the statistics.
FINE = 2**20
#: Widths below which differences of the statistics tell nothing. Their squares are added to
#: every covariance's diagonal, so that it is regular for groups of any size, also where most
#: documents have a statistic of zero.
WIDTHS = (0.4, 0.4, 0.06, 0.4, 0.05)
#: Probability with which a normal document would be rejected.
TAIL = 1e-6
#: Distances are ranked in steps of 1/RINGS of a power of e.
RINGS = 32
P = len(WIDTHS)


def _gone(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeat_words(words: Column, n: int) -> Column:
    """Words in windows of ``n`` that occur twice or more, the first time included."""
    def windows(h):
        return F.when(F.size(h) >= n, F.transform(
            F.sequence(F.lit(0), F.size(h) - n),
            lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(n)]),
        )).otherwise(F.array().cast("array<bigint>"))

    def places(s):
        def repeated(x, j):
            near = [F.get(s, j + k)["h"] == x["h"] for k in (-1, 1)]
            return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["p"]))

    def covered(p):
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - x, F.lit(n)))),
            F.lit(0), lambda a, b: a + b,
        )

    def count(g):
        ranked = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
            let(ranked, lambda s: let(places(s), covered)))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), count))


def text_statistics(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_lines and n_repeat_words of a text; a
    null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != "")
    by_word = let(words, lambda w: F.struct(
        F.size(w).alias("n"), _repeat_words(w, WINDOW).alias("repeat")))
    by_line = let(lines, lambda x: F.struct(
        F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    return {
        "_w": by_word, "_l": by_line, "word_chars": F.length(F.translate(text, SPACE, "")).cast("long"),
        "n_symbols": _gone(text, SYMBOLS).cast("long"),
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the statistics, ``base_failed``, the group key and the vector x1 to x5."""
    def label(name):
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))

    raw = docs.select(
        "doc_id", F.concat(label("lang"), F.lit("\x1f"), label("source")).alias("_group"),
        *[c.alias(k) for k, c in text_statistics(F.col("text")).items()],
    ).select(
        "doc_id", "_group", F.col("_w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.col("_l.dup").cast("long").alias("n_dup_lines"), F.col("_l.n").cast("long").alias("n_lines"),
        F.col("_w.repeat").cast("long").alias("n_repeat_words"),
    )
    some = F.greatest("n_words", F.lit(1))
    shape = [
        F.log(1.0 + F.col("n_words")),
        F.col("word_chars") / some,
        F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
        F.log(1.0 + F.col("n_dup_lines")),
        F.col("n_repeat_words") / some,
    ]
    return raw.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")),
    ).withColumns({f"x{k + 1}": F.floor(x * GRID + 0.5).cast("double") for k, x in enumerate(shape)})


def chi_square(x: float, p: int) -> float:
    """The distribution function with ``p`` degrees of freedom."""
    term = total = 1 / math.gamma(p / 2 + 1)
    k = 1
    while term > 1e-17 * total:
        term *= (x / 2) / (p / 2 + k)
        total += term
        k += 1
    return min(1.0, total * math.exp(-x / 2) * (x / 2) ** (p / 2))


def chi_square_point(probability: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, p) < probability else (low, middle)
    return high


XS = [f"x{k + 1}" for k in range(P)]
MEANS = [f"m{k + 1}" for k in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


LOWER = [f"l{i}{j}" for i, j in PAIRS]
ESTIMATE = [*MEANS, *LOWER]
FLOOR = [(w * GRID) ** 2 for w in WIDTHS]


def consistency(share: float) -> float:
    """What the covariance of a normal sample's inner ``share`` is multiplied by."""
    return share / chi_square(chi_square_point(share, P), P + 2)


def _marginals(points: DataFrame) -> DataFrame:
    """For each group the medians m1 to m5, and two widths of each statistic: ``q`` from the
    quartiles, ``a`` from the median deviation, which half of the vectors can't move."""
    def share(counts, value):
        keys = ("_group", "k")
        up_to = Window.partitionBy(*keys).orderBy(value).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return counts.groupBy(*keys, value).agg(F.sum("n").alias("n")).withColumns({
            "_below": F.sum("n").over(up_to), "_all": F.sum("n").over(Window.partitionBy(*keys)),
        })

    def quartile(q, value):
        return F.min(F.when(4 * F.col("_below") >= q * F.col("_all"), F.col(value)))

    long = points.select("_group", F.posexplode(F.array(*XS)).alias("k", "x"))
    counts = store(long.groupBy("_group", "k", "x").agg(F.count(F.lit(1)).alias("n")), "values")
    middles = share(counts, "x").groupBy("_group", "k").agg(
        quartile(2, "x").alias("m"), ((quartile(3, "x") - quartile(1, "x")) / 1.349).alias("q"))
    away = counts.join(middles, ["_group", "k"]).withColumn("x", F.abs(F.col("x") - F.col("m")))
    parts = middles.join(
        share(away, "x").groupBy("_group", "k").agg((quartile(2, "x") / 0.6745).alias("a")), ["_group", "k"])

    def of(k, name, least=None):
        value = F.max(F.when(F.col("k") == k, F.col(name)))
        return value if least is None else F.greatest(value, F.lit(least))

    return parts.groupBy("_group").agg(
        *[of(k, "m").alias(m) for k, m in enumerate(MEANS)],
        *[of(k, name, w * GRID).alias(f"{name}{k}") for name in "qa" for k, w in enumerate(WIDTHS)])


def _starts(points: DataFrame) -> DataFrame:
    """Three estimates of each group to start from, all about the medians: independent
    statistics with widths from the quartiles (0) or the median deviations (1), and the
    covariance of the directions from the medians (2), in which no vector weighs more than
    another however far it lies."""
    own = store(_marginals(points), "marginals")
    square = _sum([_over(k) * _over(k) for k in range(P)])
    directions = points.join(own, "_group").withColumn("_r", square).where("_r > 0").groupBy("_group").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.floor(_over(i) * _over(j) / F.col("_r") * FINE + 0.5)).alias(f"s{i}{j}") for i, j in PAIRS])
    spread = own.join(directions, "_group", "left").withColumns({
        f"c{i}{j}": F.coalesce(
            F.col(f"s{i}{j}") / F.col("n") * (P / FINE) * F.col(f"a{i}") * F.col(f"a{j}"), F.lit(0.0))
        + (FLOOR[i] if i == j else 0.0)
        for i, j in PAIRS})

    def diagonal(name):
        return own.select("_group", *MEANS, *[
            (F.col(f"{name}{i}") if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in PAIRS])

    starts = (diagonal("q"), diagonal("a"), _factor(spread).select("_group", *ESTIMATE))
    return reduce(DataFrame.unionByName, [
        x.withColumns({"_start": F.lit(k), "_det": F.lit(None).cast("double")}) for k, x in enumerate(starts)])


def _over(k: int) -> Column:
    return (F.col(XS[k]) - F.col(MEANS[k])) / F.col(f"a{k}")


def _sum(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def _distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance, by forward substitution with the factor's columns."""
    z: list[Column] = []
    for i in range(P):
        rest = x[i] - F.col(MEANS[i])
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * z[j]
        z.append(rest / F.col(f"l{i}{i}"))
    return _sum([x * x for x in z])


def _factor(spread: DataFrame) -> DataFrame:
    """Adds the lower factor of the covariance c00 to c44, column by column, and ``_new``, the
    covariance's determinant."""
    for j in range(P):
        own = F.col(f"c{j}{j}")
        for k in range(j):
            own = own - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        spread = spread.withColumn(f"l{j}{j}", F.sqrt(F.greatest(own, F.lit(FLOOR[j] * 1e-6))))
        below = {}
        for i in range(j + 1, P):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            below[f"l{i}{j}"] = rest / F.col(f"l{j}{j}")
        if below:
            spread = spread.withColumns(below)
    det = F.lit(1.0)
    for j in range(P):
        det = det * (F.col(f"l{j}{j}") / GRID) * (F.col(f"l{j}{j}") / GRID)
    return spread.withColumn("_new", det)


SUMS = [*XS, *[f"s{i}{j}" for i, j in PAIRS]]


def _moments(near: DataFrame, keys: list[str]) -> DataFrame:
    return near.groupBy(*keys, "_det").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in XS],
        *[F.sum(F.col(XS[i]) * F.col(XS[j])).alias(f"s{i}{j}") for i, j in PAIRS],
    )


def _estimate(sums: DataFrame, grow: float) -> DataFrame:
    """Means, covariance factor and determinant from the sums over ``n`` vectors."""
    n = F.col("n").cast("double")
    means = sums.withColumns({m: F.col(x) / n for m, x in zip(MEANS, XS)})
    return _factor(means.withColumns({
        f"c{i}{j}": grow * (F.col(f"s{i}{j}") / n - F.col(MEANS[i]) * F.col(MEANS[j]))
        + (FLOOR[i] if i == j else 0.0)
        for i, j in PAIRS
    }))


def _step(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step of each group and start: the estimate from its nearest half, the
    determinant before (_det) and after (_new).

    Moments are summed by ring of distance before anything is compared, so a group of any
    size is reduced to a few hundred rows inside the map tasks. The half ends with a ring.
    """
    keys = ["_group", "_start"]
    near = points.join(estimates, "_group").select(
        *keys, "_det", *XS,
        F.floor(F.log(_distance([F.col(x) for x in XS]) + 1e-3) * RINGS).alias("_ring"))
    before = Window.partitionBy(*keys).orderBy("_ring").rowsBetween(Window.unboundedPreceding, -1)
    inner = _moments(near, [*keys, "_ring"]).withColumns({
        "_before": F.coalesce(F.sum("n").over(before), F.lit(0)),
        "_all": F.sum("n").over(Window.partitionBy(*keys)),
    }).where(F.col("_before") < F.ceil(COVER * F.col("_all")))
    total = inner.groupBy(*keys, "_det").agg(*[F.sum(x).alias(x) for x in ("n", *SUMS)])
    return _estimate(total, consistency(COVER)).select(*keys, *ESTIMATE, "_det", "_new")


def minimum_covariance(points: DataFrame) -> DataFrame:
    """_group, means and covariance factor by minimum covariance determinant, of the vectors
    x1 to x5 of each ``_group``.

    From each start, steps follow while the determinant falls; the estimate with the smallest
    one is kept (ties: the earlier start). The mean and covariance of all vectors that lie
    inside it with a probability of ``INSIDE`` are the result.
    """
    found = []
    now = store(_starts(points), "starts")
    while True:
        # Written before it is compared: pushed down, the comparison would repeat the whole factor.
        after = store(_step(points, now), "estimates")
        now = after.where(F.col("_det").isNull() | (F.col("_new") < F.col("_det") * (1 - FALL))).select(
            "_group", "_start", *ESTIMATE, F.col("_new").alias("_det"))
        if now.isEmpty():
            break
        found.append(now)
    if not found:
        return now.select("_group", *ESTIMATE)
    best = reduce(DataFrame.union, found).groupBy("_group").agg(
        F.min_by(F.struct("_det", *ESTIMATE), F.struct("_det", "_start")).alias("_best")
    ).select("_group", "_best.*")
    inside = points.join(best, "_group").where(
        _distance([F.col(x) for x in XS]) <= chi_square_point(INSIDE, P)).select("_group", "_det", *XS)
    return _estimate(_moments(inside, ["_group"]), consistency(INSIDE)).select("_group", *ESTIMATE)


def judge(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """doc_id, the statistics, base_failed, kept and distance (squared) of each row.

    A null or empty text has no words and fails the limits. Null languages and sources are
    groups of their own. A group's estimate rests on the documents that pass the limits, equal
    vectors counted once, so that copies don't shift it however many there are; each row is
    judged. Up to half of the different vectors may lie together anywhere. An empty table gives
    an empty one; other columns are not read.
    """
    rows = store(with_statistics(docs.select("doc_id", "text", "lang", "source")), "statistics")
    points = store(rows.where(~F.col("base_failed")).select("_group", *XS).distinct(), "points")
    estimates = store(minimum_covariance(points), "estimates")
    far = _distance([F.col(x) for x in XS])
    limit = chi_square_point(1 - tail, P)
    return rows.join(estimates, "_group", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        "base_failed",
        all_of([~F.col("base_failed"), F.coalesce(far <= limit, F.lit(True))]).alias("kept"),
        F.when(~F.col("base_failed"), far).alias("distance"),
    )
