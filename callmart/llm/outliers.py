"""Quality rules with robust multivariate outliers, in DataFrame functions only.

A text's statistics come from array functions over its own words and lines, so a text never leaves its row. The
transformed statistics of rows that pass the base rules form one cloud of points for each language and source; small groups are
put together by language, and what is still small is measured by the cloud of all rows.
Of each cloud the minimum covariance determinant is sought: the half of its points whose covariance has the
smallest determinant. Several starts are concentrated: distances from the current centre are taken, the
nearer half gives the next centre and covariance. Determinants can only fall. The best start's
estimate gives each row's Mahalanobis distance, and rows beyond the cut are rejected.

Each step is two grouped sums over the narrow statistics, combined inside each task, so a group of any size
is one row for a task; estimates of all groups are one row for a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import SPACES
from callmart.session import stage

#: Passing rows of a group below which it shares an estimate: six rows for each statistic, half of which make it.
SMALL_GROUP = 30
#: Most groups whose estimates, 22 numbers each, are sent to all tasks; more are joined by group.
SENT_GROUPS = 50_000
#: Concentration steps.
STEPS = 5
#: Distance beyond which a row is rejected: the point that one row in a million of a normal cloud lies beyond, of a chi
#: with five degrees of freedom. Ordinary texts have heavier tails, so more of them are rejected.
CUT = 5.99
#: Least variance of each transformed statistic: differences below its root are never remarkable.
FLOOR = 0.04**2
#: Half of n rows are the narrower the fewer they are, and distances from them the larger: 1 + 30 / n times at the thousandth part of
#: a normal cloud of five statistics, within 4 % from 45 rows on (simulated; 16 % more at 30 rows).
FEW = 30
#: Accuracy of the distance that half the rows keep within: one part in so many of the rows.
ACCURACY = 2_000

SYMBOLS = "#*$%&|<>"
FEATURES = ["f_words", "f_chars", "f_symbols", "f_lines", "f_repeats"]


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words inside a window of three words that stands in the array at least twice.

    Windows are sorted by hash, place by place; those equal to a neighbour are taken out, and their places, in order,
    cover three words each less what they share.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
        ),
    )

    def places(s: Column) -> Column:
        same = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
        return F.array_sort(F.transform(F.filter(s, lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            p,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("end")),
            lambda a, x: F.struct(
                (a["n"] + F.least(F.lit(3), x - a["end"])).alias("n"), x.alias("end")
            ),
        )["n"]

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        let(let(F.array_sort(windows), places), covered)
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the statistics of every whole text; those of a missing text are 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spaces = "[\\x20\\x09-\\x0D]+"
    has_word = lambda x: F.length(F.translate(x, SPACES, "")) > 0
    words = F.filter(F.split(text, spaces), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), has_word)
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        let(lines, lambda x: F.size(x).cast("long")).alias("n_lines"),
        let(
            words,
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words")),
        ).alias("w"),
    )
    return found.select(
        "doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", "n_lines"
    )


def _features(stats: DataFrame) -> DataFrame:
    """Ratios on scales where an ordinary group is a compact cloud; 0 where there are no words."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return stats.select(
        "*",
        F.log1p(F.col("n_words").cast("double")).alias("f_words"),
        F.log1p(F.col("word_chars") / words).alias("f_chars"),
        F.log1p(F.col("n_symbols") / words).alias("f_symbols"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("f_lines"),
        (F.col("n_repeat_words") / words).alias("f_repeats"),
    )


def _moments(points: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and covariance of each group, the latter with its floor."""
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.avg(a).alias(f"m{i}") for i, a in enumerate(FEATURES)]
    sums += [
        F.avg(F.col(a) * F.col(b)).alias(f"q{i}{j}")
        for i, a in enumerate(FEATURES)
        for j, b in enumerate(FEATURES)
        if j <= i
    ]
    found = points.groupBy(*keys).agg(*sums)
    d = range(len(FEATURES))
    return found.select(
        *keys,
        "n",
        *[f"m{i}" for i in d],
        *[
            (F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + (FLOOR if i == j else 0.0)).alias(f"c{i}{j}")
            for i in d
            for j in d
            if j <= i
        ],
    )


def _triangle(moments: DataFrame, keys: list[str]) -> DataFrame:
    """The lower triangular root of each covariance and the logarithm of its determinant."""
    d = len(FEATURES)
    out = moments
    for j in range(d):
        left = reduce(lambda a, k: a - F.col(f"l{j}{k}") ** 2, range(j), F.col(f"c{j}{j}"))
        # Rounding cannot take a variance below its floor.
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(left, F.lit(FLOOR / 2))))
        for i in range(j + 1, d):
            left = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}"))
            out = out.withColumn(f"l{i}{j}", left / F.col(f"l{j}{j}"))
    logs = reduce(Column.__add__, [2 * F.log(f"l{j}{j}") for j in range(d)])
    kept = [f"m{i}" for i in range(d)] + [f"l{i}{j}" for i in range(d) for j in range(i + 1)]
    return out.select(*keys, "n", *kept, logs.alias("logdet"))


def _distance(rows: DataFrame) -> DataFrame:
    """The Mahalanobis distance of each row from the estimate beside it."""
    out = rows
    for i, f in enumerate(FEATURES):
        left = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"y{k}"), range(i), F.col(f) - F.col(f"m{i}"))
        out = out.withColumn(f"y{i}", left / F.col(f"l{i}{i}"))
    return out.withColumn("distance", F.sqrt(reduce(Column.__add__, [F.col(f"y{i}") ** 2 for i in range(len(FEATURES))])))


def _beside(rows: DataFrame, table: DataFrame, groups: int | None) -> DataFrame:
    """``rows`` with their group's row of ``table``, where no task gets all rows of a group if the number of groups is known to be small."""
    sent = groups is not None and groups <= SENT_GROUPS
    return rows.join(F.broadcast(table) if sent else table, "grp")


def covariance_estimates(points: DataFrame, steps: int = STEPS, groups: int | None = None) -> DataFrame:
    """One row for each ``grp`` of ``points``: centre, root of the covariance and determinant of the best half.

    Starts: the half nearest to the medians, each statistic measured by its median deviation; and the halves
    nearest to the centres of two random quarters. All are taken along at once, as groups of their own. ``groups`` is their number, if
    it is known.
    """
    medians = points.groupBy("grp").agg(*[F.percentile_approx(f, 0.5, ACCURACY).alias(f"m{i}") for i, f in enumerate(FEATURES)])
    away = _beside(points, medians, groups)
    spread = away.groupBy("grp").agg(
        *[F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5, ACCURACY).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    )
    d = range(len(FEATURES))
    first = medians.join(spread, "grp").select(
        "grp",
        F.lit(0).alias("start"),
        F.lit(0).cast("long").alias("n"),
        *[f"m{i}" for i in d],
        *[
            (F.sqrt(F.lit(FLOOR) + (1.4826 * F.col(f"s{i}")) ** 2) if i == j else F.lit(0.0)).alias(f"l{i}{j}")
            for i in d
            for j in range(i + 1)
        ],
        F.lit(0.0).alias("logdet"),
    )
    quarter = F.pmod(F.xxhash64("doc_id", *FEATURES), F.lit(4))
    chance = points.withColumn("start", (quarter + 1).cast("int")).where("start <= 2")
    estimate = stage(first.unionByName(_triangle(_moments(chance, ["grp", "start"]), ["grp", "start"])), "estimates")
    for _ in range(steps):
        measured = _distance(_beside(points, estimate, groups)).select("grp", "start", *FEATURES, "distance")
        # Half the rows, but never fewer than tie at the nearest distance.
        half = measured.groupBy("grp", "start").agg(F.percentile_approx("distance", 0.5, ACCURACY).alias("within"))
        sent = groups is not None and groups <= SENT_GROUPS
        nearer = measured.join(F.broadcast(half) if sent else half, ["grp", "start"]).where("distance <= within")
        estimate = stage(_triangle(_moments(nearer, ["grp", "start"]), ["grp", "start"]), "estimates")
    best = estimate.groupBy("grp").agg(F.min(F.struct("logdet", "start")).alias("best"))
    return estimate.join(best.select("grp", F.col("best.start").alias("start")), ["grp", "start"])


def judge(docs: DataFrame, cut: float = CUT, steps: int = STEPS, small_group: int = SMALL_GROUP) -> DataFrame:
    """Statistics of every row, base_failed, distance and kept.

    base_failed: fewer than 50 words, or over half the words in repeated windows of three. Of the rest, kept says that
    the row's distance is at most ``cut``. A covariance of the nearer half is smaller than that of all rows, so distances
    are divided by the median distance of their group over the median of a chi with as many degrees, and by what a small group adds.
    Missing languages and sources are values of their own. A group of fewer than ``small_group`` passing rows is put together with
    the other small groups of its language; if these are still fewer, its rows are measured by the estimate of all passing rows,
    however few there are. Rows without doc_id and repeated rows are judged like others; empty tables give empty results.
    """
    stats = _features(statistics(docs))
    stats = stats.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    stats = stage(stats, "statistics")
    name = F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in ("lang", "source")])
    passing = stats.where("not base_failed").withColumn("own", name)
    sizes = stage(passing.groupBy("lang", "own").count(), "sizes")
    spoken = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    small = sizes.where(F.col("count") < small_group)
    enough = small.groupBy(spoken.alias("spoken")).agg(F.sum("count").alias("together")).where(F.col("together") >= small_group)
    placed = sizes.join(enough, spoken == F.col("spoken"), "left")
    grp = F.when(F.col("count") >= small_group, F.concat(F.lit("own/"), "own"))
    grp = grp.when(F.col("spoken").isNotNull(), F.concat(F.lit("lang/"), "spoken")).otherwise(F.lit("all"))
    groups = stage(placed.select("own", grp.alias("grp")), "groups")
    n, left_over = groups.agg(F.count(F.lit(1)), F.count_if(F.col("grp") == "all")).first()
    sent = n + 1 <= SENT_GROUPS
    names = F.broadcast(groups) if sent else groups
    points = passing.join(names, "own").where("grp <> 'all'").select("doc_id", "grp", *FEATURES)
    if left_over:
        # What is left is measured by everything.
        points = points.unionByName(passing.select("doc_id", F.lit("all").alias("grp"), *FEATURES))
    points = stage(points, "points")
    estimates = stage(covariance_estimates(points, steps, n + 1), "estimates")
    # The median of a chi distribution with five degrees of freedom.
    median = F.greatest(F.percentile_approx("distance", 0.5, ACCURACY) / 2.086, F.lit(1.0))
    middle = _distance(_beside(points, estimates, n + 1)).groupBy("grp").agg((median * (1 + FEW / F.count(F.lit(1)))).alias("scale"))
    known = stage(groups.join(estimates.join(middle, "grp"), "grp").drop("grp", "n", "start", "logdet"), "known")
    rows = stats.withColumn("own_name", name)
    rows = rows.join(F.broadcast(known) if sent else known, F.col("own_name") == F.col("own"), "left")
    distance = F.when(~F.col("base_failed"), F.col("distance") / F.col("scale"))
    return _distance(rows).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(distance <= cut, F.lit(False))).alias("kept"),
        distance.alias("distance"),
    )
