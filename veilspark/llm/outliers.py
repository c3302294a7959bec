"""Quality rules by robust multivariate outliers (operator 9), DataFrame functions only.

Each text gives a few counts.  Base rules reject texts that are short or mostly
repeat themselves.  The counts of the others become a vector (:data:`VECTOR`,
logarithms of rates), and per language and source a minimum-covariance-
determinant estimate says what is usual there: the mean and covariance of the
``share`` of vectors whose covariance has the smallest determinant, found by
concentration steps (keep the nearest ``share`` of the group, estimate anew)
from two deterministic starts, one from medians and median deviations alone and
one that adds the correlations of values cut at two deviations.  A vector is
rejected if its squared Mahalanobis distance, scaled so that the group's median
fits the chi-square law, exceeds that law's quantile ``1 - tail``.

One pass over the texts writes the counts to the shared folder; every step
after that is an aggregation of those narrow rows by group with partial sums
on the map side, so a source with a third of all rows is no single task.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Name, expression over the counts, and the least standard deviation that an estimate may have.
VECTOR = [
    ("length", "ln(n_words)", 0.25),
    ("word_length", "ln(word_chars / n_words)", 0.05),
    ("symbols", "ln(1 + 100 * n_symbols / n_words)", 0.5),
    ("dup_lines", "ln(1 + 100 * n_dup_lines / __lines)", 1.2),
    ("repeats", "ln(1 + 100 * n_repeat_words / n_words)", 1.0),
    ("capitals", "ln(1 + 100 * __capitals / word_chars)", 0.3),
]
P = len(VECTOR)
X = [f"__x{i}" for i in range(P)]
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def chi_square_quantile(p: float, n: int) -> float:
    """Wilson and Hilferty's approximation."""
    return n * (1 - 2 / (9 * n) + NormalDist().inv_cdf(p) * (2 / (9 * n)) ** 0.5) ** 3


def count_words(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with :data:`COUNTS`, ``__lines`` (lines with a word) and ``__capitals`` of each whole text (null: none).

    Each step is a column of its own because lambdas may refer to columns
    only, else what they refer to is computed for every element.  Windows of
    three words are compared by a 64-bit hash of the words in their order.
    """
    n = F.size("__w")
    empty = F.array().cast("array<bigint>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn("__t", F.btrim(text, F.lit(" \t\n\x0b\f\r")))
    df = df.withColumn("__w", F.when(F.col("__t") != "", F.split("__t", SPACE)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("__l", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("__h", F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))).otherwise(empty))
    # Only texts with a window twice need the places: windows sorted by hash, those with an equal neighbour, by place.
    df = df.withColumn("__s", F.when(
        F.size(F.array_distinct("__h")) < F.size("__h"),
        F.array_sort(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
    df = df.withColumn("__p", F.array_sort(F.transform(
        F.filter("__s", lambda x, i: (F.get("__s", i - 1)["h"].eqNullSafe(x["h"]))
                 | (F.get("__s", i + 1)["h"].eqNullSafe(x["h"]))), lambda x: x["p"])))
    covered = F.aggregate(
        "__p", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")))["n"]
    return df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.char_length(F.array_join("__w", "")).cast("long"),
        "n_symbols": F.regexp_count("__t", F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "__lines": F.size("__l"),
        "__capitals": F.regexp_count("__t", F.lit("[A-Z]")),
    }).drop("__t", "__w", "__l", "__h", "__s", "__p")


def _estimate(rows: DataFrame, by: list[str], center: str, spread: str) -> DataFrame:
    """Per group: means ``m0..`` and the lower Cholesky factor ``c00..`` of the covariance, and ``logdet``;
    for rows that were joined to an estimate before, its ``logdet`` as ``was``.

    The variances get the least ones of VECTOR added where they fall short, so
    a count that never varies in a group leaves the factor defined.
    """
    before = [F.first("logdet").alias("was")] if "logdet" in rows.columns else []
    moments = rows.groupBy(*by).agg(
        *before,
        *[F.expr(center.format(x)).alias(f"m{i}") for i, x in enumerate(X)],
        *[F.expr(spread.format(X[i], X[j], i == j)).alias(f"s{i}{j}") for i, j in PAIRS])
    return _cholesky(moments, by)


def _cholesky(moments: DataFrame, by: list[str]) -> DataFrame:
    out = moments
    for i, j in PAIRS:
        s = F.coalesce(F.col(f"s{i}{j}"), F.lit(0.0))
        if i == j:
            s = F.greatest(s, F.lit(VECTOR[i][2] ** 2))
        for k in range(j):
            s = s - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
        # Rounding, or a raised variance elsewhere, may leave almost nothing: a hundredth of the least variance stays.
        out = out.withColumn(f"c{i}{j}", F.sqrt(F.greatest(s, F.lit(VECTOR[i][2] ** 2 / 100))) if i == j
                             else s / F.col(f"c{j}{j}"))
    logdet = sum((F.ln(f"c{i}{i}") for i in range(P)), F.lit(0.0))
    held = [*by, *[f"m{i}" for i in range(P)], *[f"c{i}{j}" for i, j in PAIRS], *(["was"] if "was" in out.columns else [])]
    return out.select(*held, logdet.alias("logdet"))


def _with_distance(far: DataFrame) -> DataFrame:
    """Rows joined to their group's estimate, with the squared Mahalanobis distance ``d2``.

    Forward substitution, one column per component: as one nested expression it would double with each.
    """
    for i in range(P):
        y = F.col(X[i]) - F.col(f"m{i}")
        for k in range(i):
            y = y - F.col(f"c{i}{k}") * F.col(f"__z{k}")
        far = far.withColumn(f"__z{i}", y / F.col(f"c{i}{i}"))
    return far.withColumn("d2", sum((F.col(f"__z{i}") * F.col(f"__z{i}") for i in range(P)), F.lit(0.0)))


def estimates(rows: DataFrame, share: float, max_steps: int) -> DataFrame:
    """The MCD estimate of each ``__g`` and the factor that scales its distances."""
    center = rows.groupBy("__g").agg(*[F.percentile_approx(x, 0.5).alias(f"b{i}") for i, x in enumerate(X)])
    off = rows.join(center, "__g")
    mad = off.groupBy("__g").agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"b{i}")), 0.5).alias(f"a{i}")
                                   for i, x in enumerate(X)])
    center = materialize(center.join(mad, "__g").select(
        "__g", *[F.col(f"b{i}").alias(f"m{i}") for i in range(P)],
        *[F.greatest(F.col(f"a{i}") * 1.4826, F.lit(VECTOR[i][2])).alias(f"a{i}") for i in range(P)]), "mcd-center")
    plain = _cholesky(center.select("*", *[(F.col(f"a{i}") ** 2 if i == j else F.lit(0.0)).alias(f"s{i}{j}")
                                           for i, j in PAIRS]), ["__g"])
    cut = rows.join(center, "__g").select("__g", *[
        (F.col(f"m{i}") + F.greatest(F.least(F.col(x) - F.col(f"m{i}"), 2 * F.col(f"a{i}")), -2 * F.col(f"a{i}"))).alias(x)
        for i, x in enumerate(X)])
    wrapped = _estimate(cut, ["__g"], "avg({})", "covar_pop({}, {})")
    now = materialize(plain.select(F.lit(0).alias("__start"), "*").unionByName(wrapped.select(F.lit(1).alias("__start"), "*")),
                      "mcd-start")
    by = ["__g", "__start"]
    for _ in range(max_steps):
        far = _with_distance(rows.join(now, "__g"))
        bound = far.groupBy(*by).agg(F.percentile_approx("d2", share, 10_000).alias("bound"))
        near = far.join(bound, by).filter("d2 <= bound")
        now = materialize(_estimate(near, by, "avg({})", "covar_pop({}, {})"), "mcd-step")
        if now.filter("logdet < was - 0.05").isEmpty():
            break
    best = now.groupBy("__g").agg(F.min_by("__start", "logdet").alias("__start"))
    best = now.join(best, by).drop("__start")
    scale = _with_distance(rows.join(best, "__g")).groupBy("__g").agg(
        (F.lit(chi_square_quantile(0.5, P)) / F.greatest(F.percentile_approx("d2", 0.5, 10_000), F.lit(1e-9))).alias("__scale"))
    return materialize(best.join(scale, "__g").withColumn("__scale", F.least("__scale", F.lit(1.0))), "mcd")


def judge(df: DataFrame, text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source"), least_group: int = 100,
          share: float = 0.75, tail: float = 1e-9, min_words: int = 50, max_repeat: int = 50, max_steps: int = 8,
          keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (default: all) with the counts, ``base_failed``, ``distance`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or over ``max_repeat`` per
    cent of the words in repeated windows.  ``distance``: the scaled squared
    Mahalanobis distance of a row that passed; null for one that failed.
    ``kept``: passed and not beyond the quantile ``1 - tail``.  Rows of groups
    under ``least_group`` rows are judged together per first group column,
    and where those are still fewer, all together; if even these are fewer
    than ``least_group``, only the base rules decide.  Null languages and
    sources are groups like others.  Null and blank texts have no words and
    fail.  Every row gives one row, repeated ones too; ties at the share's
    bound all count as near.  Input columns that have the name of an output
    are replaced.  An empty table gives an empty one.
    """
    keep = [c for c in (keep or df.columns) if c.lower() not in {*COUNTS, "base_failed", "kept", "distance"}]
    held = {f"__k{i}": c for i, c in enumerate(dict.fromkeys(keep))}
    narrow = df.select(*[F.col(c).alias(k) for k, c in held.items()], F.col(text_col).alias("__text"),
                       *[F.col(c).cast("string").alias(f"__g{i}") for i, c in enumerate(group_cols)])
    counted = count_words(narrow, "__text").drop("__text")
    counted = counted.withColumn("base_failed", (F.col("n_words") < min_words)
                                 | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")))
    counted = materialize(counted, "mcd-counts")

    groups = [f"__g{i}" for i in range(len(group_cols))]
    passed = counted.filter("not base_failed")
    sizes = passed.groupBy(*groups).agg(F.count("*").alias("n"))
    small = F.col("n") < least_group
    first = sizes.filter(small).groupBy(groups[0]).agg(F.sum("n").alias("n1"))
    rest = first.filter(F.col("n1") < least_group).agg(F.sum("n1")).first()[0] or 0
    sizes = sizes.join(first.withColumnRenamed(groups[0], "__f"), F.col("__f").eqNullSafe(F.col(groups[0])), "left")
    name = (F.when(~small, F.to_json(F.struct(*groups)))
            .when(F.col("n1") >= least_group, F.to_json(F.struct(groups[0], F.lit(True).alias("rest"))))
            .when(F.lit(rest >= least_group), F.lit("rest")))
    named = materialize(sizes.select(*[F.col(g).alias(f"__m{i}") for i, g in enumerate(groups)], name.alias("__g")), "mcd-groups")
    on = F.lit(True)
    for i, g in enumerate(groups):
        on = on & F.col(g).eqNullSafe(F.col(f"__m{i}"))

    def vectors(rows: DataFrame) -> DataFrame:
        """Rows with their group's name (null: judged by the base rules alone) and their vector."""
        rows = rows.join(named, on, "left").drop(*[f"__m{i}" for i in range(len(groups))])
        return rows.withColumns({x: F.when(~F.col("base_failed"), F.expr(v[1])) for x, v in zip(X, VECTOR, strict=True)})

    learned = estimates(vectors(passed).filter("__g is not null").select("__g", *X), share, max_steps)
    rows = vectors(counted)
    far = rows.join(learned.withColumnRenamed("__g", "__e"), F.col("__g") == F.col("__e"), "left")
    far = _with_distance(far)
    far = far.withColumn("distance", F.when(~F.col("base_failed"), F.col("d2") * F.col("__scale")))
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("distance") > chi_square_quantile(1 - tail, P), F.lit(False))
    return far.select(*[F.col(k).alias(c) for k, c in held.items()], *COUNTS, "base_failed", "distance", kept.alias("kept"))
