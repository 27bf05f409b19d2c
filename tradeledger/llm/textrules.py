"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Statistics of a text are transformed towards symmetry; for each language and source the minimum
covariance determinant estimate of centre and scatter is found by concentration steps from several
starts, and texts far from it by Mahalanobis distance are rejected. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.llm.batches import pick
from tradeledger.session import cut_lineage

BLANKS = " \t\n\x0b\x0c\r"
BLANK_PATTERN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: The transformed statistics, in order.
FEATURES = ("word_length", "symbol_share", "line_share", "repeat_share")

#: Added to variances, a floor for statistics that are constant in a group: a share of a sixteenth alone has
#: a squared distance of 25 there. One repeated heading is no fault and is taken out of the statistics instead.
RIDGE = (0.0025, 0.0025, 0.0025, 0.0025)

#: Words of a repeated line that may be a heading; a longer one counts as repeated text.
HEADING_WORDS = 12


def consistency(share: float) -> float:
    """What a covariance of the central ``share`` of normal rows of four statistics is multiplied by.

    share / F6(q), q the chi-square quantile of four degrees of freedom, F6 the distribution of six.
    """
    low, high = 0.0, 100.0
    for _ in range(60):
        half = (low + high) / 4
        low, high = (2 * half, high) if 1 - math.exp(-half) * (1 + half) < share else (low, 2 * half)
    return share / (1 - math.exp(-low / 2) * (1 + low / 2 + low * low / 8))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body on a value that is computed once per row, not once per use."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK_PATTERN), lambda w: w != "")


def _covered(n: Column, starts: Column, width: int) -> Column:
    """Positions within ``width`` after any of the sorted starts."""
    step = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("int").alias("n"), F.lit(-width).cast("int").alias("last")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(width), s - a["last"])).alias("n"), s.alias("last")),
    )
    return step["n"]


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words inside a window of ``width`` words that the text holds at least twice, the first included.

    Windows are compared by 64-bit hashes; only texts with equal ones sort theirs.
    """

    def of_hashes(h: Column) -> Column:
        def sorted_pairs(pairs: Column) -> Column:
            def twin(x: Column, i: Column) -> Column:
                before = F.when(i > 0, F.get(pairs, i - 1)["h"] == x["h"])
                after = F.get(pairs, i + 1)["h"] == x["h"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            starts = F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x["i"]))
            return _covered(F.lit(0), starts, width)

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, sorted_pairs))

    def of_words(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - width)
        hashes = F.transform(at, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(width))))
        return F.when(F.size(w) < width, F.lit(0)).otherwise(let(hashes, of_hashes))

    return let(words, of_words).cast("bigint")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    filled = F.filter(F.split(text, "\n"), lambda line: F.translate(line, BLANKS, "") != "")
    return let(filled, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")


def heading_words(text: Column) -> Column:
    """Words in two places of the longest line that the text repeats; 0 without one, or if it is no heading."""
    filled = F.filter(F.split(text, "\n"), lambda line: F.translate(line, BLANKS, "") != "")

    def of_sorted(lines: Column) -> Column:
        again = F.filter(lines, lambda line, i: (i > 0) & (line == F.get(lines, i - 1)))
        return F.array_max(F.transform(again, lambda line: F.size(words_of(line))))

    def of_lines(lines: Column) -> Column:
        some = F.size(lines) > F.size(F.array_distinct(lines))
        found = let(F.sort_array(lines), of_sorted)
        return F.when(some, let(found, lambda n: F.when(n <= HEADING_WORDS, 2 * n).otherwise(0))).otherwise(F.lit(0))

    return let(filled, of_lines).cast("bigint")


def text_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, heading_words and base_failed."""
    rows = pick(docs, *dict.fromkeys([*keep, "text"]))
    text = F.coalesce("text", F.lit(""))
    words = let(words_of(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("r")))
    solid = F.length(F.translate(text, BLANKS, "")).cast("bigint")
    symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")
    out = rows.select(
        *keep,
        words.alias("w"),
        solid.alias("word_chars"),
        symbols.alias("n_symbols"),
        repeated_lines(text).alias("n_dup_lines"),
        (F.size(F.split(text, "\n"))).cast("bigint").alias("n_lines"),
        heading_words(text).alias("heading_words"),
    )
    failed = (F.col("w.n") < 10) | (100 * F.col("w.r") > 20 * F.col("w.n"))
    return out.select(
        *keep, F.col("w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_lines",
        F.col("w.r").alias("n_repeat_words"), "heading_words", failed.alias("base_failed"),
    )


def _features(stats: DataFrame) -> DataFrame:
    """Logarithms and square roots of rates; one repeated heading is left out of both rates of repeats."""
    more_lines = F.greatest(F.col("n_dup_lines") - (F.col("heading_words") > 0).cast("int"), F.lit(0))
    more_words = F.greatest(F.col("n_repeat_words") - F.col("heading_words"), F.lit(0))
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return stats.withColumns(
        {
            "word_length": F.log1p(F.col("word_chars") / words),
            "symbol_share": F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
            "line_share": F.sqrt(more_lines / lines),
            "repeat_share": F.sqrt(more_words / words),
        }
    )


def _scatter(rows: DataFrame, groups: list[str], factor: float) -> DataFrame:
    """Mean and covariance times the factor per group, with the ridge, as columns m0.. and c00.."""
    aggs = [F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)]
    for i, f in enumerate(FEATURES):
        for j in range(i + 1):
            value = F.covar_pop(f, FEATURES[j])
            aggs.append((factor * F.coalesce(value, F.lit(0.0)) + (RIDGE[i] if i == j else 0.0)).alias(f"c{i}{j}"))
    return rows.groupBy(*groups).agg(*aggs)


def _factored(scatter: DataFrame, groups: list[str]) -> DataFrame:
    """Cholesky factor of each covariance as columns l00.."""
    out = scatter
    for j in range(len(FEATURES)):
        rest = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - rest, F.lit(1e-12))))
        for i in range(j + 1, len(FEATURES)):
            rest = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - rest) / F.col(f"l{j}{j}"))
    lower = [f"l{i}{j}" for i in range(len(FEATURES)) for j in range(i + 1)]
    return out.select(*groups, *[f"m{i}" for i in range(len(FEATURES))], *lower)


def _distance(rows: DataFrame, factors: DataFrame, groups: list[str], name: str) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution; NULL groups meet each other."""
    f = factors.toDF(*(f"_{c}" for c in factors.columns))
    on = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]
    met = rows.join(f, on, "left")
    z: list[Column] = []
    for i, feature in enumerate(FEATURES):
        rest = sum((F.col(f"_l{i}{k}") * F.col(f"_z{k}") for k in range(i)), F.lit(0.0))
        met = met.withColumn(f"_z{i}", (F.col(feature) - F.col(f"_m{i}") - rest) / F.col(f"_l{i}{i}"))
        z.append(F.col(f"_z{i}") * F.col(f"_z{i}"))
    return met.withColumn(name, sum(z, F.lit(0.0))).select(*rows.columns, name)


def _starts(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Three first estimates per group: medians with equal scales, medians with the spread of the quartiles, and
    mean and covariance of all rows."""
    n = len(FEATURES)
    lower = [(i, j) for i in range(n) for j in range(i + 1)]
    quartiles = [F.percentile_approx(f, [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i, f in enumerate(FEATURES)]
    cuts = cut_lineage(rows.groupBy(*groups).agg(*quartiles))

    def medians(scale: Callable[[int], Column], start: int) -> DataFrame:
        sides = [(scale(i) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i, j in lower]
        return cuts.select(*groups, *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(n)], *sides, F.lit(start).alias("_start"))

    def spread(i: int) -> Column:
        deviation = (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349
        return F.sqrt(deviation * deviation + RIDGE[i])

    whole = _factored(_scatter(rows, groups, 1.0), groups).withColumn("_start", F.lit(2))
    return cut_lineage(medians(lambda i: F.lit(RIDGE[i] ** 0.5), 0).unionByName(medians(spread, 1)).unionByName(whole))


def _concentrated(rows: DataFrame, factors: DataFrame, groups: list[str], share: float) -> DataFrame:
    """Centre, factor and log determinant of the share of each group's rows that is nearest by the given ones."""
    far = _distance(rows, factors, groups, "_d")
    limit = far.groupBy(*groups).agg(F.percentile_approx("_d", share, 1000).alias("_limit"))
    limit = limit.toDF(*(f"__{g}" for g in groups), "_limit")
    on = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in groups]
    nearest = far.join(limit, on).where(F.col("_d") <= F.col("_limit"))
    made = _factored(_scatter(nearest, groups, consistency(share)), groups)
    logs = sum((2 * F.log(f"l{i}{i}") for i in range(len(FEATURES))), F.lit(0.0))
    return cut_lineage(made.withColumn("logdet", logs))


def _least(factors: DataFrame, groups: list[str]) -> DataFrame:
    """The estimate of least determinant per group."""
    values = ["logdet", *(c for c in factors.columns if c[0] in "ml" and c[1:].isdigit())]
    least = factors.groupBy(*groups).agg(F.min(F.struct(*values)).alias("least"))
    return cut_lineage(least.select(*groups, "least.*"))


def robust_scatter(
    rows: DataFrame, groups: list[str], share: float = 0.75, first_steps: int = 2, steps: int = 10, settled: float = 1e-3
) -> DataFrame:
    """Minimum covariance determinant per group as centre and Cholesky factor, with its log determinant.

    Each of the starts takes ``first_steps`` concentration steps: a step keeps the share of the rows nearest to the
    centre of the last subset, which cannot raise the determinant but for the cut at approximate
    quantiles. The start of least determinant goes on, until a step lowers the log determinants by less than
    ``settled`` a group in the mean, ``steps`` times at most; a group keeps the least it has met. Sums are
    combined before the shuffle: no task holds a group. The scatter of the subset is scaled to that of all rows.
    """
    factors = _starts(rows, groups)
    tried = rows.withColumn("_start", F.explode(F.array(*(F.lit(i) for i in range(3)))))
    for _ in range(first_steps):
        factors = _concentrated(tried, factors, [*groups, "_start"], share)
    best = _least(factors, groups)
    mean = best.agg(F.avg("logdet")).first()[0]
    for _ in range(steps):
        best = _least(best.unionByName(_concentrated(rows, best, groups, share)), groups)
        last, mean = mean, best.agg(F.avg("logdet")).first()[0]
        if mean is None or last - mean < settled:
            break
    return best


def judge_texts(
    docs: DataFrame,
    keep: list[str] | None = None,
    groups: tuple[str, ...] = ("lang", "source"),
    most: float = 25.0,
) -> DataFrame:
    """Columns ``keep`` (id by default) with the statistics, base_failed, distance and kept.

    A row is kept if the fixed limits hold and its squared distance is at most ``most``: 25 is the
    chi-square quantile of four degrees of freedom that one normal row in 20,000 exceeds. Centre and
    scatter are those of the rows of its group that pass the limits; NULL is a group like any other.
    A NULL text has no words and fails, and so has no say in the estimate; a group of one row or of
    equal rows has the ridge as scatter. Repeated rows are judged each, and count each.
    """
    keep = ["doc_id"] if keep is None else keep
    columns = list(dict.fromkeys([*keep, *groups]))
    stats = cut_lineage(_features(text_statistics(docs, columns)))
    passed = stats.where(~F.col("base_failed"))
    small = passed.select(*groups, *FEATURES)
    judged = _distance(stats, robust_scatter(small, list(groups)), list(groups), "distance")
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= most, F.lit(True))
    return judged.withColumn("kept", kept).drop(*FEATURES, "heading_words")
