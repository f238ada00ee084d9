"""Robust multivariate outliers: minimum covariance determinant (MCD) per language and source, in DataFrame functions.

Every text becomes a vector of five transformed statistics. Per group the MCD estimate is found from two starts
(medians with quartile scales; means with standard deviations) by concentration steps: distances under the
current estimate, the share `SUPPORT` of rows with the smallest ones, their mean and covariance. A step never raises
the determinant; of the two starts the one with the smaller determinant wins. A row is rejected when its squared
Mahalanobis distance to the estimate of its group exceeds the quantile of `CUTOFF_CHANCE`; deviations to the good side count
as none.

Estimates of few rows are drawn towards those of more: a group's towards its language's, a language's towards that of all
rows, with the weight n / (n + `PRIOR_ROWS`) for its own n rows. Nothing changes at a certain number of rows, and a group of one row
has an estimate too. Order statistics are exact on a fixed grid: values are counted per grid cell before the shuffle, so a group with a
third of all rows is a bounded number of counts. Estimates are sums per group. The text is read once; the steps
run over the stored vectors. A ridge keeps statistics that are constant in a group (no symbol in most texts) from
having no spread.

Cases: a null text has no words; texts below 50 words fail the base rules and take no part in the estimates;
null languages and sources are groups of their own; repeated rows count and are judged each for itself; a table without
a usable row rejects by the base rules alone; an empty one gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.llm.staging import staged

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
SUPPORT = 0.75
STEPS = 4
PRIOR_ROWS = 25        # rows that the wider estimate counts for, five to a dimension
CUTOFF_CHANCE = 1e-6   # of a row of the model distribution beyond the cutoff
GRID = 64.0            # cells per unit of a transformed statistic
RIDGE = 0.04           # spread added to every statistic, in its transformed unit

STATS = ("word_length", "symbols", "dup_lines", "repeats", "distinct")
_BAD_SIDE = {"symbols": 1, "dup_lines": 1, "repeats": 1, "distinct": -1}  # words may be too short and too long
_D = len(STATS)


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _split_words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES[1:], " " * (len(SPACES) - 1)), " "), "")


def _repeat_words(words: Column) -> Column:
    """Words within 3-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash, so two different ones of a text count as equal with a chance of about
    2^-64. Most texts repeat no window and stop there; otherwise windows are sorted with their positions.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                         lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def positions(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = F.filter(s, lambda x, k: ((k > 0) & (F.try_element_at(s, k)["h"] == x["h"]))
                            | ((k + 2 <= F.size(s)) & (F.try_element_at(s, k + 2)["h"] == x["h"])))
            return F.size(F.array_distinct(F.flatten(F.transform(same, lambda x: F.sequence(x["i"], x["i"] + 2)))))

        return _let(ranked, twice)

    counted = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(positions(h)))
    return F.when(F.size(words) < 3, 0).otherwise(counted).cast("long")


def base_statistics(rows: DataFrame, text: Column) -> DataFrame:
    """`rows` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct, base_failed."""
    split = rows.withColumn("_text", F.coalesce(text.cast("string"), F.lit(""))) \
        .withColumn("_words", _split_words(F.col("_text")))
    words, raw = F.col("_words"), F.col("_text")
    with_word = F.filter(F.split(raw, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    lines = F.when(F.contains(raw, F.lit("\n")),
                   _let(with_word, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))))
    measured = split.select(
        *rows.columns,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.length(raw) - F.length(F.translate(raw, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.coalesce(lines["n"] - lines["d"], F.lit(0)).cast("long").alias("n_dup_lines"),
        _repeat_words(words).alias("n_repeat_words"),
        F.coalesce(lines["n"], F.lit(1)).cast("long").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def transformed() -> dict[str, Column]:
    """The vector: each statistic on a scale on which ordinary texts vary by a few tenths, cut to 1/1024."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    raw = {
        "word_length": 2 * F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "symbols": F.log1p(F.col("n_symbols") / n),
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
        # The share of distinct words falls with length; its logarithm over that of the length does not.
        "distinct": 4 * F.log(F.greatest(F.col("n_distinct"), F.lit(1)).cast("double")) / F.log(n + 1),
    }
    return {name: F.round(value * 1024) / 1024 for name, value in raw.items()}


def _levels(rows: DataFrame) -> DataFrame:
    """Each usable row in its group, its language and the whole, under one key."""
    key = F.struct(F.lit(0).alias("level"), F.col("lang"), F.col("source"))
    lang = F.struct(F.lit(1).alias("level"), F.col("lang"), F.lit(None).cast("string").alias("source"))
    whole = F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"),
                     F.lit(None).cast("string").alias("source"))
    return rows.select(F.explode(F.array(key, lang, whole)).alias("key"), *STATS)


def _at_share(rows: DataFrame, keys: list[str], cell: str, shares: dict[str, float]) -> DataFrame:
    """The grid cell that holds each share of a key's rows; counted per cell first."""
    counts = rows.groupBy(*keys, cell).agg(F.count("*").alias("n"))
    order = Window.partitionBy(*keys).orderBy(cell)
    total = F.sum("n").over(Window.partitionBy(*keys))
    upto = counts.select(*keys, cell, F.sum("n").over(order).alias("upto"), total.alias("total"))
    return upto.groupBy(*keys).agg(*[
        F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * share), F.col(cell))).alias(name)
        for name, share in shares.items()])


def _moments() -> list[Column]:
    pairs = [(i, j) for i in range(_D) for j in range(i + 1)]
    return [F.count("*").alias("n"), *[F.sum(s).alias(f"s{k}") for k, s in enumerate(STATS)],
            *[F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"q{i}{j}") for i, j in pairs]]


def _estimate(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Means, the Cholesky factor of the ridged covariance and its log-determinant from sums."""
    out = groups.select(*keys, "n", *[(F.col(f"s{k}") / F.col("n")).alias(f"m{k}") for k in range(_D)],
                        *[f"q{i}{j}" for i in range(_D) for j in range(i + 1)])
    # The share of smallest distances is narrower than the whole; the factor makes up for it.
    factor = _consistency(SUPPORT, _D)

    def spread(i: int, j: int) -> Column:
        value = F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
        return factor * F.greatest(value, F.lit(0.0)) + RIDGE ** 2 if i == j else factor * value

    out = _factored(out, spread)
    logdet = sum((F.log(F.col(f"l{k}{k}")) for k in range(1, _D)), F.log(F.col("l00")))
    return out.withColumn("logdet", logdet).select(*keys, "n", "logdet", *_estimate_columns())


def _factored(rows: DataFrame, covariance) -> DataFrame:
    """The columns l00, l10, l11, ... of the Cholesky factor of `covariance(i, j)`."""
    for i in range(_D):
        for j in range(i + 1):
            rest = covariance(i, j)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}")
            rows = rows.withColumn(f"l{i}{j}", value)
    return rows


def _shrunk(rows: DataFrame) -> DataFrame:
    """The estimate of each row drawn towards the wider one beside it (columns w_m0, ...), and own_share.

    The mixture of both: means and covariances by their shares, and what the means differ by.
    """
    pairs = [(i, j) for i in range(_D) for j in range(i + 1)]
    share = F.col("own_share")

    def product(prefix: str, i: int, j: int) -> Column:
        return sum((F.col(f"{prefix}l{i}{k}") * F.col(f"{prefix}l{j}{k}") for k in range(1, j + 1)),
                   F.col(f"{prefix}l{i}0") * F.col(f"{prefix}l{j}0"))

    def apart(i: int) -> Column:
        return F.col(f"m{i}") - F.col(f"w_m{i}")

    mixed = rows.withColumn("own_share", F.col("n_rows") / (F.col("n_rows") + PRIOR_ROWS)).withColumns({
        f"c{i}{j}": share * product("", i, j) + (1 - share) * product("w_", i, j) + share * (1 - share) * apart(i) * apart(j)
        for i, j in pairs})
    mixed = mixed.withColumns({f"m{k}": share * F.col(f"m{k}") + (1 - share) * F.col(f"w_m{k}") for k in range(_D)})
    return _factored(mixed.drop(*[f"l{i}{j}" for i, j in pairs]), lambda i, j: F.col(f"c{i}{j}"))


def _estimate_columns() -> list[str]:
    return [f"m{k}" for k in range(_D)] + [f"l{i}{j}" for i in range(_D) for j in range(i + 1)]


def distance(prefix: str = "", bad_side_only: bool = False) -> Column:
    """Squared Mahalanobis distance of a row under the estimate beside it, by forward substitution."""
    solved: list[Column] = []
    for i, name in enumerate(STATS):
        rest = F.col(name) - F.col(f"{prefix}m{i}")
        if bad_side_only and name in _BAD_SIDE:
            rest = (F.greatest if _BAD_SIDE[name] > 0 else F.least)(rest, F.lit(0.0))
        for k in range(i):
            rest = rest - F.col(f"{prefix}l{i}{k}") * solved[k]
        solved.append(rest / F.col(f"{prefix}l{i}{i}"))
    return sum((s * s for s in solved[1:]), solved[0] * solved[0])


def mcd_estimates(vectors: DataFrame) -> DataFrame:
    """(key, n_rows, logdet, m0.., l00..): the MCD estimate of every group, language and the whole.

    `vectors` has lang, source and the STATS. It is read a few times and should be a stored table.
    """
    rows = _levels(vectors)
    long = rows.select("key", F.explode(F.array(*[
        F.struct(F.lit(k).alias("stat"), F.round(F.col(s) * GRID).cast("long").alias("cell"))
        for k, s in enumerate(STATS)])).alias("x")).select("key", "x.stat", "x.cell")
    quartiles = _at_share(long, ["key", "stat"], "cell", {"low": 0.25, "middle": 0.5, "high": 0.75})
    spread = F.greatest((F.col("high") - F.col("low")) / (2 * 0.6745 * GRID), F.lit(RIDGE))
    by_stat = quartiles.groupBy("key").pivot("stat", list(range(_D))).agg(
        F.first(F.col("middle") / GRID).alias("m"), F.first(spread).alias("l"))
    sizes_and_moments = rows.groupBy("key").agg(*_moments())
    median_start = by_stat.select("key", F.lit(0).alias("start"), *[F.col(f"{k}_m").alias(f"m{k}") for k in range(_D)],
                                  *[(F.col(f"{i}_l") if i == j else F.lit(0.0)).alias(f"l{i}{j}")
                                    for i in range(_D) for j in range(i + 1)])
    mean_start = _estimate(sizes_and_moments, ["key"]).select("key", F.lit(1).alias("start"), *_estimate_columns())
    current = staged(median_start.unionByName(mean_start), "mcd-start")
    sizes = sizes_and_moments.select("key", F.col("n").alias("n_rows"))
    for _ in range(STEPS):
        # Cells of the logarithm of the distance, 16 to the octave.
        far = rows.join(current, "key").withColumn(
            "cell", F.floor(16 * F.log2(distance() + 2.0 ** -8)).cast("long"))
        cut = _at_share(far, ["key", "start"], "cell", {"cut": SUPPORT}).withColumnRenamed("key", "cut_key") \
            .withColumnRenamed("start", "cut_start")
        kept = far.join(cut, F.col("key").eqNullSafe(F.col("cut_key")) & (F.col("start") == F.col("cut_start"))) \
            .where(F.col("cell") <= F.col("cut"))
        current = staged(_estimate(kept.groupBy("key", "start").agg(*_moments()), ["key", "start"]), "mcd-step")
    best = current.groupBy("key").agg(F.min_by(F.struct("logdet", *_estimate_columns()),
                                               F.struct("logdet", "start")).alias("e"))
    return best.join(sizes, "key").select("key", "n_rows", "e.*")


def judge(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, outlier_distance, own_share, kept).

    `row` holds the named columns of the text (all by default), so their names may be anything; outlier_distance is
    null if the base rules failed; own_share is the weight of the group's own rows in its estimate. Only the bad side
    counts in the distance: symbols, repeated lines or repeated windows above the group's mean, fewer distinct words,
    or words of another length.
    """
    rows = docs.select(
        F.struct(*(docs.columns if columns is None else columns)).alias("row"), F.col("text").alias("_raw"),
        *[F.col(c).cast("string").alias(c) for c in ("lang", "source")])
    stats = base_statistics(rows, F.col("_raw")).drop("_raw").withColumns(transformed())
    return _verdicts(staged(stats, "statistics"))


def keep_good(docs: DataFrame) -> DataFrame:
    """`docs` that pass, with the columns they came with."""
    return judge(docs).where("kept").select("row.*")


def _verdicts(stored: DataFrame) -> DataFrame:
    usable = stored.where(~F.col("base_failed")).select("lang", "source", *STATS)
    estimates = staged(mcd_estimates(usable), "mcd")
    fields = _estimate_columns()
    # The estimate of all rows is one row of a few numbers.
    last = estimates.where(F.col("key.level") == 2).select(*fields).head()
    whole = [F.lit(None if last is None else last[f]).cast("double").alias(f"w_{f}") for f in fields]
    langs = _shrunk(estimates.where(F.col("key.level") == 1).select(
        F.col("key.lang").alias("w_lang"), "n_rows", *fields, *whole)).select(
            "w_lang", *[F.col(f).alias(f"w_{f}") for f in fields])
    groups = estimates.where(F.col("key.level") == 0).select(
        F.col("key.lang").alias("g_lang"), F.col("key.source").alias("g_source"), "n_rows", *fields)
    own = staged(_shrunk(groups.join(langs, groups["g_lang"].eqNullSafe(langs["w_lang"]))).select(
        "g_lang", "g_source", "own_share", *[F.col(f).alias(f"_{f}") for f in fields]), "group-estimates")
    judged = (stored
              .join(own, stored["lang"].eqNullSafe(own["g_lang"]) & stored["source"].eqNullSafe(own["g_source"]), "left")
              .select(*stored.columns, "own_share", *[f"_{f}" for f in fields]))
    judged = judged.withColumn("_far", distance("_", bad_side_only=True))
    outlier = F.coalesce(F.col("_far") > chi2_quantile(1 - CUTOFF_CHANCE, _D), F.lit(False))
    return judged.select(
        *[c for c in stored.columns if c not in STATS],
        F.when(~F.col("base_failed"), F.col("_far")).alias("outlier_distance"), "own_share",
        (~F.col("base_failed") & ~outlier).alias("kept"))


def _gamma_share(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its power series."""
    if x <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-15:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_quantile(share: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _gamma_share(d / 2, middle / 2) < share else (low, middle)
    return low


def _consistency(share: float, d: int) -> float:
    """Makes the covariance of the `share` smallest distances that of the whole, for a normal distribution."""
    return share / _gamma_share(d / 2 + 1, chi2_quantile(share, d) / 2)
