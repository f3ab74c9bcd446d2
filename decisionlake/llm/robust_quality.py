"""Quality rules with robust multivariate outliers, in DataFrame operations only.

Texts become five statistics, on log scales and rounded to 1/1024: words, letters a word, and per hundred
words symbols, repeated lines and repeated words. Each language and source has a minimum-covariance-
determinant estimate of their place and scatter, and documents far from it by Mahalanobis distance are
rejected; so are those that fail plain rules, which take no part in the estimates.

Estimates are deterministic and regularised. Each starts from the coordinates' medians and median deviations
and, a second time, from the scatter of signs about the medians. A concentration step bins the distances of all
rows (1/64 a bin), sums the integer statistics and their products per bin, and takes the bins that
reach the share ``SHARE`` of the rows into the next place and scatter; after ``STEPS`` of them the start
with the smaller determinant is corrected for consistency and reweighted once. As many statistics are 0 in
most texts, a fixed matrix, the square of ``FLOORS``, is added to each scatter.

All sums are of integers, so that they don't depend on how rows are dealt, and rows of a bin, a group or a
language are only ever counted and added up. Languages and sources with fewer than ``LEAST`` rows share the
estimate of their language's other small ones, small languages that of all; with fewer still there is none.

Cases: null and empty texts have no words and fail the rules; null languages and sources are groups of their
own; repeated rows each count and get their result; ties at a bin's edge stay together; an empty table gives
no rows; very long texts are split into words inside their row; other columns are ignored. Repeated windows
are found by a 64-bit hash of three words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from decisionlake.functions.vectors import computed_once
from decisionlake.sources.storage import cut

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED = 50

SHARE = 0.75
STEPS = 6
LEAST = 50
#: The probability of a larger distance at which a clean document is rejected.
REJECT = 0.0001
#: Standard deviations added to the scatter: words, letters a word, symbols, repeated lines, repeated words.
FLOORS = (1.0, 0.1, 0.5, 0.5, 0.8)
P = len(FLOORS)
SCALE, BINS, MOST_BINS = 1024, 64, 4096

_PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
PARAMS = [*(f"m{i}" for i in range(P)), *(f"l{i}{j}" for i, j in _PAIRS)]


def chi2_cdf(x: float, p: int) -> float:
    out, k = (math.erf(math.sqrt(x / 2)), 1) if p % 2 else (1 - math.exp(-x / 2), 2)
    while k < p:
        out -= (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
        k += 2
    return out


def chi2_quantile(share: float, p: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, p) < share else (low, middle)
    return low


def consistency(share: float, p: int) -> float:
    """By how much the scatter of the nearest ``share`` of normal rows falls short."""
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


def _without(text: Column, signs: str) -> Column:
    for sign in signs:
        text = F.replace(text, F.lit(sign), F.lit(""))
    return text


def _repeated(hits: Column) -> Column:
    """Words covered by windows of three at ascending positions."""
    first = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(hits, first, lambda have, at: F.struct(
        (have["n"] + at + 3 - F.greatest(at, have["upto"])).cast("bigint").alias("n"), (at + 3).alias("upto")
    ))["n"]


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` per row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), text.alias("text"))
    bare = F.trim("text", F.lit(SPACES))
    lines = F.filter(F.split("text", "\n"), lambda line: F.trim(line, F.lit(SPACES)) != "")
    rows = computed_once(rows, {
        "words": F.when(bare != "", F.split(bare, "[ \t\n\x0b\f\r]+")).otherwise(F.array().cast("array<string>")),
        "word_chars": F.char_length(_without(F.col("text"), SPACES)).cast("bigint"),
        "n_symbols": (F.octet_length("text") - F.octet_length(_without(F.col("text"), SYMBOLS))).cast("bigint"),
        "lines": F.when(F.contains("text", F.lit("\n")), lines),
    }).drop("text")
    windows = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    rows = computed_once(rows, {
        "n_words": F.size("words").cast("bigint"),
        "n_dup_lines": F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("bigint"),
        "windows": F.when(F.size("words") > 3, F.slice(windows, F.lit(1), F.size("words") - 2)),
    }).drop("words", "lines")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = computed_once(rows, {"placed": F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed)}).drop("windows")
    twice = F.filter("placed", lambda x, i: (x["h"] == F.get("placed", i - 1)["h"]) | (x["h"] == F.get("placed", i + 1)["h"]))
    hits = F.sort_array(F.transform(twice, lambda x: x["i"]))
    rows = computed_once(rows, {"n_repeat_words": F.coalesce(_repeated(hits), F.lit(0).cast("bigint"))}).drop("placed")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )


def coordinates() -> list[Column]:
    """The transformed statistics, as multiples of 1/1024."""
    per = [f"ln(1e0 + 100e0 * {c} / nullif(n_words, 0))" for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]
    values = ["ln(1e0 + n_words)", "ln(word_chars * 1e0 / nullif(n_words, 0))", *per]
    return [F.expr(f"cast(round({v} * {SCALE}) as bigint)").alias(f"x{i}") for i, v in enumerate(values)]


def _cells(rows: DataFrame) -> DataFrame:
    """``lang, source, cell``: the name of the estimate that a language and source use; null for none."""
    own = cut(rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "groups")
    small = own.filter(F.col("n") < LEAST).groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("n_lang"))
    small = cut(small, "languages")
    left = small.filter(F.col("n_lang") < LEAST).agg(F.sum("n_lang")).first()[0] or 0
    named = own.join(small, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    cell = (
        F.when(F.col("n") >= LEAST, F.to_json(F.struct("lang", "source")))
        .when(F.col("n_lang") >= LEAST, F.concat(F.to_json(F.struct("lang")), F.lit("*")))
        .when(F.lit(left >= LEAST), "*")
    )
    return named.select("lang", "source", cell.alias("cell"))


def _with_factors(moments: DataFrame) -> DataFrame:
    """From place (m) and scatter (s) to place and the scatter's triangular factor (l)."""
    for j in range(P):
        before = "".join(f" - l{j}{k} * l{j}{k}" for k in range(j))
        moments = moments.withColumn(f"l{j}{j}", F.expr(f"sqrt(s{j}{j}{before})"))
        moments = moments.withColumns({
            f"l{i}{j}": F.expr(f"(s{i}{j}{''.join(f' - l{i}{k} * l{j}{k}' for k in range(j))}) / l{j}{j}") for i in range(j + 1, P)
        })
    return moments.select(*[c for c in moments.columns if c in ("cell", "start")], *PARAMS)


def _floor(i: int, j: int) -> float:
    return (FLOORS[i] * SCALE) ** 2 if i == j else 0.0


def _moments(sums: DataFrame, factor: float) -> DataFrame:
    """Place and regularised scatter from counts, sums and sums of products."""
    place = {f"m{i}": F.col(f"t{i}") / F.col("n") for i in range(P)}
    scatter = {
        f"s{i}{j}": F.lit(factor) * (F.col(f"t{i}{j}") - F.col(f"t{i}") * (F.col(f"t{j}") / F.col("n"))) / F.col("n") + F.lit(_floor(i, j))
        for i, j in _PAIRS
    }
    return _with_factors(sums.withColumns({**place, **scatter}))


def _sums(suffix: str = "") -> list[Column]:
    """Counts, sums and sums of products of rows, or with a suffix of such sums."""
    if suffix:
        return [F.sum(c).alias(c) for c in ("n", *(f"t{i}" for i in range(P)), *(f"t{i}{j}" for i, j in _PAIRS))]
    return [F.count("*").alias("n"), *(F.sum(f"x{i}").alias(f"t{i}") for i in range(P)),
            *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"t{i}{j}") for i, j in _PAIRS)]


def _with_distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance from the parameters in the same row."""
    for i in range(P):
        before = "".join(f" - l{i}{k} * y{k}" for k in range(i))
        rows = rows.withColumn(f"y{i}", F.expr(f"(x{i} - m{i}{before}) / l{i}{i}"))
    return rows.withColumn("d2", F.expr(" + ".join(f"y{i} * y{i}" for i in range(P)))).drop(*(f"y{i}" for i in range(P)))


def _middle(counted: DataFrame, value: str) -> DataFrame:
    """``cell, i, middle``: the lower median of counted values."""
    order = Window.partitionBy("cell", "i").orderBy(value)
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = counted.withColumns({"upto": upto, "total": total}).filter("2 * upto >= total")
    return rows.groupBy("cell", "i").agg(F.min(value).alias("middle"))


def starts(rows: DataFrame) -> DataFrame:
    """Two first estimates per cell: medians with squared deviations, and with the scatter of signs."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("v")) for i in range(P)])).alias("e")
    counted = cut(rows.select("cell", each).groupBy("cell", F.col("e.i").alias("i"), F.col("e.v").alias("v")).agg(F.count("*").alias("n")), "counted")
    medians = cut(_middle(counted, "v"), "medians")
    off = counted.join(medians, ["cell", "i"]).groupBy("cell", "i", F.abs(F.col("v") - F.col("middle")).alias("off")).agg(F.sum("n").alias("n"))
    spread = _middle(off, "off").withColumnRenamed("middle", "off")
    at = medians.join(spread, ["cell", "i"]).groupBy("cell").agg(
        *(F.max(F.when(F.col("i") == i, F.col("middle"))).cast("double").alias(f"m{i}") for i in range(P)),
        *(F.max(F.when(F.col("i") == i, F.greatest(F.lit(1.4826) * F.col("off"), F.lit(FLOORS[i] * SCALE)))).alias(f"w{i}") for i in range(P)),
    )
    at = cut(at, "places")
    sign = [F.signum(F.col(f"x{i}") - F.col(f"m{i}")).cast("bigint") for i in range(P)]
    signs = rows.join(at, "cell").groupBy("cell").agg(F.count("*").alias("n"), *(F.sum(sign[i] * sign[j]).alias(f"g{i}{j}") for i, j in _PAIRS))
    both = at.join(signs, "cell").withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    return _with_factors(both.withColumns({
        f"s{i}{j}": F.when(F.col("start") == 0, F.col(f"w{i}") * F.col(f"w{j}") * float(i == j))
        .otherwise(F.col(f"w{i}") * F.col(f"w{j}") * (F.col(f"g{i}{j}") / F.col("n"))) + F.lit(_floor(i, j))
        for i, j in _PAIRS
    }))


def estimates(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Place and factor of the scatter per ``cell`` of rows (cell, x0, x1, ...)."""
    params = cut(starts(rows), "estimate")
    order = Window.partitionBy("cell", "start").orderBy("bin")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    for _ in range(steps):
        far = _with_distance(rows.join(params, "cell"))
        bins = far.withColumn("bin", F.least(F.floor(F.sqrt("d2") * BINS), F.lit(MOST_BINS - 1)))
        bins = bins.groupBy("cell", "start", "bin").agg(*_sums())
        near = bins.withColumns({"before": before, "total": total}).filter(F.col("before") < F.ceil(F.col("total") * F.lit(share)))
        params = cut(_moments(near.groupBy("cell", "start").agg(*_sums("again")), consistency(share, P)), "estimate")
    size = F.expr(" * ".join(f"l{i}{i}" for i in range(P)))
    best = params.groupBy("cell").agg(F.min(F.struct(size.alias("size"), "start", *PARAMS)).alias("b")).select("cell", *(f"b.{c}" for c in PARAMS))
    clear = _with_distance(rows.join(best, "cell")).filter(F.col("d2") <= chi2_quantile(0.975, P))
    return cut(_moments(clear.groupBy("cell").agg(*_sums()), consistency(0.975, P)), "estimate")


def robust_quality(docs: DataFrame, reject: float = REJECT) -> DataFrame:
    """The statistics of each row with ``base_failed``, ``kept`` and ``distance`` (squared; null without an estimate)."""
    found = cut(statistics(docs), "statistics")
    sound = found.filter(~F.col("base_failed"))
    cells = cut(_cells(sound), "cells").withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")) & ~F.col("base_failed")
    rows = cut(found.join(cells, same, "left").select(*found.drop("lang", "source").columns, "cell", *coordinates()), "coordinates")
    params = estimates(rows.filter("cell IS NOT NULL").select("cell", *(f"x{i}" for i in range(P))))
    judged = _with_distance(rows.join(params, "cell", "left"))
    far = F.coalesce(F.col("d2") > chi2_quantile(1 - reject, P), F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"), F.col("d2").alias("distance"),
    )
