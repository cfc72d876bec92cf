"""Quality rules: a threshold table compiled into one Spark projection.

Every statistic is a built-in expression over the row's own text (no user
function, no shuffle, no join), so the operator is a map over the scan and a
hot source, a long text or many copies change nothing about its plan.

Defined results: a null text is an empty one (0 words, base failed); repeated
rows are judged alike, each on its own; an empty table gives an empty result;
input columns with the names of result columns are replaced by them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, RESERVED, let, words_of

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by are this at from "
    "der die und den von zu das sich mit des auf für ist im nicht dem ein eine als "
    "de la le et les en un du une que est pour par dans avec qui pas sur au "
    "el y los las se del por con no una su para es al lo").split()
#: The forms counted: lower case or capitalised, bare or before a full stop or comma.
STOP_FORMS = tuple(dict.fromkeys(
    form + end for w in STOP_WORDS for form in (w, w.capitalize()) for end in ("", ".", ",")))


@dataclass(frozen=True)
class Threshold:
    """``low <= numerator / denominator <= high`` (a missing bound is open)."""
    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None


#: Ratios over words (at least 20 of them, by the base rule) and over lines with a word.
THRESHOLDS = (
    Threshold("mean_word_chars", "word_chars", "n_words", 2.5, 12.0),
    Threshold("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Threshold("stop_word_share", "n_stop_words", "n_words", 0.05, None),
    Threshold("duplicate_line_share", "n_dup_lines", "n_lines", None, 0.35),
    Threshold("bullet_line_share", "n_bullet_lines", "n_lines", None, 0.9),
    Threshold("ellipsis_line_share", "n_ellipsis_lines", "n_lines", None, 0.3),
)

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_STATS = ("n_stop_words", "n_lines", "n_bullet_lines", "n_ellipsis_lines")


def _repeated(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more.

    Sorted (hash, place) pairs put equal windows side by side; their places in
    order then add ``min(WINDOW, distance to the next)`` words each. Texts
    without a repeated window (nearly all) stop at the distinct count.
    """
    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.get(places, k + 1) - p))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def places(pairs: Column) -> Column:
        same = F.filter(pairs, lambda p, k: (
            F.coalesce(F.get(pairs, k - 1)["h"] == p["h"], F.lit(False))
            | F.coalesce(F.get(pairs, k + 1)["h"] == p["h"], F.lit(False))))
        return F.array_sort(F.transform(same, lambda p: p["i"]))

    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows),
                  let(let(pairs, places), covered)).otherwise(0)


def _statistics(docs: DataFrame, text: str) -> DataFrame:
    c = lambda name: f"{RESERVED}{name}"
    body = F.coalesce(F.col(text), F.lit(""))
    words, lines, hashes, windows = (F.col(c(x)) for x in ("words", "lines", "hashes", "windows"))
    count = lambda arr, test: F.size(F.filter(arr, test))
    # Each step is referenced several times by the next, so it stays a projection of its own
    # and is evaluated once a row.
    return (
        docs
        .withColumns({
            c("words"): words_of(F.col(text)),
            c("lines"): F.filter(F.split(body, "\n"), lambda x: x.rlike(NOT_SPACE)),
            c("symbols"): F.regexp_count(body, F.lit(SYMBOLS)),
        })
        .withColumn(c("hashes"), F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn(c("windows"), F.when(
            F.size(hashes) >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW),
                        lambda i: F.xxhash64(*[hashes[i + k] for k in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>")))
        .withColumns({
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.col(c("symbols")).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": _repeated(windows).cast("long"),
            "n_stop_words": count(words, lambda w: w.isin(*STOP_FORMS)).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_bullet_lines": count(lines, lambda x: x.rlike(r"^\s*[-*•]")).cast("long"),
            "n_ellipsis_lines": count(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$")).cast("long"),
        })
        .drop(*(c(x) for x in ("words", "lines", "symbols", "hashes", "windows")))
    )


def _broken(rule: Threshold) -> Column:
    ratio = F.col(rule.numerator) / F.when(F.col(rule.denominator) > 0, F.col(rule.denominator))
    tests = ([ratio < rule.low] if rule.low is not None else []) \
        + ([ratio > rule.high] if rule.high is not None else [])
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return F.coalesce(out, F.lit(False))


def judge(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``kept`` and ``failed_rules``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated
    8-word windows. ``kept``: not base-failed and no threshold broken;
    ``failed_rules`` names the broken ones (empty string: none).
    """
    # Always true, but not deterministic to the optimizer: a filter on ``kept`` is not pushed
    # below the statistics, where it would repeat their expressions for every reference.
    fence = F.monotonically_increasing_id() >= 0
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    failed = F.array_join(F.array_compact(F.array(
        *[F.when(_broken(t), F.lit(t.name)) for t in thresholds])), ",") if thresholds else F.lit("")
    return (
        _statistics(docs, text)
        .withColumns({"base_failed": base, "failed_rules": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "") & fence)
    )


def keep_good(docs: DataFrame, text: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns unchanged."""
    names = [f"{RESERVED}in_{i}" for i in range(len(docs.columns))]
    judged = judge(docs.select(*[F.col(f"`{n}`").alias(a) for n, a in zip(docs.columns, names)]),
                   names[docs.columns.index(text)], thresholds)
    return judged.where("kept").select(*[F.col(a).alias(n) for n, a in zip(docs.columns, names)])
