"""Quality rules whose cutoffs are certified on labelled holdouts, in DataFrame functions alone.

Every document is measured once: words, characters in words, symbols, repeated
lines and words in repeated three-word windows. Five rules read a rate from
these on a fixed grid and reject a document whose rate lies above the rule's
cutoff. A hash of the document's id deals the labelled documents to two halves:

- on the tuning half a rule earns its place in a stratum (say a language) if, at
  the cutoff that would reject the allowed share of good documents, it rejects a
  larger share of bad ones;
- on the holdout half each placed rule gets the tightest cutoff whose exact
  binomial test still shows a false rejection rate of at most ``limit`` divided
  by the number of the stratum's rules. Cutoffs are nested, so testing them from
  the loosest on needs no correction among themselves; the tests of all strata
  and rules share the error probability ``risk`` in equal parts (Bonferroni).

Then with probability ``1 - risk`` over the holdout no stratum loses more than
``limit`` of its good documents to the rules. A stratum with too few good
holdout documents for the test gets no cutoff and loses nothing.

Defined results: a null text counts as empty (no words, so the base rule fails);
a null stratum value is a stratum of its own; documents of one id each get their
own row and verdict, while the calibration takes one row of a labelled id (the
least by measures); an id that labels rate several times is good if all its
ratings are; labels with a null id or quality are left out, a null ``toxic`` is
not toxic; empty tables give empty results or no cutoffs; further columns of
either table, whatever their names, play no part. Two different three-word
windows of one text are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapledger.functions.skew import salted_join
from snapledger.llm.common import written

#: Share of a stratum's good documents that the rules may reject.
LIMIT = 0.02
#: Probability that any stratum exceeds it.
RISK = 0.05
#: Least number of words, and the share of words in repeated windows that fails the base rule.
LEAST_WORDS = 50
MOST_REPEATED = 50
#: Steps of a rule's grid: rates in ten-thousandths, word lengths in hundredths.
STEPS = 10_000

WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = ("symbols", "dup_lines", "repeats", "long_words", "short_words")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_window_words(words: Column, n_words: Column) -> Column:
    """How many words lie in a three-word window that the text has at least twice.

    Windows are sorted by hash and place; equal neighbours give the places of
    repeated windows, and a running last place counts each word once.
    """

    def places(windows: Column) -> Column:
        """Places of repeated windows, ascending."""
        def ordered(s: Column) -> Column:
            nothing = F.array().cast("array<int>")
            pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
                               lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])).otherwise(nothing))
            return F.sort_array(F.array_distinct(F.flatten(pairs)))

        return let(F.sort_array(F.transform(windows, lambda h, p: F.struct(h.alias("h"), p.alias("p")))), ordered)

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"))
        return F.aggregate(at, start, step, lambda acc: acc["n"])

    def counted(windows: Column) -> Column:
        some = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(some, covered(places(windows))).otherwise(F.lit(0).cast("long"))

    hashes = let(words, lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - 2),
                                              lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1))))
    return F.when(n_words >= 3, let(hashes, counted)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """A struct of MEASURES (long) of a whole text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))

    def of_words(words: Column) -> Column:
        n = F.size(words).cast("long")
        return F.struct(n.alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        repeated_window_words(words, n).alias("n_repeat_words"))

    def whole(w: Column, several: Column) -> Column:
        n_lines = F.size(several).cast("long")
        return F.struct(
            w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"),
            F.length(F.regexp_replace(text, NOT_SYMBOL, "")).cast("long").alias("n_symbols"), n_lines.alias("n_lines"),
            (n_lines - F.size(F.array_distinct(several))).cast("long").alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"))

    found = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words)
    return let(found, lambda w: let(lines, lambda several: whole(w, several)))


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def rates() -> dict[str, Column]:
    """Each rule's rate on its grid, 0 to STEPS; a high one speaks against the document."""
    def share(part: str, whole: str, steps: int = STEPS) -> Column:
        return F.when(F.col(whole) > 0, F.expr(f"{steps} * {part} div {whole}")).otherwise(0).cast("long")

    length = F.least(share("word_chars", "n_words", 100), F.lit(STEPS).cast("long"))
    return {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words"), "long_words": length, "short_words": STEPS - length}


def stratum_of(columns: Sequence[str]) -> Column:
    """One string for the values of the stratum's columns; a null differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), F.regexp_replace(F.col(f"`{c}`").cast("string"), "([~=!])", "~$1")), F.lit("!")) for c in columns]
    return F.concat_ws("", *parts) if parts else F.lit("")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", strata: Sequence[str] = ("lang",)) -> DataFrame:
    """``key, stratum``, MEASURES, ``base_failed`` and the RULES' rates of every row, written once."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), stratum_of(strata).alias("stratum"), measures(F.col(f"`{text}`")).alias("m"))
    rows = rows.select("id", "stratum", "m.*")
    return written(rows.withColumn("base_failed", base_failed()).withColumns(rates()), "measured")


def rated(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``id, good, bad, holdout``: one row per rated id. Good means quality and nothing toxic."""
    told = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull())
    one = told.groupBy(F.col(key).alias("id")).agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    # The halves are dealt by the first digit of a digest, alike in every engine.
    holdout = F.substring(F.md5(F.col("id").cast("string")), 1, 1) >= "8"
    return one.select("id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"), (F.col("quality") == 0).alias("bad"), holdout.alias("holdout"))


def log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series, for x of 20 and more (error under 1e-13)."""
    return x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3))) + 1 / (1260 * F.pow(x, F.lit(5)))


def most_rejected(n: Column, share: Column, error: Column) -> Column:
    """Largest k with P(Binomial(n, share) <= k) <= error; null if there is none.

    Sums the exact probabilities in logarithms upwards from 0, or for large
    ``n * share`` from 12 standard deviations below it (what lies lower is under
    1e-30). k is below ``n * share``, where the sum passes one half.
    """
    mean = n * share
    low = F.floor(mean - 12 * F.sqrt(mean) - 40)
    first = F.when(low < 20, F.lit(0).cast("long")).otherwise(low)
    far = log_factorial(n.cast("double")) - log_factorial(first.cast("double")) - log_factorial((n - first).cast("double")) + first * F.log(share)
    begin = F.when(first == 0, n * F.log1p(-share)).otherwise(far + (n - first) * F.log1p(-share))
    none = F.lit(None).cast("long")

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] + F.when(k == first, 0.0).otherwise(F.log((n - k + 1) / k) + F.log(share) - F.log1p(-share))
        total = F.when(k == first, term).otherwise(acc["total"] + F.log1p(F.exp(term - acc["total"])))
        return F.struct(term.alias("term"), total.alias("total"), F.when(total <= F.log(error), k).otherwise(acc["best"]).alias("best"))

    start = F.struct(begin.alias("term"), begin.alias("total"), none.alias("best"))
    return F.when(n > 0, F.aggregate(F.sequence(first, F.ceil(mean)), start, step, lambda acc: acc["best"])).otherwise(none)


def cutoffs(rows: DataFrame, labels: DataFrame, limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """``stratum, rule, n_good, n_allowed, cut`` of every placed rule that the holdout certifies.

    ``rows`` comes from :func:`measured`, ``labels`` from :func:`rated`. The
    counts per stratum, rule and grid step are aggregated before any window, so
    a window sees at most STEPS + 1 rows, whatever the size of a stratum.
    """
    one = rows.groupBy("id").agg(F.min(F.struct("stratum", "base_failed", *RULES)).alias("r")).select("id", "r.*")
    judged = one.where(~F.col("base_failed")).join(labels, "id")
    each = judged.select("stratum", "good", "bad", "holdout", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("rate")) for r in RULES))).alias("x"))
    tells = {"tune_good": F.col("good") & ~F.col("holdout"), "tune_bad": F.col("bad") & ~F.col("holdout"), "hold_good": F.col("good") & F.col("holdout")}
    steps = written(each.groupBy("stratum", "x.rule", "x.rate").agg(*(F.count_if(c).alias(n) for n, c in tells.items())), "rates")
    group = Window.partitionBy("stratum", "rule")
    higher = group.orderBy(F.col("rate").desc()).rowsBetween(Window.unboundedPreceding, -1)
    above = steps.select("stratum", "rule", "rate", *(F.sum(n).over(group).alias(n) for n in tells),
                         *(F.coalesce(F.sum(n).over(higher), F.lit(0)).alias(f"{n}_above") for n in tells))
    tried = above.where(F.col("tune_good_above") <= F.floor(F.col("tune_good") * (limit / len(RULES))))
    tried = tried.groupBy("stratum", "rule").agg(F.min_by(F.struct("tune_good", "tune_bad", "tune_good_above", "tune_bad_above"), "rate").alias("t")).select("stratum", "rule", "t.*")
    placed = tried.where(F.col("tune_bad_above") * F.col("tune_good") > F.col("tune_good_above") * F.col("tune_bad")).select("stratum", "rule")
    tests = max(placed.count(), 1)
    shares = placed.withColumn("share", limit / F.count("*").over(Window.partitionBy("stratum")))
    tested = above.join(shares, ["stratum", "rule"]).groupBy("stratum", "rule").agg(
        F.max("hold_good").alias("n_good"), F.max("share").alias("share"), F.collect_list(F.struct("rate", "hold_good_above")).alias("grid"))
    bounded = tested.withColumn("n_allowed", most_rejected(F.col("n_good"), F.col("share"), F.lit(risk / tests))).where(F.col("n_allowed").isNotNull())
    fitting = F.filter("grid", lambda g: g["hold_good_above"] <= F.col("n_allowed"))
    return bounded.select("stratum", "rule", "n_good", "n_allowed", F.array_min(F.transform(fitting, lambda g: g["rate"])).alias("cut"))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    strata: Sequence[str] = ("lang",),
    limit: float = LIMIT,
    risk: float = RISK,
) -> DataFrame:
    """Measures and verdict of every row of ``docs``: ``key``, MEASURES, ``base_failed``,
    ``kept`` and ``failed`` (the rules above their cutoff, in the order of RULES).

    ``labels`` has ``doc_id, quality, toxic`` (0 or 1). A row that fails the base
    rule isn't kept; another one is kept unless a rule of its stratum rejects it.
    """
    rows = measured(docs, key, text, strata)
    told = cutoffs(rows, rated(labels), limit, risk)
    # One row per stratum: the salted join spreads a stratum that holds many documents.
    cuts = told.groupBy("stratum").agg(*(F.min(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES))
    met = salted_join(rows, cuts, ["stratum"], "left")
    failed = F.filter(F.array(*(F.when(F.col(r) > F.col(f"cut_{r}"), F.lit(r)) for r in RULES)), lambda r: r.isNotNull())
    return met.select(F.col("id").alias(key), *MEASURES, "base_failed", (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"), failed.alias("failed"))
