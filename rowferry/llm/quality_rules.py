"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every document gets counts of its whole text. A few ratios of them are signals. Per stratum and signal the strictest
useful cutoff is taken among those for which the labelled documents prove, by an exact binomial test, that at most
`risk / signals` of the good documents are rejected. The tests of all strata, signals and cutoffs share the error
probability `error` (Bonferroni), so with probability 1 - error every stratum loses at most `risk` of its good ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import SPACES, broadcast_if_small, log_gamma, split_words, store

RISK = 0.05
ERROR = 0.05
# a rejected good document weighs as much as this many rejected bad ones
GOOD_WEIGHT = 10
# ascending cutoffs by signal; a document is rejected above the cutoff chosen
CUTOFFS = {
    "symbol_ratio": [x / 40 for x in range(1, 41)],
    "dup_line_ratio": [x / 20 for x in range(1, 20)],
    "repeat_ratio": [x / 50 for x in range(1, 25)],
    "upper_ratio": [x / 20 for x in range(1, 20)],
    "long_words": [6 + x / 2 for x in range(1, 25)],
    "short_words": [-4 + x / 5 for x in range(0, 20)],
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50
# terms of a binomial tail that are summed: so many, and so many times the root of the number of draws; a term that many
# standard deviations below the first one is nothing in double precision
TAIL_TERMS, TAIL_WIDTH = 500, 40


def repeated_words(words: Column) -> Column:
    """Number of words in three-word windows that are found twice or more, the first included.

    Hashes of the windows are sorted with their places; equal neighbours are repeats. The one-element transforms bind
    a value once for the lambdas below them.
    """
    windows = F.transform(
        F.array(words),
        lambda w: F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        ),
    )
    found = F.transform(
        windows,
        lambda unsorted: F.transform(
            F.array(F.sort_array(unsorted)),
            lambda s: F.filter(
                s,
                lambda x, i: (F.get(s, i + 1)["h"] == x["h"]) | F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)),
            ),
        )[0],
    )[0]
    places = F.flatten(F.transform(found, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(F.size(F.array_distinct(places))).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """The frame with the counts, the base verdict and the signals in place of columns of those names."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    df = docs.withColumn("__words", split_words(F.col("text"))).withColumn("__lines", lines)
    joined = F.array_join("__words", "")
    df = df.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(joined).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("__words")),
            "__n_lines": F.size("__lines"),
            "__n_upper": F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", "")),
        }
    )
    words = F.greatest(F.col("n_words"), F.lit(1))
    df = df.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "symbol_ratio": F.col("n_symbols") / words,
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("__n_lines"), F.lit(1)),
            "repeat_ratio": F.col("n_repeat_words") / words,
            "upper_ratio": F.col("__n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
            "long_words": F.col("word_chars") / words,
            "short_words": -F.col("word_chars") / words,
        }
    )
    return df.drop("__words", "__lines", "__n_lines", "__n_upper")


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of Binomial(n, p), exact up to rounding below the mean; 1 from there on, an upper bound.

    Each term is a falling share of the one above it, and all terms that count in double precision are summed.
    """
    ratio = lambda i: i * (1 - p) / ((n - i + 1) * p)  # noqa: E731  of the term of i - 1 to that of i
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    width = F.ceil(F.sqrt(n.cast("double")) * TAIL_WIDTH) + TAIL_TERMS
    steps = F.sequence(F.lit(0), F.least(k.cast("long"), width).cast("int"))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] * ratio(k - j)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    folded = F.aggregate(steps, start, add)
    log_top = log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)
    log_top = log_top + k * F.ln(F.lit(p)) + (n - k) * F.ln(F.lit(1 - p))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.exp(log_top) * folded["total"], F.lit(1.0)))


def tests(measures: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK) -> DataFrame:
    """One row per stratum, signal and cutoff: good and bad documents, those rejected, and the binomial tail."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    marks = marks.agg(F.min("quality").alias("__quality"))
    known = measures.filter(~F.col("base_failed")).join(marks, "doc_id")
    placed = F.array(
        *(
            F.struct(
                F.lit(name).alias("signal"),
                sum((F.when(F.col(name) > c, 1).otherwise(0) for c in cuts), F.lit(0)).alias("place"),
            )
            for name, cuts in CUTOFFS.items()
        )
    )
    good = F.col("__quality") == 1
    counted = known.select(F.col(stratum).alias("stratum"), good.alias("good"), F.inline(placed))
    counted = counted.groupBy("stratum", "signal", "place").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    # a document with place p is rejected by the cutoffs numbered 0 to p - 1
    total = counted.groupBy("stratum", "signal").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    over = counted.withColumn("cut", F.explode(F.when(F.col("place") > 0, F.sequence(F.lit(0), F.col("place") - 1))))
    over = over.groupBy("stratum", "signal", "cut").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    grid = F.create_map(*(x for name, cuts in CUTOFFS.items() for x in (F.lit(name), F.array(*map(F.lit, cuts)))))
    every = total.withColumn("__cuts", F.element_at(grid, F.col("signal")))
    every = every.select("stratum", "signal", "n_good", "n_bad", F.posexplode("__cuts").alias("cut", "cutoff"))
    same = every.stratum.eqNullSafe(over.stratum) & (every.signal == over.signal) & (every.cut == over.cut)
    joined = every.join(over, same, "left").select(
        *(every[c] for c in every.columns),
        F.coalesce(over.good, F.lit(0)).alias("good"),
        F.coalesce(over.bad, F.lit(0)).alias("bad"),
    )
    return joined.withColumn("tail", binomial_tail(F.col("good"), F.col("n_good"), risk / len(CUTOFFS)))


def thresholds(tested: DataFrame, error: float = ERROR) -> DataFrame:
    """The cutoff by stratum and signal: the most useful of those whose test passes; none where no test passes."""
    every = tested.agg(F.count("*").alias("n_tests"))
    allowed = error / F.greatest(F.lit(every.first()["n_tests"]), F.lit(1))
    good = F.col("good") / F.greatest(F.col("n_good"), F.lit(1))
    use = F.col("bad") / F.greatest(F.col("n_bad"), F.lit(1)) - GOOD_WEIGHT * good
    passed = tested.filter(F.col("tail") <= allowed).withColumn("use", use).filter("use > 0")
    best = passed.groupBy("stratum", "signal").agg(F.max(F.struct("use", "cutoff")).alias("best"))
    pairs = F.map_from_entries(F.collect_list(F.struct("signal", "best.cutoff")))
    return best.groupBy("stratum").agg(pairs.alias("cutoffs"))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    stratum: str = "lang",
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """Counts, base_failed and kept for every row of `docs`, with the columns named in `carry`.

    docs: doc_id, text and the stratum; labels: doc_id and quality (1 good, 0 bad). Null texts count as empty, and empty
    ones fail the base rules. Null strata form one stratum of their own. Rows with a null doc_id and those without a
    label are judged but prove nothing; a document with several labels is good only if all say so. Repeated rows are
    judged alike. Without labels, or with too few, only the base rules reject. Carried columns that clash with an
    output column are replaced by it.
    """
    needed = dict.fromkeys([*carry, "doc_id", stratum, "text"])
    measures = measured(docs.select(*needed))
    kept_columns = dict.fromkeys([*carry, "doc_id", stratum, *COUNTS, "base_failed", *CUTOFFS])
    measures = store(measures.select(*kept_columns), "quality")
    cuts = store(thresholds(store(tests(measures, labels, stratum, risk)), error))
    chosen = cuts.select(F.col("stratum").alias("__stratum"), F.col("cutoffs").alias("__cutoffs"))
    joined = measures.join(broadcast_if_small(chosen), F.col(stratum).eqNullSafe(F.col("__stratum")), "left")
    rejects = [F.coalesce(F.col(s) > F.try_element_at("__cutoffs", F.lit(s)), F.lit(False)) for s in CUTOFFS]
    rejected = F.col("base_failed")
    for reject in rejects:
        rejected = rejected | reject
    out = dict.fromkeys([*(c for c in carry if c != "kept"), *COUNTS, "base_failed"])
    return joined.select(*out, (~rejected).alias("kept"))
