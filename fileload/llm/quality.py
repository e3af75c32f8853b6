"""Quality rules with risk-controlled thresholds, natively.

A few rates of each text are held against cutoffs.  Which cutoff of a fixed grid a
stratum uses is decided on labelled documents: a cutoff is safe if the exact binomial
test rejects that it turns away a share ``risk`` or more of the good documents of the
stratum.  All tests of all strata together keep the error ``delta`` (Bonferroni), so
with probability 1 - delta every chosen cutoff is within its risk.  Of the safe
cutoffs, the one that turns away most labelled bad documents is taken, the most
lenient of equals.  The risk of a stratum is shared out between its rules.

Cases: null and empty texts have no words and fail the base rule; null labels and
labels of no document are left out; without enough labels a stratum has no cutoff and
only the base rule acts; strata beyond the MAX_STRATA with most labels, and null ones,
form one stratum; repeated rows get equal verdicts; input columns named like a result
column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fileload.llm.text import col, without
from fileload.session import stage_table

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Share of good documents of a stratum that all rules together may turn away, and
#: the chance that any of the chosen cutoffs breaks its part of it.
RISK, DELTA = 0.02, 0.05
MAX_STRATA = 64
OTHER = "(other)"

#: The grid of cutoffs of each rate; a document is turned away above it.
GRID = {
    "symbols_per_word": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8, 1.2, 2.0, 3.0),
    "dup_lines_per_line": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9),
    "repeats_per_word": (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45),
    "word_length": (6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0),
}


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words in three-word windows that the text has twice or more: the windows'
    hashes are sorted with their places, so that equal ones stand together."""

    def windows(w: Column) -> Column:
        return F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )

    def places(s: Column) -> Column:
        def same(x: Column, j: Column) -> Column:
            return F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        # A window adds three words, fewer where the next one overlaps it.
        gaps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda n, g: n + g)

    return let(words, lambda w: let(F.sort_array(windows(w)), lambda s: let(places(s), covered)))


def text_facts(text: Column) -> dict[str, Column]:
    """Counts over a whole text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+", -1), lambda x: x != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeats"))

    return {
        "__words": let(words, of_words),
        "__lines": let(lines, of_lines),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
    }


FACTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs``, without the text, with FACTS."""
    facts = text_facts(col(text_col))
    keep = [c for c in without(docs.columns, list(FACTS)) if c != text_col]
    # The facts are made once; what is read out of them below must not repeat them.
    made = docs.select(*(col(c) for c in keep), F.explode(F.array(F.struct(*(v.alias(k) for k, v in facts.items())))).alias("__f"))
    return made.select(
        *(col(c) for c in keep),
        F.col("__f.__words.n").alias("n_words"),
        F.col("__f.word_chars"),
        F.col("__f.n_symbols"),
        F.col("__f.__lines.n").alias("n_lines"),
        F.col("__f.__lines.dup").alias("n_dup_lines"),
        F.col("__f.__words.repeats").alias("n_repeat_words"),
    )


def rates() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_lines_per_line": F.col("n_dup_lines") / lines,
        "repeats_per_word": F.col("n_repeat_words") / words,
        "word_length": F.col("word_chars") / words,
    }


def _log_gamma(x: Column) -> Column:
    """For x >= 1: Stirling's series at x + 8, and back by the recurrence."""
    z = x + 8
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, 5))
    down = F.log(x)
    for i in range(1, 8):
        down = down + F.log(x + i)
    return series - down


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p) and k below n p: its largest term, times the
    sum of the falling ones before it relative to that term."""
    k, n = k.cast("double"), n.cast("double")
    log_term = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log(1 - p)
    # Beyond so many steps terms are below 1e-300 of the first.
    steps = F.least(k, F.ceil(60 * F.sqrt(n)) + 100).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * (k - i + 1) * (1 - p) / ((n - k + i) * p)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    steps_of = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.least(F.exp(log_term) * F.aggregate(steps_of, start, step, lambda a: a["sum"]), F.lit(1.0))


def choose_cutoffs(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``stratum, rate, cutoff`` of the safe cutoffs chosen, from FACTS, ``stratum``
    and ``good`` (1 or 0) of labelled documents.  One row for each stratum and kind
    of label is shuffled."""
    values = rates()
    sums = [F.sum((values[r] > c).cast("long")).alias(f"{r}_{i}") for r, grid in GRID.items() for i, c in enumerate(grid)]
    counts = labelled.groupBy("stratum", "good").agg(F.count("*").alias("n"), *sums)
    cells = F.array(*(F.struct(F.lit(r).alias("rate"), F.lit(c).alias("cutoff"), F.col(f"{r}_{i}").alias("away")) for r, grid in GRID.items() for i, c in enumerate(grid)))
    cells = counts.select("stratum", "good", "n", F.inline(cells)).groupBy("stratum", "rate", "cutoff").agg(
        F.coalesce(F.sum(F.when(F.col("good") == 1, F.col("n"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("good") == 1, F.col("away"))), F.lit(0)).alias("k"),
        F.coalesce(F.sum(F.when(F.col("good") == 0, F.col("away"))), F.lit(0)).alias("bad_away"),
    )
    own = risk / len(GRID)
    tests = (MAX_STRATA + 1) * sum(map(len, GRID.values()))
    below = F.col("k") < F.col("n") * own
    p = F.when(below, binomial_cdf(F.when(below, F.col("k")).otherwise(0), F.greatest("n", F.lit(1)), own)).otherwise(1.0)
    safe = cells.where(p <= delta / tests).where("bad_away > 0")
    best = F.max(F.struct("bad_away", "cutoff"))
    return safe.groupBy("stratum", "rate").agg(best.alias("best")).select("stratum", "rate", F.col("best.cutoff").alias("cutoff"))


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """``docs``, without the text, with FACTS, ``base_failed`` (fewer than 50 words, or
    more than half of them repeated) and ``kept``."""
    keep = [c for c in without(docs.columns, [*FACTS, "base_failed", "kept"]) if c != text_col]
    rows = docs.select(
        *(col(c) for c in keep), col(id_col).alias("__id"), col(stratum).cast("string").alias("__stratum"), col(text_col).alias("__text")
    )
    facts = stage_table(measure(rows, text_col="__text"), "facts")
    known = labels.where(col(label_col).isNotNull()).select(col(id_col).alias("__id"), (col(label_col) > 0).cast("int").alias("good"))
    labelled = stage_table(facts.select("__id", "__stratum", *FACTS).join(known, "__id"), "labelled")
    top = labelled.where("__stratum is not null").groupBy("__stratum").count().orderBy(F.desc("count"), "__stratum").limit(MAX_STRATA)
    named = [r[0] for r in top.select("__stratum").collect()]
    of = F.when(F.col("__stratum").isin(named), F.col("__stratum")).otherwise(OTHER) if named else F.lit(OTHER)
    chosen = choose_cutoffs(labelled.withColumn("stratum", of), risk, delta).collect()  # a row per stratum and rate
    away = F.lit(False)
    for rate, value in rates().items():
        cutoffs = [x for r in chosen if r["rate"] == rate for x in (F.lit(r["stratum"]), F.lit(r["cutoff"]))]
        if cutoffs:
            away = away | F.coalesce(value > F.element_at(F.create_map(*cutoffs), of), F.lit(False))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return facts.select(*(col(c) for c in keep), *FACTS, failed.alias("base_failed"), (~failed & ~away).alias("kept"))
