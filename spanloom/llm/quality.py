"""Quality rules with risk-controlled thresholds.

A rule compares one signal of a text with a cutoff. Cutoffs are not set by hand: for every stratum
(by default the language column) and rule the labelled documents show which cutoffs of a fixed
grid may be used. Cutoffs are tested from the laxest to the strictest; a cutoff is certified if,
were its true share of falsely rejected good documents ``alpha / rules`` or more, so few false
rejections as were seen would have a probability (exact binomial tail) of at most
``delta / (strata * rules)``. The first failure ends the sequence, so the tests inside a sequence
need no further correction, and the division by strata and rules holds for all of them
together (Bonferroni). So with probability 1 - delta at least, in every stratum all rules
together reject less than ``alpha`` of the good documents that pass the base rules.

Of the certified cutoffs the one is used that separates the labels best (share of bad rejected less
share of good rejected, the laxest of equals). A rule that separates nothing, or without a
certified cutoff, is off, as are all rules in a stratum without labels.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from spanloom.llm.tables import slices, text_of, values
from spanloom.staging import stage

ALPHA = 0.05
DELTA = 0.05
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words
WINDOW_WORDS = 5

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

#: Signal and grid of each rule, from the laxest cutoff to the strictest; a text is rejected if its
#: signal is above the cutoff.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / greatest(n_words, 1)", [i / 50 for i in range(150, 0, -1)]),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", [i / 100 for i in range(95, 0, -1)]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", [i / 200 for i in range(40, 0, -1)]),
    "long_words": ("word_chars / greatest(n_words, 1)", [i / 10 for i in range(200, 50, -1)]),
    "short_words": ("-word_chars / greatest(n_words, 1)", [-i / 10 for i in range(10, 50)]),
}

SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(words: list, size: int = WINDOW_WORDS) -> int:
    """Words in windows of ``size`` words that occur twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = reached = 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            end = start + size
            covered += end - max(start, reached)
            reached = end
    return covered


def signals(text: str) -> tuple[int, ...]:
    """``SIGNALS`` of a whole text; words end at the six ASCII white-space characters."""
    words = text.encode().split()
    seen: set[str] = set()
    lines = repeated = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            repeated += line in seen
            seen.add(line)
    chars = len(text) - sum(map(text.count, SPACES))
    return (
        len(words), chars, sum(map(text.count, SYMBOLS)), repeated, repeated_words(words), lines
    )


def document_signals(docs: DataFrame, stratum: str) -> DataFrame:
    """(doc_id, stratum, signals..., base_failed) for every document; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [signals(text_of(text)) for text in values(batch.column(2))]
            table = np.array(rows, dtype=np.int64).reshape(len(rows), len(SIGNALS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c) for c in table.T)],
                names=["doc_id", "stratum", *SIGNALS],
            )

    schema = "doc_id bigint, stratum string, " + ", ".join(f"{s} bigint" for s in SIGNALS)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), "text"
    ).mapInArrow(run, schema)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed)


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p)."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log((n - i[:-1]) / (i[:-1] + 1)))])
    logs += i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def choose_cutoff(
    grid: list[float], good: np.ndarray, bad: np.ndarray, alpha: float, delta: float
) -> float | None:
    """The cutoff of one rule in one stratum, None if the rule is off.

    ``good[i]`` and ``bad[i]`` are the labelled documents whose signal is above exactly the
    first i cutoffs that a rising signal passes, that is the i strictest.
    """
    n_good, n_bad = int(good.sum()), int(bad.sum())
    if not n_good or not n_bad:
        return None
    best, chosen = 0.0, None
    steps = len(grid)
    for place, cutoff in enumerate(grid):
        above = steps - place  # a signal above this cutoff is above so many at least
        false = int(good[above:].sum())
        if binomial_tail(n_good, false, alpha) > delta:
            break
        gain = bad[above:].sum() / n_bad - false / n_good
        if gain > best + 1e-12:
            best, chosen = gain, cutoff
    return chosen


def _passed(signal: Column, grid: list[float]) -> Column:
    """How many cutoffs of a grid a signal is above."""
    return F.aggregate(
        F.array(*[F.lit(g) for g in grid]), F.lit(0), lambda n, g: n + (signal > g).cast("int")
    )


def fit_cutoffs(
    found: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """(stratum, one nullable cutoff per rule) from document signals and (doc_id, quality) labels.

    A document with several labels is good if one of them says so; null labels and ids count
    for nothing. Only counts by stratum, rule and grid place are gathered.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") > 0).alias("good")
    )
    labelled = found.where("not base_failed").join(known, "doc_id")
    places = F.array(*[
        F.struct(F.lit(name).alias("rule"), _passed(F.expr(signal).cast("double"), grid).alias("place"))
        for name, (signal, grid) in RULES.items()
    ])
    counts = stage(
        labelled.select("stratum", "good", F.inline(places)).groupBy("stratum", "rule", "place")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")),
        "quality-counts",
    )
    strata = counts.select("stratum").distinct().count()
    each_alpha, each_delta = alpha / len(RULES), delta / max(strata, 1) / len(RULES)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        out = {"stratum": [rows["stratum"].iloc[0]]}
        for name, (_, grid) in RULES.items():
            good, bad = np.zeros((2, len(grid) + 1), dtype=np.int64)
            own = rows[rows["rule"] == name]
            np.add.at(good, own["place"].to_numpy(), own["good"].to_numpy())
            np.add.at(bad, own["place"].to_numpy(), own["bad"].to_numpy())
            out[name] = [choose_cutoff(grid, good, bad, each_alpha, each_delta)]
        return pd.DataFrame(out).astype({name: "float64" for name in RULES})

    schema = "stratum string, " + ", ".join(f"{name} double" for name in RULES)
    return counts.groupBy("stratum").applyInPandas(choose, schema)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    alpha: float = ALPHA,
    delta: float = DELTA,
) -> DataFrame:
    """doc_id, stratum, signals, base_failed, the cutoffs of the stratum, rejected_by and kept.

    Every document has one row; a null or empty text fails the base rules (too few words), a
    null stratum is one of its own, repeated rows are judged alike, no labels leave the base
    rules alone, and no documents give no rows. ``rejected_by`` lists the rules broken. Other
    columns are not read, so their names do not matter.
    """
    found = stage(document_signals(docs, stratum), "quality-signals")
    cutoffs = stage(fit_cutoffs(found, labels, alpha, delta), "quality-cutoffs")
    cutoffs = cutoffs.withColumnRenamed("stratum", "_stratum")
    joined = found.join(cutoffs, F.col("stratum").eqNullSafe(F.col("_stratum")), "left").drop("_stratum")
    broken = F.array_compact(F.array(*[
        F.when(F.expr(signal).cast("double") > F.col(name), F.lit(name))
        for name, (signal, _) in RULES.items()
    ]))
    judged = joined.withColumn("rejected_by", broken)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base verdict and verdict of every document."""
    return judge(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.concat_ws(",", "rejected_by").alias("rejected_by"),
    )
