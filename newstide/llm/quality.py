"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Each document has a vector of transformed statistics. For every (language, source) the
minimum covariance determinant estimate is approached by concentration steps: from a start
at the medians, the share of documents nearest to the centre gives the next centre and
scatter. A document far from its group's centre, by Mahalanobis distance, is rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from newstide.llm.common import bounded_batches, row_batches
from newstide.workspace import stage

_SYMBOL = re.compile(rb"[#*$%&|<>]")
_SPACES = b" \t\n\x0b\x0c\r"
# Vector: log words, log mean word length, then square roots, which even out the spread of
# rare events, of symbols per character, doubled lines per word and repeated words per word.
# The floors are spreads that no group is taken to be narrower than.
FLOORS = (0.25, 0.07, 0.03, 0.05, 0.15)
D = len(FLOORS)
CHI2_MEDIAN = 4.351  # of D degrees of freedom
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 2_000_000:  # keep the product below within 63 bits
        _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """The five numbers of a text, words being runs of anything but ASCII white space."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blank = sum(data.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    lines = Counter(line for line in data.split(b"\n") if line.strip(_SPACES))
    repeated_lines = sum(lines.values()) - len(lines)
    symbols = len(_SYMBOL.findall(data))
    return len(words), len(text) - blank, symbols, repeated_lines, repeated_words(words)


def document_stats(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and the five statistics of every whole text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_batches(batches, 512):
            rows = [statistics(x or "") for x in batch.column(0).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], [*keep, *STATS])

    docs = bounded_batches(docs)
    shape = docs.select(*keep).schema
    for name in STATS:
        shape = shape.add(name, "long")
    return docs.select(F.col(text), *keep).mapInArrow(measure, shape)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return [
        F.log(words),
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / words),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


def _x(i: int) -> Column:
    return F.col(f"x{i}")


def distance() -> Column:
    """Squared Mahalanobis distance from the columns mu and inv."""
    off = [_x(i) - F.col("mu")[i] for i in range(D)]
    terms = [
        (1 if i == j else 2) * off[i] * off[j] * F.col("inv")[i * D + j] for i in range(D) for j in range(i, D)
    ]
    return sum(terms[1:], terms[0])


def grouped(rows: DataFrame, least: int) -> DataFrame:
    """Add ``grp``: language and source; where these have fewer than ``least`` rows, the
    language's small sources together; where these are still too few, all the rest."""
    small = Window.partitionBy("lang", (F.col("n") < least))
    names = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    lang = F.coalesce(F.concat(F.lit("l:"), F.col("lang")), F.lit("-"))
    source = F.coalesce(F.concat(F.lit(" s:"), F.col("source")), F.lit(" -"))
    names = names.withColumn("together", F.sum("n").over(small)).select(
        F.col("lang").alias("g_lang"),
        F.col("source").alias("g_source"),
        F.when(F.col("n") >= least, F.concat(lang, source))
        .when(F.col("together") >= least, lang)
        .otherwise("rest")
        .alias("grp"),
    )
    names = stage(names, "quality-groups")
    same = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    return rows.join(names, same).drop("g_lang", "g_source")


def _solve(floors: np.ndarray, scaled: bool):
    """Group rows (grp, n, means, products[, scale]) to centre and inverse scatter."""

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples():
                mu = np.asarray(row.mu, float)
                cov = np.asarray(row.products, float).reshape(D, D) - np.outer(mu, mu)
                cov = cov * (row.scale if scaled else 1.0) + np.diag(floors**2)
                out.append((row.grp, mu.tolist(), cov.ravel().tolist(), np.linalg.inv(cov).ravel().tolist()))
            yield pd.DataFrame(out, columns=["grp", "mu", "cov", "inv"])

    return solve


_PARAMS = "grp string, mu array<double>, cov array<double>, inv array<double>"


def _moments(rows: DataFrame) -> DataFrame:
    means = [F.avg(_x(i)) for i in range(D)]
    products = [F.avg(_x(min(i, j)) * _x(max(i, j))) for i in range(D) for j in range(D)]
    return rows.groupBy("grp").agg(F.array(*means).alias("mu"), F.array(*products).alias("products"))


def fit_mcd(rows: DataFrame, share: float = 0.75, steps: int = 3, accuracy: int = 10_000) -> DataFrame:
    """Centre and inverse scatter per group, from all rows (grp, x0..x4).

    Every step is two aggregations with partial sums: the quantile of the distances, then
    the moments of the nearer rows. A group of any size is a few numbers per task.
    """
    floors = np.asarray(FLOORS)
    center = [F.percentile_approx(_x(i), 0.5, accuracy) for i in range(D)]
    start = stage(rows.groupBy("grp").agg(F.array(*center).alias("mu")), "mcd-median")
    spread = [F.percentile_approx(F.abs(_x(i) - F.col("mu")[i]), 0.5, accuracy) for i in range(D)]
    mad = rows.join(start, "grp").groupBy("grp", "mu").agg(F.array(*spread).alias("mad"))
    diagonal = [
        (F.pow(F.col("mad")[i] * 1.4826, 2) if i == j else F.lit(0.0)) + F.col("mu")[i] * F.col("mu")[j]
        for i in range(D)
        for j in range(D)
    ]
    first = mad.select("grp", "mu", F.array(*diagonal).alias("products"))
    params = stage(first.mapInPandas(_solve(floors, False), _PARAMS), "mcd-params")
    for _ in range(steps):
        placed = rows.join(params, "grp").withColumn("d2", distance())
        cut = stage(
            placed.groupBy("grp").agg(F.percentile_approx("d2", share, accuracy).alias("cut")), "mcd-cut"
        )
        near = placed.join(cut, "grp").filter(F.col("d2") <= F.col("cut"))
        params = stage(_moments(near).mapInPandas(_solve(floors / 4, False), _PARAMS), "mcd-params")
    # The nearer rows understate the spread: scale it so that the median distance is right.
    middle = (
        rows.join(params, "grp")
        .groupBy("grp", "mu", "cov")
        .agg((F.percentile_approx(distance(), 0.5, accuracy) / CHI2_MEDIAN).alias("scale"))
    )
    back = [F.col("cov")[i * D + j] + F.col("mu")[i] * F.col("mu")[j] for i in range(D) for j in range(D)]
    middle = middle.select("grp", "mu", F.array(*back).alias("products"), F.greatest("scale", F.lit(1.0)).alias("scale"))
    return stage(middle.mapInPandas(_solve(floors, True), _PARAMS), "mcd-params").select("grp", "mu", "inv")


def judged(
    docs: DataFrame, keep: list[str], text: str = "text", cut: float = 50.0, least_group: int = 200
) -> DataFrame:
    """The columns ``keep``, the statistics, ``base_failed``, ``distance`` and ``kept``.

    Expects ``lang`` and ``source``. ``kept`` is false where a fixed limit fails or the
    squared distance from the group's centre exceeds ``cut``. Documents that fail a limit do
    not shape the estimates. NULL is the empty text, which fails; NULL languages and sources
    form groups; repeated rows count as often as they occur; an empty table gives an empty
    result.
    """
    group_by = [c for c in ("lang", "source") if c not in keep]
    rows = stage(
        document_stats(docs, [*keep, *group_by], text)
        .withColumn("base_failed", base_failed())
        .withColumns({f"x{i}": x for i, x in enumerate(vector())}),
        "quality-stats",
    )
    rows = grouped(rows, least_group)
    passed = rows.filter("NOT base_failed").select("grp", *[f"x{i}" for i in range(D)])
    params = fit_mcd(passed)
    placed = rows.join(params, "grp", "left").withColumn("distance", distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= F.lit(cut), F.lit(True))
    return placed.select(*keep, *STATS, "base_failed", "distance", kept.alias("kept"))


def quality_digest(docs: DataFrame) -> DataFrame:
    return judged(docs, ["doc_id", "lang", "source"])


def keep_good(docs: DataFrame) -> DataFrame:
    """Documents that pass; input columns only. A verdict depends on text, language and
    source alone, so the rejected are removed by these, the text standing by its digest."""
    marked = docs.withColumn("_digest", F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))
    verdict = judged(marked.select("text", "lang", "source", "_digest"), ["lang", "source", "_digest"])
    rejected = stage(
        verdict.filter("NOT kept")
        .select(*[F.col(c).alias(f"r_{c}") for c in ("lang", "source", "_digest")])
        .distinct(),
        "quality-rejected",
    )
    same = (F.col("_digest") == F.col("r__digest")) & F.col("lang").eqNullSafe(F.col("r_lang"))
    same &= F.col("source").eqNullSafe(F.col("r_source"))
    return marked.join(rejected, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
