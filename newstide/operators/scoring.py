"""Sentiment per article."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from newstide.functions.sentiment import (
    ENGLISH,
    Lexicon,
    sentence_scores,
    signed_confidence,
    strongest,
)
from newstide.functions.text import article_text


def add_sentiment(
    articles: DataFrame,
    lexicon: Lexicon = ENGLISH,
    scorer: Callable[[Column], Column] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add the signed confidence of the most confident sentence as ``sentiment``.

    Articles without any scored sentence are dropped. ``scorer`` maps the article
    text to an array of ``(result, confidence, pos)`` and replaces the lexicon.
    Everything happens within the row: no sort and no self-join.
    """
    keep = keep or ["title", "text", "short_description", "date"]
    scores = (scorer or (lambda text: sentence_scores(text, lexicon)))(
        article_text(F.col("title"), F.col("text"), F.col("short_description"))
    )
    # Exploding the one value makes it a computed column; a filter on a plain alias
    # would be pushed below and score the text a second time.
    return (
        articles
        .select(*keep, F.explode_outer(F.array(strongest(scores))).alias("_best"))
        .filter(F.col("_best").isNotNull())
        .select(
            *keep,
            signed_confidence(F.col("_best.result"), F.col("_best.confidence")).alias("sentiment"),
        )
    )
