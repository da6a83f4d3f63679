"""Lexicon sentiment per sentence, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from newstide.functions.text import keep_only


@dataclass(frozen=True)
class Lexicon:
    positive: tuple[str, ...]
    negative: tuple[str, ...]


ENGLISH = Lexicon(
    positive=(
        "advance", "beat", "beats", "benefit", "best", "better", "boost", "bullish",
        "confident", "exceed", "exceeds", "excellent", "gain", "gains", "good", "great",
        "grow", "growth", "high", "improve", "improved", "increase", "innovative", "lead",
        "opportunity", "optimistic", "outperform", "positive", "profit", "profitable",
        "rally", "rebound", "record", "recover", "recovery", "rise", "rises", "rising",
        "robust", "solid", "strong", "stronger", "success", "surge", "up", "upbeat",
        "upgrade", "upgraded", "win", "wins",
    ),
    negative=(
        "bad", "bankruptcy", "bearish", "concern", "crash", "crisis", "cut", "cuts",
        "debt", "decline", "declines", "default", "deficit", "down", "downgrade",
        "downgraded", "drop", "drops", "fail", "failed", "fall", "falls", "falling",
        "fear", "fraud", "lawsuit", "layoffs", "lose", "loss", "losses", "low", "miss",
        "missed", "negative", "plunge", "poor", "recall", "recession", "risk", "scandal",
        "slump", "sink", "struggle", "tumble", "uncertain", "warning", "weak", "weaker",
        "worse", "worst",
    ),
)


def sentence_scores(text: Column, lexicon: Lexicon = ENGLISH) -> Column:
    """Array of ``(result, confidence, pos)``, one per sentence that is not blank.

    ``confidence`` is |p - n| / (p + n) over the lexicon hits of the sentence.
    """
    # Everything but letters, digits, spaces and sentence ends goes in one pass.
    plain = F.lower(keep_only(text, r"A-Za-z0-9 .!?\n"))
    sentences = F.filter(F.split(plain, r"[.!?\n]+", -1), lambda s: F.trim(s) != "")
    words = F.transform(sentences, lambda s: F.split(s, " ", -1))
    hits = F.transform(
        words,
        lambda w, i: F.struct(
            F.size(F.filter(w, lambda x: x.isin(*lexicon.positive))).alias("p"),
            F.size(F.filter(w, lambda x: x.isin(*lexicon.negative))).alias("n"),
            i.alias("pos"),
        ),
    )

    def label(hit: Column) -> Column:
        p, n = hit["p"], hit["n"]
        return F.struct(
            F.when(p > n, "positive").when(p < n, "negative").otherwise("na").alias("result"),
            F.when(p + n > 0, F.abs(p - n) / (p + n)).otherwise(0.0).alias("confidence"),
            hit["pos"].alias("pos"),
        )

    return F.transform(hits, label)


def strongest(scores: Column) -> Column:
    """``(confidence, -pos, result)`` of the most confident entry, the earliest on ties."""
    return F.array_max(
        F.transform(
            scores,
            lambda s: F.struct(
                s["confidence"].cast("double").alias("confidence"),
                (-s["pos"]).alias("neg_pos"),
                s["result"].alias("result"),
            ),
        )
    )


def label_number(label: Column) -> Column:
    """1 for positive, -1 for negative, 0 for anything else."""
    return F.when(label == "positive", 1).when(label == "negative", -1).otherwise(0)


def signed_confidence(label: Column, confidence: Column) -> Column:
    """Confidence (text or number) with the sign of the label."""
    return label_number(label) * confidence.cast("double")
