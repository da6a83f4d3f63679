"""Personal data by weak supervision.

Strict patterns give the base spans. Looser patterns give further candidates; labelers
(pattern, checksum, gazetteer, context) vote on each of them. Expectation-maximisation over
the counts of vote patterns estimates how reliable each labeler is, and a logistic span
classifier is trained on the resulting probabilities; what it accepts is added.

Everything per document is SQL functions; the driver sees only a table of counts whose size
is bounded by the number of vote patterns and feature values (see :data:`CELLS`).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from newstide.workspace import stage

KINDS = ("email", "ip", "card", "phone")
# Possessive loops: they need no backtracking here, and Java runs them without recursion.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Candidates beyond the base: spelled-out addresses, numbers without plus or valid checksum.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|[\[(]at[\])])\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9+])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.])\(?[0-9]{2,4}\)?[\x20./-]?[0-9]{3,4}[\x20./-][0-9]{3,5}(?![0-9])",
}
# Gazetteers and context words; fixed values, in lower case.
DOMAINS = "com org net edu gov info io de fr es uk eu ch at it us".split()
DIALLING = "1 33 34 39 41 43 44 49 351 353".split()
CONTEXT = {
    "email": r"(?i)(mail|contact|write to|reach|courriel|correo|kontakt)",
    "ip": r"(?i)(\bip\b|address|host|server|from|adresse)",
    "card": r"(?i)(card|visa|master|amex|credit|carte|karte|tarjeta|payment)",
    "phone": r"(?i)(phone|tel|call|fax|mobile|cell|whatsapp|telefon|llame|appel)",
}
AGAINST = r"(?i)(isbn|issn|version|\bv\.?\s*$|order|invoice|article|page|no\.\s*$|\bid\b|#\s*$|https?://\S*$)"
NEAR = 30  # characters before a span that count as its context
VOTES = ("v_shape", "v_check", "v_gazette", "v_context")
FEATURES = ("f_seps", "f_digits", "f_long", "f_word")
#: At most so many distinct (kind, votes, features): the size of what reaches the driver.
CELLS = len(KINDS) * 3 ** len(VOTES) * 4 * 4 * 3 * 2

_SPAN = "array<struct<start:int,kind:int,stop:int,body:string>>"


def located(text: Column, pattern: str, kind: int) -> Column:
    """Matches of a pattern with their place, from the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("m"), between.alias("p"))
    span = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans")),
        lambda a, x: F.when(
            x["m"].isNull(), a
        ).otherwise(
            F.struct(
                (a["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
                F.concat(
                    a["spans"],
                    F.array(
                        F.struct(
                            (a["at"] + F.length(x["p"])).alias("start"),
                            F.lit(kind).alias("kind"),
                            (a["at"] + F.length(x["p"]) + F.length(x["m"])).alias("stop"),
                            x["m"].alias("body"),
                        )
                    ),
                ).cast(_SPAN).alias("spans"),
            )
        ),
        lambda a: a["spans"],
    )
    return span


def digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def luhn(body: Column) -> Column:
    def step(a, c):
        d = c.cast("int")
        twice = F.when(d >= 5, 2 * d - 9).otherwise(2 * d)
        return F.struct(
            (a["total"] + F.when(a["odd"], twice).otherwise(d)).alias("total"), (~a["odd"]).alias("odd")
        )

    start = F.struct(F.lit(0).alias("total"), F.lit(False).alias("odd"))
    return F.aggregate(F.split(F.reverse(digits(body)), ""), start, step, lambda a: a["total"] % 10 == 0)


def valid(kind: str, body: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(
            F.split(body, r"\."),
            lambda p: F.when(F.length(part(p)) <= 3, F.concat(F.lit("0"), part(p)).cast("int") <= 255).otherwise(False),
        )
    count = F.length(digits(body))
    if kind == "card":
        return F.when(count.between(12, 19), luhn(body)).otherwise(False)
    return count.between(9, 15) if kind == "phone" else F.lit(True)


def _is_valid(kind: str):
    return lambda span: valid(kind, span["body"])


def base_spans(text: Column) -> Column:
    """Strict spans of all kinds, in no order."""
    none = F.array().cast(_SPAN)
    found = []
    for number, kind in enumerate(KINDS):
        spans = F.filter(located(text, BASE[kind], number), _is_valid(kind))
        found.append(F.when(_worth_a_look(text, kind), spans).otherwise(none))
    return F.concat(*found)


def _worth_a_look(text: Column, kind: str) -> Column:
    """Cheap and necessary: most documents hold no such thing and skip the patterns."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    return F.contains(text, F.lit("+")) if kind == "phone" else F.rlike(text, F.lit("[0-9][0-9.\x20-]*[0-9]"))


def loose_spans(text: Column) -> Column:
    none = F.array().cast(_SPAN)
    found = []
    for kind, pattern in LOOSE.items():
        look = F.rlike(text, F.lit(r"@|[\[(]at[\])]")) if kind == "email" else F.rlike(text, F.lit("[0-9]{3}"))
        found.append(F.when(look, located(text, pattern, KINDS.index(kind))).otherwise(none))
    return F.concat(*found)


def _vote(good: Column, bad: Column | None = None) -> Column:
    against = F.lit(-1) if bad is None else F.when(bad, -1).otherwise(0)
    return F.when(good, 1).otherwise(against)


def _is_kind(number: int):
    return lambda span: span["kind"] == number


def _by_kind(span: Column, make) -> Column:
    choice = F.when(span["kind"] == 0, make("email"))
    for number, kind in enumerate(KINDS[1:], 1):
        choice = choice.when(span["kind"] == number, make(kind))
    return choice


def described(span: Column, text: Column, strict: Column) -> Column:
    """A span with the labelers' votes (1 for, -1 against, 0 none) and its features."""
    body = span["body"]
    first = F.greatest(span["start"] - NEAR, F.lit(0))
    before = F.substring(text, first + 1, span["start"] - first)
    number, last = digits(body), F.lower(F.regexp_extract(body, r"([A-Za-z0-9-]+)$", 1))

    def gazette(kind):
        if kind == "email":
            return _vote(last.isin(DOMAINS))
        if kind == "phone":
            codes = "|".join(DIALLING)
            return _vote(F.rlike(body, F.lit(rf"^\+({codes})")), F.rlike(body, F.lit(r"^(19|20)[0-9]{2}[-/.]")))
        if kind == "card":
            return _vote(F.rlike(number, F.lit("^(4|5[1-5]|3[47]|6011|65)")))
        return _vote(~F.rlike(body, F.lit(r"^(0|127|255)\.")))

    context = _by_kind(span, lambda k: F.when(F.rlike(before, F.lit(CONTEXT[k])), 1))
    seps = F.length(F.regexp_replace(body, "[A-Za-z0-9]", ""))
    return F.struct(
        span["start"].alias("start"),
        span["kind"].alias("kind"),
        span["stop"].alias("stop"),
        F.when(strict, 1).otherwise(0).alias("v_shape"),
        _vote(_by_kind(span, lambda k: valid(k, body) & ~F.rlike(body, F.lit(r"^([0-9])[^0-9]*(\1[^0-9]*)+$")))).alias("v_check"),
        _by_kind(span, gazette).alias("v_gazette"),
        F.coalesce(context, F.when(F.rlike(before, F.lit(AGAINST)), -1).otherwise(0)).alias("v_context"),
        F.least(seps, F.lit(3)).alias("f_seps"),
        F.least(F.floor(F.length(number) / 4), F.lit(3)).cast("int").alias("f_digits"),
        F.least(F.floor(F.length(body) / 10), F.lit(2)).cast("int").alias("f_long"),
        F.rlike(before, F.lit(r"[\p{L}\p{N}]$")).cast("int").alias("f_word"),
    )


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per document its base spans, and base and loose spans with votes and features."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key), whole.alias("_text"))
    rows = rows.select("*", base_spans(F.col("_text")).alias("base"), loose_spans(F.col("_text")).alias("loose"))
    new = F.filter(
        "loose",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])),
    )
    every = F.concat(
        F.transform("base", lambda s: described(s, F.col("_text"), F.lit(True))),
        F.transform(new, lambda s: described(s, F.col("_text"), F.lit(False))),
    )
    slim = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    return rows.select(key, slim.alias("base"), every.alias("spans"))


def reliabilities(kinds, votes, counts, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM for labelers of unknown accuracy, one class prior per kind.

    Gives the probability of every row being personal data, and each labeler's accuracy on
    either class. A vote of 0 says nothing.
    """
    prior = np.full(len(KINDS), 0.5)
    right = np.full((2, votes.shape[1]), 0.8)  # P(vote against | not), P(vote for | is)
    given = votes != 0
    for _ in range(rounds):
        yes = np.where(votes > 0, right[1], 1 - right[1])
        no = np.where(votes > 0, 1 - right[0], right[0])
        odds = np.log(prior[kinds] / (1 - prior[kinds])) + ((np.log(yes) - np.log(no)) * given).sum(1)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        for k in range(len(KINDS)):
            at = kinds == k
            prior[k] = ((p * counts)[at].sum() + 1) / (counts[at].sum() + 2)
        is_w, not_w = (p * counts)[:, None] * given, ((1 - p) * counts)[:, None] * given
        right[1] = ((is_w * (votes > 0)).sum(0) + 8) / (is_w.sum(0) + 10)
        right[0] = ((not_w * (votes < 0)).sum(0) + 8) / (not_w.sum(0) + 10)
        right = np.clip(right, 0.55, 0.995)  # labelers are taken to be better than chance
    return p, right


def design(kinds: np.ndarray, votes: np.ndarray, features: np.ndarray) -> np.ndarray:
    return np.hstack([np.eye(len(KINDS))[kinds], votes, features / 3.0])


def fit_classifier(x: np.ndarray, p: np.ndarray, counts: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on probabilities by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        mu = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (p - mu)) - ridge * w
        bend = (x * (counts * mu * (1 - mu))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(bend, slope)
    return w


def train(spans: DataFrame) -> np.ndarray:
    """Classifier weights from the counts of all candidates, whatever their number."""
    names = ["kind", *VOTES, *FEATURES]
    cells = spans.select(F.explode("spans").alias("s")).groupBy(*[F.col(f"s.{n}").alias(n) for n in names])
    rows = cells.agg(F.count(F.lit(1)).alias("n")).orderBy(*names).limit(CELLS).collect()
    table = np.array([[float(v) for v in r] for r in rows]).reshape(len(rows), len(names) + 1)
    kinds, votes = table[:, 0].astype(int), table[:, 1 : 1 + len(VOTES)]
    x = design(kinds, votes, table[:, 1 + len(VOTES) : -1])
    # A cell stands for all its spans: the result is that of all candidates one by one.
    p, _ = reliabilities(kinds, votes, table[:, -1])
    return fit_classifier(x, p, table[:, -1])


def score(span: Column, weights: np.ndarray) -> Column:
    w = [float(v) for v in weights]
    total = F.lit(0.0)
    for k in range(len(KINDS)):
        total = total + F.when(span["kind"] == k, w[k]).otherwise(0.0)
    for i, name in enumerate(VOTES):
        total = total + span[name] * w[len(KINDS) + i]
    for i, name in enumerate(FEATURES):
        total = total + span[name] * (w[len(KINDS) + len(VOTES) + i] / 3.0)
    return total


def spelled(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    )
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(ordered, one), ",")


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: base counts, digest of the base spans, and all spans, base and added.

    Spans are code points of the whole text, end exclusive. NULL is the empty text, repeated
    rows give a row each, an empty table gives an empty result; extra columns are not read.
    Nothing but the counts of vote patterns is shuffled.
    """
    found = stage(candidates(docs, key, text), "pii-candidates")
    weights = train(found)
    # The classifier decides, but never against the labelers' balance.
    balance = lambda s: s["v_check"] + s["v_gazette"] + s["v_context"]
    accepted = F.filter("spans", lambda s: (s["v_shape"] > 0) | ((score(s, weights) > 0) & (balance(s) > 0)))
    base = F.col("base")
    counts = [
        F.size(F.filter(base, _is_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)
    ]
    return found.select(
        key, *counts, F.sha2(spelled(base), 256).alias("base_sha256"), spelled(accepted).alias("spans"),
        (F.size(accepted) - F.size(base)).cast("long").alias("n_added"),
    )
