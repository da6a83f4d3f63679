"""Text clean-up, tokens and containment tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The text that marks a legal form in a lower-cased name, and the
# pattern (a regular expression, so the dot stands for any character) then removed.
LEGAL_FORMS = [
    ("inc.", "Inc."),
    ("incorporated", "Incorporated"),
    ("corp.", "Corp."),
    ("corporation", "Corporation"),
    ("ltd.", "Ltd."),
    ("limited", "Limited"),
]


def strip_quotes(text: Column) -> Column:
    """Drop double quotes and backslashes."""
    return F.translate(text, '"\\', "")


def strip_commas(text: Column) -> Column:
    """Drop commas at both ends."""
    return F.btrim(text, F.lit(","))


def article_text(title: Column, text: Column, short_description: Column) -> Column:
    """The three text fields as one; NULL fields are left out."""
    return F.concat_ws(". ", title, text, short_description)


def clean_company_name(name: Column) -> Column:
    """Remove the first legal form found in ``name``.

    The test ignores case, the removal does not: ``ACME INC.`` stays as it is, and
    ``Incyte Inc.`` loses ``Incy`` as well.
    """
    lowered = F.lower(name)
    (marker, pattern), *others = LEGAL_FORMS
    cleaned = F.when(lowered.contains(marker), F.trim(F.regexp_replace(name, pattern, "")))
    for marker, pattern in others:
        cleaned = cleaned.when(
            lowered.contains(marker), F.trim(F.regexp_replace(name, pattern, ""))
        )
    return cleaned.otherwise(name)


def clean_company_name_strict(name: Column) -> Column:
    """Remove a legal form only as the last word, in any case, dot optional."""
    words = sorted({pattern.rstrip(".") for _, pattern in LEGAL_FORMS})
    return F.trim(F.regexp_replace(name, rf"(?i)[\s,]+(?:{'|'.join(words)})\.?\s*$", ""))


def keep_only(text: Column, characters: str) -> Column:
    """``text`` reduced to a character class.

    Joining the runs to keep takes a third of the time that replacing each unwanted
    character by nothing does.
    """
    return F.array_join(F.regexp_extract_all(text, F.lit(f"[{characters}]+"), F.lit(0)), "")


def _plain(text: Column) -> Column:
    return F.lower(keep_only(text, "A-Za-z0-9 "))


def plain_text(*fields: Column) -> Column:
    """Fields reduced to lower-case ASCII letters, digits and spaces, joined by a space.

    NULL only when every field is NULL.
    """
    present = reduce(lambda left, right: left | right, [f.isNotNull() for f in fields])
    return F.when(present, F.concat_ws(" ", *[_plain(field) for field in fields]))


def tokens_of(plain: Column) -> Column:
    """Tokens of :func:`plain_text`; consecutive spaces give empty tokens."""
    return F.split(plain, " ", -1)


def tokenize(*fields: Column) -> Column:
    """ASCII letter-and-digit tokens of the fields, in order."""
    return tokens_of(plain_text(*fields))


# A token never holds a space, so "some token contains p" is the same as "the
# space-joined tokens contain p" for every p without a space. One scan of the
# joined text then replaces a scan of every token.


def names_in_text(plain: Column, names: Column) -> Column:
    """Distinct names whose lower-case form lies inside one token, sorted."""
    found = F.filter(
        names, lambda n: plain.contains(F.lower(n)) & ~F.lower(n).contains(F.lit(" "))
    )
    return F.coalesce(F.array_sort(F.array_distinct(found)), F.array().cast("array<string>"))


def sectors_in_text(plain: Column, keywords: Column) -> Column:
    """Distinct sectors one of whose keywords has each part inside some token, sorted.

    ``keywords`` is an array of structs ``(sector, keyword)``.
    """
    found = F.filter(
        keywords,
        lambda k: F.forall(
            F.split(F.lower(k["keyword"]), " ", -1), lambda part: plain.contains(part)
        ),
    )
    sectors = F.transform(found, lambda k: k["sector"])
    return F.coalesce(F.array_sort(F.array_distinct(sectors)), F.array().cast("array<string>"))
