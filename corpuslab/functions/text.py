"""Text Column expressions: stripping, matching, tokens and n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .columns import let

# The characters that count as white space when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Default token pattern in its documented form, and the same
# pattern in the regular expression dialect of the JVM.
DEFAULT_TOKEN_PATTERN = r"(?u)\b\w\w+\b"
WORD = r"\p{L}\p{N}_"
_DEFAULT_TOKEN_REGEX = rf"[{WORD}]{{2,}}"

_REGEX_META = set("\\^$.|?*+()[]{}-")


def strip(text: Column) -> Column:
    """Remove white space (all Unicode kinds) from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and all-white-space text."""
    return F.coalesce(F.length(strip(text)) == 0, F.lit(True))


def contains_ci(text: Column, needle: str) -> Column:
    """Case-insensitive substring test, null text gives false."""
    return F.coalesce(F.lower(text).contains(needle.lower()), F.lit(False))


def contains_any_ci(columns: Sequence[Column], keywords: Sequence[str]) -> Column:
    """True when any keyword is a case-insensitive substring of any column."""
    hit = F.lit(False)
    for column in columns:
        for keyword in keywords:
            hit = hit | contains_ci(column, keyword)
    return hit


def regex_escape(text: str) -> str:
    return "".join("\\" + c if c in _REGEX_META else c for c in text)


def term_regex(term: str) -> str:
    """Regular expression that finds ``term`` as a whole word or phrase.

    A trailing ``*`` makes it a word prefix. Words of a phrase may be separated
    by any run of white space. Matching is done on lower-cased text.
    """
    prefix = term.endswith("*")
    words = [regex_escape(w) for w in term.rstrip("*").lower().split()]
    end = "" if prefix else rf"([^{WORD}]|$)"
    return rf"(^|[^{WORD}])" + r"\s+".join(words) + end


def matches_term(lowered: Column, term: str) -> Column:
    """Whole-word match; plain substring tests come first since they are far cheaper."""
    hit = F.lit(True)
    for word in term.rstrip("*").lower().split():
        hit = hit & lowered.contains(word)
    return F.coalesce(hit & lowered.rlike(term_regex(term)), F.lit(False))


def snippet(text: Column, length: int = 300) -> Column:
    """Opening characters on one line, followed by an ellipsis."""
    return F.concat(F.translate(F.substring(text, 1, length), "\n", " "), F.lit("..."))


def token_regex(pattern: str) -> tuple[str, int]:
    """JVM regular expression and capture group for a token pattern."""
    if pattern == DEFAULT_TOKEN_PATTERN:
        return _DEFAULT_TOKEN_REGEX, 0
    body = pattern.replace("(?u)", "")
    has_group = any(
        c == "(" and body[i + 1 : i + 2] != "?" and (i == 0 or body[i - 1] != "\\")
        for i, c in enumerate(body)
    )
    return "(?U)" + body, int(has_group)


def tokens(
    text: Column,
    lowercase: bool = True,
    pattern: str = DEFAULT_TOKEN_PATTERN,
    stop_words: Sequence[str] | None = None,
) -> Column:
    """Array of tokens in text order; null text gives an empty array."""
    regex, group = token_regex(pattern)
    source = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(
        F.lower(source) if lowercase else source, F.lit(regex), F.lit(group)
    )
    if stop_words:
        stops = list(stop_words)
        found = F.filter(found, lambda t: ~t.isin(stops))
    return found


def ngrams(words: Column, low: int = 1, high: int = 1) -> Column:
    """Array of all n-grams with ``low <= n <= high``, words joined by a space."""
    if not 1 <= low <= high:
        raise ValueError(f"ngram range must satisfy 1 <= low <= high, got [{low}, {high}]")
    if (low, high) == (1, 1):
        return words
    return let(words, lambda w: F.concat(*[_grams_of(w, n) for n in range(low, high + 1)]))


def _grams_of(words: Column, n: int) -> Column:
    if n == 1:
        return words
    starts = F.when(
        F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of an array of terms, computed inside the row.

    Sorting the array puts equal terms side by side, so counting is a matter of
    finding where each run starts. No shuffle and no per-token row is needed.
    """

    def runs(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        positions = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            positions,
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, F.greatest(i - 1, F.lit(0)))),
        )
        return let(
            starts,
            lambda begin: F.transform(
                begin,
                lambda p, k: F.struct(
                    F.get(ordered, p).alias("term"),
                    (F.coalesce(F.get(begin, k + 1), F.size(ordered)) - p).cast("long").alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(terms), runs)
