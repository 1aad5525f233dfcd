"""Text column expressions (P2, P5, P11, P16-P18, P20 without stemming)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tweetlake.functions.stopwords import STOP_WORDS

# java.util.StringTokenizer default delimiters: space, tab, newline, carriage return, form feed.
TOKENIZER_DELIMS = " \t\n\r\f"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_lines(col) -> Column:
    """Array of the text's lines (textFile semantics): lines end at ``\\n``, ``\\r\\n`` or ``\\r``, a final
    line break ends the last line and begins none, and the empty text has no lines.  Only texts
    with a ``\\r`` are rewritten; the split is on one character, which needs no pattern."""
    c = _c(col)
    ended = (F.when(F.endswith(c, F.lit("\r\n")), F.left(c, F.length(c) - 2))
             .when(F.endswith(c, F.lit("\n")) | F.endswith(c, F.lit("\r")), F.left(c, F.length(c) - 1)).otherwise(c))
    unix = F.replace(F.replace(ended, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.split(F.when(F.contains(c, F.lit("\r")), unix).otherwise(ended), "\n")
    return F.when(c == "", F.array().cast("array<string>")).otherwise(lines)


def split_on_space(col) -> Column:
    """``String.split(" ")`` (D1): trailing empty words dropped, leading/inner ones kept,
    the empty string gives one empty word and a spaces-only string gives none."""
    c = _c(col)
    return (F.when((c != "") & (F.rtrim(c) == ""), F.array().cast("array<string>"))
            .otherwise(F.split(F.rtrim(c), " ")))


def tokenize_whitespace(col) -> Column:
    """``StringTokenizer`` tokens (P18): maximal runs of non-delimiters, never empty."""
    return F.regexp_extract_all(_c(col), F.lit(r"[^ \t\n\r\f]+"), 0)


def remove_patterns(col, patterns: list[str]) -> Column:
    """Delete every match of each regex in order (P17; file order, D21)."""
    c = _c(col)
    for p in patterns:
        c = F.regexp_replace(c, p, "")
    return c


def prepare_line(col, case_sensitive: bool = True, skip_patterns: list[str] | None = None) -> Column:
    """Optional lower-casing (P16) followed by pattern removal."""
    c = _c(col)
    if not case_sensitive:
        c = F.lower(c)
    return remove_patterns(c, skip_patterns or [])


def longer_than(col, n: int = 2) -> Column:
    """Predicate: the line has more than ``n`` characters (P5)."""
    return F.length(_c(col)) > n


def strip_brackets(col) -> Column:
    """Trim, then remove ``[`` and ``]``."""
    return F.translate(F.trim(_c(col)), "[]", "")


def parse_numbers(col, trim: bool = True) -> Column:
    """Numeric text split on one space -> ``array<double>`` (S6, P12); without ``trim`` trailing
    empty pieces are dropped (D1).  ANSI casts fail on bad text."""
    pieces = F.split(F.trim(_c(col)), " ") if trim else split_on_space(col)
    return F.transform(pieces, lambda x: x.cast("double"))


def word_runs(col) -> Column:
    """Lower-cased runs of word characters ``[A-Za-z0-9_]`` (first step of P20)."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(r"[a-z0-9_]+"), 0)


def normalise_tokens(col, stop_words: list[str] | None = None) -> Column:
    """P20 without stemming: word runs, keep alphabetic runs of two or more letters, drop stop
    words; one copy per text in first-appearance order (``array_except`` keeps that order).  A run of
    letters between two characters outside words is such a run, so one pattern finds them."""
    words = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"(?<![a-z0-9_])[a-z]{2,}(?![a-z0-9_])"), 0)
    stops = STOP_WORDS if stop_words is None else stop_words
    return F.array_except(words, F.array(*[F.lit(s) for s in stops]).cast("array<string>"))


def join_tokens(col) -> Column:
    """Tokens as the reference's text field: each token followed by one space."""
    return F.concat(F.array_join(_c(col), " "), F.when(F.size(_c(col)) > 0, F.lit(" ")).otherwise(F.lit("")))
