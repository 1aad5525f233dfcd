"""English stemming (P20): the second Porter algorithm as column expressions.

The rules are those of the published Snowball definition of English.  A word's two regions are
found once, as positions; every step then is a chain of "ends with this suffix, longest first",
so nothing leaves the JVM.  Stemming costs some dozens of comparisons a word, so it is meant for
a table of *distinct* words that is joined back (``operators.normalise``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words with stems of their own, and words that stay as they are, at the start or after step 1a.
SPECIAL = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
           "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
           "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes"}
STAY = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
# Beginnings after which the first region starts.
BEGINNINGS = ["gener", "commun", "arsen"]
# Suffixes of steps 2 to 4 with what replaces them, longest first; a third entry is
# what must stand before the suffix.
STEP2 = [("ational", "ate", ""), ("fulness", "ful", ""), ("ousness", "ous", ""), ("iveness", "ive", ""), ("ization", "ize", ""),
         ("tional", "tion", ""), ("biliti", "ble", ""), ("lessli", "less", ""), ("entli", "ent", ""), ("ation", "ate", ""),
         ("alism", "al", ""), ("aliti", "al", ""), ("ousli", "ous", ""), ("iviti", "ive", ""), ("fulli", "ful", ""),
         ("enci", "ence", ""), ("anci", "ance", ""), ("abli", "able", ""), ("izer", "ize", ""), ("ator", "ate", ""),
         ("alli", "al", ""), ("bli", "ble", ""), ("ogi", "og", "l"), ("li", "", "cdeghkmnrt")]
STEP3 = [("ational", "ate", ""), ("tional", "tion", ""), ("alize", "al", ""), ("icate", "ic", ""), ("iciti", "ic", ""),
         ("ative", "", ""), ("ical", "ic", ""), ("ness", "", ""), ("ful", "", "")]
STEP4 = [("ement", "", ""), ("ance", "", ""), ("ence", "", ""), ("able", "", ""), ("ible", "", ""), ("ment", "", ""),
         ("ant", "", ""), ("ent", "", ""), ("ism", "", ""), ("ate", "", ""), ("iti", "", ""), ("ous", "", ""), ("ive", "", ""),
         ("ize", "", ""), ("ion", "", "st"), ("al", "", ""), ("er", "", ""), ("ic", "", "")]
VOWELS = "aeiouy"
REGION = f"[^{VOWELS}]*[{VOWELS}]+[^{VOWELS}]"
SHORT_END = f"([^{VOWELS}][{VOWELS}][^{VOWELS}wxY]|^[{VOWELS}][^{VOWELS}])$"


def _without(w: Column, n: int) -> Column:
    """The word less its last ``n`` letters."""
    return F.left(w, F.length(w) - F.lit(n))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _first_region(w: Column) -> Column:
    """Where the first region begins: after the first vowel and consonant (word's length: nowhere)."""
    found = F.length(F.regexp_extract(w, f"^{REGION}", 0))
    start = F.when(found == 0, F.length(w)).otherwise(found)
    for b in BEGINNINGS:
        start = F.when(w.startswith(b), F.lit(len(b))).otherwise(start)
    return start


def _second_region(w: Column, first: Column) -> Column:
    found = F.length(F.regexp_extract(F.substr(w, first + 1), f"^{REGION}", 0))
    return F.when(found == 0, F.length(w)).otherwise(first + found)


def _plurals(w: Column) -> Column:
    return (F.when(w.endswith("sses"), _without(w, 2))
            .when(w.rlike("(ied|ies)$"), F.when(F.length(w) > 4, _without(w, 2)).otherwise(_without(w, 1)))
            .when(w.rlike("(us|ss)$"), w)
            .when(w.rlike(f"[{VOWELS}].+s$"), _without(w, 1)).otherwise(w))


def _past_and_ing(w: Column, first: Column) -> Column:
    """Step 1b: ``eed`` is shortened; ``ed``, ``ing`` and their ``ly`` go and the word is mended."""
    bare_eed = F.regexp_replace(w, "eed(ly)?$", "")
    bare = F.regexp_replace(w, "(ing|ed)(ly)?$", "")
    return (F.when(w.rlike("eed(ly)?$"), F.when(F.length(bare_eed) >= first, F.concat(bare_eed, F.lit("ee"))).otherwise(w))
            .when(w.rlike(f"[{VOWELS}].*(ing|ed)(ly)?$"), _bound(bare, lambda x: _mended(x, first))).otherwise(w))


def _mended(w: Column, first: Column) -> Column:
    """A word that lost its ending: an ``e`` again, or one letter of a double less."""
    short = (F.length(w) <= first) & w.rlike(SHORT_END)
    return (F.when(w.rlike("(at|bl|iz)$"), F.concat(w, F.lit("e")))
            .when(w.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), _without(w, 1))
            .when(short, F.concat(w, F.lit("e"))).otherwise(w))


def _suffixes(w: Column, rules: list[tuple[str, str, str]], start: Column, starts: dict[str, Column] | None = None) -> Column:
    """The longest suffix is replaced if it lies in its region (and stands after the right letter)."""
    out = w
    for suffix, put, after in reversed(rules):
        inside = F.length(w) - F.lit(len(suffix)) >= (starts or {}).get(suffix, start)
        if after:
            inside = inside & w.rlike(f"[{after}]{suffix}$")
        out = F.when(w.endswith(suffix), F.when(inside, F.concat(_without(w, len(suffix)), F.lit(put))).otherwise(w)).otherwise(out)
    return out


def _last_letters(w: Column, first: Column, second: Column) -> Column:
    at = F.length(w) - 1
    bare = _without(w, 1)
    return (F.when(w.endswith("e"), F.when((at >= second) | ((at >= first) & ~bare.rlike(SHORT_END)), bare).otherwise(w))
            .when(w.endswith("ll") & (at >= second), bare).otherwise(w))


def _y_to_i(w: Column) -> Column:
    return F.when(w.rlike(f".[^{VOWELS}][yY]$"), F.concat(_without(w, 1), F.lit("i"))).otherwise(w)


def _steps(w: Column, first: Column, second: Column) -> Column:
    """Everything after step 1a."""
    rest = (lambda x: _past_and_ing(x, first), _y_to_i, lambda x: _suffixes(x, STEP2, first),
            lambda x: _suffixes(x, STEP3, first, {"ative": second}), lambda x: _suffixes(x, STEP4, second),
            lambda x: _last_letters(x, first, second))
    for step in rest:
        w = _bound(w, step)
    return F.translate(w, "Y", "y")


def stem(col) -> Column:
    """The stem of a lower-case word of a-z; words of one or two letters stay as they are."""
    word = F.col(col) if isinstance(col, str) else col
    marked = F.regexp_replace(F.regexp_replace(word, "^y", "Y"), f"([{VOWELS}])y", "$1Y")
    special = F.try_element_at(F.create_map(*[F.lit(x) for pair in SPECIAL.items() for x in pair]), word)
    singular = lambda w, first, second: _bound(_plurals(w), lambda x: F.when(x.isin(STAY), x).otherwise(_steps(x, first, second)))
    whole = _bound(marked, lambda w: _bound(_first_region(w), lambda first: _bound(
        _second_region(w, first), lambda second: singular(w, first, second))))
    return F.when(F.length(word) <= 2, word).otherwise(F.coalesce(special, whole))


def stem_table(words: DataFrame, col: str = "token", out: str = "stem") -> DataFrame:
    """``(col, out)``: every distinct word once, with its stem."""
    return words.select(col).distinct().withColumn(out, stem(col))
