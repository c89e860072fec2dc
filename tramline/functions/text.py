"""Text expressions: cleaning, tokens, pattern flags and mentions.

All of them are built-in Spark expressions; none needs a Python worker. NULL
text counts as "no text": empty arrays, zero counts, flags of 0.
"""

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline import fixed_values as fv

# Letters, digits and the underscore: what counts as inside a word. Spelled out
# because Java's \b and \s are ASCII-only unless told otherwise.
_WORD = r"[\p{L}\p{N}_]"
_BLANK = r"[\s\x1c-\x1f]"
_ALL = 2**31 - 1
_LITERALS_ONLY = re.compile(r"[^.^$*+?{}\[\]\\()]+")


def _or_empty(array: Column) -> Column:
    return F.coalesce(array, F.array().cast("array<string>"))


def strip_html(text: Column) -> Column:
    """Markup and `&nbsp;` become blanks, then each run of blanks one space. No trim."""
    no_tags = F.regexp_replace(text, "<[^>]+>", " ")
    no_entities = F.replace(no_tags, F.lit("&nbsp;"), F.lit(" "))
    # A lone space is already right; matching it would only copy it. Both branches are told
    # by their first character.
    return F.regexp_replace(no_entities, r"[\t\n\x0B\f\r]\s*| \s+", " ")


def _lowered(text: Column, lowered: bool) -> Column:
    return text if lowered else F.lower(text)


def tokens(text: Column, lowered: bool = False) -> Column:
    """Lower-cased words between blanks; no empty words."""
    return _or_empty(F.array_remove(F.split(_lowered(text, lowered), r"\s+"), ""))


def clean_tokens(clean: Column, lowered: bool = False) -> Column:
    """`tokens` for text that `strip_html` made: its only blank is the single space."""
    return _or_empty(F.array_remove(F.split(_lowered(clean, lowered), " "), ""))


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def length_band(words: Column) -> Column:
    """`short`, `medium` or `long` by number of words; NULL counts as 0."""
    count = F.coalesce(words, F.lit(0))
    bands = [F.when(count < bound, name) for name, bound in fv.LENGTH_BANDS]
    return F.coalesce(*bands, F.lit(fv.LONGEST_BAND))


def matches(text: Column, pattern: str, lowered: bool = False) -> Column:
    """Whether `pattern` occurs anywhere in the lower-cased text; never NULL.

    A plain alternation of words, such as `soir|nuit`, is tested by substring
    search; only a real regular expression starts the regex engine.
    """
    source = _lowered(text, lowered)
    if _LITERALS_ONLY.fullmatch(pattern):
        words = pattern.split("|")
        # A word that contains another one of the list adds nothing.
        needed = [w for w in words if not any(o != w and o in w for o in words)]
        found = reduce(or_, [F.contains(source, F.lit(word)) for word in needed])
    else:
        found = F.rlike(source, F.lit(pattern))
    return F.coalesce(found, F.lit(False))


def flag(text: Column, pattern: str, lowered: bool = False) -> Column:
    """`matches` as 0 or 1."""
    return matches(text, pattern, lowered).cast("int")


def _replace_in_each(array: Column, separator: str, pattern: str, replacement: str) -> Column:
    """Regex replacement in every element, none of which contains `separator`.

    Joins, replaces and splits instead of mapping a lambda, because lambdas keep
    their whole projection out of whole-stage code generation. NULL gives an
    empty array.
    """
    # An empty first element tells no elements from one empty element.
    marked = F.array_join(F.concat(F.array(F.lit("")), array), separator)
    edited = F.split(F.regexp_replace(marked, pattern, replacement), separator)
    return _or_empty(F.slice(edited, 2, _ALL))


def mode_mentions(text: Column, modes, letter_lines: bool = False, lowered: bool = False) -> Column:
    """Mentions such as `bus 12` of any of `modes`, in text order, repeats kept.

    Text is lower-cased first, so by default only numbered lines are found.
    `letter_lines` also finds single-letter lines a to e.
    """
    words = "|".join(modes)
    firsts = "".join(sorted({mode[0] for mode in modes}))
    line = r"\p{Nd}+"
    if letter_lines:
        line = rf"(?:\p{{Nd}}+|[a-e](?!{_WORD}))"
    # The leading lookahead rejects most positions by one character.
    pattern = rf"(?U)(?=[{firsts}])(?<!{_WORD})(?:{words})(?!{_WORD}){_BLANK}*{line}"
    mentions = F.regexp_extract_all(_lowered(text, lowered), F.lit(pattern), F.lit(0))
    return _replace_in_each(mentions, ",", rf"(?U){_BLANK}+", " ")


def transport_lines(text: Column, letter_lines: bool = False, lowered: bool = False) -> Column:
    return mode_mentions(text, fv.TRANSPORT_MODES, letter_lines, lowered)


def place_mentions(text: Column, prefix: str, lowered: bool = False) -> Column:
    """What follows each `prefix` up to the next punctuation mark, stripped."""
    pattern = f"{prefix}([^{fv.STATION_STOPPERS}]+)"
    names = F.regexp_extract_all(_lowered(text, lowered), F.lit(pattern), F.lit(1))
    # Names end at a comma, so none contains one.
    edges = rf"(?U)(?<![^,]){_BLANK}+|{_BLANK}+(?![^,])"
    return _replace_in_each(names, ",", edges, "")


def stations(text: Column, lowered: bool = False) -> Column:
    return place_mentions(text, fv.STATION_PREFIX, lowered)


def joined(array: Column) -> Column:
    return F.array_join(array, "|")
