"""Comment text to tokens and n-grams, as native column expressions.

Every function takes a column and returns a column, stays inside the JVM and
needs no shuffle. A NULL text is treated as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The punctuation marks that are tokens of their own.
PUNCTUATION = (",", ".", "!", "?", ";", ":")

# The characters Unicode-aware splitting treats as white space.
WHITESPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F\x20\x85\xA0\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Letters, decimal digits, and the digits outside category Nd
# (superscripts, subscripts, circled and historic digits).
_LATIN_DIGITS = r"\x{B2}\x{B3}\x{B9}"
_FURTHER_DIGITS = (
    r"\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}"
    r"\x{24EA}\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}"
    r"\x{278A}-\x{2792}\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}"
    r"\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
ALPHANUMERIC = rf"\p{{L}}\p{{Nd}}{_LATIN_DIGITS}{_FURTHER_DIGITS}"

# What counts as a link; it runs up to the next white space.
URL_PATTERN = rf"(?:https?://|www\.)[^{WHITESPACE}]+"

_MARKS = "".join(PUNCTUATION)

# One pass finds every token: a punctuation mark, or the stretch from the first
# to the last alphanumeric of a run. The quantifiers are possessive, so the
# matcher never backtracks. Most characters are ASCII letters, which a short class
# of their own takes; the others meet the classes of Unicode, which ask for the long
# list of rare digits only within their range. Most words end at a space, comma or full stop,
# which are looked for before the long class of what may stand inside a word.
_WORD_CHARACTER = rf"[\p{{L}}\p{{Nd}}{_LATIN_DIGITS}[\x{{1369}}-\x{{1F10A}}&&[{_FURTHER_DIGITS}]]]"
_WORD_CHARACTERS = rf"(?:[a-z]++|{_WORD_CHARACTER}++)++"
_WORD_PATTERN = (
    rf"{_WORD_CHARACTERS}(?:(?![\x20,.])[^{WHITESPACE}{_MARKS}{ALPHANUMERIC}]++{_WORD_CHARACTERS})*+"
)
_TOKEN_PATTERN = rf"{_WORD_PATTERN}|[{_MARKS}]"


def normalize(text: Column) -> Column:
    """Turn newlines and tabs into spaces and drop square brackets."""
    for old, new in (("\n", " "), ("\t", " "), ("[", ""), ("]", "")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def strip_urls(text: Column) -> Column:
    """Delete links, each up to the next white space."""
    # Few texts have one; the others are not searched by the pattern.
    linked = text.contains("http") | text.contains("www.")
    return F.when(linked, F.regexp_replace(text, URL_PATTERN, "")).otherwise(text)


def collapse_spaces(text: Column) -> Column:
    """Join the white-space separated parts of a text by single spaces."""
    return F.trim(F.regexp_replace(text, f"[{WHITESPACE}]+", " "))


def isolate_punct(text: Column) -> Column:
    """Put a space on both sides of every punctuation mark."""
    return F.regexp_replace(text, f"[{_MARKS}]", " $0 ")


def _extract(text: Column, pattern: str) -> Column:
    clean = strip_urls(normalize(F.coalesce(text, F.lit(""))))
    return F.regexp_extract_all(clean, F.lit(pattern), F.lit(0))


def tokens(text: Column) -> Column:
    """Array of tokens in their own case, punctuation marks included."""
    return _extract(text, _TOKEN_PATTERN)


def parsed_text(text: Column) -> Column:
    """Lower-case tokens, punctuation marks included, joined by spaces."""
    return F.lower(F.array_join(tokens(text), " "))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    A column named several times in a higher-order function is otherwise
    computed again for each mention.
    """
    return F.transform(F.array(value), body)[0]


def _words(parsed: Column) -> Column:
    """Tokens of a parsed text, with NULL in place of each punctuation mark."""
    return F.transform(
        F.split(parsed, " "),
        lambda token: F.when(~token.isin("", *PUNCTUATION), token),
    )


def _append_next(grams: Column, words: Column, offset: int) -> Column:
    """Join each n-gram to the word ``offset`` places on; NULL if either is NULL."""
    later = F.slice(words, offset + 1, F.size(words))
    return F.zip_with(grams, later, lambda gram, word: F.concat(gram, F.lit("_"), word))


def _bigrams_of(words: Column) -> Column:
    return _append_next(words, words, 1)


def unigrams(text: Column) -> Column:
    """Tokens that are not punctuation."""
    words = F.lower(F.array_join(_extract(text, _WORD_PATTERN), " "))
    return F.array_remove(F.split(words, " "), "")


def bigrams(text: Column) -> Column:
    """Adjacent word pairs with no punctuation between them."""
    return F.array_compact(bind(_words(parsed_text(text)), _bigrams_of))


def trigrams(text: Column) -> Column:
    """Adjacent word triples with no punctuation between them."""
    return F.array_compact(
        bind(_words(parsed_text(text)), lambda words: _append_next(_bigrams_of(words), words, 2))
    )


def ngrams(text: Column) -> Column:
    """Unigrams, then bigrams, then trigrams; duplicates kept."""
    return bind(
        _words(parsed_text(text)),
        lambda words: bind(
            _bigrams_of(words),
            lambda pairs: F.array_compact(F.concat(words, pairs, _append_next(pairs, words, 2))),
        ),
    )


def sanitize(text: Column) -> Column:
    """Struct of four strings: parsed text, unigrams, bigrams and trigrams."""
    return bind(
        parsed_text(text),
        lambda parsed: bind(
            _words(parsed),
            lambda words: bind(
                _bigrams_of(words),
                lambda pairs: F.struct(
                    parsed.alias("parsed_text"),
                    F.array_join(words, " ").alias("unigrams"),
                    F.array_join(pairs, " ").alias("bigrams"),
                    F.array_join(_append_next(pairs, words, 2), " ").alias("trigrams"),
                ),
            ),
        ),
    )


def term_counts(words: Column) -> Column:
    """Array of (token, tf) structs over an array of words; NULL if it is empty.

    Sorting the words and measuring the runs counts them inside the row, so an
    index build needs no shuffle by document.
    """

    def runs(words: Column) -> Column:
        size = F.size(words)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)),
        )
        counted = bind(
            starts,
            lambda begin: F.zip_with(
                begin,
                F.concat(F.slice(begin, 2, F.size(begin)), F.array(size)),
                lambda lo, hi: F.struct(
                    F.get(words, lo).alias("token"), (hi - lo).cast("bigint").alias("tf")
                ),
            ),
        )
        return F.when(size > 0, counted)

    return bind(F.sort_array(words), runs)
