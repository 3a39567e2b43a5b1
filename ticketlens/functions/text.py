"""Column builders for ticket text: combine, normalise, stop words, languages.

Everything except NFKC is a native Spark expression (JVM-side, no Python in
the hot path; the string functions are code-generated). NFKC has no Spark SQL function and runs as one
Arrow-batched pandas UDF that leaves pure-ASCII strings untouched.

Java's ``\\s``, ``\\S``, ``\\d``, ``\\w`` and ``\\b`` are ASCII-only, while the
ticket rules use Unicode classes, so the classes are spelled out below. The
same spellings run in RE2 (DuckDB), which lets the SQL oracle share them.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import stopwords

# Unicode white space (the set Python's str.isspace accepts),
# word characters (letters, numbers, underscore) and the replacement chain.
WHITESPACE_CLASS = r"\t-\r\x1c-\x20\x{85}\p{Z}"
WORD_CLASS = r"\p{L}\p{N}_"
URL_PATTERN = rf"https?://[^{WHITESPACE_CLASS}]+|www\.[^{WHITESPACE_CLASS}]+"
EMAIL_PATTERN = rf"[{WORD_CLASS}][^{WHITESPACE_CLASS}]*@[^{WHITESPACE_CLASS}]*[{WORD_CLASS}]"
NUMBER_PATTERN = r"\p{Nd}+"
PUNCTUATION_PATTERN = rf"[^{WORD_CLASS}{WHITESPACE_CLASS}]"
UNDERSCORE_PATTERN = r"_+"
SPACE_RUN_PATTERN = rf"[{WHITESPACE_CLASS}]+"
EDGE_SPACE_PATTERN = rf"^[{WHITESPACE_CLASS}]+|[{WHITESPACE_CLASS}]+$"

# (pattern, replacement) in the order they must be applied: URL before e-mail
# before number before punctuation.
REPLACEMENT_CHAIN = (
    (URL_PATTERN, " url "),
    (EMAIL_PATTERN, " email "),
    (NUMBER_PATTERN, " number "),
    (PUNCTUATION_PATTERN, " "),
    (UNDERSCORE_PATTERN, " "),
    (SPACE_RUN_PATTERN, " "),
)

# The same rules in the form the Spark plans run, linear in the text. A run without white
# space is an e-mail if an "@" lies between its first and its last word character;
# what is neither letter nor number ends up as single blanks.
EMAIL_RUN_PATTERN = (
    rf"(?<![^{WHITESPACE_CLASS}])([^{WORD_CLASS}{WHITESPACE_CLASS}]*+)"
    rf"[{WORD_CLASS}][^{WHITESPACE_CLASS}@]*+@[^{WHITESPACE_CLASS}]*[{WORD_CLASS}]"
)
GAP_PATTERN = r"[^\p{L}\p{N}]+"
# Every character of the white-space class.
WHITESPACE_CHARS = "".join(
    chr(c)
    for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)

UNKNOWN_LANGUAGE = "unknown"
MIN_TOKEN_CHARS = 2


def _nfkc_value(value):
    if value is None or value.isascii():
        return value
    return unicodedata.normalize("NFKC", value)


@F.pandas_udf(T.StringType())
def _nfkc_udf(text: pd.Series) -> pd.Series:
    return text.map(_nfkc_value)


def nfkc(text: Column) -> Column:
    """Unicode NFKC; only rows with a non-ASCII character can change and cross to Python."""
    changes = F.when(F.octet_length(text) > F.length(text), text)
    return F.coalesce(_nfkc_udf(changes), text)


def unicode_strip(col: Column) -> Column:
    """Python ``str.strip()``: removes Unicode white space at both ends."""
    return F.btrim(col, F.lit(WHITESPACE_CHARS))


def text_or_empty(col: Column) -> Column:
    """Null → '' and anything → string."""
    return F.coalesce(col.cast("string"), F.lit(""))


def combine_text(subject: Column, body: Column) -> Column:
    """strip(strip(subject) + ' ' + strip(body))."""
    return unicode_strip(
        F.concat(unicode_strip(text_or_empty(subject)), F.lit(" "), unicode_strip(text_or_empty(body)))
    )


def language_for_text(language: Column) -> Column:
    """Language used to pick a stop list: null → unknown, lower case, not trimmed."""
    return F.lower(F.coalesce(language.cast("string"), F.lit(UNKNOWN_LANGUAGE)))


def language_for_slices(language: Column) -> Column:
    """Language used for metric slices: lower, stripped, blank → unknown."""
    cleaned = unicode_strip(F.lower(F.coalesce(language.cast("string"), F.lit(UNKNOWN_LANGUAGE))))
    return F.when(cleaned == "", F.lit(UNKNOWN_LANGUAGE)).otherwise(cleaned)


def normalize_chars(text: Column, use_nfkc: bool = True) -> Column:
    """NFKC → lower → url / email / number masks → punctuation → collapse → strip."""
    out = text_or_empty(text)
    out = nfkc(out) if use_nfkc else out
    # one-argument lambdas bind each step once: a guard that reads a step does not run it again
    out = _bind(F.lower(out), lambda t: F.when(t.contains("http") | t.contains("www."), F.regexp_replace(t, URL_PATTERN, " url ")).otherwise(t))
    out = _bind(out, lambda t: F.when(t.contains("@"), F.regexp_replace(t, EMAIL_RUN_PATTERN, "$1 email ")).otherwise(t))
    out = F.regexp_replace(F.regexp_replace(out, NUMBER_PATTERN, " number "), GAP_PATTERN, " ")
    # only single ASCII spaces are left, so the plain trim is exact here
    return F.trim(out)


def _bind(value: Column, step) -> Column:
    return F.transform(F.array(value), step)[0]


def split_words(clean: Column) -> Column:
    """Split normalised text on single spaces; '' → empty array."""
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def _not_in(words):
    # a one-argument lambda: F.filter reads a two-argument one as (element, index)
    word_list = list(words)
    return lambda t: ~t.isin(word_list)


def remove_stop_words(tokens: Column, language: Column) -> Column:
    """Drop tokens found in the stop list chosen by the language prefix.

    ``isin`` over a literal list becomes a hash-set lookup (InSet) inside the
    lambda; duplicates and order of the other tokens are kept.
    """
    out = None
    for prefix, words in stopwords.lists_by_prefix():
        filtered = F.filter(tokens, _not_in(words)) if words else tokens
        cond = language.startswith(prefix)
        out = F.when(cond, filtered) if out is None else out.when(cond, filtered)
    return tokens if out is None else out.otherwise(tokens)


def feature_tokens(tokens: Column) -> Column:
    """Tokens the vectoriser sees: two or more characters."""
    return F.filter(tokens, lambda t: F.length(t) >= MIN_TOKEN_CHARS)


def _join_pair(a, b):
    return F.concat(a, F.lit(" "), b)


def ngrams_1_to(tokens: Column, max_n: int, min_n: int = 1) -> Column:
    """Contiguous word n-grams for n in [min_n, max_n], joined by a space.

    Built by zipping shifted slices, so each row costs O(tokens · max_n);
    a document with fewer than n tokens yields no n-gram of that size.
    The input should be a column reference (it is used several times).
    """
    size = F.size(tokens)
    empty = F.array().cast("array<string>")
    grams = {1: tokens}
    for n in range(2, max_n + 1):
        length = size - F.lit(n - 1)
        zipped = F.zip_with(
            F.slice(grams[n - 1], F.lit(1), length),
            F.slice(tokens, F.lit(n), length),
            _join_pair,
        )
        grams[n] = F.when(size >= n, zipped).otherwise(empty)
    parts = [grams[n] for n in range(min_n, max_n + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def metric_slug(col: Column) -> Column:
    """lower → split on white space → join with '_'."""
    return F.regexp_replace(unicode_strip(F.lower(col)), SPACE_RUN_PATTERN, "_")


def run_slug(col: Column) -> Column:
    """Runs outside [A-Za-z0-9_.-] → '-', strip '-', empty → 'run'."""
    replaced = F.regexp_replace(col, r"[^A-Za-z0-9_.\-]+", "-")
    stripped = F.regexp_replace(replaced, r"^-+|-+$", "")
    return F.when(stripped == "", F.lit("run")).otherwise(stripped)


def slug_of(value: str) -> str:
    """``run_slug`` of one string, for names of files."""
    return re.sub(r"[^A-Za-z0-9_.\-]+", "-", value).strip("-") or "run"
