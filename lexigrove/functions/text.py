"""Text expressions: tokens, stems, character n-grams, keys, cleaners.

All but `nfkc` and `ascii_letters`, and what is made of them, run inside the JVM.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that carry no meaning in a query (fixed values).
STOPWORDS = "a an and are as at be by for from how in is it of on or that the this to what when where who why with".split()
#: Endings that stemming strips, the first that fits (fixed values).
SUFFIXES = ("ingly", "edly", "ing", "ed", "es", "s")
#: Words whose immediate repetition is suspicious; shorter ones are never matched (fixed values).
REPEATABLE = ("also", "and", "she", "the", "they", "this", "those")
#: Words that a finished block doesn't end with (fixed values).
DANGLING = "a an and as at by for from in into of on or that the this to which with".split()

#: Small words that stay lower-case in titles (fixed values).
SMALL_WORDS = "a an and as at for in of on or the to".split()

#: White space of any script, and runs without it.
SPACE = r"[\t-\r\x1C-\x20\x{85}\p{Z}]"
NOT_SPACE = r"[^\t-\r\x1C-\x20\x{85}\p{Z}]+"
#: Runs that aren't one space already.
_RUNS = rf"{SPACE}(?:{SPACE}+|(?<! ))"


@F.arrow_udf(T.StringType())
def nfkc(text: pa.Array) -> pa.Array:
    """Unicode NFKC; the JVM has no expression for it."""
    return pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in text.to_pylist()], pa.string())


def squeeze(text: Column) -> Column:
    """White space runs become one space, none at the ends."""
    return F.trim(F.regexp_replace(text, _RUNS, " "))


def match_key(text: Column) -> Column:
    """ASCII letters and digits only, in lower case, after NFKC: ligatures and wide letters count as what they stand for."""
    return F.regexp_replace(F.lower(nfkc(text)), "[^a-z0-9]+", "")


@F.arrow_udf(T.StringType())
def ascii_letters(text: pa.Array) -> pa.Array:
    """Letters without their accents (NFKD), and nothing else beyond ASCII."""
    return pa.array([None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in text.to_pylist()], pa.string())


def slug(text: Column) -> Column:
    """Lower-case words without accents, joined by hyphens; "item" if nothing is left."""
    out = F.regexp_replace(F.regexp_replace(F.lower(ascii_letters(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(out == "", "item").otherwise(out)


def token_count(text: Column) -> Column:
    """Runs of characters that aren't white space."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def stem(token: Column) -> Column:
    """Strips the first suffix that leaves more than two letters; "ies" of a longer word becomes "y"."""
    out = F.when((F.length(token) > 5) & token.endswith("ies"), F.concat(F.substring(token, F.lit(1), F.length(token) - 3), F.lit("y")))
    for suffix in SUFFIXES:
        out = out.when((F.length(token) > len(suffix) + 2) & token.endswith(suffix), F.substring(token, F.lit(1), F.length(token) - len(suffix)))
    return out.otherwise(token)


def terms(text: Column) -> Column:
    """Stemmed ASCII words of two letters or more, without stop words; stop words are dropped after stemming."""
    stemmed = F.transform(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)), stem)
    return F.filter(stemmed, lambda t: (F.length(t) > 1) & ~t.isin(STOPWORDS))


def char_ngrams(text: Column, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """All n-grams of the lower-case ASCII words, one space between and around them."""
    cleaned = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    letters = F.split(F.concat(F.lit(" "), cleaned, F.lit(" ")), "")

    def of(c: Column, size: int) -> Column:
        places = F.when(F.size(c) >= size, F.sequence(F.lit(0), F.size(c) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(*[F.get(c, i + k) for k in range(size)]))

    # the letters are bound to a lambda's variable, so they are split once for all grams
    grams = F.flatten(F.transform(F.array(letters), lambda c: F.concat(*[of(c, n) for n in sizes])))
    return F.when(cleaned == "", F.array().cast("array<string>")).otherwise(F.filter(grams, lambda g: F.trim(g) != ""))


def repeated_words(text: Column) -> Column:
    """The suspicious words that stand twice with only white space between, in lower case."""
    pattern = rf"(?i)(?<![0-9A-Za-z_])({'|'.join(REPEATABLE)}){SPACE}+\1(?![0-9A-Za-z_])"
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lower)


def trailing_words(text: Column, n: int) -> Column:
    """The last ``n`` ASCII words, lower-cased."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))
    return F.slice(words, F.greatest(F.size(words) - n + 1, F.lit(1)), n)


def first_word(text: Column) -> Column:
    """The first run of ASCII letters."""
    return F.regexp_extract(text, "([A-Za-z]+)", 1)


def title_case(text: Column) -> Column:
    """Lines in capitals with only first letters upper-case, small words inside in lower case; other lines stay, white space squeezed."""

    def cased(flat: Column) -> Column:
        words = F.transform(F.split(F.lower(flat), " "), lambda w, i: F.when((i > 0) & w.isin(SMALL_WORDS), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))))
        return F.when((flat == F.upper(flat)) & (flat != F.lower(flat)), F.array_join(words, " ")).otherwise(flat)

    # the squeezed text is bound to a lambda's variable, so it is made once
    return F.get(F.transform(F.array(squeeze(text)), cased), F.lit(0))


def html_text(html: Column) -> Column:
    """The text of markup: scripts, styles and tags go, white space is squeezed."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return squeeze(F.regexp_replace(bare, r"(?s)<[^>]*>", " "))


def html_field(html: Column, tag: str) -> Column:
    """The text of the first element of a kind."""
    return squeeze(F.regexp_replace(F.regexp_extract(html, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1), r"(?s)<[^>]*>", " "))


def retrieval_text(markdown: Column) -> Column:
    """Markdown without comments, page and context notes; list marks are taken off, blank lines stay."""
    lines = F.transform(F.split(markdown, "\n"), lambda x: F.when(F.trim(x).startswith("- "), F.substring(F.trim(x), F.lit(3), F.length(x))).otherwise(x))
    noise = r"^\s*(<!--.*-->|_Source page .*_|(Source pages:|Context:|Supplementary side material from source page |Table-like content from source page ).*)\s*$"
    return F.trim(F.array_join(F.filter(lines, lambda x: ~x.rlike(noise)), "\n"))


def join_lines(left: Column, right: Column) -> Column:
    """Two lines as one: a hyphen before a lower-case letter goes, else a space joins them."""
    broken = left.rlike("[A-Za-z]-$") & right.rlike("^[a-z]")
    return F.when(broken, F.concat(F.regexp_replace(left, "-$", ""), right)).otherwise(F.concat_ws(" ", left, right))


def roman_value(text: Column) -> Column:
    """The number of a Roman numeral, or null."""
    values = F.from_json(F.lit('{"I":1,"V":5,"X":10,"L":50,"C":100,"D":500,"M":1000}'), "map<string,int>")
    digits = F.transform(F.split(F.upper(text), ""), lambda c: values[c])
    sums = F.transform(digits, lambda d, i: F.when(F.get(digits, i + 1) > d, -d).otherwise(d))
    valid = F.upper(text).rlike("^M*(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$") & (F.length(text) > 0)
    return F.when(valid, F.aggregate(sums, F.lit(0), lambda a, d: a + d))


def roman_numeral(number: Column) -> Column:
    """A lower-case Roman numeral of a number below 4000."""
    digit = lambda place, one, five, ten: F.element_at(F.array(*[F.lit(x) for x in ("", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten)]), (F.floor(number / place) % 10 + 1).cast("int"))
    thousands = F.repeat(F.lit("m"), F.floor(number / 1000).cast("int"))
    return F.concat(thousands, digit(100, "c", "d", "m"), digit(10, "x", "l", "c"), digit(1, "i", "v", "x"))
