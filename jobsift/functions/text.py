"""Text extraction: codes from links, pay texts, HTML fragments, terms.

All patterns are Java regular expressions evaluated JVM-side. Unicode
classes (``\\p{L}``, ``\\p{N}``) are used instead of ``\\w`` because Java's
``\\w`` is ASCII-only and would drop CJK characters.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import schema as S


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def extract_code(col, pattern: str, group: int = 1) -> Column:
    """First capture of ``pattern`` or NULL (regexp_extract gives '' on no match)."""
    return F.nullif(F.regexp_extract(_c(col), pattern, group), F.lit(""))


def first_match(col, pattern: str) -> Column:
    """First whole match (findall()[0]) or NULL."""
    return F.get(F.regexp_extract_all(_c(col), F.lit(pattern), 0), 0)


def thousands_to_long(col) -> Column:
    return F.regexp_replace(_c(col), ",", "").cast("bigint")


def parse_monthly_range(col) -> Column:
    """'月薪 30,000 至 45,000' -> struct(min_salary, max_salary); (0, 0) when absent."""
    c = _c(col)
    lo = extract_code(c, S.MONTHLY_RANGE_PATTERN, 1)
    hi = extract_code(c, S.MONTHLY_RANGE_PATTERN, 2)
    return F.struct(
        F.coalesce(thousands_to_long(lo), F.lit(0).cast("bigint")).alias("min_salary"),
        F.coalesce(thousands_to_long(hi), F.lit(0).cast("bigint")).alias("max_salary"),
    )


def join_nonempty(arr, sep: str = ",") -> Column:
    """Join array elements (NULLs skipped); NULL for an empty result."""
    return F.nullif(F.concat_ws(sep, _c(arr)), F.lit(""))


def field_of(arr, name: str) -> Column:
    """array<struct> -> array of one field."""
    return F.transform(_c(arr), lambda x: x[name])


def strip_ws(col) -> Column:
    """Trim every kind of leading/trailing whitespace, not only spaces."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


# --- HTML --------------------------------------------------------------------

def unescaped(text: str) -> str:
    return html.unescape(text).replace("\xa0", " ")


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: unescaped(x) if isinstance(x, str) and "&" in x else x)


def unescape_html(col) -> Column:
    """Entities decoded once: decimal, hexadecimal and the whole public named
    set ('&amp;lt;' gives '&lt;'); a no-break space becomes a blank."""
    return _unescaped(_c(col))


def html_element_text(col, tag: str) -> Column:
    """Text of the first <tag>…</tag>, tags inside removed, entities decoded."""
    inner = F.regexp_extract(_c(col), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    return F.nullif(collapse_ws(unescape_html(F.regexp_replace(inner, r"<[^>]*>", " "))), F.lit(""))


def html_attr(col, tag: str, attr: str) -> Column:
    return extract_code(col, rf'(?i)<{tag}\b[^>]*\b{attr}="([^"]*)"', 1)


def html_hrefs(col) -> Column:
    """All href values of anchor tags as written, in document order, in either kind of quotes."""
    quoted = F.regexp_extract_all(_c(col), F.lit(r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*')"""), 1)
    return F.transform(quoted, lambda x: x.substr(F.lit(2), F.length(x) - 2))


def collapse_ws(col) -> Column:
    return F.trim(F.regexp_replace(_c(col), r"\s+", " "))


def visible_text(col) -> Column:
    """Visible text of a page: comments, script and style blocks dropped,
    tags replaced by a blank, entities decoded, whitespace collapsed."""
    c = _c(col)
    c = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    c = F.regexp_replace(c, r"(?is)<script\b[^>]*>.*?</script>", " ")
    c = F.regexp_replace(c, r"(?is)<style\b[^>]*>.*?</style>", " ")
    c = F.regexp_replace(c, r"<[^>]*>", " ")
    return collapse_ws(unescape_html(c))


# --- terms -------------------------------------------------------------------

# Word-cloud word rules (the public word-cloud library's defaults, which the
# original feeds its skills text into): a word is a letter/digit/underscore
# followed by any of those or apostrophes; a trailing "'s" is cut; words of
# digits only and stop words (compared in lower case) are dropped.
WORD_PATTERN = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"
DIGITS_PATTERN = r"^\p{Nd}+$"

# The word-cloud library's default English stop words.
STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "also", "am", "an", "and", "any",
    "are", "aren't", "as", "at", "be", "because", "been", "before", "being", "below", "between",
    "both", "but", "by", "can", "can't", "cannot", "com", "could", "couldn't", "did", "didn't",
    "do", "does", "doesn't", "doing", "don't", "down", "during", "each", "else", "ever", "few",
    "for", "from", "further", "get", "had", "hadn't", "has", "hasn't", "have", "haven't",
    "having", "he", "he'd", "he'll", "he's", "hence", "her", "here", "here's", "hers", "herself",
    "him", "himself", "his", "how", "how's", "however", "http", "i", "i'd", "i'll", "i'm", "i've",
    "if", "in", "into", "is", "isn't", "it", "it's", "its", "itself", "just", "k", "let's",
    "like", "me", "more", "most", "mustn't", "my", "myself", "no", "nor", "not", "of", "off", "on",
    "once", "only", "or", "other", "otherwise", "ought", "our", "ours", "ourselves", "out",
    "over", "own", "r", "same", "shall", "shan't", "she", "she'd", "she'll", "she's", "should",
    "shouldn't", "since", "so", "some", "such", "than", "that", "that's", "the", "their",
    "theirs", "them", "themselves", "then", "there", "there's", "therefore", "these", "they",
    "they'd", "they'll", "they're", "they've", "this", "those", "through", "to", "too", "under",
    "until", "up", "very", "was", "wasn't", "we", "we'd", "we'll", "we're", "we've", "were",
    "weren't", "what", "what's", "when", "when's", "where", "where's", "which", "while", "who",
    "who's", "whom", "why", "why's", "with", "won't", "would", "wouldn't", "www", "you", "you'd",
    "you'll", "you're", "you've", "your", "yours", "yourself", "yourselves",
]


def words(col) -> Column:
    """Every word of a text, in its original case, in text order."""
    return F.regexp_extract_all(_c(col), F.lit(WORD_PATTERN), 0)


def strip_possessive(col) -> Column:
    """Cut a trailing "'s" (any case): "Python's" -> "Python"."""
    c = _c(col)
    return F.when(F.lower(c).endswith("'s"), c.substr(F.lit(1), F.length(c) - 2)).otherwise(c)


def keep_word(col, stop_words=STOP_WORDS) -> Column:
    """Not digits only and not a stop word (case-insensitive)."""
    c = _c(col)
    return ~c.rlike(DIGITS_PATTERN) & ~F.lower(c).isin(list(stop_words))


def plural_stem(key) -> Column:
    """For a lower-case word ending in one 's' (not 'ss'), the word without it; else NULL."""
    k = _c(key)
    return F.when(k.endswith("s") & ~k.endswith("ss"), k.substr(F.lit(1), F.length(k) - 1))
