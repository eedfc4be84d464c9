"""Text expressions (X-14 .. X-19). Built-in regex functions only: they stay in
the JVM and inside whole-stage code generation; no Python per row."""

from __future__ import annotations

import functools
import os
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# X-14 ---------------------------------------------------------------------
# Accented letters and their plain forms (Latin-1 and common Latin-A).
ACCENTED = "àáâãäåāăąçćčďèéêëēėęěìíîïīįłñńňòóôõöøōőŕřśšşťùúûüūůűųýÿžźżÀÁÂÃÄÅĀĂĄÇĆČĎÈÉÊËĒĖĘĚÌÍÎÏĪĮŁÑŃŇÒÓÔÕÖØŌŐŔŘŚŠŞŤÙÚÛÜŪŮŰŲÝŸŽŹŻ"
PLAIN = "aaaaaaaaacccdeeeeeeeeiiiiiilnnnoooooooorrssstuuuuuuuuyyzzzAAAAAAAAACCCDEEEEEEEEIIIIIILNNNOOOOOOOORRSSSTUUUUUUUUYYZZZ"


def strip_accents(x) -> Column:
    return F.translate(_c(x), ACCENTED, PLAIN)


def clean_name(x) -> Column:
    """Accents off, lower case, blanks stripped, leading backticks off."""
    return F.regexp_replace(F.trim(F.lower(strip_accents(x))), r"^`+", "")


# X-15 ---------------------------------------------------------------------
# The ordered review-cleaning steps (pattern, replacement).
# \W is written as [^\p{L}\p{N}_] so that it is Unicode-aware in Java regex.
REVIEW_REGEX_STEPS: list[tuple[str, str]] = [
    (r"[\n\r]", " "),
    (r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+", " link "),
    (r"([0-2][0-9]|(3)[0-1])(\/|\.)(((0)[0-9])|((1)[0-2]))(\/|\.)\d{2,4}", " data "),
    (r"R?\$\s?\d+([.,]\d{1,2})?", " dinheiro "),
    (r"[0-9]+", " numero "),
    (r"([nN][ãÃaA][oO]|[ñÑ]| [nN] )", " negação "),
    (r"[^\p{L}\p{N}_]", " "),
    (r"\s+", " "),
    (r"[ \t]+$", ""),
]


def regex_steps(x, steps: Sequence[tuple[str, str]] = REVIEW_REGEX_STEPS) -> Column:
    out = _c(x)
    for pat, rep in steps:
        out = F.regexp_replace(out, pat, rep)
    return out


# X-16 ---------------------------------------------------------------------
def first_keyword_rule(x, rules: Sequence[tuple[str, object]]) -> Column:
    """Case-blind 'keyword in text', first rule in list order wins; no match -> null."""
    low = F.lower(_c(x))
    expr = None
    for kw, val in rules:
        cond = low.contains(kw.lower())
        expr = F.when(cond, F.lit(val)) if expr is None else expr.when(cond, F.lit(val))
    return expr


# X-17 ---------------------------------------------------------------------
def concat_title_message(title, message) -> Column:
    """title + ' ' + message when there is a title, else the message alone;
    a null message stays null."""
    t, m = _c(title), _c(message)
    return F.when(t.isNotNull(), F.concat(t, F.lit(" "), m)).otherwise(m)


# X-18 ---------------------------------------------------------------------
def extract_number(x, prefix: str = "") -> Column:
    """'Product_37' -> 37."""
    return F.regexp_extract(_c(x), rf"{prefix}(\d+)", 1).cast("bigint")


def strip_prefix(x, prefix: str) -> Column:
    c = _c(x)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


# X-19 ---------------------------------------------------------------------
@functools.lru_cache(maxsize=None)
def default_stopwords(language: str = "english") -> tuple[str, ...]:
    """The shipped stop words of a language (``marketlens/resources/stopwords``)."""
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "resources", "stopwords",
                        f"{language}.txt")
    with open(path, encoding="utf-8") as f:
        return tuple(dict.fromkeys(f.read().split()))


LANGUAGE_NAMES = {"en": "english", "fr": "french", "de": "german", "es": "spanish"}


def tokens(x) -> Column:
    """Lower case, split on blanks, empty pieces dropped (Python ``str.split()``)."""
    return F.filter(F.split(F.lower(_c(x)), r"\s+"), lambda t: t != F.lit(""))


def remove_stopwords(x, words: Sequence[str]) -> Column:
    """Token text without stop words, order kept, joined by single blanks."""
    stop = F.array(*[F.lit(w) for w in words])
    return F.array_join(F.filter(tokens(x), lambda t: ~F.array_contains(stop, t)), " ")
