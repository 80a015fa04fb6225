"""Removal and search of long lists of literal phrases, as Arrow functions over distinct terms."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def term_list(rows: list[tuple[str | None, str | None]]) -> list[str]:
    """Terms to remove from (term, flag) rows: flag f out, longest first, each once whatever its case."""
    seen: set[str] = set()
    terms = [t for t, flag in sorted(((t, f) for t, f in rows if t), key=lambda r: -len(r[0])) if flag != "f"]
    return [t for t in terms if not (t.lower() in seen or seen.add(t.lower()))]


def remove_terms(text: str, terms: list[str], passes: int = 3) -> str:
    """Each term goes as literal text in any case, a few times over; no word boundaries are asked for."""
    low = text.lower()
    for term in terms:
        if term.lower() not in low:
            continue
        rx = re.compile(re.escape(term), re.IGNORECASE)
        for _ in range(passes):
            text, n = rx.subn("", text)
            if not n:
                break
        low = text.lower()
    return text


def strip_references(text: str) -> str:
    """Without plan references, sums of money, dates and "dated"; runs of white space become one space."""
    for rx in (
        r"numbered [0-9]+ on the filed plan",
        r"(?:Absolute)?\s*(?:Â?£|GBP ?)[0-9,.]+",
        r"\b(?:[1-9]|0[1-9]|[12][0-9]|3[01])[- /.](?:0[1-9]|1[012])[- /.](?:19|20)\d\d\b",
    ):
        text = re.sub(rx, "", text)
    text = re.sub(rf"\b[0-9]{{1,2}}(?:st|nd|rd|th)?(?: day of)? (?:{MONTHS}),? (?:19|20)[0-9]{{2}}\b", "", text, flags=re.I)
    text = re.sub(r"\b(?:deed |lease |conveyance |transfer )?dated(?: the)?\b", "", text, flags=re.I)
    return " ".join(text.split())


def phrase_cleaner(rows: list[tuple[str | None, str | None]]) -> Callable[[Column], Column]:
    """A Column function for a removal list of (term, flag)."""
    terms = term_list(rows)

    @pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        known: dict[str, str] = {}
        for t in texts.dropna().unique():
            known[t] = strip_references(remove_terms(t, terms))
        return pd.Series([None if t is None else known[t] for t in texts], dtype=object)

    return clean


def replace_words(texts: pd.Series, words: list[str], by: list[str]) -> pd.Series:
    """Whole words and phrases replaced, pair by pair."""
    for word, new in zip(words, by):
        texts = texts.str.replace(rf"\b(?:{word})\b", new, regex=True)
    return texts


def matching_phrases(phrases: list[str], start_only: bool = False) -> Callable[[Column], Column]:
    """The phrases in a text, without those inside the longest of them, joined by ``|``; null if none."""

    @pandas_udf("string")
    def find(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            if not text:
                return None
            hits = [p for p in phrases if (text.startswith(p) if start_only else p in text)]
            if not hits:
                return None
            top = max(hits, key=len)
            return "|".join([p for p in hits if p == top or p not in top])

        return pd.Series([one(t) for t in texts], dtype=object)

    return find
