"""Fields of stored web pages, taken with regular expressions over the whole page."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


#: Named entities of running text. Fixed values.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def plain_text(markup: Column | str) -> Column:
    """Text of a piece of markup: tags go, the usual entities are read, ends are trimmed."""
    text = F.regexp_replace(_col(markup), r"(?s)<!--.*?-->|<[^>]*>", "")
    for entity, sign in ENTITIES.items():  # the ampersand last, so that no entity is read twice
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.trim(text)


def tag_text(html: Column | str, tag: str) -> Column:
    """Text of the first ``tag`` element, without inner markup; NULL when the page has none."""
    inner = F.regexp_extract(_col(html), f"(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>", 1)
    return _blank_to_null(plain_text(inner))


def meta_content(html: Column | str, name: str) -> Column:
    """``content`` of the ``meta`` element with the given name, in any order and kind of quotes."""
    named = f"(?=[^>]*\\sname\\s*=\\s*[\"']{re.escape(name)}[\"'])"
    pattern = f"(?is)<meta{named}[^>]*\\scontent\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)')"
    found = F.concat(F.regexp_extract(_col(html), pattern, 1), F.regexp_extract(_col(html), pattern, 2))
    return _blank_to_null(found)


def all_texts(
    html: Column | str, tag: str, attribute: str | None = None, value: str | None = None
) -> Column:
    """Texts of all elements of a kind, in page order, optionally with an attribute value."""
    inside = f'\\s[^>]*{attribute}="{re.escape(value or "")}"[^>]*' if attribute else "(?:\\s[^>]*)?"
    pattern = f"(?s)<{tag}{inside}>(.*?)</{tag}>"
    return F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(1))


def all_attributes(html: Column | str, tag: str, attribute: str) -> Column:
    """Values of an attribute over all elements of a kind, in page order."""
    pattern = f'<{tag} [^>]*{attribute}="([^"]*)"'
    return F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(1))


def nth(items: Column, position: int) -> Column:
    """Element at a position counted from 0; NULL when the list is shorter."""
    return F.get(items, F.lit(position))


def extract_html(df: DataFrame, html: str, rules: dict[str, Column]) -> DataFrame:
    """Replace the page by the fields the rules read from it."""
    kept = [c for c in df.columns if c != html]
    return df.select(*kept, *[rule.alias(name) for name, rule in rules.items()])


def explode_items(df: DataFrame, key: str, items: Column, name: str) -> DataFrame:
    """One row per item found on each page."""
    return df.select(F.col(key), F.explode(items).alias(name))
