"""Column functions on scraped text."""

from __future__ import annotations

import html as html_module

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Named entities that occur in pages; the ampersand comes last, so that nothing is decoded twice.
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&nbsp;", " "), ("&amp;", "&"))


@F.pandas_udf(StringType())
def _numeric(texts: pd.Series) -> pd.Series:
    return texts.str.replace(r"&#(?:[0-9]+|[xX][0-9a-fA-F]+);", lambda m: html_module.unescape(m.group()), regex=True)


def decode_named(text: Column) -> Column:
    """Named entities as their characters."""
    for name, char in NAMED:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def decode_entities(text: Column) -> Column:
    """Named and numeric entities as their characters; only texts with a numeric one leave the JVM."""
    return decode_named(F.when(text.contains("&#"), _numeric(text)).otherwise(text))


def decode_percent(text: Column) -> Column:
    """Percent-encoding decoded, as UTF-8; a malformed text stays as it is. A plus sign is no space here."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def strip_label(text: Column) -> Column:
    """``<strong>Label:</strong> value`` without its label, whatever the label's language; else the text trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?s)^.*?</strong>", ""), r"\s+", " "))


def html_to_text(html: Column) -> Column:
    """The visible text of a page: scripts, styles, comments and tags go, entities are decoded, spaces collapsed."""
    text = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_named(text), r"[ \n\t\r]+", " "))


def delimited(pattern: str) -> str:
    """The pattern as whole words, by letters and digits of any script; ``\\b`` differs between engines there."""
    return rf"(^|[^\p{{L}}\p{{N}}])({pattern})($|[^\p{{L}}\p{{N}}])"
