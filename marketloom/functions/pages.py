"""Text of fetched pages, with the parser of the standard library; sites can register a reader of their own."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SKIPPED = frozenset("script style nav footer header aside noscript template svg form button".split())
BREAKING = frozenset("p div br li tr td h1 h2 h3 h4 h5 h6 section article main ul ol table blockquote".split())
READERS: dict[str, Callable[[str], str | None]] = {}


def reader(domain: str) -> Callable:
    """Registers a function from html to text for a domain; it is asked where the plain text is weak."""

    def register(f: Callable[[str], str | None]) -> Callable[[str], str | None]:
        READERS[domain] = f
        return f

    return register


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.lines, self.depth, self.data, self.title, self.within_title, self.within_data = [[]], 0, [], "", False, False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.within_title |= tag == "title"
        self.within_data = tag == "script" and ("type", "application/ld+json") in attrs
        self.depth += tag in SKIPPED
        if tag in BREAKING:
            self.lines.append([])

    def handle_endtag(self, tag: str) -> None:
        self.within_title &= tag != "title"
        self.within_data = False
        self.depth -= tag in SKIPPED and self.depth > 0
        if tag in BREAKING:
            self.lines.append([])

    def handle_data(self, data: str) -> None:
        if self.within_title:
            self.title += data
        elif self.within_data:
            self.data.append(data)
        elif not self.depth:
            self.lines[-1].append(data)


def read_page(html: str | None, domain: str | None = None, least_words: int = 120) -> dict | None:
    """title and text of a page; null for no page."""
    if not html:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    text = "\n".join(line for line in (" ".join("".join(x).split()) for x in parser.lines) if line)
    if len(text.split()) < least_words:
        other = READERS[domain](html) if domain in READERS else _structured(parser.data)
        text = (other or "").strip() or text
    return {"title": " ".join(parser.title.split()) or None, "text": text}


def _structured(blocks: list[str]) -> str | None:
    """The body of a news article in the page's structured data."""
    for block in blocks:
        try:
            value = json.loads(block)
        except ValueError:
            continue
        if isinstance(value, dict) and value.get("@type") == "NewsArticle" and value.get("articleBody"):
            return str(value["articleBody"])
    return None


def page_text(html: Column, domain: Column) -> Column:
    """struct(title, text)."""

    @F.pandas_udf("struct<title: string, text: string>")
    def run(pages: pd.Series, domains: pd.Series) -> pd.DataFrame:
        found = [read_page(h, d) or {"title": None, "text": None} for h, d in zip(pages, domains)]
        return pd.DataFrame(found, columns=["title", "text"])

    return run(html, domain)
