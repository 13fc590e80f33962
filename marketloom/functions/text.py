"""Text building, page checks and excerpts as Column expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.semantics import blank_to_null, collapsed

# Answers that are no page, and marks of a check before one.
BAD_STATUS = (401, 403, 404, 429)
CHALLENGES = ("Just a moment", "cf-browser-verification", "Checking your browser", "Attention Required", "Enable JavaScript and cookies to continue")
MIN_HTML = 800
_WORD = re.compile(r"[ \t\n\r\f]*[^ \t\n\r\f]+")


def embedding_text(title: Column, content: Column, most: int = 64_000) -> Column:
    """What is embedded of an article: its non-blank parts parted by a blank line, cut off."""
    return F.substring(F.concat_ws("\n\n", blank_to_null(title), blank_to_null(content)), 1, most)


def word_count(text: Column) -> Column:
    words = collapsed(F.coalesce(text, F.lit("")))
    return F.when(words == "", 0).otherwise(F.size(F.split(words, " ")))


def is_weak(text: Column, least: int = 120) -> Column:
    return word_count(text) < least


def looks_bad(status: Column, html: Column) -> Column:
    """Whether a fetched page is missing, an error, too short or a challenge; never null."""
    head = F.substring(html, 1, 2000)
    marked = F.lit(False)
    for mark in CHALLENGES:
        marked = marked | F.contains(head, F.lit(mark))
    return F.coalesce(status.isin(*BAD_STATUS) | (status >= 500), F.lit(True)) | F.coalesce(F.length(html) < MIN_HTML, F.lit(True)) | F.coalesce(marked, F.lit(False))


def excerpt(insight: Column, topic: Column) -> Column:
    """The insight, or where it is empty the topic, on one line."""
    return collapsed(F.coalesce(F.when(insight != "", insight), topic, F.lit("")))


def labelled(label: Column, text: Column) -> Column:
    return F.when(label.isNotNull() & (label != ""), F.concat(F.lit("["), label, F.lit("] "), text)).otherwise(text)


def precedent_line(date: Column, headline: Column, excerpts: Column) -> Column:
    """A bullet: the header, one excerpt after a dash, or several on lines of their own."""
    head = F.concat(F.lit("- "), date, F.lit(" "), F.coalesce(headline, F.lit("")))
    return F.when(F.size(excerpts) == 0, head).when(F.size(excerpts) == 1, F.concat(head, F.lit(" — "), F.element_at(excerpts, 1))).otherwise(F.concat(head, F.array_join(F.transform(excerpts, lambda x: F.concat(F.lit("\n    · "), x)), "")))


def with_headline(box: Column, headline: Column) -> Column:
    """The box under its headline line; unchanged where it has one."""
    mark = "ARTICLE_HEADLINE:"
    return F.when(box.startswith(mark), box).otherwise(F.concat(F.lit(mark + " "), F.trim(F.coalesce(headline, F.lit(""))), F.lit("\n"), box))


def box_parts(box: Column) -> Column:
    """struct(topic, insight, quotes) of a box's labelled lines."""
    line = lambda mark: F.regexp_extract(box, rf"(?m)^{mark}:[ \t]*(.*?)[ \t\r]*$", 1)
    has = lambda mark: box.rlike(rf"(?m)^{mark}:")
    tail = F.when(has("QUOTES"), F.regexp_replace(box, r"(?s)^(?:.*?\n)?QUOTES:[^\n]*\n?", "")).otherwise(F.lit(""))
    quotes = F.filter(F.transform(F.split(tail, "\n"), lambda x: F.rtrim(x)), lambda x: F.trim(x) != "")
    return F.struct(F.when(has("TOPIC"), line("TOPIC")).alias("topic"), F.when(has("INSIGHT"), line("INSIGHT")).alias("insight"), quotes.alias("quotes"))


class Words:
    """A stand-in tokenizer: words with the white space before them."""

    def cut(self, value: str, most: int) -> str:
        end = 0
        for n, m in enumerate(_WORD.finditer(value), 1):
            if n > most:
                break
            end = m.end()
        return value[:end]


def cut_to_tokens(value: Column, most: int, *, passing: int = 8000, tokenizer: object | None = None) -> Column:
    """The text cut to its first `most` tokens; texts of at most `passing` characters pass as they are, blank ones become one blank.

    `tokenizer` has cut(text, most). Texts that pass never reach Python's tokenizer.
    """
    cutter = tokenizer or Words()

    @F.pandas_udf("string")
    def cut(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if v is None or len(v) <= passing else cutter.cut(v, most))

    blank = F.coalesce(F.trim(value), F.lit("")) == ""
    return F.when(blank, F.lit(" ")).otherwise(cut(value))
