"""Insight boxes: quotes aligned with their source, and boxes read from raw completions."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

THRESHOLD = 0.75
MARGIN = 4  # words around the place to which most words of a quote point
COMMON = 40  # a word that stands so often in the source points nowhere
WORD = re.compile(r"\w+")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


class Source:
    """A text's words in order, and where each of them stands."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.spans = [m.span() for m in WORD.finditer(text)]
        self.words = [text[b:e].lower() for b, e in self.spans]
        self.places: dict[str, list[int]] = {}
        for i, w in enumerate(self.words):
            self.places.setdefault(w, []).append(i)

    def closest(self, quote: str, threshold: float) -> str | None:
        """The span most like the quote, if enough of either's letters stand in words they share in order.

        Words that are rare in the source vote for the offset at which the quote would begin; the words around it are aligned in a narrow band.
        """
        wanted = [w.lower() for w in WORD.findall(quote)]
        votes: Counter[int] = Counter()
        for i, w in enumerate(wanted):
            there = self.places.get(w, ())
            for at in there if len(there) <= COMMON else ():
                votes.update({at - i + d: 3 - abs(d) for d in (-2, -1, 0, 1, 2)})
        if not votes:
            return None
        begin = min(o for o, n in votes.items() if n == max(votes.values()))
        low, high = max(0, begin - MARGIN), min(len(self.words), begin + len(wanted) + MARGIN)
        pairs = _in_order(wanted, self.words[low:high])
        if not pairs:
            return None
        # words of the quote before its first and after its last shared word stand for as many words of the source
        first = max(low, low + pairs[0][1] - pairs[0][0])
        last = min(len(self.words) - 1, low + pairs[-1][1] + len(wanted) - 1 - pairs[-1][0])
        shared = sum(len(wanted[i]) for i, _ in pairs)
        letters = sum(map(len, wanted)) + sum(map(len, self.words[first : last + 1]))
        return self.text[self.spans[first][0] : self.spans[last][1]] if 2 * shared >= threshold * letters else None


def _in_order(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence, by letters."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + len(a[i]) if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def aligned_quotes(quotes: list[str] | None, source: str | None, threshold: float = THRESHOLD) -> tuple[list[str], int]:
    """The distinct quotes as spans of the source in order, and how many have no counterpart there. Blank quotes are left out."""
    text, words, spans, dropped = source or "", None, [], 0
    for quote in [] if quotes is None else quotes:
        bare = (quote or "").strip().strip("\"'“”‘’ \t")
        if bare and bare not in text:
            words = words or Source(text)
            bare = words.closest(EDGE.sub("", bare), threshold)
        if bare:
            spans.append(bare)
        else:
            dropped += 1
    return list(dict.fromkeys(spans)), dropped


def align_quotes(quotes: Column, source: Column, threshold: float = THRESHOLD) -> Column:
    """struct(quotes, dropped). Lists of which every quote stands in the source as it is are settled without Python."""

    @F.pandas_udf("struct<quotes: array<string>, dropped: int>")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for q, s in parts:
            yield pd.DataFrame([aligned_quotes(a, b, threshold) for a, b in zip(q, s)], columns=["quotes", "dropped"])

    return run(quotes, source)


def _box_text(box: object) -> str | None:
    """A box given as text or as an object with topic, insight and quotes."""
    if isinstance(box, str):
        return box if box.strip() else None
    if not isinstance(box, dict):
        return None
    part = {str(k).lower(): v for k, v in box.items()}
    quotes = part.get("quotes") or []
    lines = [str(x).strip() for x in ([quotes] if isinstance(quotes, str) else quotes)]
    topic, insight, lines = (part.get("topic") or "").strip(), (part.get("insight") or "").strip(), [x for x in lines if x]
    return "\n".join([f"TOPIC: {topic}", f"INSIGHT: {insight}", "QUOTES:", *lines]) if topic or insight or lines else None


def _unwrapped(text: str) -> str:
    """The text with each object that holds nothing but a string, which is no JSON, as that string."""
    out, i = [], 0
    blank = re.compile(r"\s*")
    while i < len(text):
        c, j = text[i], i
        if c == "{":
            j = blank.match(text, i + 1).end()
        if text[j : j + 1] == '"':
            try:
                end = scanstring(text, j + 1, False)[1]
            except ValueError:
                break
            after = blank.match(text, end).end()
            lone = c == "{" and text[after : after + 1] == "}"
            out.append(text[j:end] if lone else text[i:end])
            i = after + 1 if lone else end
        else:
            out.append(c)
            i += 1
    return "".join(out) + text[i:]


def boxes_in(completion: str | None) -> list[str] | None:
    """The boxes of a raw completion: those of the first object with a list of boxes that can be read after the reasoning, else null.

    Objects are tried from each opening brace on, so text and fences around them don't matter; then again with lone strings unwrapped.
    """
    answer = (completion or "").rpartition("</think>")[2]
    reader = json.JSONDecoder(strict=False)
    for text in (answer, _unwrapped(answer)):
        place = text.find("{")
        while place >= 0:
            try:
                value, _ = reader.raw_decode(text, place)
            except ValueError:
                value = None
            if isinstance(value, dict) and isinstance(value.get("boxes"), list):
                return [t for t in map(_box_text, value["boxes"]) if t]
            place = text.find("{", place + 1)
    return None


def parse_completion(completion: Column) -> Column:
    """array<string> of the boxes in raw completions."""

    @F.pandas_udf("array<string>")
    def run(completions: pd.Series) -> pd.Series:
        return completions.map(boxes_in)

    return run(completion)
