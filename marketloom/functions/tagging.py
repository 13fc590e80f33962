"""Companies and ticker symbols named in texts.

The dictionary is the universe table, a dimension (`MAX_UNIVERSE` is checked). Its names are kept by their first word and its symbols by
themselves, so a text is cut into words once and each word asks a dictionary: the work does not grow with the universe. The index is
built once per worker and runs over Arrow batches; array logic around it stays in Column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.semantics import array_or_null, stripped

MAX_UNIVERSE = 100_000

# Symbols that are words of English, taken only beside a mark of a symbol.
AMBIGUOUS = frozenset("AI ON S TT ARM NOW ALL SE GO IT".split())
# Words after which a leading brand word may stand alone.
CATEGORY_WORDS = frozenset(
    "technology technologies holdings holding systems system networks network labs instruments semiconductor semiconductors group design realty trust platforms industries"
    " scientific motion test materials research innovation enterprise electric services vernova photonics microelectronics manufacturing devices integrations storage solutions communications".split()
)
# Leading words too common to stand alone.
COMMON_FIRST = frozenset("advanced applied analog power core global united international texas western digital pure super monolithic onto carrier general american national micro open first silicon taiwan powell".split())
EXCHANGES = ("NYSE", "NASDAQ", "NYSEARCA", "AMEX", "OTC", "OTCMKTS")

Universe = tuple[tuple[str, str | None, str | None], ...]

WORD = re.compile(r"\w+")
LISTED = re.compile(rf"\b(?:{'|'.join(EXCHANGES)})\s*:?\s*$", re.I)  # an exchange just before a symbol
OPENED = re.compile(r"\(\s*$")
MOVED, CLOSED = re.compile(r"\s+[+-]?\d"), re.compile(r"\s*\)")
LOOK_BACK = 24


def short_name(company: str) -> str | None:
    """What is left of a company's name once the words that say its kind are peeled off its end, if that is one word that can stand alone."""
    words = company.split()
    whole = len(words)
    while len(words) > 1 and words[-1].strip(".,").lower() in CATEGORY_WORDS:
        words.pop()
    alone = words[0] if len(words) == 1 < whole else ""
    return alone if len(alone) > 3 and alone.lower() not in COMMON_FIRST else None


class Mention(NamedTuple):
    """Where an entity is named, by which tickers, and where the whole mark begins (a dollar sign, an exchange, a bracket)."""

    start: int
    end: int
    tickers: tuple[str, ...]
    is_name: bool
    mark: int


class Dictionary:
    """The universe's names by their first word, its symbols by themselves."""

    def __init__(self, universe: Universe) -> None:
        self.company = {ticker: (company or "").strip() for ticker, company, _ in universe}
        owners: dict[str, set[str]] = {}
        for ticker, company in self.company.items():
            for name in {company, short_name(company) if company else None} - {"", None}:
                owners.setdefault(name.lower(), set()).add(ticker)
        self.by_word: dict[str, list[tuple[int, str, tuple[str, ...]]]] = {}
        for name in sorted(owners, key=lambda n: (-len(n), n)):  # a longer name goes before its beginning
            first = WORD.search(name)
            if first:
                self.by_word.setdefault(first[0], []).append((first.start(), name, tuple(sorted(owners[name]))))
        self.by_symbol: dict[str, list[str]] = {}
        for ticker in sorted(self.company, key=lambda t: -len(t)):
            first = WORD.search(ticker)
            if first:
                self.by_symbol.setdefault(first[0], []).append(ticker)

    def mentions(self, text: str) -> list[Mention]:
        """All mentions, names and symbols each without overlaps, in the order of their marks."""
        lower = text.lower()
        if len(lower) != len(text):  # a letter whose lower case is longer
            lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        found: list[Mention] = []
        names_from = symbols_from = 0
        for m in WORD.finditer(text):
            at = m.start()
            if at >= names_from:
                named = self._name_at(lower, at, lower[at : m.end()])
                if named and named.start >= names_from:
                    found.append(named)
                    names_from = named.end
            if at >= symbols_from and m[0] in self.by_symbol:
                marked = self._symbol_at(text, at, m[0])
                if marked:
                    found.append(marked)
                    symbols_from = marked.end
        return sorted(found, key=lambda x: (x.mark, not x.is_name))

    def _name_at(self, lower: str, at: int, word: str) -> Mention | None:
        for before, name, tickers in self.by_word.get(word, ()):
            start, end = at - before, at - before + len(name)
            # a full stop beside a name continues it, as in C3.ai
            if start >= 0 and lower.startswith(name, start) and not _joined(lower[start - 1 : start]) and not _joined(lower[end : end + 1]):
                return Mention(start, end, tickers, True, start)
        return None

    def _symbol_at(self, text: str, at: int, word: str) -> Mention | None:
        left = text[max(0, at - LOOK_BACK) : at]
        for symbol in self.by_symbol[word]:
            end = at + len(symbol)
            if not text.startswith(symbol, at):
                continue
            whole = not _word(text[end : end + 1])
            opened = OPENED.search(left)
            if left.endswith("$") and whole:
                mark = at - 1
            elif (listed := LISTED.search(left)) and whole:
                mark = at - len(left) + listed.start()
            elif opened and (MOVED.match(text, end) or len(symbol) > 2 and symbol not in AMBIGUOUS and CLOSED.match(text, end)):
                mark = at - len(left) + opened.start()
            elif len(symbol) > 2 and symbol not in AMBIGUOUS and whole:
                mark = at
            else:
                continue
            return Mention(at, end, (symbol,), False, mark)
        return None

    def tickers(self, text: str | None) -> list[str]:
        """Distinct tickers in the order of their first mention."""
        return list(dict.fromkeys(t for m in self.mentions(text) for t in m.tickers)) if text else []

    def annotated(self, text: str | None) -> str | None:
        """The text with each entity's counterpart (a name's tickers, a symbol's company) in parentheses after its first mention, unless the parentheses there hold it."""
        if not text:
            return text
        insertions, told, reached = [], set(), 0
        for m in sorted(self.mentions(text), key=lambda x: (x.start, -x.end)):
            if m.start < reached:
                continue
            reached = m.end
            if m.tickers in told:
                continue
            told.add(m.tickers)
            other = m.tickers if m.is_name else (self.company[m.tickers[0]],)
            if all(other) and not _says(text, m.end, other):
                insertions.append((m.end, f" ({', '.join(other)})"))
        for place, note in reversed(insertions):
            text = text[:place] + note + text[place:]
        return text


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _joined(c: str) -> bool:
    return c == "." or _word(c)


def _says(text: str, place: int, counterparts: tuple[str, ...]) -> bool:
    """Whether parentheses that open right behind the place hold one of the counterparts."""
    rest = text[place : place + 400].lstrip()
    inside, closed, _ = rest[1:].partition(")")
    return bool(closed) and rest.startswith("(") and any(c.lower() in inside.lower() for c in counterparts)


def universe_of(table: DataFrame) -> Universe:
    """The universe's rows on the driver; refuses to grow beyond a dimension."""
    rows = table.select(F.upper(stripped(F.col("ticker"))).alias("t"), "company_name", "segment").filter(F.col("t") != "").limit(MAX_UNIVERSE + 1).collect()
    if len(rows) > MAX_UNIVERSE:
        raise ValueError(f"the universe has more than {MAX_UNIVERSE} rows")
    return tuple(sorted((r.t, r.company_name, r.segment) for r in rows))


_BUILT: dict[Universe, Dictionary] = {}


def dictionary(universe: Universe) -> Dictionary:
    if universe not in _BUILT:
        _BUILT.clear()
        _BUILT[universe] = Dictionary(universe)
    return _BUILT[universe]


def _per_text(universe: Universe, kind: str, f: Callable[[Dictionary, str | None], object]) -> Callable[[Column], Column]:
    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        found = dictionary(universe)
        return texts.map(lambda t: f(found, t))

    return run


def mentioned(text: Column, universe: Universe) -> Column:
    return _per_text(universe, "array<string>", Dictionary.tickers)(text)


def annotated(text: Column, universe: Universe) -> Column:
    return _per_text(universe, "string", Dictionary.annotated)(text)


def derived_tags(articles: DataFrame, table: DataFrame, *, with_text: bool = True) -> DataFrame:
    """(id, primary_ticker, primary_segment, more_tickers, more_segments) from an article's tickers and, after them, its text.

    Null where an article has no ticker; arrays are null rather than empty.
    """
    universe = universe_of(table)
    # the segments of the tickers found: joined back, so that the plan holds no literal of the universe
    segments_of = table.select(F.upper(stripped(F.col("ticker"))).alias("ticker"), "segment").filter((F.col("ticker") != "") & F.col("segment").isNotNull()).dropDuplicates(["ticker"])
    listed = F.filter(F.transform(F.coalesce("tickers", F.array().cast("array<string>")), lambda x: F.upper(stripped(x))), lambda x: x.isNotNull() & (x != ""))
    found = mentioned(F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit(""))), universe) if with_text else F.array().cast("array<string>")
    rows = articles.select("id", listed.alias("_t"), found.alias("_f")).withColumn("primary_ticker", F.get("_t", F.lit(0)))
    more = F.filter(F.array_distinct(F.concat(F.slice("_t", F.lit(2), F.greatest(F.size("_t"), F.lit(1))), "_f")), lambda x: x != F.col("primary_ticker"))
    rows = rows.select("id", "primary_ticker", F.when(F.col("primary_ticker").isNotNull(), more).alias("_m"), F.monotonically_increasing_id().alias("_row"))
    every = F.concat(F.array("primary_ticker"), F.coalesce("_m", F.array().cast("array<string>")))
    each = rows.select("id", "primary_ticker", "_m", "_row", F.posexplode(every).alias("_at", "ticker")).join(F.broadcast(segments_of), "ticker", "left")  # checked: at most MAX_UNIVERSE rows
    back = each.groupBy("_row").agg(F.first("id").alias("id"), F.first("primary_ticker").alias("primary_ticker"), F.first("_m").alias("_m"), F.array_sort(F.collect_list(F.struct("_at", "segment"))).alias("_s"))
    primary = F.get("_s", F.lit(0))["segment"]
    others = F.array_distinct(F.filter(F.transform("_s", lambda x: F.when(x["_at"] > 0, x["segment"])), lambda x: x.isNotNull() & ~x.eqNullSafe(primary)))
    return back.select("id", "primary_ticker", primary.alias("primary_segment"), array_or_null(F.col("_m")).alias("more_tickers"), array_or_null(others).alias("more_segments"))
