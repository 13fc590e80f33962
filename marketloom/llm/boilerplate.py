"""Page boilerplate mixed with main content.

Method: host suffix array. Every page is cut into blocks of words between block tags (runs); the token streams of a host's pages are
concatenated, each run behind a mark, and prefix doubling ranks all suffixes by their first 2, 4, ... tokens, until they are told apart over the longest
run. The suffixes at the runs are put in order; the longest common prefix of neighbours tells how far a substring from there on is repeated. A run is
covered when the substring from its mark to the next one is repeated as a whole in at least `MIN_PAGES` distinct pages (pages of one headline are one page).
What such substrings cover is boilerplate, and unique runs are kept. Place only settles unique runs that can be no part of the story: outside the element that holds the headline, in a link as a
whole, or in a kind of element whose blocks are mostly covered on this host (lists of other stories have a text of their own). Kept although repeated: bylines (a pattern
with many fillers before the first paragraph, or the author's name) and notes on a company of the headline. Each line found comes with its reason.

A host is cut into blocks of `PAGES` pages by a hash of the id, so that a host with a third of all pages is many tasks. Blocks only
name the runs and list what they saw; every count that decides (pages of a run, fillers of a byline, shares of a kind of element) is
taken over the whole host and sent back to the blocks, so the result does not depend on how a host is cut. A page is told from
another by its headline, or by its content where the headline is empty or is that of most pages of the host.

Defined results: null html or null content gives no rows; blank lines are numbered but never found; a null host is a host
of its own; a content line that is not on its page is judged by repetition alone; an empty table gives no rows; repeated rows are
judged alike; a host of fewer than `MIN_PAGES` headlines is judged by place alone.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import checkpointed

PAGES = 1500
MIN_PAGES = 4
MIN_FILLERS = 3
MOSTLY = 0.6

TAG = re.compile(r"<!--.*?-->|<(script|style|title)\b[^>]*>(.*?)</\1\s*>|<(/?)([a-zA-Z][\w-]*)([^>]*)>", re.S)
WORDS = re.compile(r"\w+")
DIGITS = re.compile(r"\d+")
ATTRIBUTES = re.compile(r"(?:class|id|role)\s*=\s*[\"']?([^\"'>\s]+)")
NAME = re.compile(r"[^\W\d_a-z][\w'’-]*(?:[ -](?:&|[^\W\d_a-z][\w.'’-]*|[dD]e [^\W\d_a-z][\w'’-]*))+")
SEPARATED = re.compile(r"\s+[·|•]\s+")
INLINE = frozenset("a b strong i em small span font u sup sub mark abbr time".split())
VOID = frozenset("meta br img link input hr wbr source col area base embed".split())
CLOSES_P = frozenset("p div ul ol li table tr td h1 h2 h3 h4 h5 h6 section article main footer header aside nav form blockquote address center hr".split())

MARK = 0x3FFFFFFF  # begins a run
LINK, INSIDE, AUTHOR, HEADLINE, EARLY, ELSEWHERE = 1, 2, 4, 8, 16, 32


class Hash(dict):
    """Strings to 31-bit numbers, remembered per worker."""

    def __missing__(self, word: str) -> int:
        h = 2166136261
        for b in (DIGITS.sub("0", word)).encode():
            h = (h ^ b) * 16777619 & 0xFFFFFFFF
        self[word] = h = (h ^ h >> 15) & 0x3FFFFFFF
        return h


class Block:
    __slots__ = ("text", "path", "wrap", "link")

    def __init__(self, text: str, path: tuple[str, ...], wrap: str, link: bool) -> None:
        self.text, self.path, self.wrap, self.link = text, path, wrap, link


def blocks_of(page: str) -> tuple[str, list[Block]]:
    """The page's title and its blocks of text in order."""
    title, out, stack, inline, pieces = "", [], [], [], []
    place = 0

    def flush() -> None:
        if pieces:
            text = "".join(p[0] for p in pieces)
            if text.strip():
                wraps = [p[1] for p in pieces if p[0].strip()]
                link = all("a" in w for w in wraps)
                common = wraps[0][-1] if all(w and w[-1] == wraps[0][-1] for w in wraps) else ""
                out.append(Block(html.unescape(text) if "&" in text else text, tuple(stack), common, link))
                if link and len(wraps) > 1:
                    out.extend(Block(html.unescape(p[0]), tuple(stack), "a", True) for p in pieces if p[0].strip())
            pieces.clear()

    for m in TAG.finditer(page):
        start, end = m.span()
        if start > place:
            pieces.append((page[place:start], tuple(inline)))
        place = end
        if m[1]:
            if m[1] == "title":
                title = html.unescape(m[2]).strip()
            continue
        if not m[4]:
            continue
        tag, closing = m[4].lower(), bool(m[3])
        if tag in INLINE:
            if closing:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k].split(".")[0] == tag:
                        del inline[k:]
                        break
            else:
                kind = ATTRIBUTES.search(m[5]) if tag != "a" else None
                inline.append(f"{tag}.{DIGITS.sub('0', kind[1])}" if kind else tag)
            continue
        flush()
        inline.clear()
        if tag in VOID:
            if tag == "hr" and stack and stack[-1].split(".")[0] == "p":
                stack.pop()
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].split(".")[0] == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P and stack and stack[-1].split(".")[0] == "p":
            stack.pop()
        if tag in ("li", "td", "tr", "option") and stack and stack[-1].split(".")[0] == tag:
            stack.pop()
        kind = ATTRIBUTES.search(m[5])
        stack.append(f"{tag}.{DIGITS.sub('0', kind[1])}" if kind else tag)
    if place < len(page):
        pieces.append((page[place:], tuple(inline)))
    flush()
    return title, out


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(" ".join(text.lower().split()).encode(), digest_size=8).digest(), "big") >> 1


def page_row(page: str, content: str, author: str | None, hashed: Hash) -> dict:
    """What the host's task needs of one page: token stream, blocks with their place and flags, and the blocks of the content's lines."""
    if len(hashed) > 600_000:
        hashed.clear()
    title, blocks = blocks_of(page)
    headline, _, site = title.rpartition(" - ")
    headline = headline or title
    key_of = lambda s: tuple(map(hashed.__getitem__, WORDS.findall(s.lower())))
    head_key = key_of(headline)
    keys = [key_of(b.text) for b in blocks]
    container = None
    for b, k in zip(blocks, keys):
        if k and k == head_key:
            container = b.path[:-1] if b.path and b.path[-1].split(".")[0] in ("h1", "h2", "h3", "h4", "h5", "h6", "p") else b.path
            break
    tokens, starts, sigs, flags, patterns, fillers = [], [], [], [], [], []
    first_paragraph = False

    def add(text: str, key: tuple[int, ...], path: tuple[str, ...], wrap: str, link: bool) -> None:
        nonlocal first_paragraph
        inside = container is not None and path[: len(container)] == container
        first_paragraph |= inside and not link and len(key) >= 20
        flag = LINK * link + INSIDE * inside + EARLY * (not first_paragraph) + AUTHOR * bool(author and author.lower() in text.lower()) + ELSEWHERE * (wrap == "?")
        names = [n for n in NAME.findall(text) if not (site and site in n)]
        if any(n.rstrip(".") in headline for n in names):
            flag |= HEADLINE
        pattern = filler = 0
        if names and len(key) <= 20:
            rest = text
            for n in names:
                rest = rest.replace(n, "\x00")
            pattern, filler = hashed[" ".join(rest.lower().split())], hashed["|".join(names)]
        starts.append(len(tokens)), tokens.append(MARK), tokens.extend(key)
        sigs.append(hashed[">".join(path[-2:]) + "|" + wrap]), flags.append(flag), patterns.append(pattern), fillers.append(filler)

    known: dict[tuple[int, ...], int] = {}
    for b, k in zip(blocks, keys):
        if k:
            known.setdefault(k, len(starts))
            add(b.text, k, b.path, b.wrap, b.link)
    numbers, at = [], []
    for n, line in enumerate(content.split("\n"), 1):
        key = key_of(line)
        if not key:
            continue
        block = known.get(key)
        if block is None:
            parts = SEPARATED.split(line.strip())
            inner = [known.get(key_of(p)) for p in parts] if len(parts) > 1 else []
            if inner and all(i is not None and flags[i] & LINK for i in inner):
                block = inner[0]
            else:
                block = len(starts)
                add(line, key, container or (), "?", False)
        numbers.append(n), at.append(block)
    starts.append(len(tokens))
    body = _digest(content)
    return {"headline": _digest(headline) if headline.strip() else body, "body": body, "tokens": tokens, "starts": starts, "sigs": sigs, "flags": flags, "patterns": patterns, "fillers": fillers, "lines": numbers, "at": at, "placed": container is not None}


def suffix_ranks(tokens: np.ndarray, longest: int) -> list[np.ndarray]:
    """ranks[k][i]: class of the 2**k tokens from i on, by prefix doubling, up to the first 2**k of at least `longest` (positions past the end are a class of their own)."""
    ranks = [np.unique(tokens, return_inverse=True)[1].astype(np.int32)]
    step = 1
    while step < longest:
        prior = ranks[-1].astype(np.int64)
        after = np.full(len(prior), -1, np.int64)
        if step < len(prior):
            after[:-step] = prior[step:]
        key = prior << 32 | after + 1
        order = np.argsort(key)
        changed = np.concatenate([[False], np.diff(key[order]) != 0])
        rank = np.empty(len(key), np.int32)
        rank[order] = np.cumsum(changed)
        ranks.append(rank)
        step *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a and at b, counted as far as the ranks reach."""
    n, length = len(ranks[0]), np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        for _ in range(2 if k == len(ranks) - 1 else 1):
            i, j = a + length, b + length
            inside = np.flatnonzero((i + (1 << k) <= n) & (j + (1 << k) <= n))
            same = inside[ranks[k][i[inside]] == ranks[k][j[inside]]]
            length[same] += 1 << k
    return length


def run_classes(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A class for each run [start, end) of a stream in which every run begins with a mark and a mark follows the last: equal exactly for equal runs.

    Runs are neighbours in the suffix array if they are equal, and then their common prefix reaches to the mark behind them.
    """
    size = ends - starts
    ranks = suffix_ranks(tokens, int(size.max()) + 1)
    order = starts[np.argsort(ranks[-1][starts], kind="stable")]
    length = np.zeros(len(tokens) + 1, np.int64)
    length[starts] = size
    new = np.ones(len(order), bool)
    new[1:] = common_prefixes(ranks, order[:-1], order[1:]) < np.maximum(length[order[:-1]], length[order[1:]]) + 1
    classes = np.empty(len(tokens) + 1, np.int64)
    classes[order] = np.cumsum(new)
    return classes[starts]


def run_names(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 63-bit name for each run, of its whole text: equal in every block exactly where `run_classes` is equal within one."""
    _, at, classes = np.unique(run_classes(np.append(tokens, MARK), starts, ends), return_index=True, return_inverse=True)
    data = tokens.astype(np.int64)
    names = np.array([int.from_bytes(hashlib.blake2b(data[b:e].tobytes(), digest_size=8).digest(), "big") >> 1 for b, e in zip(starts[at].tolist(), ends[at].tolist())], np.int64)
    return names[classes]


def _first_few(keys: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Positions of the distinct (key, a, b): of each key at most `most` smallest a, of each (key, a) at most `most` b. That is all of them, or enough to tell that there are `most`."""
    order = np.lexsort((b, a, keys))
    changes = lambda x: np.concatenate([np.ones(min(1, len(x)), bool), x[order][1:] != x[order][:-1]])
    new_key = changes(keys)
    new_a = new_key | changes(a)
    new = new_a | changes(b)
    order, new_key, new_a = order[new], new_key[new], new_a[new]
    here, nth = np.arange(len(order)), np.cumsum(new_a)
    first = lambda x: np.maximum.accumulate(np.where(x, here, 0))
    return order[(nth - nth[first(new_key)] < most) & (here - first(new_a) < most)]


def _flat(group: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists in one array, and the lists' lengths."""
    lists = group.column(column).combine_chunks()
    return lists.flatten().to_numpy().astype(np.int64), pc.list_value_length(lists).to_numpy().astype(np.int64)


def _runs_of(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all blocks of text: start within the page, length, and page."""
    starts, sizes = _flat(group, "starts")
    last = np.cumsum(sizes) - 1
    return np.delete(starts, last), np.delete(np.diff(starts), last[:-1]), np.repeat(np.arange(len(sizes)), sizes - 1)


PAGE, RUN, PATTERN, HEAD, SIG = range(5)  # kinds of rows


def seen_in(group: pa.Table, min_pages: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """Names of the runs of one block of a host, and what else it saw: (kind, keys, a, b)."""
    tokens, sizes = _flat(group, "tokens")
    starts, length, page = _runs_of(group)
    starts = starts + (np.cumsum(sizes) - sizes)[page]
    runs = run_names(tokens, starts, starts + length) if len(starts) else np.zeros(0, np.int64)
    headline, body = (group.column(c).to_numpy() for c in ("headline", "body"))
    heads, which, pages = np.unique(headline, return_inverse=True, return_counts=True)
    place = np.empty(len(heads), np.int64)
    place[np.argsort(-pages, kind="stable")] = np.arange(len(heads))  # headlines of many pages first
    (sigs, _), (patterns, _), (fillers, _) = (_flat(group, c) for c in ("sigs", "patterns", "fillers"))
    few = _first_few(runs, place[which[page]], body[page], min_pages)
    named = np.flatnonzero(patterns > 0)
    named = named[_first_few(patterns[named], fillers[named], np.zeros(len(named), np.int64), MIN_FILLERS)]
    kinds = np.unique(sigs)
    return runs, [(RUN, runs[few], headline[page[few]], body[page[few]]), (PATTERN, patterns[named], fillers[named], fillers[named]), (HEAD, heads, pages, pages), (SIG, kinds, kinds, kinds)]


def _bad(group: pa.Table, marks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all blocks of text whether they are covered by repetition, whether they are links, and whether they are kept although repeated."""
    kind, key = marks.column("kind").to_numpy(), marks.column("key").to_numpy()
    runs, flags, patterns = (_flat(group, c)[0] for c in ("runs", "flags", "patterns"))
    covered, byline = np.isin(runs, key[kind == RUN]), np.isin(patterns, key[kind == PATTERN]) & ((flags & EARLY) > 0)
    link, inside = (flags & LINK) > 0, (flags & INSIDE) > 0
    kept = inside & ~link & (byline | ((flags & AUTHOR) > 0) | ((flags & HEADLINE) > 0))
    return covered & ~kept, link, kept


def shares_of(group: pa.Table, marks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each kind of element of one block of a host: number of blocks of text, how many are boilerplate, words of the others."""
    covered, link, kept = _bad(group, marks)
    bad = covered | link
    kinds, sig = np.unique(_flat(group, "sigs")[0], return_inverse=True)
    return kinds, np.bincount(sig, minlength=len(kinds)), np.bincount(sig, bad & ~kept, len(kinds)).astype(np.int64), np.bincount(sig, np.where(bad, 0, _runs_of(group)[1]), len(kinds)).astype(np.int64)


REASONS = ("repeated", "link", "outside", "element")


def judged(group: pa.Table, marks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, line numbers and reasons of boilerplate lines among the pages of one block of a host: repetition first, place where it tells nothing."""
    covered, link, kept = _bad(group, marks)
    (sigs, counts), (flags, _), (at, _), (lines, sizes) = (_flat(group, c) for c in ("sigs", "flags", "at", "lines"))
    doubtful = np.isin(sigs, marks.column("key").to_numpy()[marks.column("kind").to_numpy() == SIG]) & ((flags & ELSEWHERE) == 0)  # a line that isn't on its page has no element
    placed = np.repeat(group.column("placed").to_numpy(), counts).astype(bool)
    reason = np.select([covered, link, placed & ((flags & INSIDE) == 0), doubtful & ~kept], range(4), -1)
    page = np.repeat(np.arange(len(sizes)), sizes)
    of_line = reason[at + (np.cumsum(counts) - counts)[page]]
    found = of_line >= 0
    return page[found], lines[found], of_line[found]


_PAGE = "headline bigint, body bigint, tokens array<int>, starts array<int>, sigs array<int>, flags array<int>, patterns array<int>, fillers array<int>, lines array<int>, `at` array<int>, placed boolean"
_KINDS = {"headline": pa.int64(), "body": pa.int64(), "placed": pa.bool_()}
_NAMES = ("headline", "body", "tokens", "starts", "sigs", "flags", "patterns", "fillers", "lines", "at", "placed")
_BLOCK = "kind int, keys array<bigint>, a array<bigint>, b array<bigint>, runs array<bigint>, starts array<int>, sigs array<int>, flags array<int>, patterns array<int>, lines array<int>, `at` array<int>, placed boolean"
_KEPT = ("starts", "sigs", "flags", "patterns", "lines", "at", "placed")


def _over_hosts(seen: DataFrame, min_pages: int) -> DataFrame:
    """(host, cut, kind, key) of the runs and byline patterns that are frequent over the whole host, for each block they are in."""
    each = seen.filter(F.col("kind").isin(RUN, PATTERN, HEAD)).select("host", "cut", "kind", F.inline(F.arrays_zip("keys", "a", "b"))).withColumnRenamed("keys", "key")
    heads = each.filter(F.col("kind") == HEAD).groupBy("host", "key").agg(F.sum("a").alias("n"))
    hosts = heads.groupBy("host").agg(F.sum("n").alias("pages"), F.max_by("key", "n").alias("shared"), F.max("n").alias("n"))
    # the host's headline that most of its pages have, if there is one: it doesn't tell pages apart
    shared = hosts.filter((F.col("pages") >= 2 * min_pages) & (2 * F.col("n") > F.col("pages"))).select("host", "shared")
    marks = each.filter(F.col("kind") != HEAD)
    told = marks.join(shared, "host", "left").withColumn("told", F.when((F.col("kind") == RUN) & (F.col("a") == F.col("shared")), F.col("b")).otherwise(F.col("a")))
    least = F.when(F.col("kind") == RUN, min_pages).otherwise(MIN_FILLERS)
    frequent = told.groupBy("host", "kind", "key").agg(F.count_distinct("told").alias("n")).filter(F.col("n") >= least).select("host", "kind", "key")
    return marks.select("host", "cut", "kind", "key").distinct().join(frequent, ["host", "kind", "key"], "left_semi").select("host", "cut", "kind", "key")


def _doubtful(shares: DataFrame, seen: DataFrame, min_pages: int) -> DataFrame:
    """(host, cut, kind, key) of the kinds of element whose blocks are mostly boilerplate on the host, unless they hold its own text."""
    sums = shares.groupBy("host", "key").agg(*(F.sum(c).alias(c) for c in ("n", "bad", "words")))
    most = sums.groupBy("host").agg(F.greatest(F.max("words"), F.lit(1)).alias("most"))
    doubtful = sums.join(most, "host").filter((F.col("bad") >= MOSTLY * F.col("n")) & (F.col("words") < 0.2 * F.col("most")) & (F.col("n") >= min_pages)).select("host", "key")
    kinds = seen.filter(F.col("kind") == SIG).select("host", "cut", "kind", F.explode("keys").alias("key"))
    return kinds.join(doubtful, ["host", "key"], "left_semi").select("host", "cut", "kind", "key")


def boilerplate_lines(df: DataFrame, *, pages: int = PAGES, min_pages: int = MIN_PAGES, id_col: str = "id", host_col: str = "source_domain", html_col: str = "raw_html", text_col: str = "content", author_col: str = "author") -> DataFrame:
    """(id, line_no, reason) of the content lines that are no part of the page's main body: repeated, link, outside or element."""
    usable = df.filter(F.col(html_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = usable.groupBy(F.coalesce(F.col(host_col), F.lit("")).alias("host")).agg(F.ceil(F.count("*") / F.lit(pages)).cast("int").alias("cuts"))
    rows = usable.select(F.col(id_col).alias("id"), F.coalesce(F.col(host_col), F.lit("")).alias("host"), F.col(html_col).alias("page"), F.col(text_col).alias("text"), F.col(author_col).alias("author"))
    kind = rows.schema["id"].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hash()
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                out = [page_row(p, t, a, hashed) for p, t, a in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
                arrays = [pa.array([o[c] for o in out], _KINDS.get(c, pa.list_(pa.int32()))) for c in _NAMES]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["id", "host", *_NAMES])

    def name(group: pa.Table) -> pa.Table:
        runs, seen = seen_in(group, min_pages)
        counts = _flat(group, "sigs")[1]
        pages_ = group.select(["host", "cut", "id", *_KEPT]).append_column("kind", pa.array(np.full(len(group), PAGE), pa.int32()))
        pages_ = pages_.append_column("runs", pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pa.array(runs)))
        lists = {c: pa.array([x[k] for x in seen], pa.list_(pa.int64())) for k, c in ((1, "keys"), (2, "a"), (3, "b"))}
        stats = pa.table({"host": pa.array([group.column("host")[0].as_py()] * len(seen), group.schema.field("host").type), "cut": pa.array([group.column("cut")[0].as_py()] * len(seen), group.schema.field("cut").type), "kind": pa.array([x[0] for x in seen], pa.int32()), **lists})
        return pa.concat_tables([pages_, stats], promote_options="default").select(["host", "cut", "id", "kind", "keys", "a", "b", "runs", *_KEPT])

    def share(group: pa.Table, marks: pa.Table) -> pa.Table:
        keys, n, bad, words = shares_of(group, marks)
        return pa.table({"host": pa.array([group.column("host")[0].as_py()] * len(keys), pa.string()), "key": pa.array(keys, pa.int64()), "n": pa.array(n, pa.int64()), "bad": pa.array(bad, pa.int64()), "words": pa.array(words, pa.int64())})

    def judge(group: pa.Table, marks: pa.Table) -> pa.Table:
        page, lines, reason = judged(group, marks)
        return pa.table({"id": group.column("id").combine_chunks().take(pa.array(page, pa.int64())), "line_no": pa.array(lines, pa.int32()), "reason": pa.array(np.array(REASONS, object)[reason], pa.string())})

    parsed = rows.mapInArrow(parse, f"id {kind}, host string, {_PAGE}")
    # a row per host: broadcast by the planner only while that is small
    keyed = parsed.join(sizes, "host").withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts"))).drop("cuts")
    # pages are parsed and their runs named once; what the blocks saw is a few numbers per block of text
    seen = checkpointed(keyed.groupBy("host", "cut").applyInArrow(name, f"host string, cut bigint, id {kind}, {_BLOCK}"))
    blocks = seen.filter(F.col("kind") == PAGE).drop("kind", "keys", "a", "b").groupBy("host", "cut")
    marks = checkpointed(_over_hosts(seen, min_pages))
    of_blocks = lambda m: m.select(F.col("host").alias("to_host"), F.col("cut").alias("to_cut"), "kind", "key").groupBy("to_host", "to_cut")
    shares = blocks.cogroup(of_blocks(marks)).applyInArrow(share, "host string, key bigint, n bigint, bad bigint, words bigint")
    marks = marks.unionByName(_doubtful(shares, seen, min_pages))
    return blocks.cogroup(of_blocks(marks)).applyInArrow(judge, f"id {kind}, line_no int, reason string")
