"""Lines repeated across the documents of one source.

Method: every line is parsed into a template by a fixed-depth token tree. A line goes down by its source, its number of tokens and its
first `depth` tokens, where a token with digits is a wildcard slot; the leaf holds the template of all its lines, in which a position
becomes a wildcard slot as soon as two of them differ there. Each task grows the trees of its partition in one pass over the texts
and passes on the number of documents of each leaf. The trees are merged by leaf: numbers of documents are added. A leaf that covers fewer
than `min_docs` documents ends there. On the others an exact test follows: the line's form, with digits as the only wildcard, must stand in
at least `min_docs` documents of the source.

Where templates are asked for, a second pass over the texts meets every line of the leaves that are left, position by position, in each task and then over the tasks.

What the first pass leaves (a line number and two hashes per line) is checkpointed. Leaves that cover many documents are few beside the
lines (a site's furniture), so they are broadcast if they were counted to be few, else joined by a shuffle.

Defined results: a row is a document, so that a row given twice counts twice; a null content has no lines; a null source is a source of its own; blank lines are numbered but are never
repeated; several equal lines in one document count once towards `min_docs` and are all found; an empty table gives no rows;
further columns of the input are ignored, whatever their names. A template shows all lines of its leaf, whatever the tasks and the order they were read in.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import checkpointed, counted_small

DEPTH = 4
SLOT = "<*>"
DIGITS = re.compile(r"\d+")
MAX_LEAVES = 100_000  # leaves a task holds before it passes them on
BROADCAST_ROWS = 200_000  # rows of two or three numbers

DOCUMENT, LEAF = 0, 1


def form_of(line: str) -> str:
    """Lower case, outer white space removed, each run of white space one blank, each run of digits one 0."""
    return DIGITS.sub("0", " ".join(line.lower().split()))


def _hash(text: str, salt: bytes = b"") -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8, salt=salt).digest(), "little", signed=True)


class Forest:
    """The token trees of one task, kept by the addresses of their leaves."""

    def __init__(self, depth: int) -> None:
        self.depth, self.known = depth, {}
        self.docs: dict[int, int] = {}
        self.first: dict[int, str] = {}  # a leaf's first form
        self.templates: dict[int, list[str | None]] = {}  # of the leaves with another form
        self.sources: dict[int, str | None] = {}

    def _parsed(self, line: str) -> tuple[int, int, str]:
        """The form's hash, the hash of its way down a tree, and the form; 0, 0 for a blank line."""
        form = form_of(line)
        if not form:
            return 0, 0, ""
        tokens = form.split(" ")
        way = " ".join(SLOT if "0" in t else t for t in tokens[: self.depth])
        return _hash(form), _hash(f"{len(tokens)} {way}"), form

    def _lines(self, source: str | None, content: str) -> Iterator[tuple[int, int, int, str]]:
        """Number, leaf, form's hash and form of a document's lines that are not blank."""
        root = _hash(source, b"s") if source is not None else 1
        for n, line in enumerate(content.split("\n"), 1):
            found = self.known.get(line)
            if found is None:
                found = self._parsed(line)
                if len(line) <= 200:
                    if len(self.known) > 50_000:
                        self.known.clear()
                    self.known[line] = found
            if found[2]:
                yield n, (found[1] ^ root * 0x2545F4914F6CDD1D + (1 << 63)) % (1 << 64) - (1 << 63), found[0], found[2]

    def add(self, source: str | None, content: str) -> tuple[list[int], list[int], list[int]]:
        """Grows the source's tree by a document: line numbers, leaves and forms of its lines that are not blank."""
        numbers, leaves, forms = [], [], []
        for n, leaf, form, _ in self._lines(source, content):
            numbers.append(n), leaves.append(leaf), forms.append(form)
        for leaf in set(leaves):
            self.docs[leaf] = self.docs.get(leaf, 0) + 1
        return numbers, leaves, forms

    def meet(self, source: str | None, content: str, wanted: frozenset[int] | None) -> None:
        """Meets the templates of the wanted leaves (null for all) with every line of a document."""
        for _, leaf, _, form in self._lines(source, content):
            if wanted is not None and leaf not in wanted:
                continue
            first = self.first.get(leaf)
            if first is None:
                self.first[leaf], self.sources[leaf] = form, source
            elif form != first:
                template = self.templates.get(leaf)
                if template is None:
                    template = self.templates[leaf] = first.split(" ")
                for i, (a, b) in enumerate(zip(template, form.split(" "))):
                    if a is not None and a != b:
                        template[i] = None

    def passed_on(self) -> list[tuple[int, int]]:
        """(leaf, documents) of each leaf."""
        rows, self.docs = list(self.docs.items()), {}
        return rows

    def passed_templates(self) -> list[tuple[int, str | None, list[str | None]]]:
        """(leaf, source, template) of each leaf that was met."""
        rows = [(leaf, self.sources[leaf], self.templates.get(leaf) or form.split(" ")) for leaf, form in self.first.items()]
        self.first, self.templates, self.sources = {}, {}, {}
        return rows


_TREE = "kind int, line_no array<int>, leaf array<bigint>, form array<bigint>, docs array<int>"
_TEMPLATE = "leaf bigint, source string, template array<string>"


def _texts(df: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return df.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))


def grown(df: DataFrame, *, depth: int = DEPTH, lines: bool = True, id_col: str = "id", source_col: str = "source_domain", text_col: str = "content") -> DataFrame:
    """What one pass over the texts leaves, checkpointed: if `lines`, a row per document with its lines' leaves and forms; and rows of the tasks' trees."""
    rows = _texts(df, id_col, source_col, text_col)
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, kind_of_id = Forest(depth), None

        def tree() -> pa.RecordBatch:
            leaves = forest.passed_on()
            parts = [leaves[s : s + 5000] for s in range(0, len(leaves), 5000)]
            column = lambda k, t: pa.array([[x[k] for x in p] for p in parts], t)
            empty = lambda t: pa.nulls(len(parts), t)
            return pa.RecordBatch.from_arrays([empty(kind_of_id), pa.array([LEAF] * len(parts), pa.int32()), empty(ints), column(0, longs), empty(longs), column(1, ints)], names=["id", "kind", "line_no", "leaf", "form", "docs"])

        for batch in batches:
            kind_of_id = batch.column(0).type
            out = [forest.add(s, t) for s, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            if lines:
                n = len(out)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([DOCUMENT] * n, pa.int32()), pa.array([o[0] for o in out], ints), pa.array([o[1] for o in out], longs), pa.array([o[2] for o in out], longs), pa.nulls(n, ints)], names=["id", "kind", "line_no", "leaf", "form", "docs"])
            if len(forest.docs) > MAX_LEAVES:
                yield tree()
        if forest.docs:
            yield tree()

    return checkpointed(rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {_TREE}"))


def covering_leaves(trees: DataFrame, min_docs: int) -> DataFrame:
    """(leaf, docs) of the merged trees' leaves that cover at least `min_docs` documents."""
    leaves = trees.filter(F.col("kind") == LEAF).select(F.inline(F.arrays_zip("leaf", "docs")))
    return checkpointed(leaves.groupBy("leaf").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs))


def met_templates(df: DataFrame, covering: DataFrame, *, depth: int = DEPTH, id_col: str = "id", source_col: str = "source_domain", text_col: str = "content") -> DataFrame:
    """(leaf, source, template) of each task's lines on the covering leaves; these are broadcast if they are few, else all leaves are met and joined by a shuffle."""
    few = covering.select("leaf").limit(BROADCAST_ROWS + 1).collect()
    wanted = df.sparkSession.sparkContext.broadcast(frozenset(r.leaf for r in few) if len(few) <= BROADCAST_ROWS else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest(depth)

        def met() -> Iterator[pa.RecordBatch]:
            leaves = forest.passed_templates()
            for part in (leaves[s : s + 5000] for s in range(0, len(leaves), 5000)):
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in part], t) for k, t in enumerate((pa.int64(), pa.string(), pa.list_(pa.string())))], names=["leaf", "source", "template"])

        for batch in batches:
            for source, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                forest.meet(source, text, wanted.value)
                if len(forest.first) > MAX_LEAVES:
                    yield from met()
        yield from met()

    parts = _texts(df, id_col, source_col, text_col).mapInArrow(run, _TEMPLATE)
    return parts if len(few) <= BROADCAST_ROWS else parts.join(covering.select("leaf"), "leaf", "left_semi")


def merged_templates(parts: DataFrame, covering: DataFrame) -> DataFrame:
    """(source, template, slots, docs) of the covering leaves: a position on which two tasks' trees differ, or that is a slot in one, is a slot."""
    cells = parts.select("leaf", "source", F.posexplode("template").alias("at", "token"))
    met = cells.groupBy("leaf", "at").agg(F.when((F.count("*") == F.count("token")) & (F.min("token") == F.max("token")), F.min("token")).alias("token"), F.min("source").alias("source"))
    whole = met.groupBy("leaf").agg(F.min("source").alias("source"), F.array_sort(F.collect_list(F.struct("at", "token"))).alias("t"), F.count_if(F.col("token").isNull()).alias("slots"))
    return whole.join(covering, "leaf").select("source", F.array_join(F.transform("t", lambda x: x["token"]), " ", SLOT).alias("template"), "slots", "docs")


def find_repeated_lines(df: DataFrame, *, min_docs: int = 4, depth: int = DEPTH, id_col: str = "id", source_col: str = "source_domain", text_col: str = "content") -> DataFrame:
    """(id, line_no, docs) of every line on a covering leaf whose form stands in at least `min_docs` documents of its source."""
    trees = grown(df, depth=depth, id_col=id_col, source_col=source_col, text_col=text_col)
    covering = counted_small(covering_leaves(trees, min_docs).select("leaf"), BROADCAST_ROWS)
    documents = trees.filter(F.col("kind") == DOCUMENT)
    once = documents.select(F.inline(F.array_distinct(F.arrays_zip("leaf", "form")))).join(covering, "leaf", "left_semi")
    exact = checkpointed(once.groupBy("leaf", "form").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs))
    lines = documents.select("id", F.inline(F.arrays_zip("line_no", "leaf", "form")))
    return lines.join(counted_small(exact, BROADCAST_ROWS), ["leaf", "form"]).select("id", "line_no", "docs")


def templates(df: DataFrame, *, min_docs: int = 4, depth: int = DEPTH, **columns: str) -> DataFrame:
    """(source, template, slots, docs) of the templates that cover at least `min_docs` documents."""
    covering = covering_leaves(grown(df, depth=depth, lines=False, **columns), min_docs)
    return merged_templates(met_templates(df, covering, depth=depth, **columns), covering)


def without_lines(df: DataFrame, found: DataFrame, *, id_col: str = "id", text_col: str = "content", out_col: str = "clean") -> DataFrame:
    """(id, clean, removed): each document's text without the found lines; null text stays null."""
    gone = found.groupBy("id").agg(F.sort_array(F.collect_set("line_no")).alias("_gone"))
    joined = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text")).join(gone, "id", "left")
    kept = F.filter(F.split("_text", "\n", -1), lambda _, i: ~F.array_contains(F.coalesce("_gone", F.array().cast("array<int>")), (i + 1).cast("int")))
    return joined.select("id", F.array_join(kept, "\n").alias(out_col), F.coalesce(F.size("_gone"), F.lit(0)).alias("removed"))
