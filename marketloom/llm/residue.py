"""Template residue and error-page text.

Method: positive-unlabelled naive Bayes fitted by expectation-maximisation, over two kinds of passages.

Lines. Trusted positives are the lines of records whose own fields report a failure (status, error, http status) and whose text is
short; all other lines are unlabelled. The first posteriors come from document rates of the words in either set, so furniture that
both share stays neutral; EM then re-estimates both word distributions, the trusted lines being free to turn negative as well. Two
anchors hold it in place: lines that recur among unlabelled records with a story stay negative, lines that recur among trusted records and never beside a story stay positive.

Marked tokens. A generic tokenizer finds tokens with marks around or before them, and words that stand for no value; a token is
described by its masked shape, marks, letter case, neighbours, and whether it stands where a number does. Trusted positives are tokens
within doubled marks and no-value words in a number's place, together with `PLACEHOLDERS`; `ORDINARY` are trusted negatives; all other
tokens are unlabelled. Tokens of an example's shape start as positive and are free to turn. So `[XX]%` and `[sic]`, or `undefined fell 3%` and `an undefined number`, are told apart by the fitted ratios.

Every line and every marked token of every record is scored with the fitted log ratios. A record is unusable when a marked token scores as a slot, or
when some line is residue and fewer than `MIN_STORY` paragraphs tell a story.

The fit reads a bounded, hash-chosen sample (`SAMPLE_POSITIVE`, `SAMPLE_UNLABELLED`, `SAMPLE_MARKED` records, of each at most `SAMPLE_CHARS`
characters or `SAMPLE_TOKENS` marked tokens); the scoring covers all rows and whole texts.

Defined results: null and blank contents are no cases; a null status, error or http status is no report of failure; without any
trusted record only slots decide; an empty table gives no rows; repeated rows are decided alike; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.session import checkpointed

SAMPLE_POSITIVE = 3000
SAMPLE_UNLABELLED = 5000
SAMPLE_MARKED = 4000
SAMPLE_CHARS = 20_000
SAMPLE_TOKENS = 100
BITS = 16
ROUNDS = 8
LONG_WORDS = 25  # a line of so many words that ends as a sentence is a paragraph
SENTENCE_ENDS = (".", "!", "?", "\"", "”", "»", ")", "…")
MIN_STORY = 2  # paragraphs that make a story; a failed page may carry one teaser
POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))
TOKENS = re.compile(r"\w+|\n")
PATH = re.compile(r"(?<![\w/])/\S+/\S+")

#: A token with marks around or before it, or a word that stands for no value.
MARKED = re.compile(
    r"[$#]?[{<\[]{1,2}[%=]{0,2}[^{}<>\[\]\n]{0,60}%?[}>\]]{1,2}|(?<![\w%$@_#])([%$@_#]{1,2})[A-Za-z][\w.]{0,40}?\1(?!\w)|(?<!\w)%[A-Za-z](?!\w)"
    r"|(?<![\w.])(?:null|None|nil|NaN|undefined|TK|TKTK)(?!\w)"
)
#: What every marked token begins with; texts without it are not searched further.
MARK_START = r"[{<\[@_#]|%[A-Za-z]|\$[A-Za-z{]|undefined|NaN|\bTK|null|None|\bnil\b"
_START = re.compile(MARK_START)
#: Examples of slots, each the marks of one template language or the null value of a program, and of ordinary uses of such marks and words.
PLACEHOLDERS = (
    "{{name}}", "{{a.b}}", "{{a|b}}", "{% if a %}", "{% endif %}", "<%= name %>", "${name}", "${a.b}", "#{name}", "{name}", "{0}", "%NAME%", "%s", "%d", "$NAME$", "__NAME__", "__name__", "@@NAME@@", "<<NAME>>", "[[a:b]]",
    "[NAME]%", "[INSERT NAME]", "[COMPANY NAME]", "<INSERT NAME>", "TKTK million", "TK percent", "$null", "null%", "undefined%", "NaN%", "$undefined", "[object Object]",
)
ORDINARY = (
    "an undefined number", "the undefined term", "is undefined in law", "are undefined here", "remains undefined until", "None of it", "the null hypothesis", "null and void", "a null result", "said [sic] in", '"[We] saw', "[They] are",
    "orders [for chips],", "orders [for the new chips]", "[ed. note]", 'matches [GET] "/a"', 'reads {"a": "B", "c": 3} and', '{"a": 1, "b": 2}', "[1] and", "<a@b.c>", "{a, b}", "f{x, y}",
)
OPENING, CLOSING = re.compile(r"^[$#]?[{<\[]+[%=]*|^[%$@_#]+"), re.compile(r"%?[}>\]]+$|[%$@_#]+$")
BEFORE, AFTER = re.compile(r"([$€£%]|[\w’'-]+|[^\w\s])\s*$"), re.compile(r"\s*([%]|[\w’'-]+|[^\w\s])")
LETTERS = re.compile(r"[^\W\d_]+")
#: What follows a number.
UNITS = frozenset("% percent million millions billion milliards milliarden millionen millones milhões milioni prozent".split())


def shape(token: str) -> str:
    """The token with each run of letters as a, A or Aa and each run of digits as 0."""
    return re.sub(r"\d+", "0", LETTERS.sub(lambda m: "A" if m[0].isupper() else "a" if m[0].islower() else "Aa", token))


SHAPES = frozenset(shape(MARKED.search(x)[0]) for x in PLACEHOLDERS)


def described(text: str, m: re.Match) -> tuple[list[str], bool, bool]:
    """Features of a marked token, whether it is trusted to be a slot, and whether the EM begins with it as one."""
    token = m[0]
    left, right = OPENING.match(token), CLOSING.search(token)
    left, right = left[0] if left else "", right[0] if right else ""
    near = [x[1].lower() if x else "" for x in (BEFORE.search(text[max(0, m.start() - 25) : m.start()]), AFTER.match(text, m.end(), m.end() + 25))]
    before, after = ("<0>" if x.isdigit() else x for x in near)
    number = bool(before) and before in "$€£" or after in UNITS
    around = [f"before:{before}", f"after:{after}"]
    if not left:
        trusted = number and not token.startswith("TK")
        return [f"word:{token}", *around, f"number:{number}", f"place:{token}{number}"], trusted, number and shape(token) in SHAPES
    inner = token[len(left) : len(token) - len(right)]
    words = LETTERS.findall(inner)
    case = "".join(sorted({"U" if w.isupper() else "l" if w.islower() else "C" for w in words})) or "0"
    quoted = '"' in inner or ": " in inner
    family = "symmetric" if left == right else "double" if len(left) > 1 else "single" if right else "prefix"
    features = [f"shape:{shape(token)[:24]}", f"marks:{left}|{right}", f"family:{family}", f"case:{family}{case}", f"words:{case}{min(3, len(words))}", *around, f"number:{number}{family}", f"quoted:{quoted}"]
    trusted = family == "double" and not quoted or family == "symmetric" and len(left) > 1
    return features + [f"in:{w.lower()}" for w in words if len(words) <= 3], trusted, trusted or shape(token) in SHAPES and (number or shape(token) != "[A]")


def marked_tokens(text: str) -> Iterator[tuple[list[str], bool, bool]]:
    if _START.search(text):
        for m in MARKED.finditer(text):
            yield described(text, m)


def fit_slots(tokens: list[tuple[list[str], bool, bool]], rounds: int = 8, add: float = 0.2) -> dict[str, float]:
    """Log ratios of the features of marked tokens: PU naive Bayes by EM from the trusted ones and the examples."""
    yes = [[f for f in described(x, MARKED.search(x))[0] if not f.startswith(("before:", "after:"))] for x in (f" {p}" for p in PLACEHOLDERS)]
    no = [described(x, MARKED.search(x))[0] for x in ORDINARY if MARKED.search(x)]
    column: dict[str, int] = {}
    coded = [[column.setdefault(f, len(column)) for f in x] for x in (*yes, *(t[0] for t in tokens), *no)]
    row, col, n = np.repeat(np.arange(len(coded)), [len(x) for x in coded]), np.array([c for x in coded for c in x]), len(column)
    sure = np.array([True] * len(yes) + [t[1] for t in tokens] + [False] * len(no))
    weight = np.array([True] * len(yes) + [t[2] for t in tokens] + [False] * len(no)).astype(float)
    told = np.bincount(col, weight[row], n) > 0
    ratio = np.zeros(n)
    for turn in range(rounds):
        inside, outside = np.bincount(col, weight[row], n), np.bincount(col, 1 - weight[row], n)
        ratio = np.log((inside + add) / (weight.sum() + add * n)) - np.log((outside + add) / ((1 - weight).sum() + add * n))
        if turn == 0:  # what no slot of the start has tells nothing yet
            ratio = np.where(told, np.maximum(ratio, -2), 0)
        weight = 1 / (1 + np.exp(-np.clip(np.bincount(row, ratio[col], len(coded)), -30, 30)))
        weight[sure] = 1
        weight[len(coded) - len(no) :] = 0
    return {f: float(ratio[c]) for f, c in column.items()}


class Columns(dict):
    """Words to hashed columns, remembered per worker; numbers are one word, marks mixed of letters and digits another."""

    def __missing__(self, word: str) -> int:
        w = word if word.isalpha() else "<0>" if word.isdigit() else "<mark>" if any(c.isdigit() for c in word) else word
        h = 2166136261
        for b in w.encode():
            h = (h ^ b) * 16777619 & 0xFFFFFFFF
        self[word] = column = -1 if word == "\n" else (h ^ h >> 16) & ((1 << BITS) - 1)
        return column


@dataclass
class Lines:
    """Hashed words and word pairs of a text's passages."""

    words: np.ndarray
    word_line: np.ndarray
    pairs: np.ndarray
    pair_line: np.ndarray
    lengths: np.ndarray  # words per passage; 0 for blank lines
    closed: np.ndarray  # whether a passage ends as a sentence does; headlines do not
    keys: np.ndarray  # a hash of each passage's words, numbers masked; 0 for blank lines

    @property
    def paragraphs(self) -> np.ndarray:
        return (self.lengths >= LONG_WORDS) & self.closed


def parsed(text: str, columns: Columns) -> Lines:
    if len(columns) > 400_000:
        columns.clear()
    closed = np.array([x.rstrip().endswith(SENTENCE_ENDS) for x in text.split("\n")])
    if "/" in text:
        text = PATH.sub("pathmark", text)
    words = TOKENS.findall(text.lower())
    ids = np.fromiter(map(columns.__getitem__, words), np.int64, len(words))
    ends = ids < 0
    line, real = np.cumsum(ends), ~ends
    both = real[1:] & real[:-1]
    pairs = ((ids[:-1] * 1000003 ^ ids[1:] * 7919) * 2654435761 >> 9 & (1 << BITS) - 1)[both] if len(ids) > 1 else ids[:0]
    lengths = np.bincount(line[real], minlength=int(line[-1]) + 1 if len(line) else 1)
    filled = np.flatnonzero(lengths)
    starts = np.cumsum(lengths)[filled] - lengths[filled]
    keys = np.zeros(len(lengths), np.uint64)
    if len(filled):
        at = np.arange(int(real.sum())) - np.repeat(starts, lengths[filled])
        keys[filled] = np.add.reduceat((ids[real].astype(np.uint64) + np.uint64(1)) * POWERS[at % len(POWERS)], starts)
    return Lines(ids[real], line[real], pairs, line[1:][both] if len(ids) > 1 else line[:0], lengths, closed, keys)


@dataclass
class Residue:
    """Log ratios of hashed words and pairs, the offset, and the log ratios of marked tokens; a passage is residue above 0."""

    word_ratio: np.ndarray
    pair_ratio: np.ndarray
    offset: float
    slots: dict[str, float]

    def scores(self, x: Lines) -> np.ndarray:
        n = len(x.lengths)
        s = np.bincount(x.word_line, self.word_ratio[x.words], n) + np.bincount(x.pair_line, self.pair_ratio[x.pairs], n) + self.offset
        return np.where(x.lengths > 0, s, -np.inf)

    def slot_score(self, text: str) -> float:
        """The highest score of the text's marked tokens."""
        ratio = self.slots.get
        return max((sum(ratio(f, 0.0) for f in features) for features, *_ in marked_tokens(text)), default=-math.inf)


def fit(positive: list[str], unlabelled: list[str], tokens: list[tuple[list[str], bool, bool]], rounds: int = ROUNDS) -> Residue:
    """PU naive Bayes by EM over the lines of trusted and unlabelled records, and over marked tokens.

    A passage of a record that tells a story (by the current scores) is negative, as is every passage of an unlabelled record with `MIN_STORY`
    paragraphs that are not residue: so what surrounds stories and failures alike counts as negative.
    """
    size, columns, slots = 1 << BITS, Columns(), fit_slots(tokens)
    if not positive:
        return Residue(np.zeros(size, np.float32), np.zeros(size, np.float32), -1.0, slots)
    texts = [parsed(t, columns) for t in positive + unlabelled]
    base = np.cumsum([0, *(len(t.lengths) for t in texts)])
    lengths = np.concatenate([t.lengths for t in texts])
    words, word_at = np.concatenate([t.words for t in texts]), np.concatenate([t.word_line + b for t, b in zip(texts, base)])
    pairs, pair_at = np.concatenate([t.pairs for t in texts]), np.concatenate([t.pair_line + b for t, b in zip(texts, base)])
    record = np.repeat(np.arange(len(texts)), np.diff(base))
    trusted, long, n = record < len(positive), np.concatenate([t.paragraphs for t in texts]), len(lengths)

    def rates(which: np.ndarray) -> np.ndarray:
        inside = which[word_at]
        seen = np.unique(record[word_at[inside]] * size + words[inside]) % size
        return (np.bincount(seen, minlength=size) + 0.5) / (len(np.unique(record[which])) + 1)

    def common(which: np.ndarray, least: int) -> set[int]:
        """Passages that stand in at least so many of the records."""
        seen = np.unique(np.stack([keys[which & (lengths > 0)], record[which & (lengths > 0)].astype(np.uint64)]), axis=1)
        values, counts = np.unique(seen[0], return_counts=True)
        return set(values[counts >= least].tolist())

    keys = np.concatenate([t.keys for t in texts])
    told = ~trusted & (np.bincount(record, long, len(texts)) >= MIN_STORY)[record]
    surroundings = common(told, 2)
    notes = common(trusted, 2) - common(told, 1)
    fixed_no, fixed_yes = np.isin(keys, np.array(sorted(surroundings), np.uint64)), np.isin(keys, np.array(sorted(notes), np.uint64))
    lift = np.log(rates(trusted)) - np.log(rates(~trusted))
    start = np.bincount(word_at, lift[words], n) / np.maximum(lengths, 1)
    weight = 1 / (1 + np.exp(-4 * (start - 1.2)))
    model = None
    for _ in range(rounds):
        stories = np.bincount(record, long & (weight < 0.5), len(texts)) >= MIN_STORY
        weight = np.where(fixed_yes, 1.0, np.where(stories[record] | fixed_no | (lengths == 0), 0.0, weight))
        ratios = []
        for ids, at in ((words, word_at), (pairs, pair_at)):
            yes, no = np.bincount(ids, weight[at], size) + 0.05, np.bincount(ids, 1 - weight[at], size) + 0.05
            ratio = np.log(yes / yes.sum()) - np.log(no / no.sum())
            ratios.append(np.where(np.bincount(ids, minlength=size) > 0, ratio, 0).astype(np.float32))
        prior = math.log((weight.sum() + 1) / ((lengths > 0).sum() - weight.sum() + 1))
        model = Residue(*ratios, prior, slots)
        score = np.bincount(word_at, ratios[0][words], n) + np.bincount(pair_at, ratios[1][pairs], n) + prior
        weight = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return model


def decide(content: str, model: Residue, columns: Columns) -> tuple[bool, float, str]:
    """(unusable, score, reason) of one non-blank content; the score is the highest of its slots, if it has any, else of its lines."""
    slot = model.slot_score(content)
    if slot > 0:
        return True, slot, "slot"
    x = parsed(content, columns)
    scores = model.scores(x)
    best = float(scores.max(initial=-1e3))
    if int((x.paragraphs & (scores <= 0)).sum()) >= MIN_STORY:
        return False, best, "story"
    return (True, best, "residue") if best > 0 else (False, best, "none")


def _blank(c: str) -> Column:
    return F.col(c).isNull() | ~F.col(c).rlike(r"[^\s ]")


def fitted(df: DataFrame, *, id_col: str = "id", text_col: str = "content") -> Residue:
    """The model of a table, from bounded samples of its trusted and its other records."""
    paragraphs = F.size(F.filter(F.split(F.col(text_col), "\n"), lambda x: (F.size(F.split(x, " ")) >= LONG_WORDS) & x.rlike(r"[.!?\"”»)]\s*$")))
    failed = F.coalesce((F.col("status") != "ok") | F.col("error").isNotNull() | (F.col("http_status") >= 400), F.lit(False))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(failed & (paragraphs < MIN_STORY), F.lit(False)).alias("trusted"), F.col(text_col).rlike(MARK_START).alias("marked")).filter(~_blank("text"))
    flags = checkpointed(rows.select("id", "trusted", "marked"))  # the texts are searched once
    totals = {(r.trusted, r.marked): r["count"] for r in flags.groupBy("trusted", "marked").count().collect()}  # four rows

    def about(most: int, total: int) -> Column:
        share = min(1.0, most / max(1, total))
        return F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 24)) < F.lit(math.ceil(share * (1 << 24)))

    wanted = {t: about(most, sum(n for (x, _), n in totals.items() if x == t)) for t, most in ((True, SAMPLE_POSITIVE), (False, SAMPLE_UNLABELLED))}
    for_lines, for_tokens = F.when(F.col("trusted"), wanted[True]).otherwise(wanted[False]), F.col("marked") & about(SAMPLE_MARKED, sum(n for (_, m), n in totals.items() if m))
    chosen = flags.select("id", "trusted", for_lines.alias("for_lines"), for_tokens.alias("for_tokens")).filter("for_lines OR for_tokens").distinct()  # about as many rows as the bounds of the samples
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t for text in batch.column(0).to_pylist() for t in islice(marked_tokens(text), SAMPLE_TOKENS)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.list_(pa.string())), pa.array([f[1] for f in found], pa.bool_()), pa.array([f[2] for f in found], pa.bool_())], names=["features", "trusted", "begins"])

    sample = texts.filter("for_lines").select("trusted", F.substring("text", 1, SAMPLE_CHARS).alias("text")).collect()
    marked = texts.filter("for_tokens").select("text")
    tokens = [(list(r.features), r.trusted, r.begins) for r in marked.mapInArrow(tokens_of, "features array<string>, trusted boolean, begins boolean").collect()]
    return fit([r.text for r in sample if r.trusted], [r.text for r in sample if not r.trusted], tokens)


def unusable(df: DataFrame, *, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """(id, unusable, score, reason) of every row; null and blank contents are usable=not a case with reason `blank`."""
    shared = df.sparkSession.sparkContext.broadcast(fitted(df, id_col=id_col, text_col=text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, columns = shared.value, Columns()
        for batch in batches:
            out = [decide(t, model, columns) if t and t.strip() else (False, 0.0, "blank") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o[0] for o in out], pa.bool_()), pa.array([o[1] for o in out], pa.float64()), pa.array([o[2] for o in out], pa.string())], names=["id", "unusable", "score", "reason"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, unusable boolean, score double, reason string")
