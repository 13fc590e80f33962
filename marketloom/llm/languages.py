"""Missing or wrong document language labels.

Method: multinomial naive Bayes over hashed character n-grams. The model is a matrix of log-probabilities, languages by hashed
n-grams (0.26 MB a language, at most `MAX_LANGUAGES`), fitted on a bounded sample of labelled rows and broadcast. A batch of texts is scored at
once in numpy: the characters of all its lines are folded to one array, each n-gram is a rolling hash, and the sparse sum of
the matrix's rows is a cumulative sum cut at the lines.

The languages are those the labels name: any code of two or three letters, or a name of `NAMES`. Labels may be wrong, so a label counts as
a language only if a model of one half of its texts finds most lines of the other half (`LEAST_RECALL`); labels such as `xx` on texts of all kinds
fall out there. After a first fit, lines whose label disagrees with the model are left out and the model is fitted again.

Confidence: n-grams overlap, so the posteriors of plain naive Bayes are far too sure. They are tempered: the temperature is the one at which
fragments of held-out lines, most of them a few words long, are likeliest. A line is in one of the known languages if the best one explains
it well above chance (`LEAST_GAIN` nats per n-gram), or somewhat (`SOME_GAIN`) and clearly better than the next one (`LEAST_MARGIN`); else it is in none: `und`.

A line's language is the most probable one, its confidence the tempered posterior. A document's main language is the one with most
words over its lines, its confidence the mean posterior of that language over those lines, by words; lines of at least `MIN_WORDS` words in another language are its foreign segments.

Bounds of the fit: `ROWS_PER_LANGUAGE` rows of a label, `SAMPLE_CHARS` characters of each; all rows are scored whole.

Defined results: null and blank texts have no language (null) and no segments; lines without letters have none; a label is right
when it names the main language in any spelling of `NAMES`, with or without a region; a tie in words goes to the language that sorts first;
an empty table gives no rows; without any labelled row every language is null.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 16
ORDERS = (2, 3, 4)
ROWS_PER_LANGUAGE = 500  # labelled rows of a language the model is fitted on, at most about so many
SAMPLE_CHARS = 20_000  # of each of them so many characters at most
MAX_LANGUAGES = 60
MIN_DOCS = 3  # texts that make a label a language
LEAST_RECALL = 0.5
LEAST_GAIN, SOME_GAIN, LEAST_MARGIN = 1.2, 0.4, 0.5
TEMPERATURES = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0, 24.0)
MIN_WORDS = 8
MIN_LETTERS = 20  # shorter lines are not held to be in no known language
UNKNOWN = "und"
BLOCK = 2_400_000  # cells scored at once: characters by languages
#: Two- and three-letter codes and English names.
NAMES = {
    "bg": ("bg", "bul", "bulgarian"), "ca": ("ca", "cat", "catalan"), "cs": ("cs", "ces", "cze", "czech"), "da": ("da", "dan", "danish"), "de": ("de", "deu", "ger", "german"), "el": ("el", "ell", "gre", "greek"),
    "en": ("en", "eng", "english"), "es": ("es", "spa", "spanish", "castilian"), "et": ("et", "est", "estonian"), "fi": ("fi", "fin", "finnish"), "fr": ("fr", "fra", "fre", "french"), "hr": ("hr", "hrv", "croatian"),
    "hu": ("hu", "hun", "hungarian"), "it": ("it", "ita", "italian"), "ja": ("ja", "jpn", "japanese"), "ko": ("ko", "kor", "korean"), "lt": ("lt", "lit", "lithuanian"), "lv": ("lv", "lav", "latvian"), "nl": ("nl", "nld", "dut", "dutch"),
    "no": ("no", "nor", "norwegian"), "pl": ("pl", "pol", "polish"), "pt": ("pt", "por", "portuguese"), "ro": ("ro", "ron", "rum", "romanian"), "ru": ("ru", "rus", "russian"), "sk": ("sk", "slk", "slo", "slovak"), "sl": ("sl", "slv", "slovenian"),
    "sv": ("sv", "swe", "swedish"), "tr": ("tr", "tur", "turkish"), "uk": ("uk", "ukr", "ukrainian"), "zh": ("zh", "zho", "chi", "chinese"),
}
CODE = {name: code for code, names in NAMES.items() for name in names}
_MULTIPLIERS = np.array([1, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def named_language(label: str | None) -> str | None:
    """The two-letter code a label names, or null."""
    if not label:
        return None
    first = re.split(r"[-_\s(;,.]", label.strip().lower(), maxsplit=1)[0]
    return CODE.get(first) or (first if re.fullmatch(r"[a-z]{2,3}", first) else None)


def _order(points: np.ndarray, n: int) -> np.ndarray:
    """Column of the n-gram that ends at each character; the first ones are short."""
    h = points * _MULTIPLIERS[0]
    for k in range(1, n):
        h[k:] += points[:-k] * _MULTIPLIERS[k]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D) + np.uint32(n)
    return (h >> np.uint32(32 - BITS)).astype(np.int32)


#: Digits, signs and line ends count as blanks, so that numbers and layout have no language.
FOLD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def lowered(text: str) -> str:
    """Lower case of the same length: a letter whose lower case is longer stays."""
    out = text.lower()
    return out if len(out) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def folded(line: str) -> str:
    return lowered(" " + " ".join(FOLD.findall(line)) + " ")


@dataclass
class Model:
    """Log-probabilities (n-grams, languages) as float32, and the temperature of the posteriors."""

    logs: np.ndarray
    languages: tuple[str, ...]
    temperature: float = 1.0

    def scores(self, lines: list[str]) -> np.ndarray:
        """Summed log-probabilities, (lines, languages)."""
        parts, start, size = [], 0, 0
        for end, line in enumerate(lines, 1):  # a bounded number of characters at a time, a longer line alone
            size += len(line)
            if size * len(self.languages) >= BLOCK or end == len(lines):
                parts.append(self._block(lines[start:end]))
                start, size = end, 0
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))

    def _block(self, lines: list[str]) -> np.ndarray:
        points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum([0, *map(len, lines)])[:-1]
        total = np.zeros((len(points), len(self.languages)), np.float32)
        for n in ORDERS:
            total += self.logs[_order(points, n)]
        return np.add.reduceat(total, starts, axis=0).astype(np.float64)

    def posteriors(self, scores: np.ndarray) -> np.ndarray:
        s = (scores - scores.max(1, keepdims=True)) / self.temperature
        p = np.exp(s)
        return p / p.sum(1, keepdims=True)

    def known(self, lines: list[str], scores: np.ndarray) -> np.ndarray:
        """Whether each line is in one of the languages: well above chance, or somewhat and clearly better than in the next one."""
        grams = np.array([len(ORDERS) * len(x) for x in lines], float)
        top = np.sort(scores, 1)
        gain = top[:, -1] / grams + BITS * math.log(2)
        margin = (top[:, -1] - top[:, -2]) / grams if scores.shape[1] > 1 else np.zeros(len(lines))
        return (gain >= LEAST_GAIN) | (gain >= SOME_GAIN) & (margin >= LEAST_MARGIN) | (grams < len(ORDERS) * MIN_LETTERS)


def _counts(lines: list[str], labels: np.ndarray, languages: int) -> np.ndarray:
    counts = np.zeros((1 << BITS, languages))
    for k in range(languages):
        own = "".join(line for line, label in zip(lines, labels) if label == k)
        if own:
            points = np.frombuffer(own.encode("utf-32-le", "surrogatepass"), np.uint32)
            for n in ORDERS:
                counts[:, k] += np.bincount(_order(points, n), minlength=1 << BITS)
    return counts


def _plain(lines: list[str], labels: np.ndarray, languages: tuple[str, ...]) -> Model:
    """Naive Bayes on the lines of labels from 0 on."""
    counts = _counts(lines, labels, len(languages)) + 0.1
    return Model(np.log(counts / counts.sum(0)).astype(np.float32), languages)


def _fragments(lines: list[str], seed: int = 3) -> list[str]:
    """Of each line a piece of one to eight words, and every fourth line whole."""
    rng, out = np.random.default_rng(seed), []
    for i, line in enumerate(lines):
        words = line.split()
        size = int(rng.integers(1, 9))
        start = int(rng.integers(0, max(1, len(words) - size + 1)))
        out.append(line if i % 4 == 0 or not words else " " + " ".join(words[start : start + size]) + " ")
    return out


def temperature(model: Model, lines: list[str], labels: np.ndarray) -> float:
    """Of `TEMPERATURES` the one under which the labels of held-out fragments are likeliest."""
    if not len(lines) or len(model.languages) < 2:
        return 1.0
    s = model.scores(_fragments(lines))
    s -= s.max(1, keepdims=True)
    own = np.arange(len(lines)), labels
    loss = [float((np.log(np.exp(s / t).sum(1)) - s[own] / t).mean()) for t in TEMPERATURES]
    return TEMPERATURES[int(np.argmin(loss))]


def fit(texts: list[str], labels: list[str], rounds: int = 3) -> Model | None:
    """Fit on labelled texts. Labels that don't find their own held-out texts are dropped; from the second round on, a line whose language disagrees with its text's label is left out."""
    docs = {x: labels.count(x) for x in set(labels)}
    present = tuple(sorted(x for x, n in docs.items() if n >= min(MIN_DOCS, max(docs.values()))))
    lines, owner, half, turn = [], [], [], dict.fromkeys(present, 0)
    for text, label in zip(texts, labels):
        if label not in turn:
            continue
        turn[label] += 1
        for line in text.split("\n"):
            if len(line) > 1:
                lines.append(folded(line))
                owner.append(present.index(label))
                half.append(turn[label] % 2)
    if not lines:
        return None
    owners, first = np.array(owner), np.array(half) == 1
    heat = 1.0
    if (~first).any():
        trial = _plain(lines, np.where(first, owners, -1), present)
        held = np.flatnonzero(~first)
        said = trial.scores([lines[i] for i in held]).argmax(1)
        tried, right = np.bincount(owners[held], minlength=len(present)), np.bincount(owners[held][said == owners[held]], minlength=len(present))
        good = (tried == 0) | (right >= LEAST_RECALL * tried)
        if not good.any():
            return None
        agree = held[(said == owners[held]) & good[owners[held]]]
        kept = np.flatnonzero(good)
        heat = temperature(Model(trial.logs[:, kept], tuple(present[k] for k in kept)), [lines[i] for i in agree], np.searchsorted(kept, owners[agree]))
        owners = np.where(good[owners], np.searchsorted(kept, owners), -1)
        present = tuple(present[k] for k in kept)
    keep, model = owners >= 0, None
    for _ in range(rounds):
        model = _plain(lines, np.where(keep, owners, -1), present)
        keep = (owners >= 0) & (model.scores(lines).argmax(1) == owners)
    return Model(model.logs, model.languages, heat)


def languages_of(content: str, model: Model) -> tuple[str | None, float, list[tuple[int, str, float, int]]]:
    """(main language, confidence, [(line_no, language, confidence, words)]) of one text."""
    return batch_languages([content], model)[0]


def batch_languages(contents: list[str | None], model: Model) -> list[tuple[str | None, float, list[tuple[int, str, float, int]]]]:
    rows, numbers, words, lines = [], [], [], []
    for i, content in enumerate(contents):
        for n, line in enumerate((content or "").split("\n"), 1):
            f = folded(line)
            if len(f) > 2:
                rows.append(i), numbers.append(n), words.append(len(line.split())), lines.append(f)
    out: list = [(None, 0.0, [])] * len(contents)
    if not lines:
        return out
    s = model.scores(lines)
    p = model.posteriors(s)
    names = (*model.languages, UNKNOWN)
    best = np.where(model.known(lines, s), p.argmax(1), len(model.languages))
    p = np.column_stack([p, 1 - p.max(1)])  # how sure it is that a line is in none: what the best language leaves
    words_, rows_ = np.array(words), np.array(rows)
    share = np.zeros((len(contents), len(names)))
    np.add.at(share, (rows_, best), words_)
    cuts = np.flatnonzero(np.diff(rows_)) + 1
    for part in np.split(np.arange(len(rows_)), cuts):
        i = rows_[part[0]]
        main = int(share[i].argmax())
        own = part[best[part] == main]
        total = words_[own].sum()
        sure = float((p[own, main] * words_[own]).sum() / total) if total else 0.0
        out[i] = (names[main] if total else None, sure, [(numbers[j], names[best[j]], float(p[j, best[j]]), words[j]) for j in part])
    return out


def fitted(df: DataFrame, *, id_col: str = "id", text_col: str = "content", label_col: str = "lang") -> Model | None:
    """The model of a table, from a bounded hash-chosen sample of its labelled rows (see the bounds of the fit)."""
    code = F.lower(F.split(F.trim(F.col(label_col)), r"[-_\s(;,.]")[0])
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), code.alias("code")).filter((F.col("code").rlike("^[a-z]{2,3}$") | F.col("code").isin(*CODE)) & F.col("text").isNotNull())
    counts = {r.code: r["count"] for r in rows.groupBy("code").count().collect()}  # a row per code of two or three letters or name of NAMES
    per: dict[str, list[str]] = {}
    for spelling in counts:
        per.setdefault(named_language(spelling), []).append(spelling)
    most = sorted(per, key=lambda x: (-sum(counts[c] for c in per[x]), x))[:MAX_LANGUAGES]
    parts = F.lit(False)
    for language in most:
        share = math.ceil(min(1.0, ROWS_PER_LANGUAGE / sum(counts[c] for c in per[language])) * (1 << 24))
        parts = parts | (F.col("code").isin(*per[language]) & (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 24)) < F.lit(share)))
    sample = rows.filter(parts).select(F.substring("text", 1, SAMPLE_CHARS).alias("text"), "code").collect()
    return fit([r.text for r in sample], [named_language(r.code) for r in sample])


def label_languages(df: DataFrame, *, id_col: str = "id", text_col: str = "content", label_col: str = "lang", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, line_no, lang, confidence, label_right): line_no 0 is the document, further rows are its foreign lines."""
    shared = df.sparkSession.sparkContext.broadcast(fitted(df, id_col=id_col, text_col=text_col, label_col=label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                labels, row, line, lang, sure, right = batch.column(2).to_pylist(), [], [], [], [], []
                found = batch_languages(batch.column(1).to_pylist(), model) if model else [(None, 0.0, [])] * batch.num_rows
                for i, (main, share, lines) in enumerate(found):
                    row.append(i), line.append(0), lang.append(main), sure.append(share), right.append(main is None or named_language(labels[i]) == main)
                    for n, other, confidence, words in lines:
                        if words >= min_words and other != main:  # `und` among them
                            row.append(i), line.append(n), lang.append(other), sure.append(confidence), right.append(False)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(line, pa.int32()), pa.array(lang, pa.string()), pa.array(sure, pa.float64()), pa.array(right, pa.bool_())], names=["id", "line_no", "lang", "confidence", "label_right"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    return rows.mapInArrow(run, f"id {kind}, line_no int, lang string, confidence double, label_right boolean")
