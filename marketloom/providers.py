"""Steps that a model or a service does elsewhere, behind small interfaces, with stand-ins that need no network and always agree."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Embedder(Protocol):
    size: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


class HashEmbedder:
    """Counts of hashed words at length 1."""

    def __init__(self, size: int = 64) -> None:
        self.size = size

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size), np.float32)
        for i, text in enumerate(texts):
            for word in re.findall(r"\w+", text.lower()):
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                out[i, h % self.size] += 1 if h >> 63 else -1
        length = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, length, out=out, where=length > 0)


class Classifier(Protocol):
    def classify(self, texts: list[str]) -> list[str]: ...


class KeywordClassifier:
    """The first label whose keyword occurs, else the last label."""

    def __init__(self, rules: list[tuple[str, str]], other: str = "other") -> None:
        self.rules, self.other = [(label, re.compile(pattern, re.I)) for label, pattern in rules], other

    def classify(self, texts: list[str]) -> list[str]:
        return [next((label for label, p in self.rules if p.search(t)), self.other) for t in texts]


def collapsed_labels(label: Column, groups: dict[str, tuple[str, ...]], other: str = "other") -> Column:
    """A fine label as the group that lists it, whatever its case and outer blanks; `other` for a label of no group, null for none."""
    bare = F.lower(F.trim(label))
    out = F.when(bare.isNull() | (bare == ""), F.lit(None).cast("string"))
    for group, labels in groups.items():
        out = out.when(bare.isin(*[x.lower() for x in labels]), group)
    return out.otherwise(other)


def embedded(df: DataFrame, embedder: Embedder, *, id_col: str, text_col: str, batch: int = 256) -> DataFrame:
    """(id, embedding) of the rows with a text; blank texts have none. Filter before: the provider is asked for every row given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                part = whole.slice(start, batch)
                texts = part.column(1).to_pylist()
                rows = [i for i, t in enumerate(texts) if t and t.strip()]
                vectors = embedder.embed([texts[i] for i in rows]) if rows else np.zeros((0, embedder.size), np.float32)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), pa.array(list(vectors), pa.list_(pa.float32()))], names=[id_col, "embedding"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, embedding array<float>")


def classified(df: DataFrame, classifier: Classifier, *, id_col: str, text_col: str) -> DataFrame:
    """(id, label) of the rows with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = part.column(1).to_pylist()
            rows = [i for i, t in enumerate(texts) if t and t.strip()]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), pa.array(classifier.classify([texts[i] for i in rows]), pa.string())], names=[id_col, "label"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, label string")
