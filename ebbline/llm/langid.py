"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point alone.  An n-gram binds
its letters: their vectors, each rotated by its place, multiplied element by element.  A document
bundles (adds) the vectors of its n-grams, and so does a language over its training documents,
each with the same total weight.  A document gets the language whose prototype has the largest
cosine with its own bundle.

Bundling is linear: a task adds up n-gram weights by language and bundles them once, and the
partial prototypes are summed in a shuffle of (tasks x languages x dimensions) numbers.

Nulls and edges: texts without a letter (or null) are ``und`` with score 0, and so is everything
if nothing could be learned.  Rows with a null text, lang or doc_id teach nothing.  Score is the
cosine, negative ones as 0; ties go to the first language in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import held_out

DIMENSIONS = 1024
GRAM = 3
#: n-gram vectors remembered by a task; beyond it they are made anew.
REMEMBERED = 1 << 15
NONE = "und"


@lru_cache(1)
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)])


@lru_cache(1 << 14)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([code, dimensions])).integers(0, 2, dimensions, dtype=np.int8)
    return bits * 2 - 1


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of lower-cased letters and single blanks between words, and their shares; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    codes = np.where(letters()[codes], codes, 0)
    if not codes.any():
        return np.empty(0, dtype=np.int64), np.empty(0)
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))]
    keys = (codes[:-2] << 42) + (codes[1:-1] << 21) + codes[2:]
    found, counts = np.unique(keys, return_counts=True)
    return found, counts / counts.sum()


class Memory:
    """Vectors of n-grams seen by a task."""

    def __init__(self, dimensions: int) -> None:
        self.dimensions = dimensions
        self.forget()

    def forget(self) -> None:
        self.at: dict[int, int] = {}
        self.vectors = np.empty((1024, self.dimensions), dtype=np.float32)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of the n-grams, one to a row."""
        if len(self.at) > REMEMBERED:
            self.forget()
        at, names = self.at, keys.tolist()
        for key in [k for k in names if k not in at]:
            if len(at) == len(self.vectors):
                self.vectors = np.concatenate((self.vectors, np.empty_like(self.vectors)))
            bound = np.ones(self.dimensions, dtype=np.int8)
            for place in range(GRAM):
                bound *= np.roll(letter_vector(key >> 21 * (GRAM - 1 - place) & 0x1FFFFF, self.dimensions), place)
            self.vectors[len(at)] = bound
            at[key] = len(at)
        return self.vectors[[at[k] for k in names]]

    def bundle(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.dimensions)
        for i in range(0, len(keys), 4096):
            out += weights[i : i + 4096].astype(np.float32) @ self.rows(keys[i : i + 4096])
        return out


def train(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """(text, lang) -> a prototype of unit length for each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[int, float]] = {}
        totals: dict[str, np.ndarray] = {}
        memory = Memory(dimensions)

        def settle(lang: str) -> None:
            own = sums.pop(lang)
            part = memory.bundle(np.fromiter(own, dtype=np.int64, count=len(own)), np.fromiter(own.values(), dtype=float, count=len(own)))
            totals[lang] = totals.get(lang, 0) + part

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                own = sums.setdefault(lang, {})
                for key, weight in zip(*(x.tolist() for x in grams(text))):
                    own[key] = own.get(key, 0.0) + weight
                if len(own) > REMEMBERED:
                    settle(lang)
        for lang in list(sums):
            settle(lang)
        for lang, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions), pa.array(range(dimensions)), pa.array(total)], ["lang", "i", "x"])

    parts = labelled.select("text", "lang").mapInArrow(run, "lang string, i long, x double")
    # Languages x dimensions numbers come to the driver: the model.
    model = parts.groupBy("lang", "i").agg(F.sum("x").alias("x")).toPandas()
    wide = model.pivot(index="lang", columns="i", values="x").sort_index()
    return {lang: row / np.linalg.norm(row) for lang, row in zip(wide.index, wide.to_numpy()) if np.linalg.norm(row) > 0}


def predict(docs: DataFrame, model: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """``doc`` (all columns of ``docs`` but the text) with lang_pred and score."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"), "text")
    names = list(model)
    shared = docs.sparkSession.sparkContext.broadcast(np.array([model[n] for n in names] or np.zeros((0, dimensions))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prototypes, memory = shared.value, Memory(dimensions)
        for batch in batches:
            found: list[tuple[str, float]] = []
            for text in batch.column("text"):
                keys, shares = grams(text.as_py())
                bundle = memory.bundle(keys, shares) if len(keys) and names else None
                length = 0.0 if bundle is None else float(np.linalg.norm(bundle))
                if not length:
                    found.append((NONE, 0.0))
                    continue
                cosines = prototypes @ bundle / length
                best = int(cosines.argmax())
                found.append((names[best], min(1.0, max(0.0, float(cosines[best])))))
            langs, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc", "lang_pred", "score"])

    return packed.mapInArrow(run, packed.drop("text").schema.add("lang_pred", "string").add("score", "double"))


def identify(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows whose crc32 is not held out."""
    out = held_out(parts, held)
    model = train(docs.where(~out & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    return predict(docs.select("doc_id", "text"), model).select("doc.doc_id", "lang_pred", "score").withColumn("held_out", out)
