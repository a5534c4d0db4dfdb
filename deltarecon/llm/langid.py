"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIMS`` signs, drawn from a seed and its
code point. An n-gram's vector binds its letters: their vectors, permuted by
their place (rotated), are multiplied. A text is the bundle (sum) of the
vectors of its n-grams, a language prototype the bundle of all its training texts,
and a text gets the language whose prototype has the largest cosine with it.

Training sums per task, then per language and dimension, so a language with most
of the rows is a few rows of partial sums. What reaches the driver is one vector
a language.

Cases: null, empty and letterless texts are ``und`` with score 0, as is every
text if nothing was learned; equal cosines go to the smallest language; rows with
a null language are predicted but not learned from; repeated rows and ids stand
for themselves; an empty table gives no rows; other columns don't matter; long
texts are read in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS = 1024
N = 3
SEED = 20
UNKNOWN = "und"
PIECE = 1 << 20
MAX_GRAMS = 20_000  # vectors kept by a worker before it starts anew
_GAP = ord("_")  # between words


class Encoder:
    """Counts n-grams and bundles them; n-gram vectors are made when first met."""

    def __init__(self) -> None:
        self.letters: dict[int, np.ndarray] = {}
        self.kind = np.full(0x110000, 2, np.uint8)  # 1 a letter, 0 none, 2 not looked up yet
        self.known = np.zeros(0, np.int64)  # ascending, with the row of each in vectors
        self.row = np.zeros(0, np.int64)
        self.vectors = np.zeros((256, DIMS), np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([SEED, code]).choice(np.array([-1, 1], np.float32), DIMS)
        return self.letters[code]

    def gram(self, key: int) -> np.ndarray:
        out = np.ones(DIMS, np.float32)
        for place in range(N):
            out *= np.roll(self.letter(key >> 21 * (N - 1 - place) & 0x1FFFFF), N - 1 - place)
        return out

    def _vectors_of(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of ``keys`` (distinct, ascending)."""
        new = np.setdiff1d(keys, self.known, assume_unique=True)
        if len(new):
            if len(self.known) + len(new) > MAX_GRAMS:
                new = keys
                self.known, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)
            at, end = len(self.known), len(self.known) + len(new)
            if end > len(self.vectors):
                self.vectors = np.concatenate([self.vectors[:at], np.zeros((max(end, 2 * at) - at, DIMS), np.float32)])
            for i, key in enumerate(new.tolist(), at):
                self.vectors[i] = self.gram(key)
            place = np.searchsorted(self.known, new)
            self.known = np.insert(self.known, place, new)
            self.row = np.insert(self.row, place, np.arange(at, end))
        return self.vectors[self.row[np.searchsorted(self.known, keys)]]

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams of a text and their counts; none without a letter. Read in
        pieces, whose cuts change nothing: the last letters go on to the next one."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        text = (text or "").lower()
        tail, last, letters = np.array([_GAP], np.int64), 0, False

        def add(codes: np.ndarray) -> None:
            key = sum(codes[i:len(codes) - N + 1 + i] << 21 * (N - 1 - i) for i in range(N))
            distinct, n = np.unique(key, return_counts=True)
            keys.append(distinct)
            counts.append(n)

        for at in range(0, len(text), PIECE):
            codes = np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
            kind = self.kind[codes]
            if (kind == 2).any():
                for c in np.unique(codes[kind == 2]).tolist():
                    self.kind[c] = chr(c).isalpha()
                kind = self.kind[codes]
            letters = letters or bool(kind.any())
            codes = np.where(kind == 1, codes, _GAP)
            before = np.concatenate([[last], codes[:-1]])
            last = int(codes[-1])
            joined = np.concatenate([tail, codes[(codes != _GAP) | (before != _GAP)]])
            if at + PIECE >= len(text):
                joined = np.concatenate([joined, [_GAP] * max(1, N - len(joined))])
            if len(joined) >= N:
                add(joined)
            tail = joined[-(N - 1):]
        return _added(keys, counts) if letters else (keys[0], counts[0])

    def bundles(self, grams: list[tuple[np.ndarray, np.ndarray]], kind: type = np.float32) -> np.ndarray:
        """For each text's n-grams the sum of their vectors."""
        out = np.zeros((len(grams), DIMS), np.float64)
        for first in range(0, len(grams), _TEXTS):
            some = grams[first:first + _TEXTS]
            sizes = [len(k) for k, _ in some]
            text = np.repeat(np.arange(len(some)), sizes)
            distinct, which = np.unique(np.concatenate([k for k, _ in some]), return_inverse=True)
            n = np.concatenate([c for _, c in some]).astype(kind)
            for at in range(0, len(distinct), 4096):
                inside = (which >= at) & (which < at + 4096)
                counts = np.zeros((len(some), min(4096, len(distinct) - at)), kind)
                counts[text[inside], which[inside] - at] = n[inside]
                out[first:first + _TEXTS] += counts @ self._vectors_of(distinct[at:at + 4096]).astype(kind, copy=False)
        return out

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The sum of one text's n-gram vectors; None without a letter."""
        grams = self.grams(text)
        return self.bundles([grams])[0] if len(grams[0]) else None


_TEXTS = 64  # bundled in one product


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up."""
    if len(keys) <= 2:
        return keys[-1], counts[-1]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(which, np.concatenate(counts), len(distinct)).astype(np.int64)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ``(lang, text)``: one vector per language of this task. A language's counts
    are added up first and bundled once."""
    encoder = Encoder()
    seen: dict[str, tuple[list, list]] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            grams = encoder.grams(text.as_py())
            keys, counts = seen.setdefault(lang, ([], []))
            keys.append(grams[0])
            counts.append(grams[1])
            if len(keys) > 500:
                whole = _added(keys, counts)
                seen[lang] = [whole[0]], [whole[1]]
    for lang, (keys, counts) in seen.items():
        grams = _added([np.zeros(0, np.int64), *keys], [np.zeros(0, np.int64), *counts])
        if len(grams[0]):
            vector = encoder.bundles([grams], np.float64)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([vector.astype(np.int64).tolist()])], ["lang", "sums"])


def prototypes(training: DataFrame) -> dict[str, np.ndarray]:
    """The unit vector of each language of ``(lang, text)``, languages not null."""
    parts = training.select("lang", "text").filter("lang is not null").mapInArrow(_learn, "lang string, sums array<long>")
    sums = parts.select("lang", F.posexplode("sums").alias("dim", "value")).groupBy("lang", "dim").agg(
        F.sum("value").alias("value"))
    whole = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("v"))
    out = {}
    for r in whole.select("lang", F.col("v.value").alias("v")).collect():
        vector = np.array(r["v"], np.float64)
        if norm := np.linalg.norm(vector):
            out[r["lang"]] = vector / norm
    return out


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the cosine, 0 to 1) per row of ``docs``,
    after learning from ``training``. ``held_out``, where present, is passed on."""
    learned = sorted(prototypes(training).items())
    names = [k for k, _ in learned]
    matrix = np.stack([v for _, v in learned]) if learned else np.zeros((0, DIMS))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for b in batches:
            langs, scores = [], []
            for at in range(0, b.num_rows, _TEXTS):
                texts = b.column(b.num_columns - 1).slice(at, _TEXTS)
                grams = [encoder.grams(t.as_py()) for t in texts]
                vectors = encoder.bundles(grams)
                norms = np.linalg.norm(vectors, axis=1)
                cosines = (vectors @ matrix.T) / np.where(norms > 0, norms, 1.0)[:, None]
                for (keys, _), row in zip(grams, cosines):
                    if len(keys) and names:
                        best = int(np.argmax(row))
                        langs.append(names[best])
                        scores.append(float(min(1.0, max(0.0, row[best]))))
                    else:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*b.schema.names[:-1], "lang_pred", "score"])

    passed = [c for c in ("doc_id", "held_out") if c in docs.columns]
    ddl = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in passed)
    return docs.select(*passed, "text").mapInArrow(predict, f"{ddl}, lang_pred string, score double")


def language_report(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learns where ``held_out`` is false, predicts all rows."""
    marked = docs.withColumn("held_out", held_out)
    return identify(marked.select("doc_id", "held_out", "text"), marked.filter(~F.col("held_out")))
