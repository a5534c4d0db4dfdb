"""Toxicity of texts after noisy-channel deobfuscation.

A word that was disguised is restored before it is judged. Its characters span a
lattice: each may stand for itself, for the letters it imitates (leetspeak), be a
separator put between letters, or repeat the letter before; each choice has a
channel cost, and a character language model of the corpus scores the letters
read. Viterbi decoding finds the best reading. A run of three or more single
characters is one lattice in which words may also end, so that "y o u f o o l" is
read as two words. A word skips the lattice only if it
is all letters, none of them doubled, between marks that imitate no letter.

A word can have several readings, of which the judge takes the one that gains most:
the word as it is, if it is all letters and none is tripled; the best one; and the
best one that repeats no letter and leaves out only punctuation, so that "a$$" isn't
only "a" or "as". A word without a letter is read if two different marks in it
imitate some and it isn't a number.

The judge is learned from restored words: of the distinct labelled training
texts, for every word and its first ``STEM`` letters, how many of the toxic and of
all texts hold it. A feature's precision is shrunk towards the base rate, and a
text's log-odds are the base rate's plus, for each distinct word of the readings
taken, the gain of its best feature.

Bounds: the character model has 28 classes, so 28 ** 3 counts whatever the corpus,
and counts all of it. The judge learns from at most ``TRAIN_ROWS`` labelled rows,
those with the least hash of their id, and keeps the words of these rows that
``MIN_TOXIC`` toxic ones hold and that gain ``MIN_GAIN``: no more than a quarter of the
words in the toxic ones. Both are sent to all executors. Paths of the lattice are kept as linked letters,
so that a word of any length is decoded exactly, in time linear in it.

Cases: null, empty and wordless texts get the base rate; without training rows
every text gets 0.5, without toxic ones among them a rate near 0; labels without an
id or a toxic flag are skipped, and of several for one id the toxic one holds;
repeated rows and ids are scored on their own; an empty table gives no rows;
other columns don't matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltarecon.session import materialize

TRAIN_ROWS = 20_000
MIN_TOXIC = 4  # toxic training texts that a feature needs
MIN_GAIN = 2.0
PRIOR_WEIGHT = 6.0
STEM = 6
THRESHOLD = 0.7
CACHE = 400_000  # words a worker keeps
MAX_WORDS = 500_000  # distinct words that a task counts before it spells them out

# What characters imitate, and the channel's costs in nats.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
        "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "§": "s"}
COST_LEET, COST_REPEAT = 0.7, 1.6
COST_END = 0.5  # of a word's end in a spaced run, besides the model's
COST_DROP = 1.0  # of a character that imitates no letter
COST_DROP_EDGE, COST_DROP_INSIDE = 3.0, 9.0  # of one that does, beside and between letters
PUNCTUATION = "!|+(¡"  # what else those of LEET stand beside words for
EDGE, OTHER = "^", "~"
_PLAIN = re.compile(r"[^\W\d_]+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_DOUBLE = re.compile(r"(.)\1")
_TRIPLE = re.compile(r"(.)\1\1+")
_MARK = re.compile("[" + re.escape("".join(LEET)) + "]")
_IDLE = re.compile(rf"^(?:(?!{_MARK.pattern})[\W_])+|(?:(?!{_MARK.pattern})[\W_])+$")
_RUN = re.compile(r"(?<!\S)\S(?:\s++\S(?!\S)){2,}+")
_NUMBER = re.compile(r"[(+\-]*[$€£§]?[\d.,:;/%+\-]+[$€£]?[).,:;!?]*")


def _classes(word: str) -> str:
    """The character model's alphabet: a to z, any other letter, the edge."""
    return "".join(c if "a" <= c <= "z" else OTHER for c in word)


_ALPHABET = EDGE + "abcdefghijklmnopqrstuvwxyz" + OTHER


def _add_trigrams(words: Counter, total: np.ndarray) -> None:
    """Adds the trigrams of all plain words, as often as each was counted."""
    plain = ((w if w.isalpha() else _EDGES.sub("", w), n) for w, n in words.items())
    plain = [(w, n) for w, n in plain if w.isalpha() or _PLAIN.fullmatch(w)]
    if not plain:
        return
    codes = np.frombuffer((EDGE + (EDGE * 3).join(w for w, _ in plain) + EDGE).encode("utf-32-le"), "<u4").astype(np.int64)
    codes = np.where(codes == ord(EDGE), 0, np.where((codes >= 97) & (codes <= 122), codes - 96, 27))
    codes = np.concatenate([[0], codes])
    # Each word is spelt ^^word^, and so has one trigram more than letters.
    lengths = np.array([len(w) for w, _ in plain])
    starts = np.cumsum(lengths + 3) - (lengths + 3)
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]), lengths + 1) + np.arange((lengths + 1).sum())
    grams = (codes[at] * 28 + codes[at + 1]) * 28 + codes[at + 2]
    total += np.bincount(grams, np.repeat(np.array([n for _, n in plain], np.float64), lengths + 1), 28 ** 3).astype(np.int64)


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, words = np.zeros(28 ** 3, np.int64), Counter()
    for b in batches:
        for t in b.column(0):
            words.update((t.as_py() or "").lower().split())
            if len(words) > MAX_WORDS:
                _add_trigrams(words, total)
                words.clear()
    _add_trigrams(words, total)
    found = np.flatnonzero(total)
    grams = [_ALPHABET[g // 784] + _ALPHABET[g // 28 % 28] + _ALPHABET[g % 28] for g in found.tolist()]
    yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(total[found])], ["gram", "n"])


def character_model(docs: DataFrame) -> dict[str, float]:
    """Log probabilities of trigrams over the words of all of ``docs``."""
    counts = docs.select("text").mapInArrow(_count_trigrams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = {r["gram"]: r["n"] for r in counts.collect()}
    context: Counter = Counter()
    for g, n in grams.items():
        context[g[:2]] += n
    model = {g: math.log((n + 0.1) / (context[g[:2]] + 2.8)) for g, n in grams.items()}
    model |= {c: math.log(0.1 / (n + 2.8)) for c, n in context.items()}
    return model


# What a path has read: all but the last letter, the last one, and how many.
_Read = tuple | None


def _comes_before(a: _Read, b: _Read) -> bool:
    """Whether reading ``a`` sorts before ``b``; walks back to where they part."""
    if a is b or not a or not b:
        return a is None and b is not None
    tails: tuple[list[str], list[str]] = [], []
    while a is not b:
        da, db = (a[2] if a else 0), (b[2] if b else 0)
        if da >= db:
            tails[0].append(a[1])
            a = a[0]
        if db >= da:
            tails[1].append(b[1])
            b = b[0]
    return tails[0][::-1] < tails[1][::-1]


class Restorer:
    """Restores words under a character model."""

    def __init__(self, model: dict[str, float]) -> None:
        self.model = model
        self.unseen = math.log(1 / 28)

    def _step(self, two: str, c: str) -> float:
        p = self.model.get(two + c)
        return p if p is not None else self.model.get(two, self.unseen)

    def decode(self, chars: str, literal: bool = False, ends: bool = False) -> str:
        """The best reading of one lattice, letters only. A literal one repeats no letter
        and drops no imitation but ``PUNCTUATION``. With ``ends`` words may end anywhere
        and are read with spaces between them. Of equal costs the smallest reading."""
        # By the last two classes and the last letter: cost and reading.
        paths: dict[tuple[str, str], tuple[float, _Read]] = {(EDGE * 2, ""): (0.0, None)}
        letters = [i for i, c in enumerate(chars) if c.isalpha()] or [0]
        for i, c in enumerate(chars):
            inside = letters[0] < i < letters[-1]
            drop = COST_DROP if c not in LEET else COST_DROP_INSIDE if inside else COST_DROP_EDGE
            can_drop = not c.isalpha() and not (literal and c in LEET and c not in PUNCTUATION)
            readings = [(c, 0.0)] if c.isalpha() else [(x, COST_LEET) for x in LEET.get(c, "")]
            readings = [(x, x if "a" <= x <= "z" else OTHER, extra) for x, extra in readings]
            nxt: dict[tuple[str, str], tuple[float, _Read]] = {}

            def offer(key: tuple[str, str], cost: float, read: _Read) -> None:
                old = nxt.get(key)
                if old is None or cost < old[0] or cost == old[0] and _comes_before(read, old[1]):
                    nxt[key] = cost, read

            for (two, last), (cost, read) in paths.items():
                for letter, k, extra in readings:
                    longer = read, letter, (read[2] if read else 0) + 1
                    offer((two[1] + k, letter), cost + extra - self._step(two, k), longer)
                    if letter == last and not literal:
                        offer((two, last), cost + extra + COST_REPEAT, read)
                if can_drop:
                    offer((two, last), cost + drop, read)
            if ends:
                # A path at a word's end has read a space last, and its next letter begins a word.
                for (two, _), (cost, read) in list(nxt.items()):
                    if two != EDGE * 2:
                        offer((EDGE * 2, ""), cost + COST_END - self._step(two, EDGE), (read, " ", read[2] + 1))
            paths = nxt
        if ends:
            paths = {key: path for key, path in paths.items() if key[0] != EDGE * 2} or paths
        best: tuple[float, _Read] | None = None
        for (two, _), (cost, read) in paths.items():
            cost -= self._step(two, EDGE)
            if best is None or cost < best[0] or cost == best[0] and _comes_before(read, best[1]):
                best = cost, read
        out, read = [], best[1] if best else None
        while read:
            out.append(read[1])
            read = read[0]
        return "".join(reversed(out))

    def _unrepeated(self, word: str) -> str:
        """``decode`` for letters only, none tripled: each doubled one is decided on its own."""
        s, out, done = EDGE + _classes(word) + EDGE, "", 0
        for m in _DOUBLE.finditer(word):
            i = m.start()
            two, x, after = s[i:i + 2], s[i + 1], s[i + 3]
            if self._step(two, after) - self._step(two, x) - self._step(x + x, after) > COST_REPEAT:
                out, done = out + word[done:i], i + 1
        return out + word[done:]

    def readings(self, word: str) -> tuple[str, ...]:
        """The readings of a word; none if nothing in it is a letter or imitates one."""
        if word.isalpha() and not _DOUBLE.search(word):
            return (word,)
        inner = _EDGES.sub("", word)
        plain = inner if _PLAIN.fullmatch(inner) and not _TRIPLE.search(inner) else ""
        marks = set(_MARK.findall(word))
        if plain and not marks and not _DOUBLE.search(plain):
            return (plain,)
        n = sum(c.isalpha() or c in LEET for c in word)
        if n < 2 or not any(map(str.isalpha, word)) and (len(marks) < 2 or _NUMBER.fullmatch(word)):
            return (plain,) if plain else ()
        if plain and not marks:
            return tuple(dict.fromkeys((plain, self._unrepeated(plain))))
        best = once = self.decode(word)
        if len(best) < n:
            once = self.decode(_TRIPLE.sub(r"\1\1", word), literal=True)
        return tuple(w for w in dict.fromkeys((plain, best, once)) if w)


class _Restored(dict):
    def __init__(self, model: dict[str, float]) -> None:
        super().__init__()
        self.restorer = Restorer(model)

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) > CACHE:
            self.clear()
        out = self[word] = self.read(word)
        return out

    def read(self, word: str) -> tuple[str, ...]:
        # Marks at the edges that imitate no letter cost every path the same.
        return self.restorer.readings(word if word.isalpha() else _IDLE.sub("", word))

    def spaced(self, run: str) -> tuple[str, ...]:
        """The readings of a run of single characters: as words with spaces between, and as one word."""
        if len({c for c in run if c.isalpha() or c in LEET}) < 2 or not any(c.isalpha() or c in LEET and not c.isdigit() for c in run):
            return ()
        decode = self.restorer.decode
        return tuple(dict.fromkeys((decode(run, ends=True), decode(run, literal=True, ends=True), *self[run])))


def restored_readings(text: str | None, restored: _Restored) -> set[tuple[str, ...]]:
    """For each distinct word and spaced run its readings."""
    text = (text or "").lower()
    found = {r for r in map(restored.__getitem__, set(text.split())) if r}
    return found | {r for r in map(restored.spaced, {"".join(m[0].split()) for m in _RUN.finditer(text)}) if r}


def restored_words(text: str | None, restored: _Restored) -> set[str]:
    return {w for r in restored_readings(text, restored) for x in r for w in x.split()}


def _features(words: set[str]) -> set[str]:
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


def _gain(word: str, gains: dict[str, float]) -> float:
    return max(gains.get(word, 0.0), gains.get(word[:STEM] + "*", 0.0) if len(word) > STEM else 0.0)


def total_gain(readings: set[tuple[str, ...]], gains: dict[str, float]) -> float:
    """Of the distinct words, each in its reading of most gain."""
    def gain(reading: str) -> float:
        return sum(sorted(_gain(w, gains) for w in set(reading.split())))

    taken = {r[0] if len(r) == 1 else max(r, key=lambda x: (gain(x), x)) for r in readings}
    return sum(sorted(_gain(w, gains) for w in {w for x in taken for w in x.split()}))


def training_rows(labels: DataFrame, learn: Column, limit: int = TRAIN_ROWS) -> DataFrame:
    """``(label_id, toxic)`` of at most ``limit`` labelled rows that may be learned from."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
    rows = rows.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    return rows.orderBy(F.xxhash64("label_id"), "label_id").limit(limit)


def learn(docs: DataFrame, rows: DataFrame, model: dict[str, float]) -> tuple[float, dict[str, float]]:
    """The base log-odds and the gain of each kept feature."""
    # At most TRAIN_ROWS rows of two numbers: small enough to send whole.
    marked = docs.join(F.broadcast(rows), F.col("doc_id") == F.col("label_id")).select("text", "toxic")
    texts = marked.filter("text is not null").groupBy(F.sha2("text", 256).alias("h")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restored, n, toxic = _Restored(model), Counter(), Counter()
        for b in batches:
            for text, flag in zip(b.column(0), b.column(1).to_pylist()):
                # The empty feature counts the texts.
                found = _features(restored_words(text.as_py(), restored)) | {""}
                n.update(found)
                if flag:
                    toxic.update(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()),
             pa.array([toxic[f] for f in n], pa.int64())], ["feature", "n", "toxic"])

    counts = texts.select("text", "toxic").mapInArrow(count, "feature string, n long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    counts = materialize(counts.filter((F.col("feature") == "") | (F.col("toxic") >= MIN_TOXIC)), "features")
    texts_seen = counts.filter("feature = ''").first()
    if texts_seen is None:
        return 0.0, {}
    base = (texts_seen["toxic"] + 0.5) / (texts_seen["n"] + 1)
    logit = lambda p: math.log(p / (1 - p))
    # What gains enough has at least this precision; a little less, for rounding.
    least = 1 / (1 + math.exp(-logit(base) - MIN_GAIN)) * (1 - 1e-9)
    precision = (F.col("toxic") + F.lit(PRIOR_WEIGHT * base)) / (F.col("n") + F.lit(PRIOR_WEIGHT))
    found = counts.filter((F.col("feature") != "") & (precision >= least)).collect()
    gains = {r["feature"]: logit((r["toxic"] + PRIOR_WEIGHT * base) / (r["n"] + PRIOR_WEIGHT)) - logit(base) for r in found}
    return logit(base), {f: g for f, g in gains.items() if g >= MIN_GAIN}


class _Scorer:
    """Scores texts, and remembers which words gain."""

    def __init__(self, model: dict[str, float], gains: dict[str, float]) -> None:
        self.restored, self.gains = _Restored(model), gains
        self.seen: set[str] = set()
        self.gaining: dict[str, tuple[str, ...]] = {}

    def _gaining_words(self, readings: tuple[str, ...]) -> tuple[str, ...]:
        """The words that gain in the reading taken."""
        if not readings:
            return ()
        def gain(reading: str) -> float:
            return sum(sorted(_gain(w, self.gains) for w in set(reading.split())))
        taken = readings[0] if len(readings) == 1 else max(readings, key=lambda x: (gain(x), x))
        return tuple(w for w in dict.fromkeys(taken.split()) if _gain(w, self.gains))

    def total(self, text: str | None) -> float:
        """``total_gain`` of the text's readings."""
        text = (text or "").lower()
        words = set(text.split())
        if len(self.seen) > CACHE:
            self.seen.clear()
            self.gaining.clear()
        for w in words - self.seen:
            if found := self._gaining_words(self.restored.read(w)):
                self.gaining[w] = found
        self.seen |= words
        taken = {x for w in words & self.gaining.keys() for x in self.gaining[w]}
        for run in {"".join(m[0].split()) for m in _RUN.finditer(text)}:
            taken.update(self._gaining_words(self.restored.spaced(run)))
        return sum(sorted(_gain(w, self.gains) for w in taken))


# The scorer of the last model that this worker met, with the model.
_KEPT: list[tuple[object, _Scorer]] = []


def _scorer(learned: tuple[dict[str, float], dict[str, float]]) -> _Scorer:
    if not _KEPT or _KEPT[0][0] is not learned:
        _KEPT[:] = [(learned, _Scorer(*learned))]
    return _KEPT[0][1]


def score(docs: DataFrame, model: dict[str, float], base: float, gains: dict[str, float]) -> DataFrame:
    """``doc_id``, ``held_out`` (where present) and ``score`` per row."""
    passed = [c for c in ("doc_id", "held_out") if c in docs.columns]
    shared = docs.sparkSession.sparkContext.broadcast((model, gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value)
        for b in batches:
            scores = []
            for text in b.column(b.num_columns - 1):
                odds = base + scorer.total(text.as_py())
                scores.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.array(scores, np.float64))],
                                             [*b.schema.names[:-1], "score"])

    ddl = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in passed)
    return docs.select(*passed, "text").mapInArrow(run, f"{ddl}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """Learns from labels of rows where ``held_out`` (of ``doc_id``) is false, scores all."""
    model = character_model(docs)
    base, gains = learn(docs.select("doc_id", "text"), training_rows(labels.select("doc_id", "toxic"), ~held_out), model)
    scored = score(docs.select("doc_id", "text").withColumn("held_out", held_out), model, base, gains)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
