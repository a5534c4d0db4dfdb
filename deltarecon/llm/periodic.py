"""Runs of words that repeat with a period, found by seed and extend on diagonals.

A run of smallest period q and length L matches itself on the diagonal of lag q over
L - q words. With at least ``MIN_WORDS`` words and ``MIN_PERIODS`` periods these are
16 or more words for every q, so a 16-gram at its start occurs again q words on. The
k-grams of a text, k = 16, 32, 64, ..., are indexed (numbered exactly, by doubling),
and each is paired with its next occurrence if that is at most k words on, and more
than k / 2 for k over 16: longer lags overlap longer. One pair an occurrence is
enough: were there a nearer one, the text between would have a smaller period. So
every pair found also shows a smallest period. Pairs are extended both ways along
their diagonal; a table of the furthest place covered by lag leaves out the others
of a stretch.

Time is n log n sorted numbers a text, with a bounded number of arrays of its length;
every text is worked on alone, in the task that reads it.

Cases: null, empty and blank texts have no words and no runs; equal exponents go to
the smallest start, then period; repeated rows and ids are worked on alone; an empty
table gives no rows; other columns don't matter, and clashing names get a number; a
row with a null id is reported, its words as they are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltarecon.llm.common import free_name

MIN_WORDS = 24
MIN_PERIODS = 3

Run = tuple[int, int, int]  # start, length, period


def split_words(text: bytes | None) -> list[bytes]:
    """What lies between spaces and the controls 9 to 13; of bytes, so no other space splits."""
    return (text or b"").split()


def _numbers(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _doubled(rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From numbers of the ``width``-grams (-1: occurs once) those of the grams twice as
    long, and every occurrence with the next of the same gram."""
    out = np.full(len(rank), -1, np.int64)
    at = np.flatnonzero((rank[:-width] >= 0) & (rank[width:] >= 0))
    if not len(at):
        return out, at, at
    key = rank[at] * (rank.max() + 1) + rank[at + width]
    order = np.argsort(key, kind="stable")  # places of one gram stay in order
    at, key = at[order], key[order]
    same = key[1:] == key[:-1]
    again = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    out[at[again]] = np.cumsum(np.concatenate([[True], ~same]))[again]
    return out, at[:-1][same], at[1:][same]


def _first_difference(ids: np.ndarray, at: int, lag: int) -> int:
    step = 64
    while at < len(ids) - lag:
        end = min(at + step, len(ids) - lag)
        differ = ids[at:end] != ids[at + lag:end + lag]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, step * 2
    return at


def _last_difference(ids: np.ndarray, at: int, lag: int) -> int:
    """The least place from which on, up to ``at``, the diagonal matches."""
    step = 64
    while at > 0:
        begin = max(0, at - step)
        differ = ids[begin:at] != ids[begin + lag:at + lag]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = begin, step * 2
    return at


def find_runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[Run]:
    """All maximal runs of at least ``min_words`` numbers and ``min_periods`` (3 or more)
    periods, by start and period."""
    if min_periods < 3:
        raise ValueError("min_periods must be 3 or more: two periods don't overlap enough to be paired")
    n, runs = len(ids), []
    if n < max(min_words, min_periods):
        return runs
    # The least overlap of a run with itself is at the period of which it has just min_periods.
    seed = max(2, 1 << (min_words * (min_periods - 1) // min_periods).bit_length() >> 1)
    rank = np.where(np.bincount(ids)[ids] > 1, ids, -1)
    furthest: dict[int, int] = {}
    width, below = 1, 0
    while True:
        if width >= seed:
            lags = places[1] - places[0]
            near = (lags > below) & (lags <= width)
            first, lags = places[0][near], lags[near]
            order = np.lexsort((first, lags))
            first, lags = first[order], lags[order]
            # Of places side by side on a diagonal the first is enough.
            head = np.ones(len(first), bool)
            head[1:] = (lags[1:] != lags[:-1]) | (first[1:] != first[:-1] + 1)
            for at, lag in zip(first[head].tolist(), lags[head].tolist()):
                if at < furthest.get(lag, 0):
                    continue
                end = furthest[lag] = _first_difference(ids, at + width, lag)
                start = _last_difference(ids, at, lag)
                if end - start + lag >= max(min_words, min_periods * lag):
                    runs.append((start, end - start + lag, lag))
            below = width
        if (below + 1) * min_periods > n or 2 * width > n:
            break
        rank, *places = _doubled(rank, width)
        width *= 2
        if not len(places[0]):
            break
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly; then the first."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def with_periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period) and ``collapsed_text`` (the
    words that stay, by one space; null for a null text). A taken name gets a number."""
    runs_name, text_name = free_name(docs, "runs"), free_name(docs, "collapsed_text")
    key = free_name(docs, "row_nr")
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, texts = [], []
            for text in b.column(0).cast(pa.binary()):
                words = split_words(text.as_py())
                runs = find_runs(_numbers(words), min_words, min_periods)
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                texts.append(None if not text.is_valid else b" ".join(collapse(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array(found, spans), pa.array(texts, pa.string())], ["row", runs_name, text_name])

    # Python sees the text and a copy of the row, so that columns of any type pass through.
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(key)
    out = docs.select("text", row).mapInArrow(
        run, f"row {row_type(docs)}, {runs_name} array<struct<start:long,length:long,period:long>>, {text_name} string")
    return out.select(*(F.col("row").getField(c).alias(c) for c in docs.columns), runs_name, text_name)


def row_type(docs: DataFrame) -> str:
    return "struct<" + ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in docs.schema.fields) + ">"


def made_periodic(words: list[bytes], doc_id: object) -> list[bytes]:
    """A tenth of the documents, by the checksum of their id, repeat one stretch from some word on."""
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    stretch = words[start:start + period]
    return words[:start] + (stretch * ((n - start) // period + 1))[:n - start]


def run_report(docs: DataFrame) -> DataFrame:
    """The digest columns per document, of the words as ``made_periodic`` returns them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                words = made_periodic(split_words(text.as_py()), doc_id)
                runs = find_runs(_numbers(words))
                best = strongest(runs)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
                rows.append((len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                             hashlib.sha256(listed).hexdigest(),
                             hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest()))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_runs long, start long, length long, period long, "
             "exponent_milli long, runs_sha256 string, collapsed_sha256 string")
