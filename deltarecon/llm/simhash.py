"""SimHash near-duplicates with pigeonring candidate filtering.

A text's fingerprint sums the bits of the XXH64 hashes of its word shingles.
Fingerprints at ``MAX_BITS`` differing bits or fewer are linked, and documents
whose fingerprints are joined by links form a component.

Candidates: the 64 bits are a ring of ``SEGMENTS`` segments. If two
fingerprints differ in at most t bits, the pigeonring principle gives a start
from which every chain of l consecutive segments has at most l * t / SEGMENTS
differing bits. For t = 2 and five segments the first two segments of that
chain are equal, which makes them a join key (26 bits); the remaining bits
are a ring of their own, whose chain extends the key to 41 bits. Within
equal keys, chains of three and four segments are held against their budgets
before the full distance is computed.

Skew: work is on distinct fingerprints, so any number of equal texts is one
row. Rows of one key differ in 23 bits at most, which bounds a run; runs
over ``DENSE_RUN`` are cut once more by a third ring, and of every run only a
spanning forest of its links leaves the task, never its pairs.

Cases: null, empty and blank texts have fingerprint zero, linked like any
other; fewer words than a shingle give one shingle of all words; repeated rows
and ids stay rows of their own in one component; a null id never becomes a
component's id, and a component of nulls only has a null id; an empty table
gives no rows; other columns are passed on untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltarecon.llm.common import free_name
from deltarecon.llm.components import connected_components
from deltarecon.session import materialize

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 5
SPARSE_RUN = 8
DENSE_RUN = 4096
_BLOCK = 1 << 16

_BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
_BYTE_AT = 256 * np.arange(8)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    ws = (text or b"").lower().split()  # of bytes: A-Z only, ASCII white space only
    if not ws:
        return 0
    n = max(1, len(ws) - shingle + 1)
    grams = map(b" ".join, zip(*(ws[i:] for i in range(shingle)))) if len(ws) > shingle else iter([b" ".join(ws)])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    seen = np.zeros(2048, np.int64)
    for i in range(0, n, _BLOCK):
        seen += np.bincount((hashes[i:i + _BLOCK, None].view(np.uint8) + _BYTE_AT).ravel(), minlength=2048)
    ones = (seen.reshape(8, 256) @ _BYTE_BITS).ravel()
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > n))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, name: str = "fingerprint",
                      keep_text: bool = True) -> DataFrame:
    """``docs`` with the fingerprint as a signed long; ``text`` must be among the columns."""
    names = docs.columns
    kept = [i for i, c in enumerate(names) if keep_text or c != "text"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(names.index("text")).cast(pa.large_binary())
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in kept), pa.array(_signed(prints))], [*(names[i] for i in kept), name])

    fields = [docs.schema.fields[i] for i in kept]
    return docs.mapInArrow(add, T.StructType([*fields, T.StructField(name, T.LongType())]))


def _chains(values: np.ndarray, width: int) -> list[tuple[np.ndarray, int, np.ndarray, list[int]]]:
    """For each start on the ring: the first two segments joined, their width,
    the other segments joined in ring order, and the widths of those."""
    widths = [width // SEGMENTS + (i < width % SEGMENTS) for i in range(SEGMENTS)]
    at = np.cumsum([0, *widths])
    segment = [(values >> np.uint64(at[i])) & np.uint64((1 << widths[i]) - 1) for i in range(SEGMENTS)]

    def joined(order: list[int]) -> np.ndarray:
        out = np.zeros_like(values)
        for i in reversed(order):
            out = (out << np.uint64(widths[i])) | segment[i]
        return out

    found = []
    for i in range(SEGMENTS):
        ring = [(i + d) % SEGMENTS for d in range(SEGMENTS)]
        found.append((joined(ring[:2]), widths[ring[0]] + widths[ring[1]], joined(ring[2:]),
                      [widths[j] for j in ring[2:]]))
    return found


def chain_keys(values: np.ndarray) -> list[np.ndarray]:
    """The 25 join keys of each fingerprint: two rings, five starts each."""
    keys = []
    for i, (first, _, rest, widths) in enumerate(_chains(values, 64)):
        for j, (second, width, _, _) in enumerate(_chains(rest, sum(widths))):
            start = np.uint64((i * SEGMENTS + j) << 48)
            keys.append(start | (first << np.uint64(width)) | second)
    return keys


def _within(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which pairs stay in the budgets of every chain from ``start``, then in ``MAX_BITS``."""
    diff = a ^ b
    ok = np.zeros(len(diff), bool)
    for i in np.unique(start):
        at = np.flatnonzero(start == i)
        _, _, rest, widths = _chains(diff[at], 64)[int(i)]
        for length in (3, 4):  # chains of one and two are equal by the key
            bits = sum(widths[: length - 2])
            part = np.bitwise_count(rest & np.uint64((1 << bits) - 1))
            at, rest = at[part <= length * MAX_BITS // SEGMENTS], rest[part <= length * MAX_BITS // SEGMENTS]
        ok[at[np.bitwise_count(diff[at]) <= MAX_BITS]] = True
    return ok


def _forest(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links among ``values``."""
    left, out = values, []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            u = frontier.pop()
            near = np.bitwise_count(left ^ u) <= MAX_BITS
            if near.any():
                out.append((np.full(int(near.sum()), u), left[near]))
                frontier.extend(left[near])
                left = left[~near]
    return out


def _run_links(values: np.ndarray, start: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within one run of equal keys; a large run is cut by a third ring first."""
    if len(values) <= DENSE_RUN:
        return _forest(values)
    _, _, rest, widths = _chains(values, 64)[start // SEGMENTS]
    _, _, rest, widths = _chains(rest, sum(widths))[start % SEGMENTS]
    out = []
    for key, _, _, _ in _chains(rest, sum(widths)):
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        for part in np.split(values[order], cuts):
            out += _forest(part)
    return out


def _links(keys: np.ndarray, values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of complete runs; ``keys`` ascend, values within a key are distinct."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    out = []
    for at in np.flatnonzero(sizes > SPARSE_RUN):
        run = slice(starts[at], starts[at] + sizes[at])
        out += _run_links(values[run], int(keys[starts[at]] >> np.uint64(48)))
    small = np.repeat((sizes > 1) & (sizes <= SPARSE_RUN), sizes)
    keys, values = keys[small], values[small]
    for step in range(1, SPARSE_RUN):
        if len(keys) <= step:
            break
        same = np.flatnonzero(keys[step:] == keys[:-step])
        a, b = values[same], values[same + step]
        ok = _within(a, b, (keys[same] >> np.uint64(48)) // SEGMENTS)
        out.append((a[ok], b[ok]))
    return out


def _links_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows come sorted by key; the last run of a batch waits for the next."""

    def emit(keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = _links(keys, values) if len(keys) else []
        for i in range(0, len(found), 256):
            a, b = (np.concatenate(x) for x in zip(*found[i:i + 256]))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(_signed(a)), pa.array(_signed(b))], ["a", "b"])

    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        keys, values = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        if waiting and (last or waiting[0][0][0] != keys[-1]):
            done = [*waiting, (keys[:last], values[:last])]
            yield from emit(*(np.concatenate(x) for x in zip(*done)))
            waiting = []
        elif last:
            yield from emit(keys[:last], values[:last])
        waiting.append((keys[last:], values[last:]))
    if waiting:
        yield from emit(*(np.concatenate(x) for x in zip(*waiting)))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        values = b.column(0).to_numpy().view(np.uint64)
        keys = chain_keys(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_signed(np.concatenate(keys))), pa.array(_signed(np.tile(values, len(keys))))],
            ["key", "fingerprint"])


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that join the distinct fingerprints of the one column
    ``fingerprint`` into their components."""
    keyed = prints.mapInArrow(_keyed, "key long, fingerprint long")
    by_key = keyed.repartition("key").sortWithinPartitions("key", "fingerprint")
    return by_key.mapInArrow(_links_of_partition, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, keep_text: bool = True) -> DataFrame:
    """``docs`` (without ``text`` if so asked) with ``fingerprint`` (signed long),
    ``component_id`` and ``is_first`` (true for just one row of each component);
    taken names get a number."""
    fp, comp, first, row = (free_name(docs, n) for n in ("fingerprint", "component_id", "is_first", "row_nr"))
    marked = with_fingerprints(docs, shingle, fp, keep_text).withColumn(row, F.monotonically_increasing_id())
    marked = materialize(marked, "simhash")
    # Least (id, row), ids before nulls.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    prints = materialize(marked.groupBy(F.col(fp).alias("fingerprint")).agg(F.min(order).alias("first")), "prints")
    roots = connected_components(fingerprint_links(prints.select("fingerprint")))
    roots = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    firsts = roots.groupBy("root").agg(F.min("first").alias("least"))
    key, least = free_name(docs, "print_key"), free_name(docs, "least_of_print")
    by_print = roots.join(firsts, "root").select(F.col("fingerprint").alias(key), F.col("least").alias(least))
    joined = marked.join(by_print, marked[fp] == by_print[key])
    kept = [c for c in docs.columns if keep_text or c != "text"]
    return joined.select(*[marked[c] for c in kept], fp, F.col(f"{least}.id").alias(comp),
                         (F.col(row) == F.col(f"{least}.row")).alias(first))


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """The digest columns per document."""
    found = near_duplicates(docs.select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component, with the columns of ``docs``."""
    return near_duplicates(docs).filter(free_name(docs, "is_first")).select(*docs.columns)
