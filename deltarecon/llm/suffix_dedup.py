"""Removal of repeated 100-byte strings by merged shard Burrows-Wheeler transforms.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier, in a
document with a smaller id or earlier in the same one.

Splitting the work. Of the hashes of all ``K``-byte strings inside a window of
``LENGTH`` bytes the least, leftmost of equal ones, is the window's anchor; equal
windows have equal anchors, so windows are compared only under one anchor.
Consecutive windows with one anchor form a segment. Texts are dealt to
blocks by hash; a block sends the distinct segments of its texts (two hashes each) to
the partition that holds their anchors. There, all but the first of equal
segments are answered as covered, and an anchor with a single kind of segment needs
nothing more. Of anchors with several kinds, the first segment of each kind is sent
as text.

Comparing. In a partition, the texts from one block are a shard. Each shard's
suffixes are sorted and its Burrows-Wheeler transform taken. The transforms are merged
by interleave refinement: starting from the shards one after another, every
round reads the symbols before the suffixes in the present order and deals the
suffixes before them out by symbol, stably; after round r the interleave is the order
by r symbols, and the borders between suffixes that differ show the common prefixes
shorter than that. Intervals of one suffix are final and leave the rounds. A symbol is
a pair of bytes here, so fifty rounds find the intervals whose common prefix reaches
``LENGTH``. In each of them all but the earliest window are covered. No suffix is compared with one of another shard.

Skew: a passage that many documents share is one segment a block wherever its
neighbourhood is the same, and equal texts are equal segments throughout. Segments at
the edges of such a passage differ and meet in the partition of its anchor. An anchor
with more than ``hot_kinds`` kinds would be too much for one task: the windows of its
segments are spread over all partitions by their own hashes (two of 64 bits) and
compared by those.

Cases: null is read as empty; texts shorter than ``LENGTH`` lose nothing; documents
with a null id come last; rows of one id are ordered as they were read, so of repeated
rows one stays; an empty table gives no rows; other columns are passed on; long texts
are anchored in pieces of bounded size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltarecon.llm.common import free_name
from deltarecon.llm.packed import ddl, mix, pack, part_of, rows, unpack

LENGTH = 100
K = 32
SPAN = LENGTH - K + 1  # K-byte strings in a window
BLOCK_BYTES = 8 << 20
PART_BYTES = 12 << 20
PIECE = 1 << 19

# Kinds of one anchor up to which they are compared in one task (about 8 MB of text).
HOT_KINDS = 50_000

FIRST, COVERED, SEND, SPREAD = 0, 1, 2, 3


def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``K`` bytes from each place on."""
    n = len(data) - K + 1
    eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    eights = np.ascontiguousarray(eights).view("<u8").ravel()
    h = np.zeros(n, np.uint64)
    for at in range(0, K, 8):
        h = (h ^ eights[at:at + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of every ``span`` consecutive values."""
    out, width = values, 1
    while width * 2 <= span:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    n = len(values) - span + 1
    return np.minimum(out[:n], out[span - width:span - width + n])


def _segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """For all segments: text number, first window, number of windows, anchor."""
    out = []
    group: list[tuple[int, int, bytes]] = []  # text number, offset of the piece, piece

    def close() -> None:
        sizes = np.array([len(p) for _, _, p in group])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        h = _hashes(data)
        at = np.arange(len(h), dtype=np.uint64)
        least = _least((h & ~np.uint64(0xFFFFFFFF)) | at, SPAN) & np.uint64(0xFFFFFFFF)
        anchor = least.astype(np.int64)
        piece = np.repeat(np.arange(len(group)), sizes)[:len(anchor)]
        ok = np.arange(len(anchor)) + LENGTH <= ends[piece]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
        starts = np.flatnonzero(new & ok)
        stop = np.flatnonzero(ok & ~np.concatenate([ok[1:] & ~new[1:], [False]]))
        number = np.array([i for i, _, _ in group])
        offset = np.array([o for _, o, _ in group]) - (ends - sizes)
        of = piece[starts]
        out.append((number[of], starts + offset[of], stop - starts + 1, mix(h[anchor[starts]])))
        group.clear()

    size = 0
    for i, t in enumerate(texts):
        for o in range(0, len(t) - LENGTH + 1, PIECE):
            p = t[o:o + PIECE + LENGTH - 1]
            if size and size + len(p) > 2 * PIECE:
                close()
                size = 0
            group.append((i, o, p))
            size += len(p)
    if group:
        close()
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


class _Block:
    """A block's texts in order, their segments, and the distinct ones as they are sent."""

    def __init__(self, table: pa.Table, names: dict[str, str], parts: int) -> None:
        nth = table[names["row"]].to_numpy().astype(np.int64)
        ids = table["doc_id"]
        none = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.lexsort((nth, ids.fill_null(0).to_numpy().astype(np.int64), none))
        self.table = table.take(pa.array(order))
        self.keys = np.stack([none[order], ids.fill_null(0).to_numpy().astype(np.int64)[order], nth[order]])
        self.texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in self.table["text"]]
        self.text, self.start, self.windows, self.anchor = _segments(self.texts)
        ends = (self.start + self.windows + LENGTH - 1).tolist()
        kind = np.fromiter((xxhash.xxh64_intdigest(self.texts[i][a:b]) for i, a, b in zip(
            self.text.tolist(), self.start.tolist(), ends)), np.uint64, len(ends))
        order = np.lexsort((self.start, self.text, kind, self.anchor))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(self.anchor[order]) != 0) | (np.diff(kind[order]) != 0)
        self.sent = order[new]  # by anchor and kind
        self.again = order[~new]  # covered within the block
        self.kind = kind[self.sent]
        edges = np.searchsorted(part_of(self.anchor[self.sent], parts), np.arange(parts + 1))
        self.parts = list(zip(edges.tolist(), edges[1:].tolist()))

    def texts_of(self, segments: np.ndarray) -> tuple[np.ndarray, bytes]:
        sizes = self.windows[segments] + LENGTH - 1
        data = b"".join(self.texts[i][a:a + n] for i, a, n in zip(
            self.text[segments].tolist(), self.start[segments].tolist(), sizes.tolist()))
        return sizes, data

    def order_columns(self, segments: np.ndarray) -> dict[str, bytes]:
        """The documents of some segments, and which one each is of."""
        docs, which = np.unique(self.text[segments], return_inverse=True)
        return {"docs": pack(self.keys[:, docs].ravel().view(np.uint64)), "which": pack(which)}


_ASK = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("anchors", pa.binary()), ("kinds", pa.binary()),
                  ("docs", pa.binary()), ("which", pa.binary()), ("starts", pa.binary()), ("sizes", pa.binary()),
                  ("data", pa.binary())])
_ANSWER = pa.schema([("block", pa.int32()), ("step", pa.int32()), ("part", pa.int32()), ("flags", pa.binary())])


def _ask_kinds(table: pa.Table, names: dict[str, str], parts: int) -> pa.Table:
    b = _Block(table, names, parts)
    number = table[names["block"]][0].as_py()
    return rows(_ASK, [
        dict(part=p, block=number, anchors=pack(b.anchor[b.sent[lo:hi]]), kinds=pack(b.kind[lo:hi]),
             **b.order_columns(b.sent[lo:hi]))
        for p, (lo, hi) in enumerate(b.parts) if hi > lo])


def _ranks(asked: list[dict]) -> np.ndarray:
    """The place of each segment's document among all of the partition."""
    docs = [unpack(x["docs"]).astype(np.uint64).view(np.int64).reshape(3, -1) for x in asked]
    whole = np.concatenate(docs, axis=1)
    rank = np.empty(whole.shape[1], np.int64)
    rank[np.lexsort(whole[::-1])] = np.arange(whole.shape[1])
    at = np.cumsum([0, *(d.shape[1] for d in docs)])
    return np.concatenate([rank[unpack(x["which"]).astype(np.int64) + a] for x, a in zip(asked, at)])


def _answer_kinds(table: pa.Table, hot_kinds: int) -> pa.Table:
    """For every segment sent: the first of its kind and anchor, a later one, or the
    first of one of several kinds."""
    asked = table.to_pylist()
    anchors = np.concatenate([unpack(x["anchors"]).astype(np.uint64) for x in asked])
    kinds = np.concatenate([unpack(x["kinds"]).astype(np.uint64) for x in asked])
    order = np.lexsort((_ranks(asked), kinds, anchors))
    a, k = anchors[order], kinds[order]
    other_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    first = other_anchor | np.concatenate([[True], k[1:] != k[:-1]])
    n_kinds = np.add.reduceat(first.astype(np.int64), np.flatnonzero(other_anchor))
    n_kinds = n_kinds[np.cumsum(other_anchor) - 1]
    flags = np.empty(len(order), np.uint8)
    flags[order] = np.select([~first, n_kinds == 1, n_kinds <= hot_kinds], [COVERED, FIRST, SEND], SPREAD)
    edges = np.cumsum([0, *(len(unpack(x["anchors"])) for x in asked)])
    return rows(_ANSWER, [dict(block=x["block"], step=0, part=x["part"], flags=flags[lo:hi].tobytes())
                          for x, lo, hi in zip(asked, edges, edges[1:])])


def _flags(answers: list[dict], step: int) -> dict[int, np.ndarray]:
    return {a["part"]: np.frombuffer(a["flags"], np.uint8) for a in answers if a["step"] == step}


def _spread(b: _Block, flags_of: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The windows of segments under hot anchors, by hash: text, start, both hashes."""
    hot = [b.sent[b.parts[p][0]:b.parts[p][1]][f == SPREAD] for p, f in sorted(flags_of.items())]
    hot = np.concatenate(hot) if hot else np.zeros(0, np.int64)
    n = b.windows[hot]
    text = np.repeat(b.text[hot], n)
    start = np.arange(int(n.sum())) + np.repeat(b.start[hot] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(hot) else text
    strings = [b.texts[i][s:s + LENGTH] for i, s in zip(text.tolist(), start.tolist())]
    one, two = (np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in strings), np.uint64, len(strings)) for seed in (1, 2))
    order = np.lexsort((start, text, two, one))
    return text[order], start[order], one[order], two[order]


def _ask_windows(b: _Block, spread: tuple, number: int, parts: int) -> list[dict]:
    text, start, one, two = spread
    edges = np.searchsorted(part_of(one, parts), np.arange(parts + 1)).tolist()
    items = []
    for p, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if hi > lo:
            docs, which = np.unique(text[lo:hi], return_inverse=True)
            items.append(dict(part=p, block=number, anchors=pack(one[lo:hi]), kinds=pack(two[lo:hi]), starts=pack(start[lo:hi]),
                              docs=pack(b.keys[:, docs].ravel().view(np.uint64)), which=pack(which)))
    return items


def _answer_windows(asked: list[dict]) -> list[dict]:
    """For windows sent by their hashes, whether each also starts earlier."""
    one, two, start = (np.concatenate([unpack(x[c]).astype(np.uint64) for x in asked]) for c in ("anchors", "kinds", "starts"))
    order = np.lexsort((start, _ranks(asked), two, one))
    covered = np.zeros(len(order), np.uint8)
    covered[order[1:]] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    edges = np.cumsum([0, *(len(unpack(x["anchors"])) for x in asked)])
    return [dict(block=x["block"], step=2, part=x["part"], flags=np.packbits(covered[lo:hi]).tobytes())
            for x, lo, hi in zip(asked, edges, edges[1:])]


def _ask_texts(docs: pa.Table, answers: pa.Table, names: dict[str, str], parts: int) -> pa.Table:
    if not docs.num_rows:
        return _ASK.empty_table()
    b = _Block(docs, names, parts)
    flags_of = _flags(answers.to_pylist(), 0)
    number = docs[names["block"]][0].as_py()
    items = _ask_windows(b, _spread(b, flags_of), number, parts)
    for p, flags in sorted(flags_of.items()):
        lo, hi = b.parts[p]
        chosen = b.sent[lo:hi][flags == SEND]
        if len(chosen):
            sizes, data = b.texts_of(chosen)
            items.append(dict(part=p, block=number, starts=pack(b.start[chosen]),
                              sizes=pack(sizes), data=pa.compress(data, codec="zstd", asbytes=True),
                              **b.order_columns(chosen)))
    return rows(_ASK, items)


def shard_suffixes(symbols: np.ndarray, shard: np.ndarray, strings: int) -> np.ndarray:
    """The suffixes of each shard in order, shards one after another.

    ``symbols`` are strings of bytes plus one, each ended by a zero; ends are ordered as
    the strings are, so a suffix that reaches its end is placed. Ranks double the
    prefix they stand for, and only suffixes that still tie are sorted again.
    """
    n = len(symbols)
    key = symbols.astype(np.int64) + strings
    ends = np.flatnonzero(symbols == 0)
    key[ends] = np.arange(strings)
    key += shard.astype(np.int64) * (strings + 257)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)

    def place(items: np.ndarray, first: np.ndarray, base: np.ndarray) -> None:
        """Ranks of sorted ``items``: the place of the first of each run of equals."""
        at = np.flatnonzero(first)
        rank[items] = base[np.repeat(at, np.diff(np.append(at, len(items))))]

    sorted_key = key[order]
    first = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    places = np.arange(n)
    place(order, first, places)
    h = 1
    alone = first & np.concatenate([first[1:], [True]])
    items, places = order[~alone], places[~alone]
    while len(items) and h < LENGTH:
        key = rank[items] * n + rank[items + h]
        by = np.argsort(key, kind="stable")
        items, key = items[by], key[by]
        order[places] = items
        first = np.concatenate([[True], key[1:] != key[:-1]])
        place(items, first, places)
        alone = first & np.concatenate([first[1:], [True]])
        items, places = items[~alone], places[~alone]
        h *= 2
    return order


def repeated_intervals(symbols: np.ndarray, shard: np.ndarray, strings: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes whose first ``LENGTH`` symbols occur again, in the order of the
    merged transforms, and the number of each one's interval of equal ones.

    A suffix that is unlike all others by some round stays so, and so does every suffix
    before it in its string: the interleave is refined only where an interval still
    holds several suffixes, and the others are left out of the rounds that follow.
    """
    order = shard_suffixes(symbols, shard, strings)
    n = len(order)
    inverse = np.empty(n, np.int32)
    inverse[order] = np.arange(n, dtype=np.int32)
    kinds = np.unique(symbols)  # 0, the end, is among them
    small = np.searchsorted(kinds, np.arange(int(kinds[-1]) + 1)).astype(np.uint16)[symbols]
    base = len(kinds)
    if base > 256:
        raise ValueError("texts are not UTF-8")
    ends = np.flatnonzero(symbols == 0)
    offset = np.arange(n, dtype=np.int32) - np.repeat(
        np.concatenate([[0], ends[:-1] + 1]), np.diff(np.concatenate([[-1], ends]))).astype(np.int32)
    two = np.flatnonzero(offset >= 2)
    del offset
    # The transform: the pair of symbols before each suffix in its shard's order (0:
    # the string begins there), and where in that order the suffix with the pair is.
    before = np.zeros(n, np.uint16)
    before[inverse[two]] = small[two - 2] * np.uint16(base) + small[two - 1]
    jump = np.zeros(n, np.int32)
    jump[inverse[two]] = inverse[two - 2]
    del inverse, two, small

    # By no symbol all suffixes are equal, ends too; with one, an end is unlike all others,
    # as is a suffix of one symbol with two: neither comes up again.
    at, block = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
    for _ in range(LENGTH // 2):
        key = before[at]
        by = np.argsort(key, kind="stable")
        by = by[np.searchsorted(key[by], 1):]
        key, at, block = key[by], jump[at[by]], block[by]
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        several = ~(new & np.concatenate([new[1:], [True]]))
        at, block = at[several], np.cumsum(new[several], dtype=np.int32)
    return order[at], block


def _answer_texts(table: pa.Table) -> pa.Table:
    """For every window of the segments sent, whether it also starts earlier."""
    asked = sorted(table.to_pylist(), key=lambda x: x["block"])
    by_hash = [x for x in asked if x["data"] is None]
    answers = _answer_windows(by_hash) if by_hash else []
    asked = [x for x in asked if x["data"] is not None]
    return rows(_ANSWER, answers + (_answer_shards(asked) if asked else []))


def _answer_shards(asked: list[dict]) -> list[dict]:
    sizes = [unpack(x["sizes"]).astype(np.int64) for x in asked]
    size = np.concatenate(sizes)
    shard_of = np.repeat(np.arange(len(asked)), [len(s) for s in sizes])
    strings = len(size)
    # Each string with an end after it.
    symbols = np.zeros(int(size.sum()) + strings, np.uint16)
    is_end = np.zeros(len(symbols), bool)
    is_end[np.cumsum(size + 1) - 1] = True
    symbols[~is_end] = np.frombuffer(b"".join(
        pa.decompress(x["data"], decompressed_size=int(n.sum()), codec="zstd", asbytes=True)
        for x, n in zip(asked, sizes)), np.uint8).astype(np.uint16) + 1
    suffix, block = repeated_intervals(symbols, np.repeat(shard_of, size + 1).astype(np.int32), strings)

    begin = np.cumsum(size + 1) - size - 1
    starts = np.concatenate([unpack(x["starts"]).astype(np.int64) for x in asked])
    first_byte = (_ranks(asked) << 36) + starts - begin  # plus the place: order of all windows
    covered = np.zeros(len(symbols), np.uint8)
    if len(suffix):
        where = first_byte[np.searchsorted(begin, suffix, "right") - 1] + suffix
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        least = np.repeat(np.minimum.reduceat(where, first), np.diff(np.append(first, len(where))))
        covered[suffix] = where > least

    windows = size - LENGTH + 1
    window = np.arange(int(windows.sum())) + np.repeat(begin - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
    covered = covered[window]
    edges = np.cumsum([0, *(int(s.sum()) - (LENGTH - 1) * len(s) for s in sizes)])
    return [dict(block=x["block"], step=1, part=x["part"], flags=np.packbits(covered[lo:hi]).tobytes())
            for x, lo, hi in zip(asked, edges, edges[1:])]


def _removed(b: _Block, answers: list[dict], parts: int) -> list[np.ndarray]:
    """For each text, which bytes go."""
    kinds, texts = _flags(answers, 0), _flags(answers, 1)
    whole, some_text, some_start = [b.again], [], []
    for p, flags in sorted(kinds.items()):
        sent = b.sent[b.parts[p][0]:b.parts[p][1]]
        whole.append(sent[flags == COVERED])
        chosen = sent[flags == SEND]
        if len(chosen):
            n = b.windows[chosen]
            bits = np.unpackbits(texts[p], count=int(n.sum())).astype(bool)
            starts = np.arange(int(n.sum())) + np.repeat(b.start[chosen] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            some_text.append(np.repeat(b.text[chosen], n)[bits])
            some_start.append(starts[bits])
    text, start, one, _ = _spread(b, kinds)
    for p, flags in sorted(_flags(answers, 2).items()):
        mine = np.flatnonzero(part_of(one, parts) == p)
        bits = np.unpackbits(flags, count=len(mine)).astype(bool)
        some_text.append(text[mine][bits])
        some_start.append(start[mine][bits])
    w = np.concatenate(whole)
    text = np.concatenate([b.text[w], *some_text])
    start = np.concatenate([b.start[w], *some_start])
    end = np.concatenate([b.start[w] + b.windows[w] + LENGTH - 1, *(s + LENGTH for s in some_start)])
    order = np.argsort(text, kind="stable")
    edges = np.searchsorted(text[order], np.arange(len(b.texts) + 1))
    out = []
    for i, t in enumerate(b.texts):
        mine = order[edges[i]:edges[i + 1]]
        depth = np.zeros(len(t) + 1, np.int32)
        np.add.at(depth, start[mine], 1)
        np.add.at(depth, end[mine], -1)
        out.append(np.cumsum(depth)[:-1] > 0)
    return out


def _dealt(docs: DataFrame, block_bytes: int, part_bytes: int) -> tuple[DataFrame, dict[str, str], int]:
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id must be a whole number: which of two strings comes first is decided by it")
    names = {n: free_name(docs, n) for n in ("row", "block")}
    size = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    blocks, parts = max(1, -(-size // block_bytes)), max(1, -(-size // part_bytes))
    row = F.monotonically_increasing_id()
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    return docs.withColumns({names["row"]: row, names["block"]: block}).repartition(names["block"]), names, parts


def _removals(docs: DataFrame, finish, schema, block_bytes: int, part_bytes: int, hot_kinds: int) -> DataFrame:
    """Applies ``finish(block, removed)`` to every block."""
    dealt, names, parts = _dealt(docs, block_bytes, part_bytes)
    by_block = lambda: dealt.groupBy(names["block"])
    kinds = by_block().applyInArrow(lambda t: _ask_kinds(t, names, parts), ddl(_ASK))
    kinds = kinds.groupBy("part").applyInArrow(lambda t: _answer_kinds(t, hot_kinds), ddl(_ANSWER))
    texts = by_block().cogroup(kinds.groupBy("block")).applyInArrow(
        lambda d, a: _ask_texts(d, a, names, parts), ddl(_ASK))
    texts = texts.groupBy("part").applyInArrow(_answer_texts, ddl(_ANSWER))

    def done(d: pa.Table, a: pa.Table) -> pa.Table:
        if not d.num_rows:
            return finish(None, [], d)
        b = _Block(d, names, parts)
        return finish(b, _removed(b, a.to_pylist(), parts), d)

    return by_block().cogroup(kinds.union(texts).groupBy("block")).applyInArrow(done, schema)


def repeat_report(docs: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES,
                  hot_kinds: int = HOT_KINDS) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (runs of removed
    bytes), ``kept_sha256`` of the bytes that stay."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def finish(b: _Block | None, removed: list[np.ndarray], d: pa.Table) -> pa.Table:
        texts = b.texts if b else []
        ids = b.table["doc_id"] if b else d["doc_id"]
        edges = [np.diff(np.concatenate([[False], r]).astype(np.int8)) for r in removed]
        kept = [hashlib.sha256(np.frombuffer(t, np.uint8)[~r].tobytes()).hexdigest() for t, r in zip(texts, removed)]
        return pa.table({
            "doc_id": ids, "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_removed": pa.array([int(r.sum()) for r in removed], pa.int64()),
            "n_spans": pa.array([int((e == 1).sum()) for e in edges], pa.int64()),
            "kept_sha256": pa.array(kept, pa.string())})

    return _removals(docs.select("doc_id", "text"), finish,
                     f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                     block_bytes, part_bytes, hot_kinds)


def without_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES,
                    hot_kinds: int = HOT_KINDS) -> DataFrame:
    """``docs`` with repeated strings removed from ``text`` (a character that a removal
    cuts goes whole) and ``n_chars``, where present, as the new text has it. Documents
    that lose all their text are left out."""
    columns = docs.columns
    schema = T.StructType(docs.schema.fields)

    def finish(b: _Block | None, removed: list[np.ndarray], d: pa.Table) -> pa.Table:
        if b is None:
            return d.select(columns)
        texts, lost = [], []
        for t, r, was in zip(b.texts, removed, b.table["text"]):
            if not r.any():
                texts.append(was.as_py())
            else:
                texts.append(np.frombuffer(t, np.uint8)[~r].tobytes().decode("utf-8", "ignore"))
            lost.append(bool(t) and not texts[-1])
        out = b.table.select(columns)
        at = columns.index("text")
        out = out.set_column(at, "text", pa.array(texts, out.schema.field("text").type))
        if "n_chars" in columns:
            new = [n if not r.any() else len(t) for n, t, r in zip(out["n_chars"].to_pylist(), texts, removed)]
            out = out.set_column(columns.index("n_chars"), "n_chars", pa.array(new, out.schema.field("n_chars").type))
        return out.filter(pa.array([not x for x in lost]))

    return _removals(docs, finish, schema, block_bytes, part_bytes, hot_kinds)
