"""Token counts by compiled finite-state transducers.

A byte-level BPE tokenizer is compiled into two deterministic transducers:

* the splitter reads classes of characters (ten states) and marks where pieces
  begin. A text is cut into chunks; each chunk's map from every entry state
  to its exit state is stepped for all chunks at once, the maps are composed by
  a parallel prefix scan within each text, and a second pass from the known
  entry states writes the marks;
* the piece transducer reads bytes, and each transition is annotated with the
  number of tokens it adds to the encoding of what was read (it may be
  negative, as a merge takes tokens back). A state is the longest suffix that
  may still grow into a token, with the last token and the count at every place
  in it where one could begin. States are made as they are first reached.

A merge list's encoding of a piece is the one sequence whose neighbours are
each other's encoding, so the token that ends at a place is the one whose
predecessor's last token fits it.

Memory: texts are read in sections, and states and known pieces are dropped and
made anew beyond a limit; neither changes a result.

Cases: null is counted as empty, with no bytes and no tokens; special strings
of the file inside a text are one token each and split it, as is the library's
default; repeated rows and ids are counted on their own; an empty table gives no
rows; other columns don't matter.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN_LIMIT = 1024
CHUNK = 128
SECTION = 1 << 20
MAX_STATES = 300_000
MAX_PIECES = 300_000

# Splitter states: at a piece's start, in a run of letters, digits or others, after a
# run of white space that ends in a space or in another one, after an apostrophe
# that began a piece, and after that and r, v or l.
START, LETTERS, DIGITS, OTHERS, SPACE, BLANK, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(10)
STATES = 10
# Symbols: letters (those of the contractions 's 't 'm 'd 're 've 'll on their own),
# digits, others, apostrophe, space, other white space; PAD leaves any state as it is.
LETTER, STMD, R, V, L, E, DIGIT, OTHER, APOSTROPHE, BLANK_SPACE, WHITE, PAD = range(12)
UNKNOWN = 255
CUT_HERE, CUT_BEFORE = 1, 2


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and cuts by symbol and state."""
    follow = np.tile(np.arange(STATES, dtype=np.uint8), (12, 1))
    cuts = np.zeros((12, STATES), np.uint8)
    opened = {DIGIT: DIGITS, OTHER: OTHERS, APOSTROPHE: QUOTE, BLANK_SPACE: SPACE, WHITE: BLANK,
              **{x: LETTERS for x in (LETTER, STMD, R, V, L, E)}}
    same = {LETTERS: {LETTER, STMD, R, V, L, E}, DIGITS: {DIGIT}, OTHERS: {OTHER, APOSTROPHE}}

    def plain(x: int, q: int) -> tuple[int, int]:
        """From a run of one kind: it goes on, or a piece begins."""
        return (q, 0) if x in same.get(q, ()) else (opened[x], CUT_HERE)

    for x in range(PAD):
        white = x in (BLANK_SPACE, WHITE)
        for q in range(STATES):
            if q in (SPACE, BLANK):
                if white:
                    to, cut = opened[x], 0
                elif q == SPACE:  # the space joins what follows, an apostrophe as one of the others
                    to, cut = OTHERS if x == APOSTROPHE else opened[x], CUT_BEFORE
                else:
                    to, cut = opened[x], CUT_BEFORE | CUT_HERE
            elif q == QUOTE:
                pending = {STMD: START, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}
                to, cut = (pending[x], 0) if x in pending else plain(x, OTHERS)
            elif q in (QUOTE_R, QUOTE_V, QUOTE_L):
                if x == (L if q == QUOTE_L else E):
                    to, cut = START, 0
                else:  # no contraction: the letter after the apostrophe began a piece
                    to, cut = plain(x, LETTERS)
                    cut |= CUT_BEFORE
            else:
                to, cut = plain(x, q)
            follow[x, q], cuts[x, q] = to, cut
    return follow, cuts


FOLLOW, CUTS = _splitter()


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceTransducer:
    """Counts the tokens of one piece; transitions are made when first needed."""

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        byte = _byte_letters()
        raw = lambda token: bytes(byte[c] for c in token)
        self.rank: dict[bytes, int] = {bytes([b]): -1 - b for b in byte.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for i, pair in enumerate(merges):
            left, right = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.parts[i] = self.rank[left], self.rank[right]
            self.merged[self.parts[i]] = i
            self.rank.setdefault(left + right, i)
        if any(raw(t) not in self.rank for t in vocab if all(c in byte for c in t)):
            raise ValueError("the vocabulary has tokens that no merge makes")
        self.grows = {t[:n] for t in self.rank for n in range(len(t))}
        self._fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple[bytes, tuple]] = [(b"", ((0, None, 0),))]
        self.number = {self.states[0]: 0}
        self.step: dict[int, int] = {}
        self._fits.clear()

    def fits(self, a: int, b: int) -> bool:
        """Whether token a then b stay as they are when encoded together."""
        key = a, b
        if key in self._fits:
            return self._fits[key]
        bound, ok = 1 << 60, None
        while ok is None:
            if self.merged.get((a, b), 1 << 61) < bound:
                ok = False  # they would have merged before their parts grew
            elif a < 0 and b < 0:
                ok = True
            elif a > b:  # undo the later merge; of equal ones the right is later
                bound, a = a, self.parts[a][1]
            else:
                bound, b = b + 1, self.parts[b][0]
        self._fits[key] = ok
        return ok

    def _make(self, state: int, byte: int) -> int:
        suffix, places = self.states[state]
        text = suffix + bytes([byte])
        for length, last, since in places:
            token = self.rank.get(text[len(text) - length - 1:])
            if token is not None and (last is None or self.fits(last, token)):
                added = 1 - since
                break
        else:
            raise ValueError("no token ends here: the merge list is not proper")
        grown = tuple((n + 1, last, since + added) for n, last, since in places
                      if text[len(text) - n - 1:] in self.grows)
        longest = grown[0][0] if grown else 0
        new = (text[len(text) - longest:], (*grown, (0, token, 0)))
        to = self.number.setdefault(new, len(self.states))
        if to == len(self.states):
            self.states.append(new)
        out = self.step[state << 8 | byte] = to << 9 | added + 256
        return out

    def count(self, piece: bytes) -> int:
        if len(self.states) > MAX_STATES:
            self.reset()
        step, state, n = self.step, 0, 0
        for byte in piece:
            go = step.get(state << 8 | byte)
            if go is None:
                go = self._make(state, byte)
            state, n = go >> 9, n + (go & 511) - 256
        return n


class _Pieces(dict):
    """Token counts of pieces seen lately."""

    def __init__(self, transducer: PieceTransducer) -> None:
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> int:
        if len(self) > MAX_PIECES:
            self.clear()
        n = self[piece] = self.transducer.count(piece.encode())
        return n


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes of all runs one after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


def split_marks(symbols: np.ndarray, sizes: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end, of ``sizes`` and read from the states ``entry``:
    the cut flags by character, whether the character before each text is a
    cut, and each text's exit state."""
    chunks = -(-sizes // CHUNK)
    n = int(chunks.sum())
    text_of = np.repeat(np.arange(len(sizes)), chunks)
    first = np.concatenate([[0], np.cumsum(chunks)[:-1]]) if len(sizes) else np.zeros(0, int)
    nth = np.arange(n) - first[text_of]
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])[text_of] + nth * CHUNK if n else np.zeros(0, int)
    length = np.minimum(CHUNK, sizes[text_of] - nth * CHUNK)
    at = begin[:, None] + np.arange(CHUNK)
    inside = np.arange(CHUNK) < length[:, None]
    table = np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], PAD) if n else np.zeros((0, CHUNK), np.uint8)
    table = np.ascontiguousarray(table.T)

    maps = np.tile(np.arange(STATES, dtype=np.uint8), (n, 1))
    for row in table:
        maps = FOLLOW[row[:, None], maps]
    # Prefix scan: after round d each map covers up to 2 ** d chunks of its text.
    reach = 1
    while n and reach < int(chunks.max()):
        later = np.flatnonzero(nth >= reach)
        maps[later] = np.take_along_axis(maps[later], maps[later - reach], axis=1)
        reach *= 2
    state = entry[text_of].astype(np.uint8)
    after = np.flatnonzero(nth > 0)
    state[after] = maps[after - 1, entry[text_of[after]]]
    leave = entry.astype(np.uint8).copy()
    some = np.flatnonzero(chunks > 0)
    leave[some] = maps[first[some] + chunks[some] - 1, entry[some]]

    found = np.empty((CHUNK, n), np.uint8)
    for k, row in enumerate(table):
        found[k] = CUTS[row, state]
        state = FOLLOW[row, state]
    found = found.T[inside]
    marks = (found & CUT_HERE).astype(bool)
    before = (found & CUT_BEFORE).astype(bool)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, int)
    ahead = np.zeros(len(sizes), bool)
    ahead[some] = before[starts[some]]
    before[starts[some]] = False
    marks[:-1] |= before[1:]
    return marks, ahead, leave


class TokenCounter:
    """Counts tokens as the tokenizer file's library does, without added ones."""

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        j = json.loads(spec)
        pre, model = j["pre_tokenizer"], j["model"]
        if (pre["type"], pre["add_prefix_space"], pre.get("use_regex", True)) != ("ByteLevel", False, True) \
                or model["type"] != "BPE" or j["normalizer"] or model.get("ignore_merges") \
                or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in j["added_tokens"]):
            raise ValueError("only plain byte-level BPE files are compiled")
        self.pieces = _Pieces(PieceTransducer(model["vocab"], model["merges"]))
        self.special = [a["content"] for a in j["added_tokens"]]
        self._split = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
        self.symbol = np.full(0x110000, UNKNOWN, np.uint8)
        for symbol, chars in ((STMD, "stmd"), (R, "r"), (V, "v"), (L, "l"), (E, "e"), (APOSTROPHE, "'"), (BLANK_SPACE, " ")):
            for c in chars:
                self.symbol[ord(c)] = symbol

    def _learn(self, codes: np.ndarray) -> None:
        """The class of code points not met before, as the file's own splitting has it."""
        for code in codes.tolist():
            alone = [s for s, c in ((LETTER, "a"), (DIGIT, "1"), (OTHER, "!")) if len(self._split(c + chr(code) + c)) == 1]
            self.symbol[code] = alone[0] if alone else WHITE

    def symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        out = self.symbol[codes]
        if (out == UNKNOWN).any():
            self._learn(np.unique(codes[out == UNKNOWN]))
            out = self.symbol[codes]
        return out

    def _parts(self, text: str) -> tuple[list[str], int]:
        """What lies between special strings, and how many of those there are."""
        parts = [text]
        for s in self.special:
            parts = [x for p in parts for x in p.split(s)] if any(s in p for p in parts) else parts
        return parts, len(parts) - 1

    def _count_short(self, texts: list[str]) -> np.ndarray:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        whole = "".join(texts)
        out = np.zeros(len(texts), np.int64)
        if not whole:
            return out
        marks, _, leave = split_marks(self.symbols(whole), sizes, np.full(len(texts), START))
        ends = np.cumsum(sizes)
        hanging = np.isin(leave, (QUOTE_R, QUOTE_V, QUOTE_L)) & (sizes > 0)
        marks[ends[hanging] - 1] = True
        cuts = np.flatnonzero(marks)
        at = [*cuts.tolist(), len(whole)]
        counts = np.fromiter((self.pieces[whole[a:b]] for a, b in zip(at, at[1:])), np.int64, len(cuts))
        total = np.concatenate([[0], np.cumsum(counts)])
        edge = np.searchsorted(cuts, np.concatenate([[0], ends]))
        return total[edge[1:]] - total[edge[:-1]]

    def _count_long(self, text: str) -> int:
        """In sections; an unfinished piece waits with the splitter's state."""
        state, waiting, n = np.array([START]), "", 0
        for i in range(0, len(text), SECTION):
            part = text[i:i + SECTION]
            marks, ahead, state = split_marks(self.symbols(part), np.array([len(part)]), state)
            if ahead[0] and len(waiting) > 1:
                n += self.pieces.transducer.count(waiting[:-1].encode())
                waiting = waiting[-1]
            cuts = np.flatnonzero(marks).tolist()
            if cuts:
                if waiting or cuts[0]:
                    n += self.pieces.transducer.count((waiting + part[:cuts[0]]).encode())
                n += sum(self.pieces[part[a:b]] for a, b in zip(cuts, cuts[1:]))
                waiting = part[cuts[-1]:]
            else:
                waiting += part
        if state[0] in (QUOTE_R, QUOTE_V, QUOTE_L):
            n += self.pieces.transducer.count(waiting[:-1].encode())
            waiting = waiting[-1]
        return n + (self.pieces.transducer.count(waiting.encode()) if waiting else 0)

    def count(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        group: list[tuple[int, str]] = []

        def close() -> None:
            np.add.at(out, [i for i, _ in group], self._count_short([t for _, t in group]))
            group.clear()

        size = 0
        for i, text in enumerate(texts):
            parts, specials = self._parts(text or "")
            out[i] += specials
            for p in parts:
                if len(p) > SECTION:
                    out[i] += self._count_long(p)
                    continue
                if size + len(p) > SECTION:
                    close()
                    size = 0
                group.append((i, p))
                size += len(p)
        close()
        return out


_COUNTERS: dict[int, TokenCounter] = {}


def _counter(spec: str) -> TokenCounter:
    """One compiled counter a worker process."""
    key = hash(spec)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = TokenCounter(spec)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``,
    ``over_limit``. ``tokenizer_file`` is read by the driver and sent to the executors
    (it is a few MB, whatever the input)."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counter = _counter(spec.value)
            texts = b.column(2)
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                counts = counter.count(texts.slice(at, 256).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts)],
                                                 ["doc_id", "n_bytes", "n_tokens"])

    wide = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = wide.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
