"""Katz back-off language model: learn from some documents, score all.

The model has ``order`` orders (word pairs by default). The probability of a word
after a history is its discounted share of the n-grams that begin with that history;
where the n-gram was never seen, it is the word's probability after the history
without its first word, times the back-off weight of the history. The recursion ends
at single words. Histories don't reach beyond the start of a text: the first word
follows a start mark, the second that mark and the first word. Discounts are
Good-Turing up to counts of ``MAX_DISCOUNTED``, for each order; back-off weights are
exact: what the discounts leave, over the mass, in the order below, of the words that
never followed. All unknown words are one event, with the mass that the discounts of
single words leave.

Flow. Texts are dealt to blocks of about ``BLOCK_BYTES`` by hash. A block's
distinct words go, sorted and packed, to the partition of the word table that
holds their hash range; it adds up the counts of all blocks, numbers the words
and answers each block in the order asked. With the numbers the block packs its
distinct pairs for the partitions of the pair table, which hold ranges of first words,
and is answered with total counts, numbers, and what back-off weights need. With the
numbers of pairs it asks for triples in the same way, and so on. Histories that occur
in one block alone are settled there; of those never seen nothing is asked; a
back-off weight is sent only to blocks that back off. Counts of counts travel with
the answers, so that every block can compute discounts. Every block then scores its
own texts.

Skew: a frequent word or n-gram is one entry a block, however often it occurs. A
history with more than twice a partition's share of all tokens is spread over
all partitions, and its sums are added up where they are used. Nothing is
collected, and the tables are whole.

Cases: null is read as empty, a text of the end token alone; with no training
text every token is unknown (probability 1 for the one event there is, so the
score is 0); repeated rows and ids are texts of their own; an empty table gives
no rows; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltarecon.llm.packed import ddl, mix, pack, pack_rising, part_of, rows, unpack, unpack_rising

ORDER = 2
MAX_DISCOUNTED = 5
BLOCK_BYTES = 8 << 20
PART_BYTES = 24 << 20
HEAVY = 2.0  # of a partition's mean share of the tokens
END, START = b" ", b"\n"  # no word holds white space
START_ID = 0


class _Block:
    """The tokens of a block's texts by local word number, 0 the end."""

    def __init__(self, texts: pa.ChunkedArray, held: pa.ChunkedArray) -> None:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
        words = pa.chunked_array([x.flatten() for x in lists.chunks], pa.large_string())
        kept = pc.not_equal(words, "")  # there is an empty one where white space begins or ends a text
        owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())[kept.to_numpy()]
        self.sizes = np.bincount(owner, minlength=len(lists)) + 1
        coded = words.filter(kept).combine_chunks().dictionary_encode()
        distinct = [END, *map(str.encode, coded.dictionary.to_pylist())]
        ends = np.cumsum(self.sizes) - 1
        self.tokens = np.zeros(int(self.sizes.sum()), np.int32)
        inside = np.ones(len(self.tokens), bool)
        inside[ends] = False
        self.tokens[inside] = coded.indices.to_numpy() + 1
        self.starts = ends - self.sizes + 1
        self.train = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), self.sizes)
        self.n_words = len(distinct)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, self.n_words)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def word_counts(self) -> np.ndarray:
        """Training counts by local number."""
        return np.bincount(self.tokens[self.train], minlength=self.n_words)


_ASK_WORDS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWERS = pa.schema([("block", pa.int32()), ("level", pa.int32()), ("part", pa.int32()), ("counts", pa.binary()),
                      ("ids", pa.binary()), ("dry", pa.binary()), ("small", pa.binary()), ("mass", pa.binary()),
                      ("stats", pa.binary())])
_ASK_GRAMS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("contexts", pa.binary()), ("others", pa.binary()),
                        ("heavy", pa.binary()), ("sizes", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()),
                        ("lower", pa.binary()), ("lower_of", pa.binary()), ("factors", pa.binary()),
                        ("settled", pa.binary())])


def _ask_words(table: pa.Table, parts: int) -> pa.Table:
    """A block's distinct words with their training counts, by partition."""
    block = _Block(table["text"], table["held_out"])
    counts = block.word_counts()[block.order]
    edges = np.searchsorted(part_of(block.hashes, parts), np.arange(parts + 1))
    items = [dict(part=p, block=table["block"][0].as_py(), keys=pack(block.hashes[a:b]), counts=pack(counts[a:b]))
            for p, (a, b) in enumerate(zip(edges, edges[1:]))]
    return rows(_ASK_WORDS, items)


def _counts_of_counts(counts: np.ndarray) -> np.ndarray:
    """How many have each count from 1 to ``MAX_DISCOUNTED`` + 1."""
    return np.bincount(np.minimum(counts, MAX_DISCOUNTED + 2), minlength=MAX_DISCOUNTED + 3)[1:MAX_DISCOUNTED + 2]


def _told(total: np.ndarray, which: np.ndarray, local: np.ndarray) -> np.ndarray:
    """What blocks are told of their entries: 0 where no other block has the same, else
    1 + the count in the others."""
    return total[which] - local + (np.bincount(which, minlength=len(total))[which] > 1)


def _answer_words(table: pa.Table) -> pa.Table:
    """A partition of the word table: adds up and answers every block."""
    keys = [unpack(x.as_py()) for x in table["keys"]]
    counts = [unpack(x.as_py()).astype(np.int64) for x in table["counts"]]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate(counts), len(distinct)).astype(np.int64)
    stats = np.array([total.sum(), (total > 0).sum(), *_counts_of_counts(total)], np.int64).tobytes()
    rank = np.empty(len(total), np.int64)  # frequent words get small numbers, which pack well
    rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
    told = _told(total, which, np.concatenate(counts))
    edges = np.cumsum([0, *map(len, keys)])
    items = [dict(block=table["block"][i].as_py(), level=1, part=table["part"][0].as_py(),
                 counts=pack(told[a:b]), ids=pack(rank[which[a:b]]), stats=stats)
            for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    return rows(_ANSWERS, items)


def discounts(n: np.ndarray) -> np.ndarray:
    """The factors for counts 0 to ``MAX_DISCOUNTED`` (that of 0 unused) from counts of
    counts. Where Good-Turing gives no factor between 0 and 1 (small or odd
    corpora), all are those of absolute discounting by n1 / (n1 + 2 n2)."""
    k = MAX_DISCOUNTED
    r = np.arange(1, k + 1)
    out = np.ones(k + 1)
    if n[0] and n[:k].all():
        common = (k + 1) * n[k] / n[0]
        if common < 1:
            out[1:] = ((r + 1) * n[1:k + 1] / n[:k] / r - common) / (1 - common)
    if not ((out[1:] > 0) & (out[1:] < 1)).all():
        off = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        out[1:] = (r - off) / r
    return out


def _discounted(counts: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= MAX_DISCOUNTED, factors[np.minimum(counts, MAX_DISCOUNTED)], 1.0)


class WordModel:
    """Single words: ``stats`` is tokens, distinct words, counts of counts."""

    def __init__(self, stats: np.ndarray) -> None:
        self.n, self.v, n = int(stats[0]), int(stats[1]), stats[2:]
        self.factors = discounts(n)
        r = np.arange(1, MAX_DISCOUNTED + 1)
        left = float(((1 - self.factors[1:]) * r * n[:MAX_DISCOUNTED]).sum())
        # Without small counts nothing is left: one more token, unknown, is assumed.
        self.of = self.n if left > 0 else self.n + 1
        self.unknown = left / self.n if left > 0 else 1 / (self.n + 1)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.factors) / self.of, self.unknown)


class _Words:
    """Single words of a block as the word table knows them, by local number; the start comes last."""

    def __init__(self, block: _Block, answers: list[dict], parts: int) -> None:
        answers = sorted(answers, key=lambda a: a["part"])
        ids = np.full(block.n_words + 1, START_ID, np.int64)
        told = np.zeros(block.n_words + 1, np.int64)
        told[block.order] = np.concatenate([unpack(a["counts"]) for a in answers])
        ranks = np.concatenate([unpack(a["ids"]).astype(np.int64) for a in answers])
        ids[block.order] = 1 + ranks * parts + part_of(block.hashes, parts)
        train = np.append(block.word_counts(), 0)
        told[-1], train[-1] = told[0], train[0]  # as many starts as ends
        self.count, self.elsewhere, self.ids = train + np.maximum(told - 1, 0), told > 0, ids
        self.model = WordModel(sum(np.frombuffer(a["stats"], np.int64) for a in answers))
        self.factors, self.of_token = self.model.factors, block.tokens

    def share_of(self, grams: np.ndarray) -> np.ndarray:
        """What the shares of these words are parts of."""
        return np.full(len(grams), self.model.of, np.int64)

    def probability(self) -> np.ndarray:
        """Of each token."""
        return self.model.probability(self.count[self.of_token])


def _sums(context: np.ndarray, n: int, total: np.ndarray, lower_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By context: how many followers have each small count, and the followers' mass in the order below."""
    few = (total > 0) & (total <= MAX_DISCOUNTED)
    flat = np.bincount(context[few] * MAX_DISCOUNTED + total[few] - 1, minlength=n * MAX_DISCOUNTED)
    seen = total > 0
    return flat.reshape(n, MAX_DISCOUNTED), np.bincount(context[seen], lower_p[seen], n).astype(np.float64)


class _Grams:
    """The distinct n-grams of a block, each a context (a gram of the order below, by its
    number there) and a word; what is asked about them, and what the answers say."""

    def __init__(self, block: _Block, words: _Words, below: _Words | _Grams, level: int, parts: int, heavy_share: float) -> None:
        self.block, self.below, self.level, self.parts = block, below, level, parts
        place = np.arange(len(block.tokens)) - np.repeat(block.starts, block.sizes)
        at = np.flatnonzero(place >= level - 2)
        before = below.of_token[at - 1].astype(np.int64)
        if level == 2:
            before[place[at] == 0] = block.n_words  # the start
        distinct, which = np.unique(before * block.n_words + block.tokens[at], return_inverse=True)
        self.context, self.word = distinct // block.n_words, distinct % block.n_words
        self.train = np.bincount(which[block.train[at]], minlength=len(distinct))
        self.of_token = np.full(len(block.tokens), -1, np.int64)
        self.of_token[at] = which
        self.suffix = np.empty(len(distinct), np.int64)  # the gram without its first word
        self.suffix[which] = below.of_token[at]

        n = len(below.count)
        self.shared = below.elsewhere & (below.count > 0)  # the others are all here, or never seen
        self.heavy = self.shared & (below.count > heavy_share * words.model.n / parts)
        self.lower_of = np.zeros(n, np.int64)
        self.lower_of[self.context] = below.share_of(self.suffix)
        self._sort(words)

    def _sort(self, words: _Words) -> None:
        """The n-grams to ask for in the order they are sent: by partition, context and word."""
        asked = np.flatnonzero(self.shared[self.context])
        context, word = self.context[asked], self.word[asked]
        a, b = self.below.ids[context], words.ids[word]
        spread = np.where(self.heavy[context], mix(mix(a) ^ b.astype(np.uint64)), mix(a))
        part = part_of(spread, self.parts).astype(np.uint16 if self.parts <= 1 << 16 else np.int64)
        by_id = np.empty(len(self.below.ids), np.int64)
        by_id[np.argsort(self.below.ids)] = np.arange(len(self.below.ids))
        word_by_id = np.empty(len(words.ids), np.int64)
        word_by_id[np.argsort(words.ids)] = np.arange(len(words.ids))
        order = np.argsort(by_id[context] * len(words.ids) + word_by_id[word])
        order = order[np.argsort(part[order], kind="stable")]
        self.asked, part, self.word_ids = asked[order], part[order], b[order]
        edges = np.searchsorted(part, np.arange(self.parts + 1))
        everywhere = np.flatnonzero(self.heavy & (np.bincount(self.context, minlength=len(self.heavy)) > 0))
        everywhere = everywhere[np.argsort(self.below.ids[everywhere])]
        context = self.context[self.asked]
        new = np.ones(len(context), bool)
        new[1:] = (context[1:] != context[:-1]) | (part[1:] != part[:-1])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(context)))
        cuts = np.searchsorted(heads, edges)
        self.messages = []
        for p in range(self.parts):
            mine, counts = context[heads[cuts[p]:cuts[p + 1]]], sizes[cuts[p]:cuts[p + 1]]
            # Heavy contexts without a follower here still need this partition's sums.
            more = everywhere[~np.isin(everywhere, mine)]
            if len(more):
                mine, counts = np.concatenate([mine, more]), np.concatenate([counts, np.zeros(len(more), np.int64)])
            self.messages.append((edges[p], edges[p + 1], mine, counts))

    def ask(self, block_nr: int) -> pa.Table:
        lower = self.below.count[self.suffix]
        settled = np.asarray(_counts_of_counts(self.train[~self.shared[self.context]]), np.int64)
        factors = self.below.factors.tobytes()
        items = []
        for p, (lo, hi, contexts, sizes) in enumerate(self.messages):
            grams, n = self.asked[lo:hi], np.count_nonzero(sizes)
            items.append(dict(
                part=p, block=block_nr, contexts=pack_rising(self.below.ids[contexts[:n]]),
                others=pack(self.below.ids[contexts[n:]]), heavy=pack(self.heavy[contexts].astype(np.uint8)), sizes=pack(sizes), words=pack(self.word_ids[lo:hi]),
                counts=pack(self.train[grams]), lower=pack(lower[grams]), lower_of=pack(self.lower_of[contexts]),
                factors=factors, settled=settled.tobytes() if p == block_nr % self.parts else None))
        return rows(_ASK_GRAMS, items)

    def learn(self, answers: list[dict]) -> None:
        """Counts, numbers, denominators and back-off weights from the partitions' answers."""
        below, n = self.below, len(self.below.count)
        stats = sum(np.frombuffer(a["stats"], np.int64) for a in answers)
        self.factors = discounts(stats)
        self.count = self.train.astype(np.int64)
        self.elsewhere = np.zeros(len(self.count), bool)
        self.ids = np.zeros(len(self.count), np.int64)
        here = ~self.shared[self.context] & (self.train > 0)
        lower = below.count[self.suffix[here]]
        small, mass = _sums(self.context[here], n, self.train[here],
                            _discounted(lower, below.factors) / np.maximum(self.lower_of[self.context[here]], 1))
        dry = small.sum(axis=1) == 0
        for a, (lo, hi, contexts, sizes) in zip(sorted(answers, key=lambda a: a["part"]), self.messages):
            grams, others = self.asked[lo:hi], unpack(a["counts"]).astype(np.int64)
            self.count[grams] += np.maximum(others - 1, 0)
            self.elsewhere[grams] = others > 0
            if a["ids"] is not None:
                self.ids[grams[(others > 0) & (self.count[grams] > 0)]] = unpack_rising(a["ids"]) * self.parts + a["part"]
            told = contexts[_backs_off(self.heavy[contexts], sizes, self.count[grams])]
            small[told] += unpack(a["small"]).astype(np.int64).reshape(MAX_DISCOUNTED, -1).T
            mass[told] += unpack(a["mass"])
            dry[contexts] &= unpack(a["dry"]).astype(bool)
        # Nothing left: one more n-gram, unseen, is assumed.
        self.of = below.count + (dry & (below.count > 0))
        left = (small * (1 - self.factors[1:]) * np.arange(1, MAX_DISCOUNTED + 1)).sum(axis=1)
        left = np.where(dry, 1.0, left) / np.maximum(self.of, 1)
        self.back = np.where(below.count > 0, left / (1 - mass), 1.0)

    def share_of(self, grams: np.ndarray) -> np.ndarray:
        """What the shares of these n-grams are parts of."""
        return self.of[self.context[grams]]

    def probability(self) -> np.ndarray:
        """Of each token, after as long a history as there is up to this order."""
        p = self.below.probability()
        at = np.flatnonzero(self.of_token >= 0)
        gram = self.of_token[at]
        context, total = self.context[gram], self.count[gram]
        share = _discounted(total, self.factors) / np.maximum(self.of[context], 1)
        p[at] = np.where(total > 0, share, self.back[context] * p[at])
        return p


def _backs_off(heavy: np.ndarray, sizes: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Which contexts of a message are answered with sums: those with an n-gram never
    seen, and heavy ones, which other partitions hold too."""
    return heavy.astype(bool) | (np.bincount(np.repeat(np.arange(len(sizes)), sizes), totals == 0, len(sizes)) > 0)


def _answer_grams(table: pa.Table, level: int, numbered: bool) -> pa.Table:
    """A partition of the table of one order: totals and numbers of n-grams, and for each
    context how many followers have each small count and the followers' own mass."""
    asked = table.to_pylist()
    sizes = [unpack(x["sizes"]).astype(np.int64) for x in asked]
    contexts = [np.concatenate([unpack_rising(x["contexts"]), unpack(x["others"]).astype(np.int64)]) for x in asked]
    join = lambda name: np.concatenate([unpack(x[name]).astype(np.int64) for x in asked])
    first = np.concatenate([np.repeat(c, s) for c, s in zip(contexts, sizes)])
    second, local, lower = join("words"), join("counts"), join("lower")
    lower_of = np.concatenate([np.repeat(unpack(x["lower_of"]).astype(np.int64), s) for x, s in zip(asked, sizes)])
    order = np.lexsort((second, first))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    total = np.bincount(which, local).astype(np.int64) if len(which) else np.zeros(0, np.int64)
    told_of = _told(total, which, local)
    head = order[new]
    settled = sum(np.frombuffer(x["settled"], np.int64) for x in asked if x["settled"])
    stats = (np.asarray(_counts_of_counts(total), np.int64) + settled).tobytes()

    known, context_of = np.unique(first[head], return_inverse=True)
    factors = np.frombuffer(asked[0]["factors"])
    small, mass = _sums(context_of, len(known), total, _discounted(lower[head], factors) / np.maximum(lower_of[head], 1))
    # One more row, for heavy contexts that have nothing here.
    known, small, mass = np.append(known, -1), np.vstack([small, small[:0].sum(axis=0)]), np.append(mass, 0.0)
    items, at = [], 0
    for x, mine, n in zip(asked, contexts, sizes):
        end = at + int(n.sum())
        place = np.searchsorted(known[:-1], mine)
        place[known[place] != mine] = len(known) - 1
        totals = total[which[at:end]]
        others = told_of[at:end]
        told = place[_backs_off(unpack(x["heavy"]), n, totals)]
        items.append(dict(
            block=x["block"], level=level, part=x["part"], counts=pack(others), stats=stats,
            ids=pack_rising(which[at:end][(others > 0) & (totals > 0)]) if numbered else None,
            dry=pack((small[place].sum(axis=1) == 0).astype(np.uint8)), small=pack(small[told].T.ravel()), mass=pack(mass[told])))
        at = end
    return rows(_ANSWERS, items)


def _levels(block: _Block, answers: list[dict], upto: int, parts: int, heavy: float) -> tuple[_Words, Sequence]:
    """The block's orders from single words to ``upto``, each with what was answered on it."""
    by_level: dict[int, list[dict]] = {}
    for a in answers:
        by_level.setdefault(a["level"], []).append(a)
    words = _Words(block, by_level[1], parts)
    levels: list = [words]
    for level in range(2, upto + 1):
        grams = _Grams(block, words, levels[-1], level, parts, heavy)
        if level in by_level:
            grams.learn(by_level[level])
        levels.append(grams)
    return words, levels


def _ask_grams(docs: pa.Table, answers: pa.Table, level: int, parts: int, heavy: float) -> pa.Table:
    if not docs.num_rows:
        return _ASK_GRAMS.empty_table()
    block = _Block(docs["text"], docs["held_out"])
    return _levels(block, answers.to_pylist(), level, parts, heavy)[1][-1].ask(docs["block"][0].as_py())


def _score(docs: pa.Table, answers: pa.Table, order: int, parts: int, heavy: float) -> pa.Table:
    schema = pa.schema([("doc_id", docs.schema.field("doc_id").type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64())])
    if not docs.num_rows:
        return schema.empty_table()
    block = _Block(docs["text"], docs["held_out"])
    words, levels = _levels(block, answers.to_pylist(), order, parts, heavy)
    model = words.model
    base = np.log10((words.count + 1) / (model.n + model.v + 1))
    add = lambda x: np.add.reduceat(x, block.starts)
    return pa.table([
        docs["doc_id"], docs["held_out"], pa.array(block.sizes),
        pa.array(add((words.count[block.tokens] > 0).astype(np.int64))), pa.array(np.full(docs.num_rows, model.n)),
        pa.array(add(base[block.tokens])), pa.array(add(np.log10(levels[-1].probability())))], schema=schema)


def score_documents(docs: DataFrame, held_out: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES,
                    part_bytes: int = PART_BYTES, heavy: float = HEAVY) -> DataFrame:
    """Learns n-grams of up to ``order`` words from the rows where ``held_out`` is false and
    scores all: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one single words), ``score`` (this model), both log10."""
    if order < 1:
        raise ValueError("order must be at least 1")
    size = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    blocks, parts = max(1, -(-size // block_bytes)), max(1, -(-size // part_bytes))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    dealt = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"), block.alias("block"))
    by_block = dealt.repartition("block")
    id_type = docs.schema["doc_id"].dataType

    asked = by_block.groupBy("block").applyInArrow(lambda t: _ask_words(t, parts), ddl(_ASK_WORDS))
    answers = asked.groupBy("part").applyInArrow(_answer_words, ddl(_ANSWERS)).repartition("block")
    def ask(level: int):
        return lambda docs, answers: _ask_grams(docs, answers, level, parts, heavy)

    def answer(level: int):
        return lambda table: _answer_grams(table, level, numbered=level < order)

    for level in range(2, order + 1):
        asked = by_block.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(ask(level), ddl(_ASK_GRAMS))
        told = asked.groupBy("part").applyInArrow(answer(level), ddl(_ANSWERS)).repartition("block")
        answers = answers.union(told)
    return by_block.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda d, a: _score(d, a, order, parts, heavy),
        f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")


def held_out(doc_id: Column, of: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest`` when divided by ``of``; a null id isn't held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of)) == rest, F.lit(False))
