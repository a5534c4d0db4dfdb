"""Benchmark decontamination by winnowing (DataFrame functions only).

Both sides are cut into words, every run of ``K`` words is hashed, and of
every ``W`` consecutive hashes the least is kept (the leftmost of equal ones)
as a fingerprint. ``K + W - 1 = WINDOW``, so two equal spans of ``WINDOW``
words keep the same fingerprint at the same place: joining the fingerprints
misses none. A joined pair is then extended by comparing the hashes of the
words around it, and counts only if the common run reaches ``WINDOW`` words.

Items of fewer than ``WINDOW`` words are one window of all their words. For
those, ``W`` is 1 and ``K`` the item's own length; the lengths that occur
(nine at most) are read from the benchmark first.

Cases: null or empty text has no words, so no hits; items without words are
no windows; a null ``item_id`` marks the words it hits but is no item of
the list; repeated rows and repeated ids are rows of their own on the document
side and one item on the benchmark side; empty tables give zero hits or no
rows; other columns are kept out of the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltarecon.llm.common import let, lower_ascii, run_lengths, words
from deltarecon.session import materialize

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
K = 4
W = WINDOW - K + 1
REACH = WINDOW - K
# Fingerprint rows of the benchmark up to which it is sent to every executor
# (about 250 bytes each); beyond that the join is a shuffle join.
BROADCAST_ROWS = 200_000
# Size of the bit map of benchmark fingerprints that documents are tested against
# before the join: a larger benchmark sets more bits and lets more through.
MAP_BITS = 17
_SALTS = 1024
_POS_BITS = 31
_ENTRIES = "array<struct<gram:bigint,kind:int,pos:int,context:array<bigint>>>"


def _words(text: Column) -> Column:
    return words(lower_ascii(text), BETWEEN_WORDS)


def _grams(ws: Column, k: int) -> Column:
    """For each run of ``k`` words 32 bits of its hash, then its position."""

    def gram(w: Column, i: Column) -> Column:
        h = F.shiftrightunsigned(F.xxhash64(w, *[ws[i + d] for d in range(1, k)]), 32)
        return F.shiftleft(h, _POS_BITS).bitwiseOR(i.cast("long"))

    return F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - (k - 1), F.lit(0))), gram)


def _pos(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << _POS_BITS) - 1)).cast("int")


def _entry(kind: int, packed: Column, context: Column) -> Column:
    return F.struct(F.shiftright(packed, _POS_BITS).alias("gram"), F.lit(kind).alias("kind"),
                    _pos(packed).alias("pos"), context.alias("context"))


def _in_map(bits: Column, packed: Column) -> Column:
    gram = F.shiftright(packed, _POS_BITS)
    at = gram.bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    word = bits[F.shiftright(at, 6).cast("int")]
    return F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1


def _winnowed(ws: Column, bits: Column | None = None) -> Column:
    """The kept fingerprints of one text, each with the word hashes around it.

    With ``bits``, only those whose bit is set: the map is tested first, so
    that most positions need no window.
    """

    def around(p: Column) -> Column:
        return F.transform(F.sequence(p - REACH, p + (WINDOW - 1)), lambda i: F.when(
            (i >= 0) & (i < F.size(ws)), F.xxhash64(ws[F.greatest(i, F.lit(0))])))

    def keep(grams: Column) -> Column:
        def least(x: Column) -> Column:
            starts = F.sequence(F.greatest(_pos(x) - (W - 1), F.lit(0)),
                                F.least(_pos(x), F.size(grams) - W))
            return F.exists(starts, lambda s: F.array_min(F.slice(grams, s + 1, W)) == x)

        tested = grams if bits is None else F.filter(grams, lambda x: _in_map(bits, x))
        return F.transform(F.filter(tested, least), lambda x: _entry(0, x, around(_pos(x))))

    return F.when(F.size(ws) >= WINDOW, let(_grams(ws, K), keep)).otherwise(F.array().cast(_ENTRIES))


def _whole_grams(ws: Column, k: int) -> Column:
    """All runs of ``k`` words, for items of just ``k`` words."""
    return F.transform(_grams(ws, k), lambda x: _entry(
        k, x, F.transform(F.slice(ws, _pos(x) + 1, k), lambda w: F.xxhash64(w))))


def _item_side(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").alias("item"), _words(F.col("text")).alias("ws"))
    short = [F.when(F.size("ws") == k, _whole_grams(F.col("ws"), k)) for k in range(1, WINDOW)]
    entries = F.coalesce(*short, _winnowed(F.col("ws")))
    return items.select("item", F.explode(entries).alias("f")).select("item", "f.*").distinct()


def _bit_map(items: DataFrame) -> Column:
    """The set fingerprints as an array of longs (16 KB, whatever the benchmark)."""
    at = F.col("gram").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rows = items.filter("kind = 0").groupBy(F.shiftright(at, 6).cast("int").alias("i")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((gram & {(1 << MAP_BITS) - 1}) & 63 as int))")).alias("bits")).collect()
    filled = [0] * (1 << (MAP_BITS - 6))
    for r in rows:
        filled[r["i"]] = r["bits"]
    return F.lit(filled).cast("array<bigint>")


def _run_left(doc: Column, item: Column) -> Column:
    """Equal words before the fingerprint, none beyond the reach."""
    out = F.lit(REACH)
    for i in range(0, REACH):  # the outermost mismatch is overruled by those nearer
        out = F.when(F.coalesce(F.get(doc, F.lit(i)) == F.get(item, F.lit(i)), F.lit(False)), out).otherwise(F.lit(REACH - 1 - i))
    return out


def _run_right(doc: Column, item: Column) -> Column:
    out = F.lit(REACH)
    for i in reversed(range(0, REACH)):
        at = WINDOW + i
        out = F.when(F.coalesce(F.get(doc, F.lit(at)) == F.get(item, F.lit(at)), F.lit(False)), out).otherwise(F.lit(i))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash`` (of the raw text, to
    tell rows of one id apart), ``n_words``, ``n_hit``, ``items`` (ids whose
    windows occur) and ``spans`` (half-open word ranges that are hit)."""
    items = materialize(_item_side(benchmark), "benchmark-fingerprints")
    seen = {r["kind"]: r["n"] for r in items.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    bits = _bit_map(items)

    # A row without a fingerprint keeps documents that hit nothing; its keys are
    # spread so that they never gather in one task.
    nothing = F.struct((-1 - F.pmod(F.col("row"), F.lit(_SALTS))).alias("gram"), F.lit(-1).alias("kind"),
                       F.lit(0).alias("pos"), F.lit(None).cast("array<bigint>").alias("context"))
    spark = docs.sparkSession
    anchors = spark.range(_SALTS).select(
        F.lit(None).cast(items.schema["item"].dataType).alias("item"), (-1 - F.col("id")).alias("gram"),
        F.lit(-1).alias("kind"), F.lit(0).alias("pos"), F.lit(None).cast("array<bigint>").alias("context"))
    right = items.unionByName(anchors).select(
        F.col("item"), F.col("gram"), F.col("kind"), F.col("context").alias("item_context"))

    base = docs.select(F.col("doc_id"), F.xxhash64(F.col("text")).alias("text_hash"),
                       F.monotonically_increasing_id().alias("row"), _words(F.col("text")).alias("ws"))

    def entries(ws: Column) -> Column:
        parts = [_winnowed(ws, bits)] + [_whole_grams(ws, k) for k in range(1, WINDOW) if k in seen]
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    left = base.select("doc_id", "text_hash", "row", F.size("ws").cast("long").alias("n_words"),
                       F.explode(F.concat(F.array(nothing), let(F.col("ws"), entries))).alias("f"))
    left = left.select("doc_id", "text_hash", "row", "n_words", "f.*")
    if sum(seen.values()) <= BROADCAST_ROWS:
        right = F.broadcast(right)
    joined = left.join(right, ["gram", "kind"])

    before = _run_left(F.col("context"), F.col("item_context"))
    after = _run_right(F.col("context"), F.col("item_context"))
    whole = (F.col("kind") > 0) & (F.col("context") == F.col("item_context"))
    start = F.when(F.col("kind") == 0, F.col("pos") - F.col("before")).otherwise(F.col("pos"))
    end = F.when(F.col("kind") == 0, F.col("pos") + K + F.col("after")).otherwise(F.col("pos") + F.col("kind"))
    long_run = (F.col("kind") == 0) & (F.col("before") + F.col("after") + K >= WINDOW)
    hits = joined.withColumns({"before": before, "after": after}).select(
        "row", "doc_id", "text_hash", "n_words", "item",
        F.when(whole | long_run, F.struct(start.alias("s"), end.alias("e"))).alias("span"))
    found = hits.groupBy("row", "doc_id", "text_hash", "n_words").agg(
        F.collect_set("span").alias("spans"),
        F.collect_set(F.when(F.col("span").isNotNull(), F.col("item").cast("string"))).alias("items"))
    return found.select("doc_id", "text_hash", "n_words", run_lengths(F.col("spans")).alias("n_hit"),
                        F.array_sort("items").alias("items"), F.array_sort("spans").alias("spans"))


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns per document."""
    found = find_contamination(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text has a benchmark window; all columns kept."""
    bad = find_contamination(docs, benchmark).filter("n_hit > 0").select(
        F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(bad["__bad_id"]) & (F.xxhash64(docs["text"]) == bad["__bad_hash"])
    return docs.join(bad, same, "left_anti")
