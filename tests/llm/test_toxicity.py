"""Deobfuscation by exhaustive search, held-out accuracy and edge cases."""

import itertools
import math
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from deltarecon.llm import katz, toxicity as tox

from tests.conftest import SF_CHECK

WORDS = "the idiot trash stupid loser moron scum clown and this is that other thing house tree".split()


@pytest.fixture(scope="module")
def model(spark):
    df = spark.createDataFrame([(" ".join(WORDS * 40),)], "text string")
    return tox.character_model(df)


def exhaustive(model, chars):
    """Every path through the lattice, by its cost."""
    r = tox.Restorer(model)
    letters = [i for i, c in enumerate(chars) if c.isalpha()] or [0]
    choices = []
    for i, c in enumerate(chars):
        inside = letters[0] < i < letters[-1]
        drop = tox.COST_DROP if c not in tox.LEET else tox.COST_DROP_INSIDE if inside else tox.COST_DROP_EDGE
        own = [("put", c, 0.0), ("rep", c, tox.COST_REPEAT)] if c.isalpha() else [
            (k, x, tox.COST_LEET + (tox.COST_REPEAT if k == "rep" else 0)) for x in tox.LEET.get(c, "") for k in ("put", "rep")]
        choices.append(own + ([] if c.isalpha() else [("drop", "", drop)]))
    best = (math.inf, "")
    for path in itertools.product(*choices):
        read, cost, ok = "", 0.0, True
        for kind, letter, extra in path:
            cost += extra
            if kind == "rep":
                ok &= read.endswith(letter) and bool(read)
            elif kind == "put":
                read += letter
        if ok:
            s = tox.EDGE * 2 + tox._classes(read)
            cost -= sum(r._step(s[i:i + 2], c) for i, c in enumerate(s[2:] + tox.EDGE))
            best = min(best, (cost, read))
    return best[1]


def test_viterbi_is_exhaustive_search(model):
    r = tox.Restorer(model)
    for w in ["1di0t", "l0$er", "i.d.i.o.t", "mooron", "$cum!!", "cl0wnn", "tr4sh|", "é!1a", "a@4", "the+", "0", "st!!pid"]:
        assert r.decode(w) == exhaustive(model, w), w


def test_disguised_words_are_restored(model):
    restored = tox._Restored(model)
    said = "tr@sh STUP1D m.o.r.o.n idiooooot l o s e r cl0wn### plain 2024 --"
    found = tox.restored_words(said, restored)
    assert {"trash", "stupid", "moron", "idiot", "loser", "clown", "plain"} <= found
    assert "" not in found and "2024" not in found


def test_doubled_letters_are_read_as_by_the_lattice(model):
    r = tox.Restorer(model)
    for w in ["mooron", "iddiott", "sttuupidd", "tree", "éé", "aabbccdd", "loosser", "a", "aa"]:
        assert r._unrepeated(w) == r.decode(w) == exhaustive(model, w), w


def test_doubled_letters_and_marks_at_the_edges(model):
    restored = tox._Restored(model)
    for said, want in {"stuupid": "stupid", "iddiot!": "idiot", "mooron": "moron", "$tupid!!": "stupid", "$cum!": "scum",
                       "(lown": "clown", "1di0+": "idiot", "£oser": "loser", "¡diot": "idiot", "tra§h": "trash", "|d!0+": "idiot"}.items():
        assert want in tox.restored_words(said, restored), said
    # Doubled letters that may be meant stay a reading, and clean words are themselves.
    assert {"ass"} <= tox.restored_words("a$$", restored) and {"ass"} <= tox.restored_words("@$$", restored)
    assert "asshole" in tox.restored_words("@$$hole", restored)
    for w in ["tree", "moor", "(house)", "this!", "\"that\""]:
        assert w.strip("()!\"") in tox.restored_words(w, restored), w
    assert tox.restored_words("1990 $100 (+49) 50! !!! $$$ -- 12:30", restored) == set()


def test_long_words_are_not_cut(model):
    r = tox.Restorer(model)
    assert r.decode("stupid" * 30) == "stupid" * 30 and r.decode("tr@sh" * 30) == "trash" * 30


def test_spaced_runs_hold_words(spark):
    said = "you are a loser shut up and you idiot fool ass of the house".split()
    model = tox.character_model(spark.createDataFrame([(" ".join(said * 40),)], "text string"))
    restored = tox._Restored(model)
    for text, want in {"you are a l o s e r": "a loser", "oh Y O U I D I 0 T yes": "you idiot", "s h u t u p": "shut up", "a s s": "ass",
                       "a\n$  $ !": "ass", "f o o l": "fool"}.items():
        assert set(want.split()) <= tox.restored_words(text, restored), text
    # Longer than SPAN and MAX_OPEN: no word is cut.
    long = ["the", "idiot", "and", "you", "loser"] * 400
    assert restored.restorer.decode("".join(long), ends=True).split() == long
    assert tox.restored_words(" ".join("".join(long)), restored) >= set(long)
    assert tox.restored_readings("1 2 3 4 - - - x", restored) >= {("x",)} and restored.spaced("1234") == ()


def test_spaced_reading_counts_its_words():
    gains = {"idiot": 3.0, "loser": 2.5}
    assert tox.total_gain({("you idiot loser", "youidiotloser"), ("idiot",)}, gains) == 5.5


def test_best_reading_counts_once():
    gains = {"stupid": 3.0, "ass": 2.5}
    assert tox.total_gain({("stuupid", "stupid"), ("stupid",), ("ass", "as"), ("tree",)}, gains) == 5.5


def test_held_out_accuracy_and_planted_disguises(make_docs, spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_CHECK}/documents.parquet' ORDER BY doc_id").fetchall()
    flags = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_CHECK}/labels.parquet'").fetchall())
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    rows += [(100_000 + i, f"some ordinary text and you {w} that is all of it")
             for i, w in enumerate(["id1ot tr@sh", "st.u.p.i.d l0$er", "c l o w n m0r0n"])]
    labels = spark.createDataFrame(list(flags.items()) + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = tox.toxicity_report(make_docs(rows), labels, katz.held_out(F.col("doc_id"), 3, 1)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["held_out"] and r["doc_id"] < 100_000} == held
    clean = [r["predicted"] for r in got if r["doc_id"] in held and flags.get(r["doc_id"]) == 0]
    toxic = [r["predicted"] for r in got if r["doc_id"] in held and flags.get(r["doc_id"]) == 1]
    assert sum(clean) <= 0.02 * len(clean) and sum(toxic) >= 0.7 * len(toxic)
    assert all(r["predicted"] == 1 for r in got if r["doc_id"] >= 100_000)


def test_judge_against_plain_counts(make_docs, spark):
    """Model, features, gains and scores over a small table, by other means."""
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_CHECK}/documents.parquet' ORDER BY doc_id LIMIT 300").fetchall()
    rows += [(1000 + i, f"you st.u.p.i.d id1ot number {i} y o u f o o l") for i in range(12)] + [(2000, None), (2001, None)]
    flags = {i: int(i >= 1000 or i % 40 == 0) for i, t in rows if i % 2 == 0}
    docs = make_docs(rows)
    model = tox.character_model(docs)
    grams = {}
    for _, t in rows:
        for w in (t or "").lower().split():
            w = tox._EDGES.sub("", w)
            if tox._PLAIN.fullmatch(w):
                s = "^^" + tox._classes(w) + "^"
                for i in range(len(s) - 2):
                    grams[s[i:i + 3]] = grams.get(s[i:i + 3], 0) + 1
    context = {}
    for g, n in grams.items():
        context[g[:2]] = context.get(g[:2], 0) + n
    assert model == {**{c: math.log(0.1 / (n + 2.8)) for c, n in context.items()},
                     **{g: math.log((n + 0.1) / (context[g[:2]] + 2.8)) for g, n in grams.items()}}

    labels = spark.createDataFrame(list(flags.items()), "doc_id long, toxic int")
    base, gains = tox.learn(docs.select("doc_id", "text"), tox.training_rows(labels, F.lit(True)), model)
    texts = {}
    for i, t in rows:
        if i in flags and t is not None:
            texts[t] = max(texts.get(t, 0), flags[i])
    seen = {}
    for t, flag in texts.items():
        for f in tox._features(tox.restored_words(t, tox._Restored(model))):
            n, k = seen.get(f, (0, 0))
            seen[f] = n + 1, k + flag
    p0 = (sum(texts.values()) + 0.5) / (len(texts) + 1)
    logit = lambda p: math.log(p / (1 - p))
    want = {f: logit((k + 6 * p0) / (n + 6)) - logit(p0) for f, (n, k) in seen.items() if k >= 4}
    want = {f: g for f, g in want.items() if g >= 2}
    assert base == pytest.approx(logit(p0)) and gains == pytest.approx(want) and "fool" in gains

    scored = {(r["doc_id"], round(r["score"], 12)) for r in tox.score(docs, model, base, gains).collect()}
    odds = {(i, base + tox.total_gain(tox.restored_readings(t, tox._Restored(model)), gains)) for i, t in rows}
    assert scored == {(i, round(1 / (1 + math.exp(-o)), 12)) for i, o in odds}


def test_open_letters_of_any_length_are_decoded(model):
    """Nothing settles in a long row of signs that may be one of two letters."""
    r = tox.Restorer(model)
    assert len(r.decode("1" * 5_000, literal=True)) == 5_000
    assert r.decode("x1" * 3_000 + "idiot", literal=True).endswith("idiot")


def test_edges(make_docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = [(1, None), (2, ""), (2, ""), (None, "x y z w v"), (3, "!" * 200_000), (4, "a1" * 100_000)]
    got = tox.toxicity_report(make_docs(rows), none, F.lit(False)).collect()
    assert len(got) == 6 and {r["score"] for r in got} == {0.5}
    assert tox.toxicity_report(make_docs([]), none, F.lit(False)).collect() == []
