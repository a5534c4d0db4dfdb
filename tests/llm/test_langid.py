"""Language identification: held-out accuracy and edge cases."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from deltarecon.llm import katz, langid

from tests.conftest import SF_CHECK

SAID = {"en": "the cat and the dog went over the hill with a thing that was there",
        "de": "der hund und die katze gingen über den hügel mit einem ding das dort war"}


def test_held_out_accuracy(make_docs):
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF_CHECK}/documents.parquet' ORDER BY doc_id LIMIT 500").fetchall()
    want = {r[0]: r[2] for r in rows}
    got = langid.language_report(make_docs(rows), katz.held_out(F.col("doc_id"), 4, 2)).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(rows) and len(held) > 80
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nulls_letterless_and_repeats(make_docs):
    rows = [(i, t, k, None) for i, (k, t) in enumerate(SAID.items())]
    rows += [(10, None, "en", None), (11, "", "en", None), (12, "123 !? 45", "de", None), (None, SAID["de"], None, None),
             (13, "The hill", None, None), (13, "The hill", None, None), (14, "x", None, None), (15, "über " * 500_000, None, None)]
    got = {}
    for r in langid.language_report(make_docs(rows), F.lit(False)).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], round(r["score"], 6)))
    assert got[10] == got[11] == got[12] == [("und", 0.0)]
    assert got[None][0][0] == "de" and got[0][0][0] == "en" and got[15][0][0] == "de"
    assert len(got[13]) == 2 and len(set(got[13])) == 1 and got[13][0][0] == "en"


def test_nothing_learned_and_empty_table(make_docs):
    r = langid.language_report(make_docs([(1, "some text", None, None)]), F.lit(False)).collect()[0]
    assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert langid.language_report(make_docs([]), F.lit(False)).collect() == []


def test_pieces_and_dropped_vectors_change_nothing(monkeypatch):
    text = " ".join(f"{w}{i}" for i in range(400) for w in SAID["de"].split())
    whole = langid.Encoder().bundle(text)
    monkeypatch.setattr(langid, "MAX_GRAMS", 30)
    assert np.array_equal(whole, langid.Encoder().bundle(text))
    a, b = langid.Encoder(), langid.Encoder()
    assert np.array_equal(a.gram(12345), b.gram(12345))
    # Vectors of different n-grams are nearly orthogonal.
    x, y = a.gram((ord("a") << 42) | (ord("b") << 21) | ord("c")), a.gram((ord("c") << 42) | (ord("b") << 21) | ord("a"))
    assert abs(float(x @ y)) / langid.DIMS < 0.15


def test_cuts_between_pieces_change_nothing(monkeypatch):
    import random
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcé  ..1\n") for _ in range(n)) for n in [1, 2, 3, 7, 50, 200] * 5] + ["", "  ", "x", " x", "x ", "..."]
    whole = [langid.Encoder().grams(t) for t in texts]
    for piece in (1, 2, 3, 10, 49):
        monkeypatch.setattr(langid, "PIECE", piece)
        for t, (keys, counts) in zip(texts, whole):
            got = langid.Encoder().grams(t)
            assert got[0].tolist() == keys.tolist() and got[1].tolist() == counts.tolist(), (piece, t)


def test_profiles_against_plain_dictionaries(make_docs):
    """Prototypes, cosines and predictions from n-gram dictionaries, one vector at a time."""
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF_CHECK}/documents.parquet' ORDER BY doc_id LIMIT 60").fetchall()

    def bundle(texts):
        out = np.zeros(langid.DIMS)
        for t in texts:
            said = "".join(c if c.isalpha() else "_" for c in t.lower())
            while "__" in said:
                said = said.replace("__", "_")
            said = "_" + said + "_"
            for i in range(len(said) - 2) if any(c.isalpha() for c in said) else ():
                key = sum(ord(c) << 21 * (2 - j) for j, c in enumerate(said[i:i + 3]))
                if key not in known:
                    known[key] = langid.Encoder().gram(key)
                out += known[key]
        return out

    known = {}
    train = [(r[1], r[2]) for r in rows if r[0] % 4]
    protos = {k: bundle([t for t, x in train if x == k and t]) for k in sorted({x for _, x in train if x})}
    marked = make_docs(rows).withColumn("held_out", F.col("doc_id") % 4 == 0)
    got = {r["doc_id"]: r for r in langid.identify(marked, marked.filter("not held_out")).collect()}
    for i, text, *_ in rows:
        v = bundle([text or ""])
        cosines = {k: v @ p / (np.linalg.norm(v) * np.linalg.norm(p)) for k, p in protos.items()} if v.any() else {"und": 0.0}
        best = max(cosines, key=lambda k: (cosines[k], k))
        assert got[i]["lang_pred"] == best and abs(got[i]["score"] - max(0.0, cosines[best])) < 1e-5
