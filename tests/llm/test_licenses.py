"""Licence scan against the SQL version and hand-made texts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from deltarecon.llm import licenses
from deltarecon.llm.oracles import ORACLES

COLS = ["doc_id", "n_units", "n_matched", "licenses", "best_dice", "best_license"]
MIT = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500)


def texts():
    long = "\n".join(f"filler line {i} of a long text" for i in range(3000))
    return [None, "", " ", "x", "MIT License", "Released under the MIT License.", "released UNDER the mit license",
            "Some words. Released under the MIT License. More words.", MIT, MIT.replace(" ", "\n\n ", 5),
            "Copyright 2001 Somebody\n\n" + MIT + "\n\nThe end.", MIT.upper()[:-40], MIT[:300],
            "Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-SA 4.0.", long,
            long + "\nLicensed under the Apache License, Version 2.0.", "a b " * 50_000]


PARTS = MIT.replace(": The above", ":\n\nThe above").replace(". THE SOFTWARE", ".\n\nTHE SOFTWARE")
APACHE = next(t for n, t in licenses.TEMPLATES if n == "Apache-2.0" and 300 < len(t) < 1000)
APACHE = APACHE.replace(" You may obtain", "\n   You may obtain").replace("LICENSE-2.0 ", "LICENSE-2.0\n\n   ").replace("implied. ", "implied.\n")
STATEMENT = "This work is licensed under a Creative Commons\nAttribution 4.0 International License."


def inside():
    """Licences in several paragraphs or lines, inside longer texts."""
    prose = "\n".join(f"Line {i} of the text around it, in which nothing is said. It goes on." for i in range(40))
    return {
        "MIT": [f"{prose}\n\n{PARTS}\n\n{prose}", f"Readme\n\nCopyright (c) 2001 A\n\n{PARTS}\n\nThanks. {prose}",
                f"{prose}\n{MIT.replace('. ', '.' + chr(10))}", f"{PARTS}\n\n{PARTS}\n\n{prose}",
                f"{prose} {PARTS.replace('. ', '.' + chr(10) + 'As is said in 2001.' + chr(10), 1)} {prose}"],
        "Apache-2.0": [f"{prose}\n\n   {APACHE}\n\n{prose}", f"# {APACHE.replace(chr(10), chr(10) + '# ')}\n\n{prose}"],
        "CC-BY-4.0": [f"{prose}\n{STATEMENT}\n{prose}", f"Some words before it. {STATEMENT} Some words after it. {prose}"],
        "": [prose, f"{prose}\n{PARTS[:250]}\n{prose}", f"{prose}\n\nThis work is licensed\n{prose}"],
    }


def test_licences_over_several_paragraphs_or_lines(make_docs):
    rows = [(i, t) for i, t in enumerate(t for ts in inside().values() for t in ts)]
    want = [name for name, ts in inside().items() for _ in ts]
    found = {r["doc_id"]: r["best_license"] or "" for r in licenses.license_scan(make_docs(rows)).collect()}
    assert [found[i] for i, _ in rows] == want  # others of nearly the same words may be named besides


def test_texts_that_match_hold_rare_bigrams():
    """Whatever a match lacks, one of the rare bigrams is left."""
    for (_, text), rare in zip(licenses.TEMPLATES, licenses.rare_bigrams()):
        pairs = licenses.template_bigrams(text)
        # The least a match shares: with a part as small as the bound allows, all of it shared.
        least = -(-len(pairs) * licenses.MIN_PERCENT // licenses.WIDE)
        assert rare <= pairs and len(rare) > len(pairs) - least


def test_texts_match_sql(make_docs):
    full = [f"Before.\n\n{t}\n\nAfter it." for t in licenses.TEXTS.values()]
    rows = [(i if i != 3 else None, t) for i, t in enumerate([*texts(), *(t for ts in inside().values() for t in ts), *full])]
    rows += [(4, "MIT License")]
    df = make_docs(rows)
    documents = df.toPandas()
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(con.execute(f"SELECT {', '.join(COLS)} FROM ({ORACLES['op2_license_scan']})").fetchall(), key=str)
    got = sorted((tuple(r) for r in licenses.license_scan(df).select(*COLS).collect()), key=str)
    assert [g[:4] + g[5:] for g in got] == [w[:4] + w[5:] for w in want]
    for g, w in zip(got, want):
        assert g[4] == pytest.approx(w[4]) if w[4] is not None else g[4] is None


def test_finds_what_it_should(make_docs):
    found = {r["doc_id"]: r["licenses"] for r in licenses.license_scan(make_docs(list(enumerate(texts())))).collect()}
    assert found[5] == found[6] == found[7] == found[8] == found[10] == found[11] == "MIT"
    assert found[12] == found[0] == found[1] == found[15] == ""
    assert found[13] == "CC-BY-4.0" and found[14] == "CC-BY-NC-4.0,CC-BY-SA-4.0" and found[16] == "Apache-2.0"


def test_usual_forms_and_full_texts(make_docs):
    said = {"Licensed under the MIT License.": "MIT", "Licensed under the ISC License.": "ISC",
            "This project is licensed under the BSD 2-Clause License.": "BSD-2-Clause",
            "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0", "Released under the zlib License.": "Zlib"}
    said |= {"Copyright 2001 Somebody\n\n" + text: name for name, text in licenses.TEXTS.items()}
    said |= {text: name for name, text in licenses._NOTICES}
    texts = list(said)
    found = {r["doc_id"]: r for r in licenses.license_scan(make_docs(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        assert found[i]["best_license"] == said[text] and said[text] in found[i]["licenses"].split(","), (i, text[:80], found[i])


def test_pair_hash_is_the_sessions(spark):  # noqa: F811
    got = spark.range(1).select(F.xxhash64(F.lit("mit"), F.lit("license"))).first()[0]
    assert got == licenses._pair_hash("mit", "license")


def test_empty_table(make_docs):
    assert licenses.license_scan(make_docs([])).collect() == []
