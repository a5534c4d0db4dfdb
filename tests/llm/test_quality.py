"""Line-first quality rules against a plain Python version."""

import re

from deltarecon.llm import quality as q


def prose(n):
    """Lines without a repeated three-word window."""
    return "\n".join(" ".join(f"word{i}{c}" for c in "abcdefgh") + "." for i in range(n))



def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(ws) - 2):
        seen.setdefault(tuple(ws[i:i + 3]), []).append(i)
    rep = len({p + d for at in seen.values() if len(at) > 1 for p in at for d in range(3)})
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), rep,
            len(ws) < 50 or 100 * rep > 50 * len(ws))


def got(df):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return [tuple(r[c] for c in cols) for r in q.quality_report(df).orderBy("doc_id").collect()]


def test_whole_small_table(make_docs, docs_small):
    assert got(make_docs(docs_small)) == [brute(t) for _, t in docs_small]


def test_edge_texts(make_docs):
    texts = [None, "", " \t\n", "a b c a b c", "a a a a", "x", "l\nl\nl", "a\x0bb\x0cc\rd", "é ü € 𝒳 𝒳",
             " ".join(f"w{i % 70_001}" for i in range(200_000)), "$$$ ### <b>|"]
    rows = list(enumerate(texts)) + [(50, "same text."), (50, "same text.")]
    assert got(make_docs(rows)) == [brute(t) for _, t in rows]
    assert q.quality_report(make_docs([(None, None)])).collect()[0]["kept"] is False


def test_empty_table_and_clashing_columns(make_docs, spark):
    assert got(make_docs([])) == []
    text = prose(30)
    df = spark.createDataFrame([(1, text, 7, 2)], "doc_id long, text string, quality int, n_chars int")
    assert [tuple(r) for r in q.clean(df).collect()] == [(1, text, 7, len(text))]


def test_lines_go_then_documents(make_docs):
    good = prose(20)
    nav = "\n".join(f"home{i} | news{i} | about{i} | terms{i}" for i in range(60))
    rows = [(1, good + "\nHome\nAll rights reserved."), (2, nav + "\n" + good[:120]), (3, good)]
    kept = {r["doc_id"]: r["text"] for r in q.clean(make_docs(rows)).collect()}
    assert kept == {1: good, 3: good}


def test_filter_stays_above_the_measures(make_docs):
    """The verdict's filter must not pull the expressions behind it into itself."""
    from tests.conftest import plan_text

    long = "\n".join(" ".join(f"w{i}x{j}" for j in range(20)) + "." for i in range(2000))
    df = q.clean(make_docs([(1, long)]))
    line = next(x for x in plan_text(df).splitlines() if x.startswith("Condition"))
    assert "kept" in line and "split" not in line and "regexp" not in line.lower()
    assert df.count() == 1
