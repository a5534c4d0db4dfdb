"""Periodic runs against a search of every period and place."""

import hashlib
import random

import numpy as np
import pytest

from deltarecon.llm import periodic


def brute(ids, min_words=24, min_periods=3):
    n, runs = len(ids), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i < n - q:
            if ids[i] != ids[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and ids[j] == ids[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_words, min_periods * q):
                part = ids[i:i + length]
                if all(any(part[t] != part[t + d] for t in range(length - d)) for d in range(1, q)):
                    runs.append((i, length, q))
            i = j
    return sorted(runs, key=lambda r: (r[0], r[2]))


def cases(seed):
    r = random.Random(seed)
    for _ in range(120):
        letters = r.choice([1, 2, 2, 3, 30])
        out = []
        while len(out) < r.randint(0, 260):
            unit = [r.randrange(letters) for _ in range(r.randint(1, 40))]
            if r.random() < 0.4:  # a unit that repeats within
                unit = unit[:5] * r.randint(1, 3) + unit
            out += (unit * r.randint(1, 9))[:r.randint(1, 200)]
        yield out


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    for ids in cases(seed):
        assert periodic.find_runs(np.array(ids, np.int64)) == brute(ids), ids


@pytest.mark.parametrize("least,periods", [(1, 3), (7, 3), (24, 4), (60, 5), (100, 3)])
def test_other_bounds(least, periods):
    for ids in cases(least):
        assert periodic.find_runs(np.array(ids, np.int64), least, periods) == brute(ids, least, periods), ids


def test_two_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(30, np.int64), 24, 2)


def test_one_word_a_million_times():
    assert periodic.find_runs(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]
    ids = np.tile(np.arange(1000), 1000)
    assert periodic.find_runs(ids) == [(0, 1_000_000, 1000)]


def plain(doc_id, text):
    words = periodic.made_periodic(periodic.split_words(None if text is None else text.encode()), doc_id)
    ids = [words.index(w) for w in words]
    runs = brute(ids)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and best[1] * 1000 // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_report_against_brute_force(make_docs, docs_small):
    rows = [(i, t) for i, t in docs_small if len((t or "").split()) < 400][:60]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "x " * 30), (1003, "x " * 30), (1004, "a b c\x1cd " * 20),
             (None, "one two " * 40)]
    got = periodic.run_report(make_docs(rows)).collect()
    want = sorted((str(i), *map(str, plain(i, t))) for i, t in rows)
    assert sorted(tuple(map(str, r)) for r in got) == want
    assert any(r["n_runs"] for r in got) and any(r["doc_id"] is None for r in got)


def test_repeated_stretch_of_chosen_documents():
    words = [b"%d" % i for i in range(100)]
    changed = [i for i in range(200) if periodic.made_periodic(words, i) != words]
    assert 10 <= len(changed) <= 30
    assert periodic.made_periodic(words, None) == words and periodic.made_periodic([], changed[0]) == []


def test_texts_without_their_repeats_and_clashing_names(spark):
    rows = [(1, "say " * 40 + "end", [1], "a"), (2, None, None, "b"), (3, "", [], None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, runs array<int>, `row` string")
    got = {r["doc_id"]: r for r in periodic.with_periodic_runs(docs).collect()}
    assert got[1]["collapsed_text"] == "say end" and got[1]["runs"] == [1] and got[1]["row"] == "a"
    assert [tuple(r) for r in got[1]["runs_1"]] == [(0, 40, 1)]
    assert got[2]["collapsed_text"] is None and got[3]["collapsed_text"] == ""
    assert periodic.with_periodic_runs(docs.limit(0)).collect() == []
    assert periodic.run_report(docs.limit(0)).collect() == []
