"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import xxhash

from deltarecon.llm import simhash


def brute_print(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Root index of each distinct fingerprint by repeated merging."""
    at = {p: p for p in prints}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    ps = sorted(at)
    for i, a in enumerate(ps):
        for b in ps[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                ra, rb = root(a), root(b)
                at[max(ra, rb)] = min(ra, rb)
    return {p: root(p) for p in ps}


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    return sorted(((i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(rows, prints)), key=str)


def got(df):
    return sorted(map(tuple, simhash.near_duplicate_report(df).collect()), key=str)


def test_whole_small_table(make_docs, docs_small):
    assert got(make_docs(docs_small)) == brute(docs_small)


def test_nulls_ties_repeats_and_long(make_docs):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (4, "A B"),
            (5, "a b"), (9, long), (8, long + " end"), (None, "only null id here"), (6, "É é   x y")]
    assert got(make_docs(rows)) == brute(rows)
    kept = simhash.keep_first(make_docs(rows)).collect()
    assert len(kept) == len({c for _, _, c in brute(rows)})


def test_empty_table(make_docs):
    assert got(make_docs([])) == []
    assert simhash.keep_first(make_docs([])).count() == 0


def test_clashing_columns(spark):
    rows = [(1, "a b c", "x", 5), (2, "a b c", "y", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, row_nr int")
    assert [tuple(r) for r in simhash.keep_first(df).collect()] == [rows[0]]


def planted(rng, groups, per_group):
    out = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(per_group):
            base ^= 1 << rng.randrange(64)
            if rng.random() < 0.6:
                base ^= 1 << rng.randrange(64)
            out.add(base)
    return out


def test_links_find_every_component(spark):
    rng = random.Random(5)
    prints = planted(rng, 40, 40) | {rng.getrandbits(64) for _ in range(500)}
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    from deltarecon.llm.components import connected_components
    comp = {r["node"] % 2**64: r["root"] % 2**64 for r in connected_components(simhash.fingerprint_links(df)).collect()}
    want = brute_components(prints)
    groups = {}
    for p, r in want.items():
        groups.setdefault(r, set()).add(p)
    mine = {}
    for p in prints:
        mine.setdefault(comp.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_dense_run_is_cut_and_stays_whole(monkeypatch):
    """Runs over the threshold give the same components as the plain forest."""
    rng = random.Random(3)
    base, i, j = rng.getrandbits(64), 1, 2
    values = {base}
    at = list(values)
    while len(values) < 600:  # walk on the 23 bits that a run's key leaves open
        x = rng.choice(at)
        key = [k[0] for k in (simhash.chain_keys(np.array([x], np.uint64))[i * 5 + j],)]
        y = x ^ 1 << rng.randrange(64)
        if simhash.chain_keys(np.array([y], np.uint64))[i * 5 + j][0] == key[0] and y not in values:
            values.add(y)
            at.append(y)
    arr = np.array(sorted(values), np.uint64)
    monkeypatch.setattr(simhash, "DENSE_RUN", 50)
    pairs = [(int(a), int(b)) for x, y in simhash._run_links(arr, i * 5 + j) for a, b in zip(x, y)]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    root = {v: v for v in map(int, values)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    mine = {}
    for v in root:
        mine.setdefault(find(v), set()).add(v)
    want = {}
    for v, r in brute_components(map(int, values)).items():
        want.setdefault(r, set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))
