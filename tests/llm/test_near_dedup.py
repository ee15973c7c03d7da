import random
from collections import defaultdict

import pytest

from engram.llm import near_dedup
from tests.llm.helpers import docs_frame, words


def sets(rows, size):
    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(size, len(w))
        out.append((i, frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if n else frozenset()))
    return out


def brute(rows, size, percent=80):
    s = sets(rows, size)
    up = list(range(len(s)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(s)):
        for b in range(a):
            x, y = s[a][1], s[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[top(a)] = top(b)
    groups = defaultdict(list)
    for k in range(len(s)):
        groups[top(k)].append(s[k][0])
    out = []
    for k, (i, x) in enumerate(s):
        ids = [j for j in groups[top(k)] if j is not None]
        low = (min(ids) if ids else None) if x else i
        out.append((i, len(x), low, i == low))
    return sorted(out, key=str)


def edited(r, base, n):
    w = list(base)
    for _ in range(n):
        w[r.randrange(len(w))] = words(r, 1)[0]
    return w


def rows():
    r = random.Random(3)
    out, k = [], 10
    for _ in range(25):  # groups with copies of all degrees, chains included
        base = words(r, r.randint(8, 120))
        for _ in range(r.randint(1, 5)):
            out.append((k, " ".join(edited(r, base, r.randint(0, max(1, len(base) // 7))))))
            k += 1
    star = words(r, 60)  # a hub whose copies are often unlike each other
    out.append((9999, " ".join(star)))
    for _ in range(90):
        out.append((k, " ".join(edited(r, star, 3))))
        k += 1
    out += [(k + j, " ".join(star).upper()) for j in range(40)]  # exact copies
    k += 40
    shared = words(r, 30)  # one passage in many texts that are no copies
    for _ in range(60):
        out.append((k, " ".join(shared + words(r, r.randint(10, 40)))))
        k += 1
    out += [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one"), (7, "x y"), (None, "x  Y"), (None, None), (4, "one"), (8, "x y z w")]
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(spark, size):
    data = rows()
    df = docs_frame(spark, data, extra="cls")
    out = near_dedup.near_duplicates(df, size=size)
    assert set(out.columns) == {*df.columns, "n_shingles", "component_id", "kept"} - {"cls"}
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()), key=str)
    assert got == brute(data, size)


def test_components_of_long_chains(spark):
    e = spark.createDataFrame([(bytes([0, k]), bytes([0, k + 1])) for k in range(60)] + [(b"zz", b"zy")], "e binary, o binary")
    got = {(bytes(r.cls), bytes(r.comp)) for r in near_dedup.components(e, "e", "o").collect()}
    assert got == {(bytes([0, k]), b"\0\0") for k in range(61)} | {(b"zz", b"zy"), (b"zy", b"zy")}


def test_small_tables(spark):
    assert near_dedup.near_duplicates(docs_frame(spark, [(1, "a")]).limit(0)).collect() == []
    assert [(r.component_id, r.kept) for r in near_dedup.near_duplicates(docs_frame(spark, [(3, "a b c")])).collect()] == [(3, True)]
    long = [(1, "word " * 50000 + "end"), (2, "word " * 50000 + "end")]
    assert [r.component_id for r in near_dedup.near_duplicates(docs_frame(spark, long)).collect()] == [1, 1]


def test_cells_find_every_link_of_large_regions(spark, monkeypatch):
    """With every class a component of its own, and with one large component, cells of a few
    members find all links between components of members whose first common region is
    large (pairs of small regions are all compared before)."""
    import random

    import numpy as np
    from pyspark.sql import functions as F

    from engram.llm import near_dedup as N
    from tests.llm.helpers import docs_frame, words

    monkeypatch.setattr(N, "BLOCK", 7)
    r = random.Random(6)
    base, docs = words(r, 90), []
    for i in range(70):
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(90)] = f"x{i}{r.randrange(9)}"
        docs.append((i, " ".join(w)))
    df = docs_frame(spark, docs).selectExpr("doc_id AS doc", "text")
    reps = N.signatures(df, "text", 2, ["doc"]).groupBy("cls").agg(F.min("doc").alias("doc"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    rows = N.forest(reps)
    texts = N.class_texts(df, reps, reps.select("cls"), 2)
    sets = {bytes(x.cls): (set(N.shingles(x.text, 2).tolist()), x.sig) for x in texts.collect()}
    keys = sorted(sets)
    sig = np.array([np.frombuffer(sets[k][1], "<u2") for k in keys])
    pairs, sizes = {}, {}
    for t in range(N.TREES):
        regions = {}
        for i, row in enumerate(sig):
            regions.setdefault(row[N._ORDERS[t, :N.BASE]].tobytes(), []).append(i)
        for members in regions.values():
            sizes[len(members)] = True
            for i in members:
                for j in members:
                    if i < j:
                        pairs.setdefault((i, j), len(members) > N.SMALL)
    jac = lambda a, b: len(a & b) / len(a | b)
    linked = {(i, j) for (i, j), large in pairs.items() if large and jac(sets[keys[i]][0], sets[keys[j]][0]) >= 0.8}
    assert max(sizes) > 3 * 7 and 50 < len(linked) < len(pairs)
    for half in (0, len(keys) // 2):    # the first half is one component
        comp = spark.createDataFrame([(bytearray(k), bytearray(keys[0] if i < half else k)) for i, k in enumerate(keys)], "cls binary, comp binary")
        got = N.stray_links(rows, reps, texts, comp, 2, 80, 0.5).collect()
        found = {tuple(sorted((keys.index(bytes(x.e)), keys.index(bytes(x.o))))) for x in got}
        assert found == {(i, j) for i, j in linked if j >= half} and len(got) == len(found)
