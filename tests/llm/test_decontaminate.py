import random

import pytest

from engram.llm.decontaminate import WORD, WindowSet, decontaminate, words_of
from tests.llm.helpers import docs_frame, words

BENCH = "item_id bigint, text string"


def brute(text, items, size=10):
    w = [x.lower() for x in WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))]
    hit, found = set(), set()
    for item, t in items:
        b = [x for x in WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))]
        n = min(size, len(b))
        wins = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                found.add("" if item is None else str(item))
    return len(w), len(hit), sorted(found), bool(hit)


@pytest.fixture(scope="module")
def data():
    r = random.Random(4)
    bench = [(i, " ".join(words(r, r.choice([3, 9, 10, 11, 25])))) for i in range(12)]
    bench += [(10, bench[3][1]), (20, None), (21, " . "), (None, " ".join(words(r, 12))), (22, "Zürich ist schön")]
    docs = []
    for i in range(60):
        t = words(r, r.randint(0, 60))
        for _ in range(r.randint(0, 2)):
            w = (r.choice(bench)[1] or "").split()
            a = r.randint(0, max(0, len(w) - 10))
            at = r.randint(0, len(t))
            t[at:at] = w[a:a + r.choice([5, 10, 14, 40])]
        docs.append((i, r.choice([" ", ", ", "\n"]).join(t)))
    docs += [(100, None), (101, ""), (102, bench[0][1].upper() + "!"), (102, bench[0][1]), (None, bench[1][1]),
             (103, "in zürich IST, schön"), (104, "word " * 30000 + bench[5][1])]
    return bench, docs


@pytest.mark.parametrize("block_bytes", [1 << 20, 120])
def test_against_brute_force(spark, data, block_bytes):
    bench, docs = data
    out = decontaminate(docs_frame(spark, docs, extra="n_hit"), spark.createDataFrame(bench, BENCH), block_bytes=block_bytes).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r.hit_items), r.contaminated) for r in out), key=str)
    assert got == sorted(((i, *brute(t, bench)) for i, t in docs), key=str)
    for r in out:  # spans cover exactly the hit words
        inside = [w for s in r.hit_spans for w in words_of(r.text[s.start:s.end])]
        assert len(inside) == r.n_hit


def test_actions(spark, data):
    bench, docs = data
    df, b = docs_frame(spark, docs, extra="n_hit"), spark.createDataFrame(bench, BENCH)
    clean = sorted((str(i), t) for i, t in docs if not brute(t, bench)[3] and t is not None)
    kept = decontaminate(df, b, action="remove_documents")
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text is not None) == clean
    cut = decontaminate(df, b, action="remove_spans")
    assert cut.columns == df.columns and cut.count() == len(docs)
    for r in cut.collect():
        if r.doc_id in (102, 103):
            assert words_of(r.text) in ([], [b"in"])


def test_empty_tables(spark):
    none = spark.createDataFrame([], BENCH)
    out = decontaminate(docs_frame(spark, [(1, "a b c")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in out] == [(3, 0, False)]
    assert decontaminate(docs_frame(spark, [(1, "a")]).limit(0), none).collect() == []


def test_windows_take_little_memory():
    import pickle

    r = random.Random(1)
    items = [(str(i), " ".join(words(r, 60))) for i in range(4000)]
    size = sum(len(t.encode()) for _, t in items)
    assert len(pickle.dumps(WindowSet(items, 10))) < 6 * size
    same = WindowSet([(str(i), "one two three") for i in range(3000)], 10)
    assert [len(x[2]) for x in same.scan(words_of("zero one two three four"))] == [3000]
