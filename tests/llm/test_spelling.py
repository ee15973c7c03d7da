import random
import re
import zlib
from collections import Counter

import pytest

from engram.llm import spelling
from tests.llm.helpers import docs_frame, words

LOW = {c: c + 32 for c in range(65, 91)}


def count_words(rows, every=31):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    """word -> (form, root, n, n_near, form_n) by comparing every pair."""
    beside = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, others in beside.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n[w], len(beside[w]), n.get(form.get(w))) for w in n)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


@pytest.fixture(scope="module")
def docs():
    r = random.Random(11)
    stems = [w for w in words(r, 300) if len(w) >= 6][:60] + ["éléments", "Straßenbahn", "ÉCOLEÉCOLE"]

    def bent(w):
        at, c = r.randrange(len(w)), r.choice("eanßéÀ÷")
        return r.choice([w[:at] + w[at + 1:], w[:at] + c + w[at:], w[:at] + c + w[at + 1:], w])
    out = []
    for i in range(150):
        text = []
        for _ in range(60):
            w = r.choice(stems[:8]) if r.random() < 0.6 else r.choice(stems)
            for _ in range(r.choice([0, 0, 0, 0, 0, 1, 2, 3])):
                w = bent(w)
            text.append(r.choice([w, w.upper(), w.title()]))
        out.append((i, r.choice([" ", ", ", "\n1"]).join(text)))
    long_run = "abcdefghij" * 900
    out += [(200, None), (201, ""), (202, "123 ЖЖЖЖЖЖЖ"), (203, out[0][1]), (203, out[0][1]),
            (None, out[1][1]), (204, f"{long_run} {long_run} {long_run}x {long_run}x"), (205, "word " * 20000 + "wordless " * 50)]
    return out


@pytest.mark.parametrize(("limit", "k"), [(4096, None), (16, 4), (16, 1), (4096, 9)])
def test_against_all_pairs(spark, docs, limit, k):
    w = spelling.corpus_words(docs_frame(spark, docs, extra="word"), change=spelling.delete_a_letter(31))
    assert rows_of(spelling.spelling_variants(w, limit=limit, k=k)) == brute(count_words(docs))


def test_forms_are_followed_to_the_last(spark):
    """Chains of three forms, ties between forms, letters beyond the usual alphabet."""
    n = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "zzzzzzz": 3, "zzzzzzy": 30, "yzzzzzz": 30, "lonelyword": 9,
         "привет1": 2, "привет2": 40, "anagram": 7, "ganaram": 7}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    got = rows_of(spelling.spelling_variants(df))
    assert got == brute(n)
    by = {r[0]: r for r in got}
    assert by["aaaaaaa"][2] == "aaaabbb" and by["zzzzzzz"][1] == "yzzzzzz"


def test_empty_tables(spark):
    none = spelling.corpus_words(docs_frame(spark, [(1, "x")]).limit(0))
    out = spelling.spelling_variants(none)
    assert out.columns == ["word", "n", "n_near", "form", "form_n", "root"] and out.collect() == []
