import random

import pytest

from engram.llm import url_filter as u

URLS = [(1, "https://www.ThThre.example.com/fr/825?page=2"), (2, "http://example.org/es/797#top"), (3, "http://x.example.org/en/12"), (4, "http://example.org/en/2"),
        (5, "https://a.com/de/1"), (6, "https://a.com/de"), (7, None), (8, "no scheme"), (9, ""), (10, "http://cheappills.net/en/5"), (11, "http://www.casino-win.net/x"),
        (12, "ftp://notorg/en"), (13, "http://org"), (14, "http://org/"), (15, "HTTP://EXAMPLE.ORG/ES/1"), (16, "a://b://c/d"), (17, "http://evil.com?x=/de/"), (18, "http://é.com/fr/\nz"),
        (2, "http://example.org/es/797#top"), (None, "http://freebets.net"), (19, "http://adult-x.net/"), (20, "http://myorg/")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return rest[:end].translate({c: c + 32 for c in range(65, 91)}), path[:stop]


def rule(host, path):
    fit = [(len(h + p), v, h + p) for v, h, p in u.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


@pytest.fixture(scope="module")
def pages(spark):
    r = random.Random(2)
    rows = URLS + [(100 + i, f"http://{r.choice(['www.', 'm.', ''])}{r.choice(['daily', 'garden', 'cloud'])}{r.choice(['news', 'shop', 'wiki'])}.net/{r.choice(['en', 'es'])}/{i}") for i in range(60)]
    rows += [(200 + i, f"http://{r.choice(['best', 'top', 'my'])}{r.choice(['casino', 'poker', 'pills'])}{r.choice(['zone', '', 'star'])}.net/en/{i}") for i in range(20)]
    return rows


def test_rules_and_parts(spark, pages):
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, verdict string")
    out = u.url_filter(df).collect()
    assert len(out) == len(pages)
    for r in out:
        host, path = split(r.url)
        verdict, name = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        if name:
            assert r.verdict == verdict
    by = {r.page_id: r for r in out}
    assert by[10].words[:2] == ["cheap", "pills"] and by[10].verdict == "block"
    assert by[11].verdict == "block" and by[None].verdict == "block"
    assert all(by[k].verdict == "allow" for k in (7, 8, 9, *range(100, 160)))
    assert all(by[k].verdict == "block" for k in range(200, 220))


def test_viterbi_against_all_splits():
    counts = {"the": 50, "res": 9, "there": 20, "sat": 5, "at": 30, "he": 40, "re": 8}
    total = float(sum(counts.values()))

    def score(parts):
        s = 1.0
        for p in parts:
            s *= counts[p] / total if p in counts and len(p) > 1 else 10.0 ** (1 - len(p)) / total
        return s

    def splits(s):
        yield [s]
        for k in range(1, len(s)):
            for rest in splits(s[k:]):
                yield [s[:k], *rest]
    for piece in ("theresat", "thethe", "xqz", "hereat", "a"):
        found = {(a, len(w)): n for w, n in counts.items() for a in range(len(piece)) if piece.startswith(w, a)}
        got = u.viterbi(piece, found, total)
        assert "".join(got) == piece
        assert score(got) == pytest.approx(max(map(score, splits(piece))))


def test_no_seeds_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id bigint, url string")
    assert [r.verdict for r in u.url_filter(df).collect()] == ["allow", "allow"]
    assert u.url_filter(df.limit(0)).collect() == []
