import random
import re

import pytest

from engram.llm import pii
from tests.llm.helpers import docs_frame, words

TEXTS = ["", None, "mail a.b@c.de, x@y (no) q@@z.com a@b.c@d.e .@.a -@-.-", "+1 (017) 555-7713 and +49 30 1234567890123456789", "10.0.0.1 1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 01.02.003.255 256.1.1.1",
         "4111 1111 1111 1111 and 4111-1111-1111-1112 and 0000000000000000000000", "é +1 202 555 0123 4111111111111111 a@b.co", "1" * 5000, "@" * 3000, "a" * 20000 + "@b", "+" * 2000 + "1 (" * 500,
         "x+1 23-456-7890@mail.example.com"]


def luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def brute(t):
    out = []
    if t:
        out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub("[^0-9]", "", m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_base_spans_of_random_strings():
    r = random.Random(2)
    for _ in range(4000):
        t = "".join(r.choices("a1.2@-+ (5)0é\n_%", k=r.randint(0, 40)))
        assert pii.base_spans(t) == brute(t), t


def corpus():
    """An entity whose rare neighbour gives it away, and one with common neighbours."""
    r = random.Random(1)
    rows = [(i, " ".join(words(r, 40))) for i in range(40)]
    for i in range(5):
        rows.append((100 + i, f"{' '.join(words(r, 5))} Zyxwvia {' '.join(words(r, 3))} zyx@mail.example.com {' '.join(words(r, 5))}"))
    rows += [(200, "here Zyxwvia speaks without an address"), (201, None), (202, "")]
    rows += [(300 + i, "same line with Qwertzu and qw@mail.example.com in it") for i in range(6)]  # one context, copied
    return rows


def test_disclosing_terms(spark):
    terms = {r.term: r.ratio for r in pii.disclosing_terms(docs_frame(spark, corpus())).collect()}
    assert "zyxwvia" in terms and terms["zyxwvia"] >= 0.9
    assert "qwertzu" not in terms  # a single distinct context has no support
    assert not set(terms) & {"the", "er", "mail"}


def test_shared_signatures_and_copies(spark):
    """One block in different texts has the support of each; copies of a text change no ratio."""
    r = random.Random(4)
    plain = [(i, " ".join(words(r, 40))) for i in range(60)]
    block = "kind regards from Vornquist Limmerhal to all at vq@mail.example.com or by post every day of week"
    signed = [(100 + i, f"{' '.join(words(r, 20))} {block} {' '.join(words(r, 20))}") for i in range(6)]
    once = {t.term: t.ratio for t in pii.disclosing_terms(docs_frame(spark, plain + signed)).collect()}
    assert once["vornquist"] == pytest.approx(1.0) and "limmerhal" in once
    copied = {t.term: t.ratio for t in pii.disclosing_terms(docs_frame(spark, plain + signed * 50)).collect()}
    assert copied == pytest.approx(once)
    apart = [(300 + i, f"{' '.join(words(r, 30))} Vornquist") for i in range(8)]  # in 14 texts, near the address in 6
    assert "vornquist" not in {t.term for t in pii.disclosing_terms(docs_frame(spark, plain + signed + apart)).collect()}


@pytest.mark.parametrize("block_terms", [1, 500_000])
def test_sanitise(spark, block_terms):
    rows = corpus() + [(400 + i, t) for i, t in enumerate(TEXTS)] + [(100, "again a@b.co")]
    out = pii.sanitise(docs_frame(spark, rows, extra="spans"), block_terms=block_terms)
    got = out.collect()
    assert len(got) == len(rows)
    base = sorted((str(r.doc_id), [(s.start, pii.KINDS.index(s.kind), s.end) for s in r.spans if s.kind != "term"]) for r in got)
    assert base == sorted((str(i), brute(t)) for i, t in rows)
    by = {r.doc_id: r for r in got}
    assert by[200].sanitised == "here [TERM] speaks without an address"
    assert by[201].sanitised is None and by[202].sanitised == ""
    assert "zyx" not in by[100 + 1].sanitised.lower() and "[EMAIL]" in by[101].sanitised
    for r in got:
        spans = [(s.start, pii.KINDS.index(s.kind)) for s in r.spans]
        assert spans == sorted(spans)


def test_empty_table(spark):
    assert pii.sanitise(docs_frame(spark, [(1, "a")]).limit(0)).collect() == []
    assert [r.sanitised for r in pii.sanitise(docs_frame(spark, [(1, "a")])).collect()] == ["a"]


def test_contexts_are_whole_words_at_any_distance(spark):
    gap, long = " 1234 " * 300, "w" * 500
    text = f"alpha beta {long}{gap}bob@firm.org{gap}gamma delta{'x' * 400} éa@x.org"
    rows = pii.contexts(docs_frame(spark, [(1, text)]), "text", 3).collect()
    by = {r.entity: r.terms for r in rows}
    assert by["email:bob@firm.org"] == sorted(["alpha", "beta", long, "gamma", "delta" + "x" * 400, "org"])
    assert by["email of:@firm.org"] == by["email:bob@firm.org"] and "email:a@x.org" in by


def test_terms_that_disclose_a_domain(spark):
    """The name of a firm stands only beside its addresses, all different: no single value
    is seen often enough, their domain is."""
    docs = [(i, f"Write to Zorblatt support: user{i}@zorblatt.org or call later number {i}") for i in range(6)]
    docs += [(100 + i, f"plain words or support call later number user{i}@mail{i}.net") for i in range(40)]
    docs += [(200, "zorblatt was mentioned")]
    out = {r.doc_id: r for r in pii.sanitise(docs_frame(spark, docs)).collect()}
    assert all("[TERM]" in out[i].sanitised and "Zorblatt" not in out[i].sanitised for i in range(6))
    assert out[200].sanitised == "[TERM] was mentioned"
    assert all(s.kind != "term" for i in range(40) for s in out[100 + i].spans)


def slow_terms(texts, window=8, support=3, threshold=0.9):
    """Every count by hand over distinct texts."""
    import math
    import re

    texts = [t for t in dict.fromkeys(texts) if t is not None]
    near, words = {}, {}
    for t in texts:
        terms = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W\d_]{3,}", t)]
        for w in {w for *_, w in terms}:
            words.setdefault(w, set()).add(t)
        for s in pii.base_spans(t):
            ctx = [w for a, b, w in terms if b <= s[0]][-window:] + [w for a, b, w in terms if a >= s[2]][:window]
            for e in pii._entities(t, s):
                near.setdefault(e, {})
                for w in set(ctx) | {""}:
                    near[e].setdefault(w, set()).add(t)
    best = {}
    for e, ctx in near.items():
        ic = math.log(len(texts) / len(ctx[""])) or 1e-9
        for w, with_both in ctx.items():
            if w and len(with_both) >= support:
                best[w] = max(best.get(w, -9), 1 + math.log(min(1, len(with_both) / len(words[w]))) / max(ic, 1e-9))
    return {w: r for w, r in best.items() if r >= threshold}


def test_term_selection_by_hand(spark):
    import random

    r = random.Random(4)
    vocab = ["".join(r.choices("abcdefgh", k=4)) for _ in range(60)]
    firms = {f"firm{k}.org": "".join(r.choices("xyzuvw", k=5)) for k in range(5)}
    docs = []
    for i in range(250):
        t = r.choices(vocab, k=20)
        if r.random() < 0.5:
            d = r.choice(list(firms))
            at = r.randrange(20)
            t[at:at] = [firms[d], f"u{r.randrange(30)}@{d}"] if r.random() < 0.95 else [f"u{i}@{d}"]
        docs.append((i, " ".join(t)))
    docs += [(500, docs[3][1]), (501, docs[3][1]), (502, None)]
    got = {x.term: x.ratio for x in pii.disclosing_terms(docs_frame(spark, docs)).collect()}
    want = slow_terms([t for _, t in docs])
    assert got.keys() == want.keys() and len(got) >= 3 and all(abs(got[w] - want[w]) < 1e-9 for w in got)


def test_blocks_of_terms_give_equal_spans(spark):
    docs = docs_frame(spark, [(i, f"text {i} zork{'abcdefg'[i % 7]} beside u{i % 7}@x{i % 7}.org ends") for i in range(35)])
    a, b = (sorted(map(str, pii.sanitise(docs, support=2, block_terms=n).collect())) for n in (10, 1))
    assert a == b and "term" in str(a)
