"""Secret scans: candidate strings judged by a random forest.

A candidate is a run of ``[A-Za-z0-9+/=_-]``, 16 characters or more, that holds a
digit and a letter, or the value after a secret's name and an assignment sign, of
any length and characters: up to the closing quote on its line, or else unbroken
(less a comma or semicolon at its end). A value and another run inside it are judged
apart, so their spans may overlap. Its features: length, rate of changes between character
classes, share of each class, entropy, distinct characters, dictionary coverage
(share of letters that stand in letter runs which are words of the dictionary or
look like words by their vowels), whether a path-like or code-like source, and
what the neighbouring words say (a secret's name before it, an assignment sign, a
word that marks hashes, links or identifiers).

The forest is trained from labelled findings (``labelled_findings``: a stated
number of findings made by rule, both secrets in assignments and the usual false
positives such as commit hashes, digests, identifiers, encoded pictures and file
names; a caller may pass own ones) with bootstrap samples, random feature subsets
and Gini splits, and broadcast (a few thousand nodes).

Defined results: a null or empty text has no candidate; texts are scanned whole;
repeated rows are scanned alike; a null source is the empty one; spans are code
points, end exclusive; columns named like an added column give way to it.
"""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.llm.common import by_row, query, table

_RUN = re.compile(r"[A-Za-z0-9+/=_-]{16,}")
_DIGIT, _LETTER, _LETTERS = re.compile("[0-9]"), re.compile("[A-Za-z]"), re.compile("[A-Za-z]+")
_WORD = re.compile(r"[A-Za-z]+")
#: Names and markers around findings (fixed values).
SECRET_WORDS = frozenset("token secret key apikey password passwd pwd auth credential credentials bearer private access".split())
PLAIN_WORDS = frozenset("commit sha hash digest checksum md5 sha1 sha256 id uuid guid etag revision src href http https www "
                        "image data file path version build ref integrity nonce example sample".split())
DICTIONARY = frozenset("the and for with file data image page index main test user name path code list item text home "
                       "docs core lib src module version release config default static public".split())
#: An identifier that holds a secret's name, an assignment sign and a value. It starts where
#: the identifier starts and gives nothing back, so long runs are read once.
_NAMED = f"(?:{'|'.join(sorted(SECRET_WORDS))})(?![A-Za-z])"
_ASSIGNED = re.compile(rf"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]*?{_NAMED})[A-Za-z0-9_-]++[\"']?[ \t]*+(?::=|=>|[=:])(?!=)[ \t]*+"
                       r"""(?:"([^"\n]+)"|'([^'\n]+)'|["']?([^\s"',;](?:[^\s"']*[^\s"',;])?))""", re.I)
FINDINGS, TREES, DEPTH = 3000, 30, 8


def candidates(text: str | None) -> list[tuple[int, int]]:
    """Spans of candidate strings of a whole text, each once, by start."""
    if not text:
        return []
    runs = {m.span() for m in _RUN.finditer(text) if _DIGIT.search(m.group()) and _LETTER.search(m.group())}
    return sorted(runs.union(m.span(m.lastindex) for m in _ASSIGNED.finditer(text)))


def features(text: str, start: int, end: int, source: str) -> list[float]:
    s = text[start:end]
    n = len(s)
    kinds = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "o" for c in s]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1)
    counts = [s.count(c) for c in set(s)]
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    covered = sum(len(r) for r in _LETTERS.findall(s)
                  if len(r) > 2 and (r.lower() in DICTIONARY or 0.25 <= sum(c in "aeiouAEIOU" for c in r) / len(r) <= 0.6 and len(r) > 4))
    before, after = text[max(0, start - 40):start], text[end:end + 20]
    words = [w.lower() for w in _WORD.findall(before)[-3:]] + [w.lower() for w in _WORD.findall(after)[:1]]
    gap = before.rstrip(" \"'")[-1:]
    return [n, changes, kinds.count("d") / n, kinds.count("l") / n, kinds.count("u") / n, kinds.count("o") / n, entropy,
            len(counts) / n, covered / n, float(any(w in SECRET_WORDS for w in words)), float(gap in ("=", ":") and gap != ""),
            float(any(w in PLAIN_WORDS for w in words)), float(before[-1:] in "\"'" and before != ""), float("/" in source or "." in source),
            float(not s.strip("0123456789abcdef") or not s.strip("0123456789ABCDEF"))]


def labelled_findings(n: int = FINDINGS, seed: int = 5) -> list[tuple[str, int, int, str, int]]:
    """(text, start, end, source, is a secret) of ``n`` findings made by rule."""
    r = random.Random(seed)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    syllables = ["the", "er", "on", "ti", "re", "st", "an", "ou", "en", "ha", "ing", "le", "de", "que", "ment", "ch"]

    def word():
        return "".join(r.choices(syllables, k=r.randint(1, 4)))

    def hexa(k):
        h = hashlib.sha256(str(r.random()).encode()).hexdigest()[:k]
        return h.upper() if r.random() < 0.3 else h

    out = []
    for i in range(n):
        label = i % 2
        if label:
            value = r.choice([hexa(40), hexa(32), hexa(64), "".join(r.choices(alnum, k=r.randint(20, 48))),
                              "".join(r.choices(alnum + "+/", k=40)), r.choice(["sk", "pk", "gh", "ak"]) + "_" + "".join(r.choices(alnum, k=32))])
            name = r.choice(sorted(SECRET_WORDS))
            name = r.choice([name, name.upper(), word() + "_" + name, name.title()])
            lead = r.choice([f"{name} = \"", f"{name}: ", f"{name}=", f"\"{name}\": \"", f"{name} = '", f"{name} "])
        else:
            value = r.choice([hexa(40), hexa(32), hexa(64), "-".join(hexa(k) for k in (8, 4, 4, 4, 12)),
                              "/".join(word() for _ in range(4)) + str(r.randint(1, 99)), "-".join(word() for _ in range(4)) + "-" + str(r.randint(1, 2030)),
                              word() + word() + word() + str(r.randint(0, 9)), "".join(r.choices(alnum + "+/", k=r.randint(60, 200))),
                              word().upper() + "_" + word().upper() + "_" + word().upper() + str(r.randint(0, 99))])
            lead = r.choice([f"{w}{g}" for w in sorted(PLAIN_WORDS) for g in (" ", ": ", "=", "/")] + [word() + " "] * 60)
        before = " ".join(word() for _ in range(r.randint(0, 6))) + " " + lead
        after = r.choice(['"', "'", " ", "\n", ", "]) + word()
        source = r.choice(["src0", "web", "config.py", "app/settings.env", "docs/readme.md"])
        out.append((before + value + after, len(before), len(before) + len(value), source, label))
    return out + assigned_findings(n // 3, seed + 1)


def assigned_findings(n: int, seed: int) -> list[tuple[str, int, int, str, int]]:
    """Labelled values after a secret's name: short and odd passwords, letters or digits
    only, against prose, code, placeholders and empty values."""
    r = random.Random(seed)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every = lower + lower.upper() + digits
    plain = ["none", "null", "true", "false", "required", "string", "str", "getenv", "your_password", "changeme", "<password>",
             "${PASSWORD}", "self.password", "args.token", "the", "a", "see", "next", "public", "x", "{{", "******"]
    out = []
    for i in range(n):
        label = i % 2
        if label:
            value = r.choice(["".join(r.choices(every + "!@#$%^&*?.", k=r.randint(8, 24))), "".join(r.choices(every, k=r.randint(8, 15))),
                              "".join(r.choices(lower, k=r.randint(12, 30))), "".join(r.choices(digits, k=r.randint(8, 24))),
                              r.choice(["p@ss", "s3cr", "adm1n", "l0g"]) + r.choice("!?#$") + "".join(r.choices(lower, k=4)) + r.choice(digits)])
        else:
            value = r.choice(plain)
        name = r.choice(sorted(SECRET_WORDS))
        name = r.choice([name, name.upper(), "db_" + name, name.title()])
        lead, after = r.choice([(f'{name} = "', '"'), (f"{name}: ", " "), (f"{name}=", " "), (f'"{name}": "', '"'), (f"{name} = '", "'")])
        before = " ".join("".join(r.choices(lower, k=r.randint(2, 8))) for _ in range(r.randint(0, 6))) + " " + lead
        out.append((before + value + after + "\nnext", len(before), len(before) + len(value), r.choice(["src0", "web", "config.py", "app/settings.env"]), label))
    return out


class Forest:
    """Binary trees in flat arrays: feature, threshold, left child, share of secrets."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.trees = []
        for _ in range(trees):
            rows = rng.integers(0, len(y), len(y))
            self.trees.append(self._grow(x[rows], y[rows], depth, rng))

    @staticmethod
    def _split(x: np.ndarray, y: np.ndarray, rng):
        best = (0.0, -1, 0.0)
        base = y.mean() * (1 - y.mean()) * len(y)
        for f in rng.choice(x.shape[1], max(1, int(x.shape[1] ** 0.5) + 1), replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, t = x[order, f], np.cumsum(y[order])
            at = np.flatnonzero(v[1:] > v[:-1])
            if not len(at):
                continue
            left, a = at + 1.0, t[at]
            right, b = len(y) - left, t[-1] - a
            gain = base - a * (1 - a / left) - b * (1 - b / right)
            k = int(gain.argmax())
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), int(f), float((v[at[k]] + v[at[k] + 1]) / 2))
        return best

    def _grow(self, x, y, depth, rng):
        feature, cut, child, value = [], [], [], []
        todo = [(np.arange(len(y)), 0)]
        while todo:  # breadth first: a node's children stand side by side
            nxt = []
            for rows, level in todo:
                feature.append(-1)
                cut.append(0.0)
                child.append(0)
                value.append(float(y[rows].mean()))
                if level < depth and len(rows) >= 8 and 0 < value[-1] < 1:
                    gain, f, c = self._split(x[rows], y[rows], rng)
                    if f >= 0:
                        feature[-1], cut[-1] = f, c
                        nxt += [(rows[x[rows, f] <= c], level + 1), (rows[x[rows, f] > c], level + 1)]
            base = len(feature)
            k = 0
            for node in range(len(feature) - len(todo), len(feature)):
                if feature[node] >= 0:
                    child[node] = base + k
                    k += 2
            todo = nxt
        return np.array(feature), np.array(cut), np.array(child), np.array(value)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets over the trees."""
        total = np.zeros(len(x))
        for feature, cut, child, value in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                go = x[np.arange(len(x)), np.maximum(f, 0)] > cut[node]
                node = np.where(inner, child[node] + go, node)
            total += value[node]
        return total / len(self.trees)


def train(findings=None) -> Forest:
    rows = labelled_findings() if findings is None else findings
    x = np.array([features(t, a, b, s) for t, a, b, s, _ in rows])
    return Forest(x, np.array([y for *_, y in rows], float))


def scan(docs: DataFrame, text_col: str = "text", source_col: str = "source", forest: Forest | None = None,
         threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Add ``n_candidates`` and ``secrets`` (start, end, score of each finding kept)."""
    bc = docs.sparkSession.sparkContext.broadcast(forest or train())

    def make():
        model = bc.value

        def fn(texts, sources):
            found = [candidates(t) for t in texts]
            x = [features(t, a, b, s or "") for t, s, spans in zip(texts, sources, found) for a, b in spans]
            p = iter(model.predict(np.array(x)).tolist() if x else ())
            out = [[{"start": a, "end": b, "score": round(q, 6)} for (a, b), q in [(s, next(p)) for s in spans] if q >= threshold]
                   for spans in found]
            return [len(s) for s in found], out
        return fn
    return by_row(docs, [text_col, source_col], "n_candidates bigint, secrets array<struct<start:int,end:int,score:double>>", make, keep=keep)


@query("op5_secrets")
def op5_secrets(spark: SparkSession, data_dir: str) -> DataFrame:
    """Findings of every document."""
    d = scan(table(spark, data_dir, "documents").select("doc_id", "text", "source"), keep=["doc_id"])
    return d.select("doc_id", "n_candidates", F.size("secrets").cast("bigint").alias("n_secrets"),
                    F.expr("array_join(transform(secrets, s -> concat(s.start, ':', s.end)), ',')").alias("spans"))
