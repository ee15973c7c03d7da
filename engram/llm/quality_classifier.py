"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. How
often each combination of votes occurs is counted by Spark over all documents (a
table of at most 3^labellers rows), and expectation-maximisation on those counts
estimates every labeller's accuracy and each combination's posterior of being good.
The posteriors train a logistic scorer on hashed words and a few measures, on a
bounded sample (``sample_rows`` documents of the lowest id hash); the scorer's
weights are broadcast and judge every document.

Defined results: a null or empty text has no words, the labellers vote on zeros and
the scorer on its bias; texts are read whole; repeated rows score alike; a null
language has no function words of its own, so that labeller abstains; an empty
table gives an empty result. Columns named like an added one give way to it.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.llm.common import by_row, query, table

BUCKETS, EPOCHS, RATE, L2 = 1 << 16, 6, 0.5, 1e-6
#: Frequent function words by language and insults (fixed values).
FUNCTION_WORDS = {
    "en": frozenset("the of and to in a is that for it as was with be by on not he this are or from at which".split()),
    "de": frozenset("der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split()),
    "fr": frozenset("de la le et les des en un du une que est pour qui dans par plus pas sur au avec ce il sont".split()),
    "es": frozenset("de la que el en y a los se del las un por con no una su para es al lo como más".split())}
INSULTS = frozenset("idiot moron stupid scum trash pathetic worthless disgusting loser clown".split())
_SYMBOLS = b"#*$%&|<>{}[]\\^~="
_UPPER, _LETTER = re.compile("[A-Z]+"), re.compile(r"[^\W\d_]+")
LABELLERS = ("symbols", "capitals", "word_length", "bars", "repeated_lines", "repeated_words", "length", "function_words",
             "exclamations", "insults")
GOOD, NONE, BAD = 0, 1, 2


def measures(text: str | None, lang: str | None) -> tuple[list[bytes], list[float]]:
    """Lower-case words and the shares that the labellers judge."""
    raw = text.encode() if text else b""
    words = raw.lower().split()
    n, size = max(1, len(words)), max(1, len(raw))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    capitals = sum(map(len, _UPPER.findall(text or "")))
    lines = [x for x in (text or "").split("\n") if x.strip()]
    kinds = Counter(words)
    own = FUNCTION_WORDS.get(lang or "")
    function = sum(kinds[w.encode()] for w in own) / n if own else -1.0
    insults = sum(v for w, v in kinds.items() if w.strip(b".,;:!?\"'()#*$%&").decode("utf-8", "ignore") in INSULTS)
    return words, [symbols / size, capitals / size, sum(map(len, words)) / n, raw.count(b"|") / n,
                   1 - len(set(lines)) / max(1, len(lines)), 1 - len(kinds) / n, float(len(words)), function, raw.count(b"!!") / n, insults / n]


#: Bad above this share; most labellers have nothing to say below it.
_BAD_ABOVE = {0: 0.03, 1: 0.3, 3: 0.05, 4: 0.3, 8: 0.05, 9: 0.0}


def votes(m: list[float]) -> list[int]:
    """One vote a labeller: all object or stay silent, function words also vouch."""
    out = [BAD if v > _BAD_ABOVE.get(k, float("inf")) else NONE for k, v in enumerate(m)]
    out[2] = BAD if m[2] < 2 or m[2] > 14 else NONE
    out[5] = BAD if m[5] > 0.85 and m[6] < 3000 else NONE
    out[6] = BAD if m[6] < 1 else NONE
    out[7] = NONE if m[7] < 0 or m[6] < 20 else GOOD if m[7] > 0.08 else BAD if m[7] < 0.03 else NONE
    return out


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500, accuracy: float = 0.8, prior: float = 0.8):
    """Accuracies of the labellers and posteriors (of good) of vote combinations.

    A labeller that speaks is right with its accuracy, whichever class. One with both
    votes speaks as often in either class, so its silence says nothing; one that only
    objects (or only vouches) speaks more often where it is right, so its silence
    counts a little. Accuracies compare the share of right votes in the one class with
    the share of wrong votes in the other, so unequal classes do not bend them. The
    start and ten pseudo votes hold every accuracy until data speak; accuracies stay
    between 0.5 (says nothing) and 0.99."""
    says = np.stack((patterns == GOOD, patterns == BAD)).astype(float)  # vote, pattern, labeller
    total, mute = counts.sum(), 1 - says.sum(0)
    spoken = (says * counts[:, None]).sum(1)
    both, seen = (spoken > 0).all(0), spoken.sum(0)
    rate = np.where(both, seen, 2 * spoken) / total
    acc, post = np.full(patterns.shape[1], accuracy), np.zeros(len(counts))
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior))
        for sign, right in ((1, np.stack((acc, 1 - acc))), (-1, np.stack((1 - acc, acc)))):
            p = rate * right  # of either vote, in the class that is good (bad)
            p = np.maximum(p * np.minimum(1, 0.999 / np.maximum(p.sum(0), 1e-12)), 1e-12)
            silent = np.where(both, 0.0, np.log1p(-p.sum(0)))
            odds = odds + sign * ((says * np.log(p)[:, None]).sum((0, 2)) + mute @ silent)
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        done, post = np.abs(new - post).max() < 1e-9, new
        if done:
            break
        mass = np.stack((post * counts, (1 - post) * counts))
        share = np.einsum("yp,vpj->yvj", mass, says) / np.maximum(mass.sum(1), 1e-9)[:, None, None]
        right, wrong = share[0, 0] + share[1, 1], share[0, 1] + share[1, 0]
        rate = np.where(both, seen / total, share.sum(0))
        acc = np.clip((seen * right / np.maximum(right + wrong, 1e-12) + 10 * accuracy) / (seen + 10), 0.5, 0.99)
        prior = float(np.clip((post * counts).sum() / total, 0.01, 0.99))
    return acc, post


def hashed(words: list[bytes], m: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: word shares (unit length) and binned measures."""
    kinds = Counter(map(crc32, words))
    h = np.fromiter(kinds.keys(), np.int64, len(kinds))
    v = np.sqrt(np.fromiter(kinds.values(), np.float64, len(kinds)))
    v = np.where(h >> 20 & 1, v, -v) / max(1e-9, np.sqrt((v * v).sum()))
    own = [crc32(f"{name}:{min(20, int(x * 40)) if x <= 1 else 20 + min(20, int(np.log2(1 + x) * 2))}".encode()) for name, x in zip(LABELLERS, m)]
    return np.concatenate((h % BUCKETS, np.array(own) % BUCKETS)), np.concatenate((v, np.full(len(own), 0.5)))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Logistic weights (last one: bias) by AdaGrad on soft labels."""
    w, g2 = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-6)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)).tolist():
            at, v = rows[k]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ v + w[-1], -30, 30)))
            for i, g in ((at, (p - target[k]) * v + L2 * w[at]), (BUCKETS, p - target[k])):
                g2[i] += g * g
                w[i] -= RATE * g / np.sqrt(g2[i])
    return w


def vote_patterns(docs: DataFrame, text_col: str, lang_col: str, keep: list[str]) -> DataFrame:
    def make():
        return lambda texts, langs: (["".join(map(str, votes(measures(t, x)[1]))) for t, x in zip(texts, langs)],)
    return by_row(docs, [text_col, lang_col], "votes string", make, keep=keep)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample_rows: int = 4000, threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Add ``votes`` (a digit a labeller: 0 good, 1 nothing, 2 bad), ``posterior``,
    ``score`` (probability of good) and ``kept`` (score of at least ``threshold``)."""
    added = ("votes", "posterior", "score", "kept")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    lang = docs.withColumn("_lang", F.col(lang_col).cast("string"))
    counted = vote_patterns(lang, text_col, "_lang", []).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    patterns = np.array([[int(c) for c in r["votes"]] for r in counted], int).reshape(len(counted), len(LABELLERS))
    _, post = em(patterns, np.array([r["n"] for r in counted], float)) if counted else (None, [])
    posterior = {r["votes"]: float(p) for r, p in zip(counted, post)}
    # the bounded, documented sample that fits the scorer: the smallest hashes win, so it is spread
    # evenly; a hash limit that lets a quarter more through keeps whole tables away from the driver
    total = sum(r["n"] for r in counted)
    limit = int(2 ** 63 * min(1.0, 1.25 * sample_rows / max(1, total))) - 1
    sample = (lang.select(text_col, "_lang", F.shiftrightunsigned(F.xxhash64(id_col, text_col), 1).alias("h"))
              .filter(F.col("h") <= limit).orderBy("h").limit(sample_rows).collect())
    held = [measures(r[0], r[1]) for r in sample]
    weights = fit_scorer([hashed(w, m) for w, m in held], np.array([posterior["".join(map(str, votes(m)))] for _, m in held]))
    bc = docs.sparkSession.sparkContext.broadcast((weights, posterior))

    def make():
        w, known = bc.value

        def fn(texts, langs):
            v, p, s = [], [], []
            for t, x in zip(texts, langs):
                words, m = measures(t, x)
                v.append("".join(map(str, votes(m))))
                p.append(round(known[v[-1]], 6))
                at, val = hashed(words, m)
                s.append(round(float(1 / (1 + np.exp(-np.clip(w[at] @ val + w[-1], -30, 30)))), 6))
            return v, p, s
        return fn
    out = by_row(lang, [text_col, "_lang"], "votes string, posterior double, score double", make, keep=kept)
    return out.withColumn("kept", F.col("score") >= threshold)


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, data_dir: str) -> DataFrame:
    """Votes, posterior, score and verdict of every document."""
    return classify(table(spark, data_dir, "documents").select("doc_id", "text", "lang"), keep=["doc_id"])
