"""Quality rules: base text statistics and language-specific perplexity bands.

The language model is a modified Kneser-Ney model over symbol 5-grams, one per
language. A symbol is one of 128 classes of characters: letters a-z and A-Z apart (so
the model knows how sentences begin), digits, the marks that end or join words each,
blanks, line ends, and 64 classes that other letters and signs are spread over. Counts
cover every character of every text and are summed by Spark; what they hold grows with
the kinds of 5-grams in the corpus. A model is fitted and kept in parts: all n-grams of
three symbols and more with the same two symbols before the last one lie in one part, so
that parts of about ``part_grams`` 5-grams are fitted apart, given the language's pairs
and counts of counts (at most 16,384 + 12 rows). Each part is a sorted array of 64-bit
n-gram hashes beside an array of log probabilities and back-off weights; scoring
looks up the distinct n-grams of a block of text by binary search. Parts are
broadcast in blocks of at most ``block_entries`` entries (or one part), one block at a
time; the sums that a text has from several blocks add up to what one block gives.

Bands: per language, the median of the mean negative log probability and the
quartile distance, from a whole-corpus histogram of texts that pass the base
rules. A text is rejected beyond so many quartile distances (at least so many nats) plus
``noise / sqrt(symbols)``; odd texts lie above, where the band is narrow (``upper``),
monotonous ones below, where clean texts spread further (``lower``). Words of a text put
in another order cost about 0.2 nats a symbol and fall out above.

Defined results: null or empty text: no words, base rule fails, no perplexity; a
null language is a language of its own, apart from the empty one; repeated rows are judged alike; texts are
read whole in pieces; an empty table gives an empty result; a language whose texts
all fail the base rules has no band and rejects nothing further. Columns named
like an added column give way to it.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engram.llm.common import by_row, query, table, written

ORDER, BITS, CLASSES = 5, 7, 128
PAIRS = 1 << 2 * BITS
PIECE, BLOCK = 1 << 19, 1 << 20
SPACE = " \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
ADDED = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
         "n_scored bigint, log_sum double")


def symbol_classes() -> np.ndarray:
    """Class of every code point."""
    cp = np.arange(0x110000, dtype=np.uint64)
    out = (64 + (cp * np.uint64(2654435761) >> np.uint64(20)) % np.uint64(64)).astype(np.uint8)
    out[:128] = 63
    out[:32] = 62
    for c in SPACE:
        out[ord(c)] = 0 if c in " \t" else 1
    for k in range(26):
        out[97 + k], out[65 + k] = 2 + k, 28 + k
    out[48:58] = 54
    for k, c in enumerate(".,;:!?-"):
        out[ord(c)] = 55 + k
    return out


def gram_blocks(texts: list[str | None], classes: np.ndarray):
    """Yield (n-gram codes, part of each code, row of each part) for blocks of text.

    Each text starts with line ends as context; long texts come in pieces that carry the
    characters before them."""
    lead = ORDER - 1
    parts, rows, size = [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text or ""), PIECE):
            parts.append((text[at - lead:at] if at else "\n" * lead) + text[at:at + PIECE])
            rows.append(row)
            size += len(parts[-1])
            if size >= BLOCK:
                yield _codes(parts, classes), np.array(rows)
                parts, rows, size = [], [], 0
    if parts:
        yield _codes(parts, classes), np.array(rows)


def _codes(parts: list[str], classes: np.ndarray):
    s = classes[np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)].astype(np.int64)
    lens, n = np.array([len(p) for p in parts]), len(s) - ORDER + 1
    code = np.zeros(n, np.int64)
    for k in range(ORDER):
        code <<= BITS
        code |= s[k:n + k]
    keep = np.ones(len(s), bool)
    ends = np.cumsum(lens)
    for k in range(1, ORDER):
        keep[ends - k] = False
    return code[keep[:n]], np.repeat(np.arange(len(parts)), lens - ORDER + 1)


def language(lang_col: str) -> F.Column:
    """The language as a key: null is one of its own."""
    return F.coalesce(F.col(lang_col).cast("string"), F.lit("\0"))


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, code, n`` over all texts: distinct n-grams per slice of rows, summed by Spark."""
    src = docs.select(language(lang_col).alias("lang"), F.col(text_col).alias("text"))
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])
    top = ORDER * BITS

    def run(batches):
        classes = symbol_classes()
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                names, which = np.unique(np.array(part.column(0).to_pylist(), object), return_inverse=True)
                total: dict[int, list] = {}
                for (codes, owner), rows in gram_blocks(part.column(1).to_pylist(), classes):
                    keys, n = np.unique(which[rows][owner].astype(np.int64) << top | codes, return_counts=True)
                    total.setdefault(0, []).append((keys, n))
                if total:
                    keys, back = np.unique(np.concatenate([k for k, _ in total[0]]), return_inverse=True)
                    n = np.bincount(back, np.concatenate([c for _, c in total[0]])).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(names[keys >> top], pa.string()),
                                                      pa.array(keys & ((1 << top) - 1)), pa.array(n)], schema=schema)

    return src.mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))


def gram_hash(order: int, code: np.ndarray) -> np.ndarray:
    """One-to-one 64-bit mix of (kind, code): kinds up to ORDER are n-grams, from 17 on contexts."""
    x = code.astype(np.uint64) | np.uint64(order << 48)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(np.uint64)


def part_of(code: np.ndarray, parts: int) -> np.ndarray:
    """Part of each n-gram (three symbols or more): by the two symbols before the last."""
    return ((code >> BITS & PAIRS - 1) * 40503 & 0xFFFF) * parts >> 16


def _levels(codes: np.ndarray, counts: np.ndarray):
    """Distinct n-grams and their counts by order, from the longest to pairs."""
    at = np.argsort(codes)
    grams, c = {ORDER: codes[at].astype(np.int64)}, {ORDER: counts[at].astype(np.float64)}
    for k in range(ORDER - 1, 1, -1):  # continuation counts: kinds of left neighbours
        grams[k], n = np.unique(grams[k + 1] & ((1 << BITS * k) - 1), return_counts=True)
        c[k] = n.astype(np.float64)
    return grams, c


def tally(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What the other parts need of one: rows (order, 1 to 4, n-grams with that count) and
    (2, pair, its continuation count). Rows of equal (order, key) add up over parts."""
    grams, c = _levels(codes, counts)
    rows = [np.array([[k, j, (c[k] == j).sum()] for k in range(3, ORDER + 1) for j in (1, 2, 3, 4)], np.int64)]
    rows.append(np.stack((np.full(len(grams[2]), 2), grams[2], c[2].astype(np.int64)), 1))
    return np.concatenate(rows)


def _discounts(n: list[float]) -> np.ndarray:
    if not all(n):
        return np.array([0.5, 0.75, 0.75])
    y = n[0] / (n[0] + 2 * n[1])
    return np.clip([1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]], 0.05, [0.95, 1.95, 2.95])


def kneser_ney(codes: np.ndarray, counts: np.ndarray, tallied: np.ndarray | None = None):
    """Hashes and values (log p of seen n-grams, log back-off of contexts) of the language's
    single symbols and pairs, then those of a part's longer n-grams.

    ``tallied``: rows of ``tally`` summed over all parts (default: of this part alone).
    The longest n-grams seen once are left out: the only text that has one would vouch for itself."""
    tallied = tally(codes, counts) if tallied is None else tallied
    grams, c = _levels(codes, counts)
    pairs = tallied[tallied[:, 0] == 2]
    pairs = pairs[np.argsort(pairs[:, 1])]
    grams[2], c[2] = pairs[:, 1], pairs[:, 2].astype(np.float64)
    grams[1], n = np.unique(grams[2] & CLASSES - 1, return_counts=True)
    c[1] = n.astype(np.float64)
    of = {(k, j): n for k, j, n in tallied[tallied[:, 0] > 2].tolist()}
    hashes, values, lower = ([], []), ([], []), None
    for k in range(1, ORDER + 1):
        d = _discounts([float((c[k] == j).sum()) if k < 3 else float(of.get((k, j), 0)) for j in (1, 2, 3, 4)])
        if k == ORDER:  # seen once: by the text itself, so its mass goes to the back-off
            d[0] = 1.0
        cut = d[np.minimum(c[k], 3).astype(int) - 1]
        ctx, which = np.unique(grams[k] >> BITS, return_inverse=True)
        mass = np.bincount(which, c[k])
        gamma = np.bincount(which, cut) / mass
        side = int(k > 2)
        if k == 1:
            p = np.full(CLASSES, gamma[0] / CLASSES)
            p[grams[1]] += (c[1] - cut) / mass[0]
            grams[1] = np.arange(CLASSES)
        else:
            suffix = grams[k] & ((1 << BITS * (k - 1)) - 1)
            p = (c[k] - cut) / mass[which] + gamma[which] * lower[np.searchsorted(grams[k - 1], suffix)]
            hashes[side].append(gram_hash(16 + k - 1, ctx))
            values[side].append(np.log(gamma))
        stored = c[k] > 1 if k == ORDER else np.ones(len(p), bool)
        hashes[side].append(gram_hash(k, grams[k][stored]))
        values[side].append(np.log(p[stored]))
        lower = p
    return tuple((np.concatenate(h), np.concatenate(v)) for h, v in zip(hashes, values))


def in_parts(grams: DataFrame, part_grams: int) -> DataFrame:
    """``lang, code, n, parts, part``: as many parts as a language's 5-grams ask for."""
    sizes = grams.groupBy("lang").agg(F.greatest(F.ceil(F.count(F.lit(1)) / part_grams), F.lit(1)).cast("int").alias("parts"))
    pair = F.shiftright("code", BITS).bitwiseAND(F.lit(PAIRS - 1)) * 40503
    return grams.join(sizes, "lang").withColumn("part", F.shiftright(pair.bitwiseAND(F.lit(0xFFFF)) * F.col("parts"), 16).cast("int"))


def fit_models(grams: DataFrame, part_grams: int) -> DataFrame:
    """``lang, parts, part, hash, value``: the models in their parts; part -1 holds a
    language's single symbols and pairs."""
    grams = in_parts(written(grams, "grams"), part_grams)
    keys = ["lang", "parts", "part"]

    def count(key, pdf):
        import pandas as pd

        rows = tally(pdf["code"].to_numpy(), pdf["n"].to_numpy())
        return pd.DataFrame({"lang": key[0], "kind": rows[:, 0], "item": rows[:, 1], "n": rows[:, 2]})

    def fit(key, pdf, low):
        import pandas as pd

        if not len(pdf):
            return pd.DataFrame({"lang": [], "parts": [], "part": [], "hash": [], "value": []})
        found = kneser_ney(pdf["code"].to_numpy(), pdf["n"].to_numpy(), low[["kind", "item", "n"]].to_numpy())
        first = int(pdf["first"].iloc[0])       # this part also gives the language's short n-grams
        return pd.concat([pd.DataFrame({"lang": key[0], "parts": key[1], "part": part, "hash": h.view(np.int64),
                                        "value": v.astype(np.float32)})
                          for part, (h, v) in zip((-1, key[2]), found) if part >= 0 or key[2] == first])

    tallied = (grams.groupBy(*keys).applyInPandas(count, "lang string, kind bigint, item bigint, n bigint")
               .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))
    there = grams.groupBy("lang", "parts").agg(F.collect_set("part").alias("all"))
    low = tallied.join(there, "lang").withColumn("part", F.explode("all")).drop("all")
    firsts = there.select("lang", F.array_min("all").alias("first"))
    return (grams.join(firsts, "lang").groupBy(*keys).cogroup(low.groupBy(*keys))
            .applyInPandas(fit, "lang string, parts int, part int, hash bigint, value float"))


class Model:
    """Log probabilities of one language from the sorted hash arrays of some of its parts."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray, parts: int = 1, held: list[int] | None = None):
        at = np.argsort(hashes.view(np.uint64))
        self.hashes, self.values = hashes.view(np.uint64)[at], values[at]
        self.parts, self.held = parts, None if held is None or len(held) == parts else np.array(held)

    def _get(self, kind: int, code: np.ndarray, missing: float) -> np.ndarray:
        h = gram_hash(kind, code)
        pos = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[pos] == h, self.values[pos].astype(np.float64), missing)

    def log_p(self, code: np.ndarray) -> np.ndarray:
        """Log p of the last symbol of each n-gram, backing off where it is unseen; 0 for
        n-grams of parts that are not held."""
        out, weight = np.full(len(code), np.nan), np.zeros(len(code))
        todo = np.arange(len(code))
        if self.held is not None:
            mine = np.isin(part_of(code, self.parts), self.held)
            out[~mine], todo = 0.0, todo[mine]
        for k in range(ORDER, 0, -1):
            g = code[todo] & ((1 << BITS * k) - 1)
            p = self._get(k, g, np.nan)
            seen = ~np.isnan(p)
            out[todo[seen]] = weight[todo[seen]] + p[seen]
            todo, g = todo[~seen], g[~seen]
            if not len(todo):
                break
            weight[todo] += self._get(16 + k - 1, g >> BITS, 0.0)
        return out


def base_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    blank = len(raw) - len(raw.translate(None, SPACE.encode()))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    n, covered = len(words), 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        many, last = Counter(windows), 0
        for i, w in enumerate(windows):
            if many[w] > 1:
                covered += i + 3 - max(i, last)
                last = i + 3
    return n, len(text) - blank, len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), covered


def _score(docs: DataFrame, text_col: str, key: str, bc, keep: list[str], stats: bool = True) -> DataFrame:
    """Base statistics (unless not asked for), symbols and the sum of their log p."""
    def make():
        models, classes = bc.value, symbol_classes()

        def fn(texts, langs):
            total = np.zeros(len(texts))
            for lang in set(langs):
                mine = [i for i, x in enumerate(langs) if x == lang]
                model = models.get(lang)
                if model is None:
                    continue
                for (codes, owner), rows in gram_blocks([texts[i] for i in mine], classes):
                    kinds, which = np.unique(codes, return_inverse=True)
                    sums = np.bincount(owner, model.log_p(kinds)[which], minlength=len(rows))
                    for row, s in zip(rows.tolist(), sums.tolist()):
                        total[mine[row]] += s
            if not stats:
                return (total.tolist(),)
            base = [(*base_stats(t), len(t or "")) for t in texts]
            return (*map(list, zip(*base)), total.tolist()) if base else ([],) * 7
        return fn
    return by_row(docs, [text_col, key], ADDED if stats else "log_sum double", make, keep=keep, slice_rows=1024)


def blocks_of(models: DataFrame, block_entries: int) -> list[list[tuple[str, int, int]]]:
    """(language, parts, part) in blocks of at most ``block_entries`` entries (or one part).
    Every block also holds the short n-grams of its languages."""
    rows = models.groupBy("lang", "parts", "part").agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "part").collect()
    short = {r["lang"]: r["n"] for r in rows if r["part"] < 0}
    blocks, size, last = [[]], 0, None
    for r in rows:
        if r["part"] < 0:
            continue
        extra = r["n"] + (short[r["lang"]] if r["lang"] != last else 0)
        if blocks[-1] and size + extra > block_entries:
            blocks.append([])
            size, extra = 0, r["n"] + short[r["lang"]]
        blocks[-1].append((r["lang"], r["parts"], r["part"]))
        size, last = size + extra, r["lang"]
    return blocks


def load_block(models: DataFrame, block: list[tuple[str, int, int]]) -> dict[str, Model]:
    """The parts of one block, read as one bounded table."""
    if not block:
        return {}
    wanted = models.sparkSession.createDataFrame(block + [(lang, parts, -1) for lang, parts in sorted({x[:2] for x in block})],
                                                 "lang string, parts int, part int")
    names = {lang: k for k, lang in enumerate(sorted({x[0] for x in block}))}
    number = wanted.sparkSession.createDataFrame(list(names.items()), "lang string, number int")
    t = (models.join(F.broadcast(wanted), ["lang", "parts", "part"], "left_semi").join(F.broadcast(number), "lang")
         .select("number", "hash", "value").toArrow())
    index, h, v = (t.column(c).to_numpy() for c in ("number", "hash", "value"))
    held = {lang: (parts, [p for x, _, p in block if x == lang]) for lang, parts, _ in block}
    return {lang: Model(h[index == k], v[index == k], *held[lang]) for lang, k in names.items()}


def bands(scored: DataFrame, key: str, upper: tuple[float, float], lower: tuple[float, float]) -> DataFrame:
    """``key, middle, above, below`` from an exact histogram (steps of 0.001 nats)."""
    hist = (scored.filter(~F.col("base_failed") & F.col("log_ppl").isNotNull())
            .groupBy(F.col(key).alias("lang"), F.floor(F.col("log_ppl") * 1000).alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("lang").orderBy("bin")
    cum = hist.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    q = cum.groupBy("lang").agg(*[F.min(F.when(F.col("upto") >= F.col("all") * f, F.col("bin"))).alias(name)
                                  for name, f in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))])
    apart = (F.col("q3") - F.col("q1")) / 1000
    return q.select(F.col("lang").alias(key), F.struct(((F.col("q2") + 0.5) / 1000).alias("middle"),
                                                       F.greatest(apart * upper[0], F.lit(upper[1])).alias("above"),
                                                       F.greatest(apart * lower[0], F.lit(lower[1])).alias("below")).alias(key + "_band"))


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None,
                  upper: tuple[float, float] = (1.5, 0.05), lower: tuple[float, float] = (8.0, 0.25), noise: float = 2.5,
                  block_entries: int = 12_000_000, part_grams: int = 2_000_000) -> DataFrame:
    """Add base statistics, ``n_scored``, ``log_ppl`` (nats a symbol), ``band_low``,
    ``band_high``, ``base_failed`` and ``kept`` to the columns in ``keep`` (all).

    ``upper``, ``lower``: quartile distances from the median to the band's ends, and the
    nats that are allowed at least."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in
            ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_scored", "log_ppl",
             "log_sum", "band_low", "band_high", "base_failed", "kept")]
    key = "lang_key"
    while any(c.startswith(key) for c in docs.columns):
        key += "_"
    models = written(fit_models(count_grams(docs, text_col, lang_col), part_grams), "perplexity")
    sc, blocks = docs.sparkSession.sparkContext, blocks_of(models, block_entries)
    rows = docs.withColumn(key, language(lang_col))
    if len(blocks) == 1:
        scored = _score(rows, text_col, key, sc.broadcast(load_block(models, blocks[0])), [*keep, key])
    else:  # one block live at a time; a row's sums meet by the row's number
        row = key + "_row"
        rows = written(rows.select(*dict.fromkeys([*keep, text_col, key])).withColumn(row, F.monotonically_increasing_id()), "numbered")
        sums = None
        for block in blocks:
            bc = sc.broadcast(load_block(models, block))
            part = written(_score(rows.filter(F.col(key).isin(sorted({x[0] for x in block}))), text_col, key, bc, [row], stats=False), "sums")
            bc.destroy()
            sums = part if sums is None else sums.unionAll(part)
        total = sums.groupBy(row).agg(F.sum("log_sum").alias("log_sum"))
        scored = (_score(rows, text_col, key, sc.broadcast({}), [*keep, key, row]).drop("log_sum")
                  .join(total, row, "left").drop(row))
    scored = scored.withColumn("log_ppl", F.when(F.col("n_scored") > 0, F.round(-F.col("log_sum") / F.col("n_scored"), 6))).drop("log_sum")
    scored = written(scored.withColumn("base_failed", (F.col("n_words") < 50)
                                       | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))), "scored")
    band = key + "_band"
    out = scored.join(F.broadcast(bands(scored, key, upper, lower)), key, "left")
    margin = noise / F.sqrt(F.greatest("n_scored", F.lit(1)))
    out = (out.withColumn("band_low", F.col(band)["middle"] - F.col(band)["below"] - margin)
           .withColumn("band_high", F.col(band)["middle"] + F.col(band)["above"] + margin))
    inside = F.coalesce(F.col("log_ppl").between(F.col("band_low"), F.col("band_high")), F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside).drop(key, band)


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, data_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    d = quality_rules(table(spark, data_dir, "documents"), keep=["doc_id"])
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept", "log_ppl", "band_low", "band_high")
