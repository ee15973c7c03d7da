"""URL filters: rules first, then naive Bayes over segmented host and path tokens.

Host names are cut at dots and non-letters; each distinct piece is segmented into
words by a unigram Viterbi search. The unigram counts are the words that stand
alone in the urls (path tokens, parts of hyphenated names), counted by Spark over
all rows, plus a stated lexicon. Candidate words of a piece come from a join of its
substrings (at most ``MAX_WORD`` characters) with the counts, so the vocabulary may
grow without bound; only one piece's matches are ever together.

Naive Bayes: pages whose tokens contain a word of ``seeds`` are the blocked class,
all others the allowed one; multinomial counts of tokens, hashed into ``BUCKETS``,
are summed by Spark over all pages. The weights (bounded by ``BUCKETS``) are
broadcast, and every page is scored: log prior plus the tokens' log ratios.

Defined results: a null url or one without ``://`` has an empty host and path, no
tokens and no rule; the method allows it. A rule fits its host and all subdomains
if the path starts with the rule's path (an empty path does not start with ``/``);
of several the longest wins, blocks first on ties. Repeated rows are judged alike;
without any seeded page everything is allowed; columns named like an added one give
way to it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.llm.common import by_row, query, table, written

MAX_WORD, BUCKETS, SALTS = 20, 1 << 18, 16
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Words that mark unwanted sites (fixed values, a parameter of the operator).
SEEDS = ("adult", "ads", "adserver", "bet", "bets", "betting", "bingo", "casino", "cheap", "escort", "gambling",
         "jackpot", "loans", "lottery", "malware", "phishing", "pills", "poker", "porn", "roulette", "sex", "slots",
         "spam", "track", "tracker", "viagra", "warez", "xxx")
#: Ordinary words of site names (fixed values), so that names split where people would.
LEXICON = ("about", "app", "archive", "art", "best", "blog", "book", "books", "buy", "card", "cars", "city", "click",
           "cloud", "code", "credit", "daily", "data", "deal", "deals", "design", "digital", "doc", "docs", "farm",
           "film", "find", "food", "forum", "free", "fun", "game", "games", "garden", "get", "global", "group", "health",
           "help", "home", "hot", "house", "info", "job", "jobs", "lab", "law", "learn", "life", "line", "link",
           "live", "local", "love", "mail", "man", "map", "market", "media", "mobile", "money", "music", "net", "new",
           "news", "now", "online", "page", "pages", "party", "pay", "photo", "play", "press", "pro", "radio", "real",
           "review", "sale", "school", "science", "search", "shop", "site", "social", "sport", "star", "store", "story",
           "super", "tech", "the", "time", "times", "tools", "top", "town", "travel", "tube", "video", "web", "wiki",
           "win", "wins", "world", "your", "zone")


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict of the rule): the longest fitting rule, blocks first on ties."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rhost, rpath in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "block")):
        fits = ((host == rhost) | host.endswith("." + rhost)) & path.startswith(rpath)
        name, verdict = F.when(fits, rhost + rpath).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _letters(c: Column) -> Column:
    """Lower-case letter runs; digit runs become ``#``."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), r"[0-9]+", " # "), r"[^\p{L}#]+"), lambda t: t != "")


def word_counts(urls: DataFrame, lexicon, weight: int) -> DataFrame:
    """``word, n``: words standing alone in paths and hyphenated names, and the lexicon."""
    parts = F.flatten(F.transform(F.filter(F.split("host", r"\."), lambda x: x.contains("-")), _letters))
    seen = (urls.select(F.explode(F.concat(_letters(F.col("path")), parts)).alias("word"))
            .filter((F.length("word") > 1) & (F.length("word") <= MAX_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    known = urls.sparkSession.createDataFrame([(w, weight) for w in sorted(set(lexicon))], "word string, n bigint")
    return seen.unionAll(known).groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(piece: str, found: dict[tuple[int, int], float], total: float) -> list[str]:
    """Best split of ``piece``; ``found``: (start, length) -> count. Unknown words cost a
    factor of ten a letter; on equal scores the longer last word wins."""
    best, back = [0.0], [0]
    log_total = math.log(total)
    for end in range(1, len(piece) + 1):
        top, arg = -math.inf, 0
        for start in range(max(0, end - MAX_WORD), end):
            n = found.get((start, end - start))
            s = best[start] + (math.log(n) if n else math.log(10) * (1 - (end - start))) - log_total
            if s > top + 1e-12:
                top, arg = s, start
        best.append(top)
        back.append(arg)
    out, end = [], len(piece)
    while end:
        out.append(piece[back[end]:end])
        end = back[end]
    return out[::-1]


def segmented_hosts(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """``host, words``: words of every distinct host, in order."""
    hosts = urls.select("host").filter("host <> ''").distinct()
    placed = hosts.select("host", F.posexplode(_letters(F.col("host"))).alias("at", "piece"))
    pieces = placed.select("piece").distinct()
    subs = (pieces.select("piece", F.explode(F.expr("sequence(0, length(piece) - 1)")).alias("start"))
            .select("piece", "start", F.explode(F.expr(f"sequence(1, least({MAX_WORD}, length(piece) - start))")).alias("len")))
    subs = subs.withColumn("word", F.expr("substring(piece, start + 1, len)")).filter("len > 1")
    hits = (subs.join(counts, "word").groupBy("piece")
            .agg(F.collect_list(F.struct("start", "len", "n")).alias("found")))
    total = float(counts.agg(F.sum("n")).head()[0] or 1)

    def make():
        def fn(texts, found):
            return ([viterbi(p, {(f["start"], f["len"]): f["n"] for f in fs or ()}, total) for p, fs in zip(texts, found)],)
        return fn
    split = by_row(pieces.join(hits, "piece", "left"), ["piece", "found"], "words array<string>", make, keep=["piece"])
    return (placed.join(split, "piece").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("w"))
            .select("host", F.flatten(F.col("w.words")).alias("words")))


def naive_bayes(tokens: DataFrame, seeds, alpha: float = 0.1) -> tuple[float, np.ndarray] | None:
    """Log prior odds and log ratio of every bucket (block over allow); None without a seeded page."""
    blocked = F.arrays_overlap("tokens", F.array(*map(F.lit, seeds)))
    t = tokens.withColumn("y", F.coalesce(blocked, F.lit(False)).cast("int"))
    pages = {r["y"]: r["n"] for r in t.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not pages.get(1) or not pages.get(0):
        return None
    sums = (t.select("y", F.explode("tokens").alias("t")).groupBy("y", (F.crc32(F.col("t").cast("binary")) % BUCKETS).cast("int").alias("k"))
            .agg(F.count(F.lit(1)).alias("n")).toArrow())
    n = np.zeros((2, BUCKETS))
    n[sums.column("y").to_numpy(), sums.column("k").to_numpy()] = sums.column("n").to_numpy()
    used = (n.sum(0) > 0).sum()  # every token that can be asked for has been counted
    p = (n + alpha) / (n.sum(1, keepdims=True) + alpha * used)
    return math.log(pages[1] / pages[0]), np.log(p[1] / p[0])


def url_filter(pages: DataFrame, url_col: str = "url", rules=RULES, seeds=SEEDS, lexicon=LEXICON, lexicon_weight: int = 100,
               threshold: float = 0.0, keep: list[str] | None = None) -> DataFrame:
    """Add ``host, path, rule, verdict, score`` (log odds of block) and ``words``."""
    added = ("host", "path", "rule", "verdict", "score", "words", "tokens")
    kept = [c for c in (pages.columns if keep is None else keep) if c not in added]
    d = pages.select(*kept, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = d.select("host", "path")
    hosts = segmented_hosts(urls, written(word_counts(urls, [*lexicon, *seeds], lexicon_weight), "words"))
    salted = hosts.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    d = d.withColumn("_salt", F.pmod(F.xxhash64("path", *[c for c in kept if c != url_col][:1]), F.lit(SALTS)))
    no_words = F.array().cast("array<string>")
    j = (d.join(salted, ["host", "_salt"], "left").withColumn("words", F.coalesce("words", no_words))
         .withColumn("tokens", F.concat("words", _letters(F.col("path")))).drop("_salt"))
    j = written(j.select(*kept, "host", "path", "words", "tokens"), "url_tokens")
    bc = pages.sparkSession.sparkContext.broadcast(naive_bayes(j, seeds))

    def make():
        from zlib import crc32

        model = bc.value

        def fn(tokens):
            if model is None:
                return ([None] * len(tokens),)
            prior, ratio = model
            return ([round(prior + sum(ratio[crc32(t.encode()) % BUCKETS] for t in ts), 6) if ts else None for ts in tokens],)
        return fn
    out = by_row(j, ["tokens"], "score double", make, keep=[*kept, "host", "path", "words"])
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") > threshold, "block").otherwise("allow")
    return out.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, own))


@query("op1_url_filter")
def op1_url_filter(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rule and verdict of every page url."""
    d = url_filter(table(spark, data_dir, "pages").select("page_id", "url"), keep=["page_id"])
    return d.select("page_id", "host", "path", "rule", "verdict", "score", F.array_join("words", " ").alias("host_words"))
