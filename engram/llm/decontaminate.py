"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Normalisation: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` (ASCII
letters and digits plus everything beyond ASCII). A window is ``size`` consecutive
words of an item; a shorter item that has words is one window of its own length.

Training texts are scanned in one narrow pass: words become 64-bit hashes, windows whose
words all occur in items get a rolling hash, hashes found in the sorted set are verified
against the items' words themselves, and verified windows mark their words. Nothing is
shuffled. The set is kept in flat arrays (the items' normalised text, where its words
start, sorted window hashes with their places), some 4 bytes a byte of item text. It is
bounded by ``block_bytes`` of item text: a larger benchmark is split by item hash into
blocks, scanned one after another; each pass but the last is written out and its set
released before the next, so a worker holds one block however many there are.

Defined results: a null, empty or wordless text has no words and no hits; items
with a null or wordless text have no window; a null item id counts as the empty id; repeated items and documents each
count on their own; an empty benchmark leaves every document clean; documents
columns named like an added column give way to it.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from engram.llm.common import by_row, query, table, written

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_NOT_WORD = bytes(32 if b < 0x30 or 0x39 < b < 0x61 or 0x7a < b < 0x80 else b for b in range(256))
_MULT = np.uint64(0x9E3779B97F4A7C15)
COLUMNS = ("n_words", "n_hit", "hit_items", "hit_spans", "contaminated")


def words_of(text: str | None) -> list[bytes]:
    """Normalised words as UTF-8 bytes."""
    return text.encode().lower().translate(_NOT_WORD).split() if text else []


class WindowSet:
    """Windows of a block of items in flat arrays: the normalised words of all items as one
    text, the place of each word, and per window length the sorted hashes with the number
    of the word each window starts at."""

    def __init__(self, items: list[tuple[str, str | None]], size: int):
        self.names, parts, lengths, first = [], [], [], [0]
        for item, text in items:
            words = words_of(text)
            if words:
                self.names.append(item)
                parts.append(b" ".join(words))
                lengths.append(np.fromiter(map(len, words), np.int32, len(words)))
                first.append(first[-1] + len(words))
        self.text, self.first = b" ".join(parts), np.array(first, np.int64)
        n = int(self.first[-1])
        self.at = np.zeros(n + 1, np.int64)
        if n:
            np.cumsum(np.concatenate(lengths) + 1, out=self.at[1:])
        self.at = self.at.astype(np.int32 if len(self.text) < 2 ** 31 - 2 else np.int64)
        h = np.fromiter(map(xxh3_64_intdigest, self.text.split()), np.uint64, n)
        self.vocab, self.windows = np.unique(h), {}
        counts = np.diff(self.first)
        for length in np.unique(np.minimum(counts, size)).tolist():
            mine = counts >= size if length == size else counts == length
            start = np.concatenate([np.arange(a, a + c - length + 1) for a, c in zip(self.first[:-1][mine], counts[mine])])
            key = self._hash([h[start + k] for k in range(length)])
            order = np.argsort(key, kind="stable")
            self.windows[length] = key[order], start[order].astype(np.int32 if n < 2 ** 31 else np.int64)
        self._known: dict[tuple, frozenset] = {}

    def __getstate__(self):
        return self.__dict__ | {"_known": {}}

    def __bool__(self) -> bool:
        return bool(self.names)

    @staticmethod
    def _hash(columns) -> np.ndarray:
        h = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            h = (h + c) * _MULT
            h ^= h >> np.uint64(29)
        return h

    def _items(self, key: int, length: int, window: bytes) -> frozenset:
        """Items that hold the window, word by word. Answers are kept while they are few."""
        found = self._known.get((length, window))
        if found is None:
            keys, start = self.windows[length]
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            places = [p for p in start[lo:hi].tolist() if self.text[self.at[p]:self.at[p + length] - 1] == window]
            found = frozenset(self.names[i] for i in np.searchsorted(self.first, places, "right") - 1) if places else frozenset()
            if len(self._known) >= 10_000:
                self._known.clear()
            self._known[length, window] = found
        return found

    def scan(self, words: list[bytes]):
        """Yield (start, length, items) of each verified window in ``words``."""
        n = len(words)
        if not n or not self:
            return
        h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
        known = self.vocab[np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)] == h
        unknown = np.concatenate(([0], np.cumsum(~known)))
        for size, (keys, _) in self.windows.items():
            if size > n:
                continue
            at = np.flatnonzero(unknown[size:] == unknown[:n - size + 1])
            if not len(at):
                continue
            key = self._hash([h[at + k] for k in range(size)])
            hit = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
            for i, k in zip(at[hit].tolist(), key[hit]):
                items = self._items(k, size, b" ".join(words[i:i + size]))
                if items:
                    yield i, size, items


def _scan_pass(docs: DataFrame, text_col: str, bc, first: bool) -> DataFrame:
    def make():
        windows = bc.value

        def fn(texts, counts, hit_words, hit_items):
            n_words, marks, found = [], [], []
            for text, count, old, old_items in zip(texts, counts, hit_words, hit_items):
                words = words_of(text)
                hit, items = set(old or ()), set(old_items or ())
                for i, size, names in windows.scan(words):
                    hit.update(range(i, i + size))
                    items |= names
                n_words.append(len(words) if first else count)
                marks.append(sorted(hit))
                found.append(sorted(items))
            return n_words, marks, found
        return fn
    return by_row(docs, [text_col, "_n", "_hit", "_items"],
                  "_n bigint, _hit array<int>, _items array<string>", make)


def _spans(docs: DataFrame, text_col: str) -> DataFrame:
    def make():
        def fn(texts, marks):
            out = []
            for text, hit in zip(texts, marks):
                spans, last = [], -2
                if hit:
                    at = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
                    for w in hit:
                        if w == last + 1:
                            spans[-1]["end"] = at[w][1]
                        else:
                            spans.append({"start": at[w][0], "end": at[w][1]})
                        last = w
                out.append(spans)
            return (out,)
        return fn
    return by_row(docs, [text_col, "_hit"], "hit_spans array<struct<start:int,end:int>>", make)


_LOWER = {c: c + 32 for c in range(65, 91)}


def window_blocks(bench: DataFrame, item_col: str, text_col: str, size: int,
                  block_bytes: int) -> list[WindowSet]:
    """Window sets of at most about ``block_bytes`` of item text each (a single
    longer item makes its own block), read from Spark block by block."""
    b = bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    total = b.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        rows = b.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect() if n > 1 else b.collect()
        ws = WindowSet([(r["item"], r["text"]) for r in rows], size)
        if ws:
            yield ws


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  bench_text_col: str = "text", size: int = 10, block_bytes: int = 32 << 20,
                  action: str = "annotate", spans: bool = True) -> DataFrame:
    """Find test passages in training texts.

    ``action``: ``annotate`` adds ``n_words, n_hit, hit_items, hit_spans, contaminated``
    (spans are code points of the text; left out with ``spans=False``);
    ``remove_documents`` returns the input columns of clean rows only;
    ``remove_spans`` returns all rows with hit passages cut out of the text.
    """
    added = [c for c in (*COLUMNS, "_n", "_hit", "_items") if c in docs.columns and c != text_col]
    base = docs.drop(*added) if action == "annotate" else docs
    d = (base.withColumn("_n", F.lit(None).cast("bigint")).withColumn("_hit", F.lit(None).cast("array<int>"))
         .withColumn("_items", F.lit(None).cast("array<string>")))
    sc, first = docs.sparkSession.sparkContext, True
    held = None
    for ws in window_blocks(bench, item_col, bench_text_col, size, block_bytes):
        if held is not None:
            d = written(d, "benchmark-pass")
            held.destroy()
        held = sc.broadcast(ws)
        d, first = _scan_pass(d, text_col, held, first), False
    if first:
        d = _scan_pass(d, text_col, sc.broadcast(WindowSet([], size)), True)
    if action == "remove_documents":
        return d.filter(F.size("_hit") == 0).select(*docs.columns)
    if action == "remove_spans":
        d = _spans(d, text_col)
        cut = F.expr("concat(" + f"array_join(transform(hit_spans, (s, i) -> substring(`{text_col}`, "
                     "if(i = 0, 0, hit_spans[i - 1].end) + 1, s.start - if(i = 0, 0, hit_spans[i - 1].end))), ''), "
                     f"substring(`{text_col}`, element_at(hit_spans, -1).end + 1))")
        return d.withColumn(text_col, F.when(F.size("_hit") > 0, cut).otherwise(F.col(text_col))).select(*docs.columns)
    if spans:
        d = _spans(d, text_col)
    return (d.withColumn("n_words", F.col("_n")).withColumn("n_hit", F.size("_hit").cast("bigint"))
            .withColumn("hit_items", F.col("_items")).withColumn("contaminated", F.size("_hit") > 0)
            .drop("_n", "_hit", "_items"))


_SQL_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

SQL_OP10 = rf"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS g
        FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g FROM (
        SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, dw.n AS n, item FROM dw JOIN win ON dw.n = win.n AND dw.g = win.g),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
        SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op10_decontaminate", SQL_OP10)
def op10_decontaminate(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per document: hit words and the items they come from."""
    d = decontaminate(table(spark, data_dir, "documents").select("doc_id", "text"),
                      table(spark, data_dir, "benchmark"), spans=False)
    return d.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")
