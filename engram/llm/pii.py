"""Personal data: base patterns plus information-theoretic sanitisation.

Base spans (e-mail, IPv4, card with Luhn check, phone) are the protected
entities, at several grains: the value itself and what it belongs to (an address's domain,
an IP's network, the leading digits of a number). Around each, the ``window`` whole words
on either side form a context, however long they are and whatever stands between.
A term t discloses an entity e as far as

    PMI(t; e) / IC(e) = 1 + log P(e | t) / -log P(e)

with P(e) = texts with e / all texts and P(e | t) = texts with t near e / texts with t.
Terms seen near an entity in at least ``support`` texts whose ratio reaches
``threshold`` become spans of kind ``term`` wherever they stand. Every count is of
distinct texts and covers all documents: copies of a text count once everywhere, and
a passage shared by different texts counts in each of them.

Spark does the counting: contexts are rows (entity, text, term) summed by key
with map-side combines. A term stands in at least as many texts as it has near any
entity, so pairs whose ratio cannot reach the threshold even then go first (no
result depends on it); text counts of the other terms come from a second pass that
ships only words whose checksum is set in a 2^24-bit map of the candidates (fixed
size; the later join drops false hits). Disclosing terms are
applied in blocks of at most ``block_terms`` broadcast terms, each block one narrow pass;
a pass that is not the last is written out and its terms are released before the next one,
so a worker holds one block however many there are.

Defined results: a null or empty text has no span and stays as it is; a number
in several kinds gives a span of each; overlapping spans are replaced as one, by
the first one's label; terms that touch a base span are not reported; repeated
rows count as documents of their own; an empty table gives an empty result.
Columns named ``spans`` or ``sanitised`` give way to the added ones.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.llm.common import by_row, query, table, written

KINDS = ("email", "ip", "card", "phone", "term")
LABELS = {k: f"[{k.upper()}]" for k in KINDS}
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile("[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
SPANS = "array<struct<kind:string,start:int,end:int>>"
MAP_BITS = 24


def _emails(text: str):
    at, after, done = text.find("@"), 0, 0
    while at >= 0:
        run = text[max(done, after):at]
        local = len(run) - len(run.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at) if local else None
        if m:
            yield at - local, m.end()
            done = m.end()
        after = at + 1
        at = text.find("@", max(done, after))


def _ips(text: str):
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts = list(_PART.finditer(text, m.start(), m.end()))
        for k in range(0, len(parts) - 3, 4):
            four = [p.group().lstrip("0") for p in parts[k:k + 4]]
            if all(len(p) < 4 and int(p or 0) <= 255 for p in four):
                yield parts[k].start(), parts[k + 3].end()


def _digits(s: str) -> list[int]:
    return [ord(c) - 48 for c in s if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    total = sum(digits[-1::-2]) + sum(2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of the base kinds, sorted."""
    if not text:
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    out += [(a, 1, b) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out)


def _entities(text: str, span) -> list[str]:
    """The value and what it belongs to."""
    start, kind, end = span
    value = text[start:end]
    if kind == 0:
        value = value.lower()
        wider = value[value.index("@"):]
    elif kind == 1:
        wider = value[:value.rindex(".")]
    else:
        value = "".join(map(str, _digits(value)))
        wider = value[:6] if kind == 2 else value[:-4]
    return [f"{KINDS[kind]}:{value}", f"{KINDS[kind]} of:{wider}"]


def _around(terms: list, starts: list[int], ends: list[int], start: int, end: int, window: int) -> list[str]:
    """The ``window`` terms that end before the span and those that start after it."""
    a, b = bisect_right(ends, start), bisect_left(starts, end)
    return terms[max(0, a - window):a] + terms[b:b + window]


def _number(text: str) -> int:
    """The 64-bit number of a text: equal for copies."""
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def contexts(docs: DataFrame, text_col: str, window: int) -> DataFrame:
    """``entity, doc, terms``: a row per base span and grain of every text."""
    schema = pa.schema([("entity", pa.string()), ("doc", pa.int64()), ("terms", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                if not spans:
                    continue
                doc, found = _number(text), list(_TERM.finditer(text))
                words = [m.group().lower() for m in found]
                starts, ends = [m.start() for m in found], [m.end() for m in found]
                for s in spans:
                    near = sorted(set(_around(words, starts, ends, s[0], s[2], window)))
                    rows += [(e, doc, near) for e in _entities(text, s)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[]] * 3, schema)], schema=schema)

    return docs.select(text_col).mapInArrow(run, "entity string, doc bigint, terms array<string>")


def _document_counts(docs: DataFrame, text_col: str, bitmap) -> DataFrame:
    """``term, n``: distinct texts with each word whose checksum is set in the bit map."""
    schema = pa.schema([("term", pa.string()), ("doc", pa.int64())])
    mask = (1 << MAP_BITS) - 1

    def run(batches):
        bits, crc = bitmap.value, zlib.crc32
        for batch in batches:
            terms, owners = [], []
            for text in dict.fromkeys(batch.column(0).to_pylist()):
                found = []
                for w in set(_TERM.findall(text.lower())) if text else ():
                    k = crc(w.encode()) & mask
                    if bits[k >> 3] >> (k & 7) & 1:
                        found.append(w)
                if found:
                    terms += found
                    owners += [_number(text)] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(owners, pa.int64())], schema=schema)

    return docs.select(text_col).mapInArrow(run, "term string, doc bigint").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def disclosing_terms(docs: DataFrame, text_col: str = "text", window: int = 8, support: int = 3,
                     threshold: float = 0.9) -> DataFrame:
    """``term, ratio``: terms whose best PMI/IC over entities reaches ``threshold``."""
    ctx = written(contexts(docs, text_col, window), "contexts")
    spark = docs.sparkSession
    n_docs = docs.filter(F.col(text_col).isNotNull()).select(F.xxhash64(text_col)).distinct().count()

    def ratio(n):
        return 1 + F.log(F.least(F.lit(1.0), F.col("both") / n)) / F.greatest(F.log(n_docs / F.col("with_entity")), F.lit(1e-9))
    pairs = (ctx.select("entity", "doc", F.explode("terms").alias("term")).distinct()
             .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")).filter(F.col("both") >= support))
    in_docs = ctx.select("entity", "doc").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"))
    near = (ctx.select("doc", F.explode("terms").alias("term")).distinct()
            .groupBy("term").agg(F.count(F.lit(1)).alias("near")).filter(F.col("near") >= support))
    pairs = pairs.join(in_docs, "entity").join(near, "term").filter(ratio(F.col("near")) >= threshold)
    pairs = written(pairs.select("entity", "term", "both", "with_entity"), "pairs")
    on = pairs.select((F.crc32(F.col("term").cast("binary")) % (1 << MAP_BITS)).cast("int").alias("k")).distinct().toArrow()
    bits = np.zeros(1 << MAP_BITS >> 3, np.uint8)
    k = on.column("k").to_numpy()
    if not len(k):
        return pairs.select("term", F.lit(0.0).alias("ratio"))
    np.bitwise_or.at(bits, k >> 3, (1 << (k & 7)).astype(np.uint8))
    counts = _document_counts(docs, text_col, spark.sparkContext.broadcast(bits.tobytes()))
    return (pairs.join(counts, "term").groupBy("term").agg(F.max(ratio(F.col("n"))).alias("ratio"))
            .filter(F.col("ratio") >= threshold))


def _apply(docs: DataFrame, text_col: str, terms, first: bool, last: bool) -> DataFrame:
    def make():
        chosen = terms.value

        def fn(texts, before):
            all_spans, clean = [], []
            for text, old in zip(texts, before):
                if first:
                    spans = base_spans(text)
                else:
                    spans = [(s["start"], KINDS.index(s["kind"]), s["end"]) for s in old]
                if text and chosen and not chosen.isdisjoint(_TERM.findall(text.lower())):
                    taken = _merged(spans)
                    k = 0
                    for m in _TERM.finditer(text):
                        while k < len(taken) and taken[k][1] <= m.start():
                            k += 1
                        if m.group().lower() in chosen and not (k < len(taken) and taken[k][0] < m.end()):
                            spans.append((m.start(), 4, m.end()))
                    spans.sort()
                all_spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans])
                clean.append(_replaced(text, spans) if last else None)
            return all_spans, clean
        return fn
    return by_row(docs, [text_col, "spans"], f"spans {SPANS}, sanitised string", make)


def _merged(spans) -> list[list]:
    """Overlapping spans as one: [start, end, kind of the first]."""
    out: list[list] = []
    for a, k, b in spans:
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b, k])
    return out


def _replaced(text, spans):
    if not spans:
        return text
    parts, at = [], 0
    for a, b, k in _merged(spans):
        parts += [text[at:a], LABELS[KINDS[k]]]
        at = b
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame, text_col: str = "text", window: int = 8, support: int = 3, threshold: float = 0.9,
             block_terms: int = 500_000, keep: list[str] | None = None) -> DataFrame:
    """Add ``spans`` (kind, start, end in code points, end exclusive; by start, then
    kind) and ``sanitised`` (the text with every span replaced by its kind's label)."""
    terms = written(disclosing_terms(docs, text_col, window, support, threshold), "terms").select("term")
    n = max(1, -(-terms.count() // block_terms))
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("spans", "sanitised")]
    d = docs.select(*dict.fromkeys([*kept, text_col])).withColumn("spans", F.lit(None).cast(SPANS))
    for k in range(n):
        block = frozenset(r["term"] for r in terms.filter(F.pmod(F.xxhash64("term"), F.lit(n)) == k).collect())
        held = docs.sparkSession.sparkContext.broadcast(block)
        d = _apply(d, text_col, held, k == 0, k == n - 1)
        if k < n - 1:
            d = written(d, "pii-pass")
            held.destroy()
    return d.select(*kept, "spans", "sanitised")


@query("op8_pii")
def op8_pii(spark: SparkSession, data_dir: str) -> DataFrame:
    """Spans of every document: base counts and digest, and all spans."""
    d = sanitise(table(spark, data_dir, "documents").select("doc_id", "text"), keep=["doc_id"])

    def joined(kinds):
        part = f"filter(spans, s -> s.kind IN ({', '.join(map(repr, kinds))}))"
        return F.expr(f"array_join(transform({part}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")

    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return d.select("doc_id", *counts[:4], F.sha2(joined(KINDS[:4]).cast("binary"), 256).alias("base_sha256"),
                    joined(KINDS).alias("spans"), counts[4])
