"""Spelling variants: words one edit apart, found by blocked Gram matrices.

1. A word's letter counts form a vector. One inserted or deleted letter moves it by a
   squared distance of 1, one replaced letter by 2 (0 if both letters share a
   counter), so near words are at most 2 apart and their lengths differ by at most 1.
2. Blocks: the alphabet is cut into ``k`` classes of about equal use (``k`` grows with
   the logarithm of the vocabulary) and a block holds the words of one length and
   one count per class. A word joins the block of its own counts (side 0) and, for
   each class it has letters of, the block of the words with one letter less (side =
   class + 1). Two near words meet in exactly one block: a word and one with a
   letter more on sides 0 and i, two words that differ by a letter of different
   classes on sides i < j, two with equal counts on side 0.
3. Inside a block a NumPy product of the count vectors (row strips of a Gram matrix)
   gives all squared distances; pairs of at most 2 are verified letter by letter.
   Blocks over ``LIMIT`` members are dealt into chunks, and every pair of chunks is
   a block of its own, so no task holds more than two chunks' worth and no pair is lost.
4. Each block reports one row per word (near words, best form), never the pairs.
   Roots follow from the forms by pointer doubling (a form has ``ratio`` times the
   occurrences, so a chain of d forms needs n >= ratio^d).

Defined results: null and empty texts have no words; repeated rows count every time;
a null document id counts as an empty one where the id is read; text columns of any
length are read whole; an empty table gives an empty result; columns of the input
other than the two named ones are never read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.llm.common import query, table, written
from engram.session import ship_package

#: Letters of a run.
LETTERS = "A-Za-zÀ-ÿ"
COUNTERS = 90               # letter counters of a vector: a-z and U+00C0..U+00FF; others share them
LIMIT = 4096                # members of a block
STRIP = 1024                # rows of a Gram strip
PAIR_CELLS = 1 << 21        # letters compared at once
MAX_BROADCAST_BLOCKS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def corpus_words(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_len: int = 7, min_count: int = 2,
                 change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(word, n): maximal letter runs, A-Z lower-cased, of at least ``min_len`` letters
    that occur ``min_count`` times. ``change(id, run)`` may alter an occurrence before
    it is counted; what it makes shorter than ``min_len`` goes. Counts combine before
    the exchange, so a frequent word costs one row a task."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(
        F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{min_len},}}"), F.lit(0))).alias("run"))
    run = F.translate(F.col("run"), UPPER, LOWER)
    word = run if change is None else change(F.coalesce(F.col("id").cast("string"), F.lit("")), run)
    return (runs.select(word.alias("word")).filter(F.length("word") >= min_len)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def letter_classes(words: DataFrame, k: int, most: int = 256) -> list[str]:
    """The ``most`` commonest letters dealt into ``k`` classes of about equal use; letters
    beyond them belong to the last class, whose list is not needed."""
    top = (words.select(F.explode(F.split("word", "")).alias("c")).filter(F.col("c") != "")
           .groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "c").limit(most).collect())
    load, classes = [0] * k, [""] * k
    for r in top:
        i = load.index(min(load))
        classes[i] += r["c"]
        load[i] += r["n"]
    return classes


def blocks(words: DataFrame, k: int) -> DataFrame:
    """(block, side, word, n): every word in each block it belongs to."""
    classes = letter_classes(words, k)
    length = F.length("word")
    w = words
    for i, letters in enumerate(classes[:-1]):
        left = F.length(F.translate(F.col("word"), letters, "")) if letters else length
        w = w.withColumn(f"c{i}", (length - left).cast("int"))
    w = w.withColumn(f"c{k - 1}", (length - sum((F.col(f"c{i}") for i in range(k - 1)), F.lit(0))).cast("int"))

    def of(i: int) -> Column:
        return F.concat_ws(",", *[F.col(f"c{j}") - 1 if j == i else F.col(f"c{j}") for j in range(k)])

    sides = [F.struct(of(-1).alias("block"), F.lit(0).cast("smallint").alias("side"))]
    sides += [F.when(F.col(f"c{i}") > 0, F.struct(of(i).alias("block"), F.lit(i + 1).cast("smallint").alias("side")))
              for i in range(k)]
    return (w.select("word", "n", F.explode(F.filter(F.array(*sides), lambda s: s.isNotNull())).alias("s"))
            .select("s.block", "s.side", "word", "n"))


def chunked(members: DataFrame, limit: int) -> DataFrame:
    """Deal members of blocks over ``limit`` into chunks; each pair of chunks becomes a block."""
    sizes = members.groupBy("block").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > limit)
    large = written(sizes.select("block", F.ceil(F.col("size") * 2 / limit).cast("int").alias("m")), "variant-blocks")
    n = large.count()
    if not n:
        return members.withColumn("chunk", F.lit(0))
    m = members.join(F.broadcast(large) if n <= MAX_BROADCAST_BLOCKS else large, "block", "left")
    m = m.withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("word"), F.col("m")).cast("int"), F.lit(0)))
    pair = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("m"), F.lit(1)) - 1)).alias("x")
    return m.select("*", pair).select(
        F.when(F.col("m").isNull(), F.col("block")).otherwise(F.concat_ws(
            ":", "block", F.least("chunk", "x"), F.greatest("chunk", "x"))).alias("block"),
        "side", "word", "n", "chunk")


class _Words:
    """Letters and counters of a list of words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.at = np.concatenate(([0], np.cumsum(self.length)))
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        row = np.repeat(np.arange(len(words)), self.length)
        slot = np.where(self.flat < 192, self.flat - 97, self.flat - 166) % COUNTERS
        self.counts = np.bincount(row * COUNTERS + slot,
                                  minlength=len(words) * COUNTERS).reshape(-1, COUNTERS).astype(np.float32)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Exactly one edit between words i and j (len j - len i is 0 or 1, or the reverse)."""
        out = np.zeros(len(i), bool)
        if not len(i):
            return out
        swap = self.length[i] > self.length[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        n, longer = self.length[i], self.length[j] - self.length[i]
        for size, more in {*zip(n.tolist(), longer.tolist())}:
            if more > 1:
                continue
            here = np.flatnonzero((n == size) & (longer == more))
            step = max(1, PAIR_CELLS // max(1, size))
            for s in range(0, len(here), step):
                h = here[s:s + step]
                a = self.flat[self.at[i[h]][:, None] + np.arange(size)]
                b = self.flat[self.at[j[h]][:, None] + np.arange(size + more)]
                if more:
                    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
                    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
                    out[h] = head + tail >= size
                else:
                    out[h] = (a != b).sum(1) == 1
        return out


def block_pairs(w: _Words, lo: int, hi: int, side: np.ndarray, chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (row numbers) of the block in rows lo..hi."""
    x = w.counts[lo:hi]
    sq = np.einsum("ij,ij->i", x, x)
    crossing = chunk[lo:hi].min() != chunk[lo:hi].max()
    left, right = [], []
    for at in range(0, hi - lo, STRIP):
        d = x[at:at + STRIP] @ x[at:].T
        d *= -2
        d += sq[at:at + STRIP, None]
        d += sq[None, at:]
        i, j = np.nonzero(d <= 2)
        i, j = i[i < j] + lo + at, j[i < j] + lo + at
        ok = (side[i] == 0) & (side[j] == 0) | (side[i] != side[j])
        if crossing:
            ok &= chunk[i] != chunk[j]
        left.append(i[ok])
        right.append(j[ok])
    i, j = np.concatenate(left), np.concatenate(right)
    good = w.near(i, j)
    return i[good], j[good]


def _best(w: _Words, n: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Per word of the pairs: near words and the one of largest n (ties: smallest)."""
    me, other = np.concatenate((i, j)), np.concatenate((j, i))
    used = np.unique(other)
    rank = np.empty(len(w.words), np.int64)
    rank[sorted(used.tolist(), key=w.words.__getitem__)] = np.arange(len(used))
    order = np.lexsort((rank[other], -n[other], me))
    me, other = me[order], other[order]
    start = np.flatnonzero(np.concatenate(([True], me[1:] != me[:-1])))
    return me[start], np.diff(np.concatenate((start, [len(me)]))), other[start]


_REPORT = "word string, n_near bigint, best_n bigint, best string"


def _reports(batches):
    """Rows sorted by block in; (word, n_near, best_n, best) of each block out. Rows of the
    last block of a batch wait for the next batch; a block is bounded by ``LIMIT``."""
    kept = None

    def done(t: pa.Table):
        if not t.num_rows:
            return
        t = t.combine_chunks()
        key = t.column("block").combine_chunks().dictionary_encode()
        key = (key.chunk(0) if isinstance(key, pa.ChunkedArray) else key).indices.to_numpy(zero_copy_only=False)
        cut = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        side, chunk, n = (t.column(c).to_numpy() for c in ("side", "chunk", "n"))
        w = _Words(t.column("word").to_pylist())
        pairs = [block_pairs(w, lo, hi, side, chunk) for lo, hi in zip(cut[:-1], cut[1:]) if hi - lo > 1]
        # blocks have rows of their own, so one pass gives every block's report
        i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*pairs) if pairs else ((), ())))
        if len(i):
            me, near, best = _best(w, n, i, j)
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.words[x] for x in me.tolist()], pa.string()), pa.array(near, pa.int64()),
                 pa.array(n[best], pa.int64()), pa.array([w.words[x] for x in best.tolist()], pa.string())],
                names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if kept is not None:
            t = pa.concat_tables([kept, t])
        blocks_ = t.column("block")
        last, lo = blocks_[t.num_rows - 1].as_py(), t.num_rows - 1
        while lo > 0 and blocks_[lo - 1].as_py() == last:
            lo -= 1
        yield from done(t.slice(0, lo))
        kept = t.slice(lo)
    if kept is not None:
        yield from done(kept)


def near_words(words: DataFrame, limit: int = LIMIT, k: int | None = None) -> DataFrame:
    """(word, n_near, best_n, best): words with near words, their number and the near word
    of largest n (ties: smallest in code-point order). ``words``: distinct (word, n)."""
    ship_package(words.sparkSession)
    if k is None:
        k = min(24, max(4, round(float(np.log2(max(2, words.count())))) - 12))
    m = chunked(blocks(words, k), limit)
    found = m.repartition("block").sortWithinPartitions("block", "side", "chunk").mapInArrow(_reports, _REPORT)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("best")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best")))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by pointer doubling. Forms
    never lead in a circle (each has more occurrences than the one before)."""
    step = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = written(step.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "variant-roots")
        step = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return step


def spelling_variants(words: DataFrame, ratio: int = 10, limit: int = LIMIT, k: int | None = None) -> DataFrame:
    """Group the spelling variants of a vocabulary.

    ``words``: distinct (word, n). Adds ``n_near``, ``form`` (its near word of largest n if
    that has at least ``ratio`` times its occurrences), ``form_n`` and ``root``."""
    w = written(words.select("word", "n"), "variant-words")
    near = w.join(near_words(w, limit, k), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    typed = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")),
                    "variant-forms")
    return (typed.join(roots_of(typed.filter("form is not null")), "word", "left")
            .withColumn("root", F.coalesce("root", "word")))


def delete_a_letter(every: int) -> Callable[[Column, Column], Column]:
    """An occurrence loses the letter at crc32 % length if ``every`` divides the crc32 of
    ``<id>:<run>``."""
    def change(doc_id: Column, run: Column) -> Column:
        h = F.crc32(F.concat(doc_id, F.lit(":"), run))
        at = F.pmod(h, F.length(run)).cast("int")
        return F.when(h % every == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)
    return change


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per word of the whole corpus: form, root and near words."""
    words = corpus_words(table(spark, data_dir, "documents").select("doc_id", "text"), change=delete_a_letter(31))
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")
