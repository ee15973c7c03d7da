"""MinHash near-duplicate groups by an LSH forest.

1. One pass over the texts makes each document's shingle set, a 128-bit key of the
   set and ``HASHES`` 16-bit minima. Equal keys are one class (exact copies); from
   here on one representative per class moves, so copies cost nothing more.
2. Forest: each of ``TREES`` orders reads ``DEPTH`` minima of the signature in its
   own sequence. Representatives that share the first ``BASE`` minima of an order
   form a region. A region of at most ``SMALL`` members yields all its pairs. A
   larger one goes deeper: members are chained to the neighbours with the longest
   common prefix (same full key, in blocks of about ``SMALL``), and each is paired
   with the region's hub, the member that carries the region's commonest key in
   most orders. (For similarity 0.8 a pair shares no region of 40 orders with
   depth 5 with a probability of about 1e-7 for independent orders.)
3. Pairs are judged by their signatures first (estimates under ``cut`` go: 4.5
   standard deviations below the threshold), then confirmed on the full sets of
   the two texts: every class tries its two best pairs, linked classes merge, then all
   pairs that still cross components are confirmed. Last, members of a large region
   that are outside the region's main component, the strays, meet all members of other
   components in cells of a block of members and a block of strays (``stray_links``), so
   chains and hubs lose no link and no list of all pairs is ever written. Only strays are
   copied to several blocks; cells compare signatures first, and texts travel only for
   rows that have a pair above the estimate.
4. Components: min-label propagation with pointer jumping over the confirmed links;
   each round's table is written to the shared folder.

Nothing is collected to the driver but counts. Groups that are collected (small
regions, blocks of a chain) hold about ``SMALL`` ids; hot regions are handled by
aggregates and joins that Spark can split.

Defined results: a document without words (null or empty text included) has an
empty set, is linked with nothing and stays; with fewer words than ``size`` the
whole sequence is one shingle; rows are judged by their text, so rows that repeat
an id with equal text share everything, and rows with a null id belong to their
text's component (smallest known id, null if there is none); an empty table gives
an empty result; columns named like an added column give way to it.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from engram.llm.common import by_row, query, table, written

HASHES, TREES, DEPTH, BASE, SMALL = 200, 40, 8, 5, 8
#: Members and shingles of a block of a large region (a task holds two blocks at once).
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
_SEED = np.random.default_rng(20)
_A = (_SEED.integers(1, 1 << 32, HASHES, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
_B = _SEED.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
#: Orders share none of the minima that make their regions; the deeper ones come from others.
_ORDERS = np.array([np.concatenate((own, _SEED.permutation(np.setdiff1d(np.arange(HASHES), own))[:DEPTH - BASE]))
                    for own in _SEED.permutation(HASHES).reshape(TREES, BASE)])
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    from xxhash import xxh3_64_intdigest

    words = text.encode().lower().split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, n)
    w = min(size, n)
    s = np.full(n - w + 1, w, np.uint64)
    for k in range(w):
        s = _mix(s + h[k:n - w + 1 + k])
    return np.unique(s)


def signature(s: np.ndarray) -> bytes:
    """``HASHES`` 16-bit values of the minima of a set."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = s.astype(np.uint32)[None, :]
    for at in range(0, x.shape[1], 2048):
        part = _A * x[:, at:at + 2048]
        part += _B
        np.minimum(low, part.min(1), out=low)
    return (low ^ (low >> np.uint32(16))).astype("<u2").tobytes()


def _key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, text_col: str, size: int, keep: list[str]) -> DataFrame:
    """Add ``n_shingles, cls`` (key of the set, null if empty) and ``sig``."""
    def make():
        def fn(texts):
            sets = [shingles(t, size) for t in texts]
            return ([len(s) for s in sets], [_key(s) if len(s) else None for s in sets],
                    [signature(s) if len(s) else None for s in sets])
        return fn
    return by_row(docs, [text_col], "n_shingles bigint, cls binary, sig binary", make, keep=keep)


def forest(reps: DataFrame) -> DataFrame:
    """``tree, region, key, cls, n_shingles, n, total``: rows of regions with at least two
    members, and the region's members and shingles."""
    def make():
        def fn(sigs):
            rows = np.frombuffer(b"".join(sigs), "<u2").reshape(len(sigs), HASHES)[:, _ORDERS]
            flat, step = rows.tobytes(), 2 * DEPTH
            return ([[flat[a:a + step] for a in range(k, k + TREES * step, step)]
                     for k in range(0, len(flat), TREES * step)],)
        return fn
    keyed = by_row(reps, ["sig"], "keys array<binary>", make, keep=["cls", "n_shingles"])
    rows = (keyed.select("cls", "n_shingles", F.posexplode("keys").alias("tree", "key")).withColumn("tree", F.col("tree").cast("tinyint"))
            .withColumn("region", F.substring("key", 1, 2 * BASE)))
    sizes = (rows.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
             .filter("n > 1"))
    return rows.join(sizes, ["tree", "region"])


def _pairs_of(ids: str, chain: bool) -> F.Column:
    """Pairs of a sorted array: neighbours only, or all."""
    reach = "1" if chain else f"size({ids})"
    return F.explode(F.expr(f"flatten(transform({ids}, (x, i) -> transform(slice({ids}, i + 2, {reach}), "
                            "y -> struct(x as a, y as b))))"))


def candidates(rows: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of classes from small regions, chains and hubs."""
    region = ["tree", "region"]
    small = (rows.filter(F.col("n") <= SMALL).groupBy(*region).agg(F.array_sort(F.collect_list("cls")).alias("ids"))
             .select(_pairs_of("ids", False).alias("p")))
    large = rows.filter(F.col("n") > SMALL)
    by_key = large.groupBy(*region, "key").agg(F.count(F.lit(1)).alias("same"))
    split = (large.join(by_key, [*region, "key"])
             .withColumn("part", F.pmod(F.xxhash64("cls"), F.ceil(F.col("same") / SMALL))))
    chains = (split.groupBy(*region, "key", "part").agg(F.array_sort(F.collect_list("cls")).alias("ids"))
              .select(_pairs_of("ids", True).alias("p")))
    common = by_key.groupBy(*region).agg(F.max_by("key", F.struct("same", "key")).alias("key"))
    score = large.join(common, [*region, "key"]).groupBy("cls").agg(F.count(F.lit(1)).alias("score"))
    hubs = (large.join(score, "cls").groupBy(*region).agg(F.max_by("cls", F.struct("score", "cls")).alias("hub")))
    to_hub = (large.join(hubs, region).filter(F.col("cls") != F.col("hub"))
              .select(F.struct(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).alias("p")))
    return small.unionAll(chains).unionAll(to_hub).select("p.a", "p.b").distinct()


def estimated(pairs: DataFrame, reps: DataFrame, cut: float, threshold: float) -> DataFrame:
    """Pairs whose sizes allow a link and whose signatures agree in at least ``cut``."""
    a = reps.select(F.col("cls").alias("a"), F.col("sig").alias("sig_a"), F.col("n_shingles").alias("n_a"))
    b = reps.select(F.col("cls").alias("b"), F.col("sig").alias("sig_b"), F.col("n_shingles").alias("n_b"))
    j = pairs.join(a, "a").join(b, "b").filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (threshold - 1e-9))

    def make():
        def fn(x, y):
            if not x:
                return ([],)
            u, v = (np.frombuffer(b"".join(s), "<u2").reshape(len(s), HASHES) for s in (x, y))
            return ((u == v).mean(1).tolist(),)
        return fn
    return by_row(j, ["sig_a", "sig_b"], "est double", make, keep=["a", "b"], slice_rows=4096).filter(F.col("est") >= cut)


def _best(pairs: DataFrame, k: int | None) -> DataFrame:
    """``e, o``: the pairs that are among the ``k`` best of an endpoint (all for None)."""
    if k is None:
        return pairs.select(F.col("a").alias("e"), F.col("b").alias("o"))
    ends = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("e"), F.col("b").alias("o"), "est"),
                                          F.struct(F.col("b").alias("e"), F.col("a").alias("o"), "est"))).alias("p")).select("p.*")
    w = Window.partitionBy("e").orderBy(F.desc("est"), "o")
    top = ends.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)
    # a pair chosen from both ends is judged once, at the end with the smaller key
    return (top.groupBy(F.least("e", "o").alias("x"), F.greatest("e", "o").alias("y"))
            .agg(F.min("e").alias("e")).select("e", F.when(F.col("e") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("o")))


def class_texts(docs: DataFrame, reps: DataFrame, used: DataFrame, size: int) -> DataFrame:
    """``cls, text, sig``: one text of each class in ``used``; the corpus text moves once."""
    wanted = reps.join(used.distinct(), "cls").select("cls", "sig", F.col("doc").alias("w"))
    picked = docs.join(wanted, docs["doc"].eqNullSafe(wanted["w"])).select("cls", "sig", "text")
    # a text stands for its class if its own set has the class's key (ids may repeat)
    own = by_row(picked, ["text"], "own binary",
                 lambda: lambda texts: ([_key(s) if len(s := shingles(t, size)) else None for t in texts],))
    return written(own.filter(F.col("own") == F.col("cls")).groupBy("cls")
                   .agg(F.first("text").alias("text"), F.first("sig").alias("sig")), "texts")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``e, o``: pairs whose full sets reach the threshold."""
    j = (pairs.join(texts.select(F.col("cls").alias("o"), F.col("text").alias("t_o")), "o")
         .join(texts.select(F.col("cls").alias("e"), F.col("text").alias("t_e")), "e"))

    def make():
        def fn(left, right):
            out, last, held = [], None, None
            for x, y in zip(left, right):
                if x != last:
                    last, held = x, shingles(x, size)
                s = shingles(y, size)
                both = len(np.intersect1d(held, s, assume_unique=True))
                out.append(100 * both >= percent * (len(held) + len(s) - both))
            return (out,)
        return fn
    return by_row(j, ["t_e", "t_o"], "linked boolean", make, keep=["e", "o"]).filter("linked").select("e", "o")


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``cls, comp`` (smallest key of the component) for every endpoint of ``links``."""
    both = written(links.select(F.explode(F.array(F.struct(F.col(left).alias("u"), F.col(right).alias("v")),
                                                  F.struct(F.col(right).alias("u"), F.col(left).alias("v")))).alias("p"))
                   .select("p.u", "p.v").distinct(), "edges")
    labels = written(both.groupBy(F.col("u").alias("cls")).agg(F.min(F.least("u", "v")).alias("comp")), "labels")
    while True:
        near = (both.join(labels.select(F.col("cls").alias("v"), F.col("comp").alias("c")), "v")
                .groupBy(F.col("u").alias("cls")).agg(F.min("c").alias("c")))
        step = labels.join(near, "cls").select("cls", F.col("comp").alias("old"), F.least("comp", "c").alias("comp"))
        up = labels.select(F.col("cls").alias("comp"), F.col("comp").alias("above"))
        new = written(step.join(up, "comp").select("cls", "old", F.least("comp", "above").alias("comp")), "labels")
        if new.filter(F.col("old") != F.col("comp")).isEmpty():
            return new.select("cls", "comp")
        labels = new.select("cls", "comp")


def _crossing(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs whose ends are still in different components."""
    a, b = (comp.select(F.col("cls").alias(x), F.col("comp").alias(f"c_{x}")) for x in "ab")
    j = pairs.join(a, "a", "left").join(b, "b", "left")
    return j.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).drop("c_a", "c_b")


def _cells(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """Members and strays of large regions that still hold several components, by cell.

    Members fall into blocks of about ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles at
    most, strays into blocks of the same size; a cell is one of each. With few strays, a
    member is in one cell and each stray in as many as the region has blocks."""
    region = ["tree", "region"]
    large = (rows.filter(F.col("n") > SMALL).join(comp, "cls", "left")
             .select(*region, "n", "total", "cls", "n_shingles", F.coalesce("comp", "cls").alias("c")))
    main = (large.groupBy(*region, "c").agg(F.count(F.lit(1)).alias("k")).groupBy(*region)
            .agg(F.max_by("c", F.struct("k", "c")).alias("main"), F.sum("k").alias("all"), F.max("k").alias("most"), F.count(F.lit(1)).alias("comps"))
            .filter("comps > 1"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES))
    m = (large.join(main, region).withColumn("blocks", blocks)
         .withColumn("sets", F.ceil(F.col("blocks") * (F.col("all") - F.col("most")) / F.col("all")))
         .withColumn("stray", F.col("c") != F.col("main")))
    h = F.xxhash64("cls")
    as_member = F.transform(F.expr("sequence(cast(0 as bigint), sets - 1)"),
                            lambda x: F.struct(F.pmod(h, F.col("blocks")).alias("block"), x.alias("set"), F.lit(False).alias("asks")))
    as_stray = F.transform(F.expr("sequence(cast(0 as bigint), blocks - 1)"),
                           lambda x: F.struct(x.alias("block"), F.pmod(h, F.col("sets")).alias("set"), F.lit(True).alias("asks")))
    m = m.withColumn("p", F.explode(F.when(F.col("stray"), F.concat(as_member, as_stray)).otherwise(as_member)))
    return m.select(F.xxhash64(*region, "p.block", "p.set").alias("cell"), "cls", "n_shingles", "c", "tree", "stray", "p.asks")


def _by_cell(batches):
    """Arrow rows sorted by cell, one list of row tuples (without the cell) per cell."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != at:
                if held:
                    yield at, held
                at, held = row[0], []
            held.append(row[1:])
    if held:
        yield at, held


def _near_strays(cls, c, tree, stray, asks, sig, n, percent: int, cut: float):
    """(asking row, rows it must be compared with) of a cell: other components, sizes that allow
    a link, signatures that agree, no region shared in an earlier order. A pair of two
    strays is judged by the one with the smaller key."""
    sigs = np.frombuffer(b"".join(sig), "<u2").reshape(len(sig), HASHES)
    comps = np.unique(np.array([x.hex() for x in c]), return_inverse=True)[1]
    keys = np.unique(np.array([x.hex() for x in cls]), return_inverse=True)[1]
    n, asks, stray, t = np.array(n), np.array(asks), np.array(stray), tree[0]
    for x in np.flatnonzero(asks).tolist():
        ok = ~asks & (comps != comps[x]) & (np.minimum(n, n[x]) * 100 >= np.maximum(n, n[x]) * percent) & ~(stray & (keys < keys[x]))
        y = np.flatnonzero(ok)
        y = y[(sigs[y] == sigs[x]).mean(1) >= cut]
        if len(y):
            same = (sigs[y][:, _ORDERS[:t, :BASE]] == sigs[x][_ORDERS[:t, :BASE]]).all(2).any(1)
            if not same.all():
                yield x, y[~same].tolist()


def stray_links(rows: DataFrame, reps: DataFrame, texts: DataFrame, comp: DataFrame, size: int, percent: int, cut: float) -> DataFrame:
    """``e, o``: links between members of a large region that are in different components.

    Twice by cell: first on signatures, which leaves the rows of pairs above the estimate, then
    on the full sets of those rows; only links leave the second pass. A pair that shares
    regions of several orders is judged in the first of them."""
    import pyarrow as pa

    names = ["cell", "cls", "c", "tree", "stray", "asks", "sig", "n_shingles"]
    members = _cells(rows, comp).join(reps.select("cls", "sig"), "cls").select(*names)
    schema = members.schema

    def passing(batches):
        types = pa.schema([("cell", pa.int64()), ("cls", pa.binary()), ("c", pa.binary()), ("tree", pa.int8()), ("stray", pa.bool_()),
                           ("asks", pa.bool_()), ("sig", pa.binary()), ("n_shingles", pa.int64())])
        for cell, held in _by_cell(batches):
            pairs = list(_near_strays(*zip(*held), percent, cut))
            if pairs:
                used = sorted({x for x, _ in pairs}.union(*(y for _, y in pairs)))
                yield pa.RecordBatch.from_arrays([pa.array([cell] * len(used), pa.int64())] + [
                    pa.array([held[i][k] for i in used], types[k + 1].type) for k in range(len(names) - 1)], schema=types)

    near = written(members.repartition("cell").sortWithinPartitions("cell").mapInArrow(passing, schema), "cells")

    def judged(batches):
        for _, held in _by_cell(batches):
            cols = list(zip(*held))
            cls, text, sets, links = cols[0], cols[-1], {}, []
            for x, others in _near_strays(*cols[:-1], percent, cut):
                for y in others:
                    for i in (x, y):
                        if cls[i] not in sets:
                            sets[cls[i]] = shingles(text[i], size)
                    a, b = sets[cls[x]], sets[cls[y]]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        links.append((cls[x], cls[y]))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.binary()), pa.array([b for _, b in links], pa.binary())], names=["e", "o"])

    return (near.join(texts.select("cls", "text"), "cls").select(*names, "text").repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(judged, "e binary, o binary").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
                    keep: list[str] | None = None) -> DataFrame:
    """Add ``n_shingles, component_id`` (smallest id reachable) and ``kept`` (the row
    that carries that id) to the columns in ``keep`` (default all)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_shingles", "component_id", "kept", "cls")]
    threshold = percent / 100
    cut = threshold - 4.5 * (threshold * (1 - threshold) / HASHES) ** 0.5
    narrow = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    marked = signatures(narrow, "text", size, ["doc"]).filter(F.col("cls").isNotNull())
    reps = written(marked.groupBy("cls").agg(F.min("doc").alias("doc"), F.first("n_shingles").alias("n_shingles"),
                                             F.first("sig").alias("sig")), "classes")
    rows = written(forest(reps), "forest")
    pairs = written(estimated(candidates(rows), reps, cut, threshold), "pairs")
    used = pairs.select(F.explode(F.array("a", "b")).alias("cls")).unionAll(rows.filter(F.col("n") > SMALL).select("cls"))
    texts, comp = class_texts(narrow, reps, used, size), None
    for limit in (2, None):  # the best pairs of every class, then whatever still crosses components
        if comp is not None:
            pairs = written(_crossing(pairs, comp), "pairs")
        links = written(confirmed(written(_best(pairs, limit), "chosen"), texts, size, percent), "links")
        comp = _merge(comp, links)
    comp = _merge(comp, written(stray_links(rows, reps, texts, comp, size, percent, cut), "links"))
    smallest = reps.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    smallest = smallest.join(smallest.groupBy("comp").agg(F.min("doc").alias("component_id")), "comp")
    return _labelled(docs, smallest.select("cls", F.col("component_id").alias("_c")), id_col, text_col, size, keep)


def _merge(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after ``links`` are added: contracts known components first."""
    if comp is None:
        return components(links, "e", "o")
    e, o = (comp.select(F.col("cls").alias(x), F.col("comp").alias(f"c_{x}")) for x in "eo")
    merged = components(links.join(e, "e", "left").join(o, "o", "left")
                        .select(F.coalesce("c_e", "e").alias("e"), F.coalesce("c_o", "o").alias("o")), "e", "o")
    up = merged.select(F.col("cls").alias("comp"), F.col("comp").alias("above"))
    old = comp.join(up, "comp", "left").select("cls", F.coalesce("above", "comp").alias("comp"))
    return written(old.unionAll(merged.join(comp.select("cls"), "cls", "left_anti")), "components")


def _labelled(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, size: int, keep: list[str]) -> DataFrame:
    def make():
        def fn(texts):
            sets = [shingles(t, size) for t in texts]
            return [len(s) for s in sets], [_key(s) if len(s) else None for s in sets]
        return fn
    own = by_row(docs, [text_col], "n_shingles bigint, cls binary", make, keep=list(dict.fromkeys([*keep, id_col])))
    # rows without words have no class: spread them by id, their eight bytes match no class
    own = own.withColumn("_k", F.coalesce("cls", F.encode(F.hex(F.xxhash64(id_col)), "UTF-8")))
    out = own.join(classes.withColumnRenamed("cls", "_k"), "_k", "left")
    # a class without a known id keeps every row; a set without words belongs to itself
    out = out.withColumn("component_id", F.when(F.col("cls").isNull(), F.col(id_col)).otherwise(F.col("_c")))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))).select(*keep, "n_shingles", "component_id", "kept")


@query("op7_near_dedup")
def op7_near_dedup(spark: SparkSession, data_dir: str) -> DataFrame:
    """Component of every document over word pairs, similarity 0.8 or more."""
    return near_duplicates(table(spark, data_dir, "documents").select("doc_id", "text"), size=2, keep=["doc_id"])
