"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A piece is a row of byte positions. Leaf ``i`` of the tree holds the rank of the
pair (token starting at ``i``, next live token); inner nodes hold the minimum, a
descent that prefers the left child on ties finds the leftmost minimum. A merge
joins that pair, clears the absorbed neighbour's leaf and re-ranks the two live
neighbours: three point updates of logarithmic cost, so a piece of n bytes takes
O(n log n) whatever its length. Short pieces of a slice run through the same tree
in lock step as numpy rows; longer ones run one by one.

Texts are cut at blanks that stand between two characters that are not white
space (always a border of two matches of the pattern), and the ids of a cut are
kept in a bounded cache, so frequent words cost one lookup.

Defined results: null and empty texts have no ids; ids are packed as little-endian
unsigned 32-bit integers; special tokens are never produced and their strings are
ordinary text; decoding null gives null, an unknown id raises. Every text is
encoded whole; row order, repeated rows and other columns are kept.
"""

from __future__ import annotations

import base64
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engram.llm.common import by_row, query, table

INF = np.iinfo(np.int32).max
#: Widest piece handled in lock step, cached cut and entries kept (memory bound per worker).
LANE_BYTES, CUT_CHARS, CACHE_ENTRIES = 32, 64, 300_000
#: A blank beside white space, by a class no smaller than the pattern's.
_LOOSE = re.compile(r" \s|\s ").search
_CODECS: dict[tuple, Codec] = {}


class Codec:
    """Ranks of one vocabulary file; encodes and decodes whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.cache, self.older = ranks, {}, {}
        self.split = regex.compile(pattern).findall
        self.cuts = regex.compile(r"(?<=\S) (?=\S)").finditer
        self.bytes_of: list = [None] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys, self.pair_ranks = keys, np.array([pairs[k] for k in keys.tolist()], np.int32)

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        """One codec per worker process and vocabulary (the file is on every node)."""
        if (path, pattern) not in _CODECS:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
            _CODECS[path, pattern] = cls(ranks, pattern)
        return _CODECS[path, pattern]

    # -- one long piece ---------------------------------------------------
    def piece(self, piece: bytes) -> list[int]:
        """Ids of one piece by a scalar segment tree."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        if n < 2:
            return [self.ranks[piece]] if n else []
        size = 1 << (n - 1).bit_length()
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.pairs.get
        tree = [INF] * (2 * size)
        for i in range(n - 1):
            tree[size + i] = rank(ids[i] << 32 | ids[i + 1], INF)
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a <= b else b

        def put(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a <= b else b
                if tree[k] == low:
                    return
                tree[k] = low
                k >>= 1

        while tree[1] < INF:
            k = 1
            while k < size:
                k *= 2
                if tree[k] > tree[k + 1]:
                    k += 1
            i, merged = k - size, tree[1]
            gone = nxt[i]
            after, before = nxt[gone], prv[i]
            ids[i], nxt[i], ids[gone] = merged, after, -1
            if after < n:
                prv[after] = i
            put(gone, INF)
            put(i, rank(merged << 32 | ids[after], INF) if after < n else INF)
            if before >= 0:
                put(before, rank(ids[before] << 32 | merged, INF))
        return [x for x in ids if x >= 0]

    # -- many short pieces ------------------------------------------------
    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], INF)

    def pieces(self, batch: list[bytes]) -> list[bytes]:
        """Packed ids of each piece; lock-step trees for the short ones."""
        out: list = [None] * len(batch)
        lanes: dict[int, list[int]] = {}
        for k, p in enumerate(batch):
            if p in self.ranks:
                out[k] = self.ranks[p].to_bytes(4, "little")
            elif len(p) <= LANE_BYTES:
                lanes.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(k)
            else:
                out[k] = np.array(self.piece(p), "<u4").tobytes()
        for width, ks in lanes.items():
            for at in range(0, len(ks), 4096):
                part = ks[at:at + 4096]
                for k, ids in zip(part, self._lane([batch[k] for k in part], width)):
                    out[k] = ids
        return out

    def _lane(self, batch: list[bytes], width: int):
        rows, n = len(batch), np.array([len(p) for p in batch])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in batch), np.uint8).reshape(rows, width)
        ids = np.where(np.arange(width) < n[:, None], self.byte_id[raw], -1)
        nxt = np.tile(np.arange(1, width + 1), (rows, 1))
        prv = np.tile(np.arange(-1, width - 1), (rows, 1))
        tree = np.full((rows, 2 * width), INF, np.int32)
        tree[:, width:-1] = self._rank(ids[:, :-1], ids[:, 1:])
        k = width
        while k > 1:
            tree[:, k // 2:k] = np.minimum(tree[:, k:2 * k:2], tree[:, k + 1:2 * k:2])
            k //= 2

        tree, step = tree.ravel(), 2 * width
        ids, nxt, prv = ids.ravel(), nxt.ravel(), prv.ravel()

        def put(base, i, value):
            k = i + width
            tree[base + k] = value
            for _ in range(width.bit_length() - 1):
                k >>= 1
                pair = base + 2 * k
                tree[base + k] = np.minimum(tree[pair], tree[pair + 1])

        live = np.flatnonzero(tree[1::step] < INF)
        while len(live):
            base, row = live * step, live * width
            merged = tree[base + 1]
            k = np.ones(len(live), np.int64)
            for _ in range(width.bit_length() - 1):
                k *= 2
                k += tree[base + k] > merged  # the left child holds the minimum unless it is larger
            i = k - width
            here = row + i
            gone = nxt[here]
            after, before = nxt[row + gone], prv[here]
            ids[here], ids[row + gone], nxt[here] = merged, -1, after
            inside = after < width
            prv[(row + after)[inside]] = i[inside]
            follow = np.where(inside, ids[row + np.minimum(after, width - 1)], -1)
            put(base, gone, INF)
            has = np.flatnonzero(before >= 0)
            ahead, merged = row[has] + before[has], merged.astype(np.int64)
            ranks = self._rank(np.concatenate((merged, ids[ahead])), np.concatenate((follow, merged[has])))
            put(base, i, ranks[:len(i)])
            put(base[has], before[has], ranks[len(i):])
            live = live[tree[base + 1] < INF]
        ids = ids.reshape(rows, width)
        flat = ids[ids >= 0].astype("<u4").tobytes()
        ends = np.cumsum((ids >= 0).sum(1) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    # -- whole texts ------------------------------------------------------
    def _cut(self, text: str) -> list[str]:
        if not _LOOSE(text):
            parts = text.split(" ")
            return [parts[0], *[" " + p for p in parts[1:]]]
        at = [0, *[m.start() for m in self.cuts(text)], len(text)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of each text (little-endian unsigned 32-bit integers)."""
        cuts = [self._cut(t) if t else [] for t in texts]
        need = set().union(*cuts)
        known = {c: self.cache[c] for c in need.intersection(self.cache)}
        need.difference_update(known)
        # entries of the older generation come back when they are used again
        back = {c: self.older[c] for c in need.intersection(self.older)}
        need.difference_update(back)
        split = {c: [p.encode() for p in self.split(c)] for c in need}
        flat = list(set().union(*split.values()))
        ids = dict(zip(flat, self.pieces(flat)))
        known.update(back)
        for c, ps in split.items():
            known[c] = back[c] = ids[ps[0]] if len(ps) == 1 else b"".join([ids[p] for p in ps])
        if len(self.cache) + len(back) > CACHE_ENTRIES:
            self.older, self.cache = self.cache, {}
        self.cache.update((c, v) for c, v in back.items() if len(c) <= CUT_CHARS)
        return [b"".join(map(known.__getitem__, cut)) for cut in cuts]

    def decode(self, packed: bytes | None) -> bytes | None:
        """Bytes of packed ids."""
        if packed is None:
            return None
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add ``ids_col``: packed ids of each whole text (empty for null)."""
    return by_row(df, [text_col], f"`{ids_col}` binary",
                  lambda: lambda texts: (Codec.load(path, pattern).encode_many(texts),))


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col``: the bytes that packed ids stand for."""
    return by_row(df, [ids_col], f"`{bytes_col}` binary",
                  lambda: lambda ids: (list(map(Codec.load(path, pattern).decode, ids)),))


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``ids`` (packed) and ``decoded`` (bytes of those ids) in one pass."""
    def make():
        codec = Codec.load(path, pattern)

        def fn(texts):
            ids = codec.encode_many(texts)
            return ids, list(map(codec.decode, ids))
        return fn
    return by_row(df, [text_col], "ids binary, decoded binary", make, keep=keep)


def digests(df: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of a :func:`round_trip`."""
    return df.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                     F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def default_vocabulary() -> tuple[str, str]:
    """Path and pattern of the public 50k byte-level vocabulary."""
    import public_tokenizers as P

    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


@query("op3_bpe")
def op3_bpe(spark: SparkSession, data_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    path, pattern = default_vocabulary()
    return digests(round_trip(table(spark, data_dir, "documents"), path, pattern, keep=["doc_id"]))
