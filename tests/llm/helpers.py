"""Small fixtures shared by the operator tests."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYL = "the er on ti re st an ou en ha ing le de que ment ch".split()


def words(r: random.Random, n: int) -> list[str]:
    return ["".join(r.choices(SYL, k=r.randint(1, 4))) for _ in range(n)]


def docs_frame(spark, rows, extra: str = ""):
    """``rows``: (doc_id, text[, lang[, source]]); ``extra``: a clashing column to add."""
    full = []
    for row in rows:
        i, t, lang, source = (*row, *((None, "en", "src0")[len(row) - 1:]))
        full.append((i, t, lang, source, len(t) if t is not None else None))
    df = spark.createDataFrame(full, DOCS)
    return df.selectExpr("*", f"'clash' as {extra}") if extra else df
