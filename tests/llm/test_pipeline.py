import random

import corpus_pipeline as cp
from engram.llm import registry
from tests.llm.helpers import docs_frame, words


def test_registered_queries():
    names = registry.all_queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(registry.all_sql()) <= set(names)


def test_stages(spark, tmp_path):
    r = random.Random(6)
    bench = [(i, " ".join(words(r, 30))) for i in range(3)]
    good = [(i, " ".join(words(r, 120))) for i in range(40)]
    near = [(100 + i, " ".join(good[i][1].split()[:-2] + words(r, 2))) for i in range(5)]
    leak = [(200, " ".join(words(r, 60)) + " " + bench[1][1] + " " + " ".join(words(r, 40)))]
    private = [(300, " ".join(words(r, 80)) + " write to a.b@mail.example.com now")]
    poor = [(400, "short"), (401, None), (402, ""), (403, "a b c " * 50)]
    docs_frame(spark, good + near + leak + private + poor).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, steps = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(cp.STAGES) - 1:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        steps.append({row.doc_id: row for row in docs.collect()})
    ids = [set(s) for s in steps]
    clean = {i for i, _ in good}
    assert ids[0] == clean | {100, 101, 102, 103, 104, 200, 300}
    assert ids[1] == clean | {200, 300}
    assert ids[2] == ids[3] == ids[4] == clean | {300}
    assert "[EMAIL]" in steps[3][300].text and steps[3][300].n_chars == len(steps[3][300].text)
    assert steps[3][0].text == good[0][1]
    run = {row.doc_id: row for row in cp.run(spark, str(tmp_path)).collect()}
    assert run == steps[4]


def test_clashing_columns_repeats_and_empty_tables(spark, tmp_path):
    from pyspark.sql import functions as F

    r = random.Random(9)
    good = [(i, " ".join(words(r, 120))) for i in range(30)]
    rows = good + [good[3], good[3], (None, good[4][1]), (50, None), (51, "")]
    clash = ["kept", "spans", "cls", "sanitised", "_hit", "_n", "lang_key", "component_id", "n_words", "_k"]
    docs = docs_frame(spark, rows).select("*", *[F.lit(f"own {c}").alias(c) for c in clash])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words(r, 12)))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(cp.STAGES[:-1]):
        d = stage(spark, d, str(tmp_path))
        assert d.dtypes == docs.dtypes
        d.write.parquet(f"{tmp_path}/out{k}")
        d = spark.read.parquet(f"{tmp_path}/out{k}")
        assert all(row[c] == f"own {c}" for row in d.collect() for c in clash)
    assert sorted(row.doc_id for row in d.collect()) == sorted([*range(30), 3, 3])   # the row without id gives way to 4
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0
