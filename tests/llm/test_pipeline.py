"""Every stage on untidy rows, and the whole pipeline on the smallest tables."""

import random

import corpus_pipeline
from tests.llm.test_operators import words
from zonepulse.llm.scratch import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(8)
    item, passage = words(rng, 30), words(rng, 60)
    clean = [words(rng, 80) for _ in range(60)]
    bad = [" ".join(x for w in words(rng, 60).split(" ") for x in (w, "nastyword")) for _ in range(30)]
    texts = [*clean, clean[0], *bad, clean[1] + " " + passage, clean[2] + " " + passage, words(rng, 20) + " " + item, None, ""]
    # The passage's documents differ from the clean ones by more than a fifth of their shingles.
    docs = spark.createDataFrame([(i, t, "en", None, None, "k") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, key string")
    spark.createDataFrame([(i, int(61 <= i < 91)) for i in range(91)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    gone = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.collect()}
        docs = stored(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.columns == COLUMNS, name
        gone.append(before - {r["doc_id"] for r in docs.collect()})
    leak = 93
    assert gone == [set(range(61, 91)), {60}, set(), {leak}]
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert passage not in left[91] and passage not in left[92]
    assert left[5] == clean[5] and left[94] == left[95] == ""
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in last.collect()} == set(left)


def test_stages_judge_rows_apart(spark, tmp_path):
    rng = random.Random(9)
    item = words(rng, 30)
    clean = [words(rng, 80) for _ in range(12)]
    near = clean[4] + " more"
    leak, other_leak = words(rng, 40) + " " + item, words(rng, 45) + " " + item
    rows = [
        (1, clean[1]), (1, clean[1]), (1, clean[1]), (None, clean[2]), (None, clean[2]), (None, clean[3]), (3, clean[3]), (4, clean[4]), (5, near), (5, clean[5]), (6, clean[6]), (6, leak), (None, other_leak),
        (None, clean[7]), (None, ""), (None, ""), (8, None), (8, None), (8, clean[8]), (9, clean[8]),
    ]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    count = lambda rows: sorted((str(i), str(t)) for i, t in rows)
    left = [(1, clean[1]), (None, clean[2]), (3, clean[3]), (4, clean[4]), (5, clean[5]), (6, clean[6]), (None, clean[7]), (None, ""), (None, ""), (8, None), (8, None), (8, clean[8])]
    docs = stored(corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)), "stage")
    assert count(docs.select("doc_id", "text").collect()) == count([*left, (6, leak), (None, other_leak)])
    leaks = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert leaks.columns == COLUMNS and count(leaks.select("doc_id", "text").collect()) == count(left)
    cut = corpus_pipeline.cut_repeats(spark, leaks, str(tmp_path))
    assert count(cut.select("doc_id", "text").collect()) == count((i, t or "") for i, t in left)


def test_stages_on_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), "stage")
    assert docs.count() == 0


def test_whole_pipeline(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert 0 < len(found) <= 200 and len({r["doc_id"] for r in found}) == len(found)
