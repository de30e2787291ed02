import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages_tell_rows_apart_by_id_and_text(spark, tmp_path):
    text = lambda name, n=40: " ".join(f"{name}{k}" for k in range(n))
    spark.createDataFrame([(1, text("item"))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [
        (None, text("a")), (None, text("a")), (None, text("a") + " more"),  # one stays
        (None, text("b")), (5, text("b") + " more"),  # that with an id stays
        (6, text("c")), (7, text("c")), (7, text("d")),  # 7 is a copy of 6 once, its other text stays
        (8, text("e")), (8, text("e")),
        (None, text("item")), (9, text("item")), (9, text("f")), (None, None),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id or 0, (r.text or " ").split(" ")[0]) for r in kept.collect()))
    assert found == sorted([(0, "a0"), (5, "b0"), (6, "c0"), (7, "d0"), (8, "e0"), (9, "item0"), (9, "f0"), (0, "")])
    clean = corpus_pipeline.no_benchmark(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and clean.count() == len(rows) - 2


def test_near_duplicates_at_five_words_and_eight_tenths(spark):
    rows = []
    for k in range(10):
        own = [f"t{k}x{j}" for j in range(100)]
        # 15 percent of new words at the end; then one word changed in 50
        rows += [(10 * k, " ".join(own)), (10 * k + 1, " ".join(own + [f"new{k}x{j}" for j in range(15)]))]
        rows += [(10 * k + 2, " ".join(w.upper() + "s" if j in (25, 75) else w for j, w in enumerate(own)))]
        # too far: a third of new words
        rows += [(10 * k + 3, " ".join(own + [f"far{k}x{j}" for j in range(34)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert sorted(r.doc_id % 10 for r in kept.collect()) == [0] * 10 + [3] * 10


def test_awkward_and_empty_tables(spark, awkward, nothing, tmp_path):
    spark.createDataFrame([(1, "none of these words is in any text"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (7, 1, 0), (9, 0, 1), (None, 1, 0), (20, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    clash = awkward.withColumnsRenamed({"n": "own0", "score": "mix"}).withColumns({"rate": F.lit("r"), "Quality_Score": F.lit("own")})
    for docs in (clash, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, str(tmp_path))
            assert kept.columns == docs.columns
            assert kept.count() == 0 or docs is clash
            assert docs is nothing or {r.Quality_Score for r in kept.collect()} == {"own"}
    clash.write.parquet(f"{tmp_path}/documents.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and done.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_stages_keep_the_columns_and_whole_results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = docs, docs.columns
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == columns
        sizes.append(kept.count())
    assert sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2]  # rates may repeat rows in the last
    final = corpus_pipeline.run(spark, SF).toPandas()
    assert len(final) == sizes[-1]
    assert final.start.sort_values().tolist() == final.n_tokens[final.start.sort_values().index].cumsum().shift(fill_value=0).tolist()
