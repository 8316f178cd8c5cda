import zlib

from pyspark.sql import functions as F

from sluice.llm import labelled as L


def test_a_repeated_id_enters_the_sample_once(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    hot = ids[0]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").unionAll(
        spark.range(20_000).select(F.lit(hot).cast("long"), F.concat(F.lit("zz"), F.col("id").cast("string"))))
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    got = L.training_texts(docs, labels.unionAll(labels), "quality", 5, 0, 1000).collect()
    assert len(got) == len(ids) and {r.text for r in got} == {f"text {i}" for i in ids}
    assert len(L.training_texts(docs, labels, "quality", 5, 0, 20).collect()) <= 40


def test_null_texts_and_labels(spark):
    docs = spark.createDataFrame([(1, None), (2, "b"), (2, None), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (2, None)], "doc_id long, quality int")
    got = sorted(map(tuple, L.training_texts(docs, labels, "quality", 99, 98, 10).collect()), key=str)
    assert got == [("b", 0), (None, 1)]
