import re
from collections import defaultdict

import corpus_pipeline as C
from sluice.llm import decontaminate as D
from sluice.llm import quality
from .test_jaccard import brute
from .test_packing import check
from .test_pii import base

SF = "/root/testdata/sf0.001"


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = lambda df: sorted((r.doc_id, r.text) for r in df.collect())
    step = {}
    for name, stage in C.STAGES[:-1]:
        before = rows(docs)
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        step[name] = (before, rows(docs))

    before, after = step["quality"]
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert after == [r for r, s in zip(before, model.score([t for _, t in before])) if s >= 0.3]
    before, after = step["near_copies"]
    assert {i for i, _ in after} == {int(c) for _, _, c in brute(before, 5, 80)} and set(after) <= set(before)
    before, after = step["decontamination"]
    items = [D.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert after == [r for r in before if not any(i in D.normal(r[1]) for i in items)]
    before, after = step["personal_data"]
    assert [i for i, _ in before] == [i for i, _ in after]
    for (_, was), (_, now) in zip(before, after):
        assert base(now) == "" and (base(was) or re.search("[0-9@]", was) or was == now)
    packed = C.STAGES[-1][1](spark, docs, SF).collect()
    check(packed, [(i, t) for i, t in after], 4096)
    per = defaultdict(int)
    for r in packed:
        per[r.sequence_id] += r.length
    assert max(per.values()) <= 4096


def test_run_and_null_rows(spark, tmp_path):
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, None, None, None, None)], docs.schema)
    docs.unionAll(odd).unionAll(docs.limit(3)).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).count() > 0
    docs.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/empty/{t}.parquet")
    assert C.run(spark, f"{tmp_path}/empty").count() == 0
