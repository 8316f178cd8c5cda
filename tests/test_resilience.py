"""Task failures during writes: a task that dies mid-write is retried and the
written table holds every row exactly once (landing batch, curated merge).  Runs in its own process because task retries need a
``local[n, maxFailures]`` master, and a process has one SparkContext."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(r"""
    import sys
    sys.path.insert(0, ROOT)
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from pyspark.sql.functions import udf
    from sluice.session import ensure_checkpoint_dir, shared_dir
    from sluice.sources import landing as L
    from sluice.sources import curated as K
    from sluice.operators.merge import latest_per_key

    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark)

    seen = {}

    @udf("bigint")
    def flaky(v):
        # The first attempt of partition 1 dies after 180 rows, i.e. after
        # earlier row batches have already reached the writer.
        ctx = TaskContext.get()
        key = (ctx.stageId(), ctx.partitionId(), ctx.attemptNumber())
        seen[key] = seen.get(key, 0) + 1
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0 and seen[key] == 180:
            raise RuntimeError("simulated executor loss")
        return v

    sc = spark.sparkContext

    def failed_tasks(group):
        st = sc.statusTracker()
        return sum(st.getStageInfo(s).numFailedTasks for j in st.getJobIdsForGroup(group)
                   for s in st.getJobInfo(j).stageIds if st.getStageInfo(s))

    e = spark.read.parquet(SF + "/events.parquet").repartition(4)
    expected = e.count()
    hurt = e.withColumn("event_id", flaky("event_id"))

    landing = shared_dir(spark, "r-landing")
    sc.setJobGroup("landing", "landing write with a failing task")
    L.write_landing(hurt, landing, 1, partition_by="event_type")
    assert failed_tasks("landing") >= 1, "no task failed"
    back = L.read_landing(spark, landing, batch_id=1)
    assert back.count() == expected == back.select("event_id").distinct().count(), "landing"

    curated = shared_dir(spark, "r-curated")
    sc.setJobGroup("merge", "merge with a failing task")
    K.merge(spark, hurt, curated, key="user_id", version="ts", buckets=4)
    assert failed_tasks("merge") >= 1, "no task failed"
    want = sorted(tuple(r) for r in latest_per_key(e, key="user_id", version="ts").collect())
    got = sorted(tuple(r) for r in K.read(spark, curated).collect())
    assert got == want, "final"
    print("RESILIENT", expected)
""")


def test_writes_survive_task_failures():
    env = dict(os.environ)
    code = f"ROOT = {ROOT!r}\nSF = '/root/testdata/sf0.001'\n" + SCRIPT
    res = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, env=env)
    assert res.returncode == 0, res.stdout[-2000:] + res.stderr[-4000:]
    assert "RESILIENT" in res.stdout
