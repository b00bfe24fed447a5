from pyspark.sql import functions as F

from tessera.sources.documents import read_paths, sample_rows, spread


def test_spread_only_narrow_scans_and_runs_nothing(spark, tables):
    st = spark.sparkContext.statusTracker()
    joined = tables["customer"].join(tables["nation"],
                                     tables["customer"].c_nationkey == tables["nation"].n_nationkey)
    before = len(st.getJobIdsForGroup(None))
    assert spread(joined) is joined
    assert len(st.getJobIdsForGroup(None)) == before
    wide = spread(tables["lineitem"])
    assert wide.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert wide.count() == tables["lineitem"].count()


def test_read_paths_and_sample_rows(spark, tables):
    docs = tables["customer"].select("c_custkey", F.struct("c_name", "c_acctbal").alias("p"))
    out = read_paths(docs, ["c_custkey", "p.c_name"])
    assert out.columns == ["c_custkey", "p_c_name"]
    assert "c_acctbal" not in out._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    top = sample_rows(tables["orders"], 3, "o_orderkey").collect()
    assert [r.o_orderkey for r in top] == [0, 1, 2]
