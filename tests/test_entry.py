"""Driver contract: entry(), queries() and oracle_sql()."""

import __spark_entry__ as E

# Not SQL: checked against brute force in the tests of their subpackage, if it is there.
NO_ORACLE = {"op2_suffix_dedup", "op4_byte_bpe", "op5_quality", "op8_pii", "op9_simhash", "op11_quality_gam", "pipeline"}


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and set(df.columns) >= {"source", "pages", "accepted", "rejected"}


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    assert set(q) - set(o) <= NO_ORACLE
    assert set(o) <= set(q)


def test_small_queries_run(spark):
    q = E.queries()
    for name in ["link_absolutise", "seen_anti_join", "ttl_throttle", "latest_per_url", "run_stats"]:
        assert q[name](spark, "/root/testdata/sf0.001").count() >= 0


def test_a_cluster_needs_a_shared_scratch_folder():
    import types

    import pytest

    from inkwell.session import checkpoint_root

    sc = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(cluster)


def test_scratch_folders_can_be_dropped(spark):
    import os

    from inkwell.session import drop_scratch, scratch_dir

    path = scratch_dir(spark, "x").replace("file:", "")
    assert os.path.isdir(path)
    assert drop_scratch(spark) >= 1 and not os.path.exists(path)


def test_a_missing_library_costs_only_the_optional_queries(monkeypatch):
    import sys

    import pytest

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # importing it now raises ImportError
    with pytest.warns(UserWarning, match="no training-data queries"):
        names = set(E.queries())
    assert "rss_items" in names and not any(n.startswith("op1") for n in names)
