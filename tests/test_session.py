from types import SimpleNamespace

import pytest

from rillframe import session

PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_shuffles_fit_the_tables(spark, monkeypatch):
    monkeypatch.setattr(session, "_BYTES", {})
    session.fit_shuffles(spark, "/root/testdata/sf0.001")
    assert spark.conf.get(PARTITIONS, None) is None, "small tables change nothing"
    monkeypatch.setattr(session, "PARTITION_BYTES", 1000)
    try:
        session.fit_shuffles(spark, "/root/testdata/sf0.001")
        assert 100 < int(spark.conf.get(PARTITIONS)) < session.MAX_PARTITIONS
    finally:
        spark.conf.unset(PARTITIONS)


def test_settled_rows_come_from_the_shared_folder(spark):
    rows = session.settled(spark.range(10))
    assert rows.count() == 10
    assert all(session.shared_dir(spark) in name for name in rows.inputFiles())


def test_a_cluster_must_name_its_shared_folder():
    context = SimpleNamespace(master="spark://somewhere", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(sparkContext=context, conf={})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)
