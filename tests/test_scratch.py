from __future__ import annotations

from types import SimpleNamespace

import pytest

from meterwell.sources.scratch import scratch_dir, shared_root


def fake(master: str = "yarn", **settings: str):
    known = {key.replace("_", "."): value for key, value in settings.items()}
    conf = SimpleNamespace(get=lambda key, *default: known.get(key))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_folder_comes_from_the_session():
    both = {"spark_checkpoint_dir": "hdfs:///shared/", "spark_sql_warehouse_dir": "hdfs:///tables"}
    assert shared_root(fake(**both)) == "hdfs:///shared"
    assert shared_root(fake(spark_sql_warehouse_dir="hdfs:///tables")) == "hdfs:///tables"


def test_every_scratch_folder_is_new(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    assert scratch_dir(spark, "x").startswith(shared_root(spark))


def test_a_folder_beside_the_driver_is_refused_on_a_cluster():
    for folder in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(fake(spark_sql_warehouse_dir=folder))
        assert shared_root(fake("local[8]", spark_sql_warehouse_dir=folder)) == folder
        assert shared_root(fake(spark_checkpoint_dir="/shared", spark_sql_warehouse_dir=folder)) == "/shared"
