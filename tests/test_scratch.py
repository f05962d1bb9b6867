import os

import pytest
from pyspark.sql import functions as F

from civiclens import scratch


def test_tables_of_a_run_go_one_by_one_or_all_at_once(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_RUN", "run-of-a-test")
    one, two = (scratch.materialise(spark.range(3).select(F.col("id") * n), "t") for n in (1, 2))
    folder = scratch._run_folder(spark)
    assert len(os.listdir(folder)) == 2 and one.count() == 3
    scratch.discard(one)
    assert len(os.listdir(folder)) == 1 and two.count() == 3
    scratch.clear(spark)
    assert not os.path.exists(folder)


def test_only_a_local_master_may_lack_the_setting(spark, monkeypatch):
    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        pass

    session = Session()
    for master in ("spark://host", "local-cluster[2,1,1024]", "yarn"):
        session.conf = Conf(master)
        with pytest.raises(ValueError):
            scratch.scratch_path(session, "x")
    session.conf = Conf("local[4]")
    assert "civiclens" in scratch.scratch_path(session, "x")
