from __future__ import annotations

from types import SimpleNamespace

import pytest

from seatlens import session


def fake(master: str, folder: str | None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_shared_folder_is_the_one_the_cluster_names():
    assert session.shared_folder(fake("yarn", "hdfs://x/ckpt/")) == "hdfs://x/ckpt/seatlens/app-1"


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn", None))


def test_local_master_may_use_its_own_folder():
    assert "seatlens-" in session.shared_folder(fake("local[2]", None))


def test_stage_reads_back_what_it_wrote(spark):
    staged = session.stage(spark.range(5), "numbers")
    assert sorted(r.id for r in staged.collect()) == [0, 1, 2, 3, 4]
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("folder", ["/tmp/x", "file:/tmp/x", "file:///var/tmp/x"])
def test_cluster_refuses_a_machines_own_folder(folder):
    with pytest.raises(ValueError, match="shared"):
        session.shared_folder(fake("yarn", folder))


def test_temporary_stages_are_deleted(spark, tmp_path):
    with session.temporary_stages(spark):
        staged = session.stage(spark.range(3), "gone")
        place = staged.inputFiles()[0]
    assert session.stage(spark.range(3), "kept").count() == 3
    with pytest.raises(Exception, match="(?i)not_?(exist|found)"):
        spark.read.parquet(place).count()
