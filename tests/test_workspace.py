import os
import time
from types import SimpleNamespace

import pytest

from arrivalmart.sources import workspace


def session(master, folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: {"spark.checkpoint.dir": folder}.get(name) or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_folder_named_by_the_session_is_used():
    spark = session("yarn", "hdfs://shared/checkpoints/")
    assert workspace.shared_folder(spark) == "hdfs://shared/checkpoints"
    first, second = (workspace.new_folder(spark, "fact") for _ in range(2))
    assert first.startswith("hdfs://shared/checkpoints/arrivalmart/fact-") and first != second


@pytest.mark.parametrize("master", ["local[4]", "spark://cluster:7077"])
def test_a_session_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        workspace.shared_folder(session(master, None))


def test_sweep_removes_what_queries_have_left(spark):
    path = workspace.new_folder(spark, "left")
    workspace.kept(spark.range(3), path)
    workspace.sweep(spark)
    assert not os.path.exists(path)


@pytest.mark.parametrize("fails", [False, True])
def test_work_folder_is_removed_with_its_tables(spark, fails):
    try:
        with workspace.work_folder(spark, "test") as work:
            table = workspace.kept(spark.range(3), f"{work}/numbers")
            assert table.count() == 3 and os.path.isdir(work)
            if fails:
                raise ValueError
    except ValueError:
        assert fails
    assert not os.path.exists(work)


def test_a_query_leaves_no_shuffle_files_where_they_are_removed(spark, tmp_path):
    def files():
        held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(k).getName() for k in range(held.size()) if held.apply(k).getName().startswith("shuffle_")}

    def written(name):
        before = files()
        spark.range(1_000).repartition(3, "id").write.parquet(str(tmp_path / name))
        for _ in range(50):
            if not files() - before:
                break
            time.sleep(0.1)
        return files() - before

    setting = spark.conf.get(workspace.REMOVES_SHUFFLES, None)
    with workspace.shuffles_removed(spark):
        assert not written("within")
    assert spark.conf.get(workspace.REMOVES_SHUFFLES, None) == setting
    assert written("outside")
