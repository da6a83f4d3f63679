from types import SimpleNamespace

import pytest

from newstide.workspace import fresh_path, shared_folder, stage


def session(master, application="app-1", setting=None):
    conf = SimpleNamespace(get=lambda key, default=None: setting or default)
    context = SimpleNamespace(
        master=master, applicationId=application, getConf=lambda: SimpleNamespace(get=lambda key: setting)
    )
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_folder_comes_from_the_cluster():
    assert shared_folder(session("spark://host:7077", setting="hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host:7077"))


def test_local_session_without_setting():
    first = shared_folder(session("local[2]"))
    assert first == shared_folder(session("local[2]"))
    assert first != shared_folder(session("local[2]", "app-2"))


def test_stage(spark, rows):
    staged = stage(spark.range(3), "numbers")
    assert rows(staged) == [(0,), (1,), (2,)]
    assert staged.inputFiles()[0].startswith("file:")
    assert fresh_path(spark, "a") != fresh_path(spark, "a")
