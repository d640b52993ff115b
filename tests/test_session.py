from __future__ import annotations

from types import SimpleNamespace

import pytest

from streamlake.session import RUNTIME_CONF, configure, scratch_dir


def session(setting=None, context_dir=None, master="local[2]"):
    """The few parts of a session the scratch folder depends on."""
    state = {"dir": context_dir}
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: state["dir"], setCheckpointDir=lambda d: state.update(dir=d)
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=context)


def test_the_clusters_folder_comes_first():
    assert scratch_dir(session("s3a://b/cp/", "/other", "spark://m"), "x").startswith("s3a://b/cp/streamlake/x-")
    assert scratch_dir(session(None, "hdfs://n/cp", "yarn"), "x").startswith("hdfs://n/cp/streamlake/x-")


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session(master="yarn"), "x")


def test_a_local_session_gets_one_folder():
    local = session()
    first, second = scratch_dir(local, "x"), scratch_dir(local, "x")
    assert first != second
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_configure(spark):
    configure(spark)
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_CONF.items())
