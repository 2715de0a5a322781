from types import SimpleNamespace

import pytest

from tillroll.sinks.scratch import scratch_folder


def session(master, shared=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_folder_of_the_session_is_used():
    first, second = (scratch_folder(session("yarn", "hdfs:///shared/")) for _ in range(2))
    assert first.startswith("hdfs:///shared/tillroll-") and first != second


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_without_one_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(session(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[2,3]"])
def test_a_session_in_one_process_has_its_own(master):
    assert "tillroll-" in scratch_folder(session(master))
