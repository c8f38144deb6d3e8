"""Where scratch data goes."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from tidewright.session import scratch_path, scratch_root


def session(master, folder=None, checkpoint=None):
    """Only what the scratch folder is found by."""
    place = [checkpoint]
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: place[0], setCheckpointDir=lambda x: place.__setitem__(0, x))
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used():
    assert scratch_root(session("spark://host:7077", "hdfs://x/shared/")) == "hdfs://x/shared"
    assert scratch_root(session("yarn", checkpoint="hdfs://x/c")) == "hdfs://x/c"
    assert scratch_path(session("yarn", "s://a"), "n").startswith("s://a/tidewright/n-")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"])
def test_a_cluster_must_name_one(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session(master))


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_process_may_use_a_folder_of_its_own(master):
    made = session(master)
    assert os.path.isdir(scratch_root(made)) and scratch_root(made) == scratch_root(made)
