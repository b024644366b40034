"""The shared folder of sessions that name one, and of those that do not."""

import os
from types import SimpleNamespace

import pytest

from barloom import session


def fake(master, path=None, application="app-test"):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: path or default),
                           sparkContext=SimpleNamespace(master=master, applicationId=application))


def test_named_folder_is_used():
    assert session.shared_dir(fake("spark://host:7077", "/shared/folder/")) == "/shared/folder"
    assert session.stage_root(fake("local[2]", "/shared")) == "/shared/barloom-app-test"


def test_local_session_without_a_folder_gets_one_of_its_own():
    first = session.shared_dir(fake("local[2]"))
    assert os.path.isdir(first) and session.shared_dir(fake("local[2]")) == first
    assert session.shared_dir(fake("local[2]", application="app-other")) != first


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(fake("spark://host:7077"))
