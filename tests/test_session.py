from __future__ import annotations

import os

import pytest

from conftest import rows
from loomframe import session


def test_staged_copies_live_in_the_shared_folder(spark):
    df = spark.range(5)
    copy = session.stage(df, "copy")
    assert rows(copy) == rows(df)
    path = copy.inputFiles()[0].removeprefix("file://")
    assert spark.conf.get("spark.checkpoint.dir") in path
    assert session.drop_staged(spark) >= 1 and not os.path.exists(path)
    assert session.drop_staged(spark) == 0


class _Stub:
    """A session without the setting, on a master of our choice."""

    def __init__(self, master: str):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})()


def test_a_cluster_needs_the_setting(spark):
    assert session.shared_dir(_Stub("local[2]")) == session.shared_dir(_Stub("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Stub("yarn"))


def test_one_staged_copy_can_go_alone(spark):
    first, second = (session.stage(spark.range(n), "part") for n in (3, 4))
    folder = os.path.dirname(first.inputFiles()[0].removeprefix("file:").replace("///", "/"))
    assert os.path.exists(folder)
    session.discard(first)
    assert not os.path.exists(folder) and second.count() == 4
    assert session.drop_staged(spark) >= 1
