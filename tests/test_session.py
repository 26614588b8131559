import pytest

from ticklake import session


class FakeSession:
    def __init__(self, master, named=None):
        self.sparkContext = type("C", (), {"master": master})()
        self.conf = type("F", (), {"get": staticmethod(lambda key, default: named or default)})()


def test_shared_folder_comes_from_the_session():
    assert session.shared_dir(FakeSession("yarn", "hdfs://x/checkpoints/")) == "hdfs://x/checkpoints"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("yarn"))


def test_local_fallback_is_one_folder():
    assert session.shared_dir(FakeSession("local[2]")) == session.shared_dir(FakeSession("local[2]"))
