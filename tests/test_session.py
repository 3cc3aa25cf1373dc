from types import SimpleNamespace

import pytest

from clickmetrics.session import work_folder


def fake(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_folder_lies_in_the_shared_folder():
    first, second = (work_folder(fake("yarn", "/shared/x/"), "job") for _ in range(2))
    assert first.startswith("/shared/x/job-") and first != second


def test_only_local_sessions_may_lack_the_setting():
    assert "clickmetrics-" in work_folder(fake("local[2]"), "job")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(fake("yarn"), "job")
