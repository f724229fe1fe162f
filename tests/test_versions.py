"""Commits of versioned tables: one writer takes each number, and a change is made from what it replaces."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from hearth.sources import sinks


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_writers_at_once_lose_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.write_version(spark.range(0), root)

    def add(k):
        return sinks.update_version(spark, root, lambda now: now.union(spark.range(k, k + 1)))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(6)))
    assert _ids(sinks.read_current(spark, root)) == list(range(6))
    assert sinks.current_version(spark, root) == 7


def test_full_refreshes_at_once_all_commit(spark, tmp_path):
    root = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: sinks.write_version(spark.range(k, k + 1), root), range(4)))
    assert sinks.current_version(spark, root) == 4
    assert sorted(_ids(sinks.read_current(spark, root, n))[0] for n in range(1, 5)) == [0, 1, 2, 3]


def test_a_stale_base_commits_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.write_version(spark.range(1), root, base=0)
    with pytest.raises(sinks.VersionConflict):
        sinks.write_version(spark.range(2), root, base=0)
    assert _ids(sinks.read_current(spark, root)) == [0] and sinks.read_current(spark, str(tmp_path / "none")) is None


def test_a_commit_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/_pointers/000000000001"
    (tmp_path / "_pointers").mkdir()
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: sinks._create(spark, path, f"v{k}"), range(8)))
    assert sum(made) == 1
    text = open(path).read()
    assert text == f"v{made.index(True)}"
    assert sinks._pointers(spark, str(tmp_path)) == ["000000000001"]


def test_reload_with_no_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.truncate_reload(spark.range(5), root)
    assert sinks.truncate_reload(spark.range(0), root).count() == 0
