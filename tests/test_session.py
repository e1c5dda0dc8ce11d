"""Checkpoint folder: read from the session, never replaced."""

from __future__ import annotations

from tillroll.session import checkpoint_dir, ensure_checkpoint_dir


def test_existing_checkpoint_dir_is_kept(spark):
    before = checkpoint_dir(spark)
    assert before
    assert ensure_checkpoint_dir(spark, scratch_if_unset=True) == before
    assert ensure_checkpoint_dir(spark) == before
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    import pytest

    from tillroll import session
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn", getConf=lambda: {},
                         setCheckpointDir=lambda d: pytest.fail("no folder may be made up on a cluster"))
    cluster = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: None))
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(cluster, scratch_if_unset=True)
    assert session.ensure_checkpoint_dir(cluster) is None
