import os
from types import SimpleNamespace

import pytest

from millrace import session


def _session(master, settings):
    made = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append
    )
    conf = SimpleNamespace(get=settings.get)
    return SimpleNamespace(conf=conf, sparkContext=context), made


def test_the_clusters_folder_is_used():
    fake, made = _session("yarn", {"spark.checkpoint.dir": "s3a://bucket/work"})
    assert session.shared_root(fake) == "s3a://bucket/work" and made == ["s3a://bucket/work"]
    assert session.shared_root(fake) == "s3a://bucket/work" and len(made) == 1


def test_work_paths_lie_in_one_folder_of_the_application(spark):
    first, second = session.work_path(spark, "x"), session.work_path(spark, "x")
    folder = f"{session.shared_root(spark)}/millrace-{spark.sparkContext.applicationId}"
    assert first.startswith(f"{folder}/x-") and first != second and os.path.isdir(folder)


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_a_cluster_without_a_folder_is_an_error(master):
    fake, made = _session(master, {})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(fake)
    assert not made


def test_a_local_session_gets_one_folder():
    fake, made = _session("local[4]", {})
    assert session.shared_root(fake) == session.shared_root(fake) == made[0]


def test_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
