"""Session settings: what the submitter set stays; nothing private on a cluster."""

import pytest

from campuslens import session as S


def test_submitted_settings_stay():
    given = {"spark.master": "yarn", "spark.sql.shuffle.partitions": "4000", "spark.sql.adaptive.enabled": "false"}
    conf = S.session_conf(given)
    assert not set(conf) & set(given)
    assert S.session_conf({"spark.master": "yarn"}).get("spark.sql.shuffle.partitions") is None


def test_a_bare_session_is_local():
    conf = S.session_conf({})
    assert conf["spark.master"] == S.LOCAL_MASTER and conf["spark.sql.shuffle.partitions"] == str(S.LOCAL_PARTITIONS)
    assert S.session_conf({"spark.master": "yarn"}, master="local[2]")["spark.master"] == "local[2]"


def test_sizes_follow_the_input_and_buckets_are_capped():
    small, large = S.session_conf({}, input_bytes=1 << 30), S.session_conf({}, input_bytes=100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) == S.MAX_BUCKETS
    assert "spark.sql.shuffle.partitions" not in S.session_conf({"spark.sql.shuffle.partitions": "7"}, input_bytes=1 << 40)


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Cluster:
    """A session on a cluster without a shared folder."""

    def __init__(self, master, **conf):
        self.conf = _Conf({"spark.master": master, **conf})

    @property
    def sparkContext(self):
        raise RuntimeError("not here")


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_Cluster("yarn"))
    assert S.ensure_checkpoint_dir(_Cluster("yarn", **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    assert S.ensure_checkpoint_dir(_Cluster("local[2]"))
