"""Session helpers: shared folders and the cluster profile."""

from livetables import session


def test_scratch_paths_are_fresh_and_under_the_checkpoint_folder(spark):
    base = session.ensure_checkpoint_dir(spark)
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))


def test_cluster_profile_applies_sql_settings_only(spark):
    keys = [k for k in session.CLUSTER_CONF if k.startswith("spark.sql.")]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        session.apply_conf(spark)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20000"
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == session.CLUSTER_CONF["spark.sql.autoBroadcastJoinThreshold"]
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before["spark.sql.shuffle.partitions"]


def test_session_key_is_stable(spark):
    assert session.session_key(spark) == session.session_key(spark)
