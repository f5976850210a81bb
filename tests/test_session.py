from arrivals.session import CLUSTER_CONF, scratch_path, scratch_root, unique_table_name


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert root == configured.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root + "/arrivals/x-") and a != b


def test_unique_table_names_and_cluster_profile():
    assert unique_table_name("t") != unique_table_name("t")
    assert CLUSTER_CONF["spark.sql.adaptive.enabled"] == "true"
    assert CLUSTER_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_cluster_profile_settings_are_valid(spark):
    from arrivals.session import apply_cluster_conf

    before = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        apply_cluster_conf(spark)
        for k, v in CLUSTER_CONF.items():
            assert spark.conf.get(k) == v
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
