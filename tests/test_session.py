from strata.session import checkpoint_root, default_parallelism, scratch_path, session_key, use_utc


def test_scratch_paths_live_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)
    assert checkpoint_root(spark) == root  # stable across calls


def test_utc_and_identity(spark):
    use_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session_key(spark) == session_key(spark)
    assert default_parallelism(spark) >= 1
