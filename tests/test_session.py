from quarterlens.session import CHECKPOINT_CONF, ensure_checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    folder = ensure_checkpoint_dir(spark)
    if configured:  # the session (cluster or defaults file) names it: it wins
        assert folder == configured
    assert spark.sparkContext.getCheckpointDir() is not None
    assert ensure_checkpoint_dir(spark) == folder  # idempotent
