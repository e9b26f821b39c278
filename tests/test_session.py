from shelfcast.session import checkpoint_dir, drop_path, ensure_defaults, scratch_path, stage_table


def test_checkpoint_dir_is_read_from_session(spark):
    before = spark.conf.get("spark.checkpoint.dir")
    ensure_defaults(spark)
    assert spark.conf.get("spark.checkpoint.dir") == before        # never overridden
    assert checkpoint_dir(spark) == before
    assert scratch_path(spark, "x").startswith(before.rstrip("/") + "/x-")


def test_stage_table_round_trip_and_drop(spark):
    import os
    df = spark.range(100)
    staged, path = stage_table(df, "t")
    assert staged.count() == 100 and path.startswith(checkpoint_dir(spark).rstrip("/"))
    drop_path(spark, path)
    assert not os.path.exists(path.replace("file:", ""))
