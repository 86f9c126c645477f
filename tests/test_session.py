import os

from volpanel.session import ensure_checkpoint_dir, stable


def test_checkpoints_go_to_the_session_checkpoint_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder == spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == folder  # stable across calls
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert folder.replace("file:", "").startswith(configured.replace("file:", ""))
    df = stable(spark.range(100))
    assert df.count() == 100
    path = folder.replace("file:", "")
    assert os.path.isdir(path) and any(os.scandir(path))
