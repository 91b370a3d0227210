"""Scratch paths come from the session's shared checkpoint folder."""

from aidspark.session import RUNTIME_CONF, _checkpoint_root, prepare, scratch_dir


def test_scratch_dir_uses_session_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root and _checkpoint_root(spark) == root
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(root.rstrip("/") + "/aidspark/x-") and a != b


def test_prepare_is_idempotent(spark):
    prepare(prepare(spark))
    for k, v in RUNTIME_CONF.items():
        assert spark.conf.get(k) == v


def test_scratch_needs_a_shared_folder_off_one_machine():
    import pytest

    from aidspark.session import scratch_dir

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")
