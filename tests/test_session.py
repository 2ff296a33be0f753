import pytest

from skyroute.session import DEFAULT_CONF, ensure_checkpoint_dir, scratch_path, state_off_heap


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert configured.rstrip("/").split("/")[-1] in root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root.rstrip("/") + "/skyroute/") and a != b


def test_no_machine_local_scratch_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_session_defaults(spark):
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"
    for key in ("spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit",
                "spark.sql.session.timeZone"):
        assert spark.conf.get(key) == DEFAULT_CONF[key]


def test_streams_of_other_sessions_keep_their_state_off_the_heap():
    class Session:
        def __init__(self, store):
            self.conf = {"spark.sql.streaming.stateStore.providerClass": store}

    class Conf(dict):
        set = dict.__setitem__

    def after(store):
        session = Session(store)
        session.conf = Conf(session.conf)
        state_off_heap(session)
        return session.conf
    key = "spark.sql.streaming.stateStore.providerClass"
    spark_own = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    assert {k: v for k, v in DEFAULT_CONF.items() if ".stateStore." in k} == after(spark_own)
    assert after(DEFAULT_CONF[key])[key] == DEFAULT_CONF[key]
    assert after("my.Provider") == {key: "my.Provider"}


def test_the_package_is_shipped_whole(tmp_path):
    """What ``ship_package`` sends can be imported by a Python that has nothing else of the repository."""
    import os
    import shutil
    import subprocess
    import sys

    from skyroute.session import ship_package

    class Context:
        def addPyFile(self, path):
            shutil.copy(path, tmp_path / "sent.zip")

    class Session:
        sparkContext = Context()

    ship_package(Session())
    code = ("import skyroute, skyroute.jobs, skyroute.sources.ingest, skyroute.plans.catalog as c; "
            "print(skyroute.__file__, len(c.QUERIES))")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                          env=os.environ | {"PYTHONPATH": str(tmp_path / "sent.zip")})
    assert done.returncode == 0 and "sent.zip" in done.stdout, done.stderr[-1000:]


def test_small_methods_in_a_session_of_others(spark):
    from skyroute.session import small_methods
    key, had = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        for before, after in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(key, before)
            small_methods(spark)
            assert spark.conf.get(key) == after
    finally:
        spark.conf.set(key, had)
