from types import SimpleNamespace

import pytest

from greenshoe.session import build_session, materialize, shared_folder


def fake(master, folder=None):
    """A session without the cluster's setting, as far as ``shared_folder`` looks at it."""
    state = {"dir": None}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=path),
    )
    return SimpleNamespace(conf={"spark.checkpoint.dir": folder}, sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_folder(fake("yarn", "hdfs:///shared")) == "hdfs:///shared"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(ValueError):
        shared_folder(fake("yarn"))


def test_a_local_session_gets_one_folder():
    session = fake("local[2]")
    assert shared_folder(session) == shared_folder(session) != ""


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(5).selectExpr("id", "cast(id as decimal(18,2)) d", "cast(null as date) x")
    table = materialize(df, "t")
    assert table.schema.simpleString() == df.schema.simpleString()
    assert sorted(table.collect()) == sorted(df.collect())
    assert "Range" not in table._jdf.queryExecution().toString()


def test_settings(spark):
    session = build_session("tests", "local[8]")
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
