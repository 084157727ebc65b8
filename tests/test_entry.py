import os

from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.group import GroupedData

import __spark_entry__ as E
from quarry.plans import registry


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == ["word", "n"]
    assert 0 < len(rows) <= 20


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.oracle())


def test_no_python_and_no_scratch_left_in_any_query(spark, tmp_dir, monkeypatch):
    """Every query of the core library stays JVM-side, in its result and in every job it runs before: no frame of any
    kind is handed to Python, and after it only tables that the result reads are left on scratch."""
    from plans import plan_text
    from quarry import session
    from quarry.plans.registry import QUERIES

    def refused(*_, **__):
        raise AssertionError("rows are handed to Python")

    for kind, names in ((DataFrame, ("mapInArrow", "mapInPandas", "toPandas", "toArrow", "foreach", "foreachPartition", "rdd")),
                        (GroupedData, ("applyInPandas", "applyInArrow", "cogroup"))):
        for name in names:
            monkeypatch.setattr(kind, name, property(refused) if name == "rdd" else refused)
    monkeypatch.setattr(session, "checkpoint_dir", lambda _: tmp_dir)
    for name, q in QUERIES.items():
        made = set(os.listdir(tmp_dir))
        result = q(spark, E.SMOKE_DIR)
        read = {part for f in result.inputFiles() for part in f.split("/")}
        assert set(os.listdir(tmp_dir)) - made <= read, name
        plan = plan_text(result)
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsIn", "MapInPandas", "MapInArrow"):
            assert marker not in plan, (name, marker)
        assert result.count() >= 0
