import os

import pytest
from pyspark.sql import functions as F

from cairnspark.llm import common


def test_scratch_is_below_the_shared_folder_and_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_base", lambda _: f"file://{tmp_path}/shared")
    assert common.staged(spark.range(5), "x").count() == 5
    assert len(os.listdir(tmp_path / "shared")) == 1 and common.clear_scratch(spark) >= 1
    assert os.listdir(tmp_path / "shared") == []
    first = common.staged(spark.range(1), "a")
    since = common.scratch_mark()
    common.staged(spark.range(2), "b")
    last = common.staged(spark.range(3), "c")
    assert common.clear_scratch(spark, since, 1) == 1 and (first.count(), last.count()) == (1, 3)


def test_names():
    assert common.fresh("a", ["A", "b"]) == "a_" and common.fresh("a", ["a", "A_"]) == "a__" and common.fresh("c", ["a"]) == "c"


def test_tags_hold(spark, documents, odd):
    """Of a file, and of rows that are none: one tag a row, the same on every reading."""
    for docs, copies in ((documents, 0), (documents.select("text", "doc_id").where("doc_id > 3"), 0), (odd, 1), (documents.repartition(3), 1), (documents.where(F.rand() < 0.5), 1)):
        made = len(common._made)
        rows = common.tagged(docs, "t")
        assert len(common._made) - made == copies and rows.columns == [*docs.columns, "t"]
        first, second = ({r["t"]: r["text"] for r in rows.select("t", "text").collect()} for _ in "ab")
        assert first == second and len(first) == rows.count()


def test_scratch_is_shared_off_local_masters():
    class Session:
        class conf:
            get = staticmethod(lambda k, d=None: d)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        common.shared_base(Session)
