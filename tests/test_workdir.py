"""Where tables are kept, and when they go."""

import os

import pytest

from shardlog.sources.files import exists, read_text, write_text
from shardlog.workdir import materialised, temporary, work_dir


class Session:
    """A session's settings only."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_a_cluster_needs_a_shared_folder():
    local = Session(spark_master="local[4]", spark_sql_warehouse_dir="/w")
    assert work_dir(local, "x").startswith("/w/shardlog/x-")
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(Session(spark_master=master, spark_sql_warehouse_dir="/w"), "x")
        assert work_dir(Session(spark_master=master, spark_checkpoint_dir="/c/"), "x").startswith("/c/shardlog/x-")


def test_a_scope_removes_what_was_stored_in_it(spark):
    outside = materialised(spark.range(3), "outside")
    with temporary(spark):
        path = work_dir(spark, "inside")
        spark.range(5).write.parquet(path)
        with pytest.raises(ZeroDivisionError), temporary(spark):
            inner = work_dir(spark, "inner")
            spark.range(1).write.parquet(inner)
            raise ZeroDivisionError
        assert exists(spark, path) and not exists(spark, inner)
    assert not exists(spark, path) and outside.count() == 3


def test_small_texts_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "a" / "text")
    assert read_text(spark, path) is None
    for text in ("one", "two é", ""):
        write_text(spark, path, text)
        assert read_text(spark, path) == text
    assert [n for n in os.listdir(tmp_path / "a") if not n.startswith(".")] == ["text"]


def test_the_entry_stands_without_the_corpus_operators(tmp_path):
    """A missing library is like missing folders: the other queries are there."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['tokenizers'] = None; import __spark_entry__ as e; n = e.queries(); assert len(n) > 50 and not any(x.startswith('op') and x[2:3].isdigit() for x in n)"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
