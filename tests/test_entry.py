import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobsluice.sources import work

ROOT = Path(__file__).resolve().parent.parent
LIST = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(*q)"


def listed(folder):
    done = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


def test_queries_are_listed_without_a_session():
    """The driver lists names before there is a session."""
    assert listed(ROOT)


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_queries_are_listed_without_the_training_data_part(tmp_path, with_pipeline):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for folder in (copy / "jobsluice" / "llm", copy / "tests" / "llm"):
        if folder.exists():
            shutil.rmtree(folder)
    if not with_pipeline:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    names = listed(copy)
    assert names and not any(n.startswith("op") or n == "pipeline" for n in names)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="checkpoint"):
        work.shared_dir(Session())
    Context.master = "local[2]"
    assert work.shared_dir(Session()).startswith("file:/")


def test_stored_tables_can_go(spark):
    table = work.stored(spark.range(5).withColumn("x", F.col("id") * 2))
    assert table.count() == 5
    work.dropped(table)
    assert not Path(table._stored_path.removeprefix("file://")).exists()
