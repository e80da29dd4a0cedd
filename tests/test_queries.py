"""Every query against its SQL on the supplied tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences
from tests.conftest import SF_DIR
from umbu.queries import REGISTRY


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert differences(df, duck, driver.oracle_sql()[name]) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == [
        "city_code", "cidade_cesta", "estado", "valor_cesta_medio", "populacao",
        "valor_total_gasto", "data_carga",
    ]
    assert df.count() > 0


def test_every_query_is_checked():
    assert set(REGISTRY) <= set(driver.queries())
    assert set(REGISTRY) <= set(driver.oracle_sql())


@pytest.mark.parametrize("lack", ["nothing", "emptied", "hidden"])
def test_the_rest_loads_without_the_training_data_queries(tmp_path, lack):
    """With their folder gone but for itself, or with a library they need hidden."""
    root = Path(driver.__file__).parent
    ignore = shutil.ignore_patterns(".git", "tests", "__pycache__", *(["llm"] if lack == "emptied" else []))
    shutil.copytree(root, tmp_path / "copy", ignore=ignore)
    if lack == "emptied":
        (tmp_path / "copy/umbu/llm").mkdir()
    hide = "import sys; sys.modules['numpy'] = None; " if lack == "hidden" else ""
    names = f"{hide}import __spark_entry__ as d; print(*d.queries())"
    run = subprocess.run([sys.executable, "-c", names], cwd=tmp_path / "copy", capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    assert set(REGISTRY) <= set(run.stdout.split())
    there = (root / "umbu/llm/queries.py").exists() and (root / "corpus_pipeline.py").exists()
    assert ("without the training-data queries" in run.stderr) == (lack != "nothing" or not there)
