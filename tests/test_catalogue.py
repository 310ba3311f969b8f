import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import duck, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.01"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_matches_sql(spark, con, name):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    assert (names, rows) == sql_rows(con, ORACLES[name])
    assert rows


ORDERED = """with_seq scan_user scan_global batch_n split_when zip_tables max3 concat merge_preferred balance
balance_mxn throttle shed_drop_tail shed_drop_buffer restart_scan scan_max scan_by_text scan_affine fold_affine""".split()


@pytest.mark.parametrize("name", ORDERED)
def test_query_matches_sql_when_groups_are_sliced(tiny_slices, con, name):
    """Every group of more than 4 or 40 rows is cut, as a huge one would be."""
    if name not in ("shed_drop_tail", "shed_drop_buffer", "split_when"):
        tiny_slices.conf.set("rillframe.sliceRows", "40")
    assert spark_rows(QUERIES[name](tiny_slices, FOLDER)) == sql_rows(con, ORACLES[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_text_package(tmp_path, pipeline):
    """The queries of the other operators load where the text package is not there, with or without the pipeline's file."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "rillframe", tmp_path / "rillframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", "bench.py", *["corpus_pipeline.py"] * (pipeline and (root / "corpus_pipeline.py").exists())]:
        shutil.copy(root / name, tmp_path / name)
    code = "import __spark_entry__ as e, bench; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    from rillframe.catalogue import QUERIES as own

    assert said.stdout.split() == sorted(own)
