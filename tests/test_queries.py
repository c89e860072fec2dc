"""Every query at the smallest scale, against its SQL."""

import __spark_entry__ as entry
import check
import pyspark
import pytest
from pyspark.ml.feature import StopWordsRemover

from tramline import catalogue
from tramline import fixed_values as fv

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {
    "split_random",
    "sample_rows",
    "ml_rf_score",
    "ml_lr_score",
    "ml_gbt_ovr_score",
    "ml_train_best",
    "ml_save_load_score",
}


@pytest.fixture(scope="module")
def sample_tables():
    return check.connect(SF_DIR)


@pytest.fixture(scope="module")
def oracles():
    return catalogue.oracles()


def test_only_inexpressible_queries_lack_sql(oracles):
    assert set(catalogue.QUERIES) - set(oracles) == ROWS_ONLY
    assert set(oracles) <= set(catalogue.QUERIES)


def test_entry_registers_the_catalogue(oracles):
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert oracles.items() <= entry.oracle_sql().items()


def test_check_sql_needs_no_spark_files(monkeypatch, folder, oracles):
    monkeypatch.setattr(pyspark, "__file__", f"{folder}/__init__.py")
    assert entry.oracle_sql().items() >= oracles.items()


def test_stop_words_are_sparks(spark):
    assert fv.STOP_WORDS == StopWordsRemover.loadDefaultStopWords(fv.STOP_WORD_LANGUAGE)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows == sorted(rows, key=lambda r: -r["TOTAL_VALIDATION"])


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, sample_tables, oracles, name):
    ok, rows, note = check.compare(spark, sample_tables, SF_DIR, catalogue.QUERIES[name], oracles.get(name))
    assert ok, note
