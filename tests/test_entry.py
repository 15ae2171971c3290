import os

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# One query per family; ALL_QUERIES=1 runs every one.
SAMPLE = (
    "rows_per_report_90d", "grain_check", "null_profile", "top_beats", "rows_per_report_describe", "normalize_rows",
    "first_violation", "staging_counts", "csv_scan", "row_numbers", "load_job_refusals", "document_features", "header_check", "response_split", "batch_envelope",
    "observation_flatten", "feature_rules", "beat_consolidation", "nearest_of_listed", "beat_union", "beat_point",
)
NAMES = sorted(ORACLE) if os.environ.get("ALL_QUERIES") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def test_names_match():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["rows_per_key", "n_keys"] and frame.count() > 0


def ordered(rows):
    plain = [tuple(float(v) if type(v).__name__ == "Decimal" else v for v in row) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, v) for v in row))


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    columns = sorted(frame.columns)
    position = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(position) == columns
    expected = [tuple(row[position[c]] for c in columns) for row in result.fetchall()]
    assert ordered([tuple(row[c] for c in columns) for row in frame.collect()]) == ordered(expected)
