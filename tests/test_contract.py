import duckdb
import pytest

import __spark_entry__ as contract
import check_oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in check_oracle.TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    result = check_oracle.compare(spark, con, SF_DIR, name)
    assert "DIFFER" not in result, result


def test_only_trained_queries_lack_an_oracle():
    own = {name for name in contract.queries() if not name.startswith("op") and name != "pipeline"}
    assert own - set(contract.oracle_sql()) == {"gbt_train_eval", "gbt_importance", "gbt_submission"}
    assert set(contract.oracle_sql()) <= set(contract.queries())
