"""Every SQL-checkable key against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as se
from tools.check_oracle import digest
from tests.conftest import SF_SMALL

SQL_KEYS = sorted(se.oracle_sql())
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}


@pytest.mark.parametrize("key", SQL_KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = se.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert df.columns == ocols
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = {d[0]: DUCK_TO_SPARK.get(str(d[1]), str(d[1])) for d in res.description}
    assert spark_types == duck_types
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


def test_every_key_is_registered_once():
    keys = se.queries()
    assert set(se.oracle_sql()) <= set(keys)
    assert len(keys) >= 70


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns[0] == "project_id" and df.count() > 0
