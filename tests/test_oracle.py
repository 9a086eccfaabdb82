"""Every query against its SQL, by names, types and values."""

import duckdb
import pytest

from tidemill.catalogue import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE_SQL[name])
    wanted_types = {d[0]: TYPES[str(d[1])] for d in cursor.description}
    assert dict(frame.dtypes) == wanted_types
    order = sorted(wanted_types)
    places = [[d[0] for d in cursor.description].index(c) for c in order]
    wanted = sorted((tuple(row[p] for p in places) for row in cursor.fetchall()), key=repr)
    found = sorted((tuple(row[c] for c in order) for row in frame.collect()), key=repr)
    assert len(found) == len(wanted)
    assert found == wanted
