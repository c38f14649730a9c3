import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from docketry.session import build_session

    session = build_session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"


def plain(value):
    """Values of either engine in one form: lists as tuples, floats rounded, missing as None."""
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return None if value != value else round(value, 6)
    return value


@pytest.fixture(scope="session")
def compare(spark, sf_dir):
    """Runs a query here and its SQL in DuckDB on the same tables; both must give the same columns and rows."""
    import duckdb

    engine = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split():
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")

    def run(query, sql):
        ours = query(spark, sf_dir)
        theirs = engine.execute(sql)
        names = [d[0] for d in theirs.description]
        assert sorted(ours.columns) == sorted(names)
        left = sorted((plain(tuple(r)) for r in ours.select(*sorted(names)).collect()), key=repr)
        order = [names.index(n) for n in sorted(names)]
        right = sorted((plain(tuple(r[i] for i in order)) for r in theirs.fetchall()), key=repr)
        assert left == right

    return run
