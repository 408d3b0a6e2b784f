import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tintloom.session import local_session

    session = local_session(cpus=4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    tables = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
    connection = duckdb.connect()
    for t in tables.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection
