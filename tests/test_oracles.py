import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import output_queries, queries, record_queries  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(x):
    if x is None or x != x:
        return None
    return round(float(x), 9) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows(frame):
    names = sorted(frame.columns)
    frame = frame[names].astype(object).where(frame[names].notna(), None)
    return names, sorted(str([value(x) for x in r]) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert rows(queries.QUERIES[name](spark, sf).toPandas()) == rows(db.sql(queries.ORACLE_SQL[name]).df())


def test_office_files_of_other_parts(spark, tmp_path):
    """Archives without a single file that are cut off, and names that XML escapes or encodes in more bytes than signs."""
    names = ["a plain name", "salt & <pepper>", "crème brûlée", "日本語"]
    parts = [(k, names[(k + size) % 4], size) for k, size in zip([*range(1, 45), 630, 840], [6, 18, 1, 2, 3, 4, 12, 5, 30] * 6)]
    spark.createDataFrame([*parts, (63, "empty", 6), (147, "empty", 18)], "p_partkey long, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    assert rows(queries.QUERIES["office_peeks"](spark, str(tmp_path)).toPandas()) == rows(db.sql(queries.ORACLE_SQL["office_peeks"]).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
