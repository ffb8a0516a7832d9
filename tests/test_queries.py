"""Every registered query against its oracle SQL, and the plans that matter."""

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
TABLES = ["documents", "conversations", "embeddings"]


@pytest.fixture(scope="module")
def connection(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def plain(value):
    return repr(value) if isinstance(value, float) else str(value)


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    assert rows
    if name not in ORACLES:
        return
    result = connection.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    types = dict(frame.dtypes)
    assert [TYPES[types[c]] for c in columns] == [str(result.description[i][1]) for i in order]
    assert rows == sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_split_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["caption_scan"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,de)]" in plan


def test_grams_and_texts_are_not_shuffled(spark, sf_dir):
    spark.conf.unset("spark.capstan.input.partitions")
    try:
        plan = plan_of(QUERIES["bleu_corpus"](spark, sf_dir))
    finally:
        spark.conf.set("spark.capstan.input.partitions", "4")
    # The one exchange is that of the sums.
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("MapInArrow")


def test_entry(spark):
    assert entry.entry(spark).count() == 4
