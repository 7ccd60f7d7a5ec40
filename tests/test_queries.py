"""Every registered query with SQL agrees with DuckDB on the smallest tables; the others give rows."""

import collections
import os

import pytest

import __spark_entry__ as entry
from tidemark.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return con


def _cell(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    return f"{float(v):.6g}" if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(columns, found.fetchall())


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_ids_are_the_blueprints():
    assert len(QUERIES) > 200


@needs_data
def test_json_captions_are_whole(spark):
    from tidemark.plans import mapping as mp

    told = collections.defaultdict(list)
    for r in mp.segments(spark, SF).orderBy("video_id", "ord").collect():
        told[r.video_id].append(r.text)
    assert max(len(t) for texts in told.values() for t in texts) > 40
    for r in QUERIES["snk_json_caps"](spark, SF).collect():
        assert r.captions == "\n".join(told[r.video_id])
    for name in ("snk_srt", "snk_vtt", "snk_pkg_srt_vtt", "snk_txt"):
        for r in QUERIES[name](spark, SF).collect():
            assert all(t in r.body for t in told[r.video_id])
