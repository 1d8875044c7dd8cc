"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from folio.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "title", "author_text", "category_text", "quantity_text"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    res = duck.execute(registry.ORACLE_SQL[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_cols, res.fetchall())


def test_every_query_has_an_oracle_or_is_listed():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
    assert set(registry.QUERIES) <= set(entry.queries())


def test_command_line_lists_and_runs(spark, capsys, scratch):
    from folio.__main__ import main
    assert main(["list"]) == 0
    listed = capsys.readouterr().out.split()
    assert set(listed) == set(entry.queries())
    assert main(["run", "catalog_point", SF, "--out", f"{scratch}/point"]) == 0
    assert spark.read.parquet(f"{scratch}/point").count() == 1


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="catalog_point,link_parse", BENCH_DRIVER_MEMORY="1g")
    out = subprocess.run([sys.executable, os.path.join(repo, "bench.py")], env=env, cwd=repo,
                         capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert set(result["queries"]) == {"catalog_point", "link_parse"} and result["sf"] == 0.001
