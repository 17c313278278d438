"""Ontologies in JSON documents of bounded size: whole trees come back, customers under their nations."""

import json
import os
from pathlib import Path

import pytest

from stratavox.plans import catalog
from stratavox.sources import files as io

DATA = Path(os.environ.get("QUERY_DATA", "/root/testdata/sf0.001"))
NODE = "region_id long, name string, above array<long>"


def lines(path):
    return [json.loads(line) for p in Path(path).glob("part-*") for line in p.read_text(encoding="utf-8").splitlines()]


def listed(nodes):
    return sum((not n.get("elsewhere", False)) + listed(n.get("children", [])) for n in nodes)


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_customers_are_leaves_of_the_one_tree(spark):
    got = {r["region_id"]: r for r in catalog.QUERIES["ontology_file"](spark, str(DATA)).collect()}
    assert [r["region_id"] for r in got.values() if r["parent_id"] is None] == [1000]
    customers = spark.read.parquet(f"{DATA}/customer.parquet").collect()
    assert len(got) == len(customers) + 1 + sum(spark.read.parquet(f"{DATA}/{t}.parquet").count() for t in ("region", "nation"))
    for c in customers:
        path = [got[c["c_custkey"] + 10000]]
        while path[-1]["parent_id"] is not None:
            path.append(got[path[-1]["parent_id"]])
        assert path[1]["region_id"] == c["c_nationkey"] + 1
        assert [r["level"] for r in path] == [3, 2, 1, 0]


def test_documents_are_bounded_and_the_tree_is_whole(spark, tmp_path):
    """A wide level, a path of five, names that need escapes or are missing, a parent that no document lists."""
    rows = [(1, "root", []), (2, 'a "quoted"\nname', [1]), (3, None, [1]), (4, "ü", [1, 2]), (5, "deep", [1, 2, 4]), (6, "deeper", [1, 2, 4, 5])]
    rows += [(k, f"leaf {k}", [1, 3]) for k in range(100, 150)] + [(900, "orphan", [1, None, 77]), (901, "lost", [1, None, None])]
    io.write_ontology(spark.createDataFrame(rows, NODE).repartition(3), str(tmp_path / "o"), lot=7)
    got = io.scan_ontology(spark, str(tmp_path / "o"), lines=True).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(i, n, above[-1] if above else None, len(above)) for i, n, above in rows], key=str)
    docs = lines(tmp_path / "o")
    assert sum(map(listed, docs)) == len(rows) and max(map(listed, docs)) == 7


def test_names_and_ids_that_a_level_lacks(spark, tmp_path):
    io.write_ontology(spark.createDataFrame([(1, None, []), (2, "x", [None])], NODE), str(tmp_path / "o"))
    assert sorted(map(tuple, io.scan_ontology(spark, str(tmp_path / "o"), lines=True).collect())) == [(1, None, None, 0), (2, "x", None, 1)]
    io.write_ontology(spark.createDataFrame([(5, "y", [None, 3])], NODE), str(tmp_path / "p"))
    assert [tuple(r) for r in io.scan_ontology(spark, str(tmp_path / "p"), lines=True).collect()] == [(5, "y", 3, 2)]


def test_odd_tables_give_what_the_sql_gives(spark, tmp_path):
    """Customers of no nation or an unknown one, a nation of an unknown region, rows twice; then no rows."""
    duckdb = pytest.importorskip("duckdb")
    tables = {
        "region": ([(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "KENYA", 0), (1, "NOWHERE", 9), (2, "EMPTY", 1), (0, "KENYA", 0), (3, None, None)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(0, "a", 0), (1, "b", 1), (2, "c", 8), (3, "d", None), (0, "a", 0), (123456, None, 3)], "c_custkey long, c_name string, c_nationkey int"),
    }
    for full in (True, False):
        d = tmp_path / str(full)
        for t, (data, schema) in tables.items():
            spark.createDataFrame(data if full else [], schema).write.parquet(f"{d}/{t}.parquet")
            duckdb.sql(f"create or replace view {t} as select * from '{d}/{t}.parquet/*.parquet'")
        want = duckdb.sql(f"select region_id, name, parent_id, level from ({catalog.ORACLE_SQL['ontology_file']})").fetchall()
        got = [tuple(r) for r in catalog.QUERIES["ontology_file"](spark, str(d)).select("region_id", "name", "parent_id", "level").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
