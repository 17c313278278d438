"""Region sheets in CSV: levels of a tree, deep chains, and sheets that are no tree."""

import pytest

from stratavox.sources import files as io


def sheet(tmp_path, rows, header="id,name,parent"):
    (tmp_path / "s.csv").write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")
    return str(tmp_path / "s.csv")


def test_levels_and_sheets(spark, tmp_path):
    path = sheet(tmp_path, ['1,"root, whole",,x', "2,a,1,x", "7,ü,2,x", " 3 ,b,1,x", "9,other root,,x"], "id,name,parent,colour")
    got = io.scan_regions(spark, path)
    assert sorted(map(tuple, got.collect())) == [(1, "root, whole", None, 0), (2, "a", 1, 1), (3, "b", 1, 1), (7, "ü", 2, 2), (9, "other root", None, 0)]
    io.write_level_sheets(got, str(tmp_path / "out"))
    back = spark.read.schema("region_id long, name string, parent_id long, level int").option("header", True).csv(str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, got.select(back.columns).collect()))
    assert {p.name for p in (tmp_path / "out").glob("level=*")} == {"level=0", "level=1", "level=2"}


def test_a_chain_of_300_levels(spark, tmp_path):
    got = io.scan_regions(spark, sheet(tmp_path, [f"{k},r{k},{k - 1 if k else ''}" for k in range(300)]))
    assert sorted((r["region_id"], r["level"]) for r in got.collect()) == [(k, k) for k in range(300)]


@pytest.mark.parametrize(("rows", "what"), [(["1,a,", "2,b,5"], "no region"), (["1,a,2", "2,b,1"], "cycle"), (["1,a,", "1,b,"], "repeated"), (["x,a,"], "ids that are no numbers"), (["1,a,", "2,b,one"], "parents that are no numbers")])
def test_sheets_that_are_no_tree(spark, tmp_path, rows, what):
    with pytest.raises(ValueError, match=what):
        io.scan_regions(spark, sheet(tmp_path, rows))


def test_missing_columns_and_no_rows(spark, tmp_path):
    with pytest.raises(ValueError, match="no column parent"):
        io.scan_regions(spark, sheet(tmp_path, ["1,a"], "id,name"))
    assert io.scan_regions(spark, sheet(tmp_path, [])).count() == 0
