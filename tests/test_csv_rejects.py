"""Malformed CSV records go to the rejects, whatever is selected of the rows."""

import pytest

from hazardspark.sources import tables


@pytest.mark.parametrize("line_breaks", [True, False])
def test_rows_and_rejects(spark, tmp_path, line_breaks):
    cell = '"two\nlines, ""quoted"""' if line_breaks else '"one line"'
    (tmp_path / "a.csv").write_text(f"id,n,note\n1,5,{cell}\n2,x,bad number\n3,7\n4,8,more,cells\n5,,\n")
    good, bad = tables.csv_with_rejects(spark, str(tmp_path / "a.csv"), _schema(), line_breaks)
    assert sorted(r["id"] for r in good.collect()) == [1, 5] and sorted(r["id"] for r in good.select("id").collect()) == [1, 5]
    assert good.count() == 2 and good.where("id = 1").first()["note"] == ('two\nlines, "quoted"' if line_breaks else "one line")
    got = bad.collect()
    assert sorted(r["record"].split(",")[0] for r in got) == ["2", "3", "4"] and all(r["file"].endswith("a.csv") for r in got)


def _schema():
    from pyspark.sql.types import StructType

    return StructType.fromDDL("id long, n long, note string")
