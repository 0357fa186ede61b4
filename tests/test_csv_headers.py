from __future__ import annotations

from pyspark.sql.types import StructType

from fleetspark.sources.evolution import LINE, csv_lines, parse_csv_by_header
from tests.conftest import rows


def test_headers_are_worked_out_once_a_file(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text("id,amount,name\n1,2.5,x\n2,,\n3,bad,z\n4,1.0\n5,1.0,q,9\n\n")
    (land / "b.csv").write_text('﻿name,"region",id,amount\n"a, b","NORTH, 1",6,7.5\n"say, hi",,7,\n p ,S,8,"1.5"\n')
    schema = StructType().add("id", "string").add("amount", "double").add("name", "string")
    got = parse_csv_by_header(csv_lines(spark.read.text(str(land)).select(LINE, "_metadata")), schema)
    assert rows(got) == sorted([
        ("1", 2.5, "x", None, None), ("2", None, None, None, None), ("3", None, "z", None, "3,bad,z"),
        ("4", 1.0, None, None, "4,1.0"), ("5", 1.0, "q", None, "5,1.0,q,9"),
        ("6", 7.5, "a, b", '{"region":"NORTH, 1"}', None), ("7", None, 'say, hi', '{"region":null}', None), ("8", 1.5, " p ", '{"region":"S"}', None),
    ], key=repr)
    plan = got._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "array_position" not in plan
