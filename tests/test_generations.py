"""Schema generations: what widens, what is refused by name, rows under the declared schema."""

import pytest
from pyspark.sql import types as T

from cardlake.sources.generations import read_generations, refusals, widens


def _type(text):
    return T.DataType.fromDDL(text)


@pytest.mark.parametrize("found,declared,ok", [
    ("int", "long", True), ("long", "int", False), ("int", "double", True), ("long", "double", False),
    ("short", "float", True), ("int", "float", False), ("float", "double", True), ("double", "float", False),
    ("int", "decimal(10,0)", True), ("int", "decimal(10,2)", False), ("decimal(9,2)", "decimal(18,2)", True),
    ("decimal(18,2)", "decimal(18,4)", False), ("double", "decimal(18,2)", False), ("string", "date", False),
    ("int", "string", False), ("date", "timestamp", False), ("array<int>", "array<long>", True),
    ("struct<a:int>", "struct<a:long>", True), ("struct<a:int>", "struct<b:int>", False),
    ("map<string,float>", "map<string,double>", True), ("array<long>", "array<int>", False)])
def test_what_widens(spark, found, declared, ok):
    assert widens(_type(found), _type(declared)) is ok
    assert widens(_type(found), _type(found)) and widens(T.NullType(), _type(declared))


def test_refused_by_name(spark):
    declared = _type("struct<id:string,n:long,v:double>")
    assert refusals(_type("struct<id:string,n:int>"), declared, ["id"]) == []
    found = _type("struct<n:string,x:int>")
    assert refusals(found, declared, ["id"]) == ["missing id", "extra x", "type n: string doesn't fit bigint"]
    assert refusals(found, declared, extra="drop") == ["type n: string doesn't fit bigint"]
    with pytest.raises(ValueError, match="refuse"):
        refusals(found, declared, extra="keep")


def test_rows_of_all_generations(spark, tmp_root):
    declared = T.StructType.fromDDL("id string, n long, `a.b` double, note string")
    spark.createDataFrame([("x", 2147483647), (None, None)], "id string, n int").write.parquet(f"{tmp_root}/1")
    spark.createDataFrame([(7, 1.5, "y", 1 << 40)], "extra int, `a.b` float, id string, n long").write.parquet(f"{tmp_root}/2")
    got = read_generations(spark, [f"{tmp_root}/1", f"{tmp_root}/2"], declared, extra="drop")
    assert got.dtypes == [("id", "string"), ("n", "bigint"), ("a.b", "double"), ("note", "string")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("x", 2147483647, None, None), (None, None, None, None), ("y", 1 << 40, 1.5, None)], key=str)
    assert read_generations(spark, [], declared).count() == 0
    with pytest.raises(ValueError, match=r"/2: extra extra"):
        read_generations(spark, [f"{tmp_root}/1", f"{tmp_root}/2"], declared)
