"""Records in byte ranges, inferred schemas and date layouts against plain readers and hand-made cases."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabula.operators import dates
from tabula.operators.sizing import shared_folder
from tabula.sources import delimited, inference, records


@pytest.fixture
def small_ranges(spark):
    def limit(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield limit
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(key)


def messy(seed, n):
    r = random.Random(seed)

    def cell():
        return r.choice(["", "plain 7", '5" disk', '""', '"q"', '"line\nbreak ""q"", %s"' % ("x" * r.randrange(30)), '"a\r\nb\n\n,c"', "é中"])
    return "\n".join(["a,b,c"] + [",".join(cell() for _ in range(r.choice([3, 3, 3, 2, 4]))) for _ in range(n)]) + "\n"


@pytest.mark.parametrize("size", ["128m", "300", "60", "17"])
def test_ranges_give_the_rows_of_a_whole_read(spark, tmp_path, small_ranges, size):
    files = {"one.csv": messy(1, 90), "two.csv": 'a,b,c\r\n1,"x\r\ny",3\r\n\r\n4,5,6\r\n', "open.csv": 'a,b,c\n1,2,3\n4,"never\nends', "none.csv": ""}
    for name, text in files.items():
        (tmp_path / name).write_text(text, newline="")
    path = f"file://{tmp_path}"
    schema = StructType([*delimited.text_schema(["a", "b", "c"]), StructField("_corrupt", StringType())])
    whole = spark.read.schema(schema).option("header", True).option("multiLine", True).options(**delimited._RULES).csv(path)
    whole = whole.where(F.col("_corrupt").isNull() | ~delimited._overlong(3)).drop("_corrupt")
    want = sorted(map(repr, map(tuple, whole.collect())))
    small_ranges(size)
    rows = delimited.read_csv(spark, path, ["a", "b", "c"])
    got = sorted(map(repr, map(tuple, rows.collect())))
    assert [g for g in got if "never" not in g] == [w for w in want if "never" not in w] and sum("never" in g for g in got) == 1
    assert rows.count() == len(want)
    if size == "17":
        assert records._lines(spark, path).rdd.getNumPartitions() > 40


def test_count_and_header_of_plain_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,"na,me"\n1,a\n2\n3,b,c\n')
    path = f"file://{tmp_path}"
    assert delimited.header_of(spark, path) == ["id", "na,me"]
    for multiline in (True, False):
        rows = delimited.read_csv(spark, path, multiline=multiline)
        assert rows.columns == ["id", "na,me"] and rows.count() == 2 and rows.select("id").count() == 2
    assert delimited.overlong_rows(spark, path, ["id", "name"]).count() == 1
    (tmp_path / "x.csv").write_text("")
    with pytest.raises(ValueError):
        delimited.header_of(spark, path)


@pytest.mark.parametrize("line, inside, ends", [
    ("a,b", False, False), ('a,"b', False, True), ('a,"b""', False, True), ('a,"b"""', False, False), ('5" x,6"', False, False),
    ('x",b', True, False), ('x"",b', True, True), ('x",b,"', True, True), ('"",""', False, False), ('"a"b,"c', False, True), ("", True, True)])
def test_what_a_line_does_to_the_quotes(line, inside, ends):
    assert records.ends_inside(line, inside) == ends


def test_schema_lattice(spark):
    rows = [("1", "1", "1", "2024-01-02", "x", None, "NA", "007"), ("-2", "2.5", "2024-01-02", "2024-01-02T10:00:00Z", "1", " ", "3", "1e5"),
            ("+3", ".5", "", "2024-01-02 10:00", "", "", "", "12345678901234567890")]
    df = spark.createDataFrame(rows, "i string, d string, mix string, t string, x string, e string, n string, `odd name` string").withColumn("k", F.lit(1))
    found = inference.infer_schema(df, ["NA"]).orderBy("position").collect()
    assert [(r["column"], r["type"]) for r in found] == [
        ("i", "integer"), ("d", "decimal"), ("mix", "text"), ("t", "timestamp"), ("x", "text"), ("e", "empty"), ("n", "integer"), ("odd name", "decimal")]
    assert tuple(found[2])[3:] == (3, 1, 1, 0, 1, 0)
    typed = inference.typed(df, ["NA"])
    assert dict(typed.dtypes) == {"i": "bigint", "d": "double", "mix": "string", "t": "timestamp", "x": "string", "e": "string", "n": "bigint",
                                  "odd name": "double", "k": "int"}
    assert sorted(r["n"] or 0 for r in typed.collect()) == [0, 0, 3]
    # the order of rows does not matter, and an empty table decides nothing
    again = inference.infer_schema(df.orderBy(F.desc("i")), ["NA"]).orderBy("position").collect()
    assert found == again
    assert {r["type"] for r in inference.infer_schema(df.limit(0)).collect()} == {"empty"}


def test_layouts_come_from_the_column(spark):
    def parsed(cells, **options):
        df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, w string")
        return [r["m"] and r["m"].strftime("%Y-%m-%d %H:%M") for r in dates.with_dates(df, "w", "m", **options).orderBy("i").collect()]
    assert parsed(["2024/05/01", "May 1, 2024", "1 May 2024 10:00", "sept. 3, 2021", "2024-05-01T07:08:09", "1-Jun-2020"]) == [
        "2024-05-01 00:00", "2024-05-01 00:00", "2024-05-01 10:00", "2021-09-03 00:00", "2024-05-01 07:08", "2020-06-01 00:00"]
    assert parsed(["01.05.2024", "31.12.2024"]) == ["2024-05-01 00:00", "2024-12-31 00:00"]  # day first, seen at 31
    assert parsed(["01/05/2024", "12/31/2024"]) == ["2024-01-05 00:00", "2024-12-31 00:00"]
    assert parsed(["01/05/2024"]) == ["2024-01-05 00:00"] and parsed(["01/05/2024"], day_first=True) == ["2024-05-01 00:00"]
    assert parsed(["3/4/2024 1:05 pm", "3/14/2024 12:00 AM"]) == ["2024-03-04 13:05", "2024-03-14 00:00"]
    assert parsed([None, "", "soon", "2024-13-45", "2024-05-01 10:00:00.5Z"]) == [None, None, None, None, "2024-05-01 10:00"]
    df = spark.createDataFrame([("2024/05/01",), ("soon",), ("later",), ("2024/99/01",), (None,)], "w string")
    assert sorted(map(tuple, dates.unread_shapes(df, "w").collect())) == [("Y/9/9", 2, 1), ("a", 2, 2)]
