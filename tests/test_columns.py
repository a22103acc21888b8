"""Names, types, JSON lists, grids, schema checks."""

import pytest
from pyspark.sql import functions as F

from lakeops.functions.jsoncols import list_long, list_of, list_text, list_wide
from lakeops.functions.names import distinct_names, name_blank, rename_all, snake, squeeze, underscore
from lakeops.operators.mapping import Field, SchemaMismatch, add_missing, check_columns, map_columns
from lakeops.operators.quality import Rule, evaluate
from lakeops.plans.feeds import CATEGORIES, CUSTOMERS, FRAUD_COLUMNS, TRANSACTIONS, centers, fraud_rows, phone_lists, shape
from lakeops.sources.grid import grid_to_columns, grid_to_json


def test_rules():
    assert underscore("No. of Login") == "no__of_login"
    assert squeeze(" Center\nName ") == "centername"
    assert snake("Full\r Name ") == "full_name"
    assert distinct_names(["a", "a", "a_2", "a"]) == ["a", "a_3", "a_2", "a_4"]


def test_blank_headings(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["_c0", "b", " "])
    assert name_blank(df, "center_code").columns == ["center_code", "b", " "]
    assert name_blank(df, "center_code", first_only=False).columns == ["center_code", "b", "center_code_2"]
    assert rename_all(df, underscore).columns == ["_c0", "b", "_"]


def test_mapping_takes_first_spelling_and_parses(spark):
    df = spark.createDataFrame([("007", "20240229120000", "x", "1")], ["ID no.", "when", "level", "trust_level"])
    fields = [
        Field("id no.", "id"),
        Field("when", "at", "timestamp", "yyyyMMddHHmmss"),
        Field(("missing", "trust_level", "level"), "level", "int"),
    ]
    row = map_columns(df, fields).first()
    assert (row["id"], str(row["at"]), row["level"]) == ("007", "2024-02-29 12:00:00", 1)
    with pytest.raises(ValueError):
        map_columns(df, [Field("absent", "absent")])
    assert map_columns(df, [Field("absent", "absent", "int")], missing="null").first()[0] is None


def test_schema_check(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "B"])
    assert check_columns(df, ["b", "A"], ignore_case=True) is df
    with pytest.raises(SchemaMismatch) as error:
        check_columns(df, ["a", "c"])
    assert (error.value.missing, error.value.extra) == (["c"], ["B"])
    assert add_missing(df, {"b": "int", "c": "int"}).columns == ["a", "B", "c"]


@pytest.mark.parametrize(
    "cell,values",
    [
        ("0900000001", ["0900000001"]),
        ('"0900000001", "0900000002"', ["0900000001", "0900000002"]),
        (" 1 ,, 2 ", ["1", "2"]),
        ("", None),
        ("nan", None),
        (" , ", None),
        (None, None),
        ("a\\b", ["a\\b"]),
    ],
)
def test_list_text(spark, cell, values):
    df = spark.createDataFrame([(cell,)], "c string").select(list_text(F.col("c"), "k").alias("c"))
    assert df.select(list_of(F.col("c"), "k")).first()[0] == values


def test_lists_wide_and_long(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, None), (3, "c")], "id int, c string")
    df = df.withColumn("c", list_text(F.col("c"), "k"))
    assert sorted(map(tuple, list_wide(df, "c", "k").collect())) == [(1, "a", "b"), (2, None, None), (3, "c", None)]
    assert sorted(map(tuple, list_long(df, "c", "k").collect())) == [(1, 0, "a"), (1, 1, "b"), (3, 0, "c")]
    assert list_wide(df.where("id = 2"), "c", "k").columns == ["id"]


def test_grids(spark):
    body = '{"values": [["t"], ["a", "b", "a"], ["1"], ["2", "3", "4", "5"], []]}'
    df = spark.createDataFrame([("s", body), ("empty", '{"values": [["t"], ["a"]]}'), ("bad", "no json"), ("none", None)], "sheet string, body string")
    got = grid_to_json(df, "body", header_row=1).orderBy("position").collect()
    assert [r["record"] for r in got] == ['{"b":null,"a":null}', '{"b":"3","a":"4"}', '{"b":null,"a":null}']
    columns = grid_to_columns(df, "body", ["a", "b", "z"], header_row=1).orderBy("position").collect()
    assert [tuple(r)[2:] for r in columns] == [(None, None, None), ("4", "3", None), (None, None, None)]
    bare = spark.createDataFrame([('[["h"], ["v"]]',)], "body string")
    assert grid_to_columns(bare, "body", ["h"], field=None).first()["h"] == "v"


def test_feed_targets():
    assert len(TRANSACTIONS.fields) == 37 and len(CUSTOMERS.fields) == 27 and len(CATEGORIES.fields) == 11
    assert len(centers("pay").fields) == 25 and len(FRAUD_COLUMNS) == 31
    targets = [f.target for f in TRANSACTIONS.fields]
    assert {"cost_principle_commission", "revenue_service_fee", "third_party_charge", "credit_customer_id"} <= set(targets)
    targets = [f.target for f in CUSTOMERS.fields]
    assert {"customer_nrc_passport", "no_of_login_for_one_month", "state_division", "level", "customer_id"} <= set(targets)


def test_customer_spellings(spark):
    old = spark.createDataFrame([("09", "A", "2024/01/02 03:04:05", "x_02012024.csv")], ["phone no", "level", "date registered", "file_name"])
    new = spark.createDataFrame([("09", "B", "bad", "x_03012024.csv")], ["phone_no", "trust_level", "date_registered", "file_name"])
    a, b = shape(CUSTOMERS, old).first(), shape(CUSTOMERS, new).first()
    assert (a["phone_no"], a["level"], str(a["date_registered"]), a["day_key"]) == ("09", "A", "2024-01-02 03:04:05", "20240101")
    assert (b["phone_no"], b["level"], b["date_registered"], b["month_key"]) == ("09", "B", None, "202401")
    assert len(shape(CUSTOMERS, old).columns) == 31


def test_fraud_sheet(spark):
    df = spark.createDataFrame([tuple("x" for _ in FRAUD_COLUMNS) + ("f",)], [*FRAUD_COLUMNS, "file_name"])
    checked = phone_lists(fraud_rows(df))
    assert checked.first()["first_related_phone"] == '{"first_related_phone_json":["x"]}'
    assert checked.first()["fourth_related_phone"] == "x"
    with pytest.raises(SchemaMismatch):
        fraud_rows(df.drop("remark"))


def test_quality_without_a_scan(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    got = [tuple(r) for r in evaluate(df, [Rule("ColumnCount", ">", 0), Rule("ColumnCount", "<", 2)]).collect()]
    assert sorted(got) == [("ColumnCount < 2", 2, False), ("ColumnCount > 0", 2, True)]
