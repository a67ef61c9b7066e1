import pytest
from pyspark.sql import types as T

from tagloom.functions.names import column_name, match_key, quoted
from tagloom.schema import schema_from_spec, tagged_read_schema


@pytest.mark.parametrize(
    "path, name",
    [
        (("cardInfo", "issueDate"), "card_info_issue_date"),
        (("cardID",), "card_i_d"),
        (("Name",), "name"),
        (("already_snake",), "already_snake"),
        (("address", "City"), "address__city"),
        (("S",), "s"),
        (("a.b",), "a.b"),
    ],
)
def test_column_name(path, name):
    assert column_name(path) == name


def test_match_key_ignores_case_and_underscores():
    assert match_key("measureKind") == match_key("Measure_Kind") == match_key("MEASUREKIND")


def test_quoted_doubles_back_quotes():
    assert quoted("a`b.c") == "`a``b.c`"


def test_every_declared_type():
    columns = [
        {"Name": "a", "Type": "varchar", "Nullable": False},
        {"Name": "b", "Type": "integer"},
        {"Name": "c", "Type": "bigint"},
        {"Name": "d", "Type": "float"},
        {"Name": "e", "Type": "double"},
        {"Name": "f", "Type": "timestamp"},
        {"Name": "g", "Type": "date"},
        {"Name": "h", "Type": "decimal", "Precision": 10, "Scale": 3},
        {"Name": "i", "Type": "boolean"},
        {"Name": "j", "Type": "row", "Columns": [{"Name": "x", "Type": "bigint"}]},
        {"Name": "k", "Type": "array", "Columns": [{"Name": "y", "Type": "varchar"}]},
        {"Name": "l", "Type": "array", "ArrayType": "varchar"},
    ]
    assert schema_from_spec(columns).simpleString() == (
        "struct<a:string,b:int,c:bigint,d:float,e:double,f:timestamp,g:date,h:decimal(10,3),i:boolean,"
        "j:struct<x:bigint>,k:array<struct<y:string>>,l:array<string>>"
    )
    assert all(field.nullable for field in schema_from_spec(columns))


@pytest.mark.parametrize(
    "column",
    [
        {"Name": "x", "Type": "uuid"},
        {"Name": "x", "Type": "array"},
        {"Name": "x", "Type": "array", "ArrayType": "integer"},
        {"Name": "x", "Type": "decimal"},
        {"Name": "x", "Type": "row"},
        {"Name": "x"},
        {"Name": "x", "Type": "row", "Columns": [{"Name": "y", "Type": "uuid"}]},
    ],
)
def test_bad_column_specs(column):
    with pytest.raises(TypeError):
        schema_from_spec([column])


def test_error_names_the_nested_column():
    with pytest.raises(TypeError, match="outer.inner"):
        schema_from_spec([{"Name": "outer", "Type": "row", "Columns": [{"Name": "inner", "Type": "uuid"}]}])


def test_structtype_passes_through():
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert schema_from_spec(schema) is schema


def test_read_schema_shares_parent_maps():
    declared = schema_from_spec(
        [
            {"Name": "city", "Type": "varchar", "Source": "address.city"},
            {"Name": "zip", "Type": "integer", "Source": ["address", "zip"]},
            {"Name": "open", "Type": "boolean"},
            {"Name": "items", "Type": "array", "Columns": [{"Name": "qty", "Type": "bigint"}]},
        ]
    )
    assert tagged_read_schema(declared, "Item").simpleString() == (
        "struct<Item:struct<"
        "address:struct<M:struct<city:struct<S:string,N:string,BOOL:boolean,B:string>,zip:struct<N:string,S:string>>>,"
        "open:struct<BOOL:boolean,S:string>,"
        "items:struct<L:array<struct<M:struct<qty:struct<N:string,S:string>>>>>>>"
    )
