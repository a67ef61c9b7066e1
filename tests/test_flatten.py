import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tagloom.operators import flatten_tagged
from tagloom.schema import schema_from_spec, tagged_read_schema


def rows(df):
    return [row.asDict(recursive=True) for row in df.collect()]


def test_scalars_become_text(exported):
    df = exported({"userId": {"N": "12"}, "name": {"S": "Ann"}, "open": {"BOOL": True}, "blob": {"B": "aGk="}})
    flat = flatten_tagged(df, "Item")
    assert dict(flat.dtypes) == {"blob": "string", "name": "string", "open": "string", "user_id": "string"}
    assert rows(flat) == [{"blob": "aGk=", "name": "Ann", "open": "true", "user_id": "12"}]


def test_maps_expand_at_any_depth(exported):
    df = exported({"home": {"M": {"city": {"S": "Cali"}, "geo": {"M": {"latDeg": {"N": "3.4"}}}}}})
    assert rows(flatten_tagged(df, "Item")) == [{"home_city": "Cali", "home_geo_lat_deg": "3.4"}]


def test_union_tags_take_the_set_one(exported):
    df = exported({"p": {"N": "1"}}, {"p": {"S": "x"}}, {"p": {"BOOL": False}}, {"p": {"NULL": True}})
    assert [r["p"] for r in rows(flatten_tagged(df, "Item"))] == ["1", "x", "false", None]


def test_union_does_not_touch_longer_names(exported):
    df = exported({"id": {"N": "1"}, "card_id": {"S": "c1"}}, {"id": {"S": "b"}, "card_id": {"S": "c2"}})
    assert rows(flatten_tagged(df, "Item")) == [{"card_id": "c1", "id": "1"}, {"card_id": "c2", "id": "b"}]


def test_null_tags(exported):
    df = exported({"k": {"S": "1"}, "z": {"NULL": True}, "m": {"NULL": True}}, {"k": {"S": "2"}, "m": {"M": {"x": {"S": "y"}}}})
    flat = flatten_tagged(df, "Item")
    assert dict(flat.dtypes)["z"] == "string"
    assert rows(flat) == [{"k": "1", "m_x": None, "z": None}, {"k": "2", "m_x": "y", "z": None}]


def test_sets_lose_their_tag(exported):
    df = exported({"tags": {"SS": ["a", "b"]}, "nums": {"NS": ["1", "2"]}, "raw": {"BS": ["aGk="]}})
    assert rows(flatten_tagged(df, "Item")) == [{"nums": ["1", "2"], "raw": ["aGk="], "tags": ["a", "b"]}]


def test_list_of_scalars(exported):
    df = exported({"l": {"L": [{"S": "u"}, {"N": "5"}, {"BOOL": True}, {"NULL": True}]}}, {"l": {"L": []}})
    flat = flatten_tagged(df, "Item")
    assert dict(flat.dtypes) == {"l": "array<string>"}
    assert rows(flat) == [{"l": ["u", "5", "true", None]}, {"l": []}]


def test_list_of_maps(exported):
    df = exported(
        {"items": {"L": [{"M": {"unitPrice": {"N": "3"}, "sku": {"S": "a"}}}, {"NULL": True}]}},
        {"items": {"L": []}},
        {"other": {"S": "x"}},
    )
    flat = flatten_tagged(df, "Item")
    assert dict(flat.dtypes)["items"] == "array<struct<sku:string,unitPrice:string>>"
    assert [r["items"] for r in rows(flat)] == [
        [{"sku": "a", "unitPrice": "3"}, {"sku": None, "unitPrice": None}],
        [],
        None,
    ]


def test_list_of_maps_with_union_and_nesting(exported):
    df = exported(
        {
            "items": {
                "L": [
                    {"M": {"v": {"N": "1"}, "in": {"M": {"a": {"BOOL": True}}}, "l": {"L": [{"S": "x"}]}}},
                    {"M": {"v": {"S": "two"}}},
                    {"NULL": True},
                ]
            }
        }
    )
    flat = flatten_tagged(df, "Item")
    assert dict(flat.dtypes)["items"] == "array<struct<in:struct<a:string>,l:array<string>,v:string>>"
    assert rows(flat)[0]["items"] == [
        {"in": {"a": "true"}, "l": ["x"], "v": "1"},
        {"in": None, "l": None, "v": "two"},
        {"in": None, "l": None, "v": None},
    ]


def test_flag_in_list_of_maps_is_text(exported):
    df = exported({"items": {"L": [{"M": {"on": {"BOOL": True}}}, {"M": {"on": {"BOOL": False}}}]}})
    assert rows(flatten_tagged(df, "Item"))[0]["items"] == [{"on": "true"}, {"on": "false"}]


def test_list_in_list(exported):
    df = exported({"g": {"L": [{"L": [{"N": "1"}, {"N": "2"}]}, {"L": [{"N": "3"}]}]}})
    flat = flatten_tagged(df, "Item")
    assert dict(flat.dtypes) == {"g": "array<array<string>>"}
    assert rows(flat) == [{"g": [["1", "2"], ["3"]]}]


def test_scalar_or_list_keeps_both_as_text(exported):
    df = exported({"p": {"S": "plain"}}, {"p": {"L": [{"M": {"q": {"N": "1"}}}]}})
    assert [r["p"] for r in rows(flatten_tagged(df, "Item"))] == ["plain", '[{"q":"1"}]']


def test_map_or_scalar_gives_both_columns(exported):
    df = exported({"p": {"S": "plain"}}, {"p": {"M": {"q": {"N": "1"}}}})
    assert rows(flatten_tagged(df, "Item")) == [{"p": "plain", "p_q": None}, {"p": None, "p_q": "1"}]


def test_attributes_named_like_tags_or_with_dots(exported):
    df = exported({"S": {"S": "s"}, "M": {"M": {"L": {"N": "1"}}}, "a.b": {"S": "dot"}, "c`d": {"N": "2"}})
    assert rows(flatten_tagged(df, "Item")) == [{"s": "s", "m__l": "1", "a.b": "dot", "c`d": "2"}]


def test_colliding_names_merge_or_are_refused(exported):
    df = exported({"cardId": {"S": "new"}}, {"card_id": {"S": "old"}})
    assert [r["card_id"] for r in rows(flatten_tagged(df, "Item", on_collision="coalesce"))] == ["new", "old"]
    with pytest.raises(ValueError, match="card_id"):
        flatten_tagged(df, "Item", on_collision="error")


def test_only_the_root_is_read(exported):
    df = exported({"Item": {"k": {"S": "1"}}, "Keys": {"k": {"S": "other"}}, "Metadata": {"t": {"N": "9"}}}, root="")
    assert flatten_tagged(df, "Item").columns == ["k"]
    with pytest.raises(ValueError, match="NewImage"):
        flatten_tagged(df, "NewImage")


def test_record_without_root_gives_nulls(exported):
    df = exported({"NewImage": {"k": {"S": "1"}}}, {"OldImage": {"k": {"S": "2"}}}, root="")
    assert rows(flatten_tagged(df, "NewImage")) == [{"k": "1"}, {"k": None}]


def test_untagged_attributes(exported):
    df = exported({"n": 3, "t": "x", "inner": {"deep": 1.5}, "arr": [1, 2]})
    assert rows(flatten_tagged(df, "Item")) == [{"arr": [1, 2], "inner_deep": "1.5", "n": "3", "t": "x"}]


def test_declared_row_stays_a_struct(exported):
    df = exported({"home": {"M": {"city": {"S": "Cali"}, "zip": {"N": "76"}}}, "k": {"S": "1"}})
    schema = schema_from_spec(
        [
            {"Name": "k", "Type": "varchar"},
            {"Name": "home", "Type": "row", "Columns": [{"Name": "city", "Type": "varchar"}]},
            {"Name": "home_zip", "Type": "integer"},
        ]
    )
    # home_zip is no attribute of its own: its name is what home's zip flattens to
    assert rows(flatten_tagged(df, "Item", schema)) == [
        {"home": {"city": "Cali", "zip": "76"}, "home_zip": "76", "k": "1"}
    ]


def test_declared_read_equals_inferred_read(spark, exported, folder):
    df = exported(
        {"userId": {"N": "1"}, "home": {"M": {"city": {"S": "Cali"}}}, "tags": {"SS": ["a"]}},
        {"userId": {"S": "2"}, "items": {"L": [{"M": {"qty": {"N": "3"}, "note": {"NULL": True}}}]}, "x": {"S": "-"}},
        {"userId": {"NULL": True}},
    )
    schema = schema_from_spec(
        [
            {"Name": "user_id", "Type": "bigint", "Source": "userId"},
            {"Name": "home_city", "Type": "varchar", "Source": "home.city"},
            {"Name": "tags", "Type": "array", "ArrayType": "varchar"},
            {"Name": "items", "Type": "array", "Columns": [{"Name": "qty", "Type": "integer"}]},
            {"Name": "absent", "Type": "varchar"},
        ]
    )
    declared = spark.read.schema(tagged_read_schema(schema, "Item")).json(folder)
    left, right = flatten_tagged(declared, "Item", schema), flatten_tagged(df, "Item", schema)
    for name in ("user_id", "home_city", "tags"):
        assert [r[name] for r in rows(left)] == [r[name] for r in rows(right)]
    assert [r["absent"] for r in rows(left)] == [None] * 3
    assert rows(left)[1]["items"] == [{"qty": "3"}]


def test_one_attribute_for_two_columns_and_sources_win(spark, exported, folder):
    df = exported({"userId": {"N": "1"}, "user_id": {"S": "not this"}})
    schema = schema_from_spec(
        [
            {"Name": "user_id", "Type": "bigint", "Source": "userId"},
            {"Name": "user_text", "Type": "varchar", "Source": "userId"},
        ]
    )
    declared = spark.read.schema(tagged_read_schema(schema, "Item")).json(folder)
    for source in (df, declared):
        assert rows(flatten_tagged(source, "Item", schema)) == [{"user_id": "1", "user_text": "1"}]


SCALARS = st.one_of(
    st.builds(lambda v: {"S": v}, st.text("ab ", max_size=3)),
    st.builds(lambda v: {"N": str(v)}, st.integers(-9, 9)),
    st.builds(lambda v: {"BOOL": v}, st.booleans()),
    st.just({"NULL": True}),
)
MAPS = st.builds(lambda v: {"M": v}, st.dictionaries(st.sampled_from(["p", "qR"]), SCALARS, min_size=1))
RECORDS = st.fixed_dictionaries(
    {"key": st.builds(lambda v: {"S": v}, st.text("k", min_size=1, max_size=2))},
    optional={
        "scalarOne": SCALARS,
        "two": SCALARS,
        "home": MAPS,
        "texts": st.builds(lambda v: {"L": v}, st.lists(SCALARS, min_size=1, max_size=3)),
        "maps": st.builds(lambda v: {"L": v}, st.lists(MAPS, min_size=1, max_size=3)),
    },
)


def text(value):
    """The scalar rule, worked out in Python."""
    (tag, content), = value.items()
    return None if tag == "NULL" else str(content).lower() if tag == "BOOL" else content


def model(record):
    flat = {}
    for name, value in record.items():
        column = {"scalarOne": "scalar_one"}.get(name, name)
        if name == "home":
            for inner, v in value["M"].items():
                flat[{"p": "home_p", "qR": "home_q_r"}[inner]] = text(v)
        elif name == "texts":
            flat[column] = [text(v) for v in value["L"]]
        elif name == "maps":
            flat[column] = [{k: text(v) for k, v in e["M"].items()} for e in value["L"]]
        else:
            flat[column] = text(value)
    return flat


def without_nulls(value):
    if isinstance(value, dict):
        return {k: without_nulls(v) for k, v in value.items() if v is not None}
    return [without_nulls(v) for v in value] if isinstance(value, list) else value


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records=st.lists(RECORDS, min_size=1, max_size=4))
def test_equals_a_model_in_python(exported, records):
    flat = rows(flatten_tagged(exported(*records), "Item"))
    assert [without_nulls(r) for r in flat] == [without_nulls(model(r)) for r in records]


def nested(exported):
    part = lambda n, **more: {"M": {"amount": {"N": str(n)}, **more}}
    return exported(
        {"lines": {"L": [{"M": {"kind": {"S": "a"}, "code": {"N": "1"}, "parts": {"L": [part(1), part(2, note={"S": "x"})]}, "tags": {"SS": ["t", "u"]}}}, {"NULL": True}, {"M": {"code": {"S": "z"}, "parts": {"L": []}, "at": {"M": {"city": {"S": "c"}}}}}]}},
        {"lines": {"L": [{"M": {"parts": {"L": [part(3), {"NULL": True}]}}}]}},
        {"lines": {"L": []}},
        {"other": {"S": "1"}},
    )


def test_lists_inside_lists(exported):
    df = flatten_tagged(nested(exported), "Item").select("lines")
    none = {"at": None, "code": None, "kind": None, "parts": None, "tags": None}
    part = lambda amount, note=None: {"amount": amount, "note": note}
    assert [r.asDict(True)["lines"] for r in df.collect()] == [
        [
            none | {"kind": "a", "code": "1", "parts": [part("1"), part("2", "x")], "tags": ["t", "u"]},
            none,
            none | {"code": "z", "parts": [], "at": {"city": "c"}},
        ],
        [none | {"parts": [part("3"), part(None)]}],
        [],
        None,
    ]


def test_no_lambda_over_the_elements_of_inner_lists(exported):
    """One lambda each for the union, the map and the inner list, over their own values; none for scalars and sets."""
    plan = flatten_tagged(nested(exported), "Item").select("lines")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform(") == 3 and "arrays_zip" in plan
    (inner,) = [part for part in plan.split("transform(")[1:] if "parts" in part.split(",")[0]]
    body = inner.split("lambdafunction(")[1]
    assert body.startswith("arrays_zip(")
