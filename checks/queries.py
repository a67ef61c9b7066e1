"""One query per operator over the given tables; ``oracles.py`` has their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import encode as tag
from tagloom.context import RunContext
from tagloom.functions import default_time_column, millis_time_column, parse_any, to_time_column
from tagloom.operators import (
    add_metadata,
    align,
    flatten_tagged,
    keep_keyed,
    latest_per_key,
    post_filters,
    rename_columns,
    row_count,
    select_columns,
    sorted_projection,
    split_rejects,
    sql_columns,
    surrogate_id,
    utc_to_local,
)
from tagloom.plans import ExportSpec, JobResult, build, run_job
from tagloom.schema import schema_from_spec
from tagloom.scratch import scratch_path, staged
from tagloom.sinks import read_upserted, upsert, write_files, write_partitioned, write_table
from tagloom.sources import (
    load_source,
    load_sources,
    read_catalog,
    read_dated,
    read_format,
    read_partitioned,
    read_tagged,
    read_tagged_variant,
)

Query = Callable[[SparkSession, str], DataFrame]

DAYS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType()),
    ]
)


def plain(column: Column | str) -> Column:
    """TIMESTAMP without a zone, as the test tables and the oracle have it."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def wall_text(column: str) -> Column:
    """A time as ``yyyy-MM-dd HH:mm:ss.SSSSSS`` text."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# --- scans ---------------------------------------------------------------------------


def _orders_export(df: DataFrame, root: str, folder: str = "") -> str:
    return tag.export(
        df,
        root,
        folder,
        o_orderkey=tag.number("o_orderkey"),
        o_custkey=tag.number("o_custkey"),
        o_orderstatus=tag.text("o_orderstatus"),
        o_totalprice=tag.cents("o_totalprice"),
        o_orderpriority=tag.text("o_orderpriority"),
    )


def scan_tagged_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _orders_export(tag.table(spark, sf_dir, "orders"), "Item")
    item = read_tagged(spark, path).select("Item.*")
    return item.select(
        item.o_orderkey.N.cast("bigint").alias("o_orderkey"),
        item.o_custkey.N.cast("bigint").alias("o_custkey"),
        item.o_orderstatus.S.alias("o_orderstatus"),
        item.o_totalprice.N.cast("double").alias("o_totalprice"),
        item.o_orderpriority.S.alias("o_orderpriority"),
    )


def scan_tagged_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes under several tags, lists of mixed elements and NULL tags, read without a second parse."""
    events = tag.table(spark, sf_dir, "events")
    click, user = F.col("event_type") == "click", F.col("user_id").cast("string")
    mark = lambda **tags: F.to_json(F.struct(*[v.alias(k) for k, v in tags.items()]))
    # As text, for elements of differing shapes.
    listed = F.concat(F.lit("["), F.concat_ws(",", mark(S=F.col("event_type")), mark(N=user), mark(M=F.struct(F.struct(user.alias("N")).alias("k")))), F.lit("]"))
    item = F.concat_ws(
        ",",
        F.concat(F.lit('"eventId":'), mark(N=F.col("event_id").cast("string"))),
        F.concat(F.lit('"code":'), F.when(click, mark(N=user)).otherwise(mark(S=F.concat(F.lit("u"), user)))),
        F.concat(F.lit('"detail":'), F.when(click, mark(S=F.col("event_type"))).otherwise(mark(M=F.struct(F.struct(user.alias("N")).alias("user"))))),
        F.concat(F.lit('"gap":'), F.when(click, F.lit('{"NULL":true}')).otherwise(mark(S=F.col("event_type")))),
        F.concat(F.lit('"marks":{"L":'), listed, F.lit("}")),
    )
    path = scratch_path(spark, "export")
    events.select(F.concat(F.lit('{"Item":{'), item, F.lit("}}"))).write.text(path)
    flat = flatten_tagged(read_tagged_variant(spark, path, "Item"), "Item")
    marks = [F.col("marks")[i].alias(f"mark_{i}") for i in range(3)]
    return flat.select(F.col("event_id").cast("bigint").alias("event_id"), "code", "detail", "detail_user", "gap", *marks)


def scan_dated_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change files of the hours of one day: the day's folders are all that is listed."""
    events = tag.table(spark, sf_dir, "events")
    base = scratch_path(spark, "dated")
    events.select(
        tag.attributes(event_id=tag.number("event_id"), event_type=tag.text("event_type")).alias("NewImage"),
        F.year("ts").alias("year"),
        F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"),
        F.when(F.hour("ts") < 12, "00").otherwise("12").alias("hour"),
    ).hint("rebalance", "year", "month", "day", "hour").write.partitionBy("year", "month", "day", "hour").json(base)
    template = base + "/year={process_year}/month={process_month}/day={process_day}/{process_hour}"
    declared = schema_from_spec(
        [{"Name": "event_id", "Type": "bigint"}, {"Name": "event_type", "Type": "varchar"}]
    )
    day = read_dated(spark, template, RunContext.of("2024-01-15", "INC"), declared)
    return align(flatten_tagged(day, "NewImage"), declared)


def _orders_table(spark: SparkSession, sf_dir: str) -> str:
    orders = tag.table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders")
    name = "orders_" + path.rsplit("-", 1)[1]
    orders.hint("rebalance", "o_year").write.partitionBy("o_year").option("path", path).saveAsTable(name)
    return name


def scan_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the changes of the 15th and the day before; by the second, files came for both
    days and an old one was written anew."""
    events = tag.table(spark, sf_dir, "events")
    base, ledger = scratch_path(spark, "feed"), scratch_path(spark, "ledger")

    def put(day: int, name: str, mode: str, rows: Column) -> None:
        part = events.where((F.dayofmonth("ts") == day) & rows).select(F.struct(tag.number("event_id").alias("eventId"), tag.text("event_type").alias("eventType")).alias("NewImage"))
        part.write.mode(mode).json(f"{base}/day={day}/hour={name}/data")

    context = RunContext(date(2024, 1, 15), "INC")
    details = {"path_template_inc": base + "/day={process_day}/{process_hour}data", "ledger": ledger, "days_back": 1}
    schema = schema_from_spec([{"Name": "event_id", "Type": "bigint", "Source": "eventId"}, {"Name": "event_type", "Type": "varchar", "Source": "eventType"}])

    def run(number: int) -> DataFrame:
        source = load_source(spark, {"connection_type": "s3_path", "s3_details": details}, context, schema)
        rows = staged(align(flatten_tagged(source, "NewImage", schema), schema).withColumn("run", F.lit(number)))
        source.taken.remember()
        return rows

    click, view = F.col("event_type") == "click", F.col("event_type") == "view"
    put(15, "01", "overwrite", click)
    put(14, "01", "overwrite", click)
    put(15, "02", "overwrite", view)
    first = run(1)
    put(15, "03", "overwrite", ~click & ~view)
    put(14, "02", "overwrite", view)
    put(15, "02", "overwrite", view & (F.col("event_id") % 2 == 0))
    return first.union(run(2))


def scan_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_catalog(spark, None, _orders_table(spark, sf_dir))


def scan_catalog_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _orders_table(spark, sf_dir)
    return read_catalog(spark, "default", name, "o_year = 1997 AND o_orderstatus = 'F'")


def scan_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = tag.table(spark, sf_dir, "customer")
    parts = []
    for data_format, options in (("csv", {"header": "true", "sep": ";"}), ("json", {}), ("parquet", {}), ("orc", {})):
        path = scratch_path(spark, data_format)
        customer.write.format(data_format).options(**options).save(path)
        df = read_format(spark, data_format, path, options, customer.schema)
        parts.append(df.withColumn("data_format", F.lit(data_format)))
    first, *others = parts
    for other in others:
        first = first.unionByName(other)
    return first


def source_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _orders_table(spark, sf_dir)
    sources = {"urgent": {"origin": "catalog", "database": "default", "table_name": name}}
    hooks = {"urgent": lambda df: df.where("o_orderpriority = '1-URGENT'").drop("o_year")}
    return load_sources(spark, sources, RunContext.of("2024-01-15"), hooks)["urgent"]


# --- flatten -------------------------------------------------------------------------


def _tagged(df: DataFrame, **values: Column) -> DataFrame:
    return df.select(tag.attributes(**values).alias("Item"))


def flatten_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = tag.table(spark, sf_dir, "customer")
    item = _tagged(
        customer,
        c_custkey=tag.number("c_custkey"),
        c_name=tag.text("c_name"),
        c_acctbal=tag.cents("c_acctbal"),
        in_debt=tag.flag(F.col("c_acctbal") < 0),
    )
    return flatten_tagged(item, "Item")


def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = tag.table(spark, sf_dir, "customer")
    item = _tagged(
        customer,
        key=tag.number("c_custkey"),
        home=tag.mapped(
            nation=tag.mapped(key=tag.number("c_nationkey")), segment=tag.text("c_mktsegment")
        ),
    )
    return flatten_tagged(item, "Item")


def flatten_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """camelCase, inner capitals, and attributes called like tags or holding dots."""
    customer = tag.table(spark, sf_dir, "customer")
    item = customer.select(
        F.struct(
            tag.number("c_custkey").alias("custKey"),
            tag.text("c_name").alias("CustName"),
            tag.number("c_nationkey").alias("nationID"),
            tag.text("c_mktsegment").alias("S"),
            tag.mapped(**{"firstLine": tag.text("c_name")}).alias("homeAddress"),
            tag.number("c_custkey").alias("dotted.key"),
        ).alias("Item")
    )
    flat = flatten_tagged(item, "Item")
    return flat.withColumnRenamed("dotted.key", "dotted_key")


def flatten_scalar_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tag.table(spark, sf_dir, "orders")
    item = _tagged(
        orders,
        o_orderkey=tag.number("o_orderkey"),
        tags=tag.text_set(F.col("o_orderstatus"), F.col("o_orderpriority")),
        mixed=tag.listed(
            F.struct(F.col("o_orderstatus").alias("S"), F.lit(None).cast("string").alias("N")),
            F.struct(F.lit(None).cast("string").alias("S"), F.col("o_custkey").cast("string").alias("N")),
        ),
    )
    flat = flatten_tagged(item, "Item")
    return flat.select(
        "o_orderkey",
        F.size("tags").alias("n_tags"),
        F.col("tags")[0].alias("status"),
        F.col("tags")[1].alias("priority"),
        F.col("mixed")[0].alias("mixed_text"),
        F.col("mixed")[1].alias("mixed_number"),
    )


def _measures(df: DataFrame) -> DataFrame:
    """Each line item as a list of maps: one per measure, so no rows are collected."""
    return _tagged(
        df,
        orderKey=tag.number("l_orderkey"),
        partKey=tag.number("l_partkey"),
        measures=tag.listed(
            tag.mapped(measureKind=tag.text(F.lit("quantity")), amount=tag.minor_units("l_quantity")),
            tag.mapped(measureKind=tag.text(F.lit("price")), amount=tag.minor_units("l_extendedprice")),
            tag.mapped(measureKind=tag.text(F.lit("discount")), amount=tag.minor_units("l_discount")),
        ),
    )


def flatten_list_of_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_tagged(_measures(tag.table(spark, sf_dir, "lineitem")), "Item")
    return flat.select("order_key", "part_key", F.inline_outer("measures"))


def flatten_nested_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of maps that hold lists of maps, attributes under two tags, and epoch times; flattened, aligned, unnested."""
    orders = tag.table(spark, sf_dir, "orders")
    key, is_open = F.col("o_orderkey"), F.col("o_orderstatus") == "O"

    def element(i: int) -> Column:
        text = (key + i).cast("string")
        return tag.mapped(
            kind=tag.text(F.lit(f"k{i}")),
            code=F.struct(F.when(is_open, text).alias("N"), F.when(~is_open, F.concat(F.lit("c"), text)).alias("S")),
            seenAt=tag.number(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + i),
            parts=tag.listed(*[tag.mapped(Amount=tag.number(F.col("o_custkey") * 2 + j), note=tag.text("o_orderpriority")) for j in range(2)]),
        )

    item = _tagged(orders, o_orderkey=tag.number(key), lines=tag.listed(element(0), element(1)))
    parts = {"Name": "parts", "Type": "array", "Columns": [{"Name": "amount", "Type": "bigint"}, {"Name": "note", "Type": "varchar"}]}
    line = [{"Name": "kind", "Type": "varchar"}, {"Name": "code", "Type": "varchar"}, {"Name": "seen_at", "Type": "timestamp"}, parts]
    schema = schema_from_spec([{"Name": "o_orderkey", "Type": "bigint"}, {"Name": "lines", "Type": "array", "Columns": line}])
    aligned = align(flatten_tagged(item, "Item"), schema)
    outer = aligned.select("o_orderkey", F.posexplode("lines").alias("slot", "line"))
    inner = outer.select("o_orderkey", "slot", "line.*").select("o_orderkey", "slot", "kind", "code", plain("seen_at").alias("seen_at"), F.posexplode("parts").alias("part", "p"))
    return inner.select("o_orderkey", "slot", "kind", "code", "seen_at", "part", "p.amount", "p.note")


def flatten_union_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tag.table(spark, sf_dir, "orders")
    is_open = F.col("o_orderstatus") == "O"
    key = F.col("o_custkey").cast("string")
    item = _tagged(
        orders,
        o_orderkey=tag.number("o_orderkey"),
        o_custkey=F.struct(F.when(is_open, key).alias("N"), F.when(~is_open, key).alias("S")),
        o_custkey_note=tag.text("o_orderpriority"),
    )
    return flatten_tagged(item, "Item")


def flatten_collision_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two attributes that make one column name, merged on request."""
    orders = tag.table(spark, sf_dir, "orders")
    old = F.col("o_orderkey") % 3 == 0
    item = _tagged(
        orders,
        key=tag.number("o_orderkey"),
        orderStatus=tag.text(F.when(~old, F.col("o_orderstatus"))),
        order_status=tag.text(F.when(old, F.concat(F.lit("old "), F.col("o_orderstatus")))),
    )
    return flatten_tagged(item, "Item", on_collision="coalesce")


def flatten_null_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tag.table(spark, sf_dir, "orders")
    is_low = F.col("o_orderpriority") == "5-LOW"
    item = _tagged(
        orders,
        o_orderkey=tag.number("o_orderkey"),
        priority=F.struct(
            F.when(is_low, True).alias("NULL"), F.when(~is_low, F.col("o_orderpriority")).alias("S")
        ),
        never=F.struct(F.lit(True).alias("NULL")),
    )
    return flatten_tagged(item, "Item")


# --- filters, latest row, projections -------------------------------------------------


def _events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tag.table(spark, sf_dir, "events")
    return events.withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id"))).withColumn(
        "props", F.when(F.col("value") > 1, F.col("props"))
    )


def filter_keys_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_keyed(_events_with_gaps(spark, sf_dir), ["user_id", "props"])


def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers kept as text, compared as numbers."""
    events = tag.table(spark, sf_dir, "events")
    texts = events.withColumn("value", F.col("value").cast("decimal(15,2)").cast("string"))
    return latest_per_key(
        texts, ["user_id"], "value", order_type=T.DoubleType(), tiebreak=["event_id"]
    ).select("user_id", "event_id", "event_type", "value")


def latest_per_key_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tag.table(spark, sf_dir, "events")
    return latest_per_key(events, ["user_id", "event_type"], "ts", tiebreak=["event_id"])


def row_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(tag.table(spark, sf_dir, "lineitem"), "n_rows")


def post_filters_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tag.table(spark, sf_dir, "orders")
    return post_filters(orders, ["o_totalprice > 100000", "o_orderstatus <> 'P' OR o_orderpriority = '2-HIGH'"])


def rename_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tag.table(spark, sf_dir, "orders")
    renames = [("o_orderkey", "order_key"), ("not_there", "ignored"), ("o_custkey", "buyer"), ("buyer", "customer")]
    return rename_columns(orders, renames)


def sql_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tag.table(spark, sf_dir, "orders")
    return sql_columns(
        orders,
        [
            ("price_band", "CAST(FLOOR(o_totalprice / 100000) AS BIGINT)"),
            ("label", "CONCAT(o_orderstatus, '-', CAST(price_band AS STRING))"),
            ("from_millis", "CAST(FROM_UNIXTIME(o_orderkey * 1000000 / 1000) AS TIMESTAMP_NTZ)"),
            ("o_custkey", "COALESCE(NULLIF(o_custkey, 0), -1)"),
        ],
    )


def select_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_columns(tag.table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderkey"])


def sorted_projection_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column order turned into data, as the comparison ignores the order itself."""
    sorted_orders = sorted_projection(tag.table(spark, sf_dir, "orders"))
    return sorted_orders.withColumn("column_order", F.lit(",".join(sorted_orders.columns)))


def surrogate_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = tag.table(spark, sf_dir, "lineitem")
    return surrogate_id(lineitem, ["l_orderkey", "l_linenumber", "l_returnflag"]).select(
        "id", "l_orderkey", "l_linenumber", "l_returnflag"
    )


# --- align ---------------------------------------------------------------------------


def align_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to declared types, some of them not fitting."""
    events = tag.table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.col("event_id").cast("string"), F.lit(".75")).alias("event_id"),
        F.col("value").cast("decimal(15,2)").cast("string").alias("value"),
        F.col("value").cast("decimal(15,2)").cast("string").alias("amount"),
        wall_text("ts").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("on_day"),
        (F.col("value") > 10).cast("string").alias("large"),
        F.lit("dropped").alias("extra"),
    )
    schema = schema_from_spec(
        [
            {"Name": "user_id", "Type": "integer"},
            {"Name": "event_id", "Type": "bigint"},
            {"Name": "value", "Type": "double"},
            {"Name": "amount", "Type": "decimal", "Precision": 12, "Scale": 2},
            {"Name": "ts", "Type": "timestamp"},
            {"Name": "on_day", "Type": "date"},
            {"Name": "large", "Type": "boolean"},
        ]
    )
    # decimals and dates as text, which compares the same in every client
    texts = {n: F.col(n).cast("string") for n in ("amount", "on_day")}
    return align(events, schema).withColumns({"ts": plain("ts"), **texts})


def align_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that do not fit: plain ones, in a struct, in lists of scalars and of maps, in JSON text."""
    error, user = F.col("event_type") == "error", F.col("user_id").cast("string")
    bad = F.when(error, F.lit("n/a")).otherwise(user)
    events = tag.table(spark, sf_dir, "events").select(
        F.col("event_id"),
        bad.alias("user_id"),
        F.when(F.col("event_type") == "view", "9" * 12).otherwise(user).alias("small"),
        F.struct(F.struct(bad.alias("Userid")).alias("inner"), F.col("event_type").alias("code")).alias("detail"),
        F.array(user, bad, F.lit(None)).alias("numbers"),
        F.struct(F.array(F.struct(F.struct(tag.number(user).alias("qty"), tag.text("event_type").alias("kind")).alias("M")), F.struct(F.struct(tag.number(bad).alias("qty"), tag.text("event_type").alias("kind")).alias("M"))).alias("L")).alias("items"),
        F.when(error, "{broken").otherwise(F.to_json(F.struct(user.alias("k")))).alias("props"),
        wall_text("ts").alias("ts"),
    )
    inner = {"Name": "inner", "Type": "row", "Columns": [{"Name": "user_id", "Type": "bigint"}]}
    schema = schema_from_spec(
        [
            {"Name": "event_id", "Type": "bigint"},
            {"Name": "user_id", "Type": "integer"},
            {"Name": "small", "Type": "integer"},
            {"Name": "detail", "Type": "row", "Columns": [inner, {"Name": "code", "Type": "varchar"}]},
            {"Name": "items", "Type": "array", "Columns": [{"Name": "qty", "Type": "bigint"}, {"Name": "kind", "Type": "varchar"}]},
            {"Name": "props", "Type": "row", "Columns": [{"Name": "k", "Type": "bigint"}]},
            {"Name": "ts", "Type": "timestamp"},
        ]
    )
    numbers = T.StructField("numbers", T.ArrayType(T.LongType()))
    aligned = align(events, T.StructType([*schema.fields, numbers]), rejects="rejects")
    return split_rejects(aligned, "rejects", ["event_id"])[1]


def align_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = schema_from_spec(
        [
            {"Name": "o_orderkey", "Type": "varchar"},
            {"Name": "o_comment", "Type": "varchar"},
            {"Name": "o_clerk", "Type": "integer"},
            {"Name": "o_rate", "Type": "double"},
            {"Name": "o_closed", "Type": "date"},
        ]
    )
    aligned = align(tag.table(spark, sf_dir, "orders"), schema)
    return aligned.withColumn("o_closed", F.col("o_closed").cast("string"))


def align_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tag.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.struct(
            F.col("o_custkey").cast("string").alias("custKey"),
            F.struct(F.col("o_orderstatus").alias("code"), F.lit("x").alias("extra")).alias("status"),
        ).alias("buyer"),
    )
    schema = schema_from_spec(
        [
            {"Name": "o_orderkey", "Type": "bigint"},
            {
                "Name": "buyer",
                "Type": "row",
                "Columns": [
                    {"Name": "cust_key", "Type": "bigint"},
                    {"Name": "status", "Type": "row", "Columns": [{"Name": "code", "Type": "varchar"}]},
                    {"Name": "segment", "Type": "varchar"},
                ],
            },
        ]
    )
    return align(orders, schema).select(
        "o_orderkey",
        F.col("buyer.cust_key").alias("cust_key"),
        F.col("buyer.status.code").alias("code"),
        F.col("buyer.segment").alias("segment"),
        F.size(F.map_keys(F.from_json(F.to_json("buyer.status"), "map<string,string>"))).alias("n_fields"),
    )


def align_array_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text arrays stay; numeric arrays become text arrays, element by element."""
    orders = tag.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.array("o_orderkey", "o_custkey").alias("numbers"),
        F.array("o_orderstatus", "o_orderpriority").alias("texts"),
    )
    schema = schema_from_spec(
        [
            {"Name": "o_orderkey", "Type": "bigint"},
            {"Name": "numbers", "Type": "array", "ArrayType": "varchar"},
            {"Name": "texts", "Type": "array", "ArrayType": "varchar"},
        ]
    )
    aligned = align(orders, schema)
    return aligned.select(
        "o_orderkey", F.posexplode(F.concat("numbers", "texts")).alias("slot", "element")
    )


def align_list_of_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Still tagged lists, camelCase names, one field no element has."""
    items = _measures(tag.table(spark, sf_dir, "lineitem")).select(
        F.col("Item.orderKey.N").alias("order_key"),
        F.col("Item.partKey.N").alias("part_key"),
        F.col("Item.measures.L").alias("measures"),
    )
    schema = schema_from_spec(
        [
            {"Name": "order_key", "Type": "bigint"},
            {"Name": "part_key", "Type": "bigint"},
            {
                "Name": "measures",
                "Type": "array",
                "Columns": [
                    {"Name": "measure_kind", "Type": "varchar"},
                    {"Name": "amount", "Type": "double"},
                    {"Name": "unit", "Type": "varchar"},
                ],
            },
        ]
    )
    return align(items, schema).select("order_key", "part_key", F.inline_outer("measures"))


def align_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tag.table(spark, sf_dir, "events").select(
        "event_id",
        F.array(
            "props",
            F.to_json(F.struct(F.col("user_id").cast("string").alias("k"), F.col("event_type").alias("kind"))),
        ).alias("notes"),
    )
    schema = schema_from_spec(
        [
            {"Name": "event_id", "Type": "bigint"},
            {
                "Name": "notes",
                "Type": "array",
                "Columns": [{"Name": "k", "Type": "bigint"}, {"Name": "kind", "Type": "varchar"}],
            },
        ]
    )
    return align(events, schema).select("event_id", F.inline_outer("notes"))


# --- time columns ----------------------------------------------------------------------


def ts_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text, with an offset, and one that is no time; and an absent column."""
    events = tag.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("soon"))
        .when(F.col("event_type") == "view", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-05:00")))
        .otherwise(wall_text("ts"))
        .alias("seen"),
    )
    times = default_time_column(default_time_column(events, "seen"), "absent")
    return times.select("event_id", plain("seen").alias("seen"), plain("absent").alias("absent"))


def ts_epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tag.table(spark, sf_dir, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("seen")
    )
    times = millis_time_column(events, "seen")
    return times.select("event_id", plain("seen").alias("seen"))


def _notations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ts`` in a notation that depends on the event type."""
    zoned = F.col("ts").cast("timestamp")
    wall = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    kind, band = F.col("event_type"), F.col("value")
    return tag.table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "value",
        F.when((kind == "click") & (band < 20), F.unix_micros(zoned).cast("string"))
        .when(kind == "click", F.unix_millis(zoned).cast("string"))
        .when(kind == "view", F.unix_seconds(zoned).cast("string"))
        .when((kind == "signup") & (band < 20), F.concat(wall, F.lit("Z")))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when((kind == "purchase") & (band < 20), F.concat(wall, F.lit("-05:00[UTC-05:00]")))
        .when(kind == "purchase", F.concat(wall, F.lit("[UTC+02:00]")))
        .otherwise(F.lit("not a time"))
        .alias("seen"),
    )


def ts_multi_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notations(spark, sf_dir).select("event_id", plain(parse_any(F.col("seen"))).alias("seen"))


def ts_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, text, and timestamp columns, each converted as its type asks."""
    events = tag.table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("from_number"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("from_text"),
        F.col("ts").alias("unchanged"),
    )
    for name in ("from_number", "from_text", "unchanged", "absent"):
        events = to_time_column(events, name)
    return events.select(
        "event_id", plain("from_number").alias("from_number"), plain("from_text").alias("from_text"), "unchanged"
    )


# --- metadata --------------------------------------------------------------------------

INGESTED = datetime(2024, 2, 1, 3, 30, 0)


def add_metadata_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tag.table(spark, sf_dir, "events")
    dated = add_metadata(events, date(2024, 1, 31), "ts", ingested_at=INGESTED)
    return dated.select(
        "event_id",
        "year",
        "month",
        "day",
        plain("momento_ingestion").alias("momento_ingestion"),
        plain("job_process_date").alias("job_process_date"),
    )


def utc_to_local_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tag.table(spark, sf_dir, "events")
    return events.select("event_id", plain(utc_to_local(F.col("ts").cast("timestamp"))).alias("local_ts"))


# --- sinks -----------------------------------------------------------------------------


def _dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag.table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.lit(1).cast("bigint").alias("version"),
        F.year("ts").alias("year"),
        F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"),
    )


def sink_table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, the second time with fewer rows, which is what has to remain."""
    orders = tag.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "table")
    name = "overwritten_" + path.rsplit("-", 1)[1]
    write_table(orders, name, path, files=4)
    return write_table(orders.where("o_orderstatus <> 'P'"), name, path)


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days written, then one day again: the other days have to stay."""
    events = _dated_events(spark, sf_dir)
    path = scratch_path(spark, "days")
    write_partitioned(events, path)
    write_partitioned(events.where("day = '15'").withColumn("value", F.lit(0.0)), path)
    return read_partitioned(spark, path, DAYS)


def sink_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = tag.table(spark, sf_dir, "customer")
    options = {"header": "true", "sep": "|", "quote": "'", "compression": "gzip"}
    path = scratch_path(spark, "csv")
    write_files(customer, path, data_format="csv", files=2, options=options)
    write_files(customer, path, data_format="csv", mode="append", files=2, options=options)
    return read_format(spark, "csv", path, options, customer.schema)


def _corrections(events: DataFrame) -> DataFrame:
    """Changes up to the 20th: newer clicks, tied views, older errors, repeated newer
    purchases, and new rows; days after that are left alone."""
    early = events.where("day <= '20'")
    changed = F.col("value") + 1
    return (
        early.where("event_type = 'click'").withColumns({"version": F.lit(2).cast("bigint"), "value": changed})
        .unionByName(early.where("event_type = 'view'").withColumn("value", changed + 1))
        .unionByName(early.where("event_type = 'error'").withColumns({"version": F.lit(0).cast("bigint"), "value": changed}))
        .unionByName(
            early.where("event_type = 'purchase'")
            .withColumn("version", F.explode(F.array(F.lit(2).cast("bigint"), F.lit(3).cast("bigint"))))
            .withColumn("value", F.col("value") + F.col("version"))
        )
        .unionByName(early.where("event_type = 'signup'").withColumn("event_id", -F.col("event_id") - 1))
    )


def _upserted(spark: SparkSession, sf_dir: str, times: int) -> DataFrame:
    events = _dated_events(spark, sf_dir)
    path = scratch_path(spark, "upsert")
    upsert(events, path, ["event_id"], "version", staged=True, unique=True)
    for _ in range(times):
        upsert(_corrections(events), path, ["event_id"], "version")
    return read_partitioned(spark, path, DAYS)


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, 1)


def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, 2)


def upsert_many_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with eight partitions merged at a time, so in several groups."""
    events = _dated_events(spark, sf_dir)
    path = scratch_path(spark, "upsert")
    upsert(events, path, ["event_id"], "version", staged=True, unique=True, partitions_at_once=8)
    upsert(_corrections(events), path, ["event_id"], "version", partitions_at_once=8)
    return read_partitioned(spark, path, DAYS)


def upsert_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL and empty text are one partition: stored rows under either meet incoming ones."""
    kind = F.when(F.col("event_type") == "view", "").when(F.col("event_type") != "error", F.col("event_type"))
    events = tag.table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.lit(1).alias("version"), kind.alias("kind"))
    path = scratch_path(spark, "upsert")
    upsert(events, path, ["event_id"], "version", ["kind"])
    errors = events.where("event_type = 'error'")
    newer = errors.withColumns({"version": F.lit(2), "value": F.col("value") + 1, "kind": F.lit("")})
    upsert(newer, path, ["event_id"], "version", ["kind"])
    return read_partitioned(spark, path, T.StructType([T.StructField("kind", T.StringType())]))


def upsert_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days up to the 10th come again in wider types; the files of the others are read as these."""
    events = _dated_events(spark, sf_dir)
    narrow = {"value": "float", "version": "int", "cents": "decimal(9,2)", "marks": "array<int>"}
    wide = {"value": "double", "version": "bigint", "cents": "decimal(16,4)", "marks": "array<bigint>"}
    both = events.withColumns({"cents": F.col("value"), "marks": F.array("user_id")})
    path = scratch_path(spark, "upsert")
    upsert(both.select("*").withColumns({n: F.col(n).cast(t) for n, t in narrow.items()}), path, ["event_id"], "version")
    newer = both.where("day <= '10'").withColumns({"version": F.lit(2), "value": F.col("value") + 1, "marks": F.array(F.col("user_id") + (1 << 40))})
    upsert(newer.withColumns({n: F.col(n).cast(t) for n, t in wide.items()}), path, ["event_id"], "version")
    read = read_upserted(spark, path).select("event_id", "version", "value", "cents", F.col("marks")[0].alias("mark"), *DAYS.names)
    return read.withColumn("cents", (F.col("cents") * 100).cast("bigint"))


# --- composed jobs -----------------------------------------------------------------------

EVENT_COLUMNS = [
    {"Name": "user_id", "Type": "bigint", "Source": "userId"},
    {"Name": "event_type", "Type": "varchar", "Source": "eventType"},
    {"Name": "event_id", "Type": "bigint", "Source": "eventId"},
    {"Name": "amount", "Type": "double", "Source": "detail.amount"},
    {"Name": "detail_note", "Type": "varchar", "Source": "detail.note"},
    {"Name": "tstamp", "Type": "bigint", "Source": "tstamp"},
    {"Name": "created_at", "Type": "timestamp", "Source": "createdAt"},
    {"Name": "channel", "Type": "varchar", "Source": "channel"},
]

FULL_FOLDER = "full/year=2024/month=01/day=31/0001/data"
INC_FOLDER = "incremental/year=2024/month=01/day=31/hour=07/data"


def _event_export(spark: SparkSession, sf_dir: str, root: str, folder: str, changed: bool = False) -> str:
    """Events as export records; errors have no user (in change files: no new image).

    ``changed``: clicks come later and with another amount, the rest earlier than before.
    """
    events = tag.table(spark, sf_dir, "events")
    has_user, is_click = F.col("event_type") != "error", F.col("event_type") == "click"
    micros, amount = F.unix_micros(F.col("ts").cast("timestamp")), F.col("value")
    if changed:
        micros, amount = F.when(is_click, micros + 1).otherwise(micros - 1), amount + 1
    values = {
        "userId": tag.number(F.when(has_user, F.col("user_id"))),
        "eventType": tag.text("event_type"),
        "eventId": tag.number("event_id"),
        "detail": tag.mapped(amount=tag.cents(amount), note=tag.text("props")),
        "tstamp": tag.number(micros),
        "createdAt": tag.text(wall_text("ts")),
        "undeclared": tag.text(F.lit("dropped")),
    }
    return tag.export(events, root, folder, present=has_user if root == "NewImage" else None, **values)


def event_spec(base: str, context: RunContext, read_schema: str = "declared", output: dict | None = None, **processing) -> ExportSpec:
    """The spec of the event export below ``base``."""
    dated = "year={process_year}/month={process_month}/day={process_day}"
    return ExportSpec.from_dict(
        {
            "source_config": {
                "connection_type": "s3_path",
                "read_schema": read_schema,
                "s3_details": {
                    "path_template_full": base + "/{current_process_type_folder}/" + dated + "/{current_data_folder}",
                    "path_template_inc": base + "/incremental/" + dated + "/{process_hour}data",
                },
            },
            "processing_config": {
                "schema": EVENT_COLUMNS,
                "key_columns": ["user_id", "event_type"],
                "order_by_column": "tstamp",
                "tiebreak_columns": ["event_id"],
                "precombine_key": "tstamp",
                **processing,
            },
            "output_config": output or {},
        },
        context,
    )


def sink_declared_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extra output of a job whose spec names no options, read back as it is written by default."""
    base = _event_export(spark, sf_dir, "Item", FULL_FOLDER)
    context = RunContext(date(2024, 1, 31), "FULL", ingested_at=INGESTED)
    path = scratch_path(spark, "output")
    spec = event_spec(base, context, output={"path_template": path})
    run_job(spark, spec, context, table="output_" + path.rsplit("-", 1)[1], table_path=scratch_path(spark, "analytics"))
    back = read_format(spark, "csv", path, {"header": "true", "escape": '"'})
    return back.select("id", F.col("event_id").cast("bigint"), F.col("amount").cast("double"), "detail_note")


KEY_COLUMNS = [
    {"Name": "head", "Type": "varchar"},
    {"Name": "tail", "Type": "varchar"},
    {"Name": "order_key", "Type": "bigint"},
    {"Name": "seen_at", "Type": "timestamp"},
]


def export_key_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose two keys make one joined id in pairs: every order stays."""
    even, pair = F.col("o_orderkey") % 2 == 0, F.floor(F.col("o_orderkey") / 2).cast("string")
    base = tag.export(
        tag.table(spark, sf_dir, "orders"),
        "Item",
        FULL_FOLDER,
        head=tag.text(F.when(even, "p-q").otherwise("p")),
        tail=tag.text(F.when(even, pair).otherwise(F.concat(F.lit("q-"), pair))),
        order_key=tag.number("o_orderkey"),
        seen_at=tag.text(wall_text("o_orderdate")),
    )
    context = RunContext(date(2024, 1, 31), "FULL", ingested_at=INGESTED)
    keyed = {"schema": KEY_COLUMNS, "key_columns": ["head", "tail"], "order_by_column": "order_key", "tiebreak_columns": None}
    spec = event_spec(base, context, partition_date="seen_at", precombine_key="order_key", **keyed)
    curated = scratch_path(spark, "curated")
    run_job(spark, spec, context, table="keys_" + curated.rsplit("-", 1)[1], table_path=scratch_path(spark, "analytics"), curated_path=curated)
    return read_partitioned(spark, curated, DAYS).select("id", "head", "tail", "order_key")


def _feed(spark: SparkSession, sf_dir: str, root: str, folder: str) -> str:
    """Events as a snapshot, or changes to them, by event_id modulo 5: deleted (0); deleted, then
    written again with a lower order value (1); changed, then deleted (2); a delete from before
    the snapshot (3); none (4). Some records of the snapshot have no key."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    events = tag.table(spark, sf_dir, "events").withColumns({"at": at, "amount": F.col("value"), "order": at, "here": F.lit(True), "keyed": F.col("event_id") % 97 != 0})
    if root == "NewImage":
        kind = F.col("event_id") % 5
        plus = {"amount": F.col("amount") + 1}
        gone = events.where(kind < 4).withColumns({"here": F.lit(False), "at": F.when(kind == 3, at - 100).otherwise(at + 100)})
        again = events.where(kind == 1).withColumns({"at": at + 200, "order": at - 7, **plus})
        before = events.where(kind == 2).withColumns({"at": at + 50, "order": at + 50, **plus})
        events = gone.union(again).union(before).withColumn("keyed", F.lit(True))
    return tag.export(
        events, root, folder, present=F.col("here"), written=F.col("at"), keys=tag.attributes(eventId=tag.number("event_id")),
        userId=tag.number("user_id"), eventType=tag.text("event_type"), eventId=tag.number(F.when(F.col("keyed"), F.col("event_id"))),
        detail=tag.mapped(amount=tag.cents("amount")), tstamp=tag.number("order"), createdAt=tag.text(wall_text("ts")),
    )


def _fed(spark: SparkSession, sf_dir: str, read_schema: str) -> tuple[str, dict[str, JobResult]]:
    """A snapshot job and an incremental one that applies deletes; the upserted table and what each did."""
    curated, done = scratch_path(spark, "curated"), {}
    by_event = {"key_columns": ["event_id"], "tiebreak_columns": None, "deletes": "apply"}
    for mode, root, folder in (("FULL", "Item", FULL_FOLDER), ("INC", "NewImage", INC_FOLDER)):
        base = _feed(spark, sf_dir, root, folder)
        context = RunContext(date(2024, 1, 31), mode, ingested_at=INGESTED)
        spec = event_spec(base, context, read_schema, partition_date="created_at", **by_event)
        name = "feed_" + base.rsplit("-", 1)[1]
        done[mode] = run_job(spark, spec, context, table=name, table_path=scratch_path(spark, "analytics"), curated_path=curated)
    return curated, done


def upsert_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes of a change feed leave the upserted table, with the order of changes kept."""
    curated, _ = _fed(spark, sf_dir, "declared")
    return read_upserted(spark, curated).select("event_id", "event_type", "amount", "tstamp", "change_micros", *DAYS.names)


def job_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two jobs counted on the way, as rows."""
    _, done = _fed(spark, sf_dir, "inferred")
    names = ("records", "images", "keyed", "deletes", "rows", "merged", "deleted")
    return spark.createDataFrame([(mode, name, getattr(job, name)) for mode, job in done.items() for name in names], "mode string, metric string, n bigint")


def _without_zones(df: DataFrame) -> DataFrame:
    return df.withColumns({n: plain(n) for n in ("created_at", "momento_ingestion", "job_process_date")})


def export_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot files to finished rows, read with the declared schema."""
    base = _event_export(spark, sf_dir, "Item", FULL_FOLDER)
    context = RunContext(date(2024, 1, 31), "FULL", ingested_at=INGESTED)
    return _without_zones(build(spark, event_spec(base, context), context))


def export_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change files, deletes among them, to finished rows, read with inferred types."""
    base = _event_export(spark, sf_dir, "NewImage", INC_FOLDER)
    context = RunContext(date(2024, 1, 31), "INC", ingested_at=INGESTED)
    return _without_zones(build(spark, event_spec(base, context, "inferred"), context))


def export_from_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All optional steps of a spec, on the snapshot."""
    base = _event_export(spark, sf_dir, "Item", FULL_FOLDER)
    context = RunContext(date(2024, 1, 31), "FULL", {"min_amount": "5"}, ingested_at=INGESTED)
    spec = event_spec(
        base,
        context,
        post_read_filters=["amount > {min_amount}", "event_type <> 'signup'"],
        select_columns=["id", "user_id", "event_id", "amount", "created_at", "tstamp"],
        rename_columns=[{"old_name": "amount", "new_name": "paid"}, {"old_name": "created_at", "new_name": "seen_at"}],
        sql_transformations=[
            {"name": "paid_cents", "sql": "CAST(ROUND(paid * 100) AS BIGINT)"},
            {"name": "is_large", "sql": "paid_cents > 2000"},
            {"name": "tstamp", "sql": "CAST(FROM_UNIXTIME(tstamp DIV 1000000, 'yyyy-MM-dd HH:mm:ss') AS TIMESTAMP_NTZ)"},
        ],
    )
    df = build(spark, spec, context)
    return df.withColumns({n: plain(n) for n in ("seen_at", "momento_ingestion", "job_process_date")})


def export_to_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot job, then incremental job, into one upserted table."""
    curated = scratch_path(spark, "curated")
    for mode, root, folder in (("FULL", "Item", FULL_FOLDER), ("INC", "NewImage", INC_FOLDER)):
        base = _event_export(spark, sf_dir, root, folder, changed=mode == "INC")
        context = RunContext(date(2024, 1, 31), mode, ingested_at=INGESTED)
        name = "export_" + base.rsplit("-", 1)[1]
        run_job(
            spark,
            event_spec(base, context),
            context,
            table=name,
            table_path=scratch_path(spark, "analytics"),
            curated_path=curated,
        )
    return _without_zones(read_partitioned(spark, curated, DAYS))


QUERIES: dict[str, Query] = {
    "scan_tagged_json": scan_tagged_json,
    "scan_tagged_variant": scan_tagged_variant,
    "scan_dated_partition": scan_dated_partition,
    "scan_new_files": scan_new_files,
    "scan_catalog": scan_catalog,
    "scan_catalog_pruned": scan_catalog_pruned,
    "scan_format": scan_format,
    "source_hook": source_hook,
    "flatten_scalars": flatten_scalars,
    "flatten_nested": flatten_nested,
    "flatten_names": flatten_names,
    "flatten_scalar_set": flatten_scalar_set,
    "flatten_list_of_maps": flatten_list_of_maps,
    "flatten_nested_lists": flatten_nested_lists,
    "flatten_union_tags": flatten_union_tags,
    "flatten_collision_coalesce": flatten_collision_coalesce,
    "flatten_null_tag": flatten_null_tag,
    "filter_keys_not_null": filter_keys_not_null,
    "latest_per_key": latest_per_key_query,
    "latest_per_key_composite": latest_per_key_composite,
    "row_count": row_count_query,
    "align_cast": align_cast,
    "align_rejects": align_rejects,
    "align_missing": align_missing,
    "align_struct": align_struct,
    "align_array_cast": align_array_cast,
    "align_list_of_maps": align_list_of_maps,
    "align_json_array": align_json_array,
    "surrogate_id": surrogate_id_query,
    "sorted_projection": sorted_projection_query,
    "ts_default": ts_default,
    "ts_epoch_millis": ts_epoch_millis,
    "ts_multi_format": ts_multi_format,
    "ts_dispatch": ts_dispatch,
    "post_filters": post_filters_query,
    "rename_columns": rename_columns_query,
    "sql_columns": sql_columns_query,
    "select_columns": select_columns_query,
    "add_metadata": add_metadata_query,
    "utc_to_local": utc_to_local_query,
    "sink_table_overwrite": sink_table_overwrite,
    "sink_partitioned": sink_partitioned,
    "sink_format": sink_format,
    "upsert_merge": upsert_merge,
    "upsert_idempotent": upsert_idempotent,
    "upsert_many_partitions": upsert_many_partitions,
    "upsert_null_partition": upsert_null_partition,
    "upsert_widened": upsert_widened,
    "upsert_deletes": upsert_deletes,
    "job_metrics": job_metrics,
    "export_full": export_full,
    "export_incremental": export_incremental,
    "export_from_spec": export_from_spec,
    "export_to_upsert": export_to_upsert,
    "export_key_collision": export_key_collision,
    "sink_declared_output": sink_declared_output,
}
