"""Scans, projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.dates import (
    age_years,
    flag_to_bool,
    from_epoch,
    normalise_epoch,
    to_number,
    zero_date_to_null,
)
from chartloom.functions.drugs import DRUG_NAMES, drug_names
from chartloom.functions.json import parse_doc_json, to_doc_json
from chartloom.functions.text import display, doc_key, full_name
from chartloom.functions.variants import variant_json, variant_text, variant_type
from chartloom.operators.relational import (
    not_retired,
    not_voided,
    preferred,
    project,
    replace_columns,
)
from chartloom.sources.tables import (
    ParquetTables,
    balanced_ranges,
    filter_in,
    read_ranges,
    read_table,
    scan_by_keys as scan_keys,
)
from workload.registry import query
from workload.standin import load


@query(
    """SELECT o_orderkey AS encounter_id, o_custkey AS person_id, o_orderdate AS encounter_datetime FROM orders"""
)
def scan_project(spark: SparkSession, sf: str) -> DataFrame:
    names = {"o_orderkey": "encounter_id", "o_custkey": "person_id", "o_orderdate": "encounter_datetime"}
    return project(read_table(spark, ParquetTables(sf), "orders", list(names)), names)


@query(
    """SELECT l_returnflag, count(*) AS n, min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem GROUP BY 1"""
)
def scan_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """All rows, read by balanced ranges of the order."""
    lines = read_ranges(spark, ParquetTables(sf), "lineitem", "l_orderkey", 16)
    return lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")
    )


@query(
    """SELECT 8 AS ranges, count(*) AS n, true AS balanced,
              count(*) FILTER (WHERE o_orderstatus = 'P') AS without_value FROM orders"""
)
def scan_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of a column that is unevenly filled and sometimes missing: no row lost or doubled, sizes within twice of each other."""
    total = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") * F.col("o_totalprice"))
    orders = load(spark, sf, "orders").select(total.alias("squared"))
    ranges = balanced_ranges(orders, "squared", 8)
    own = F.coalesce(*[F.when(F.expr(r), F.lit(k)) for k, r in enumerate(ranges)])
    known = F.count("squared").alias("known")
    sizes = orders.groupBy(own.alias("own")).agg(F.count(F.lit(1)).alias("rows"), known)
    return sizes.agg(
        F.count(F.lit(1)).cast("int").alias("ranges"),
        F.sum("rows").alias("n"),
        (F.max("known") <= 2 * F.min("known")).alias("balanced"),
        (F.sum("rows") - F.sum("known")).alias("without_value"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
       WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)"""
)
def scan_by_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = load(spark, sf, "supplier").where("s_acctbal > 5000").select("s_suppkey")
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey")
    return scan_keys(lines, keys, "l_suppkey", "s_suppkey").drop("l_suppkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')"""
)
def scan_by_many_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = load(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return scan_keys(lines, keys, "l_orderkey", "o_orderkey")


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    name="filter_in",
)
def filter_in_list(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return filter_in(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS seen FROM orders"""
)
def zero_date(spark: SparkSession, sf: str) -> DataFrame:
    text = (
        F.when(F.col("o_orderstatus") == "P", F.lit("0000-00-00 00:00:00"))
        .when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
        .otherwise(F.col("o_orderdate").cast("string"))
    )
    return load(spark, sf, "orders").select(
        "o_orderkey", zero_date_to_null(text).cast("timestamp_ntz").alias("seen")
    )


@query(
    """SELECT event_id, date_trunc('second', ts) AS seen, epoch_us(ts) // 1000000 AS seconds,
              CASE WHEN event_type <> 'error' THEN value END AS weight
       FROM events"""
)
def epoch_normalise(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    seconds = F.call_function("div", millis, F.lit(1000))
    raw = load(spark, sf, "events").select(
        "event_id",
        millis.cast("string").alias("seen"),
        F.when(F.col("event_type") == "click", seconds).otherwise(seconds * 1000).alias("seconds"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("weight"),
    )
    return replace_columns(
        raw,
        {
            "seen": from_epoch("seen").cast("timestamp_ntz"),
            "seconds": normalise_epoch("seconds"),
            "weight": to_number("weight"),
        },
    )


@query(
    """SELECT o_orderkey, o_orderstatus <> 'O' AS voided FROM orders""",
    name="flag_to_bool",
)
def flag_to_boolean(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "O", F.lit(0)).when(F.col("o_orderstatus") == "F", F.lit(1))
    return load(spark, sf, "orders").select("o_orderkey", flag_to_bool(flag).alias("voided"))


@query("""SELECT o_orderkey, 2020 - year(o_orderdate) AS age FROM orders""", name="age_years")
def age_in_years(spark: SparkSession, sf: str) -> DataFrame:
    age = age_years("o_orderdate", F.to_date(F.lit("2020-03-01"))).cast("bigint")
    return load(spark, sf, "orders").select("o_orderkey", age.alias("age"))


@query(
    """SELECT o_orderkey, concat_ws('_', 'labs', o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END) AS doc_id
       FROM orders""",
    name="doc_key",
)
def document_key(spark: SparkSession, sf: str) -> DataFrame:
    part = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    return load(spark, sf, "orders").select("o_orderkey", doc_key("labs", "o_custkey", part).alias("doc_id"))


@query(
    """SELECT c_custkey, concat_ws(' ', c_mktsegment, CASE WHEN c_acctbal > 0 THEN 'Q' END, c_name) AS person_name,
              c_mktsegment || ' : ' || c_name AS label, c_name || ' = ' || c_nationkey AS attribute
       FROM customer"""
)
def display_text(spark: SparkSession, sf: str) -> DataFrame:
    middle = F.when(F.col("c_acctbal") > 0, F.lit("Q"))
    return load(spark, sf, "customer").select(
        "c_custkey",
        full_name("c_mktsegment", middle, "c_name").alias("person_name"),
        display("c_mktsegment", F.lit(":"), "c_name").alias("label"),
        display("c_name", F.lit("="), "c_nationkey").alias("attribute"),
    )


@query(
    """SELECT p_partkey, p_name FROM part
       WHERE p_type <> 'ECONOMY' AND p_size <= 40 AND p_brand <> 'Brand#3'"""
)
def filter_flags(spark: SparkSession, sf: str) -> DataFrame:
    parts = load(spark, sf, "part").withColumns(
        {
            "voided": F.col("p_type") == "ECONOMY",
            "retired": F.when(F.col("p_size") > 40, F.lit(1)).otherwise(F.lit(0)),
            "preferred": F.col("p_brand") != "Brand#3",
        }
    )
    return preferred(not_retired(not_voided(parts))).select("p_partkey", "p_name")


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN false WHEN 'F' THEN true END AS voided
       FROM orders WHERE o_orderstatus <> 'F'"""
)
def filter_null_or_false(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "O", F.lit(False)).when(F.col("o_orderstatus") == "F", F.lit(True))
    return not_voided(load(spark, sf, "orders").select("o_orderkey", flag.alias("voided")))


@query(
    """WITH v AS (
         SELECT event_id, user_id,
                CASE WHEN event_type = 'click' THEN value END AS num, CASE WHEN event_type = 'view' THEN props END AS words,
                CASE WHEN event_type = 'purchase' THEN user_id END AS drug,
                CASE WHEN event_type = 'purchase' AND value > 50 THEN 'drug ' || user_id END AS drug_name,
                CASE WHEN event_type IN ('signup', 'purchase') THEN date_trunc('second', ts) END AS moment,
                CASE WHEN event_type IN ('error', 'click') THEN user_id END AS code
         FROM events),
       t AS (
         SELECT *, CASE WHEN num IS NOT NULL THEN CAST(num AS VARCHAR) WHEN words IS NOT NULL THEN words
                        WHEN drug IS NOT NULL THEN drug_name ELSE CAST(moment AS VARCHAR) END AS value_text
         FROM v)
       SELECT event_id, value_text,
              CASE WHEN num IS NOT NULL THEN 'numeric' WHEN words IS NOT NULL THEN 'text' WHEN drug IS NOT NULL THEN 'drug'
                   WHEN moment IS NOT NULL THEN 'datetime' WHEN code IS NOT NULL THEN 'coded' END AS value_type,
              CASE WHEN code IS NOT NULL THEN '{"uuid":"u-' || user_id || '","display":"d' || user_id || '"}'
                   ELSE value_text END AS top_value,
              coalesce(value_text, '{"display":"d' || user_id || '","uuid":"u-' || user_id || '"}') AS member_value
       FROM t"""
)
def variant_value(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    values = load(spark, sf, "events").select(
        "event_id",
        F.when(kind == "click", F.col("value")).alias("num"),
        F.when(kind == "view", F.col("props")).alias("words"),
        F.when(kind == "purchase", F.col("user_id")).alias("drug"),
        F.when((kind == "purchase") & (F.col("value") > 50), display(F.lit("drug"), "user_id")).alias("drug_name"),
        F.when(kind.isin("signup", "purchase"), F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("moment"),
        F.when(kind.isin("error", "click"), F.col("user_id")).alias("code"),
        F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("uuid"),
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("name"),
    )
    text = variant_text("num", "words", "drug", "drug_name", "moment")
    return values.select(
        "event_id",
        text.alias("value_text"),
        variant_type("num", "words", "drug", "moment", "code").alias("value_type"),
        variant_json("code", text, "name", "uuid").alias("top_value"),
        variant_json("code", text, "name", "uuid", coded_first=False).alias("member_value"),
    )


_NAMES = ", ".join(f"'{code}': '{name}'" for code, name in DRUG_NAMES.items())
CODES_SQL = """CASE WHEN l_quantity <= 45 THEN concat_ws(' ## ',
         CASE l_linenumber WHEN 1 THEN '625' WHEN 2 THEN '628' WHEN 3 THEN '6964' WHEN 4 THEN '1' ELSE '9435' END,
         CASE l_returnflag WHEN 'A' THEN '797' WHEN 'N' THEN '0' END, CASE l_linestatus WHEN 'O' THEN '633' END) END"""


def names_sql(codes: str) -> str:
    """Oracle expression for the names of a code list."""
    return (
        f"CASE WHEN {codes} IS NOT NULL THEN coalesce(array_to_string(list_transform(list_filter("
        f"string_split({codes}, ' ## '), lambda c: map_contains(MAP {{{_NAMES}}}, c)), "
        f"lambda c: MAP {{{_NAMES}}}[c] || ','), ''), '') END"
    )


@query(
    f"""WITH coded AS (SELECT {CODES_SQL} AS codes FROM lineitem)
        SELECT codes, {names_sql("codes")} AS names, count(*) AS n FROM coded GROUP BY 1, 2""",
    name="drug_names",
)
def drug_names_of_lists(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("l_linenumber")
    first = (
        F.when(number == 1, F.lit("625"))
        .when(number == 2, F.lit("628"))
        .when(number == 3, F.lit("6964"))
        .when(number == 4, F.lit("1"))
        .otherwise(F.lit("9435"))
    )
    second = F.when(F.col("l_returnflag") == "A", F.lit("797")).when(F.col("l_returnflag") == "N", F.lit("0"))
    third = F.when(F.col("l_linestatus") == "O", F.lit("633"))
    codes = F.when(F.col("l_quantity") <= 45, F.concat_ws(" ## ", first, second, third))
    coded = load(spark, sf, "lineitem").select(codes.alias("codes"))
    return coded.select("codes", drug_names("codes").alias("names")).groupBy("codes", "names").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    """SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value, CAST(NULL AS INTEGER) AS order_number,
              CAST(json_extract(props, '$.k') AS INTEGER) AS k
       FROM events"""
)
def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    body = F.struct(
        F.col("event_type").alias("kind"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.lit("A-17").alias("orderNumber"),
        parse_doc_json("props", "k int").alias("props"),
    )
    text = load(spark, sf, "events").select("event_id", to_doc_json(body).alias("doc"))
    schema = "kind string, value double, orderNumber int, props struct<k:int>"
    parsed = text.select("event_id", parse_doc_json("doc", schema).alias("d"))
    return parsed.select(
        "event_id",
        F.col("d.kind").alias("event_type"),
        F.col("d.value").alias("value"),
        F.col("d.orderNumber").alias("order_number"),
        F.col("d.props.k").alias("k"),
    )
