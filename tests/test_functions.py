from datetime import datetime

from pyspark.sql import functions as F

from chartloom import schemas
from chartloom.functions.dates import (
    LITERAL_THRESHOLD,
    age_years,
    flag_to_bool,
    from_epoch,
    in_return_window,
    normalise_epoch,
    to_number,
    zero_date_to_null,
)
from chartloom.functions.drugs import DRUG_NAMES, drug_names, map_codes
from chartloom.functions.json import parse_doc_json, to_doc_json
from chartloom.functions.text import display, doc_key, full_name
from chartloom.functions.variants import variant_json, variant_text, variant_type


def values(df):
    return [tuple(r) for r in df.collect()]


def test_keys_and_display_skip_nulls(rows):
    df = rows("a int, b string, c string", (1, None, "x"), (None, "", "y"))
    got = values(df.select(doc_key("labs", "a", "b"), full_name("b", "c"), display("b", F.lit("="), "c")))
    assert got == [("labs_1", "x", "= x"), ("labs_", " y", " = y")]


def test_zero_and_broken_dates_are_null(rows):
    df = rows("d string", ("0000-00-00 00:00:00",), ("2020-01-02 03:04:05",), ("nonsense",), (None,))
    assert values(df.select(zero_date_to_null("d"))) == [(None,), (datetime(2020, 1, 2, 3, 4, 5),), (None,), (None,)]


def test_epoch_units(rows):
    df = rows("ms string, s bigint", ("1514851000999", 1514851000), (None, None), ("x", 0))
    got = values(df.select(from_epoch("ms"), from_epoch("s", "s")))
    assert got == [
        (datetime(2018, 1, 1, 23, 56, 40), datetime(2018, 1, 1, 23, 56, 40)),
        (None, None),
        (None, datetime(1970, 1, 1)),
    ]


def test_epoch_repair_spares_round_seconds(rows):
    df = rows("v bigint", (1514851000000,), (1514851000,), (1514851000123,), (None,))
    assert values(df.select(normalise_epoch("v"))) == [(1514851000,), (1514851000,), (1514851000123,), (None,)]
    assert values(df.select(normalise_epoch("v", LITERAL_THRESHOLD)))[1] == (1514851,)


def test_flags_numbers_age(rows):
    df = rows("flag int, text string, born timestamp_ntz", (0, "1.5", datetime(1980, 12, 31)), (None, "-", None), (2, "", None))
    got = values(df.select(flag_to_bool("flag"), to_number("text"), age_years("born", F.to_date(F.lit("2020-01-01")))))
    assert got == [(False, 1.5, 40), (True, None, None), (True, None, None)]


def test_return_window_ends_at_midnight(rows):
    df = rows(
        "d timestamp_ntz",
        (datetime(2020, 1, 3),),
        (datetime(2020, 1, 2, 23, 59),),
        (datetime(2020, 2, 2),),
        (datetime(2020, 2, 2, 0, 0, 1),),
    )
    got = values(df.select(in_return_window("d", F.to_date(F.lit("2020-01-31")))))
    assert got == [(True,), (False,), (True,), (False,)]


def test_drug_lists(rows):
    df = rows("ids string", ("625 ## 628",), ("1 ## 9759",), ("1",), ("",), (None,))
    got = values(df.select(drug_names("ids")))
    assert got == [("STAVUDINE,LAMIVUDINE,",), ("DOLUTEGRAVIR,",), ("",), ("",), (None,)]
    assert len(DRUG_NAMES) == 35
    plain = map_codes(F.split("ids", " ## "), {"1": "ONE", "9759": "TWO"}, trailing=False)
    assert values(df.select(plain))[1] == ("ONE,TWO",)


def test_variants(rows):
    df = rows(
        "num double, txt string, drug int, name string, dt timestamp_ntz, code int",
        (1.5, "t", 1, "D", datetime(2020, 1, 1), 9),
        (None, "t", 1, "D", None, 9),
        (None, None, 1, None, datetime(2020, 1, 1), None),
        (None, None, None, None, datetime(2020, 1, 1), None),
        (None, None, None, None, None, 9),
        (None, None, None, None, None, None),
    )
    text = variant_text("num", "txt", "drug", "name", "dt")
    kind = variant_type("num", "txt", "drug", "dt", "code")
    assert values(df.select(text, kind)) == [
        ("1.5", "numeric"),
        ("t", "text"),
        (None, "drug"),
        ("2020-01-01 00:00:00", "datetime"),
        (None, "coded"),
        (None, None),
    ]
    top = variant_json("code", text, F.lit("n"), F.lit("u"))
    inner = variant_json("code", text, F.lit(None).cast("string"), F.lit("u"), coded_first=False)
    got = values(df.select(top, inner))
    assert got[0] == ('{"uuid":"u","display":"n"}', "1.5")
    assert got[4] == ('{"uuid":"u","display":"n"}', '{"uuid":"u"}')
    assert got[5] == (None, '{"uuid":"u"}')


def test_json_drops_nulls_and_only_bad_fields(rows):
    df = rows("a int, b string", (1, None))
    assert values(df.select(to_doc_json(F.struct("a", "b")))) == [('{"a":1}',)]
    text = rows("t string", ('[{"uuid":"u","orderNumber":"ORD-1","urgency":"ROUTINE"}]',))
    order = text.select(parse_doc_json("t", schemas.ORDERS)[0].alias("o")).select("o.*").first()
    assert (order.uuid, order.orderNumber, order.urgency) == ("u", "ORD-1", "ROUTINE")


def test_hiv_schema_is_complete():
    names = schemas.HIV_SUMMARY_CHANGE.fieldNames()
    assert len(names) == len(set(names)) == 96
