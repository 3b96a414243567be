"""Checks on raw documents and their flattening."""

import pytest

from isobar.operators.documents import assert_clean, check_bronze, flatten_hourly
from isobar.schemas import REQUIRED_KEYS
from samples import COMPLETE, document, hours, raw, rows


def found(spark, *documents):
    result = {}
    for row in check_bronze(raw(spark, *documents)).collect():
        result.setdefault(row["file_path"], {})[row["check_name"]] = (row["n"], row["detail"])
    return [result.get(f"doc-{i}", {}) for i in range(len(documents))]


def test_clean_document(spark):
    violations = check_bronze(raw(spark, COMPLETE))
    assert violations.count() == 0
    assert_clean(violations)


def test_missing_keys_are_listed_in_order(spark):
    checks = found(spark, {"latitude": 42.36})[0]
    n, detail = checks["required_keys"]
    assert n == 8
    assert detail == "Data is missing required keys: " + ",".join(REQUIRED_KEYS[1:])


def test_null_key_is_present(spark):
    assert "required_keys" not in found(spark, document(elevation=None))[0]


def test_duplicates(spark):
    doc = document(hours("2026-01-25T12:00:00", "2026-01-25T12:00:00", temperature_2m=[72.5, 72.5]))
    checks = found(spark, doc)[0]
    assert checks == {"duplicates": (1, "Data contains 1 duplicates on natural key")}
    with pytest.raises(ValueError, match="duplicates on natural key"):
        assert_clean(check_bronze(raw(spark, doc)))


def test_duplicates_compare_raw_text(spark):
    assert found(spark, document(hours("2026-01-25T12:00", "2026-01-25T12:00:00"))) == [{}]


@pytest.mark.parametrize("hourly", [{"time": []}, {}, {"time": None}])
def test_empty(spark, hourly):
    assert found(spark, document(hourly))[0]["non_empty"][1] == "Dataset is empty"


def test_empty_is_not_reported_without_the_hourly_key(spark):
    assert "non_empty" not in found(spark, {"latitude": 1.0})[0]


def test_timestamps(spark):
    texts = ["20260125T120000", "2026", "x", "2026-01-25", "", "2026-13-01", "a", "b", "c"]
    n, detail = found(spark, document(hours(*texts)))[0]["timestamps"]
    assert n == 7
    assert detail == (
        "Found 7 unparseable timestamps. Examples: [1] 2026; [2] x; [4] ; [5] 2026-13-01; [6] a"
    )


def test_numbers_and_nulls_are_not_timestamps(spark):
    n, detail = found(spark, document(hours("2026-01-25T12:00", 20260125, None)))[0]["timestamps"]
    assert n == 2
    assert detail.endswith("[1] 20260125; [2] null")


@pytest.mark.parametrize("text", ['{"a": 1,', "", "[1]", '{"a": 1} x', '{"a": 1}{"a": 1}', '{"a":1},{"a":2}'])
def test_malformed(spark, text):
    assert list(found(spark, text)[0]) == ["malformed_json"]


def test_repeated_key_keeps_the_last(spark):
    import json

    text = json.dumps(document())[:-1] + ', "latitude": 1.5}'
    assert found(spark, text) == [{}]
    assert flatten_hourly(raw(spark, text)).first()["latitude"] == 1.5


def test_unequal_lengths(spark):
    doc = document(hours("2026-01-25T12:00", "2026-01-25T13:00", temperature_2m=[1.0], precipitation=[0.0, 0.0]))
    assert found(spark, doc)[0] == {
        "array_lengths": (1, "Arrays differ in length from time: temperature_2m")
    }


def test_values_that_are_not_numbers(spark):
    doc = document(hours("2026-01-25T12:00", "2026-01-25T13:00", temperature_2m=["warm", None], precipitation=3))
    assert found(spark, doc)[0]["measure_types"][0] == 2


def test_several_documents_are_reported_together(spark):
    checks = found(spark, COMPLETE, document(hours()), {"latitude": 1})
    assert [sorted(c) for c in checks] == [[], ["non_empty"], ["required_keys"]]


def test_flatten(spark):
    flat = flatten_hourly(raw(spark, document(hours(
        "2026-01-25T12:00:00", "2026-01-25T13:00:00", temperature_2m=[35.5, 36.0]
    ))))
    assert dict(flat.dtypes)["time"] == "timestamp_ntz"
    assert rows(flat, "latitude", "temperature_2m", "precipitation") == [(42.36, 35.5, None), (42.36, 36.0, None)]


def test_flatten_keeps_order_of_values(spark):
    flat = flatten_hourly(raw(spark, COMPLETE)).selectExpr(
        "cast(time as string)", "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m"
    )
    assert rows(flat) == [
        ("2026-01-25 12:00:00", 35.5, 50, 0.0, 12.5), ("2026-01-25 13:00:00", 36.0, 51, 0.4, 15.1),
    ]


def test_flatten_refuses_a_bad_document(spark):
    with pytest.raises(Exception, match="Dataset is empty"):
        flatten_hourly(raw(spark, COMPLETE, document(hours()))).count()


def test_every_hourly_array_has_its_length_checked(spark):
    times = ("2026-01-25T12:00", "2026-01-25T13:00")
    even, short, scalar = (document(hours(*times, gusts=values)) for values in ([1, 2], [1], 7))
    good, bad, other = found(spark, even, short, scalar)
    assert good == {} and other == {}
    assert bad == {"array_lengths": (1, "Arrays differ in length from time: gusts")}


def test_humidity_that_is_not_whole_is_a_finding(spark):
    times = ("2026-01-25T12:00", "2026-01-25T13:00")
    whole, half = (document(hours(*times, relative_humidity_2m=values)) for values in ([50.0, None], [50.5, 51]))
    assert found(spark, whole, half) == [{}, {"measure_types": (1, "1 values are not numbers")}]


def test_checks_parse_each_document_once(spark):
    """Before, a condition that the optimizer inferred from the inlined findings stood for 189 parses of each document."""
    violations = check_bronze(raw(spark, COMPLETE)).where("check_name = 'duplicates'")
    assert violations._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
