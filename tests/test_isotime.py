"""Timestamp grammar against the standard library's parser."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from isobar.functions.isotime import iso_timestamp

WRITTEN = [
    "2026-01-25T12:00", "2026-01-25T12:00:00", "2026-01-25", "20260125", "20260125T120000",
    "20260125T12", "2026-01-25x12", "2026-01-25T12:00:00,5", "2026-01-25T12:00:00.1234567",
    "2026-01-25T12:00Z", "2026-01-25T12:00+0100", "2026-01-25T12:00-01:00:30", "2026-W05-1",
    "2026W051", "2026-W05", "2020-W53-7", "2026-W53-7", "2026-W00-1", "2026", "2026-01", "2026-01-25T",
    "2026-01-25T24:00", "2026-01-25T12:00:60", "2026-02-30", "2024-02-29", "2026-13-01", "0000-01-01",
    "2026-01-25T12:0000", "2026-01-25T12:00:00.", "2026-01-25T12:00+24:00", "2026-01-25T12:00z",
    " 2026-01-25", "2026-1-25", "", "not-a-time", "2026-0125", "2026-01-25 12:00:00",
]


def _expected(text):
    try:
        value = datetime.fromisoformat(text)
    except ValueError:
        return None
    if value.tzinfo:
        value = (value - value.utcoffset()).replace(tzinfo=None)
    return value.isoformat(sep=" ", timespec="microseconds")


def _parsed(spark, texts):
    shown = F.date_format(iso_timestamp(F.col("s")), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    frame = spark.createDataFrame([(t,) for t in texts], "s string")
    return {r["s"]: r["v"] for r in frame.select("s", shown.alias("v")).collect()}


def test_written_forms(spark):
    assert _parsed(spark, WRITTEN) == {text: _expected(text) for text in WRITTEN}


def test_changed_digits(spark):
    """Every written form with digits replaced: ranges of months, days, hours, offsets."""
    rng = random.Random(7)
    texts = set()
    for text in WRITTEN:
        digits = [at for at, c in enumerate(text) if c.isdigit()]
        for _ in range(80 if digits else 0):
            at = rng.choice(digits)
            texts.add(text[:at] + rng.choice("0123456789") + text[at + 1:])
    texts = sorted(texts)
    found = _parsed(spark, texts)
    assert [t for t in texts if found[t] != _expected(t)] == []


def test_stray_characters_are_refused(spark):
    """Unlike the library, which lets some pass in front of an offset or fraction."""
    texts = ["2026-01-25T12:00 +01:00", "2026-01-25T12:00:00:12", "2026-01-25T12500Z"]
    assert set(_parsed(spark, texts).values()) == {None}


def test_null_is_null(spark):
    frame = spark.createDataFrame([(None,)], "s string")
    assert frame.select(iso_timestamp(F.col("s"))).first()[0] is None
