"""Raw JSON documents: parse once, check, flatten to hourly rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.isotime import iso_timestamp
from isobar.schemas import BRONZE_PARTITIONS, MEASURES, OTHER_HOURLY, REQUIRED_KEYS, SILVER, VIOLATION

_EXAMPLES = 5


def parse_documents(raw: DataFrame) -> DataFrame:
    """Parse every document once; all checks and the flattening read the result.

    The text is wrapped in brackets first, so text after the document's end makes the
    parse fail and a second document shows up as a second element. ``hours`` holds the
    time texts with the timestamps they stand for, NULL where they stand for none.
    """
    parsed = raw.withColumn("_json", F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]"))))
    parsed = parsed.withColumn(
        "_top",
        F.when(
            F.try_variant_get("_json", "$[1]", "variant").isNull(),
            F.try_variant_get("_json", "$[0]", "map<string,variant>"),
        ),
    ).withColumn("_hourly", _inside(F.col("_top")["hourly"], "map<string,variant>"))
    times = F.col("_hourly")["time"]
    kinds = F.transform(_inside(times, "array<variant>"), F.schema_of_variant)
    return parsed.select(
        *[name for name in raw.columns if name != "value"],
        F.map_keys("_top").alias("keys"),
        _inside(F.col("_top")["latitude"], "double").alias("latitude"),
        _inside(F.col("_top")["longitude"], "double").alias("longitude"),
        F.zip_with(_inside(times, "array<string>"), kinds, _hour).alias("hours"),
        *[_measure(name) for name in MEASURES],
        _other_arrays().alias("others"),
    )


def _other_arrays() -> Column:
    """The hourly arrays that are not measures, by name."""
    known = ("time", *MEASURES)
    others = F.map_filter("_hourly", lambda name, _: ~name.isin(*known))
    arrays = F.transform_values(others, lambda _, value: _inside(value, "array<variant>"))
    return F.map_filter(arrays, lambda _, values: values.isNotNull())


def _other_values(n_hours: Column) -> Column:
    """For each hour, the values of the other arrays as JSON text; NULL where a document has no such array."""
    def text(value: Column) -> Column:
        return F.when(~F.is_variant_null(value), F.to_json(value))

    def at(hour: Column) -> Column:
        return F.map_from_entries(F.transform(F.map_entries("others"), lambda e: F.struct(e["key"], text(F.get(e["value"], hour)))))

    none = F.array_repeat(F.lit(None).cast(OTHER_HOURLY.dataType), n_hours)
    return F.when(F.size("others") > 0, F.transform(F.sequence(F.lit(0), n_hours - 1), at)).otherwise(none)


def _inside(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _hour(text: Column, kind: Column) -> Column:
    """Only strings are timestamps; a number that looks like one is not."""
    stamp = F.when(kind == "STRING", iso_timestamp(text))
    return F.struct(text.alias("text"), stamp.alias("stamp"))


def _measure(name: str) -> Column:
    """Numbers of one measure, and how many of its values are not numbers."""
    value = F.col("_hourly")[name]
    numbers, texts = _inside(value, "array<double>"), _inside(value, "array<string>")
    odd = F.when(
        numbers.isNull(), F.when(value.isNotNull() & ~F.is_variant_null(value), 1).otherwise(0)
    ).otherwise(_nulls(numbers) - _nulls(texts))
    if SILVER[name].dataType == T.IntegerType():
        odd = odd + F.coalesce(F.size(F.filter(numbers, lambda x: x != F.round(x))), F.lit(0))
    return F.struct(numbers.alias("numbers"), odd.alias("odd")).alias(name)


def _nulls(array: Column) -> Column:
    return F.size(F.filter(array, lambda item: item.isNull()))


def _finding(check: str, n: Column, detail: Column) -> Column:
    n = F.coalesce(n, F.lit(0)).cast("bigint")
    return F.struct(F.lit(check).alias("check_name"), detail.alias("detail"), n.alias("n"))


def _text(*parts: object) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def with_findings(parsed: DataFrame) -> DataFrame:
    """Add ``findings``, an array of what is wrong with each document. Row-local."""
    numbers = {name: F.col(name)["numbers"] for name in MEASURES}
    n_hours = F.size("hours")
    evidence = parsed.withColumns(
        {
            "_missing": F.array_except(F.array(*[F.lit(key) for key in REQUIRED_KEYS]), F.col("keys")),
            "_unparsed": F.filter(
                F.transform("hours", lambda hour, at: F.struct(at.alias("at"), hour.alias("hour"))),
                lambda item: item["hour"]["stamp"].isNull(),
            ),
            "_repeated": n_hours - F.size(F.array_distinct(F.col("hours")["text"])),
            "_uneven": F.concat(
                F.filter(
                    F.array(*[F.when(F.size(values) != n_hours, F.lit(name)) for name, values in numbers.items()]),
                    lambda name: name.isNotNull(),
                ),
                F.coalesce(
                    F.map_keys(F.map_filter("others", lambda _, values: F.size(values) != n_hours)),
                    F.array().cast("array<string>"),
                ),
            ),
            "_odd": sum((F.coalesce(F.col(name)["odd"], F.lit(0)) for name in MEASURES), F.lit(0)),
        }
    )
    is_document = F.col("keys").isNotNull()
    has_hourly = F.array_contains("keys", "hourly")
    empty = F.coalesce(n_hours, F.lit(0)) <= 0
    unparsed, n_unparsed = F.col("_unparsed"), F.size("_unparsed")
    examples = F.array_join(
        F.transform(
            F.slice(unparsed, 1, _EXAMPLES),
            lambda item: _text(
                "[", item["at"].cast("string"), "] ", F.coalesce(item["hour"]["text"], F.lit("null"))
            ),
        ),
        "; ",
    )
    candidates = F.array(
        _finding("malformed_json", F.when(~is_document, 1), F.lit("Not one JSON object")),
        _finding(
            "required_keys",
            F.size("_missing"),
            _text("Data is missing required keys: ", F.array_join("_missing", ",")),
        ),
        _finding("non_empty", F.when(has_hourly & empty, 1), F.lit("Dataset is empty")),
        _finding(
            "timestamps",
            n_unparsed,
            _text("Found ", n_unparsed.cast("string"), " unparseable timestamps. Examples: ", examples),
        ),
        _finding(
            "duplicates",
            F.col("_repeated"),
            _text("Data contains ", F.col("_repeated").cast("string"), " duplicates on natural key"),
        ),
        _finding(
            "array_lengths",
            F.when(n_hours > 0, F.size("_uneven")),
            _text("Arrays differ in length from time: ", F.array_join("_uneven", ",")),
        ),
        _finding("measure_types", F.col("_odd"), _text(F.col("_odd").cast("string"), " values are not numbers")),
    )
    return evidence.select(
        *parsed.columns, F.filter(candidates, lambda finding: finding["n"] > 0).alias("findings")
    )


def check_bronze(raw: DataFrame) -> DataFrame:
    """Every violation of every document, one row each."""
    # Inlining the bare column would let the optimizer infer a condition on its size and push it below the parsing, where it
    # stands for all checks written out, each with its own parse of the document. An expression over it stays where it is.
    findings = F.filter("findings", lambda finding: finding["n"] > 0)
    return (
        with_findings(parse_documents(raw))
        .select("file_path", *BRONZE_PARTITIONS, F.inline(findings))
        .select(*VIOLATION.names)
    )


def assert_clean(violations: DataFrame, shown: int = 20) -> None:
    """Raise ``ValueError`` when there is any violation, naming some of them."""
    found = violations.limit(shown).collect()
    if found:
        lines = [f"{v['file_path']}: {v['check_name']}: {v['detail']}" for v in found]
        raise ValueError("Bronze validation failed\n" + "\n".join(lines))


def guarded(parsed: DataFrame) -> DataFrame:
    """Make the job fail on a document with findings, before its rows are committed."""
    message = _text(
        "Invalid document: ", F.array_join(F.transform("findings", lambda finding: finding["detail"]), "; ")
    )
    # The hours feed every output row, so the guard cannot be pruned away.
    hours = F.when(F.size("findings") > 0, F.raise_error(message)).otherwise(F.col("hours"))
    return with_findings(parsed).withColumn("hours", hours).drop("findings")


def flatten_parsed(parsed: DataFrame, others: bool = False) -> DataFrame:
    """One row per hour, with the document's coordinates beside it; with ``others`` also all that its other hourly arrays say.

    A measure missing from a document becomes NULLs of the right length; zipping with
    a NULL array would drop the document's rows.
    """
    n_hours = F.size("hours")

    def column(name: str) -> Column:
        absent = F.array_repeat(F.lit(None).cast("double"), n_hours)
        return F.coalesce(F.col(name)["numbers"], absent).alias(name)

    stamps = F.col("hours")["stamp"].alias("time")
    more = [_other_values(n_hours).alias(OTHER_HOURLY.name)] if others else []
    rows = parsed.select(
        *BRONZE_PARTITIONS, "latitude", "longitude",
        F.inline(F.arrays_zip(stamps, *[column(name) for name in MEASURES], *more)),
    )
    return rows.select(
        "time",
        "temperature_2m",
        F.round("relative_humidity_2m").cast("int").alias("relative_humidity_2m"),
        "precipitation",
        "wind_speed_10m",
        "latitude",
        "longitude",
        *([OTHER_HOURLY.name] if others else []),
        *BRONZE_PARTITIONS,
    )


def flatten_hourly(raw: DataFrame, others: bool = False) -> DataFrame:
    """Hourly rows of documents that pass the checks; fails on one that does not."""
    return flatten_parsed(guarded(parse_documents(raw)), others)
