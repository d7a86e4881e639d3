"""Building, checking and serialising click events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmeter.functions.timebucket import is_bucket, iso, minute_bucket
from clickmeter.settings import (
    BUCKET_PATTERN,
    DATE_TIME_FIELDS,
    DATE_TIME_PATTERN,
    EVENT_FIELDS,
    NON_EMPTY_EVENT_FIELDS,
    REQUIRED_EVENT_FIELDS,
)


def event_id(*parts: Column) -> Column:
    """Id from what makes the click unique: a re-run builds the same event again."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def event_columns(clicked_at: Column, received_at: Column) -> dict[str, Column]:
    """The time fields of an event; the bucket always follows the click time."""
    return {
        "click_ts": iso(clicked_at),
        "minute_bucket": minute_bucket(clicked_at),
        "ingest_ts": iso(received_at),
    }


def event_json() -> Column:
    """One JSON object per event; absent optional fields get no key."""
    return F.to_json(F.struct(*EVENT_FIELDS))


def violations() -> Column:
    """What is wrong with an event row, one entry per finding, empty when valid."""
    missing = [
        F.when(F.coalesce(F.col(name), F.lit("")) == "", F.lit(f"{name} is required"))
        for name in REQUIRED_EVENT_FIELDS
    ]
    malformed = F.when(~is_bucket(F.col("minute_bucket")), F.lit("minute_bucket is malformed"))
    return F.array_compact(F.array(*missing, malformed))


def schema_violations(text: Column) -> Column:
    """Findings of the closed event schema on a JSON text.

    Looks at the raw object, so unknown fields and values of another type are seen.
    """
    known = F.array(*[F.lit(name) for name in EVENT_FIELDS])
    fields = F.from_json(text, "map<string,string>")
    parsed = F.try_parse_json(text)
    unknown = F.transform(
        F.array_sort(F.array_except(F.map_keys(fields), known)),
        lambda name: F.concat(F.lit("unknown field "), name),
    )
    missing = [
        F.when(~F.map_contains_key(fields, name), F.lit(f"{name} is missing"))
        for name in REQUIRED_EVENT_FIELDS
    ]
    mistyped = [
        F.when(
            F.schema_of_variant(F.try_variant_get(parsed, f"$.{name}", "variant")) != "STRING",
            F.lit(f"{name} is not text"),
        )
        for name in EVENT_FIELDS
    ]
    empty = [
        F.when(fields[name] == "", F.lit(f"{name} is empty")) for name in NON_EMPTY_EVENT_FIELDS
    ]
    malformed = F.when(
        ~fields["minute_bucket"].rlike(BUCKET_PATTERN), F.lit("minute_bucket is malformed")
    )
    no_time = [
        F.when(~fields[name].rlike(DATE_TIME_PATTERN), F.lit(f"{name} is no date-time"))
        for name in DATE_TIME_FIELDS
    ]
    findings = F.concat(
        unknown, F.array_compact(F.array(*missing, *mistyped, *empty, malformed, *no_time))
    )
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, findings).otherwise(F.array(F.lit("not a JSON object")))
