from __future__ import annotations

import pytest

from contrail.operators.quality import (
    QualityError,
    enforce,
    quality_gate,
    quality_report,
    rule_counts,
    validate,
)
from contrail.session import SkipBatch


def counts(df):
    return {r.rule: r.violations for r in validate(df).collect()}


def test_clean_rows_pass(reports):
    assert counts(reports({})) == {}
    enforce(validate(reports({})))


def test_every_broken_rule_is_reported(reports):
    rows = reports(
        {"icao24": None},
        {"icao24": "  "},
        {"latitude": 90.5},
        {"longitude": -180.1},
        {"velocity": -0.1},
        {"on_ground": None},
        {"time_position": None},
        {"latitude": None},
    )
    assert counts(rows) == {
        "icao24 is present": 1,
        "icao24 is not blank": 1,
        "latitude within [-90, 90]": 1,
        "longitude within [-180, 180]": 1,
        "velocity is not negative": 1,
        "on_ground is present": 1,
        "a position has a time": 1,
        "an airborne row has a position": 1,
    }
    with pytest.raises(QualityError, match="(?s)blank.*latitude"):
        enforce(validate(rows))


def test_warnings_do_not_fail(reports):
    enforce(validate(reports({"latitude": None, "longitude": None})))


def test_empty_input_breaks_the_row_rule(reports):
    assert counts(reports({}).where("false")) == {"at least one row": 1}


def test_missing_column_is_one_violation(reports):
    rows = rule_counts(reports({}, {"velocity": -1.0}).drop("geo_altitude", "latitude")).collect()
    got = {r.rule: r.violations for r in rows}
    assert got["geo_altitude exists"] == got["latitude exists"] == got["velocity is not negative"] == 1
    assert "latitude within [-90, 90]" not in got


def test_text_columns_are_read_and_extra_columns_allowed(reports):
    rows = reports({}, {}, {}).selectExpr(
        "* EXCEPT (velocity, on_ground, latitude)",
        "CASE source_file WHEN 'a.json' THEN '-3.5' END AS velocity",
        "'True' AS on_ground",
        "'north' AS latitude",
    )
    got = counts(rows)
    assert got["velocity is not negative"] == 3
    assert got["latitude reads as double"] == 3
    assert "on_ground is present" not in got


def test_report(reports):
    rows = reports(
        {"icao24": None, "latitude": None},
        {"latitude": None, "on_ground": True},
        {"longitude": None},
    )
    assert quality_report(rows).first().asDict() == {
        "row_count": 3,
        "null_icao24": 1,
        "null_latitude": 2,
        "null_longitude": 1,
        "null_position_ground": 1,
        "null_position_airborne": 1,
    }


def test_gate(reports):
    report = quality_report(reports({}))
    assert quality_gate(report) is True
    assert quality_gate(None) is False
    assert quality_gate({"row_count": 5}, min_row_count=5) is True
    with pytest.raises(QualityError, match="at least 2"):
        quality_gate(report, min_row_count=2)
    with pytest.raises(SkipBatch):
        quality_gate({"row_count": 0}, fail_on_empty=False)
    with pytest.raises(QualityError, match="(?s)null_icao24.*absent"):
        quality_gate(report, extra_checks={"null_icao24": 1, "absent": 0, "row_count": 1})
