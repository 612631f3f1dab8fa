import pytest

from breezemart.operators.quality import (
    DataQualityError, Rules, check, gate_report, judge, observed, profile)


@pytest.fixture
def table(spark):
    rows = [(i, None if i % 5 == 0 else 1.0, 2.0) for i in range(20)]
    return spark.createDataFrame(rows, "id int, holes double, full double")


def test_profile(table):
    found = {r.column_name: r for r in profile(table).collect()}
    assert (found["holes"].n_rows, found["holes"].null_count, found["holes"].null_pct) == (20, 4, 20.0)
    assert found["full"].null_pct == 0.0
    assert found["id"].mean_null_pct == pytest.approx(20 / 3)


def test_profile_of_nothing_has_no_percentages(table):
    row = profile(table.limit(0)).first()
    assert (row.n_rows, row.null_pct, row.mean_null_pct) == (0, None, None)


def test_gate_names_every_broken_rule(table):
    with pytest.raises(DataQualityError) as error:
        check(table, Rules("t", ["holes", "full"], not_null=["holes"]))
    assert "holes is null in 20.00%" in str(error.value) and "holes must not be null" in str(error.value)
    assert "full" not in str(error.value)
    assert check(table, Rules("t", ["holes"], threshold=20.0)) == {"holes": 20.0}


def test_gate_wants_rows_and_columns(table):
    with pytest.raises(DataQualityError, match="no data in t"):
        check(table.limit(0), Rules("t", ["full"]))
    with pytest.raises(DataQualityError, match="missing columns .*gone"):
        check(table, Rules("t", [], required=["gone"]))


def test_report_gives_a_verdict_per_column(table):
    assert {r.column_name: r.passed for r in gate_report(table).collect()} == {
        "id": True, "holes": False, "full": True}


def test_counts_ride_along_with_a_write(table, tmp_path):
    rules = Rules("t", ["holes"])
    watched, observation = observed(table, rules)
    watched.write.parquet(str(tmp_path / "t"))
    with pytest.raises(DataQualityError, match="20.00%"):
        judge(observation.get, table, rules)
