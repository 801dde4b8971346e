from datetime import timedelta

import pytest

from tickflow.plans.params import REFERENCE, SCALED, TickParams, interval


def test_reference_durations():
    assert REFERENCE.labels == ("30s", "1m", "5m", "15m", "30m", "1h")
    assert [REFERENCE.panes(label) for label in REFERENCE.labels] == [3, 6, 30, 90, 180, 360]
    assert REFERENCE.tolerance == timedelta(seconds=0.1)
    assert REFERENCE.horizon == timedelta(seconds=20)


def test_scaling_keeps_ratios_and_labels():
    assert SCALED.slide == timedelta(minutes=20)
    assert SCALED.largest == timedelta(hours=120)
    assert SCALED.labels == REFERENCE.labels
    assert [SCALED.panes(label) for label in SCALED.labels] == [3, 6, 30, 90, 180, 360]
    assert interval(SCALED.tolerance) == "12000000 microseconds"


def test_bad_windows_are_refused():
    with pytest.raises(ValueError):
        TickParams(windows=(("odd", timedelta(seconds=35)),))
    with pytest.raises(ValueError):
        TickParams(windows=(("b", timedelta(seconds=60)), ("a", timedelta(seconds=30))))


def test_session_settings_as_given():
    from tickflow.plans.session import session_settings

    given = session_settings(4, driver_memory="1g", executor_memory="2g", max_result_size="512m", packages=("a:b:1", "c:d:2"))
    assert given["spark.sql.shuffle.partitions"] == "4" and given["spark.driver.maxResultSize"] == "512m"
    assert (given["spark.driver.memory"], given["spark.executor.memory"]) == ("1g", "2g")
    assert given["spark.jars.packages"] == "a:b:1,c:d:2"
    assert not {"spark.driver.maxResultSize", "spark.jars.packages", "spark.driver.memory"} & session_settings().keys()
