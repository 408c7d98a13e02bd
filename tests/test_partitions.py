import pytest

from quillstream.schema import AGG_TABLE, TELEMETRY_TABLE, day_partition_field


def test_day_field_names():
    assert day_partition_field(TELEMETRY_TABLE, "ts") == "ts_day"
    assert day_partition_field(AGG_TABLE, "window_start") == "window_start_day"


def test_unknown_column_rejected():
    with pytest.raises(ValueError):
        day_partition_field(TELEMETRY_TABLE, "nope")
