"""Types of the raw tables. Nothing is inferred: a file is read with its declared types."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


TELEMETRY = _table(
    record_id=LongType, site=StringType, ts=TimestampNTZType, shift=StringType, tons=DoubleType,
    feed=DoubleType, conc=DoubleType, tail=DoubleType, dose=DoubleType, ph=DoubleType,
)
MAINTENANCE = _table(
    record_id=LongType, site=StringType, truck=StringType, day=DateType, shift=StringType, sched_h=DoubleType,
    oper_h=DoubleType, maint_h=DoubleType, fail_h=DoubleType, cycles=DoubleType, fill=DoubleType,
)
SAFETY = _table(
    incident_id=LongType, site=StringType, day=DateType, shift=StringType, truck=StringType, sev=StringType,
    kind=StringType, down_h=DoubleType,
)
EQUIPMENT = _table(truck=StringType, site=StringType, model=StringType, cap_t=DoubleType, cyc_h=DoubleType)
YEARBOOK = _table(
    tab=StringType, ord=IntegerType, lvl=IntegerType, label=StringType, parent=StringType, grp=StringType,
    yr=IntegerType, value=DoubleType, value_text=StringType, unit=StringType,
)
HOURLY_PRICE = _table(day=DateType, hour=IntegerType, bus=StringType, price=DoubleType)
DAILY_PRICE = _table(
    day=DateType, bus=StringType, price_mean=DoubleType, price_solar=DoubleType, price_night=DoubleType, hours=LongType
)
SHEET_ROWS = StructType(
    [
        StructField("sheet", StringType()),
        StructField("row_num", LongType()),
        StructField("cells", ArrayType(StructType([StructField("num", DoubleType()), StructField("txt", StringType())]))),
    ]
)

RAW = {
    "raw_telemetry": TELEMETRY,
    "raw_maintenance": MAINTENANCE,
    "raw_safety": SAFETY,
    "equipment": EQUIPMENT,
    "raw_yearbook": YEARBOOK,
    "raw_daily_price": DAILY_PRICE,
    "raw_hourly_price": HOURLY_PRICE,
}
