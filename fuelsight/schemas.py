"""Schemas, signal names and KPI codes shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: signal type names as sent by the vehicles (spelling kept) ---
SPEED = "drivingSpeed"
RPM = "rotationlSpeed"
INJECTION = "InsFuelInjection"
ODOMETER = "drivingMileage"
AIRCON = "airConditioningState"
FUEL_LEVEL = "fuelLevel"
FUEL_SUPPLY = "fuelSupplyC-1"

# --- fixed values: KPI codes of the fact tables ---
D_TOTAL_FUEL = "D001"
D_IDLE_FUEL = "D002"
D_DRIVING_FUEL = "D003"
D_AIRCON_FUEL = "D004"
D_OTHER_FUEL = "D005"
D_MILEAGE = "D006"
KM_TOTAL_FUEL = "KM001"
KM_IDLE_FUEL = "KM002"
KM_DRIVING_FUEL = "KM003"
KM_AIRCON_FUEL = "KM004"
KM_OTHER_FUEL = "KM005"
C_TOTAL_MILEAGE = "C001"
C_TOTAL_FUEL = "C002"
C_DRIVING_FUEL = "C003"
C_IDLE_FUEL = "C004"
C_AIRCON_FUEL = "C005"
C_FUEL_PER_100KM = "C006"
FF_AVG_SPEED = "FF001"
FF_HEATING_VALUE = "FF002"
FF_ECONOMY = "FF003"

# Lifetime roll-ups: each current attribute is the sum of one daily KPI.
LIFETIME_FROM_DAY = {
    C_TOTAL_MILEAGE: D_MILEAGE,
    C_TOTAL_FUEL: D_TOTAL_FUEL,
    C_DRIVING_FUEL: D_DRIVING_FUEL,
    C_IDLE_FUEL: D_IDLE_FUEL,
    C_AIRCON_FUEL: D_AIRCON_FUEL,
}

# Earliest instant used when a vehicle has no processed-fill mark yet.
NO_MARK_FLOOR = "1753-01-01 00:00:00"

# Upload envelope as it arrives from the vehicle (M1).
ENVELOPE = T.StructType([
    T.StructField("FR", T.StringType()),   # vehicle id
    T.StructField("TS", T.StringType()),   # send time
    T.StructField("DT", T.StringType()),   # JSON array of readings
])

# One reading inside an envelope payload.
READING = T.StructType([
    T.StructField("ts", T.StringType()),
    T.StructField("stype", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
PAYLOAD = T.ArrayType(READING)

# Long (one row per reading) signal table (M2).
SIGNAL = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("stype", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

# Refuelling record (M4) and processed-fill mark (M5).
FILL = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("fill_start_time", T.TimestampNTZType()),
    T.StructField("gas_id", T.IntegerType()),
    T.StructField("fill_grade", T.StringType()),
    T.StructField("price", T.DoubleType()),
])
PROCESSED_FILL = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("fill_ts", T.TimestampNTZType()),
])

# 100-km checkpoint (M11): per100 is a bucket index, not kilometres.
KM_CHECKPOINT = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("stype", T.StringType()),
    T.StructField("per100", T.IntegerType()),
])

# KPI fact tables.
KPI_DAY = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("now_date", T.DateType()),
    T.StructField("data_key", T.StringType()),
    T.StructField("data_value", T.DoubleType()),
])
KPI_KM = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("mileage", T.IntegerType()),
    T.StructField("data_key", T.StringType()),
    T.StructField("data_value", T.DoubleType()),
])
KPI_FILL = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("gas_id", T.IntegerType()),
    T.StructField("fill_grade", T.StringType()),
    T.StructField("fill_date", T.TimestampNTZType()),
    T.StructField("data_key", T.StringType()),
    T.StructField("data_value", T.DoubleType()),
])
ATTR_CURRENT = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("attribute_type", T.StringType()),
    T.StructField("attribute_value", T.DoubleType()),
])

# Alert payloads.
LOW_FUEL_ALERT = T.StructType([
    T.StructField("msg_type", T.StringType()),
    T.StructField("vin", T.StringType()),
    T.StructField("msg_para", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]))),
])
REFUEL_ALERT = T.StructType([
    T.StructField("vin", T.StringType()),
    T.StructField("fuel_mass", T.DoubleType()),
    T.StructField("fill_amount", T.DoubleType()),
    T.StructField("fill_start_time", T.TimestampNTZType()),
    T.StructField("fill_end_time", T.TimestampNTZType()),
    T.StructField("gps_latitude", T.DoubleType()),
    T.StructField("gps_longitude", T.DoubleType()),
])
