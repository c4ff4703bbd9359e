"""Explicit schemas and column lists.

Schemas are declared up front: inferring a CSV schema makes Spark read the
whole input once more before the real job starts.

Fixed values (they must equal the data layouts the pipeline reads):
column names, their order and their types of the legacy layout (29
columns), the modern layout (27 columns), the unified flights table (25
columns), the training sample (12 columns) and the registry record.
Names are kept in lower case; Spark resolves them case-insensitively, so
``CANCELLED`` and ``cancelled`` name the same column.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: legacy layout, in file order -----------------------------
LEGACY_DDL = (
    "month double, dayofmonth double, dayofweek double, deptime double, crsdeptime double, "
    "arrtime double, crsarrtime double, uniquecarrier string, flightnum double, tailnum string, "
    "actualelapsedtime double, crselapsedtime double, airtime double, arrdelay double, "
    "depdelay double, origin string, dest string, distance double, taxiin double, taxiout double, "
    "cancelled double, cancellationcode string, diverted double, carrierdelay double, "
    "weatherdelay double, nasdelay double, securitydelay double, lateaircraftdelay double, "
    "year double"
)

# --- fixed values: modern layout, in file order -----------------------------
MODERN_DDL = (
    "fl_date date, op_carrier string, op_carrier_fl_num string, origin string, dest string, "
    "crs_dep_time string, dep_time string, dep_delay double, taxi_out double, wheels_off string, "
    "wheels_on string, taxi_in double, crs_arr_time string, arr_time string, arr_delay double, "
    "cancelled double, cancellation_code string, diverted double, crs_elapsed_time double, "
    "actual_elapsed_time double, air_time double, distance double, carrier_delay double, "
    "weather_delay double, nas_delay double, security_delay double, late_aircraft_delay double"
)

# --- fixed values: legacy name -> unified name ------------------------------
LEGACY_RENAMES = {
    "deptime": "dep_time",
    "crsdeptime": "crs_dep_time",
    "arrtime": "arr_time",
    "crsarrtime": "crs_arr_time",
    "uniquecarrier": "op_carrier",
    "flightnum": "op_carrier_fl_num",
    "actualelapsedtime": "actual_elapsed_time",
    "crselapsedtime": "crs_elapsed_time",
    "airtime": "air_time",
    "arrdelay": "arr_delay",
    "depdelay": "dep_delay",
    "origin": "origin",
    "dest": "dest",
    "distance": "distance",
    "taxiin": "taxi_in",
    "taxiout": "taxi_out",
    "cancelled": "cancelled",
    "cancellationcode": "cancellation_code",
    "diverted": "diverted",
    "carrierdelay": "carrier_delay",
    "weatherdelay": "weather_delay",
    "nasdelay": "nas_delay",
    "securitydelay": "security_delay",
    "lateaircraftdelay": "late_aircraft_delay",
}

# --- fixed values: unified flights table, in table order --------------------
UNIFIED_COLUMNS = [
    "fl_date", "dep_time", "crs_dep_time", "arr_time", "crs_arr_time", "op_carrier",
    "op_carrier_fl_num", "actual_elapsed_time", "crs_elapsed_time", "air_time", "arr_delay",
    "dep_delay", "origin", "dest", "distance", "taxi_in", "taxi_out", "cancelled",
    "cancellation_code", "diverted", "carrier_delay", "weather_delay", "nas_delay",
    "security_delay", "late_aircraft_delay",
]

# Columns that are text in one layout and numbers in the other; settled to
# HHMM / flight-number text without decimals before the union.
TEXT_NUMBER_COLUMNS = ["dep_time", "crs_dep_time", "arr_time", "crs_arr_time", "op_carrier_fl_num"]

# --- fixed values: training sample, in file order ---------------------------
TRAINING_COLUMNS = [
    "fl_date", "op_carrier", "op_carrier_fl_num", "origin", "dest", "crs_dep_time",
    "crs_arr_time", "cancelled", "crs_elapsed_time", "distance", "hour", "week",
]
TRAINING_DDL = (
    "fl_date date, op_carrier string, op_carrier_fl_num string, origin string, dest string, "
    "crs_dep_time string, crs_arr_time string, cancelled double, crs_elapsed_time double, "
    "distance double, hour int, week int"
)

# --- fixed values: model features and label ---------------------------------
CATEGORICAL_FEATURES = ["op_carrier", "origin", "dest"]
NUMERIC_FEATURES = ["week", "hour"]
LABEL = "cancelled"
TARGET_NAMES = ["Not-cancelled", "Cancelled"]

# Columns that together name a flight.
FLIGHT_KEY = ["fl_date", "op_carrier", "op_carrier_fl_num", "origin", "dest", "crs_dep_time"]

# Row key carried through every fixture-derived table (the raw data has none).
ROW_KEY = "row_key"


_FLAT_TYPES = {"double": T.DoubleType, "string": T.StringType, "date": T.DateType, "int": T.IntegerType}


def flat_schema(ddl: str) -> T.StructType:
    """``"a double, b string"`` -> StructType (flat, nullable; no JVM needed at import)."""
    fields = []
    for item in ddl.split(","):
        name, type_name = item.split()
        fields.append(T.StructField(name, _FLAT_TYPES[type_name](), True))
    return T.StructType(fields)


def with_row_key(ddl: str) -> T.StructType:
    """Schema of a raw layout with the fixture's ``row_key`` in front."""
    return flat_schema(f"{ROW_KEY} string, {ddl}")


LEGACY_SCHEMA = flat_schema(LEGACY_DDL)
MODERN_SCHEMA = flat_schema(MODERN_DDL)
TRAINING_SCHEMA = flat_schema(TRAINING_DDL)

# --- fixed values: model registry record (18 fields, five of them structs), in file order ---
REGISTRY_DDL = (
    "id string, projectId int, "
    "project struct<id: int, name: string, slug: string, crn: string, default_project_engine_type: string>, "
    "projectOwner struct<id: int, username: string, type: string>, "
    "crn string, creatorId int, creator struct<id: int, username: string, type: string>, "
    "name string, description string, visibility string, accessKey string, authEnabled boolean, "
    "defaultResources struct<cpuMillicores: int, memoryMb: int>, "
    "defaultReplicationPolicy struct<type: string, numReplicas: int>, "
    "htmlUrl string, createdAt string, updatedAt string, namespace string"
)

# --- fixed values: deployment status of a model, as the status reply nests it ---
STATUS_DDL = "id string, latestModelDeployment struct<crn: string, status: string, replicationStatus: struct<numReplicasAvailable: int>>"
