"""Table layouts, keys, thresholds and vocabularies (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

_BY_NAME = {
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def _layout(text: str) -> T.StructType:
    """``"name type"`` lines to a schema; a name may contain spaces."""
    fields = []
    for line in filter(None, (raw.strip() for raw in text.splitlines())):
        name, kind = line.rsplit(" ", 1)
        fields.append(T.StructField(name.strip(), _BY_NAME[kind], True))
    return T.StructType(fields)


# Conformed trip columns, in canonical order.
TRIP = _layout(
    """
    pickup_datetime timestamp
    dropoff_datetime timestamp
    pulocationid int
    dolocationid int
    trip_distance double
    fare_amount double
    total_amount double
    taxi_type string
    vendor_id long
    hvfhs_license_num string
    dispatching_base_num string
    originating_base_num string
    passenger_count int
    ratecode_id string
    request_datetime timestamp
    on_scene_datetime timestamp
    store_and_fwd_flag boolean
    payment_type string
    trip_time long
    shared_request_flag boolean
    extra double
    mta_tax double
    improvement_surcharge double
    wav_request_flag boolean
    wav_match_flag boolean
    tip_amount double
    tolls_amount double
    driver_pay double
    congestion_surcharge double
    airport_fee double
    cbd_congestion_fee double
    bcf double
    sales_tax double
    access_a_ride_flag boolean
    shared_match_flag boolean
    """
)

FACT = _layout(
    """
    hour_ts timestamp
    pulocationid int
    demand long
    avg_trip_distance double
    avg_total_amount double
    row_fingerprint string
    """
)

# Rows kept from one feature run for the lags of the next.
LAST_ROWS = _layout(
    """
    hour_ts timestamp
    pulocationid int
    demand long
    as_of date
    """
)

HISTORY_SUMS = _layout(
    """
    pulocationid int
    hour_of_day int
    day_of_week int
    data_month date
    total double
    n long
    """
)

_SUM = T.StructType([T.StructField("feature", T.StringType()), T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType())])
_SPREAD = T.StructType([T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType()), T.StructField("sketch", T.BinaryType())])
_ERRORS = T.StructType([T.StructField("n", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("squares", "absolute", "shares")]])
# Mergeable summary of a month of features.
FEATURE_SUMMARY = T.StructType(
    [
        T.StructField("data_month", T.DateType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("features", T.ArrayType(_SUM)),
        T.StructField("label", _SPREAD),
        T.StructField("errors", _ERRORS),
    ]
)

WEATHER = _layout(
    """
    date date
    temperature_mean double
    precipitation_sum double
    wind_speed_max double
    borough string
    """
)

ZONE = _layout(
    """
    location_id int
    borough string
    zone string
    service_zone string
    """
)

ZONE_RAW = _layout(
    """
    LocationID int
    Borough string
    Zone string
    service_zone string
    """
)

FEATURE_TABLE = _layout(
    """
    pulocationid int
    hour_ts timestamp
    target_demand long
    hour int
    day_of_week int
    month int
    is_weekend int
    hour_sin double
    hour_cos double
    dow_sin double
    dow_cos double
    temperature_mean double
    precipitation_sum double
    wind_speed_max double
    is_rainy int
    is_heavy_rain int
    is_hot int
    demand_lag_1 long
    demand_lag_2 long
    demand_lag_24 long
    rolling_mean_3h double
    borough_manhattan int
    borough_brooklyn int
    borough_queens int
    borough_bronx int
    borough_staten island int
    borough_ewr int
    borough_nan int
    service_zone_Yellow_Zone int
    service_zone_Boro_Zone int
    service_zone_Airports int
    service_zone_EWR int
    service_zone_nan int
    """
)

DRIFT_SUMMARY = _layout(
    """
    data_month date
    execution_date date
    avg_feature_drift double
    high_drift_count int
    critical_count int
    label_drift_score double
    label_severity string
    label_should_alert boolean
    model_rmse_ratio double
    model_severity string
    model_should_alert boolean
    overall_status string
    training_triggered boolean
    """
)

DRIFT_FEATURES = _layout(
    """
    data_month date
    feature string
    feature_type string
    reference_value double
    current_value double
    drift_score double
    severity string
    """
)

SCHEMAS = {
    "trips": TRIP,
    "fact_trips_pickup": FACT,
    "dim_weather": WEATHER,
    "dim_zone": ZONE,
    "pickup_features": FEATURE_TABLE,
    "drift_run_summary": DRIFT_SUMMARY,
    "drift_feature_stats": DRIFT_FEATURES,
}

KEYS = {
    "fact_trips_pickup": ("hour_ts", "pulocationid"),
    "dim_weather": ("date", "borough"),
    "dim_zone": ("location_id",),
    "pickup_features": ("hour_ts", "pulocationid"),
    "drift_run_summary": ("data_month",),
    "drift_feature_stats": ("data_month", "feature"),
}

# Columns a raw or processed table must have.
REQUIRED = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"),
    "fhvhv": ("pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"),
    "weather": ("date", "temperature_mean", "precipitation_sum", "wind_speed_max", "borough"),
    "lookup": ("LocationID", "Borough", "Zone", "service_zone"),
    "fact_trips_pickup": tuple(FACT.names),
    "dim_weather": tuple(WEATHER.names),
    "dim_zone": tuple(ZONE.names),
}

# One-hot vocabularies (column suffix -> matched value).
BOROUGHS = ("manhattan", "brooklyn", "queens", "bronx", "staten island", "ewr")
SERVICE_ZONES = ("Yellow Zone", "Boro Zone", "Airports", "EWR")
WEATHER_BOROUGHS = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island", "EWR")
BOROUGH_LABELS = ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR", "Unknown")
SERVICE_ZONE_LABELS = ("Yellow Zone", "Boro Zone", "Airports", "EWR", "Unknown")
WEEKDAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
EXCLUDED_LOCATION_IDS = (264, 265)
UNKNOWN_BOROUGHS = ("N/A", "Unknown")

WEATHER_COLUMNS = ("temperature_mean", "precipitation_sum", "wind_speed_max")
LAG_COLUMNS = ("demand_lag_1", "demand_lag_2", "demand_lag_24", "rolling_mean_3h")

# One vector order for training, drift and serving alike.
NOT_FEATURES = ("hour_ts", "target_demand")
FEATURES = tuple(n for n in FEATURE_TABLE.names if n not in NOT_FEATURES)

ONE_HOT_FEATURES = tuple(n for n in FEATURES if n.startswith(("borough_", "service_zone_")))
DRIFT_EXCLUDED = ("pulocationid", "month")
NUMERIC_FEATURES = ("target_demand",) + tuple(
    n for n in FEATURES if n not in ONE_HOT_FEATURES and n not in DRIFT_EXCLUDED
)
MONITORED_FEATURES = NUMERIC_FEATURES + ONE_HOT_FEATURES

# Drift, anomaly, scoring and promotion thresholds.
CRITICAL, HIGH, MEDIUM = 0.80, 0.55, 0.30
MIN_HIGH_FEATURES = 2
LABEL_DRIFT_ALERT = 0.30
MODEL_DRIFT_ALERT = 0.30
BASELINE_RMSE = 40.0
SCORE_LOW, SCORE_HIGH = 23.0, 196.0
PROMOTION_TOLERANCE = {"val_rmse": 1.01, "val_mae": 1.05, "val_smape": 1.05}
RETRAIN_MONTHS = (1, 7)
ANOMALY = {
    "zero_demand_rate": 0.5,
    "high_demand": 3000,
    "high_amount": 500,
    "zero_distance_rate": 0.05,
    "null_rate": 0.30,
}

# Dashboard feature groups.
FEATURE_GROUPS = {
    "Demand Lags": ("demand_lag_1h", "demand_lag_24h", "demand_lag_168h", "rolling_mean_7d"),
    "Time Buckets": ("hour", "day_of_week", "month"),
    "Time Encoding": ("hour_sin", "hour_cos", "dow_sin", "dow_cos"),
    "Time Flags": ("is_weekend", "is_peak_hour"),
    "Weather": (
        "is_raining",
        "extreme_weather_flag",
        "rain_peak_interaction",
        "temperature",
        "rainfall",
        "temperature_mean",
        "precipitation_sum",
        "wind_speed_max",
    ),
    "Trip Metrics": ("avg_trip_distance", "avg_fare"),
}


def feature_columns(df, exclude=NOT_FEATURES) -> list[str]:
    """Model inputs: every column but the time stamp and the target."""
    return [c for c in df.columns if c not in exclude]


def missing_columns(df, required) -> list[str]:
    """Required names the frame lacks; looks at metadata only."""
    return sorted(set(required) - set(df.columns))


def usable_features(reference, live, wanted=MONITORED_FEATURES) -> tuple[list[str], list[str]]:
    """Split wanted names into (numeric on both sides, missing)."""

    def numeric(df):
        return {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}

    both = numeric(reference) & numeric(live)
    return [c for c in wanted if c in both], [c for c in wanted if c not in both]
