"""The canonical observation table and the fixed identifiers in it.

``scraped_at`` is a ``timestamp_ntz`` that holds UTC wall time, so no result
depends on the zone of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Source identifiers stored in the data.
RETAIL = "gasbuddy_fuel_insights"
DAILY_AVG = "aaa_gas_prices"
RBOB = "marketwatch_rbob_futures"
WTI = "marketwatch_wti_futures"
STOCKS = "tradingeconomics_gasoline_stocks"
RUNS = "tradingeconomics_refinery_runs"
SOURCES = [RETAIL, DAILY_AVG, RBOB, WTI, STOCKS, RUNS]

# Fuel type and region written with each source.
FUEL_TYPE = {
    RETAIL: "regular_gas",
    DAILY_AVG: "regular",
    RBOB: "rbob_futures",
    WTI: "wti_futures",
    STOCKS: "gasoline_stocks_change",
    RUNS: "refinery_crude_runs",
}
REGION = "United States"

# Weekly releases are stored without the jump check.
SCREENED = [RETAIL, DAILY_AVG, RBOB, WTI]

OBSERVATION = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("fuel_type", T.StringType()),
        T.StructField("price", T.DecimalType(10, 4)),
        T.StructField("label_ts", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("consensus", T.DecimalType(10, 4)),
        T.StructField("surprise", T.DecimalType(10, 4)),
        T.StructField("scraped_at", T.TimestampNTZType(), False),
        T.StructField("as_of_date", T.DateType()),
    ]
)
COLUMNS = OBSERVATION.fieldNames()
BASE_COLUMNS = ["source", "fuel_type", "price", "label_ts", "region", "scraped_at"]
OPTIONAL_COLUMNS = ["consensus", "surprise", "as_of_date"]
ADDED_LATER = {"consensus": "double", "surprise": "double", "as_of_date": "date"}

KEY_V1 = ["source", "fuel_type", "label_ts", "scraped_at"]
KEY = ["source", "fuel_type", "scraped_at"]
SERIES_KEY = ["region", "source", "fuel_type"]


def conform(df: DataFrame) -> DataFrame:
    """Cast to the stored types in stored order; absent columns become NULL and
    NaN becomes NULL."""
    have = set(df.columns)
    out = []
    for field in OBSERVATION:
        if field.name not in have:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name)
        if isinstance(df.schema[field.name].dataType, (T.DoubleType, T.FloatType)):
            value = F.when(F.isnan(value), None).otherwise(value)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def as_double(df: DataFrame) -> DataFrame:
    """Compute form: decimals become doubles before any arithmetic."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("double")
            for f in df.schema
            if isinstance(f.dataType, T.DecimalType)
        }
    )


def observation_id(keys: list[str] = KEY):
    """Surrogate key: a hash of the natural key."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)
