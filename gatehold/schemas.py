"""Declared schemas of the raw inputs (as DDL), so that no source needs inference."""

FLIGHTS_RAW = (
    "Year int, Month int, DayofMonth int, DayOfWeek int, CRSDepTime string, UniqueCarrier string, "
    "FlightNum int, TailNum string, Origin string, Dest string, Distance int, DepDelay int"
)

WEATHER_RAW = (
    "STATION string, DATE timestamp, REPORT_TYPE2 string, DailyPrecipitation string, DailySnowfall string, "
    "DailySnowDepth string, DailyMinimumDryBulbTemperature int, DailyMaximumDryBulbTemperature int"
)

AIRPORT_CODES = "iata_code string, name string, iso_region string"
