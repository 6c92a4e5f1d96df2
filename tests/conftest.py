"""Session and hand-made inputs. The expected values are worked out by hand."""

from __future__ import annotations

import json
from datetime import datetime

import pytest

from gatehold import schemas
from gatehold.plans import airports, flights, weather
from gatehold.session import local_session
from gatehold.sources import files

STATIONS = {"STN1": "ORD", "STN2": "SEA"}


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def flight_files(tmp_path_factory):
    """The first part has a header, the others have none; one field of the last line is not a number."""
    folder = tmp_path_factory.mktemp("flights")
    header = ",".join(part.split()[0] for part in schemas.FLIGHTS_RAW.split(", "))
    (folder / "part-00000").write_text(
        f"{header}\n2007,3,4,7,741,UA,100,N1,ORD,SEA,1721,16\n2007,3,4,7,5,UA,101,NA,SEA,ORD,1721,15\n"
    )
    (folder / "part-00501").write_text(
        "2007,12,31,1,2359,AA,7,N2,ORD,EWR,719,NA\n"
        "2008,1,1,2,1200,AA,8,N3,ORD,LGA,733,-4\n"
        "2008,1,1,2,2400,AA,9,N3,ORD,LGA,733,1\n"
        "2008,2,29,5,NA,AA,10,N4,ORD,SEA,1721,30\n"
        "1987,10,14,3,741,PS,1451,NA,SAN,SFO,447,11\n"
        "1987,10,15,4,630,UA,12,NA,ORD,SEA,1721,20\n"
    )
    (folder / "part-00777").write_text("2006,5,6,6,900,XX,oops,N9,LAX,SEA,954,3\n")
    return str(folder)


@pytest.fixture(scope="session")
def raw(spark, flight_files):
    return files.multipart_csv(
        spark, f"{flight_files}/part-00000", f"{flight_files}/part-00[5-9][0-9][0-9]", schemas.FLIGHTS_RAW
    )


@pytest.fixture(scope="session")
def silver(raw):
    return flights.silver(flights.bronze(raw, ["ORD", "SEA"]))


@pytest.fixture(scope="session")
def weather_raw(spark):
    def at(text):
        return datetime.fromisoformat(text)

    rows = [
        ("STN1", at("2007-03-04T23:59:00"), "SOD  ", "T", "0.3", "T", 20, 33),
        ("STN2", at("2007-03-04T23:59:00"), "SOD", "0.29", "T", "1.2", 38, 50),
        ("STN1", at("2007-12-31T23:59:00"), "SOD", None, "1.2", "5", 10, 25),
        ("STN1", at("2007-03-04T10:51:00"), "FM-15", "0.1", None, None, None, None),
        ("STN1", at("2008-01-01T23:59:00"), " SOD", "0.05s", "0.0", "0", 12, 28),
    ]
    return spark.createDataFrame(rows, schemas.WEATHER_RAW)


@pytest.fixture(scope="session")
def daily(weather_raw):
    return weather.daily_weather(weather_raw, STATIONS)


@pytest.fixture(scope="session")
def airport_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("airports") / "codes.json"
    rows = [
        ("SEA", "Seattle Tacoma", "US-WA"),
        ("EWR", "Newark", "US-NJ"),
        ("LGA", "LaGuardia", "US-NY"),
        ("ORD", "OHare", "US-IL"),
        ("XXX", "NoRegion", "US"),
    ]
    path.write_text("\n".join(json.dumps(dict(zip(("iata_code", "name", "iso_region"), r))) for r in rows))
    return str(path)


@pytest.fixture(scope="session")
def airport_codes(spark, airport_file):
    return airports.with_region(files.json_lines(spark, airport_file, schemas.AIRPORT_CODES))


@pytest.fixture(scope="session")
def database(spark, tmp_path_factory):
    from gatehold.operators import tables

    tables.create_database(spark, "tests_db", str(tmp_path_factory.mktemp("database")))
    return "tests_db"


def rows_of(df, *columns):
    """Rows as a sorted list of tuples, for comparing without regard to order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
