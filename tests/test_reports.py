from gatehold.operators import tables
from gatehold.plans import reports

from .conftest import rows_of


def in_order(df):
    return [tuple(r) for r in df.collect()]


def test_delay_by_route(silver):
    assert in_order(reports.delay_by_route(silver, [2006, 2007, 2008], "ORD", floor=10)) == [
        (2007, "ORD", "SEA", 16),
        (2008, "ORD", "SEA", 30),
    ]
    assert in_order(reports.delay_by_route(silver, 2007, floor=-1)) == [
        (2007, "ORD", "EWR", 0),
        (2007, "SEA", "ORD", 15),
        (2007, "ORD", "SEA", 16),
    ]


def test_default_floor_is_exclusive(silver):
    assert reports.delay_by_route(silver, 2007).count() == 0
    assert in_order(reports.delay_by_route(silver, 2007, "ORD", floor=16)) == []


def test_delay_by_named_route(silver, airport_codes):
    expected = [(2007, "ORD", "SEA - Seattle Tacoma", 16), (2008, "ORD", "SEA - Seattle Tacoma", 30)]
    assert in_order(reports.delay_by_named_route(silver, airport_codes, [2006, 2007, 2008], "ORD", 10)) == expected
    assert in_order(reports.delay_by_named_route_from(silver, airport_codes, 2006, origin="ORD", floor=10)) == expected


def test_named_route_equals_joining_before_summing(spark, silver, airport_codes):
    """Two airports under one code: each route counts once per name, as if flights were joined one by one."""
    doubled = airport_codes.union(airport_codes.filter("iata_code = 'SEA'"))
    doubled = doubled.union(spark.createDataFrame([("SEA", "Boeing Field", "US-WA", "WA"), (None, "Nowhere", None, None)], doubled.schema))
    silver.createOrReplaceTempView("report_flights")
    doubled.createOrReplaceTempView("report_airports")
    expected = spark.sql(
        """SELECT Year AS year, Origin AS origin, concat(Dest, ' - ', i.name) AS name, sum(delay) AS total_delay
           FROM report_flights JOIN report_airports i ON i.iata_code = Dest
           WHERE Year IN (2007, 2008) GROUP BY Year, Origin, i.name, Dest HAVING sum(delay) > 10"""
    )
    assert rows_of(reports.delay_by_named_route(silver, doubled, [2007, 2008], floor=10)) == rows_of(expected)


def test_airports_are_joined_to_sums_not_to_flights(silver, airport_codes):
    plan = reports.delay_by_named_route(silver, airport_codes, 2007)._jdf.queryExecution().optimizedPlan().toString()
    join, first_sum = plan.index("Join Inner"), plan.rindex("Aggregate [")
    assert first_sum > join  # deeper in the tree, so it runs before the join


def test_delay_by_destination(silver):
    report = reports.delay_by_destination(silver, ["EWR", "LGA"])
    assert in_order(report) == [(2007, "EWR", 0), (2008, "LGA", -3)]


def test_yearly_delays_and_years(silver):
    assert in_order(reports.yearly_delays(silver)) == [(1987, 1, 20), (2007, 2, 31), (2008, 2, 31)]
    assert in_order(reports.years_present(silver)) == [(1987,), (2007,), (2008,)]
    assert reports.matching_count(silver, "Year = 1987").first()["n"] == 1


def test_report_with_parameters(spark, silver):
    silver.createOrReplaceTempView("param_flights")
    query = "SELECT FlightNum FROM param_flights WHERE Year IN (:year, :year + 1) AND Origin = :origin"
    assert rows_of(reports.run_report(spark, query, year=2007, origin="SEA")) == [(101,)]


def test_stored_years_are_pruned(spark, silver, database):
    table = tables.replace_table(silver, f"{database}.report_silver", ["Year"], ["DateString"])
    plan = reports.delay_by_route(table, 2007)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan and "partial_sum" in plan
