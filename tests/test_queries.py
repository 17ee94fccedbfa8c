"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
from hardwood import catalog
from compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
CHECKS = catalog.oracle_sql()


@pytest.fixture(scope="module", autouse=True)
def generated_code(spark):
    """The registered queries run as they would outside of tests."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    assert difference(spark, database, SF_DIR, QUERIES[name], CHECKS[name]) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry_returns_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_the_flagship_uses_nearly_all_shots(spark):
    """Shots of nation 0, the sentinel, are the only ones without a team."""
    from hardwood.catalog import standins
    from hardwood.plans import dimensions

    shots = standins.shots(spark, SF_DIR)
    teams = dimensions.dim_team(standins.teams(spark, SF_DIR), standins.team_details(spark, SF_DIR)).where("business_key <> '0'")
    with_team = shots.join(teams, shots.team_id == teams.business_key, "left_semi").count()
    assert with_team >= 0.8 * shots.count() and shots.count() == standins.read(spark, SF_DIR, "lineitem").count()
