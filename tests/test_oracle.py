"""Every report against its SQL in DuckDB."""

import pytest
from compare import connect, differences

from tallybook.reports.registry import all_reports

SF_DIR = "/root/testdata/sf0.001"
REPORTS = all_reports()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(REPORTS))
def test_report_equals_sql(spark, con, name):
    report = REPORTS[name]
    assert differences(report.run(spark, SF_DIR), con, report.oracle()) == []


def test_entry_functions(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(REPORTS) <= set(driver.oracle_sql())
    assert driver.entry(spark).count() == 150
