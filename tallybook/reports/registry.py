"""All reports by name."""

from __future__ import annotations

import importlib

from tallybook.reports.report import Report

AREAS = [
    "basics",
    "accounts",
    "lifecycle",
    "branches",
    "transactions",
    "campaign",
    "cohorts",
    "digital",
]


def all_reports() -> dict[str, Report]:
    reports: dict[str, Report] = {}
    for area in AREAS:
        module = importlib.import_module(f"tallybook.reports.{area}")
        for report in module.REPORTS:
            if report.name in reports:
                raise ValueError(f"two reports are named {report.name}")
            reports[report.name] = report
    return reports
