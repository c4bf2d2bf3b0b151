"""Products per customer by branch, and the goals derived from them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.operators.aggregates import distinct_counts, nested_mean, pivot_agg
from tallybook.operators.picks import top_k
from tallybook.operators.ranks import ranked
from tallybook.plans.conform import LIVE_STATUSES

BRANCH = "dynamic_branch_name"
MONTH = "me_utc_timestamp"


def month_end_snapshots(spine: DataFrame) -> DataFrame:
    """Last processing day of each month with the calendar month-end it stands for."""
    return (
        spine.groupBy(F.last_day("snapshot_date").alias("month_end"))
        .agg(F.max("snapshot_date").alias("snapshot_date"))
        .select("month_end", "snapshot_date")
    )


def product_counts(
    xref_usable: DataFrame,
    monthly_assignments: DataFrame,
    excluded_branches: Iterable[str] = (),
    officer: str = "RTL",
) -> DataFrame:
    """Live accounts owned directly by customers of retail officers, with branch and quarter."""
    assigned = monthly_assignments.where(
        (F.col("dynamic_officer_assignment") == officer)
        & ~F.col(BRANCH).isin(list(excluded_branches))
    ).select("customer_key", MONTH, BRANCH)
    live = xref_usable.where(
        (F.col("ownership_type") == "Direct") & F.col("conformed_status").isin(LIVE_STATUSES)
    )
    # the officer test drops every relationship without an assignment
    return live.join(assigned, ["customer_key", MONTH]).select(
        BRANCH,
        "customer_key",
        MONTH,
        F.date_format(MONTH, "yyyy_Q").alias("quarter"),
        "account_key",
    )


def branch_month_means(counts: DataFrame) -> DataFrame:
    """Mean distinct products per customer, by branch and month."""
    per_customer = distinct_counts(
        counts, [BRANCH, "customer_key", MONTH, "quarter"], {"products": "account_key"}
    )
    return nested_mean(per_customer, [[BRANCH, MONTH, "quarter"]], "products", "mean_products")


def quarterly_products_per_customer(counts: DataFrame, year: int, prefix: str) -> DataFrame:
    """One row per branch, one column per real quarter ``<prefix>_Q1`` to ``_Q4``."""
    months = branch_month_means(counts.where(F.year(MONTH) == year))
    quarters = nested_mean(months, [[BRANCH, "quarter"]], "mean_products", "mean_products")
    labels = [f"{year}_{q}" for q in range(1, 5)]
    return pivot_agg(
        quarters,
        [BRANCH],
        "quarter",
        labels,
        F.max("mean_products"),
        [f"{prefix}_Q{q}" for q in range(1, 5)],
    )


def annual_goal_stddev(counts: DataFrame, year: int) -> DataFrame:
    """Sample standard deviation of a branch's monthly means (null for one month)."""
    months = branch_month_means(counts.where(F.year(MONTH) == year))
    return months.groupBy(BRANCH).agg(
        F.stddev_samp("mean_products").alias("current_year_annual_goal")
    )


def year_end_counts(counts: DataFrame, year: int) -> DataFrame:
    """Distinct customers and accounts per branch in the last month present in the year."""
    monthly = distinct_counts(
        counts.where(F.year(MONTH) == year),
        [BRANCH, MONTH],
        {"prior_ye_num_cust": "customer_key", "prior_ye_num_prod_svc": "account_key"},
    )
    # at most twelve rows per branch reach this window; looking the month up on its own
    # would build the counts twice
    last = F.max(MONTH).over(Window.partitionBy())
    return monthly.withColumn("_last", last).where(F.col(MONTH) == F.col("_last")).drop(
        MONTH, "_last"
    )


def goal_ladder(base: DataFrame) -> DataFrame:
    """Five goal steps per quarter from the prior Q4 mean and the annual goal.

    Step 3 of quarter n is the prior Q4 plus n quarters of the goal, step 1 is the
    previous quarter's step 3, and the other steps continue at half that distance.
    """
    start, goal = F.col("prior_year_Q4"), F.col("current_year_annual_goal")
    steps = {}
    one = start
    for quarter in range(1, 5):
        three = start + goal / 4 * quarter
        two = (one + three) / 2
        four = three + (two - one)
        five = four + (two - one)
        for n, step in enumerate((one, two, three, four, five), start=1):
            steps[f"current_year_q{quarter}_{n}pt_goal"] = step
        one = three
    return base.withColumns(steps)


def branch_goals(counts: DataFrame, year: int) -> DataFrame:
    """Prior and current quarters, annual goal, year-end counts and the goal ladder.

    A quarter's mean is the mean of its months, so both years' quarters and the goal come
    from one aggregate over the branch-month means. Branches without a prior year drop out.
    """
    prior = F.year(MONTH) == year - 1
    months = branch_month_means(counts.where(F.year(MONTH).between(year - 1, year)))

    def quarter_mean(y: int, q: int):
        return F.avg(F.when(F.col("quarter") == f"{y}_{q}", F.col("mean_products")))

    means = months.groupBy(BRANCH).agg(
        *[quarter_mean(year - 1, q).alias(f"prior_year_Q{q}") for q in range(1, 5)],
        *[quarter_mean(year, q).alias(f"current_year_Q{q}") for q in range(1, 5)],
        F.stddev_samp(F.when(prior, F.col("mean_products"))).alias("current_year_annual_goal"),
        F.count(F.when(prior, 1)).alias("_prior_months"),
    )
    base = means.where(F.col("_prior_months") > 0).drop("_prior_months")
    return goal_ladder(base.join(year_end_counts(counts, year - 1), BRANCH, "left"))


def monthly_products_pivot(counts: DataFrame, months: Sequence[str]) -> DataFrame:
    """One row per branch, one column of mean products per listed month-end (ISO text).

    The list is the window: other months are not read. :func:`branch_month_means` has all.
    """
    listed = counts.where(F.col(MONTH).cast("string").isin(list(months)))
    means = branch_month_means(listed).withColumn("_month", F.col(MONTH).cast("string"))
    return pivot_agg(means, [BRANCH], "_month", months, F.max("mean_products"))


def top_customers_by_products(
    base: DataFrame,
    customer_types: DataFrame,
    assignments: DataFrame,
    customer_type: str = "Personal",
    k: int | None = None,
    rank: str | None = None,
) -> DataFrame:
    """Customers of one type by live direct accounts, most first, with branch and flags.

    All of them, or the first ``k``; the order is total, by count and then key. ``rank`` names a column
    for the position in it.
    """
    live = base.where(
        F.col("product_group").isin("Deposit", "Lending", "Services")
        & (F.col("ownership_type") == "Direct")
        & F.col("conformed_status").isin(LIVE_STATUSES)
    )
    typed = customer_types.where(F.col("customer_type") == customer_type)
    counted = distinct_counts(
        live.join(typed.select("customer_key").distinct(), "customer_key", "left_semi"),
        ["customer_key"],
        {"num_prod_svcs": "account_key"},
    )
    branch = assignments.select(
        "customer_key", "dynamic_branch_assignment", "is_active", "is_direct"
    )
    if k is not None:
        counted = top_k(counted, "num_prod_svcs", k, ["customer_key"])
    order = [F.desc("num_prod_svcs"), F.asc_nulls_last("customer_key")]
    if rank is not None:
        return ranked(counted, order, rank).join(branch, "customer_key", "left")
    return counted.join(branch, "customer_key", "left").orderBy(*order)
