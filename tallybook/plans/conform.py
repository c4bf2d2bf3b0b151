"""Account status, relationships and account lists.

``by`` names extra join keys, normally ``("snapshot_date",)``, so that one plan
handles all processing days at once; without it the inputs are one day's extracts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import starts_with_any
from tallybook.functions.dates import as_date
from tallybook.operators.lookups import small_lookup
from tallybook.operators.picks import latest_per_key

# Status code types that count, the application left out, live statuses.
STATUS_CODE_TYPES = ["STAT", "SS", "LNST", "CLSD"]
EXCLUDED_APPLICATION = "SI"
LIVE_STATUSES = ["OPEN", "DORMANT"]
DEPOSIT_APPLICATIONS = ["DD", "SV", "CD", "IR"]
LENDING_APPLICATIONS = ["LN", "ML"]
MERCHANT_SERVICES_PRODUCT = "1-55-"


def conform_status(codes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One conformed status per code; a blank or null description reads OPEN.

    Several descriptions for one code give the alphabetically first, so a code never
    multiplies accounts.
    """
    kept = codes.where(
        F.col("code_type").isin(STATUS_CODE_TYPES)
        & (F.col("application") != EXCLUDED_APPLICATION)
    )
    text = F.col("code_description_2")
    status = F.when(text != "", text).otherwise("OPEN")
    return kept.groupBy("code_key", *by).agg(F.min(status).alias("conformed_status"))


def conformed_accounts(
    accounts: DataFrame,
    codes: DataFrame,
    default: str | None = "OPEN",
    by: Sequence[str] = (),
) -> DataFrame:
    """Accounts with their status; an unknown status key gets the default or stays null."""
    status = conform_status(codes, by).withColumnRenamed("code_key", "status_key")
    out = accounts.join(status, ["status_key", *by], "left")
    if default is not None:
        out = out.fillna(default, subset=["conformed_status"])
    return out


def build_relationship_base(
    xref: DataFrame,
    product_groups: DataFrame,
    ownership: DataFrame,
    accounts: DataFrame,
    unmatched: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Customer-account relationships with product group, ownership and status.

    ``accounts`` carries ``conformed_status``. A relationship without an account row
    gets ``unmatched`` as its status, or null. Groups and ownership types are few: as long as they are, they
    are looked up in place, and only the accounts are joined.
    """
    groups = product_groups.select(
        F.col("application_code").alias("application"), "product_group", *by
    ).distinct()
    owners = ownership.select("relationship_key", "ownership_type", *by).distinct()
    status = accounts.select("account_key", "conformed_status", *by)
    grouped = _looked_up(xref, groups, ["application", *by], "product_group")
    owned = _looked_up(grouped, owners, ["relationship_key", *by], "ownership_type")
    out = owned.join(status, ["account_key", *by], "left")
    if unmatched is not None:
        out = out.fillna(unmatched, subset=["conformed_status"])
    return out.select(
        "account_key",
        "product_group",
        "conformed_status",
        "customer_key",
        "ownership_type",
        "primary_customer_flag",
        *by,
    )


def _looked_up(df: DataFrame, lookup: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Left join with a lookup, without moving ``df`` if the lookup is small."""
    small = small_lookup(lookup, keys, value)
    if small is None:
        return df.join(lookup, list(keys), "left")
    kinds = [df.schema[k].dataType for k in keys]
    return df.withColumn(value, small.get(*keys, typed=kinds))


def direct_relationships(
    base: DataFrame,
    groups: Iterable[str] | None = None,
    statuses: Iterable[str] | None = None,
    exclude_groups: Iterable[str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Direct owners, one row per account and customer; the primary row wins."""
    kept = base.where(F.col("ownership_type") == "Direct")
    if groups is not None:
        kept = kept.where(F.col("product_group").isin(list(groups)))
    if exclude_groups is not None:
        kept = kept.where(~F.col("product_group").isin(list(exclude_groups)))
    if statuses is not None:
        kept = kept.where(F.col("conformed_status").isin(list(statuses)))
    return latest_per_key(
        kept,
        ["account_key", "customer_key", *by],
        "primary_customer_flag",
        ["product_group", "conformed_status"],
    )


def activity_flags(
    base: DataFrame, by: Sequence[str] = (), legacy_active: bool = False
) -> DataFrame:
    """``is_active`` and ``is_direct`` (Y/N) per customer.

    Active: any open or dormant relationship (``legacy_active``: any relationship).
    Direct: direct owner of an open or dormant deposit or lending product.
    """
    live = F.col("conformed_status").isin(LIVE_STATUSES)
    direct = (
        live
        & (F.col("ownership_type") == "Direct")
        & F.col("product_group").isin("Deposit", "Lending")
    )
    active = F.lit(True) if legacy_active else live

    def flag(test):
        return F.when(F.max(test), "Y").otherwise("N")

    return base.groupBy("customer_key", *by).agg(
        flag(active).alias("is_active"), flag(direct).alias("is_direct")
    )


def business_accounts(
    accounts: DataFrame,
    codes: DataFrame,
    product_lookup: DataFrame,
    merchant_product: str = MERCHANT_SERVICES_PRODUCT,
    by: Sequence[str] = (),
) -> DataFrame:
    """Accounts of business products, with status and a merchant-services flag."""
    business = product_lookup.where(F.col("consumer_or_business_product") == "Business")
    merchant = F.when(F.col("product_key") == merchant_product, 1).otherwise(0)
    return (
        conformed_accounts(accounts, codes, "OPEN", by)
        .join(business.select("product_key").distinct(), "product_key", "left_semi")
        .withColumn("merchant_services_flag", merchant)
    )


def relationship_type_counts(
    xref: DataFrame,
    accounts: DataFrame,
    dates: DataFrame,
    relationship: str | None = None,
) -> DataFrame:
    """Relationship rows per type, or per product for one type, on the given days."""
    days = F.broadcast(dates.select("snapshot_date").distinct())  # bounded by the calendar
    rows = xref.join(days, "snapshot_date", "left_semi")
    if relationship is None:
        keys = ["snapshot_date", "relationship_key"]
    else:
        # counted per account first, so the account join moves one row per account
        keys = ["snapshot_date", "product_key"]
        rows = (
            rows.where(F.col("relationship_key") == relationship)
            .groupBy("snapshot_date", "account_key")
            .agg(F.count(F.lit(1)).alias("_n"))
            .join(
                accounts.select("snapshot_date", "account_key", "product_key"),
                ["snapshot_date", "account_key"],
                "left",
            )
        )
        return rows.groupBy(*keys).agg(F.sum("_n").alias("relationship_count"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("relationship_count"))


def estatement_accounts(
    delivery: DataFrame, accounts: DataFrame, products: DataFrame, codes: DataFrame
) -> DataFrame:
    """Live deposit and lending accounts; ``estatements`` is 1 where statements go
    out electronically, else null."""
    electronic = (
        delivery.where((F.col("delivery_method") == "E") & (F.col("form_category") == "STMT"))
        .select("account_key")
        .distinct()
        .withColumn("estatements", F.lit(1))
    )
    eligible = products.where(F.col("product_group").isin("Deposit", "Lending"))
    return (
        conformed_accounts(accounts, codes, "OPEN")
        .where(F.col("conformed_status").isin(LIVE_STATUSES))
        .join(eligible.select("product_key", "product_group").distinct(), "product_key")
        .join(electronic, "account_key", "left")
    )


def retail_deposit_accounts(
    accounts: DataFrame,
    type_lookup: DataFrame,
    gl_lookup: DataFrame,
    since: date | str,
    tiebreak: Sequence[str] = ("product_key",),
) -> DataFrame:
    """Newest row of each consumer retail deposit account opened on or after a day."""
    consumer = type_lookup.where(F.col("consumer_or_business_product") == "Consumer")
    retail = gl_lookup.where(starts_with_any("gl_type_description", ["RET"])).select(
        F.col("gl_type_code").alias("gl_type"),
        F.col("application_code").alias("sub_application_code"),
        "gl_type_description",
    )
    newest = latest_per_key(accounts, ["account_key"], "snapshot_date", tiebreak)
    return (
        newest.where(
            F.col("application_code").isin(DEPOSIT_APPLICATIONS)
            & (F.col("date_opened") >= as_date(since))
        )
        .join(consumer.select("product_key").distinct(), "product_key", "left_semi")
        .join(retail.distinct(), ["gl_type", "sub_application_code"])
    )


def xref_usable(
    xref: DataFrame,
    ownership: DataFrame,
    accounts: DataFrame,
    codes: DataFrame,
    product_lookup: DataFrame,
    month_ends: DataFrame,
    excluded_products: Iterable[str] = (),
) -> DataFrame:
    """Month-end relationships with ownership, status and product designation.

    The feeds carry ``snapshot_date``; ``month_ends`` maps each used day to its
    calendar month-end. Only products designated Product or Service remain.
    """
    # bounded by the calendar, as are the days in the array that prunes the snapshot scans
    used = month_ends.agg(F.collect_set("snapshot_date"))
    ends = F.broadcast(
        month_ends.select("snapshot_date", F.col("month_end").alias("me_utc_timestamp"))
    )
    key = ["me_utc_timestamp"]

    def at_month_end(feed: DataFrame) -> DataFrame:
        wanted = feed.where(F.array_contains(used.scalar(), F.col("snapshot_date")))
        return wanted.join(ends, "snapshot_date").drop("snapshot_date")

    designated = (
        product_lookup.where(
            F.col("retail_product_designation").isin("Product", "Service")
            & ~F.col("product_key").isin(list(excluded_products))
        )
        .select("product_key", "retail_product_designation")
        .distinct()
    )
    # an account without a row has no product either, so the inner joins lose nothing
    status = conformed_accounts(at_month_end(accounts), at_month_end(codes), "OPEN", key)
    status = status.select("account_key", "product_key", "conformed_status", *key).distinct()
    owners = at_month_end(ownership).select("relationship_key", "ownership_type", *key)
    return (
        at_month_end(xref)
        .join(owners.distinct(), ["relationship_key", *key], "left")
        .join(status, ["account_key", *key])
        .join(designated, "product_key")
        .select(
            "account_key",
            "customer_key",
            "primary_customer_flag",
            "ownership_type",
            "conformed_status",
            "retail_product_designation",
            "me_utc_timestamp",
        )
    )

