"""Campaign targeting, control groups and attribution."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import classify, contains_any, first_non_blank
from tallybook.functions.dates import as_date
from tallybook.operators.joins import asof_join
from tallybook.operators.picks import latest_per_key
from tallybook.plans.transactions import (
    NSF_CODE,
    PAYDAY_EXCLUSIONS,
    PAYDAY_PHRASES,
    recent_activity_flag,
    recent_activity_flags,
)

# Campaign outcomes from worst to best, and the mail outcomes that do
# not count as received.
OUTCOMES = [
    "unsubscribed", "dismissed", "no-contact", "failed", "reached", "engaged", "lead", "converted",
]
MAIL_NOT_RECEIVED = [":no-contact", ":failed", ":reached"]

# Segment labels in order of priority, and the cluster that is falling.
SEGMENTS = [
    ("payday_lending_flag", "Payday"),
    ("nsf_flag", "NSF"),
    ("decreasing_balance_flag", "Decreasing Balance"),
]
SEGMENT_DEFAULT = "General"
DECREASING_CLUSTER = 0

DATE_COLUMNS = [
    "first_contact_date",
    "first_clicked_date",
    "first_banner_viewed_date",
    "last_result_date",
    "upload_date",
]


def eligible_base(
    direct_accounts: DataFrame,
    predictions: DataFrame,
    trans: DataFrame,
    clusters: DataFrame,
    loans: DataFrame,
    as_of: date | str,
    max_loans: int = 3,
    loan_days: int = 182,
    payday_days: int = 91,
    nsf_days: int = 31,
) -> DataFrame:
    """Scored open deposit accounts with three activity flags.

    ``direct_accounts`` are direct relationships with ``application_code`` and
    ``conformed_status``. Customers with ``max_loans`` or more loans boarded in the last
    ``loan_days`` are left out; ``loans`` has customer, account and ``boarding_date``.
    """
    scored = direct_accounts.where(
        F.col("application_code").isin("DD", "SV") & (F.col("conformed_status") == "OPEN")
    ).join(predictions.select("account_key", "prediction").distinct(), "account_key")
    payday = contains_any("description", PAYDAY_PHRASES, True) & ~contains_any(
        "description", PAYDAY_EXCLUSIONS, True
    )
    nsf = F.col("transaction_code") == NSF_CODE
    rules = {"payday_lending_flag": (payday, payday_days), "nsf_flag": (nsf, nsf_days)}
    flagged = recent_activity_flags(scored, trans, rules, as_of)
    flagged = recent_activity_flag(
        flagged, clusters, F.col("cluster") == DECREASING_CLUSTER, "decreasing_balance_flag"
    )
    recent = loans.where(F.col("boarding_date") >= F.date_sub(as_date(as_of), loan_days))
    heavy = (
        recent.groupBy("customer_key")
        .agg(F.count("account_key").alias("_loans"))
        .where(F.col("_loans") >= max_loans)
    )
    return flagged.join(heavy, "customer_key", "left_anti").select(
        "customer_key",
        "account_key",
        "prediction",
        "payday_lending_flag",
        "nsf_flag",
        "decreasing_balance_flag",
    )


def segment_customers(base: DataFrame) -> DataFrame:
    """One segment per customer and prediction: the first flag set on any account."""
    flags = [flag for flag, _ in SEGMENTS]
    grouped = base.groupBy("prediction", "customer_key").agg(
        *[F.max(flag).alias(flag) for flag in flags]
    )
    label = classify([(F.col(flag) == 1, name) for flag, name in SEGMENTS], SEGMENT_DEFAULT)
    return grouped.select("prediction", "customer_key", label.alias("cp_model_group"))


def assign_control(
    positives: DataFrame,
    master: DataFrame,
    as_of: date | str,
    fraction: float | dict[str, float] = 0.15,
    strata: str = "cp_model_group",
    seed: int = 42,
) -> DataFrame:
    """Master rows plus a label for every customer never labelled before.

    The split comes from the MD5 of the customer key, so it depends on neither
    partitioning nor row order, can be recomputed by any engine, and labels already
    given stay. ``fraction`` may differ per stratum; strata
    it does not name get no control group.
    """
    shares = fraction if isinstance(fraction, dict) else None
    if shares is None:
        limit = F.lit(int(round(fraction * 10000)))
    else:
        limit = classify(
            [(F.col(strata) == s, int(round(f * 10000))) for s, f in shares.items()], 0
        )
    digest = F.md5(F.concat_ws(":", F.col("customer_key").cast("string"), F.lit(str(seed))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10000
    new = positives.join(master.select("customer_key"), "customer_key", "left_anti")
    labelled = new.select(
        "customer_key",
        F.when(bucket < limit, "Control").otherwise("Experiment").alias("exp_control_label"),
        as_date(as_of).alias("date_added"),
    )
    return master.select("customer_key", "exp_control_label", "date_added").unionByName(labelled)


def daily_target_list(positives: DataFrame, master: DataFrame, as_of: date | str) -> DataFrame:
    """Positive customers outside the control group, with segment and date."""
    experiment = master.where(F.col("exp_control_label") == "Experiment").select("customer_key")
    return positives.join(experiment, "customer_key", "left_semi").select(
        "customer_key", "cp_model_group", as_date(as_of).alias("cp_model_date")
    )


def campaign_results_clean(
    raw: DataFrame,
    group_columns: Sequence[str],
    upload_columns: Sequence[str],
    date_columns: Sequence[str] = tuple(DATE_COLUMNS),
) -> DataFrame:
    """Campaign rows with one segment and one upload date, typed dates and counts."""
    merged = {
        "cp_model_group": first_non_blank(group_columns),
        "upload_date": first_non_blank(upload_columns),
        "banners_viewed": F.col("banners_viewed").try_cast("int"),
    }
    typed = raw.withColumns(merged).drop(*group_columns, *upload_columns)
    dates = [c for c in date_columns if c in typed.columns]
    return typed.withColumns({c: F.col(c).try_cast("date") for c in dates})


def first_touch(campaign: DataFrame) -> DataFrame:
    """First contact and first view (click, else banner view) per customer."""
    clicked = F.col("first_clicked_date")
    viewed = F.when(clicked >= F.lit("1901-01-01").cast("date"), clicked).otherwise(
        F.col("first_banner_viewed_date")
    )
    return campaign.groupBy("customer_key").agg(
        F.min("first_contact_date").alias("first_marketing_date"),
        F.min(viewed).alias("first_marketing_open"),
    )


def booked_after_flags(loans: DataFrame, touches: DataFrame) -> DataFrame:
    """Loans with Yes/No: booked on or after the first contact, and the first view."""
    booked = F.col("current_note_date")

    def after(column: str):
        return F.when(booked >= F.col(column), "Yes").otherwise("No")

    return loans.join(touches, "customer_key", "left").withColumns(
        {
            "loan_booked_after_first_marketing_date": after("first_marketing_date"),
            "loan_booked_after_first_marketing_open": after("first_marketing_open"),
        }
    )


def last_touch_attribution(campaign: DataFrame, flagged_loans: DataFrame) -> DataFrame:
    """Channel and segment of the last result on or before the booking day.

    Only loans booked on or after the first view; loans without such a result drop out.
    """
    loans = flagged_loans.where(F.col("loan_booked_after_first_marketing_open") == "Yes")
    results = campaign.select(
        "customer_key",
        "last_result_date",
        F.col("result_channel").alias("attribution_channel"),
        F.col("cp_model_group").alias("attribution_model_group"),
    )
    found = asof_join(
        loans.select("account_key", "customer_key", "current_note_date"),
        results,
        ["customer_key"],
        "current_note_date",
        "last_result_date",
        ["attribution_channel", "attribution_model_group"],
    )
    return found.where(F.col("last_result_date").isNotNull()).select(
        "account_key", "attribution_channel", "attribution_model_group"
    )


def channel_receipt(campaign: DataFrame) -> DataFrame:
    """Whether each customer received a banner and a mail, and which of both.

    A mail with no recorded result counts as received.
    """
    mailed = F.when(F.col("mail_result").isin(MAIL_NOT_RECEIVED), 0).otherwise(1)
    received = campaign.groupBy("customer_key").agg(
        F.sum("banners_viewed").alias("_banners"), F.max(mailed).alias("_mails")
    )
    yes_no = received.select(
        "customer_key",
        F.when(F.col("_banners") > 0, "yes").otherwise("no").alias("banner_received"),
        F.when(F.col("_mails") > 0, "yes").otherwise("no").alias("mail_received"),
    )
    banner, mail = F.col("banner_received") == "yes", F.col("mail_received") == "yes"
    kind = classify(
        [(banner & mail, "banner and mail"), (banner, "banner only"), (mail, "mail only")], "none"
    )
    return yes_no.withColumn("marketing_received", kind)


def best_worst_result(campaign: DataFrame, order: Sequence[str] = tuple(OUTCOMES)) -> DataFrame:
    """Best and worst outcome per customer; outcomes outside the order are ignored."""
    label = F.ltrim(F.regexp_replace("campaign_result", "^:", ""))
    rank = classify([(label == name, i) for i, name in enumerate(order)])
    ranked = campaign.groupBy("customer_key").agg(
        F.max(rank).alias("_best"), F.min(rank).alias("_worst")
    )
    names = F.array(*[F.lit(name) for name in order])
    return ranked.select(
        "customer_key",
        F.get(names, F.col("_best")).alias("campaign_result_best"),
        F.get(names, F.col("_worst")).alias("campaign_result_worst"),
    )


def campaign_results_assembled(campaign: DataFrame) -> DataFrame:
    """Every campaign row with its customer's first dates, receipt, best and worst outcome.

    The three summaries hold one row per customer and are laid out alike, so they meet
    where they are and the campaign rows are joined once.
    """
    key = "customer_key"
    summary = (
        first_touch(campaign)
        .join(channel_receipt(campaign), key)
        .join(best_worst_result(campaign), key)
    )
    return campaign.join(summary, key, "left")


def loan_performance(
    loans: DataFrame,
    attribution: DataFrame,
    tiebreak: Sequence[str] = ("customer_key",),
) -> DataFrame:
    """Newest row per loan with total interest paid and its attribution."""
    newest = latest_per_key(loans, ["account_key"], "snapshot_date", tiebreak)
    total = F.col("interest_paid_prev_ytd") + F.col("interest_paid_ytd")
    return newest.withColumn("interest_paid_total", total).join(attribution, "account_key", "left")
