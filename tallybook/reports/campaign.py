"""Campaign targeting and attribution."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.plans import campaign
from tallybook.reports.accounts import base
from tallybook.reports.report import Report
from tallybook.reports.shapes import Tables

AS_OF = "1999-06-30"


def eligible(t: Tables):
    applications = t.accounts.select("account_key", "application_code")
    direct = (
        base(t).where(F.col("ownership_type") == "Direct").join(applications, "account_key")
    )
    predictions = t.accounts.select(
        "account_key",
        F.when(F.col("opening_amount") > 200000, "1").otherwise("0").alias("prediction"),
    )
    clusters = t.accounts.select(
        "account_key", F.pmod("org_key", F.lit(4)).alias("cluster")
    )
    loans = t.direct.join(
        t.accounts.where(F.col("application_code") == "LN").select(
            "account_key", F.col("date_opened").alias("boarding_date")
        ),
        "account_key",
    )
    return campaign.eligible_base(
        direct, predictions, t.transactions, clusters, loans, AS_OF,
        max_loans=2, loan_days=1500, payday_days=1500, nsf_days=600,
    )


def segments(t: Tables):
    return campaign.segment_customers(eligible(t))


def _positives(t: Tables):
    return segments(t).where(F.col("prediction") == "1").drop("prediction")


def _master(t: Tables):
    """Labels given earlier: by account balance, for customers of three segments."""
    return t.raw("customer").where(
        F.col("c_mktsegment").isin("BUILDING", "FURNITURE", "MACHINERY")
    ).select(
        F.col("c_custkey").alias("customer_key"),
        F.when(F.col("c_acctbal") < 0, "Control").otherwise("Experiment").alias(
            "exp_control_label"
        ),
        F.lit("1999-01-31").cast("date").alias("date_added"),
    )


def control(t: Tables):
    return campaign.assign_control(_positives(t), _master(t), AS_OF)


def targets(t: Tables):
    return campaign.daily_target_list(_positives(t), _master(t), AS_OF)


def clean(t: Tables):
    return campaign.campaign_results_clean(
        t.touches, ["ads_group", "email_group", "mail_group"], ["ads_upload", "email_upload"]
    )


def booked(t: Tables):
    return campaign.booked_after_flags(t.booked_loans, campaign.first_touch(clean(t)))


def attribution(t: Tables):
    return campaign.last_touch_attribution(clean(t), booked(t))


def _by_visit(t: Tables):
    return clean(t).drop("customer_key").withColumnRenamed("visit_key", "customer_key")


def performance(t: Tables):
    loans = t.booked_loans.drop("current_note_date")
    return campaign.loan_performance(loans, attribution(t)).drop("snapshot_date")


_ELIGIBLE_SQL = f"""
SELECT b.customer_key, b.account_key,
       CASE WHEN opening_amount > 200000 THEN '1' ELSE '0' END AS prediction,
       CASE WHEN b.account_key IN (
         SELECT account_key FROM d_transactions
         WHERE description LIKE '%SPEEDY CASH%' AND description NOT LIKE '%SPEEDY CASH PAWN%'
           AND transaction_date BETWEEN DATE '{AS_OF}' - 1500 AND DATE '{AS_OF}')
         THEN 1 ELSE 0 END AS payday_lending_flag,
       CASE WHEN b.account_key IN (
         SELECT account_key FROM d_transactions WHERE transaction_code = 71
           AND transaction_date BETWEEN DATE '{AS_OF}' - 600 AND DATE '{AS_OF}')
         THEN 1 ELSE 0 END AS nsf_flag,
       CASE WHEN org_key % 4 = 0 THEN 1 ELSE 0 END AS decreasing_balance_flag
FROM d_base b JOIN d_accounts a ON a.account_key = b.account_key
WHERE ownership_type = 'Direct' AND application_code IN ('DD', 'SV')
  AND conformed_status = 'OPEN' AND b.customer_key NOT IN (
    SELECT customer_key FROM d_direct JOIN d_accounts l USING (account_key)
    WHERE application_code = 'LN' AND date_opened >= DATE '{AS_OF}' - 1500
    GROUP BY 1 HAVING count(*) >= 2)"""

_SEGMENT_SQL = f"""
SELECT prediction, customer_key,
       CASE WHEN max(payday_lending_flag) = 1 THEN 'Payday' WHEN max(nsf_flag) = 1 THEN 'NSF'
         WHEN max(decreasing_balance_flag) = 1 THEN 'Decreasing Balance' ELSE 'General' END
         AS cp_model_group
FROM ({_ELIGIBLE_SQL}) GROUP BY 1, 2"""

_ATTRIBUTION_SQL = """
SELECT account_key, result_channel AS attribution_channel,
       cp_model_group AS attribution_model_group
FROM d_booked_loans l JOIN d_first_touch f ON f.customer_key = l.customer_key
JOIN d_touches t ON t.customer_key = l.customer_key AND t.contact_day <= l.current_note_date
WHERE l.current_note_date >= f.first_marketing_open
QUALIFY row_number() OVER (PARTITION BY account_key
  ORDER BY contact_day DESC, result_channel, cp_model_group) = 1"""

_RANK = """CASE campaign_result WHEN ':failed' THEN 3 WHEN ':reached' THEN 4
 WHEN ':engaged' THEN 5 WHEN ':lead' THEN 6 WHEN ':converted' THEN 7 END"""
_NAMES = "['unsubscribed','dismissed','no-contact','failed','reached','engaged','lead','converted']"

_CLEAN_SQL = """
SELECT customer_key, visit_key, contact_day AS first_contact_date,
       clicked_day AS first_clicked_date, banner_day AS first_banner_viewed_date,
       contact_day AS last_result_date, result_channel, banners_viewed, cp_model_group,
       contact_day AS upload_date, mail_result, campaign_result
FROM d_touches"""
_CLEAN_DATES = (
    "first_contact_date", "first_clicked_date", "first_banner_viewed_date", "last_result_date",
    "upload_date",
)

REPORTS = [
    Report("eligible_base", eligible, _ELIGIBLE_SQL),
    Report("segment_customers", segments, _SEGMENT_SQL),
    Report("assign_control", control, f"""
WITH m AS (
  SELECT c_custkey AS customer_key,
         CASE WHEN c_acctbal < 0 THEN 'Control' ELSE 'Experiment' END AS exp_control_label,
         DATE '1999-01-31' AS date_added
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY'))
SELECT * FROM m
UNION ALL
SELECT customer_key,
       CASE WHEN CAST('0x' || substr(md5(CAST(customer_key AS VARCHAR) || ':42'), 1, 8) AS BIGINT)
         % 10000 < 1500 THEN 'Control' ELSE 'Experiment' END, DATE '{AS_OF}'
FROM ({_SEGMENT_SQL}) WHERE prediction = '1'
  AND customer_key NOT IN (SELECT customer_key FROM m)""", dates=("date_added",)),
    Report("daily_targets", targets, f"""
SELECT customer_key, cp_model_group, DATE '{AS_OF}' AS cp_model_date
FROM ({_SEGMENT_SQL}) WHERE prediction = '1' AND customer_key IN (
  SELECT c_custkey FROM customer WHERE c_acctbal >= 0
    AND c_mktsegment IN ('BUILDING', 'FURNITURE', 'MACHINERY'))""", dates=("cp_model_date",)),
    Report("campaign_clean", clean, _CLEAN_SQL, dates=_CLEAN_DATES),
    Report("campaign_assembled",
           lambda t: campaign.campaign_results_assembled(clean(t)), f"""
WITH r AS (
  SELECT customer_key,
         CASE WHEN coalesce(sum(banners_viewed), 0) > 0 THEN 'yes' ELSE 'no' END
           AS banner_received,
         CASE WHEN bool_or(mail_result IS NULL
           OR mail_result NOT IN (':no-contact', ':failed', ':reached')) THEN 'yes' ELSE 'no' END
           AS mail_received,
         {_NAMES}[CAST(max({_RANK}) + 1 AS INTEGER)] AS campaign_result_best,
         {_NAMES}[CAST(min({_RANK}) + 1 AS INTEGER)] AS campaign_result_worst
  FROM d_touches GROUP BY 1)
SELECT c.*, f.* EXCLUDE (customer_key), r.* EXCLUDE (customer_key),
       CASE banner_received || mail_received WHEN 'yesyes' THEN 'banner and mail'
         WHEN 'yesno' THEN 'banner only' WHEN 'noyes' THEN 'mail only' ELSE 'none' END
         AS marketing_received
FROM ({_CLEAN_SQL}) c JOIN d_first_touch f USING (customer_key) JOIN r USING (customer_key)""",
           dates=(*_CLEAN_DATES, "first_marketing_date", "first_marketing_open")),
    Report("first_touch", lambda t: campaign.first_touch(clean(t)), "SELECT * FROM d_first_touch",
           dates=("first_marketing_date", "first_marketing_open")),
    Report("booked_after", booked, """
SELECT l.*, current_note_date AS snapshot_date, first_marketing_date, first_marketing_open,
       CASE WHEN current_note_date >= first_marketing_date THEN 'Yes' ELSE 'No' END
         AS loan_booked_after_first_marketing_date,
       CASE WHEN current_note_date >= first_marketing_open THEN 'Yes' ELSE 'No' END
         AS loan_booked_after_first_marketing_open
FROM d_booked_loans l LEFT JOIN d_first_touch USING (customer_key)""",
           dates=("current_note_date", "snapshot_date", "first_marketing_date",
                  "first_marketing_open"),
           money=("interest_paid_ytd", "interest_paid_prev_ytd")),
    Report("last_touch", attribution, _ATTRIBUTION_SQL),
    Report("channel_receipt", lambda t: campaign.channel_receipt(_by_visit(t)), """
WITH r AS (
  SELECT visit_key AS customer_key,
         CASE WHEN coalesce(sum(banners_viewed), 0) > 0 THEN 'yes' ELSE 'no' END
           AS banner_received,
         CASE WHEN bool_or(mail_result IS NULL
           OR mail_result NOT IN (':no-contact', ':failed', ':reached')) THEN 'yes' ELSE 'no' END
           AS mail_received
  FROM d_touches GROUP BY 1)
SELECT *, CASE banner_received || mail_received WHEN 'yesyes' THEN 'banner and mail'
  WHEN 'yesno' THEN 'banner only' WHEN 'noyes' THEN 'mail only' ELSE 'none' END
  AS marketing_received FROM r"""),
    Report("best_worst", lambda t: campaign.best_worst_result(_by_visit(t)), f"""
SELECT visit_key AS customer_key,
       {_NAMES}[CAST(max({_RANK}) + 1 AS INTEGER)] AS campaign_result_best,
       {_NAMES}[CAST(min({_RANK}) + 1 AS INTEGER)] AS campaign_result_worst
FROM d_touches GROUP BY 1"""),
    Report("loan_performance", performance, f"""
SELECT account_key, customer_key, interest_paid_ytd, interest_paid_prev_ytd,
       interest_paid_ytd + interest_paid_prev_ytd AS interest_paid_total,
       attribution_channel, attribution_model_group
FROM d_booked_loans LEFT JOIN ({_ATTRIBUTION_SQL}) USING (account_key)""",
           money=("interest_paid_ytd", "interest_paid_prev_ytd", "interest_paid_total")),
]
