"""Banking feeds derived from the driver tables, once for Spark and once as SQL.

Each method of :class:`Tables` has its SQL twin of the same name, with the prefix
``d_``, in :data:`SHAPES_SQL`.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions import classify
from tallybook.operators.picks import latest_per_key
from tallybook.operators.spines import processing_dates


def money(column: str):
    return F.col(column).cast("decimal(18,2)")


def month_snapshot(column: str):
    """Processing day standing for a month: the day before the calendar month-end."""
    return F.date_sub(F.last_day(column), 1)


def ownership_type(key: str):
    return F.when(F.col(key) == "1-A-P", "Indirect").otherwise("Direct").alias("ownership_type")


def code_columns(key):
    """Type, application and description of a status code."""
    flag = F.substring(key, 1, 1)
    texts = [(key == "AF", "OPEN"), (key == "AO", "DORMANT"), (key == "NF", ""),
             (key == "NO", "CLOSED")]
    return [
        key.alias("code_key"),
        classify([(flag == "A", "STAT"), (flag == "N", "SS")], "LNST").alias("code_type"),
        F.when(key == "RO", "SI").otherwise("DD").alias("application"),
        classify(texts).alias("code_description_2"),
    ]


class Tables:
    """Driver tables of one folder and the feeds made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def derived(self, name: str, build) -> DataFrame:
        """What ``build`` makes, made once for all steps of a query."""
        if name not in self._tables:
            self._tables[name] = build()
        return self._tables[name]

    # accounts and relationships -------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_key"),
            F.col("c_nationkey").alias("opening_branch"),
            F.col("c_mktsegment").alias("customer_type"),
            F.col("c_name").alias("short_name"),
        )

    @cached_property
    def xref(self) -> DataFrame:
        """One relationship per order, and a joint owner on medium-priority ones."""
        kind = F.pmod(F.col("o_orderkey"), F.lit(6))
        codes = ["DD", "SV", "CD", "LN", "SC", "ZZ"]
        primary = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Y").otherwise("N")
        owner = F.struct(
            F.col("o_custkey").alias("customer_key"),
            F.concat(F.lit("1-A-"), "o_orderstatus").alias("relationship_key"),
            primary.alias("primary_customer_flag"),
        )
        joint = F.struct(
            (F.col("o_custkey") + 1).alias("customer_key"),
            F.lit("1-A-JNT").alias("relationship_key"),
            F.lit("N").alias("primary_customer_flag"),
        )
        owners = F.array_compact(
            F.array(owner, F.when(F.col("o_orderpriority") == "3-MEDIUM", joint))
        )
        return self.raw("orders").select(
            F.col("o_orderkey").alias("account_key"),
            classify([(kind == i, c) for i, c in enumerate(codes)]).alias("application"),
            F.to_date("o_orderdate").alias("relationship_date"),
            month_snapshot("o_orderdate").alias("snapshot_date"),
            F.inline(owners),
        )

    @cached_property
    def ownership(self) -> DataFrame:
        return self.xref.select(
            "relationship_key", ownership_type("relationship_key")
        ).distinct()

    @cached_property
    def product_groups(self) -> DataFrame:
        code = F.col("application")
        group = classify([(code == "LN", "Lending"), (code == "SC", "Services")], "Deposit")
        return (
            self.xref.where(code != "ZZ")
            .select(code.alias("application_code"), group.alias("product_group"))
            .distinct()
        )

    @cached_property
    def codes(self) -> DataFrame:
        known = self.raw("lineitem").select("l_returnflag", "l_linestatus").distinct()
        return known.select(*code_columns(F.concat("l_returnflag", "l_linestatus")))

    @cached_property
    def daily_codes(self) -> DataFrame:
        """The codes as a feed with one extract per processing day."""
        # one entry per status code, few whatever the size of the feed
        codes = self.raw("lineitem").agg(F.collect_set(F.concat("l_returnflag", "l_linestatus")))
        keys = F.explode(F.sort_array(codes.scalar()))
        days = self.month_spine.select("snapshot_date", keys.alias("_key"))
        return days.select(*code_columns(F.col("_key")), "snapshot_date")

    @cached_property
    def last_lines(self) -> DataFrame:
        """Newest line per order: status, product, organisation and branch of an account."""
        newest = latest_per_key(
            self.raw("lineitem"),
            ["l_orderkey"],
            "l_shipdate",
            ["l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice", "l_quantity"],
        )
        return newest.select(
            F.col("l_orderkey").alias("account_key"),
            F.concat("l_returnflag", "l_linestatus").alias("status_key"),
            F.concat(F.lit("1-"), F.pmod("l_partkey", F.lit(60)), F.lit("-")).alias("product_key"),
            F.col("l_suppkey").alias("org_key"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        kind = F.pmod(F.col("o_orderkey"), F.lit(6))
        codes = ["DD", "SV", "CD", "LN", "SC", "ZZ"]
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("account_key"),
            F.to_date("o_orderdate").alias("date_opened"),
            money("o_totalprice").alias("opening_amount"),
            classify([(kind == i, c) for i, c in enumerate(codes)]).alias("application_code"),
            month_snapshot("o_orderdate").alias("snapshot_date"),
        )
        return orders.join(self.last_lines, "account_key", "left")

    @cached_property
    def orgs(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("org_key"),
            F.pmod("s_suppkey", F.lit(10)).cast("int").alias("branch_id"),
            F.col("s_nationkey").alias("utc_timestamp"),
        )

    @cached_property
    def product_lookup(self) -> DataFrame:
        """Sixty products: consumer or business, and their retail designation."""
        number = F.pmod("p_partkey", F.lit(60))
        business = F.when(number >= 30, "Business").otherwise("Consumer")
        designation = classify([(number < 25, "Product"), (number < 56, "Service")], "Other")
        group = classify([(number < 20, "Deposit"), (number < 40, "Lending")], "Services")
        return (
            self.raw("part")
            .select(
                F.concat(F.lit("1-"), number, F.lit("-")).alias("product_key"),
                business.alias("consumer_or_business_product"),
                designation.alias("retail_product_designation"),
                group.alias("product_group"),
            )
            .distinct()
        )

    # teller activity and branches --------------------------------------------------

    @cached_property
    def teller(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("account_key"),
            F.pmod("l_suppkey", F.lit(10)).cast("int").alias("branch_number"),
            F.to_date("l_shipdate").alias("transaction_date"),
        )

    @cached_property
    def direct(self) -> DataFrame:
        """Direct owners, one row per account and customer."""
        direct = self.ownership.where(F.col("ownership_type") == "Direct")
        return self.xref.join(direct, "relationship_key", "left_semi").select(
            "account_key", "customer_key", "primary_customer_flag"
        )

    @cached_property
    def accts(self) -> DataFrame:
        return self.accounts.where(F.col("org_key").isNotNull()).select(
            "account_key",
            "date_opened",
            F.pmod("org_key", F.lit(10)).cast("int").alias("branch_id"),
        )

    @cached_property
    def month_spine(self) -> DataFrame:
        """Processing days: one per month in which accounts were opened."""
        return processing_dates(
            self.raw("orders").select(month_snapshot("o_orderdate").alias("snapshot_date"))
        )

    @cached_property
    def branch_lookup(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").alias("branch_id"),
            F.col("n_name").alias("branch_description"),
            F.col("n_regionkey").alias("utc_timestamp"),
        )

    # daily presence ------------------------------------------------------------------

    @cached_property
    def presence(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").alias("customer_key"), F.to_date("ts").alias("snapshot_date")
        )

    @cached_property
    def masters(self) -> DataFrame:
        """Customer masters of the years before the daily feed."""
        return (
            self.raw("customer")
            .where(F.col("c_mktsegment") != "MACHINERY")
            .select(
                F.format_string("%08d", "c_custkey").alias("customer_key"),
                F.date_add(F.lit("2019-01-01").cast("date"), F.col("c_nationkey") * 10).alias(
                    "date_customer_added"
                ),
                F.lit("2020-12-31").cast("date").alias("snapshot_date"),
            )
        )

    # transactions ----------------------------------------------------------------------

    @cached_property
    def transactions(self) -> DataFrame:
        """Account transactions whose description follows the noun of the part name."""
        noun = F.element_at(F.split("p_name", " "), -1)
        lead = classify(
            [
                (F.col("p_name") == "old anvil", "SPEEDY CASH PAWN "),
                (noun == "anvil", "SPEEDY CASH "),
                (noun == "ring", "PURCH SQ "),
                (noun == "bolt", "PayPal "),
                (noun == "plate", "Venmo "),
                (noun == "rod", "INTUITIVE "),
                (noun == "gizmo", "Square Inc Cash App "),
                (noun == "gear", "stripe/ refund "),
                (noun == "widget", "ZELLE "),
            ],
            "POS ",
        )
        parts = self.raw("part").select(
            F.col("p_partkey").alias("l_partkey"), F.concat(lead, "p_name").alias("description")
        )
        return (
            self.raw("lineitem")
            .join(parts, "l_partkey")
            .select(
                F.col("l_orderkey").alias("account_key"),
                F.to_date("l_shipdate").alias("transaction_date"),
                (F.col("l_linenumber") * 10 + 1).alias("transaction_code"),
                money("l_extendedprice").alias("transaction_amount"),
                F.when(F.col("l_linestatus") == "O", "C").otherwise("D").alias("db_cr_flag"),
                "description",
                F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
                            F.col("l_quantity").cast("int")).alias("transaction_id"),
            )
        )

    # campaign and digital ----------------------------------------------------------------

    @cached_property
    def touches(self) -> DataFrame:
        """Campaign contacts: one per event of a customer."""
        kind = F.col("event_type")
        day = F.to_date("ts").cast("string")
        outcomes = {"click": ":engaged", "view": ":reached", "signup": ":lead",
                    "purchase": ":converted", "error": ":failed"}
        mails = {"error": ":failed", "click": ":opened", "signup": ":no-contact",
                 "view": ":reached"}
        return self.raw("events").select(
            F.col("user_id").alias("customer_key"),
            (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("visit_key"),
            classify([(kind == k, v) for k, v in outcomes.items()]).alias("campaign_result"),
            day.alias("first_contact_date"),
            F.when(kind == "click", day).otherwise("").alias("first_clicked_date"),
            F.when(kind == "view", day).alias("first_banner_viewed_date"),
            day.alias("last_result_date"),
            kind.alias("result_channel"),
            F.when(kind == "view", "1").otherwise("").alias("banners_viewed"),
            classify([(kind == k, v) for k, v in mails.items()]).alias("mail_result"),
            F.when(kind == "click", "General").otherwise("").alias("ads_group"),
            F.when(kind == "signup", "NSF").alias("email_group"),
            F.when(kind == "purchase", "Payday").otherwise("").alias("mail_group"),
            F.when(kind == "click", day).otherwise("").alias("ads_upload"),
            F.when(kind != "click", day).alias("email_upload"),
        )

    @cached_property
    def booked_loans(self) -> DataFrame:
        return (
            self.raw("events")
            .where(F.col("event_type") == "purchase")
            .select(
                F.col("event_id").alias("account_key"),
                F.col("user_id").alias("customer_key"),
                F.to_date("ts").alias("current_note_date"),
                money("value").alias("interest_paid_ytd"),
                (money("value") * 2).cast("decimal(18,2)").alias("interest_paid_prev_ytd"),
                F.to_date("ts").alias("snapshot_date"),
            )
        )

    @cached_property
    def digital(self) -> DataFrame:
        kind = F.col("event_type")
        types = {"view": "Login", "click": "PFM Login", "purchase": "Transfer",
                 "signup": "Remote Deposit Capture", "error": "Get RDC Configuration"}
        failed = (kind == "error") | ((kind == "signup") & (F.col("value") < 150))
        device, channel = F.pmod("event_id", F.lit(4)), F.pmod("event_id", F.lit(3))
        name = F.col("user_id").cast("string")
        return self.raw("events").select(
            F.col("user_id").alias("individual_id"),
            F.concat(F.lit("U"), name).alias("user_id"),
            F.concat(F.lit("First"), name).alias("first_name"),
            F.concat(F.lit("Last"), name).alias("last_name"),
            classify([(kind == k, v) for k, v in types.items()]).alias("transaction_type"),
            F.when(failed, "FAILURE").otherwise("SUCCESS").alias("result"),
            classify(
                [(device == 0, "PHONE"), (device == 1, "TABLET"), (device == 2, "DESKTOP")],
                "UNKNOWN",
            ).alias("device"),
            classify([(channel == 0, "Browser"), (channel == 1, "Mobile")], "App").alias("channel"),
            F.date_format("ts", "MM/dd/yyyy HH:mm:ss").alias("transaction_stamp"),
            F.to_date("ts").alias("transaction_date"),
            F.col("value").alias("amount"),
            F.col("event_id"),
        )


_APPLICATION = (
    "CASE o_orderkey % 6 WHEN 0 THEN 'DD' WHEN 1 THEN 'SV' WHEN 2 THEN 'CD' "
    "WHEN 3 THEN 'LN' WHEN 4 THEN 'SC' ELSE 'ZZ' END"
)
_MONEY = "CAST({} AS DECIMAL(18,2))"


def _month(column: str) -> str:
    return f"CAST(last_day(CAST({column} AS DATE)) - INTERVAL 1 DAY AS DATE)"


SHAPES_SQL: dict[str, str] = {
    "d_customers": """
SELECT c_custkey AS customer_key, c_nationkey AS opening_branch,
       c_mktsegment AS customer_type, c_name AS short_name
FROM customer""",
    "d_xref": f"""
SELECT o_orderkey AS account_key, {_APPLICATION} AS application,
       CAST(o_orderdate AS DATE) AS relationship_date, {_month('o_orderdate')} AS snapshot_date,
       o_custkey AS customer_key, '1-A-' || o_orderstatus AS relationship_key,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Y' ELSE 'N' END
         AS primary_customer_flag
FROM orders
UNION ALL
SELECT o_orderkey, {_APPLICATION}, CAST(o_orderdate AS DATE), {_month('o_orderdate')},
       o_custkey + 1, '1-A-JNT', 'N'
FROM orders WHERE o_orderpriority = '3-MEDIUM'""",
    "d_ownership": """
SELECT DISTINCT relationship_key,
       CASE WHEN relationship_key = '1-A-P' THEN 'Indirect' ELSE 'Direct' END AS ownership_type
FROM d_xref""",
    "d_product_groups": """
SELECT DISTINCT application AS application_code,
       CASE application WHEN 'LN' THEN 'Lending' WHEN 'SC' THEN 'Services' ELSE 'Deposit' END
         AS product_group
FROM d_xref WHERE application <> 'ZZ'""",
    "d_codes": """
SELECT DISTINCT l_returnflag || l_linestatus AS code_key,
       CASE l_returnflag WHEN 'A' THEN 'STAT' WHEN 'N' THEN 'SS' ELSE 'LNST' END AS code_type,
       CASE WHEN l_returnflag || l_linestatus = 'RO' THEN 'SI' ELSE 'DD' END AS application,
       CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'OPEN' WHEN 'AO' THEN 'DORMANT'
         WHEN 'NF' THEN '' WHEN 'NO' THEN 'CLOSED' END AS code_description_2
FROM lineitem""",
    "d_status": """
SELECT code_key AS status_key,
       CASE WHEN code_description_2 <> '' THEN code_description_2 ELSE 'OPEN' END
         AS conformed_status
FROM d_codes WHERE code_type IN ('STAT', 'SS', 'LNST', 'CLSD') AND application <> 'SI'""",
    "d_last_lines": """
SELECT l_orderkey AS account_key, l_returnflag || l_linestatus AS status_key,
       '1-' || CAST(l_partkey % 60 AS VARCHAR) || '-' AS product_key, l_suppkey AS org_key
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber,
  l_suppkey, l_partkey, l_extendedprice, l_quantity) = 1""",
    "d_accounts": f"""
SELECT o_orderkey AS account_key, CAST(o_orderdate AS DATE) AS date_opened,
       {_MONEY.format('o_totalprice')} AS opening_amount, {_APPLICATION} AS application_code,
       {_month('o_orderdate')} AS snapshot_date, status_key, product_key, org_key
FROM orders LEFT JOIN d_last_lines ON o_orderkey = account_key""",
    "d_conformed": """
SELECT a.*, coalesce(conformed_status, 'OPEN') AS conformed_status
FROM d_accounts a LEFT JOIN d_status USING (status_key)""",
    "d_base": """
SELECT x.account_key, product_group, conformed_status, customer_key, ownership_type,
       primary_customer_flag
FROM d_xref x LEFT JOIN d_product_groups ON application = application_code
LEFT JOIN d_ownership USING (relationship_key)
LEFT JOIN d_conformed c ON x.account_key = c.account_key""",
    "d_product_lookup": """
SELECT DISTINCT '1-' || CAST(p_partkey % 60 AS VARCHAR) || '-' AS product_key,
       CASE WHEN p_partkey % 60 >= 30 THEN 'Business' ELSE 'Consumer' END
         AS consumer_or_business_product,
       CASE WHEN p_partkey % 60 < 25 THEN 'Product' WHEN p_partkey % 60 < 56 THEN 'Service'
         ELSE 'Other' END AS retail_product_designation,
       CASE WHEN p_partkey % 60 < 20 THEN 'Deposit' WHEN p_partkey % 60 < 40 THEN 'Lending'
         ELSE 'Services' END AS product_group
FROM part""",
    "d_teller": """
SELECT l_orderkey AS account_key, CAST(l_suppkey % 10 AS INTEGER) AS branch_number,
       CAST(l_shipdate AS DATE) AS transaction_date
FROM lineitem""",
    "d_direct": """
SELECT account_key, customer_key, primary_customer_flag
FROM d_xref WHERE relationship_key <> '1-A-P'""",
    "d_accts": """
SELECT account_key, date_opened, CAST(org_key % 10 AS INTEGER) AS branch_id
FROM d_accounts WHERE org_key IS NOT NULL""",
    "d_month_spine": f"""
SELECT snapshot_date, CAST(row_number() OVER (ORDER BY snapshot_date) AS INTEGER) AS seq,
       lag(snapshot_date) OVER (ORDER BY snapshot_date) AS prior_date,
       lead(snapshot_date) OVER (ORDER BY snapshot_date) AS next_date
FROM (SELECT DISTINCT {_month('o_orderdate')} AS snapshot_date FROM orders)""",
    "d_presence": """
SELECT DISTINCT user_id AS customer_key, CAST(ts AS DATE) AS snapshot_date FROM events""",
    "d_day_spine": """
SELECT snapshot_date, CAST(row_number() OVER (ORDER BY snapshot_date) AS INTEGER) AS seq,
       lag(snapshot_date) OVER (ORDER BY snapshot_date) AS prior_date,
       lead(snapshot_date) OVER (ORDER BY snapshot_date) AS next_date
FROM (SELECT DISTINCT CAST(ts AS DATE) AS snapshot_date FROM events)""",
    "d_seed": """
SELECT c_custkey AS customer_key,
       CAST(DATE '2019-01-01' + CAST(c_nationkey * 10 AS INTEGER) AS DATE)
         AS original_acquisition_date
FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "d_changes": """
SELECT p.customer_key, s.snapshot_date AS processing_date, s.snapshot_date AS acquired_on,
       CAST(NULL AS DATE) AS lost_on
FROM d_presence p JOIN d_day_spine s USING (snapshot_date)
WHERE s.prior_date IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM d_presence q
  WHERE q.customer_key = p.customer_key AND q.snapshot_date = s.prior_date)
UNION ALL
SELECT p.customer_key, s.next_date, NULL, s.snapshot_date
FROM d_presence p JOIN d_day_spine s USING (snapshot_date)
WHERE s.next_date IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM d_presence q
  WHERE q.customer_key = p.customer_key AND q.snapshot_date = s.next_date)""",
    "d_known": """
SELECT customer_key, original_acquisition_date, TRUE AS seeded,
       DATE '1900-01-01' AS entry_date FROM d_seed
UNION ALL
SELECT customer_key, min(acquired_on), FALSE, min(acquired_on)
FROM d_changes WHERE customer_key NOT IN (SELECT customer_key FROM d_seed)
GROUP BY customer_key HAVING min(acquired_on) IS NOT NULL""",
    "d_ledger_history": """
SELECT k.customer_key, k.original_acquisition_date,
       max(c.acquired_on) AS most_recent_acquisition_date,
       max(CASE WHEN k.seeded OR c.processing_date > k.entry_date THEN c.lost_on END)
         AS most_recent_lost_date,
       s.snapshot_date
FROM d_known k
JOIN d_day_spine s ON s.seq > 1 AND s.snapshot_date >= k.entry_date
LEFT JOIN d_changes c
  ON c.customer_key = k.customer_key AND c.processing_date <= s.snapshot_date
GROUP BY k.customer_key, k.original_acquisition_date, s.snapshot_date""",
    "d_transactions": f"""
SELECT l_orderkey AS account_key, CAST(l_shipdate AS DATE) AS transaction_date,
       l_linenumber * 10 + 1 AS transaction_code,
       {_MONEY.format('l_extendedprice')} AS transaction_amount,
       CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'D' END AS db_cr_flag,
       CASE WHEN p_name = 'old anvil' THEN 'SPEEDY CASH PAWN '
         WHEN p_name LIKE '% anvil' THEN 'SPEEDY CASH '
         WHEN p_name LIKE '% ring' THEN 'PURCH SQ '
         WHEN p_name LIKE '% bolt' THEN 'PayPal '
         WHEN p_name LIKE '% plate' THEN 'Venmo '
         WHEN p_name LIKE '% rod' THEN 'INTUITIVE '
         WHEN p_name LIKE '% gizmo' THEN 'Square Inc Cash App '
         WHEN p_name LIKE '% gear' THEN 'stripe/ refund '
         WHEN p_name LIKE '% widget' THEN 'ZELLE '
         ELSE 'POS ' END || p_name AS description,
       concat_ws('-', l_orderkey, l_linenumber, l_suppkey, l_partkey,
         CAST(l_quantity AS INTEGER)) AS transaction_id
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "d_touches": """
SELECT user_id AS customer_key, user_id * 100 + day(ts) AS visit_key,
       CASE event_type WHEN 'click' THEN ':engaged' WHEN 'view' THEN ':reached'
         WHEN 'signup' THEN ':lead' WHEN 'purchase' THEN ':converted'
         WHEN 'error' THEN ':failed' END AS campaign_result,
       CAST(ts AS DATE) AS contact_day,
       CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) END AS clicked_day,
       CASE WHEN event_type = 'view' THEN CAST(ts AS DATE) END AS banner_day,
       event_type AS result_channel,
       CASE WHEN event_type = 'view' THEN 1 END AS banners_viewed,
       CASE event_type WHEN 'error' THEN ':failed' WHEN 'click' THEN ':opened'
         WHEN 'signup' THEN ':no-contact' WHEN 'view' THEN ':reached' END AS mail_result,
       CASE event_type WHEN 'click' THEN 'General' WHEN 'signup' THEN 'NSF'
         WHEN 'purchase' THEN 'Payday' ELSE 'ERROR' END AS cp_model_group
FROM events""",
    "d_first_touch": """
SELECT customer_key, min(contact_day) AS first_marketing_date,
       min(coalesce(clicked_day, banner_day)) AS first_marketing_open
FROM d_touches GROUP BY customer_key""",
    "d_booked_loans": f"""
SELECT event_id AS account_key, user_id AS customer_key, CAST(ts AS DATE) AS current_note_date,
       {_MONEY.format('value')} AS interest_paid_ytd,
       CAST({_MONEY.format('value')} * 2 AS DECIMAL(18,2)) AS interest_paid_prev_ytd
FROM events WHERE event_type = 'purchase'""",
    "d_digital": """
SELECT user_id AS individual_id, 'U' || CAST(user_id AS VARCHAR) AS user_id,
       'First' || CAST(user_id AS VARCHAR) AS first_name,
       'Last' || CAST(user_id AS VARCHAR) AS last_name,
       CASE event_type WHEN 'view' THEN 'Login' WHEN 'click' THEN 'PFM Login'
         WHEN 'purchase' THEN 'Transfer' WHEN 'signup' THEN 'Remote Deposit Capture'
         WHEN 'error' THEN 'Get RDC Configuration' END AS transaction_type,
       CASE WHEN event_type = 'error' OR (event_type = 'signup' AND value < 150)
         THEN 'FAILURE' ELSE 'SUCCESS' END AS result,
       CASE event_id % 4 WHEN 0 THEN 'PHONE' WHEN 1 THEN 'TABLET' WHEN 2 THEN 'DESKTOP'
         ELSE 'UNKNOWN' END AS device,
       CASE event_id % 3 WHEN 0 THEN 'Browser' WHEN 1 THEN 'Mobile' ELSE 'App' END AS channel,
       strftime(ts, '%m/%d/%Y %H:%M:%S') AS transaction_stamp,
       CAST(ts AS DATE) AS transaction_date, value AS amount, event_id
FROM events""",
}
