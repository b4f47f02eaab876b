"""The given test tables in the shape of the credit tables.

Each shape is one SELECT used as it stands by Spark and by the SQL checks; only the day count is
spelt differently by the two engines. Days count from 2001-12-31, so they are negative.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_EPOCH = "DATE '2001-12-31'"
_UNPAID = "l_discount >= 0.095 AND l_tax >= 0.075"
_LINES = "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"

SHAPES: dict[str, str] = {
    "instalments": f"""
        SELECT o_custkey AS customer_id,
               o_custkey * 2 + l_partkey % 2 AS credit_id,
               CAST(1 AS DOUBLE) AS version,
               l_linenumber AS number,
               [D:l_shipdate] AS due_day,
               CASE WHEN {_UNPAID} THEN NULL
                    WHEN l_returnflag = 'R' THEN [D:l_shipdate] + CAST(l_quantity AS INT)
                    WHEN l_returnflag = 'A' THEN [D:l_shipdate] + CAST(l_quantity AS INT) % 16
                    ELSE [D:l_shipdate] - CAST(l_quantity AS INT) % 8 END AS pay_day,
               l_extendedprice AS instalment,
               CASE WHEN {_UNPAID} THEN l_extendedprice * 0
                    WHEN l_discount >= 0.065 THEN l_extendedprice * (1 - 8 * l_discount)
                    ELSE l_extendedprice * (1 + l_tax / 2) END AS payment
        FROM {_LINES}""",
    "application": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS TARGET,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
               c_acctbal AS AMT_INCOME_TOTAL,
               c_acctbal * 4 AS AMT_CREDIT,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal / 8 END AS AMT_ANNUITY,
               c_acctbal * 2 AS AMT_GOODS_PRICE,
               c_mktsegment AS NAME_INCOME_TYPE,
               CASE c_custkey % 3 WHEN 0 THEN 'Secondary' WHEN 1 THEN 'Higher' ELSE 'Other' END AS NAME_EDUCATION_TYPE,
               CASE c_custkey % 5 WHEN 0 THEN 'Single' WHEN 1 THEN 'Widow' ELSE 'Married' END AS NAME_FAMILY_STATUS,
               CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'Rented' ELSE 'House' END AS NAME_HOUSING_TYPE,
               n_regionkey AS REGION_RATING_CLIENT,
               n_nationkey % 3 AS REGION_RATING_CLIENT_W_CITY,
               CAST(-7300 - (c_custkey % 13) * 1000 AS INT) AS DAYS_BIRTH,
               CAST(-(c_custkey % 17) * 100 AS INT) AS DAYS_EMPLOYED,
               CAST(-(c_custkey % 19) * 50 AS DOUBLE) AS DAYS_REGISTRATION,
               CAST(-(c_custkey % 23) * 30 AS INT) AS DAYS_ID_PUBLISH,
               CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 29 AS DOUBLE) END AS OWN_CAR_AGE,
               CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 97 AS DOUBLE) / 128 END AS EXT_SOURCE_1,
               CAST(c_custkey % 101 AS DOUBLE) / 128 AS EXT_SOURCE_2,
               CAST(NULL AS DOUBLE) AS EXT_SOURCE_3,
               CAST(c_custkey % 4 AS INT) AS CNT_CHILDREN,
               CAST(c_custkey % 5 + 1 AS DOUBLE) AS CNT_FAM_MEMBERS,
               n_name AS ORGANIZATION_TYPE
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    "previous": """
        SELECT o_custkey * 2 + o_orderkey % 2 AS credit_id,
               o_custkey AS customer_id,
               MIN(o_orderpriority) AS NAME_CONTRACT_TYPE,
               MAX(o_totalprice) / 16 AS AMT_ANNUITY,
               MIN(o_totalprice) AS AMT_APPLICATION,
               MAX(o_totalprice) AS AMT_CREDIT,
               CASE WHEN COUNT(*) > 3 THEN MIN(o_totalprice) / 8 END AS AMT_DOWN_PAYMENT,
               MAX(o_totalprice) / 2 AS AMT_GOODS_PRICE,
               MIN(o_orderstatus) AS NAME_CONTRACT_STATUS,
               MIN([D:o_orderdate]) AS DAYS_DECISION,
               CAST(COUNT(*) AS DOUBLE) AS CNT_PAYMENT,
               MAX(o_orderpriority) AS NAME_PORTFOLIO,
               MAX(o_orderstatus) AS NAME_PRODUCT_TYPE,
               CASE WHEN COUNT(*) % 2 = 0 THEN 'Branch' ELSE 'Online' END AS CHANNEL_TYPE,
               CAST(COUNT(*) % 7 AS INT) AS SELLERPLACE_AREA,
               CASE WHEN MAX(o_totalprice) > 400000 THEN 'high' WHEN MAX(o_totalprice) > 200000 THEN 'middle' END
                   AS NAME_YIELD_GROUP,
               CASE WHEN MIN(o_orderstatus) = MAX(o_orderstatus) THEN 'single' ELSE 'mixed' END AS PRODUCT_COMBINATION
        FROM {orders} GROUP BY o_custkey, o_orderkey % 2""",
    "bureau": """
        SELECT o_custkey AS customer_id,
               o_orderkey AS bureau_id,
               CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END AS CREDIT_ACTIVE,
               [D:o_orderdate] AS DAYS_CREDIT,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey % 40 ELSE 0 END AS INT) AS CREDIT_DAY_OVERDUE,
               CAST([D:o_orderdate] + 365 AS DOUBLE) AS DAYS_CREDIT_ENDDATE,
               CASE WHEN o_orderstatus = 'F' THEN CAST([D:o_orderdate] + 300 AS DOUBLE) END AS DAYS_ENDDATE_FACT,
               CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 64 END AS AMT_CREDIT_MAX_OVERDUE,
               CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice * 0 ELSE o_totalprice END AS AMT_CREDIT_SUM,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 4 END AS AMT_CREDIT_SUM_DEBT,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN o_totalprice / 32
                    ELSE o_totalprice * 0 END AS AMT_CREDIT_SUM_OVERDUE,
               o_totalprice / 2 AS AMT_CREDIT_SUM_LIMIT,
               o_orderpriority AS CREDIT_TYPE
        FROM {orders}""",
    "bureau_balance": """
        SELECT l_orderkey AS bureau_id,
               -l_linenumber AS MONTHS_BALANCE,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'C' WHEN l_returnflag = 'N' THEN 'X'
                    ELSE CAST(CAST(l_quantity AS INT) % 6 AS VARCHAR(1)) END AS STATUS
        FROM {lineitem}""",
    "pos_cash": """
        SELECT user_id * 2 + event_id % 2 AS credit_id,
               user_id AS customer_id,
               CAST(-(event_id % 24) AS INT) AS MONTHS_BALANCE,
               CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 12 AS DOUBLE) END AS CNT_INSTALMENT,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 6 AS DOUBLE) END AS CNT_INSTALMENT_FUTURE,
               CASE event_type WHEN 'purchase' THEN 'Active' WHEN 'signup' THEN 'Signed' ELSE 'Completed' END
                   AS NAME_CONTRACT_STATUS,
               CAST(FLOOR(value / 50) AS INT) AS SK_DPD,
               CAST(FLOOR(value / 100) AS INT) AS SK_DPD_DEF
        FROM {events}""",
    "credit_card": f"""
        SELECT o_custkey * 2 + l_partkey % 2 AS credit_id,
               o_custkey AS customer_id,
               -l_linenumber AS MONTHS_BALANCE,
               l_extendedprice AS AMT_BALANCE,
               l_tax * 1000000 AS AMT_CREDIT_LIMIT_ACTUAL,
               l_quantity * 100 AS AMT_DRAWINGS_CURRENT,
               l_extendedprice / 16 AS AMT_INST_MIN_REGULARITY,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice * l_discount END AS AMT_PAYMENT_CURRENT,
               l_extendedprice * l_discount AS AMT_PAYMENT_TOTAL_CURRENT,
               l_extendedprice / 2 AS AMT_RECEIVABLE_PRINCIPAL,
               l_extendedprice AS AMT_RECIVABLE,
               l_extendedprice AS AMT_TOTAL_RECEIVABLE,
               l_quantity AS CNT_DRAWINGS_CURRENT,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) % 10 ELSE 0 END AS SK_DPD,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN CAST(l_quantity AS INT) % 5 ELSE 0 END
                   AS SK_DPD_DEF,
               CASE WHEN l_linestatus = 'O' THEN 'Active' ELSE 'Completed' END AS NAME_CONTRACT_STATUS
        FROM {_LINES}""",
}
_INPUTS = ("lineitem", "orders", "customer", "nation", "events")


def _days(sql: str, template: str) -> str:
    head, *rest = sql.split("[D:")
    for part in rest:
        column, tail = part.split("]", 1)
        head += template.format(column) + tail
    return head


def credit_table(spark: SparkSession, folder: str, shape: str) -> DataFrame:
    sql = _days(SHAPES[shape], "datediff({}, " + _EPOCH + ")")
    inputs = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in _INPUTS if "{" + t + "}" in sql}
    return spark.sql(sql, **inputs)


def credit_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {s: credit_table(spark, folder, s) for s in SHAPES}


def check_sql(shape: str) -> str:
    """The same SELECT for the checking engine."""
    sql = _days(SHAPES[shape], "CAST(date_diff('day', " + _EPOCH + ", CAST({} AS DATE)) AS INT)")
    return sql.format(**{t: t for t in _INPUTS})
