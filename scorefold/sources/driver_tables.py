"""The driver's tables in the shape of a campaign's inputs.

No credit data is shipped, so every customer becomes one applicant whose bureau
attributes are computed from the customer key.  Each attribute takes NULL, the
codes -1 ... -6 and ordinary values.  The expressions are SQL text that Spark
and the checking engine read alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorefold.functions import rules

STATE_CODES = "WY NH PA TN IL AL CA NM NY CO MA TX FL OH GA AZ AK MI WA VA KS DC NV MN IA".split()


SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders":
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem":
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the schema is given, so no job reads file footers first."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bureau_sql(offset: int, base: str) -> str:
    shifted = f"(c_custkey + {offset}) % 17"
    return (
        f"CASE WHEN {shifted} = 0 THEN NULL WHEN {shifted} <= 6 THEN CAST(-({shifted}) AS DOUBLE) "
        f"ELSE CAST({base} AS DOUBLE) END"
    )


def tag_sql(period: int) -> str:
    return f"CASE WHEN c_custkey % {period} >= {period // 2} THEN 'Y' ELSE 'N' END"


def state_sql(column: str = "n_nationkey") -> str:
    whens = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATE_CODES))
    return f"CASE {column} {whens} END"


def zip_sql(column: str = "c_nationkey") -> str:
    return f"lpad(CAST({column} AS STRING), 5, '0')"


_NAMED_BUREAU = {
    "V71_REAP01": (0, "c_custkey % 900"),
    "V71_INAP01": (5, "(c_custkey * 3) % 1500"),
    "V71_HIAP01": (9, "c_custkey % 400"),
    "V71_MT101S": (2, "(c_custkey * 991) % 400000"),
    "V71_MT21S": (3, "c_custkey % 120"),
    "W49_ATTR06": (1, "c_custkey % 300"),
    "W49_ATTR10": (4, "c_custkey % 360"),
    "W49_AUP1003": (7, "c_custkey % 700"),
    "W55_PAYMNT08": (6, "c_custkey % 40"),
    "epay01attr25": (8, "(c_custkey * 17) % 30000"),
    "epay01attr19": (10, "(c_custkey * 13) % 20000"),
    "epay01attr24": (11, "c_custkey % 2500"),
    "epay01attr26": (12, "c_custkey % 700"),
    "V71_BC03S": (13, "c_custkey % 9"),
    "V71_BC25S": (14, "c_custkey % 5"),
    "W55_TRV01": (15, "c_custkey % 20"),
    "W55_TRV02": (16, "c_custkey % 20"),
    "W49_ATTR07": (3, "(c_custkey * 7) % 4000"),
    "W49_ATTR08": (11, "(c_custkey * 5) % 160"),
    "V71_RE101S": (6, "(c_custkey * 29) % 9000"),
    "V71_ST02S": (2, "c_custkey % 3"),
}
_OTHER_BUREAU = sorted(
    (
        {name for name, _, _ in rules.POLICY_IMPUTATION}
        | {name for name, _ in rules.FUNDING_PROCESSED}
        | {"_".join(n.split("_")[:2]) for n in rules.CREDIT_MODEL_LONG_NAMES}
        | set(rules.CREDIT_MODEL_999)
        | {name for name, _ in rules.RENT_COEFFICIENTS + rules.MORTGAGE_COEFFICIENTS}
        | set(rules.TARGET_ENCODED + rules.ONE_HOT_COLUMNS)
        | set(
            "epay01attr20 epay01attr21 epay01attr22 epay01attr23 V71_IN101S V71_HR101S V71_AU101S "
            "V71_ST101S V71_US101S V71_BC101S V71_AT03S V71_G069S V71_G095S N05_G082 V71_MT09S "
            "V71_BR01S V71_G200S V71_ST05S W55_WALSRVS1 GGENERC_gna001 W49_AUC1002".split()
        )
    )
    - set(_NAMED_BUREAU)
)
# Further inputs of the income model; at the end, so that the others keep their values.
_OTHER_BUREAU += sorted(
    {c for c in rules.INCOME_V4_FEATURES if c.startswith(("V71_", "W55_", "W49_")) and c not in rules.ONE_HOT_REQUIRED}
    - set(_OTHER_BUREAU) - set(_NAMED_BUREAU)
)
_MODULI = (40, 300, 5000, 12, 120, 700, 9)


def _bureau() -> dict[str, str]:
    columns = {name: bureau_sql(*args) for name, args in _NAMED_BUREAU.items()}
    for i, name in enumerate(_OTHER_BUREAU):
        base = f"(c_custkey * {2 * i + 3}) % {_MODULI[i % len(_MODULI)]}"
        columns[name] = bureau_sql(i % 17, base)
    return columns


APPLICANT_SQL: dict[str, str] = {
    "PPPCL_CONSUMER_ID": "CAST(c_custkey AS STRING)",
    "NCOA_ADDR_State": state_sql(),
    "NCOA_ADDR_ZipCode": zip_sql(),
    "PIE_Income_Estimation": "CAST(15000 + (c_custkey * 53) % 300000 AS DOUBLE)",
    "lastreportedincome":
        "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(20000 + (c_custkey * 37) % 480000 AS DOUBLE) END",
    "lastreportedhousingpayment":
        "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(300 + (c_custkey * 11) % 2500 AS STRING) END",
    "MedianRental": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(600 + (c_custkey * 7) % 1800 AS DOUBLE) END",
    "MeanIncome": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST((c_custkey * 4099) % 700000 AS DOUBLE) END",
    "LAE_Loan_Amount_Estimation":
        "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST((c_custkey * 101) % 35000 AS DOUBLE) END",
    "RECENT_TAG": "CASE WHEN c_custkey % 10 < 7 THEN 'Y' ELSE 'N' END",
    "PREVIOUS_COUNTER": "CAST(c_custkey % 6 AS INT)",
    "email_only": "CAST(c_custkey % 2 AS INT)",
    "sendableemail": "CAST(c_custkey % 3 AS INT)",
    "ehpm01_nopdfor": "CAST(c_custkey % 5 AS INT)",
    "ehpm01_nopmod": "CAST(c_custkey % 7 AS INT)",
    "ehpm01_nocpgt45": "CAST(c_custkey % 4 AS INT)",
    "N05_S0Y2":
        "CASE WHEN c_custkey % 9 = 0 THEN NULL "
        "ELSE CAST((1940 + c_custkey % 60) * 100 + 1 + c_custkey % 12 AS STRING) END",
    "creditAsOfDate": "20011231",
    "last_applied_date": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_last AS DATE) AS STRING) END",
    "last_partner_applied_date":
        "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(CAST(o_first AS DATE) AS STRING) END",
    **{f"previous6Tag{i}": tag_sql(2 ** i) for i in range(1, 6)},
    **_bureau(),
}
_FROM_ORDERS = {"last_applied_date", "last_partner_applied_date"}


def applicants(spark: SparkSession, sf_dir: str, columns: Sequence[str]) -> DataFrame:
    """Applicants with the given columns; only the tables these need are read."""
    people = table(spark, sf_dir, "customer")
    if any("n_nationkey" in APPLICANT_SQL[c] for c in columns):
        nation = table(spark, sf_dir, "nation").select("n_nationkey")
        people = people.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    if _FROM_ORDERS & set(columns):
        dates = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
            F.max("o_orderdate").alias("o_last"), F.min("o_orderdate").alias("o_first")
        )
        people = people.join(dates, F.col("o_custkey") == F.col("c_custkey"), "left")
    return people.selectExpr(*[f"{APPLICANT_SQL[c]} AS `{c}`" for c in columns])


def applicants_sql(columns: Sequence[str]) -> str:
    """The same rows as a SELECT for the checking engine."""
    source = "customer"
    if any("n_nationkey" in APPLICANT_SQL[c] for c in columns):
        source += " JOIN nation ON c_nationkey = n_nationkey"
    if _FROM_ORDERS & set(columns):
        source += (
            " LEFT JOIN (SELECT o_custkey, MAX(o_orderdate) AS o_last, MIN(o_orderdate) AS o_first"
            " FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey"
        )
    listed = ", ".join(f'{APPLICANT_SQL[c]} AS "{c}"' for c in columns)
    return f"SELECT {listed} FROM {source}"


# ------------------------------------------------------------------ side tables

_BRACKETS = ((0, 10000, 2), (10000, 40000, 4), (50000, 1000000000, 6))


def state_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tax brackets per state; the state of nation 24 is unknown on purpose."""
    nation = table(spark, sf_dir, "nation").filter("n_nationkey <> 24")
    slots = F.array(*[
        F.struct(
            F.lit(float(p)).alias("DollarsPreviousTaxed"),
            F.lit(float(m)).alias("MaximumTaxableDollars"),
            F.lit(r).alias("r"),
        )
        for p, m, r in _BRACKETS
    ])
    return nation.select(F.expr(state_sql()).alias("State"), "n_nationkey", F.inline(slots)).select(
        "State", "DollarsPreviousTaxed", "MaximumTaxableDollars",
        ((F.col("r") * (1 + F.col("n_nationkey") % 3)).cast("double") / 100).alias("Rates"),
        (F.lit(2000.0) + F.col("n_nationkey") * 100).alias("Standard_Deduction"),
        (F.lit(1000.0) + F.col("n_nationkey") * 10).alias("Personal_Exemption"),
    )


def state_brackets_sql() -> str:
    values = ", ".join(str(b) for b in _BRACKETS)
    return (
        f"SELECT {state_sql()} AS State, CAST(p AS DOUBLE) AS DollarsPreviousTaxed, "
        "CAST(m AS DOUBLE) AS MaximumTaxableDollars, CAST(r * (1 + n_nationkey % 3) AS DOUBLE) / 100 AS Rates, "
        "CAST(2000 + n_nationkey * 100 AS DOUBLE) AS Standard_Deduction, "
        "CAST(1000 + n_nationkey * 10 AS DOUBLE) AS Personal_Exemption "
        f"FROM nation CROSS JOIN (VALUES {values}) AS b(p, m, r) WHERE n_nationkey <> 24"
    )


# name -> (filter, {column: SQL over nation})
ZIP_TABLE_SQL = {
    "modelling": ("n_nationkey % 5 <> 2", {
        "acs_median_income": "CAST(30000 + n_nationkey * 1700 AS DOUBLE)",
        "population": "CAST(1000 + n_nationkey * 313 AS DOUBLE)",
    }),
    "population": ("n_nationkey % 7 <> 3", {"pop_density": "CAST(10 + n_nationkey * 3 AS DOUBLE)"}),
    "incomes": ("n_nationkey % 4 <> 1", {"HC03_VC113": "CAST(n_nationkey % 9 AS DOUBLE)"}),
    "home_values": ("n_nationkey < 20", {
        "median_home": "CAST(90000 + n_nationkey * 5000 AS DOUBLE)",
        "median_rental": "CAST(700 + n_nationkey AS DOUBLE)",
    }),
    "income": ("n_nationkey > 2", {
        "median_income": "CAST(40000 + n_nationkey * 900 AS DOUBLE)",
        "size": "CAST(2 AS DOUBLE)",
        "mean_income": "CAST(50000 AS DOUBLE)",
    }),
    "irs": ("n_nationkey % 6 <> 5", {
        c: f"CAST((n_nationkey + {i}) * {i + 2} AS DOUBLE)" for i, c in enumerate(rules.IRS_COLUMNS)
    }),
}


def zip_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation = table(spark, sf_dir, "nation")
    return {
        name: nation.filter(keep).selectExpr(
            f"{zip_sql('n_nationkey')} AS {'ZIPCODE' if name == 'irs' else 'zipcode'}",
            *[f"{sql} AS {c}" for c, sql in columns.items()],
        )
        for name, (keep, columns) in ZIP_TABLE_SQL.items()
    }


def zip_table_sql(name: str, drop: Sequence[str] = ()) -> str:
    keep, columns = ZIP_TABLE_SQL[name]
    listed = ", ".join(f"{sql} AS {c}" for c, sql in columns.items() if c not in drop)
    return f"SELECT {zip_sql('n_nationkey')} AS zipcode, {listed} FROM nation WHERE {keep}"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as taxi trips: the user is the ZIP, a trip lasts 1 to 60 minutes."""
    minutes = "CAST(1 + event_id % 60 AS INT)"
    return table(spark, sf_dir, "events").selectExpr(
        "ts AS tpep_pickup_datetime",
        f"ts + make_dt_interval(0, 0, {minutes}) AS tpep_dropoff_datetime",
        "CAST(user_id AS INT) AS pickup_zip",
        "CAST((user_id * 7 + 3) % 97 AS INT) AS dropoff_zip",
        "value AS fare_amount",
        "CAST(event_id % 250 AS DOUBLE) / 10 AS trip_distance",
        "event_id AS trip_id",
    )


TRIPS_SQL = (
    "SELECT ts AS tpep_pickup_datetime, ts + to_minutes(CAST(1 + event_id % 60 AS INTEGER)) AS tpep_dropoff_datetime, "
    "CAST(user_id AS INTEGER) AS pickup_zip, CAST((user_id * 7 + 3) % 97 AS INTEGER) AS dropoff_zip, "
    "value AS fare_amount, CAST(event_id % 250 AS DOUBLE) / 10 AS trip_distance, event_id AS trip_id FROM events"
)
