"""Noisy customer views derived from the given tables.

Each view is one SELECT that Spark SQL and DuckDB both read; ``{table}`` stands for a source
table. Noise is a pure function of the key, and ``ord_`` is the unique ordinal of a row.
"""

from pyspark.sql import DataFrame, SparkSession

LABEL = """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN '  ' ELSE '' END || 'C' || CAST(o_custkey AS STRING) AS customerID,
       CASE WHEN o_orderkey % 211 = 0 THEN 'not a date'
            ELSE substr(CAST(o_orderdate AS STRING), 1, 7) || '-01' END AS snapdate,
       CASE WHEN o_orderkey % 101 = 0 THEN 'Unknown'
            WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS Churn,
       o_orderkey AS ord_
FROM {orders}
"""

DEMOGRAPHIC = """
SELECT 'C' || CAST(k AS STRING) AS customerID,
       CASE (k + v) % 12 WHEN 0 THEN 'female' WHEN 1 THEN ' MALE' WHEN 2 THEN 'femail' WHEN 3 THEN 'femalee'
            WHEN 4 THEN 'maie' WHEN 5 THEN 'mal' WHEN 6 THEN 'f' WHEN 7 THEN 'unknown' WHEN 8 THEN 'fmale'
            WHEN 9 THEN NULL WHEN 10 THEN 'male' ELSE 'Female ' END AS gender,
       CASE k % 9 WHEN 0 THEN 'yes' WHEN 1 THEN 'No.' WHEN 2 THEN '1.0' WHEN 3 THEN '0' WHEN 4 THEN '是'
            WHEN 5 THEN 'es' WHEN 6 THEN 'yes!' WHEN 7 THEN 'N' ELSE 'Yep' END AS Partner,
       CASE k % 7 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' WHEN 2 THEN '无' WHEN 3 THEN 'y'
            WHEN 4 THEN 'nope' WHEN 5 THEN 'off' ELSE 'on' END AS Dependents,
       CASE k % 8 WHEN 0 THEN 'bachelor' WHEN 1 THEN 'High School' WHEN 2 THEN 'colege' WHEN 3 THEN 'bachelur'
            WHEN 4 THEN 'phd' WHEN 5 THEN 'collage' WHEN 6 THEN 'highschol' ELSE 'College' END AS EducationLevel,
       CASE k % 7 WHEN 0 THEN 'employed' WHEN 1 THEN 'retird' WHEN 2 THEN 'self employed' WHEN 3 THEN 'unemployed'
            WHEN 4 THEN 'student' WHEN 5 THEN 'Retired' ELSE 'Self-Employed' END AS EmploymentStatus,
       CASE k % 7 WHEN 0 THEN '60–100k' WHEN 1 THEN '1t0-150k' WHEN 2 THEN '>150k' WHEN 3 THEN '6z-100k'
            WHEN 4 THEN 'n / a' WHEN 5 THEN '100—150k' ELSE '>15mk' END AS AnnualIncomeBracket,
       k + 10000000 * v AS ord_
FROM (SELECT c_custkey AS k, 0 AS v FROM {customer}
      UNION ALL SELECT c_custkey AS k, 1 AS v FROM {customer} WHERE c_custkey % 10 = 0) t
"""

FINANCIAL = """
SELECT 'C' || CAST(c_custkey AS STRING) AS customerID,
       CASE c_custkey % 29 WHEN 0 THEN '-' WHEN 1 THEN 'Unknown' WHEN 2 THEN '12f' WHEN 3 THEN '1e3'
            WHEN 4 THEN CAST(c_custkey * 1000 + 50000 AS STRING) WHEN 5 THEN '1_000' WHEN 6 THEN 'nan'
            ELSE ' ' || CAST(c_acctbal AS STRING) END AS MonthlyCharges,
       CASE c_custkey % 23 WHEN 0 THEN '—' WHEN 1 THEN '-5.5' WHEN 2 THEN '99999.125' WHEN 3 THEN NULL
            ELSE CAST((c_custkey * 37) % 500 AS STRING) || '.125' END AS AverageDataUsage,
       CASE c_custkey % 19 WHEN 0 THEN '-3' WHEN 1 THEN '7.9' WHEN 2 THEN '4000' WHEN 3 THEN 'none'
            ELSE CAST((c_custkey * 11) % 40 AS STRING) END AS AppLoginFrequency,
       CAST(1 + c_custkey % 5 AS STRING) AS CustomerSatisfactionScore,
       CAST(c_custkey % 72 AS STRING) AS tenure,
       c_custkey AS ord_
FROM {customer}
"""

CONTRACT = """
SELECT 'C' || CAST(k AS STRING) AS customerID,
       CASE k % 11 WHEN 0 THEN 'unknown' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN NULL WHEN 3 THEN 'Two year'
            WHEN 4 THEN 'One year' ELSE 'Month-to-month' END AS Contract,
       CASE k % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' WHEN 2 THEN 'Bank transfer'
            ELSE 'Credit card' END AS PaymentMethod,
       k + 10000000 * v AS ord_
FROM (SELECT c_custkey AS k, 0 AS v FROM {customer}
      UNION ALL SELECT c_custkey AS k, 1 AS v FROM {customer} WHERE c_custkey % 6 = 0) t
"""

SERVICE = """
SELECT 'C' || CAST(k AS STRING) AS customerID,
       CASE (k + v) % 4 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' WHEN 2 THEN 'None' ELSE 'Cable' END AS InternetService,
       CASE WHEN k % 13 = 0 THEN NULL WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END AS StreamingTV,
       k + 10000000 * (v + 2 * w) AS ord_
FROM (SELECT c_custkey AS k, 0 AS v, 0 AS w FROM {customer}
      UNION ALL SELECT c_custkey AS k, 1 AS v, 0 AS w FROM {customer} WHERE c_custkey % 5 = 0
      UNION ALL SELECT c_custkey AS k, 0 AS v, 1 AS w FROM {customer} WHERE c_custkey % 7 = 0) t
"""

SCORES = """
SELECT m AS model, substr(CAST(l_shipdate AS STRING), 1, 7) AS month,
       l_orderkey * 10 + l_linenumber AS id,
       CASE WHEN m = 'b' AND substr(CAST(l_shipdate AS STRING), 1, 7) = '1996-03' THEN 0
            WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
       CAST((l_orderkey * 7 + l_linenumber * 13) % 80
            + CASE WHEN l_returnflag = 'R' AND (m = 'a' OR l_orderkey % 2 = 0) THEN 21 ELSE 0 END AS DOUBLE)
         / CAST(100 AS DOUBLE) AS p
FROM (SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag, {both_models} AS m FROM {lineitem}) x
"""

# margins of two made ensembles after each round; eighths, so that sums are exact
ROUNDS = """
SELECT m AS model, r AS round, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
       CAST(CASE WHEN o_orderstatus = 'F' THEN least(r, 5) - CASE WHEN m = 'a' THEN greatest(r - 5, 0) ELSE 0 END ELSE 0 END
            + (o_orderkey * 7 + r * 13) % 32 AS DOUBLE) / CAST(8 AS DOUBLE) AS margin
FROM (SELECT o_orderkey, o_orderstatus, m, {rounds} AS r FROM (SELECT o_orderkey, o_orderstatus, {both_models} AS m FROM {orders}) x) z
"""

# dates of two tables in two formats: no date at all among the first rows, and some in another format later on
ORDER_DATES = """
SELECT CASE WHEN o_orderkey < 1100 THEN 'no. ' || CAST(o_orderkey AS STRING)
            WHEN o_orderkey % 17 = 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
            WHEN o_orderkey % 19 = 0 THEN '2024/13/45'
            ELSE replace(substr(CAST(o_orderdate AS STRING), 1, 7), '-', '/') || '/01' END AS snapdate,
       o_orderkey AS ord_
FROM {orders}
"""

SHIP_DATES = """
SELECT CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN '99999999'
            ELSE replace(substr(CAST(l_shipdate AS STRING), 1, 7), '-', '') || '15' END AS snapdate,
       l_orderkey * 10 + l_linenumber AS ord_
FROM {lineitem}
"""

BOTH_MODELS_SPARK = "explode(array('a', 'b'))"
BOTH_MODELS_DUCK = "unnest(['a', 'b'])"
ROUNDS_SPARK = "explode(sequence(1, 12))"
ROUNDS_DUCK = "CAST(unnest(range(1, 13)) AS INTEGER)"

VIEWS = {
    "fx_label": (LABEL, "orders"), "fx_demographic": (DEMOGRAPHIC, "customer"),
    "fx_financial": (FINANCIAL, "customer"), "fx_contract": (CONTRACT, "customer"),
    "fx_service": (SERVICE, "customer"), "fx_scores": (SCORES, "lineitem"),
    "fx_rounds": (ROUNDS, "orders"), "fx_order_dates": (ORDER_DATES, "orders"), "fx_ship_dates": (SHIP_DATES, "lineitem"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text, source = VIEWS[name]
    text = text.replace("{both_models}", BOTH_MODELS_SPARK).replace("{rounds}", ROUNDS_SPARK)
    return spark.sql(text, **{source: table(spark, sf_dir, source)})


def duck_view(name: str) -> str:
    text, source = VIEWS[name]
    return text.replace("{both_models}", BOTH_MODELS_DUCK).replace("{rounds}", ROUNDS_DUCK).replace("{%s}" % source, source).strip()
