"""The employee-shaped feed derived from customer and nation, and its SQL twin.

``RAW_FEED`` is written in the SQL both engines share. The other constants are
the same steps in plain SQL that the operators do in Spark, for comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import cell, name
from feedloom.operators.convert import convert_csv
from feedloom.operators.route import validate
from feedloom.plans.employee import EMPLOYEE

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)



def key36(column: str) -> str:
    """A whole number as six digits of base 36, in the SQL both engines share; numbers past their range are an error."""
    digits = [
        f"substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', cast(cast(floor({column} / {36**i}e0) AS bigint) % 36 AS integer) + 1, 1)"
        for i in range(5, -1, -1)
    ]
    past = f"cast(cast('past the range of ids: ' || cast({column} AS varchar(20)) AS bigint) AS varchar(20))"
    return f"CASE WHEN {column} < {36**6} THEN {' || '.join(digits)} ELSE {past} END"


RAW_FEED = f"""
SELECT c_custkey,
  'E' || {key36("c_custkey")} AS employee_id,
  CASE WHEN c_custkey % 7 = 0 THEN 'Al' WHEN c_custkey % 19 = 0 THEN '   ' ELSE n_name END AS first_name,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 53 = 0 THEN c_name
       ELSE ' Cust' || cast(c_custkey % 100 AS varchar(20)) END AS last_name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 'no-at-sign.example.com'
       ELSE 'c.' || {key36("c_custkey")} || '@example.com' END AS email,
  CASE WHEN c_custkey % 13 = 0 THEN '+91-98765-43210'
       ELSE lpad(cast(c_custkey AS varchar(20)), 10, '9') END AS phone_number,
  CASE WHEN c_custkey % 17 = 0 THEN '2022-02-30' ELSE '2022-03-15' END AS hire_date,
  c_mktsegment AS department,
  CASE WHEN c_custkey % 37 = 0 THEN 'Principal Coordinator of Everything' ELSE 'Clerk' END AS job_title,
  CASE WHEN c_custkey % 31 = 0 THEN 'lots' WHEN c_custkey % 59 = 0 THEN ''
       ELSE cast(cast(floor(c_acctbal) AS bigint) AS varchar(20)) END AS salary,
  CASE WHEN c_custkey % 29 = 0 THEN 'inr' ELSE 'INR' END AS currency,
  'Full-time' AS employment_status,
  'M' || lpad(cast(c_nationkey AS varchar(20)), 6, '0') AS manager_id,
  CASE WHEN c_custkey % 41 = 0 THEN 'yes' WHEN c_custkey % 43 = 0 THEN ' '
       WHEN c_custkey % 2 = 0 THEN 'TRUE' ELSE 'false' END AS is_active,
  CASE WHEN c_custkey % 47 = 0 THEN repeat('Kubernetes;', 20) WHEN c_custkey % 3 = 0 THEN NULL
       ELSE ' SQL; ;' || c_mktsegment || ' ' END AS skills,
  cast(c_custkey AS varchar(20)) || ', "' || n_name || '" Road' AS address_street,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE n_name END AS address_city,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS address_state,
  lpad(cast(c_custkey AS varchar(20)), 6, '5') AS address_postal_code,
  n_name AS address_country,
  c_name AS emergency_contact_name,
  CASE WHEN c_custkey % 3 = 0 THEN 'Sibling' ELSE NULL END AS emergency_contact_relationship,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE lpad(cast(c_custkey AS varchar(20)), 10, '8') END
    AS emergency_contact_phone,
  'e' || cast(c_custkey AS varchar(20)) || '@example.org' AS emergency_contact_email
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

COLUMNS = EMPLOYEE.csv_columns


def table(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{which}.parquet")


def sql_on(spark: SparkSession, sf_dir: str, query: str, *tables: str) -> DataFrame:
    """``query`` with the named tables of ``sf_dir`` in place of their names."""
    return spark.sql(
        "WITH " + ", ".join(f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in tables) + " " + query
    )


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as text, one row per customer."""
    return sql_on(spark, sf_dir, RAW_FEED, "customer", "nation")


def raw_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the columns of the CSV form."""
    return raw_feed(spark, sf_dir).select(*COLUMNS)


def typed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed converted; a record's number is its customer key."""
    cells = raw_feed(spark, sf_dir).selectExpr(
        "c_custkey AS record_number",
        "'customer' AS source_file",
        "cast(NULL AS string) AS parse_error",
        *[f"{cell(name(c))} AS {name(c)}" for c in COLUMNS],
    )
    return convert_csv(cells, EMPLOYEE)


def checked_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with ``error_type`` and ``error_message``."""
    return validate(typed_feed(spark, sf_dir), EMPLOYEE)


# The same in plain SQL ---------------------------------------------------------


def _cells() -> str:
    return ", ".join(f"nullif(trim({c}), '') AS {c}" for c in COLUMNS)


def _length(f: str, low: int, high: int, required: bool = True) -> str:
    missing = f"'{f} is required'" if required else "NULL"
    span = f"exactly {high}" if low == high else f"between {low} and {high}"
    return (
        f"CASE WHEN {f} IS NULL THEN {missing} WHEN length({f}) NOT BETWEEN {low} AND {high}"
        f" THEN '{f} must be {span} characters (found ' || length({f}) || ')' END"
    )


_RULES = ",\n".join(
    [
        _length("employee_id", 7, 7),
        _length("first_name", 3, 15),
        _length("last_name", 0, 15, False),
        _length("email", 13, 30),
        _length("phone_number", 10, 10),
        _length("hire_date", 10, 10),
        _length("department", 0, 20, False),
        _length("job_title", 0, 30, False),
        _length("currency", 3, 3),
        _length("employment_status", 3, 13),
        _length("manager_id", 7, 7),
        r"CASE WHEN NOT regexp_full_match(email, '[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')"
        " THEN 'email has an invalid format' END",
        "CASE WHEN hire_date IS NOT NULL AND try_strptime(hire_date, '%Y-%m-%d') IS NULL"
        " THEN 'hire_date must be a real date in yyyy-MM-dd format' END",
        "CASE WHEN NOT regexp_full_match(currency, '[A-Z]{3}')"
        " THEN 'currency must be a 3-letter uppercase ISO code such as INR or USD' END",
        "CASE WHEN try_cast(salary AS bigint) < 0 THEN 'salary must not be negative' END",
        "CASE WHEN is_active IS NULL THEN 'is_active is required (true or false)' END",
        "CASE WHEN length(array_to_string(skill_list, ';')) > 100"
        " THEN 'skills must not exceed 100 characters in total' END",
    ]
)

FEED_CTES = f"""WITH raw_feed AS ({RAW_FEED}),
cells AS (SELECT c_custkey, {_cells()} FROM raw_feed),
typed AS (
  SELECT *,
    coalesce([trim(s) FOR s IN string_split(skills, ';') IF trim(s) <> ''], []) AS skill_list,
    coalesce(
      CASE WHEN salary IS NOT NULL AND try_cast(salary AS bigint) IS NULL THEN 'salary must be a whole number' END,
      CASE WHEN is_active IS NOT NULL AND lower(is_active) NOT IN ('true', 'false')
           THEN 'is_active must be true or false' END) AS parse_error
  FROM cells),
checked AS (
  SELECT *, coalesce(parse_error, nullif(concat_ws('; ', {_RULES}), '')) AS error_message,
    CASE WHEN parse_error IS NOT NULL THEN 'PARSE_ERROR'
         WHEN coalesce(parse_error, nullif(concat_ws('; ', {_RULES}), '')) IS NOT NULL THEN 'VALIDATION_ERROR'
    END AS error_type
  FROM typed)
"""


def by_batch(rows: DataFrame) -> DataFrame:
    """Rows dealt out by ``batch``, mostly one to a task whatever their number; left to Spark, a task's share grows."""
    return rows.repartition(4 * rows.agg(F.count_distinct("batch")).first()[0] + 1, "batch")


def numbered_batches(lines: DataFrame, path: str, header: str | None = None, line_end: str = "\n") -> str:
    """Write ``(batch, place, line)`` as one text file per batch, in place order.

    Batches are made of consecutive keys, so none outgrows a task. ``header``
    becomes the first line of every file.
    """
    if header is not None:
        first = lines.select("batch").distinct()
        head = first.select("batch", F.lit(-1).cast("bigint").alias("place"), F.lit(header).alias("line"))
        lines = lines.unionByName(head)
    ordered = by_batch(lines).sortWithinPartitions("batch", "place")
    ordered.select("batch", "line").write.partitionBy("batch").text(path, lineSep=line_end)
    return path
