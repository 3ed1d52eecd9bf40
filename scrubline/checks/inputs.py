"""The two input tables, derived from the given ones.

The given tables are clean, so these expressions add the dirt that the
operators are about: gaps, NaN, blanks, impossible dates, overflowing counts,
infinite scores, very short texts.  They cover every row, and Spark SQL and
DuckDB run the same text, which makes them the common ground of a query and its
check.  Every document is a review with its whole text; gaps and short texts are
further reviews with keys of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

APPS_TABLE = "part"
APPS = {
    "app_id": "p_partkey",
    "app": "concat(p_name, ' #', CAST(p_partkey AS STRING))",
    "category": "p_type",
    "rating": """CASE WHEN p_partkey % 11 = 0 THEN NULL
        WHEN p_partkey % 13 = 0 THEN CAST('NaN' AS DOUBLE)
        WHEN p_partkey % 97 = 0 THEN CAST(19 AS DOUBLE)
        ELSE CAST(10 + p_partkey % 41 AS DOUBLE) / 10 END""",
    "reviews": """CASE WHEN p_partkey % 17 = 0 THEN '3.0M' WHEN p_partkey % 37 = 0 THEN ''
        ELSE CAST(p_partkey * 37 AS STRING) END""",
    "size": """CASE WHEN p_partkey % 7 = 0 THEN 'Varies with device'
        ELSE concat(CAST(p_size AS STRING), 'M') END""",
    "installs": """CASE p_partkey % 6 WHEN 0 THEN '1,000+' WHEN 1 THEN '10,000+'
        WHEN 2 THEN '1,000,000,000+' WHEN 3 THEN '5,000,000,000+'
        WHEN 4 THEN 'Free' ELSE '0' END""",
    "type": """CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 23 = 0 THEN ''
        WHEN p_partkey % 29 = 0 THEN '  ' WHEN p_partkey % 31 = 0 THEN '0'
        WHEN p_partkey % 43 = 0 THEN 'NaN' WHEN p_partkey % 5 = 0 THEN 'Paid'
        ELSE 'Free' END""",
    "price": """CASE WHEN p_partkey % 5 = 0 THEN concat('$', CAST(p_retailprice AS STRING)) WHEN p_partkey % 47 = 0 THEN '$1,234.56'
        WHEN p_partkey % 53 = 0 THEN '1,99' WHEN p_partkey % 59 = 0 THEN 'Everyone'
        ELSE '0' END""",
    "content_rating": """CASE WHEN p_partkey % 14 = 0 THEN NULL WHEN p_partkey % 15 = 0 THEN 'NaN'
        WHEN p_partkey % 3 = 0 THEN 'Teen' ELSE 'Everyone' END""",
    "genres": "p_brand",
    "last_updated": """CASE p_partkey % 8 WHEN 0 THEN 'Jan 7, 2018' WHEN 1 THEN 'February 30, 2018'
        WHEN 2 THEN '1.0.19' WHEN 3 THEN 'May 05, 2017' WHEN 4 THEN 'July 30, 2018'
        ELSE 'January 7, 2018' END""",
    "current_ver": """CASE WHEN p_partkey % 16 = 0 THEN NULL WHEN p_partkey % 18 = 0 THEN 'NaN'
        ELSE concat('1.', CAST(p_partkey % 20 AS STRING)) END""",
    "android_ver": """CASE WHEN p_partkey % 21 = 0 THEN NULL
        WHEN p_partkey % 2 = 0 THEN '4.1 and up' ELSE '4.0 and up' END""",
}

# Numbers with zeros of either sign, from the table of the apps.
NUMBERS = {
    "app_id": "p_partkey",
    "size": "p_size",
    "balance": """CASE p_partkey % 4 WHEN 0 THEN CAST('-0.0' AS DOUBLE)
        WHEN 1 THEN CAST('0.0' AS DOUBLE) ELSE p_retailprice END""",
}

# A line of three fields, some with one field less or two more.
CSV_LINE = """concat(CAST(app_id AS STRING), ',', CAST(size AS STRING),
    CASE WHEN app_id % 5 = 0 THEN '' WHEN app_id % 7 = 0 THEN ',x,y,z' ELSE ',x' END)"""

# Numbers of a table with many rows.
NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

REVIEWS_TABLE = "documents"
REVIEWS = {
    "review_id": "doc_id",
    "app": "source",
    "translated_review": "text",
    "sentiment": """CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'nan'
        WHEN doc_id % 3 = 0 THEN ' Positive ' WHEN doc_id % 5 = 0 THEN 'POSITIVE'
        WHEN doc_id % 3 = 1 THEN 'Negative' ELSE 'Neutral' END""",
    "sentiment_polarity": """CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'nan'
        WHEN doc_id % 19 = 0 THEN 'abc'
        ELSE CAST(CAST(doc_id % 201 - 100 AS DOUBLE) / 100 AS STRING) END""",
    "sentiment_subjectivity": """CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'nan'
        WHEN doc_id % 29 = 0 THEN ''
        ELSE CAST(CAST(doc_id % 101 AS DOUBLE) / 100 AS STRING) END""",
}
SHORT_REVIEWS = REVIEWS | {
    "review_id": "doc_id + 1000000000000",
    "translated_review": """CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 10 = 0 THEN ''
        WHEN doc_id % 11 = 0 THEN 'nan' WHEN doc_id % 8 = 0 THEN '...'
        WHEN doc_id % 7 = 0 THEN 'Là' WHEN doc_id % 5 = 0 THEN 'Ok, né'
        ELSE substr('wonderful', 1, CAST(1 + doc_id % 9 AS INT)) END""",
    "sentiment_polarity": f"""CASE WHEN doc_id % 31 = 1 THEN 'inf' WHEN doc_id % 31 = 2
        THEN '-Infinity' ELSE {REVIEWS['sentiment_polarity']} END""",
}


def _listed(expressions: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in expressions.items()]


def as_sql(expressions: dict[str, str], table: str) -> str:
    return f"SELECT {', '.join(_listed(expressions))} FROM {table}"


def apps_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{APPS_TABLE}.parquet")
    return table.selectExpr(*_listed(APPS))


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{APPS_TABLE}.parquet")
    return table.selectExpr(*_listed(NUMBERS))


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{REVIEWS_TABLE}.parquet")
    whole, short = (table.selectExpr(*_listed(e)) for e in (REVIEWS, SHORT_REVIEWS))
    return whole.unionAll(short)
