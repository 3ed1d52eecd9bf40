"""DuckDB SQL for the registered queries, written from the operators' contracts.

It shares only the input tables with the Spark side.  Text is cleaned by the
two separate rewrites, NaN text is recognised by comparison, the median and the
modes come from the engine's own functions or plain ranking.
"""

from __future__ import annotations

from scrubline.checks.inputs import (
    APPS,
    APPS_TABLE,
    CSV_LINE,
    NUMBERS,
    NUMERIC,
    REVIEWS,
    REVIEWS_TABLE,
    SHORT_REVIEWS,
    as_sql,
)

APP_ROWS = f"apps AS ({as_sql(APPS, APPS_TABLE)})"
REVIEW_ROWS = (
    f"reviews AS ({as_sql(REVIEWS, REVIEWS_TABLE)} "
    f"UNION ALL {as_sql(SHORT_REVIEWS, REVIEWS_TABLE)})"
)
COMPLETE = """complete AS (
    SELECT * FROM reviews
    WHERE translated_review IS NOT NULL AND translated_review <> ''
      AND sentiment IS NOT NULL AND sentiment_polarity IS NOT NULL
      AND sentiment_subjectivity IS NOT NULL)"""
CLEANED = r"""cleaned AS (
    SELECT * REPLACE (lower(regexp_replace(regexp_replace(
        translated_review, '[^\w\s]', ' ', 'g'), '\s{2,}', ' ', 'g')) AS translated_review)
    FROM complete)"""
LONG_ENOUGH = "kept AS (SELECT * FROM cleaned WHERE length(translated_review) >= 3)"
POSITIVE = "positive AS (SELECT * FROM kept WHERE lower(trim(sentiment)) = 'positive')"
WORDS = r"""counted AS (
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(translated_review, '\s+')) AS word FROM positive)
    WHERE word <> '' GROUP BY word)"""


def _apps(query: str) -> str:
    return f"WITH {APP_ROWS} {query}"


def _reviews(query: str, *steps: str) -> str:
    return f"WITH {', '.join((REVIEW_ROWS, *steps))} {query}"


def _nan_text(column: str) -> str:
    return f"coalesce(lower(trim({column})) = 'nan', false)"


# Presence of a value in the imputed columns.
PRESENT = {
    "rating": "rating IS NOT NULL AND NOT isnan(rating)",
    "type": "type IS NOT NULL AND trim(type) <> ''",
    "content_rating": f"content_rating IS NOT NULL AND NOT {_nan_text('content_rating')}",
    "current_ver": f"current_ver IS NOT NULL AND NOT {_nan_text('current_ver')}",
    "android_ver": f"android_ver IS NOT NULL AND NOT {_nan_text('android_ver')}",
}


def _ranked(column: str, present: str) -> str:
    return (
        f"(SELECT {column} AS mode, count(*) AS n FROM apps WHERE {present} "
        f"GROUP BY {column} ORDER BY n DESC, mode LIMIT 1)"
    )


def _mode(column: str, present: str | None = None) -> str:
    return f"(SELECT mode FROM {_ranked(column, present or PRESENT[column])})"


def _filled(column: str, present: str | None = None) -> str:
    present = present or PRESENT[column]
    return f"CASE WHEN {present} THEN {column} ELSE {_mode(column, present)} END AS {column}"


MEDIAN = f"(SELECT quantile_disc(rating, 0.5) FROM apps WHERE {PRESENT['rating']})"
RATING_FILLED = f"CASE WHEN {PRESENT['rating']} THEN rating ELSE {MEDIAN} END AS rating"
PLAIN_RATING = f"CASE WHEN {PRESENT['rating']} THEN rating END AS rating"

TO_INT = "CAST(TRY_CAST(regexp_replace({0}, '[^0-9]', '', 'g') AS INT) AS DOUBLE) AS {0}"
TO_PRICE = """TRY_CAST(replace(regexp_replace(price, '[^0-9.,]', '', 'g'), ',', '.')
    AS DOUBLE) AS price"""
TO_DATE = "CAST(CAST(try_strptime(last_updated, '%B %-d, %Y') AS DATE) AS VARCHAR)"
CONVERTED = f"{TO_INT.format('reviews')}, {TO_INT.format('installs')}, {TO_PRICE}"


def _score(column: str) -> str:
    number = f"TRY_CAST({column} AS FLOAT)"
    return f"CASE WHEN isfinite({number}) THEN CAST({number} AS DOUBLE) END AS {column}"


SCORES = f"{_score('sentiment_polarity')}, {_score('sentiment_subjectivity')}"


def _pct(part: str, whole: str, name: str) -> str:
    """Percentage with two decimals in whole numbers, so that an exact half goes
    up; the engine's ``round`` of a double sends 4.765 down."""
    return f"((20000 * {part} + {whole}) // (2 * {whole})) / 100.0 AS {name}"


def _audit(column: str, kind: str = "text") -> str:
    """Condition of the audit: NULL, NaN or empty text."""
    if kind == "double":
        return f"{column} IS NULL OR isnan({column})"
    if kind == "integer":
        return f"{column} IS NULL"
    return f"{column} IS NULL OR {column} = '' OR {_nan_text(column)}"


APP_KINDS = {c: "text" for c in APPS} | {"app_id": "integer", "rating": "double"}
REVIEW_KINDS = {c: "text" for c in REVIEWS} | {"review_id": "integer"}


def _wide(kinds: dict[str, str]) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {_audit(c, k)}) AS {c}" for c, k in kinds.items())


def _long(table: str, kinds: dict[str, str], *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {', '.join(columns)} FROM "
        f"(SELECT count(*) FILTER (WHERE {_audit(c, k)}) AS missing, count(*) AS total "
        f"FROM {table})"
        for c, k in kinds.items()
    )


def _count_not(column: str) -> str:
    return f"count(*) FILTER (WHERE NOT ({PRESENT[column]}))"


def _imputed_anywhere() -> str:
    columns = ["app_id", RATING_FILLED, _filled("type")]
    for c in APPS:
        if c not in ("app_id", "rating", "type"):
            columns.append(_filled(c, f"NOT ({_audit(c)})"))
    return ", ".join(columns)


def _non_numeric(column: str) -> str:
    return (
        f"SELECT '{column}' AS \"column\", count(*) FILTER (WHERE {column} IS NOT NULL "
        f"AND TRY_CAST({column} AS DOUBLE) IS NULL) AS non_numeric FROM complete"
    )


def _impute_line(column: str) -> str:
    filled = RATING_FILLED if column == "rating" else _filled(column)
    return (
        f"SELECT '{column}' AS \"column\", {_count_not(column)} AS before, "
        f"(SELECT {_count_not(column)} FROM (SELECT {filled} FROM apps)) AS after, "
        f"{_pct(_count_not(column), 'count(*)', 'pct_before')} FROM apps"
    )


def _shown(column: str, width: int) -> str:
    """Display form: at most ``width`` characters, the last three dots."""
    return (
        f"CASE WHEN length({column}) > {width} "
        f"THEN concat(left({column}, {width - 3}), '...') ELSE {column} END AS {column}"
    )


def _union(lines) -> str:
    return " UNION ALL ".join(lines)


MISSING_CRITICAL = """(CASE WHEN translated_review IS NULL OR translated_review = '' THEN 1 ELSE 0 END
    + CASE WHEN sentiment IS NULL THEN 1 ELSE 0 END
    + CASE WHEN sentiment_polarity IS NULL THEN 1 ELSE 0 END
    + CASE WHEN sentiment_subjectivity IS NULL THEN 1 ELSE 0 END)"""
LENGTHS = """SELECT CAST(length(translated_review) AS BIGINT) AS length, count(*) AS n
    FROM cleaned {where} GROUP BY 1"""
CLEAN_APP = f"""SELECT app_id, app, category, {RATING_FILLED}, size, {_filled('type')},
    {_filled('content_rating')}, genres, last_updated, {_filled('current_ver')},
    {_filled('android_ver')}, {CONVERTED}, {TO_DATE} AS last_updated_date FROM apps"""
IN_DOMAIN = "coalesce(type IN ('Free', 'Paid'), false)"

def _checksum(columns: dict[str, str]) -> str:
    """Sum of the rows' checksums: 32 bits of the MD5 of the columns' text."""
    billionths = "CAST(TRY_CAST({0} * 1e9 AS DECIMAL(38,0)) AS VARCHAR)"
    form = {"text": "{0}", "integer": "CAST(CAST({0} AS BIGINT) AS VARCHAR)", "double": billionths}
    parts = ", ".join(f"coalesce('=' || {form[k].format(c)}, '-')" for c, k in columns.items())
    return f"CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(31), {parts})), 1, 8) AS BIGINT)) AS BIGINT)"


def _manifest() -> str:
    apps = {"app_id": "integer", "app": "text", "category": "text", "rating": "double"}
    apps |= dict.fromkeys(("size", "type", "content_rating", "genres", "last_updated"), "text")
    apps |= {"current_ver": "text", "android_ver": "text", "reviews": "integer"}
    apps |= {"installs": "integer", "price": "double", "last_updated_date": "text"}
    reviews = {"review_id": "integer", "app": "text", "translated_review": "text"}
    reviews |= {"sentiment": "text", "sentiment_polarity": "double"}
    reviews |= {"sentiment_subjectivity": "double", "review_length": "integer"}
    reviews |= {"sentiment_normalized": "text"}
    clean = _reviews(
        f"""SELECT review_id, app, translated_review, sentiment, {SCORES},
        length(translated_review) AS review_length,
        lower(trim(sentiment)) AS sentiment_normalized FROM kept""",
        COMPLETE,
        CLEANED,
        LONG_ENOUGH,
    )
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, 2 * count(*) AS landed_rows, true AS complete, "
        f"count(*) AS once_rows, {_checksum(columns)} AS checksum FROM ({rows})"
        for name, columns, rows in (("apps", apps, _apps(CLEAN_APP)), ("reviews", reviews, clean))
    )


def _type_of(table: str, rows: str, columns: list[str]) -> str:
    """Type and reason of each text column of ``rows``."""
    whole, fraction = "0|-?[1-9][0-9]*", r"-?(0|[1-9][0-9]*)\.[0-9]+"
    digits = "length(regexp_replace(v, '[^0-9]', '', 'g'))"
    significant = "length(ltrim(regexp_replace(v, '[^0-9]', '', 'g'), '0'))"
    scale = "CASE WHEN contains(v, '.') THEN length(regexp_extract(v, '[^.]*$')) ELSE 0 END"
    ok = {
        "boolean": "v IN ('true', 'false')",
        "int": f"regexp_full_match(v, '{whole}') AND TRY_CAST(v AS INT) IS NOT NULL",
        "bigint": f"regexp_full_match(v, '{whole}') AND TRY_CAST(v AS BIGINT) IS NOT NULL",
        "decimal": f"(regexp_full_match(v, '{whole}') OR regexp_full_match(v, '{fraction}')) AND {digits} <= 38",
        "double": rf"regexp_full_match(v, '-?(0|[1-9][0-9]*)\.(0|[0-9]*[1-9])') AND {significant} <= 15",
        "date": "regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(v AS DATE) IS NOT NULL",
        "timestamp": "regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}') "
        "AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
    }
    kinds = ("boolean", "bigint", "decimal", "double", "date", "timestamp")
    ranked = ", ".join(f"{{'c': no_{k}, 'o': {i}, 't': '{k}'}}" for i, k in enumerate(kinds))
    counts = ", ".join(f"count(*) FILTER (WHERE NOT ({test})) AS no_{t}" for t, test in ok.items())
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS name, {i} AS place, CAST({c} AS VARCHAR) AS v FROM t" for i, c in enumerate(columns)
    )
    given = "'every text is given back'"
    return f"""SELECT '{table}' AS table_name, name AS "column",
        CASE WHEN n = 0 THEN 'string' WHEN no_boolean = 0 THEN 'boolean' WHEN no_int = 0 THEN 'int'
          WHEN no_bigint = 0 THEN 'bigint' WHEN is_decimal THEN 'decimal(' || (digits + most) || ',' || most || ')'
          WHEN no_double = 0 THEN 'double' WHEN no_date = 0 THEN 'date' WHEN no_timestamp = 0 THEN 'timestamp'
          ELSE 'string' END AS type,
        CASE WHEN n = 0 THEN 'no values' WHEN no_boolean = 0 OR no_int = 0 OR no_bigint = 0 THEN {given}
          WHEN is_decimal THEN 'one number of decimals'
          WHEN no_double = 0 OR no_date = 0 OR no_timestamp = 0 THEN {given}
          ELSE nearest.c || ' of ' || n || ' are no ' || nearest.t END AS reason
      FROM (SELECT *, no_decimal = 0 AND least = most AND digits + most <= 38 AS is_decimal,
          list_sort([{ranked}])[1] AS nearest
        FROM (SELECT name, place, count(*) AS n, {counts}, min({scale}) AS least, max({scale}) AS most,
            max({digits} - ({scale})) AS digits
          FROM (WITH t AS ({rows}) SELECT * FROM ({long})) WHERE v IS NOT NULL AND v <> '' GROUP BY name, place))"""


PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]

ORACLE: dict[str, str] = {
    # sources and sinks
    "normalize_columns": _apps(f"SELECT * REPLACE ({PLAIN_RATING}) FROM apps"),
    "table_shape": f"""WITH {APP_ROWS}, {REVIEW_ROWS}
        SELECT 'apps' AS table_name, count(*) AS rows, CAST({len(APPS)} AS BIGINT) AS columns
        FROM apps UNION ALL
        SELECT 'reviews', count(*), CAST({len(REVIEWS)} AS BIGINT) FROM reviews""",
    "csv_roundtrip": _reviews(
        """SELECT review_id, nullif(app, '') AS app,
        nullif(translated_review, '') AS translated_review, sentiment,
        nullif(sentiment_polarity, '') AS sentiment_polarity,
        nullif(sentiment_subjectivity, '') AS sentiment_subjectivity FROM reviews"""
    ),
    "csv_malformed_rows": f"""WITH apps AS ({as_sql(NUMBERS, APPS_TABLE)})
        SELECT app_id AS key, CAST(size AS VARCHAR) AS size, {CSV_LINE} AS malformed_line
        FROM apps WHERE app_id % 5 = 0 OR app_id % 7 = 0""",
    "parquet_roundtrip": _apps(
        f"""SELECT * REPLACE ({PLAIN_RATING}, nullif(reviews, '') AS reviews,
        nullif(type, '') AS type) FROM apps"""
    ),
    "preview_reviews": _reviews(
        f"""SELECT review_id, {_shown('translated_review', 100)}
        FROM kept ORDER BY review_id LIMIT 5""",
        COMPLETE,
        CLEANED,
        LONG_ENOUGH,
    ),
    "preview_ties": _apps(
        f"""SELECT {_shown('genres', 20)}, {_shown('category', 20)}, app_id FROM
        (SELECT * FROM apps ORDER BY genres, category, app_id LIMIT 5)"""
    ),
    "jdbc_ready_apps": _apps(
        f"""SELECT app_id, app, category, {PLAIN_RATING}, size, type, content_rating, genres,
        last_updated, current_ver, android_ver, {CONVERTED},
        {TO_DATE} AS last_updated_date FROM apps"""
    ),
    "jdbc_ready_reviews": _reviews(
        f"SELECT review_id, app, translated_review, sentiment, {SCORES} FROM reviews"
    ),
    "load_manifest": _manifest(),
    "inferred_schema": _type_of(
        "apps", as_sql(APPS, APPS_TABLE), [c for c in APPS if c not in ("app_id", "rating")]
    )
    + " UNION ALL "
    + _type_of("parts", "SELECT * FROM part", PART_COLUMNS),
    # filters
    "type_missing_report": _apps(
        f"""SELECT count(*) AS rows, {_count_not('type')} AS missing,
        {_pct(_count_not('type'), 'count(*)', 'pct')} FROM apps"""
    ),
    "reviews_complete": _reviews("SELECT * FROM complete", COMPLETE),
    "reviews_incomplete_sample": _reviews(
        f"""SELECT review_id, {_shown('translated_review', 20)}, sentiment,
        sentiment_polarity, sentiment_subjectivity FROM reviews
        WHERE {MISSING_CRITICAL} > 0 ORDER BY review_id LIMIT 5"""
    ),
    "non_numeric_counts": _reviews(
        _union(map(_non_numeric, ("sentiment_polarity", "sentiment_subjectivity"))), COMPLETE
    ),
    "reviews_min_length": _reviews(
        "SELECT review_id, translated_review FROM kept", COMPLETE, CLEANED, LONG_ENOUGH
    ),
    "positive_reviews": _reviews(
        """SELECT review_id, lower(trim(sentiment)) AS sentiment_normalized, translated_review
        FROM positive""",
        COMPLETE,
        CLEANED,
        LONG_ENOUGH,
        POSITIVE,
    ),
    "domain_violations": _apps(
        f"""SELECT 'type' AS "column",
        count(*) FILTER (WHERE {PRESENT['type']} AND NOT {IN_DOMAIN}) AS violations FROM apps
        UNION ALL SELECT 'rating', count(*) FILTER (WHERE {PRESENT['rating']}
        AND NOT rating BETWEEN 0 AND 5) FROM apps"""
    ),
    "domain_nulled": _apps(
        f"""SELECT app_id, CASE WHEN type IS NULL OR trim(type) = '' OR {IN_DOMAIN}
        THEN type END AS type,
        CASE WHEN {PRESENT['rating']} AND rating BETWEEN 0 AND 5 THEN rating END AS rating
        FROM apps"""
    ),
    "reviews_valid_sentiment": _reviews(
        """SELECT * FROM complete
        WHERE isfinite(TRY_CAST(sentiment_polarity AS DOUBLE))
          AND isfinite(TRY_CAST(sentiment_subjectivity AS DOUBLE))""",
        COMPLETE,
    ),
    # aggregations and profiling
    "app_missing_before": _apps(
        "SELECT count(*) AS rows, "
        + ", ".join(f"{_count_not(c)} AS {c}_missing" for c in PRESENT)
        + " FROM apps"
    ),
    "rating_mean": _apps(
        # Ratings are whole multiples of 2**-52 and their mean is between 2 and 4, so the mean
        # rounded once is a whole multiple of 2**-51.
        f"""SELECT CAST((s + n) // (2 * n) AS DOUBLE) / 2251799813685248.0 AS rating_mean FROM (
        SELECT sum(CAST(rating * 4503599627370496.0 AS HUGEINT)) AS s, count(*) AS n
        FROM apps WHERE {PRESENT['rating']})"""
    ),
    "rating_median": _apps(f"SELECT {MEDIAN} AS rating_median"),
    "rating_median_approx": _apps(
        f"SELECT count(*) AS n_rows, true AS within_error FROM apps WHERE {PRESENT['rating']}"
    ),
    "numeric_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS value FROM lineitem"
        for c in NUMERIC
    ),
    "fill_values": _apps(
        _union(
            f"SELECT '{c}' AS \"column\", '{'median' if c == 'rating' else 'mode'}' AS statistic, "
            f"CAST({MEDIAN if c == 'rating' else _mode(c)} AS VARCHAR) AS value"
            for c in PRESENT
        )
    ),
    "column_modes": _apps(
        _union(
            f"SELECT '{c}' AS \"column\", mode, n FROM {_ranked(c, p)}"
            for c, p in PRESENT.items()
            if c != "rating"
        )
    ),
    "numeric_modes": f"WITH apps AS ({as_sql(NUMBERS, APPS_TABLE)}) "
    + _union(
        f"SELECT '{c}' AS \"column\", mode, n FROM (SELECT {c} + 0.0::DOUBLE AS mode, "
        f"count(*) AS n FROM apps GROUP BY 1 ORDER BY n DESC, mode LIMIT 1)"
        for c in ("size", "balance")
    ),
    "bounded_modes": _apps(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST(mode AS VARCHAR) AS mode, n
            FROM {_ranked(c, f"NOT ({_audit(c, k)})")}"""
            for c, k in APP_KINDS.items()
            if c != "rating"
        )
    ),
    "missing_wide": _apps(f"SELECT {_wide(APP_KINDS)} FROM apps"),
    "missing_wide_reviews": _reviews(f"SELECT {_wide(REVIEW_KINDS)} FROM reviews"),
    "missing_long": _reviews(
        _long("complete", REVIEW_KINDS, "missing AS missing_count"), COMPLETE
    ),
    "missing_pct": _reviews(
        _long(
            "complete", REVIEW_KINDS, "missing", _pct("missing", "total", "pct")
        ),
        COMPLETE,
    ),
    "review_length_hist": _reviews(
        LENGTHS.format(where="WHERE length(translated_review) BETWEEN 1 AND 10"),
        COMPLETE,
        CLEANED,
    ),
    "review_length_dist": _reviews(LENGTHS.format(where=""), COMPLETE, CLEANED),
    "type_distribution": _apps(
        f"SELECT type AS value, count(*) AS n FROM (SELECT {_filled('type')} FROM apps) "
        "GROUP BY type"
    ),
    "impute_report": _apps(_union(map(_impute_line, PRESENT))),
    "word_counts": _reviews(
        "SELECT word, n FROM counted", COMPLETE, CLEANED, LONG_ENOUGH, POSITIVE, WORDS
    ),
    "row_missing_profile": _reviews(
        f"SELECT CAST({MISSING_CRITICAL} AS BIGINT) AS n_missing, count(*) AS n "
        "FROM reviews GROUP BY 1"
    ),
    # missing-value handling
    "nan_to_null": _apps(
        f"SELECT app_id, {PLAIN_RATING}, "
        + ", ".join(
            f"CASE WHEN {PRESENT[c]} THEN {c} END AS {c}"
            for c in ("content_rating", "current_ver", "android_ver")
        )
        + " FROM apps"
    ),
    "rating_imputed": _apps(f"SELECT app_id, {RATING_FILLED} FROM apps"),
    "rating_mean_imputed": _apps(
        f"""SELECT app_id, round(CASE WHEN {PRESENT['rating']} THEN rating ELSE
        (SELECT avg(rating) FROM apps WHERE {PRESENT['rating']}) END, 6) AS rating FROM apps"""
    ),
    "type_imputed": _apps(f"SELECT app_id, {_filled('type')} FROM apps"),
    "content_rating_imputed": _apps(f"SELECT app_id, {_filled('content_rating')} FROM apps"),
    "versions_imputed": _apps(
        f"SELECT app_id, {_filled('current_ver')}, {_filled('android_ver')} FROM apps"
    ),
    "type_domain_imputed": _apps(f"SELECT app_id, {_filled('type', IN_DOMAIN)} FROM apps"),
    "all_columns_imputed": _apps(f"SELECT {_imputed_anywhere()} FROM apps"),
    # conversions
    "reviews_to_int": _apps(f"SELECT app_id, {TO_INT.format('reviews')} FROM apps"),
    "installs_to_int": _apps(f"SELECT app_id, {TO_INT.format('installs')} FROM apps"),
    "price_to_double": _apps(f"SELECT app_id, {TO_PRICE} FROM apps"),
    "last_updated_to_date": _apps(
        f"SELECT app_id, last_updated, {TO_DATE} AS last_updated_date FROM apps"
    ),
    "sentiment_to_float": _reviews(f"SELECT review_id, {SCORES} FROM reviews"),
    "reviews_clean": _reviews(
        "SELECT review_id, translated_review FROM cleaned", COMPLETE, CLEANED
    ),
    # whole flows
    "app_clean": _apps(CLEAN_APP),
    "reviews_clean_full": _reviews(
        f"""SELECT review_id, app, translated_review, sentiment, {SCORES},
        CAST(length(translated_review) AS BIGINT) AS review_length,
        lower(trim(sentiment)) AS sentiment_normalized FROM kept""",
        COMPLETE,
        CLEANED,
        LONG_ENOUGH,
    ),
    "top_positive_words": _reviews(
        "SELECT word, n FROM counted ORDER BY n DESC, word LIMIT 20",
        COMPLETE,
        CLEANED,
        LONG_ENOUGH,
        POSITIVE,
        WORDS,
    ),
}

# The same results by other ways.
ORACLE["observed_audit"] = ORACLE["missing_pct"]
ORACLE["app_clean_lazy"] = ORACLE["app_clean"]
ORACLE["incremental_fill_values"] = ORACLE["fill_values"]
ORACLE["csv_split_roundtrip"] = ORACLE["csv_roundtrip"]
