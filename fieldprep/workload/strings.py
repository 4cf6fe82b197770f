"""String expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldprep.functions import clock, text
from fieldprep.workload.registry import query, table


@query(
    r"""
    SELECT doc_id,
           array_to_string(list_transform(
             regexp_extract_all(lower(text),
               '[\p{L}\p{M}\p{N}_]+(?:[''’.][\p{L}\p{M}\p{N}_]+)*|[^\p{L}\p{M}\p{N}_]+'),
             lambda w: (CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END) || w[2:]), '') AS title
    FROM documents
    """
)
def title_case(spark, d):
    return table(spark, d, "documents").select("doc_id", text.title_case(F.col("text")).alias("title"))


@query(
    """
    SELECT p_partkey, regexp_replace(p_size || p_name || p_size || p_brand, '([0-9]+)([a-zA-Z]+)', '\\1 \\2') AS spaced
    FROM part
    """
)
def split_digits_letters(spark, d):
    size = F.col("p_size").cast("string")
    glued = F.concat(size, F.col("p_name"), size, F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", text.split_digits_from_letters(glued).alias("spaced"))


@query(
    """
    SELECT doc_id, regexp_replace(text, '[,.] ', '') AS once, regexp_replace(text, '[,.] ', '', 'g') AS every_time,
           regexp_replace('CA.' || upper(lang), '[A-Z]{2}\\.', '') AS code
    FROM documents
    """
)
def first_only_remove(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        text.remove_first(F.col("text"), "[,.] ").alias("once"),
        text.remove_all(F.col("text"), "[,.] ").alias("every_time"),
        text.strip_country_prefix(F.concat(F.lit("CA."), F.upper("lang"))).alias("code"),
    )


@query(
    """
    SELECT doc_id,
           CASE WHEN regexp_matches(line, ', .*,') THEN regexp_extract(line, ', (.*),', 1) END AS between,
           regexp_replace(line, ',.*', '', 'g') AS before
    FROM (SELECT doc_id, replace(text, chr(10), ' ') AS line FROM documents)
    """
)
def extract_between(spark, d):
    line = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    return (
        table(spark, d, "documents")
        .select("doc_id", line.alias("line"))
        .select(
            "doc_id",
            text.between_commas(F.col("line")).alias("between"),
            text.before_comma(F.col("line")).alias("before"),
        )
    )


@query(
    """
    WITH t AS (SELECT doc_id, source || ' town ' || upper(lang) || ' x' AS place,
                      (2015 + doc_id % 5) || '-' || doc_id AS rec FROM documents)
    SELECT doc_id,
           CASE WHEN regexp_matches(place, '[A-Za-z]* ') THEN regexp_extract(place, '([A-Za-z]*) ', 1) END AS city_word,
           regexp_extract(place, '[A-Z]{2}') AS province,
           regexp_replace(place, '[A-Z]{2}', '', 'g') AS city,
           regexp_replace(rec, '2016-', '') AS bare_id,
           regexp_extract(rec, '^[0-9]{4}') AS prefix
    FROM t
    """
)
def city_province_split(spark, d):
    df = table(spark, d, "documents").select(
        "doc_id",
        F.concat(F.col("source"), F.lit(" town "), F.upper("lang"), F.lit(" x")).alias("place"),
        F.concat((F.col("doc_id") % 5 + 2015).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("rec"),
    )
    place, rec = F.col("place"), F.col("rec")
    return df.select(
        "doc_id",
        text.leading_word(place).alias("city_word"),
        text.province_code(place).alias("province"),
        text.without_province(place).alias("city"),
        text.strip_year_prefix(rec, 2016).alias("bare_id"),
        text.extract(rec, "^[0-9]{4}").alias("prefix"),
    )


@query(
    """
    SELECT event_id, strftime(ts, '%H') AS hour_text, strftime(ts, '%H:%M') AS hour_minute,
           CAST(strftime(ts, '%H') || '-' || strftime(ts, '%M') AS VARCHAR) AS comment,
           regexp_extract(strftime(ts, '%H%M') || '-' || lpad(CAST(hour(ts + INTERVAL 8 HOUR) AS VARCHAR), 2, '0'), '-([0-9]{2})', 1) AS end_hour
    FROM events
    """
)
def hour_extract(spark, d):
    ts = F.col("ts")
    stamp = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    later = ts + F.expr("INTERVAL 8 HOUR")
    comment = F.concat(F.date_format(ts, "HHmm"), F.lit("-"), F.date_format(later, "HH"))
    return table(spark, d, "events").select(
        "event_id",
        text.extract(stamp, "[0-9]{2}(?=:[0-9]{2}:[0-9]{2})").alias("hour_text"),
        clock.hour_minute(ts).alias("hour_minute"),
        F.date_format(ts, "HH-mm").alias("comment"),
        text.extract(comment, "(?<=-)[0-9]{2}").alias("end_hour"),
    )


@query(
    """
    SELECT event_id, try_cast(raw AS DOUBLE) AS number, CAST(floor(try_cast(raw AS DOUBLE)) AS BIGINT) AS whole
    FROM (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'n/a' WHEN event_id % 13 = 0 THEN NULL
                 ELSE regexp_extract(props, '[0-9]+') || '.25' END AS raw FROM events)
    """
)
def safe_number(spark, d):
    number = F.concat(text.extract(F.col("props"), "[0-9]+"), F.lit(".25"))
    raw = F.when(F.col("event_id") % 11 == 0, "n/a").when(F.col("event_id") % 13 == 0, None).otherwise(number)
    return (
        table(spark, d, "events")
        .select("event_id", raw.alias("raw"))
        .select("event_id", text.to_number(F.col("raw")).alias("number"), text.whole_number(F.col("raw")).alias("whole"))
    )
