"""Sources, sinks, caches and the incremental append."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldprep.operators.reshape import union_by_name
from fieldprep.sources import readers, sinks
from fieldprep.streaming.append import append_stream
from fieldprep.session import shared_folder
from fieldprep.workload.registry import query, table


def scratch(spark) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex[:12]}"


def one_file(lines, path: str) -> None:
    """Lines (one text column) as one file of this name, in their order of ``at``."""
    spark = lines.sparkSession
    beside = f"{path}.writing"
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.text(beside)
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(beside)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith("part-"))
    files.rename(part, hadoop.Path(path))


#: Files that a hand-made table is dealt to; each is written by a task of its own.
FILES = 8


def titled_files(records, title: str | None, header: str, folder: str) -> list[str]:
    """The paths of files that begin with a title, if there is one, and a header, the records (at, value) dealt to them."""
    spark = records.sparkSession
    dealt = records.select("at", "value", F.pmod(F.xxhash64("at"), F.lit(FILES)).cast("int").alias("file"))
    top = [(n - 2, line, k) for k in range(FILES) for n, line in enumerate((title, header)) if line is not None]
    lines = spark.createDataFrame(top, "at bigint, value string, file int").unionByName(dealt)
    lines.repartition("file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").text(folder)
    return [f"{folder}/file={k}" for k in range(FILES)]


def quoted(cell):
    return F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))


def titled(spark, df, title: str, header: str):
    """The lines of a titled table: title, header, and one record per row of ``df`` (at, value)."""
    top = spark.createDataFrame([(-2, title), (-1, header)], "at bigint, value string")
    return top.unionByName(df.select("at", "value"))


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text_md5, lang, 'NA' AS note, CAST(NULL AS VARCHAR) AS text_5 FROM documents
    UNION ALL SELECT 'doc_id', md5('text'), 'lang', 'note', 'text'
    """
)
def read_titled_tables(spark, d):
    """A titled table with line breaks and quotes in its cells, padded cells, a repeated header and a record like the header."""
    base = scratch(spark)
    docs = table(spark, d, "documents")
    value = F.concat(F.col("doc_id"), F.lit(","), quoted(F.col("text")), F.lit(",  "), F.col("lang"), F.lit("  ,NA,"))
    records = docs.select(F.col("doc_id").alias("at"), value.alias("value"))
    like_header = spark.createDataFrame([(0, "doc_id,text,lang,note,text")], "at bigint, value string")
    paths = titled_files(records.unionByName(like_header), "Inspections, all stations", "doc_id,text,lang,note,text", f"{base}/raw")
    read = union_by_name(list(readers.read_year_tables(spark, dict(enumerate(paths))).values()))
    second = read.columns[4]
    return read.select("doc_id", F.md5(F.col(f"`{read.columns[1]}`").cast("binary")).alias("text_md5"), "lang", "note", F.col(f"`{second}`").alias("text_5"))


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS text_md5, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang,
           CASE WHEN doc_id % 2 = 0 THEN 2020 ELSE 2021 END AS "Year" FROM documents
    """
)
def read_extract_files(spark, d):
    """Extracts of two years with headers in another order, NA for a missing cell, other files beside them."""
    base = scratch(spark)
    lang = F.when(F.col("lang") == "en", "NA").otherwise(F.col("lang"))
    docs = table(spark, d, "documents").withColumn("shown", lang)
    forms = {
        "metabase_1.csv": ("doc_id,text,lang", ["doc_id", quoted(F.col("text")), "shown"], "doc_id % 2 = 0"),
        "metabase_2.csv": ("lang,doc_id,text", ["shown", "doc_id", quoted(F.col("text"))], "doc_id % 2 = 1"),
        "notes.csv": ("doc_id,text,lang", ["doc_id", F.lit("x"), "shown"], "doc_id >= 0"),
    }
    for name, (header, cells, rows) in forms.items():
        records = docs.filter(rows).select(F.col("doc_id").alias("at"), F.concat_ws(",", *cells).alias("value"))
        top = spark.createDataFrame([(-1, header)], "at bigint, value string")
        one_file(top.unionByName(records), f"{base}/extracts/{name}")
    read = readers.read_extracts(spark, f"{base}/extracts")
    return read.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "lang", "Year")


@query(
    """
    SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(0 AS BIGINT) AS out_of_order FROM orders
    """
)
def write_in_order(spark, d):
    """A table sorted once at the sink: each stored file ends where the next one begins."""
    path = f"{scratch(spark)}/ordered"
    sinks.write_ordered(table(spark, d, "orders"), path, [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    files = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    )
    # One row per file.
    before = F.min("low").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    marked = files.withColumn("bad", F.col("high") > before)
    return marked.agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"), F.count_if("bad").alias("out_of_order"))


@query(
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal >= 9000 THEN 1 END AS list,
           CASE WHEN c_acctbal < 0 OR c_acctbal >= 9000 THEN c_mktsegment END AS said FROM customer
    """
)
def read_key_lists(spark, d):
    """Hand-kept lists, one titled and one plain, read, brought to one key column and met with all records."""
    base = scratch(spark)
    customers = table(spark, d, "customer")
    value = F.concat(F.lit(" "), F.col("c_custkey"), F.lit(' ,"said ""'), F.col("c_mktsegment"), F.lit('"""'))
    lists = {0: ("Debts, 2020", customers.filter("c_acctbal < 0")), 1: (None, customers.filter("c_acctbal >= 9000"))}
    read = []
    for n, (title, rows) in lists.items():
        records = rows.select(F.col("c_custkey").alias("at"), value.alias("value"))
        for path in titled_files(records, title, "Watercraft Risk Assessment ID,Remark", f"{base}/{n}"):
            read.append((n, readers.read_key_list(spark, path, "titled_csv" if title else "csv")))
    said = lambda df: F.regexp_extract(F.col(f"`{df.columns[1]}`"), '^said "(.*)"$', 1)
    key = lambda df: F.col(f"`{df.columns[0]}`").cast("bigint")
    listed = union_by_name([df.select(key(df).alias("c_custkey"), F.lit(n).alias("list"), said(df).alias("said")) for n, df in read])
    return customers.select("c_custkey").join(listed, "c_custkey", "left")


@query(
    """
    SELECT o_orderstatus, CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
    FROM orders GROUP BY ALL
    """
)
def sink_round_trip(spark, d):
    """Text extracts with differing headers written, listed, read back with a year each, stored once and reused."""
    base = scratch(spark)
    orders = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    early, late = orders.filter("year < 1999"), orders.filter("year >= 1999")
    sinks.write_table(early.select("o_orderkey", "o_orderstatus", "year"), f"{base}/raw/metabase_1.csv", "csv")
    sinks.write_table(late.select("year", "o_orderstatus", "o_orderkey"), f"{base}/raw/metabase_2.csv", "csv")
    texts = [readers.read_lookup(spark, f"{base}/raw/metabase_{i}.csv") for i in (1, 2)]
    stored = sinks.read_or_build(spark, f"{base}/all", lambda: union_by_name(texts))
    again = sinks.read_or_build(spark, f"{base}/all", lambda: stored.limit(0))
    return again.groupBy("o_orderstatus", "year").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_orderkey").cast("bigint")).alias("keys")
    )


@query(
    """
    WITH e AS (SELECT event_type, user_id, strftime(ts, '%Y-%m-%d') AS day, min(event_id) AS event_id FROM events GROUP BY ALL)
    SELECT event_type, day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM e GROUP BY ALL
    """
)
def stream_append(spark, d):
    """The events as arriving files: first of a key kept, appended by day, replayed without effect."""
    base = scratch(spark)
    schema = table(spark, d, "events").schema

    def clean(batch):
        return batch.select("event_id", "event_type", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))

    for replay in ("first", "again"):
        append_stream(
            spark,
            d,
            schema,
            clean,
            f"{base}/table",
            ["user_id", "event_type", "day"],
            "day",
            f"{base}/checkpoint-{replay}",
            fmt="parquet",
            glob="events.parquet",
        ).awaitTermination()
    stored = spark.read.schema("event_id bigint, event_type string, user_id bigint, day string").parquet(f"{base}/table")
    return stored.groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))
