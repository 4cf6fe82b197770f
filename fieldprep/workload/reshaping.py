"""Unions, stacking, unpivoting, schema mapping, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldprep.operators import columns as cols
from fieldprep.operators import reshape
from fieldprep.plans.schema_map import Rule, copy, country, is_yes, map_schema
from fieldprep.session import cut_lineage
from fieldprep.sources.sinks import counted
from fieldprep.workload.registry import query, table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    """
    SELECT * FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, measure, least(amount, 1) AS amount FROM (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS measure,
               unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS amount FROM lineitem))
    WHERE amount > 0
    """
)
def unpivot_capped(spark, d):
    return reshape.unpivot_capped(
        table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], MEASURES, "measure", "amount"
    )


@query(
    """
    WITH p AS (SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS n1, p_type AS c1,
                      CASE WHEN p_size % 4 <> 0 THEN p_name END AS n2, CASE WHEN p_size % 5 <> 0 THEN p_type END AS c2,
                      CASE WHEN p_size % 2 <> 0 THEN p_type END AS n3, CASE WHEN p_size % 7 <> 0 THEN p_brand END AS c3 FROM part)
    SELECT p_partkey, 1 AS slot, n1 AS name, c1 AS city FROM p
    UNION ALL SELECT p_partkey, 2, n2, c2 FROM p WHERE n2 IS NOT NULL
    UNION ALL SELECT p_partkey, 3, n3, c3 FROM p WHERE n3 IS NOT NULL AND c3 IS NOT NULL
    """
)
def stack_slots(spark, d):
    unless = lambda k, c: F.when(F.col("p_size") % k != 0, F.col(c))
    slots = [
        {"name": unless(3, "p_brand"), "city": F.col("p_type")},
        {"name": unless(4, "p_name"), "city": unless(5, "p_type")},
        {"name": unless(2, "p_type"), "city": unless(7, "p_brand")},
    ]
    return reshape.stack_slots(
        table(spark, d, "part"), ["p_partkey"], slots, [(), ("name",), ("name", "city")], slot_column="slot"
    )


@query(
    """
    SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance, NULL AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    """
)
def union_by_name(spark, d):
    suppliers = table(spark, d, "supplier").toDF("id", "name", "nation", "balance")
    customers = table(spark, d, "customer").toDF("id", "name", "nation", "balance", "segment")
    return reshape.union_by_name([suppliers, customers])


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_tax FROM lineitem")
def distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_tax").distinct()


@query(
    """
    SELECT s_suppkey, s_name FROM supplier
    UNION ALL SELECT * FROM (VALUES (CAST(-1 AS BIGINT), 'Pacific Ocean'), (CAST(-2 AS BIGINT), 'Dry Storage'))
    """
)
def append_literals(spark, d):
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_name")
    return reshape.append_rows(suppliers, "s_suppkey bigint, s_name string", [(-1, "Pacific Ocean"), (-2, "Dry Storage")])


@query(
    """
    SELECT p_partkey, split_part(t, ',', 1) AS t1, CASE WHEN n > 1 THEN split_part(t, ',', 2) END AS t2,
           CASE WHEN n > 2 THEN split_part(t, ',', 3) END AS t3
    FROM (SELECT p_partkey, t, length(t) - length(replace(t, ',', '')) + 1 AS n FROM
          (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN p_type WHEN 1 THEN p_type || ',' || p_name
                  WHEN 2 THEN p_type || ',,' || p_brand ELSE p_type || ', ' || p_name || ',' || p_brand || ',x' END AS t FROM part))
    """
)
def split_to_columns(spark, d):
    k, kind = F.col("p_size") % 4, F.col("p_type")
    cell = (
        F.when(k == 0, kind)
        .when(k == 1, F.concat_ws(",", kind, "p_name"))
        .when(k == 2, F.concat_ws(",", kind, F.lit(""), "p_brand"))
        .otherwise(F.concat_ws(",", kind, F.concat(F.lit(" "), "p_name"), "p_brand", F.lit("x")))
    )
    return reshape.split_to_columns(
        table(spark, d, "part").select("p_partkey", cell.alias("t")), "t", ["t1", "t2", "t3"]
    )


@query(
    """
    SELECT 1 AS "Year", o_orderkey AS "ID", strftime(o_orderdate, '%Y-%m-%d') AS "Start_Date",
           CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS "Done_Ind",
           NULL AS "Country_Code", NULL AS "Name", o_totalprice AS amount_total FROM orders
    UNION ALL
    SELECT 2, c_custkey, NULL, NULL, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CAN' ELSE 'USA' END, c_name, c_acctbal FROM customer
    """
)
def schema_map(spark, d):
    """Two tables of different shape under one schema: headers cleaned, rules applied, united."""
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("Order ID#"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Start/Date"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("Is it done?"),
        F.col("o_totalprice").alias("Amount"),
        F.col("o_orderpriority").alias("Amount"),
    )
    orders = orders.toDF(*cols.repair_duplicate_names(orders.columns))
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Customer ID"),
        F.col("c_name").alias("Name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "BC").otherwise(F.col("c_mktsegment")).alias("Destination Province/State"),
        F.col("c_acctbal").alias("Balance"),
    )
    schema = {
        "ID": {1: Rule(copy, ("Order_ID",)), 2: Rule(copy, ("Customer_ID",))},
        "Start_Date": {1: Rule(copy, ("Start_Date",))},
        "Done_Ind": {1: Rule(is_yes, ("Is_it_done",))},
        "Country_Code": {2: Rule(country, (cols.PROVINCE_HEADER,))},
        "Name": {2: Rule(copy, ("Name",))},
        "AmountTotal": {1: Rule(copy, ("Amount...4",)), 2: Rule(copy, ("Balance",))},
    }
    mapped = [map_schema(cols.clean_column_names(df), schema, y) for y, df in ((1, orders), (2, customers))]
    df = reshape.union_by_name(mapped)
    df = df.withColumnRenamed("AmountTotal", cols.snake_name("AmountTotal"))
    return cols.select_once(cols.move_first(df, "ID", "Year"), [*df.columns, "ID"])


@query(
    """
    SELECT l_suppkey, n, row_number() OVER (ORDER BY n DESC, l_suppkey) AS place
    FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey)
    """
)
def ordered_output(spark, d):
    """A report in order of size: the only sort is the last step, and it is a range partitioning."""
    from fieldprep.operators.windows import number_rows

    counts = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return number_rows(counts, [F.col("n").desc(), F.col("l_suppkey")], alias="place").orderBy("place")


@query(
    """
    SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders) AS "rows",
           (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS urgent
    FROM orders GROUP BY o_orderstatus
    """
)
def observed_counts(spark, d):
    """Row counts taken while the table is aggregated, without a second pass."""
    orders, seen = counted(table(spark, d, "orders"), "orders", urgent=F.col("o_orderpriority") == "1-URGENT")
    counts = cut_lineage(orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))
    metrics = seen.get
    return counts.withColumns({"rows": F.lit(metrics["rows"]), "urgent": F.lit(metrics["urgent"])})
