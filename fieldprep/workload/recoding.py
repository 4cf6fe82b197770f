"""Recoding and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldprep.functions import recode
from fieldprep.operators import columns as cols
from fieldprep.operators.joins import null_safe_join, override_by_membership
from fieldprep.plans.fixed_values import REGION_NAMES
from fieldprep.workload.registry import query, table


@query(
    """
    SELECT o_orderkey,
           CASE WHEN regexp_matches(o_orderpriority, '^1') THEN 'now'
                WHEN regexp_matches(o_orderpriority, 'HIGH|MEDIUM') THEN 'soon'
                WHEN regexp_matches(o_orderpriority, '[A-Z]+ [A-Z]+') THEN 'open'
                WHEN regexp_matches(o_orderpriority, 'SPEC') THEN 'never'
                ELSE o_orderpriority END AS urgency
    FROM orders
    """
)
def recode_first_match(spark, d):
    rules = [("^1", "now"), ("HIGH|MEDIUM", "soon"), ("[A-Z]+ [A-Z]+", "open"), ("SPEC", "never")]
    return table(spark, d, "orders").select(
        "o_orderkey", recode.recode_first_match(F.col("o_orderpriority"), rules).alias("urgency")
    )


@query(
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN 'visit' WHEN 'view' THEN 'visit'
                           WHEN 'purchase' THEN 'sale' ELSE event_type END AS activity
    FROM events
    """
)
def recode_exact(spark, d):
    mapping = {"click": "visit", "view": "visit", "purchase": "sale"}
    return table(spark, d, "events").select(
        "event_id", recode.recode_exact(F.col("event_type"), mapping).alias("activity")
    )


# Fixed values, stated once more so that a wrong or lost rule of the library shows.
_REGIONS_SQL = """CASE
                WHEN contains(place, 'Ontario') THEN 'ON'
                WHEN contains(place, 'British') THEN 'BC'
                WHEN contains(place, 'Alberta') THEN 'AB'
                WHEN contains(place, 'Indiana') THEN 'IN'
                WHEN contains(place, 'Manitoba') THEN 'MB'
                WHEN contains(place, 'Washington') THEN 'WA'
                WHEN contains(place, 'Califor') THEN 'CA'
                WHEN contains(place, 'Sask') THEN 'SK'
                WHEN contains(place, 'Oregon') THEN 'OR'
                WHEN contains(place, 'Nova') THEN 'NS'
                WHEN contains(place, 'Montana') THEN 'MT'
                WHEN contains(place, 'Idaho') THEN 'ID'
                WHEN contains(place, 'Nebraska') THEN 'NE'
                WHEN contains(place, 'Colorado') THEN 'CO'
                WHEN contains(place, 'Minnesota') THEN 'MN'
                WHEN contains(place, 'Texas') THEN 'TX'
                WHEN contains(place, 'Alaska') THEN 'AK'
                WHEN contains(place, 'New York') THEN 'NY'
                WHEN contains(place, 'North Dakota') THEN 'ND'
                WHEN contains(place, 'Tennessee') THEN 'TN'
                WHEN contains(place, 'Michigan') THEN 'MI'
                WHEN contains(place, 'Nevada') THEN 'NV'
                WHEN contains(place, 'Florida') THEN 'FL'
                WHEN contains(place, 'Quebec') THEN 'QC'
                WHEN contains(place, 'South Dakota') THEN 'SD'
                WHEN contains(place, 'West Virginia') THEN 'WV'
                WHEN contains(place, 'Arizona') THEN 'AZ'
                WHEN contains(place, 'Wyoming') THEN 'WY'
                ELSE place END"""
# fmt: off
_PLACES = [
    "Ontario", "British", "Alberta", "Indiana", "Manitoba", "Washington", "Califor", "Sask",
    "Oregon", "Nova", "Montana", "Idaho", "Nebraska", "Colorado", "Minnesota", "Texas",
    "Alaska", "New York", "North Dakota", "Tennessee", "Michigan", "Nevada", "Florida", "Quebec",
    "South Dakota", "West Virginia", "Arizona", "Wyoming",
    "Baja", "North Idaho Ontario", "ontario",
]
# fmt: on


@query(
    f"""
    WITH p AS (SELECT c_custkey,
                      'State of ' || ({_PLACES!r})[CAST((c_custkey * 7 + c_nationkey) % {len(_PLACES)} AS INTEGER) + 1]
                      || ', area ' || c_nationkey AS place
               FROM customer)
    SELECT c_custkey, {_REGIONS_SQL} AS region FROM p
    """
)
def abbreviate_region(spark, d):
    names = F.array(*[F.lit(p) for p in _PLACES])
    pick = F.get(names, ((F.col("c_custkey") * 7 + F.col("c_nationkey")) % len(_PLACES)).cast("int"))
    place = F.concat(F.lit("State of "), pick, F.lit(", area "), F.col("c_nationkey").cast("string"))
    return (
        table(spark, d, "customer")
        .select("c_custkey", place.alias("place"))
        .select("c_custkey", recode.recode_contains(F.col("place"), REGION_NAMES).alias("region"))
    )


def _labelled(spark, d):
    """Documents with label flags in mixed spellings; documents without a label have NULL."""
    labels = table(spark, d, "labels")
    flag = lambda c: (
        F.when((F.col(c) == 1) & (F.col("doc_id") % 2 == 0), "TRUE")
        .when(F.col(c) == 1, "true")
        .when(F.col("doc_id") % 3 == 0, "FALSE")
        .otherwise("false")
    )
    texts = labels.select("doc_id", flag("quality").alias("Quality_Ind"), flag("toxic").alias("toxic_ind"))
    return table(spark, d, "documents").select("doc_id").join(texts, "doc_id", "left")


_LABELLED_SQL = """
    WITH f AS (
      SELECT doc_id,
             CASE WHEN quality = 1 AND doc_id % 2 = 0 THEN 'TRUE' WHEN quality = 1 THEN 'true'
                  WHEN doc_id % 3 = 0 THEN 'FALSE' ELSE 'false' END AS q,
             CASE WHEN toxic = 1 AND doc_id % 2 = 0 THEN 'TRUE' WHEN toxic = 1 THEN 'true'
                  WHEN doc_id % 3 = 0 THEN 'FALSE' ELSE 'false' END AS t
      FROM labels),
    l AS (SELECT documents.doc_id, q, t FROM documents LEFT JOIN f USING (doc_id))
"""


@query(
    _LABELLED_SQL
    + """
    SELECT doc_id, coalesce(lower(q), 'false') AS quality_text, coalesce(lower(t), 'false') AS toxic_text FROM l
    """
)
def text_boolean_normalise(spark, d):
    return _labelled(spark, d).select(
        "doc_id",
        recode.normalise_flag_text(F.col("Quality_Ind")).alias("quality_text"),
        recode.normalise_flag_text(F.col("toxic_ind")).alias("toxic_text"),
    )


@query(
    _LABELLED_SQL
    + """
    SELECT doc_id, lower(q) = 'true' AS "Quality_Ind", lower(t) = 'true' AS toxic_ind,
           coalesce(q IN ('TRUE', 'true'), false) OR coalesce(t IN ('TRUE', 'true'), false) AS either
    FROM l
    """
)
def flags_to_boolean(spark, d):
    df = _labelled(spark, d).withColumn("either", recode.either_flag(F.col("Quality_Ind"), F.col("toxic_ind")))
    return cols.apply_to_columns(df, recode.flag_text_to_boolean, suffix="Ind")


@query(
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS answer,
           CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS answered_yes
    FROM orders
    """
)
def yes_no_map(spark, d):
    asked = table(spark, d, "orders").withColumn(
        "said", recode.recode_exact(F.col("o_orderstatus"), {"F": "yes", "O": "no", "P": "maybe"})
    )
    return asked.select(
        "o_orderkey",
        recode.yes_no(F.col("said")).alias("answer"),
        recode.flag_text(F.col("said") == "yes").alias("answered_yes"),
    )


@query(
    """
    SELECT p_partkey,
           CASE WHEN p_size % 9 = 0 THEN NULL WHEN p_type = 'PROMO' THEN p_name ELSE p_type END AS kind,
           CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_name END AS kind_text
    FROM part
    """
)
def other_falls_back(spark, d):
    listed = F.when(F.col("p_size") % 9 != 0, recode.replace_value(F.col("p_type"), "PROMO", "Other"))
    return (
        table(spark, d, "part")
        .select("p_partkey", "p_name", listed.alias("choice"))
        .select(
            "p_partkey",
            recode.other_to_text(F.col("choice"), F.col("p_name")).alias("kind"),
            recode.other_to_text(F.col("choice"), F.col("p_name"), always_text=True).alias("kind_text"),
        )
    )


@query(
    """
    WITH j AS (
      SELECT l_orderkey, l_linenumber, l_partkey,
             CASE WHEN l_linenumber = 1 THEN 'Other' WHEN l_linenumber = 2 THEN NULL
                  ELSE 'City ' || l_suppkey || ', far away' END AS closest,
             CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'Major ' || l_linestatus || ', x' END AS major,
             CASE WHEN p_size > 25 THEN p_name END AS name,
             CASE WHEN p_type = 'SMALL' THEN 'Region ' || p_size END AS region,
             l_discount > 0.05 AS outside, l_tax > 0.05 AS unknown_toggle
      FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
    k AS (SELECT *, CASE WHEN closest IS NOT NULL AND closest <> 'Other' THEN closest ELSE major END AS chosen FROM j)
    SELECT l_orderkey, l_linenumber, l_partkey,
           regexp_replace(coalesce(chosen, 'Unknown'), ',.*', '') AS city,
           CASE WHEN name IS NOT NULL THEN name WHEN region IS NOT NULL THEN region
                WHEN outside THEN 'Outside BC' WHEN unknown_toggle THEN 'Unknown (Toggle)' ELSE 'Unknown' END AS dest_year,
           CASE WHEN name IS NOT NULL THEN name WHEN region IS NOT NULL THEN region
                WHEN outside THEN 'Outside BC' ELSE 'Unknown' END AS dest_all
    FROM k
    """
)
def cascade_classify(spark, d):
    from fieldprep.plans.reports import city_name, destination_region

    part = table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_type")
    rows = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    rows = rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(line == 1, "Other")
        .when(line != 2, F.concat(F.lit("City "), F.col("l_suppkey").cast("string"), F.lit(", far away")))
        .alias("closest"),
        F.when(flag != "R", F.concat(F.lit("Major "), F.col("l_linestatus"), F.lit(", x"))).alias("major"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("name"),
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("Region "), F.col("p_size").cast("string"))).alias("region"),
        (F.col("l_discount") > 0.05).alias("outside"),
        (F.col("l_tax") > 0.05).alias("toggle"),
    )
    region = lambda toggle: destination_region(
        F.col("name"), F.col("region"), F.col("outside"), F.lit(False), F.col("toggle") if toggle else None
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        city_name(F.col("closest"), F.col("major")).alias("city"),
        region(True).alias("dest_year"),
        region(False).alias("dest_all"),
    )


@query(
    """
    WITH s AS (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 9000),
    a AS (SELECT c_custkey, c_mktsegment,
                 CASE WHEN c_nationkey IN (SELECT s_nationkey FROM s) OR c_mktsegment IN ('BUILDING', 'MACHINERY')
                      THEN 'BC' WHEN c_nationkey % 2 = 0 THEN NULL ELSE 'N' || c_nationkey END AS province
          FROM customer)
    SELECT c_custkey, province,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Pacific Ocean' ELSE c_mktsegment END AS place
    FROM a
    """
)
def override_by_membership_sets(spark, d):
    from fieldprep.operators.joins import flag_membership

    known = table(spark, d, "supplier").filter(F.col("s_acctbal") > 9000).select("s_nationkey")
    df = table(spark, d, "customer").select(
        "c_custkey",
        "c_nationkey",
        F.col("c_mktsegment").alias("city"),
        F.col("c_mktsegment").alias("place"),
        F.when(F.col("c_nationkey") % 2 != 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("province"),
    )
    df = flag_membership(df, known, [("c_nationkey", "s_nationkey")], "known")
    changed = override_by_membership(
        df,
        [
            (F.col("known"), "province", "BC"),
            (recode.in_set(F.col("city"), ["BUILDING", "MACHINERY"]), "province", "BC"),
            (recode.in_set(F.col("city"), ["MACHINERY"]), "place", "Pacific Ocean"),
        ],
    )
    return changed.select("c_custkey", "province", "place")


@query(
    """
    SELECT c_custkey, 'N' || n_regionkey AS province,
           CASE WHEN 'N' || n_regionkey IN ('N0', 'N2') THEN 'CAN' ELSE 'USA' END AS country,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'amount ' || c_custkey ELSE '0' END AS building_count,
           r_name || '/' || (CASE WHEN 'N' || n_regionkey IN ('N0', 'N2') THEN 'CAN' ELSE 'USA' END) AS label
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """
)
def derived_after_derived(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, d, "region")
    df = table(spark, d, "customer")
    df = null_safe_join(df, nation, [("c_nationkey", "n_nationkey")])
    df = null_safe_join(df, region, [("n_regionkey", "r_regionkey")])
    df = cols.derive_in_order(
        df,
        [
            {"province": F.concat(F.lit("N"), F.col("n_regionkey").cast("string"))},
            {"country": recode.class_of(F.col("province"), ["N0", "N2"], "CAN", "USA")},
            {
                "label": F.concat_ws("/", "r_name", "country"),
                "building_count": recode.value_if(
                    F.col("c_mktsegment"), "BUILDING", F.concat(F.lit("amount "), F.col("c_custkey").cast("string"))
                ),
            },
        ],
    )
    return df.select("c_custkey", "province", "country", "building_count", "label")


@query(
    """
    SELECT c_custkey, o_orderkey, o_orderkey IS NULL AND o_orderstatus IS NULL AS unknown_source,
           coalesce(o_orderstatus <> 'F' OR o_orderpriority = '5-LOW', false) AS not_ours,
           coalesce(o_orderstatus = 'P' OR c_mktsegment = 'BUILDING', false) AS storage,
           coalesce(contains(o_orderpriority, 'SPEC'), false) AS ocean,
           coalesce(o_orderpriority, 'none') AS filled,
           coalesce(o_orderstatus, c_mktsegment) AS first_known
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    """
)
def null_chain_flags(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    df = table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    status, priority, segment = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("c_mktsegment")
    return df.select(
        "c_custkey",
        "o_orderkey",
        recode.all_missing(F.col("o_orderkey"), status).alias("unknown_source"),
        recode.holds((status != "F") | (priority == "5-LOW")).alias("not_ours"),
        recode.holds((status == "P") | (segment == "BUILDING")).alias("storage"),
        recode.holds(priority.contains("SPEC")).alias("ocean"),
        F.coalesce(priority, F.lit("none")).alias("filled"),
        F.coalesce(status, segment).alias("first_known"),
    )


@query(
    """
    WITH s AS (
      SELECT doc_id,
             CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN 'Unknown' ELSE 'P_' || lang END AS source_place,
             CASE WHEN doc_id % 3 = 0 THEN 'None' WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'Town'
                  ELSE 'Town, ' || source || ', Land, CAN' END AS major,
             'H_' || source AS home
      FROM documents),
    r AS (SELECT *, CASE WHEN source_place IS NOT NULL AND source_place <> 'Unknown' THEN source_place
                         WHEN major IS NOT NULL AND major <> 'None' THEN major ELSE home END AS raw FROM s),
    e AS (SELECT doc_id, CASE WHEN regexp_matches(raw, ',.*,') THEN regexp_extract(raw, ', (.*),', 1) ELSE raw END AS place FROM r)
    SELECT doc_id, coalesce(CASE place WHEN 'H_src1' THEN 'S1' WHEN 'src2, Land' THEN 'S2' END, place) AS resolved,
           CASE WHEN regexp_matches(place, '[o,O]cean|src1') THEN 'Pacific Ocean' ELSE place END AS water
    FROM e
    """
)
def resolve_source(spark, d):
    from fieldprep.operators.joins import recode_by_lookup
    from fieldprep.operators.reshape import literal_rows
    from fieldprep.plans.cleaning import resolved_source

    doc, src = F.col("doc_id"), F.col("source")
    df = table(spark, d, "documents").select(
        "doc_id",
        F.when(doc % 4 == 0, None).when(doc % 4 == 1, "Unknown").otherwise(F.concat(F.lit("P_"), "lang")).alias("place"),
        F.when(doc % 3 == 0, "None")
        .when(doc % 7 == 0, None)
        .when(doc % 5 == 0, "Town")
        .otherwise(F.concat(F.lit("Town, "), src, F.lit(", Land, CAN")))
        .alias("major"),
        F.concat(F.lit("H_"), src).alias("home"),
    )
    df = df.withColumn("resolved", resolved_source(F.col("place"), F.col("major"), F.col("home")))
    df = df.withColumn("water", recode.recode_first_match(F.col("resolved"), [("[o,O]cean|src1", "Pacific Ocean")]))
    codes = literal_rows(spark, "name string, code string", [("H_src1", "S1"), ("src2, Land", "S2")])
    return recode_by_lookup(df, "resolved", codes, "name", "code").select("doc_id", "resolved", "water")
