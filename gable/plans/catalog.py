"""Registered queries over the driver tables, each with its DuckDB oracle.

Every query reads whole tables from ``sf_dir`` (no id subsets, no row caps;
the only ``limit`` is the top-k report), so its work grows with the data.
The SQL twin computes the same rows with the same column names; money
averages go through exact decimal sums in both engines, and statistics that
depend on summation order are rounded in both.

Queries without an SQL twin (MLlib fits, iterative searches) are listed in
``QUERIES`` only and get the driver's rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gable.operators import columns as cols_
from gable.operators import encode, fitting, joins, metrics, quality, split
from gable.functions import codes, text
from gable.sources.files import stage_audit

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# md5 split bucket, identical in both engines
def _bucket_sql(key_sql: str, salt: str, mod: int = 100) -> str:
    return f"(('0x' || substr(md5({key_sql} || ':{salt}'), 1, 8))::BIGINT % {mod})"


_ORDER_BUCKET = _bucket_sql("CAST(o_orderkey AS VARCHAR)", "42")
_SPLIT_SQL = (f"CASE WHEN {_ORDER_BUCKET} < 70 THEN 'train' "
              f"WHEN {_ORDER_BUCKET} < 85 THEN 'val' ELSE 'test' END")


def _orders_split(spark, d):
    return split.assign_split(table(spark, d, "orders"), "o_orderkey", (0.70, 0.15, 0.15), seed=42)


# ---------------------------------------------------------------------------
# Smoothed target encoding (minimum slice)
# ---------------------------------------------------------------------------

def _fit_order_te(spark, d):
    train = _orders_split(spark, d).where(F.col("split") == "train")
    return fitting.fit_target_encoding(
        train, ["o_orderpriority", "o_custkey"], "o_totalprice", alpha=100.0, suffix="_te",
        exact_decimal=(18, 2))


_TE_STATS_SQL = f"""
WITH s AS (SELECT *, {_SPLIT_SQL} AS split FROM orders),
train AS (SELECT * FROM s WHERE split = 'train'),
g AS (SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS gm FROM train),
st AS (
  SELECT 'o_orderpriority' AS feature, CAST(o_orderpriority AS VARCHAR) AS key, COUNT(o_totalprice) AS n,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS mean
  FROM train WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2
  UNION ALL
  SELECT 'o_custkey', CAST(o_custkey AS VARCHAR), COUNT(o_totalprice),
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice)
  FROM train WHERE o_custkey IS NOT NULL GROUP BY 1, 2
),
te AS (SELECT feature, key, n, mean,
              (n * mean + CAST(100.0 AS DOUBLE) * gm) / (n + CAST(100.0 AS DOUBLE)) AS te
       FROM st CROSS JOIN g)
"""


@register("target_encode_fit", _TE_STATS_SQL + "SELECT feature, key, n, mean, te FROM te")
def q_target_encode_fit(spark, d):
    enc = _fit_order_te(spark, d)
    return enc.table.select(F.col("column").alias("feature"), "key", "n", "mean", "te")


@register("target_encode_apply", _TE_STATS_SQL + """
SELECT s.o_orderkey, s.split,
       COALESCE(a.te, g.gm) AS o_orderpriority_te,
       COALESCE(b.te, g.gm) AS o_custkey_te
FROM s CROSS JOIN g
LEFT JOIN te a ON a.feature = 'o_orderpriority' AND a.key = CAST(s.o_orderpriority AS VARCHAR)
LEFT JOIN te b ON b.feature = 'o_custkey' AND b.key = CAST(s.o_custkey AS VARCHAR)
""")
def q_target_encode_apply(spark, d):
    enc = _fit_order_te(spark, d)
    out = enc.transform(_orders_split(spark, d))
    return out.select("o_orderkey", "split", "o_orderpriority_te", "o_custkey_te")


# ---------------------------------------------------------------------------
# shared SQL snippets (DuckDB's regexp_replace needs 'g' to replace all)
# ---------------------------------------------------------------------------

_NUM_RE = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _norm_sql(x: str) -> str:
    spaced = f"regexp_replace(lower({x}), '-', ' ', 'g')"
    return f"regexp_replace({_strip_sql(spaced)}, '\\s+', ' ', 'g')"


def _to_number_sql(x: str) -> str:
    return (f"CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '{_NUM_RE}') "
            f"THEN TRY_CAST({_strip_sql(f'CAST({x} AS VARCHAR)')} AS DOUBLE) END")


def _extract_sql(x: str, pattern: str) -> str:
    return f"nullif(regexp_extract({x}, '{pattern}', 1), '')"


# ---------------------------------------------------------------------------
# URL parts
# ---------------------------------------------------------------------------

_URL_PATTERNS = {
    "host": r"://([^/?#]+)",
    "subdomain": r"://(www|blog|m)\.",
    "lang": r"/([a-z]{2})/[0-9]",
    "page_num": r"/[a-z]{2}/([0-9]+)",
}


@register("url_extract", f"""
SELECT * FROM (
  SELECT page_id,
         {_extract_sql('url', _URL_PATTERNS['host'])} AS host,
         {_extract_sql('url', _URL_PATTERNS['subdomain'])} AS subdomain,
         {_extract_sql('url', _URL_PATTERNS['lang'])} AS lang,
         {_extract_sql('url', _URL_PATTERNS['page_num'])} AS page_num
  FROM pages)
WHERE host IS NOT NULL AND lang IS NOT NULL AND page_num IS NOT NULL
""")
def q_url_extract(spark, d):
    df = encode.extract_patterns(table(spark, d, "pages"), "url", _URL_PATTERNS)
    df = cols_.drop_null_rows(df, ["host", "lang", "page_num"])
    return df.select("page_id", *_URL_PATTERNS)


# ---------------------------------------------------------------------------
# Label normalisation and group mapping
# ---------------------------------------------------------------------------

_TYPE_GROUPS = {"Sized": ["small", "medium", "large"], "Priced": ["economy", "promo"]}
_WORD_GROUPS = {"Colour": ["red", "blue"], "Temperature": ["hot", "cold"], "Size": ["small", "large"]}


def _group_sql(x: str, groups) -> str:
    whens = " ".join(
        f"WHEN {x} IN ({', '.join(repr(v) for v in vals)}) THEN '{name}'" for name, vals in groups.items())
    return f"CASE {whens} ELSE 'Other' END"


@register("text_normalize_map", f"""
SELECT p_partkey, type_norm, {_group_sql('type_norm', _TYPE_GROUPS)} AS type_group,
       name_norm, {_group_sql('first_word', _WORD_GROUPS)} AS word_group
FROM (SELECT p_partkey, {_norm_sql('p_type')} AS type_norm, {_norm_sql('p_name')} AS name_norm,
             {_extract_sql(_norm_sql('p_name'), '^([a-z]+)')} AS first_word
      FROM part)
""")
def q_text_normalize_map(spark, d):
    df = table(spark, d, "part")
    df = encode.classify_labels(df, "p_type", "type_norm", "type_group", _TYPE_GROUPS)
    df = df.withColumn("name_norm", text.normalize_label("p_name"))
    df = df.withColumn("word_group", text.classify(text.regex_group("name_norm", "^([a-z]+)"), _WORD_GROUPS, normalize=False))
    return df.select("p_partkey", "type_norm", "type_group", "name_norm", "word_group")


# ---------------------------------------------------------------------------
# C4: yes / no
# ---------------------------------------------------------------------------

@register("yes_no_encode", f"""
SELECT o_orderkey,
       CAST(CASE WHEN lower({_strip_sql('o_orderstatus')}) = 'f' THEN 1
                 WHEN lower({_strip_sql('o_orderstatus')}) = 'o' THEN 0 END AS DOUBLE) AS status_flag
FROM orders
""")
def q_yes_no_encode(spark, d):
    df = table(spark, d, "orders").withColumnRenamed("o_orderstatus", "status_flag")
    # 1 / 0 / NULL as DOUBLE, the float column a dataframe library yields
    out = encode.encode_yes_no(df, ["status_flag"], yes="F", no="O")
    return out.select("o_orderkey", F.col("status_flag").cast("double").alias("status_flag"))


# ---------------------------------------------------------------------------
# Numbers from strings
# ---------------------------------------------------------------------------

@register("numeric_string_clean", f"""
SELECT p_partkey,
       CASE WHEN b IN ('', 'nan', 'None') THEN NULL ELSE {_to_number_sql('b')} END AS brand_num,
       {_to_number_sql('p_size')} AS size_num,
       {_to_number_sql('p_name')} AS name_num
FROM (SELECT *, {_strip_sql("replace(p_brand, 'Brand#', '')")} AS b FROM part)
""")
def q_numeric_string_clean(spark, d):
    df = table(spark, d, "part")
    return df.select(
        "p_partkey",
        text.clean_numeric_string("p_brand", remove="Brand#").alias("brand_num"),
        text.to_number("p_size").alias("size_num"),
        text.to_number("p_name").alias("name_num"),
    )


# ---------------------------------------------------------------------------
# Typed projection + conjunctive not-null filter
# ---------------------------------------------------------------------------

@register("typed_not_null_filter", f"""
SELECT * FROM (
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
         CAST({_to_number_sql(_extract_sql('props', '"k":\\s*([0-9]+)'))} AS INTEGER) AS k, value
  FROM events)
WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND k IS NOT NULL AND value IS NOT NULL
""")
def q_typed_not_null_filter(spark, d):
    df = table(spark, d, "events")
    df = df.withColumn("k", text.to_number(text.regex_group("props", r'"k":\s*([0-9]+)')))
    df = cols_.enforce_types(df, {"user_id": "string", "k": "int"})
    df = cols_.not_null_filter(df, ["event_id", "user_id", "k", "value"])
    return df.select("event_id", "user_id", "event_type", "k", "value")


# ---------------------------------------------------------------------------
# Membership filters
# ---------------------------------------------------------------------------

@register("segment_filter", """
SELECT c_custkey, c_mktsegment, nullif(c_mktsegment, 'HOUSEHOLD') AS seg2
FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
  AND NOT coalesce(nullif(c_mktsegment, 'HOUSEHOLD') IN ('MACHINERY'), false)
""")
def q_segment_filter(spark, d):
    df = table(spark, d, "customer")
    df = cols_.keep_values(df, "c_mktsegment", ["BUILDING", "MACHINERY", "HOUSEHOLD"])
    df = df.withColumn("seg2", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")))
    df = cols_.drop_values_keep_null(df, "seg2", ["MACHINERY"])
    return df.select("c_custkey", "c_mktsegment", "seg2")


# ---------------------------------------------------------------------------
# Drop / rename / numeric-only / affix / lenient select
# ---------------------------------------------------------------------------

@register("project_rename_drop", """
SELECT l_orderkey, l_linenumber, l_quantity AS qty, l_extendedprice AS price, l_discount FROM lineitem
""")
def q_project_rename_drop(spark, d):
    df = table(spark, d, "lineitem")
    df = cols_.drop_if_present(df, ["l_partkey", "l_suppkey", "no_such_column"])
    df = cols_.rename_if_present(df, {"l_quantity": "qty", "l_extendedprice": "price", "no_such_column": "x"})
    df = cols_.keep_numeric(df)
    df = cols_.drop_by_affix(df, suffixes=["_tax"])
    return cols_.select_features(df, ["l_orderkey", "l_linenumber", "qty", "price", "l_discount", "absent"], strict=False)


# ---------------------------------------------------------------------------
# Key normalisation and language fallback
# ---------------------------------------------------------------------------

@register("postal_normalize", f"""
SELECT c_custkey, name_key,
       nullif(CAST(CAST({_to_number_sql("coalesce(digits, '0')")} AS BIGINT) AS VARCHAR), '0') AS postal,
       coalesce(nullif(regexp_extract(c_name, '#0*([1-9][0-9]*)$', 1), ''), name_key) AS label
FROM (SELECT *, lower({_strip_sql('c_name')}) AS name_key, {_extract_sql('c_name', '#([0-9]+)$')} AS digits
      FROM customer)
""")
def q_postal_normalize(spark, d):
    df = table(spark, d, "customer")
    df = df.withColumns({
        "name_key": text.lower_strip("c_name"),
        "digits": text.regex_group("c_name", "#([0-9]+)$"),
    })
    return df.select(
        "c_custkey", "name_key",
        text.int_key_string("digits").alias("postal"),
        text.coalesce_blank(F.regexp_extract("c_name", "#0*([1-9][0-9]*)$", 1), "name_key").alias("label"),
    )


# ---------------------------------------------------------------------------
# Binary with missing, numeric sentinel fill (real NULLs from labels)
# ---------------------------------------------------------------------------

def _docs_labels(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang")
    return docs.join(table(spark, d, "labels"), "doc_id", "left")


@register("binary_missing_encode", """
SELECT d.doc_id,
       CAST(CASE WHEN l.quality = 1 THEN 1 WHEN l.quality = 0 THEN 0 ELSE -1 END AS INTEGER) AS quality,
       CAST(CASE WHEN l.toxic = 1 THEN 1 WHEN l.toxic = 0 THEN 0 ELSE -1 END AS INTEGER) AS toxic,
       coalesce(l.quality + l.toxic, -1) AS label_sum
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_binary_missing_encode(spark, d):
    df = _docs_labels(spark, d).withColumn("label_sum", F.col("quality") + F.col("toxic"))
    df = encode.encode_binary_with_missing(df, ["quality", "toxic"])
    df = encode.fill_sentinel(df, ["label_sum"])
    return df.select("doc_id", "quality", "toxic", "label_sum")


# ---------------------------------------------------------------------------
# Missing category, ordinal maps (one label unmapped), default -1
# ---------------------------------------------------------------------------

_PRIORITY_MAP = {"Missing": -1, "1-URGENT": 4, "2-HIGH": 3, "4-NOT SPECIFIED": -1}
_STATUS_MAP = {"F": 1, "O": 0}


@register("ordinal_encode", """
SELECT o_orderkey,
       CAST(CASE coalesce(nullif(o_orderpriority, '3-MEDIUM'), 'Missing')
            WHEN 'Missing' THEN -1 WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '4-NOT SPECIFIED' THEN -1
            END AS DOUBLE) AS priority,
       CAST(coalesce(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END, -1) AS INTEGER) AS status
FROM orders
""")
def q_ordinal_encode(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priority"),
        F.col("o_orderstatus").alias("status"))
    df = encode.fill_category(df, ["priority"])
    df = encode.ordinal_encode(df, "priority", _PRIORITY_MAP)
    df = encode.ordinal_encode(df, "status", _STATUS_MAP, missing_label=None, default=-1)
    # an unmapped label is NULL, so the code column is DOUBLE (as with NaN)
    return df.withColumn("priority", F.col("priority").cast("double"))


# ---------------------------------------------------------------------------
# Drop one value (NULL kept), remap others
# ---------------------------------------------------------------------------

@register("value_remap", """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE l_returnflag END AS flag
FROM lineitem WHERE NOT coalesce(l_returnflag IN ('N'), false)
""")
def q_value_remap(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"))
    return encode.remap_values(df, "flag", drop=["N"], remaps=[{"A": "accepted"}, {"R": "returned"}])


# ---------------------------------------------------------------------------
# Missing flags then sentinel -> NULL
# ---------------------------------------------------------------------------

@register("missing_flags", """
WITH e AS (
  SELECT d.doc_id,
         CASE WHEN l.quality = 1 THEN 1 WHEN l.quality = 0 THEN 0 ELSE -1 END AS q,
         CASE WHEN l.toxic = 1 THEN 1 WHEN l.toxic = 0 THEN 0 ELSE -1 END AS t
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, CAST(nullif(q, -1) AS DOUBLE) AS quality, CAST(nullif(t, -1) AS DOUBLE) AS toxic,
       CAST(coalesce(q = -1, false) AS INTEGER) AS quality_missing,
       CAST(coalesce(t = -1, false) AS INTEGER) AS toxic_missing
FROM e
""")
def q_missing_flags(spark, d):
    df = encode.encode_binary_with_missing(_docs_labels(spark, d), ["quality", "toxic"])
    df = encode.missingness_handler(df, ["quality", "toxic"])
    return df.select("doc_id", F.col("quality").cast("double").alias("quality"),
                     F.col("toxic").cast("double").alias("toxic"), "quality_missing", "toxic_missing")


# ---------------------------------------------------------------------------
# log1p of positive values
# ---------------------------------------------------------------------------

@register("log_feature", """
SELECT c_custkey, c_acctbal, round(CASE WHEN c_acctbal > 0 THEN ln(1 + c_acctbal) END, 9) AS c_acctbal_log
FROM customer
""")
def q_log_feature(spark, d):
    df = encode.add_log_features(table(spark, d, "customer"), ["c_acctbal"])
    return df.select("c_custkey", "c_acctbal", F.round("c_acctbal_log", 9).alias("c_acctbal_log"))


# ---------------------------------------------------------------------------
# Benchmark dimensions on customer -> nation -> region
# ---------------------------------------------------------------------------

# Benchmark dimensions for the driver tables, made by rule: 11 nations and 3
# regions carry a benchmark, the rest get NULL (as unknown provinces do).
_NATION_BENCH = {
    "province": [f"NATION_{i}" for i in range(11)],
    "apt_avg_m2": [2000 + 50 * i for i in range(11)],
    "house_avg_m2": [1500 + 40 * i for i in range(11)],
}
_REGION_BENCH = {"region": ["AFRICA", "AMERICA", "ASIA"], "apt_avg_m2": [3100, 2400, 3400],
                 "house_avg_m2": [2300, 1600, 3300]}
_NATIONAL_BENCH = {"apartment": {"avg": 3000}, "house": {"avg": 2100}}


def _values_sql(tbl) -> str:
    keys = list(tbl)
    rows = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in zip(*tbl.values()))
    return f"(VALUES {rows}) AS t({', '.join(keys)})"


def _segment_type(col: str = "c_mktsegment"):
    return (F.when(F.col(col) == "BUILDING", "Apartment").when(F.col(col) == "HOUSEHOLD", "House")
            .otherwise(F.col(col)))


_SEGMENT_TYPE_SQL = ("CASE c_mktsegment WHEN 'BUILDING' THEN 'Apartment' WHEN 'HOUSEHOLD' THEN 'House' "
                     "ELSE c_mktsegment END")


@register("benchmark_select", f"""
WITH base AS (
  SELECT c.c_custkey, n.n_name, r.r_name, {_SEGMENT_TYPE_SQL} AS ptype
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
prov AS (SELECT * FROM {_values_sql(_NATION_BENCH)}),
reg AS (SELECT * FROM {_values_sql(_REGION_BENCH)})
SELECT base.c_custkey, base.n_name, base.r_name, base.ptype, prov.province,
       CAST(prov.apt_avg_m2 AS DOUBLE) AS apt_avg_m2_province, CAST(prov.house_avg_m2 AS DOUBLE) AS house_avg_m2_province,
       reg.region, CAST(reg.apt_avg_m2 AS DOUBLE) AS apt_avg_m2_region, CAST(reg.house_avg_m2 AS DOUBLE) AS house_avg_m2_region,
       CAST(CASE WHEN ptype = 'Apartment' THEN prov.apt_avg_m2 ELSE prov.house_avg_m2 END AS DOUBLE) AS province_benchmark_m2,
       CAST(CASE WHEN ptype = 'Apartment' THEN reg.apt_avg_m2 ELSE reg.house_avg_m2 END AS DOUBLE) AS region_benchmark_m2,
       CAST(CASE lower(ptype) WHEN 'apartment' THEN 3000 WHEN 'house' THEN 2100 END AS DOUBLE) AS national_benchmark_m2
FROM base LEFT JOIN prov ON base.n_name = prov.province LEFT JOIN reg ON base.r_name = reg.region
""")
def q_benchmark_select(spark, d):
    nation = joins.bounded(table(spark, d, "nation"))
    region = joins.bounded(table(spark, d, "region"))
    df = table(spark, d, "customer").select("c_custkey", "c_nationkey", _segment_type().alias("ptype"))
    df = joins.lookup_join(df, nation, "c_nationkey", "n_nationkey")
    df = joins.lookup_join(df, region, "n_regionkey", "r_regionkey")
    df = joins.enrich_benchmarks(df, spark, _NATION_BENCH, _REGION_BENCH, _NATIONAL_BENCH,
                                 province_key="n_name", region_key="r_name", type_col="ptype")
    return df.select(
        "c_custkey", "n_name", "r_name", "ptype", "province", "apt_avg_m2_province", "house_avg_m2_province",
        "region", "apt_avg_m2_region", "house_avg_m2_region", "province_benchmark_m2", "region_benchmark_m2",
        "national_benchmark_m2")


# ---------------------------------------------------------------------------
# Lookup chain with a many-to-many fan-out
# ---------------------------------------------------------------------------

@register("geo_chain", """
SELECT o.o_orderkey, c.c_custkey, n.n_nationkey, n.n_name, r.r_name, p.n_name AS peer_name
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN nation p ON n.n_regionkey = p.n_regionkey
WHERE r.r_name IS NOT NULL
""")
def q_geo_chain(spark, d):
    nation = joins.bounded(table(spark, d, "nation"))
    region = joins.bounded(table(spark, d, "region"))
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    df = joins.lookup_join(df, table(spark, d, "customer").select("c_custkey", "c_nationkey"), "o_custkey", "c_custkey")
    df = joins.lookup_join(df, nation, "c_nationkey", "n_nationkey")
    df = joins.lookup_join(df, region, "n_regionkey", "r_regionkey")
    df = df.where(F.col("r_name").isNotNull())
    peers = nation.select(F.col("n_regionkey").alias("peer_region"), F.col("n_name").alias("peer_name"))
    df = joins.lookup_join(df, peers, "n_regionkey", "peer_region")
    return df.select("o_orderkey", "c_custkey", "n_nationkey", "n_name", "r_name", "peer_name")


# ---------------------------------------------------------------------------
# Two-language lookup with per-code fallback
# ---------------------------------------------------------------------------

_INCOME_SQL = """
inc AS (SELECT s_nationkey, CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS v
        FROM supplier GROUP BY s_nationkey),
src AS (SELECT lower(n.n_name) AS a, lower(r.r_name) AS b, inc.v
        FROM inc JOIN nation n ON n.n_nationkey = inc.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey),
stacked AS (SELECT a AS name, v, 0 AS prio FROM src UNION ALL SELECT b, v, 1 FROM src),
lk AS (SELECT name, v FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY prio, v) AS rn
                            FROM stacked WHERE name IS NOT NULL) WHERE rn = 1),
geo AS (SELECT c.c_custkey, c.c_nationkey, lower(n.n_name) AS nl, lower(r.r_name) AS fr
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
pergroup AS (SELECT p.c_nationkey, arg_min(l.v, p.fr) AS v
             FROM (SELECT DISTINCT c_nationkey, fr FROM geo WHERE c_nationkey IS NOT NULL) p
             JOIN lk l ON p.fr = l.name GROUP BY p.c_nationkey),
joined AS (SELECT g.c_custkey, g.c_nationkey, coalesce(l1.v, pg.v) AS median_income
           FROM geo g LEFT JOIN lk l1 ON g.nl = l1.name LEFT JOIN pergroup pg ON g.c_nationkey = pg.c_nationkey)
"""


def _income_lookup(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    inc = (table(spark, d, "supplier").groupBy("s_nationkey")
           .agg((F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("median_income")))
    src = (inc.join(nation, inc.s_nationkey == nation.n_nationkey)
           .join(region, nation.n_regionkey == region.r_regionkey)
           .select("n_name", "r_name", "median_income"))
    return joins.two_name_lookup(src, "n_name", "r_name", ["median_income"])


def _customer_geo(spark, d):
    nation = joins.bounded(table(spark, d, "nation"))
    region = joins.bounded(table(spark, d, "region"))
    df = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    df = joins.lookup_join(df, nation, "c_nationkey", "n_nationkey")
    df = joins.lookup_join(df, region, "n_regionkey", "r_regionkey")
    return df.select("c_custkey", "c_nationkey", text.lower_strip("n_name").alias("nl"),
                     text.lower_strip("r_name").alias("fr"))


def _nation_second_names(spark, d):
    """(nation key, second-language name) pairs from the dimension."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), text.lower_strip("r_name").alias("fr"))


@register("fallback_lookup", "WITH " + _INCOME_SQL + """
SELECT c_custkey, c_nationkey, median_income FROM joined WHERE median_income IS NOT NULL
""")
def q_fallback_lookup(spark, d):
    out = joins.fallback_lookup(_customer_geo(spark, d), _income_lookup(spark, d), "nl", "fr", "c_nationkey",
                                "median_income", pairs=_nation_second_names(spark, d))
    return out.select("c_custkey", "c_nationkey", "median_income")


@register("unmatched_count", "WITH " + _INCOME_SQL + """
SELECT COUNT(*) FILTER (WHERE median_income IS NULL) AS n_unmatched FROM joined
""")
def q_unmatched_count(spark, d):
    out = joins.fallback_lookup(_customer_geo(spark, d), _income_lookup(spark, d), "nl", "fr", "c_nationkey",
                                "median_income", keep_unmatched=True, pairs=_nation_second_names(spark, d))
    return joins.count_unmatched(out, "median_income")


# ---------------------------------------------------------------------------
# full-row distinct
# ---------------------------------------------------------------------------

@register("dedup_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_dedup_rows(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


# ---------------------------------------------------------------------------
# G1: group mean broadcast back to rows
# ---------------------------------------------------------------------------

@register("group_mean_window", """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_custkey IS NOT NULL THEN
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE)
         / COUNT(o_totalprice) OVER (PARTITION BY o_custkey) END AS cust_mean_price
FROM orders
""")
def q_group_mean_window(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    df = fitting.add_group_means(df, {"cust_mean_price": "o_custkey"}, "o_totalprice", exact_decimal=(18, 2))
    return df.select("o_orderkey", "o_custkey", "cust_mean_price")


# ---------------------------------------------------------------------------
# Imputation statistics and their application
# ---------------------------------------------------------------------------

def _impute_frame(spark, d):
    return _docs_labels(spark, d).withColumn("label_score", (F.col("quality") - F.col("toxic")).cast("double"))


def _impute_stats(spark, d):
    df = _impute_frame(spark, d)
    med = fitting.exact_medians(df, ["n_chars", "label_score"])
    mod = fitting.modes(df, ["quality", "toxic", "lang"])
    return df, med, mod


_IMPUTE_STATS_SQL = """
f AS (SELECT d.doc_id, d.n_chars, d.lang, l.quality, l.toxic, CAST(l.quality - l.toxic AS DOUBLE) AS label_score
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
stats AS (SELECT
  (SELECT quantile_cont(CAST(n_chars AS DOUBLE), 0.5) FROM f) AS n_chars_median,
  (SELECT quantile_cont(label_score, 0.5) FROM f) AS label_score_median,
  (SELECT CAST(quality AS BIGINT) FROM f WHERE quality IS NOT NULL GROUP BY quality ORDER BY COUNT(*) DESC, quality LIMIT 1) AS quality_mode,
  (SELECT CAST(toxic AS BIGINT) FROM f WHERE toxic IS NOT NULL GROUP BY toxic ORDER BY COUNT(*) DESC, toxic LIMIT 1) AS toxic_mode,
  (SELECT lang FROM f WHERE lang IS NOT NULL GROUP BY lang ORDER BY COUNT(*) DESC, lang LIMIT 1) AS lang_mode)
"""


@register("impute_fit", "WITH " + _IMPUTE_STATS_SQL + "SELECT * FROM stats")
def q_impute_fit(spark, d):
    _, med, mod = _impute_stats(spark, d)
    row = (med["n_chars"], med["label_score"], mod["quality"], mod["toxic"], mod["lang"])
    return spark.createDataFrame(
        [row], "n_chars_median double, label_score_median double, quality_mode bigint, toxic_mode bigint, lang_mode string")


@register("impute_apply", "WITH " + _IMPUTE_STATS_SQL + """
SELECT f.doc_id, coalesce(f.label_score, stats.label_score_median) AS label_score,
       CAST(coalesce(f.quality, stats.quality_mode) AS INTEGER) AS quality,
       CAST(coalesce(f.toxic, 0) AS INTEGER) AS toxic, coalesce(f.lang, stats.lang_mode) AS lang
FROM f CROSS JOIN stats
""")
def q_impute_apply(spark, d):
    df, med, mod = _impute_stats(spark, d)
    out = fitting.apply_imputation(df, {"label_score": med["label_score"]}, ["toxic"],
                                   {"quality": mod["quality"], "lang": mod["lang"]})
    return out.select("doc_id", "label_score", "quality", "toxic", "lang")


# ---------------------------------------------------------------------------
# Plausibility flags, outlier split, capping
# ---------------------------------------------------------------------------

_LINE_RANGES = {"l_quantity": (5, 45), "l_extendedprice": (1000, 100000), "l_discount": (0.0, 0.08)}


def _flag_sql(c, lo, hi):
    return f"CAST(coalesce({c} IS NOT NULL AND {c} <> -1 AND ({c} < {lo} OR {c} > {hi}), false) AS INTEGER)"


@register("range_flags", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{_flag_sql(c, lo, hi)} AS {c}_unusual" for c, (lo, hi) in _LINE_RANGES.items()) + " FROM lineitem")
def q_range_flags(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_LINE_RANGES)
    df = quality.flag_out_of_range(df, _LINE_RANGES)
    return df.select("l_orderkey", "l_linenumber", *[f"{c}_unusual" for c in _LINE_RANGES])


@register("outlier_split", "SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN (" + " + ".join(
    _flag_sql(c, lo, hi) for c, (lo, hi) in _LINE_RANGES.items()) + ") > 0 THEN 'outlier' ELSE 'clean' END AS segment"
    " FROM lineitem")
def q_outlier_split(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_LINE_RANGES)
    df = quality.label_outliers(quality.flag_out_of_range(df, _LINE_RANGES))
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "segment")


@register("cap_values", """
SELECT c_custkey, CASE WHEN c_acctbal <> -1 AND (c_acctbal < 0 OR c_acctbal > 9000) THEN -1.0 ELSE c_acctbal END AS c_acctbal
FROM customer
""")
def q_cap_values(spark, d):
    df = quality.cap_values(table(spark, d, "customer"), {"c_acctbal": (0, 9000)})
    return df.select("c_custkey", "c_acctbal")


# ---------------------------------------------------------------------------
# L1-L4: hash splits and folds
# ---------------------------------------------------------------------------

@register("split_assign", f"""
SELECT o_orderkey, {_SPLIT_SQL} AS split,
       CASE WHEN {_ORDER_BUCKET} < 15 THEN 'test'
            WHEN {_bucket_sql('CAST(o_orderkey AS VARCHAR)', '42:inner')} < 15 THEN 'val' ELSE 'train' END AS nested
FROM orders
""")
def q_split_assign(spark, d):
    df = _orders_split(spark, d)
    df = split.nested_split(df, "o_orderkey", 0.15, 0.15, seed=42, col="nested")
    return df.select("o_orderkey", "split", "nested")


@register("fold_assign", f"""
SELECT o_orderkey, CAST({_bucket_sql('CAST(o_orderkey AS VARCHAR)', 'fold:42', 5)} AS INTEGER) AS fold FROM orders
""")
def q_fold_assign(spark, d):
    return split.assign_fold(table(spark, d, "orders"), "o_orderkey", 5, seed=42).select("o_orderkey", "fold")


# ---------------------------------------------------------------------------
# Formula predictors on lineitem
# ---------------------------------------------------------------------------

_LINE_KEY_SQL = "CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)"
_PRED_SQL = f"""
preds AS (
  SELECT l_extendedprice AS y, l_quantity * CAST(1500.0 AS DOUBLE) AS p_a,
         l_quantity * CAST(1000.0 AS DOUBLE) + CAST(25000.0 AS DOUBLE) AS p_b,
         CASE WHEN {_bucket_sql(_LINE_KEY_SQL, '7')} < 80 THEN 'train' ELSE 'val' END AS split,
         CAST({_bucket_sql(_LINE_KEY_SQL, 'fold:7', 5)} AS INTEGER) AS fold
  FROM lineitem),
stacked AS (SELECT 'a' AS model, split, fold, y, p_a AS p FROM preds
            UNION ALL SELECT 'b', split, fold, y, p_b FROM preds)
"""


def _line_preds(spark, d):
    df = table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.lit(1500.0)).alias("p_a"),
        (F.col("l_quantity") * F.lit(1000.0) + F.lit(25000.0)).alias("p_b"),
        "l_orderkey", "l_linenumber")
    df = split.assign_split(df, ["l_orderkey", "l_linenumber"], (0.8, 0.2), ("train", "val"), seed=7)
    return split.assign_fold(df, ["l_orderkey", "l_linenumber"], 5, seed=7)


def _stacked_preds(spark, d):
    df = _line_preds(spark, d)
    a = df.select(F.lit("a").alias("model"), "split", "fold", "y", F.col("p_a").alias("p"))
    b = df.select(F.lit("b").alias("model"), "split", "fold", "y", F.col("p_b").alias("p"))
    return a.unionByName(b)


@register("regression_metrics", "WITH " + _PRED_SQL + """
SELECT model, split, COUNT(*) AS n, round(AVG(abs(y - p)), 4) AS mae, round(sqrt(AVG((y - p) * (y - p))), 4) AS rmse,
       round(1 - SUM((y - p) * (y - p)) / (COUNT(*) * var_pop(y)), 9) AS r2
FROM stacked GROUP BY model, split
""")
def q_regression_metrics(spark, d):
    m = metrics.regression_metrics(_stacked_preds(spark, d), "y", "p", by=["model", "split"])
    return m.select("model", "split", "n", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"),
                    F.round("r2", 9).alias("r2"))


@register("gap_penalty", "WITH " + _PRED_SQL + """,
m AS (SELECT model, split, 1 - SUM((y - p) * (y - p)) / (COUNT(*) * var_pop(y)) AS r2, AVG(abs(y - p)) AS mae
      FROM stacked GROUP BY model, split),
w AS (SELECT model, MAX(CASE WHEN split = 'train' THEN r2 END) AS train_r2,
             MAX(CASE WHEN split = 'val' THEN r2 END) AS val_r2 FROM m GROUP BY model)
SELECT model, round(train_r2, 9) AS train_r2, round(val_r2, 9) AS val_r2, round(train_r2 - val_r2, 9) AS gap,
       round(greatest(0.0, (train_r2 - val_r2) - 0.2) * 2.0, 9) AS penalty,
       round(val_r2 - greatest(0.0, (train_r2 - val_r2) - 0.2) * 2.0, 9) AS score
FROM w
""")
def q_gap_penalty(spark, d):
    m = metrics.regression_metrics(_stacked_preds(spark, d), "y", "p", by=["model", "split"])
    s = metrics.penalised_scores(m, ["model"])
    return s.select("model", *[F.round(c, 9).alias(c) for c in ("train_r2", "val_r2", "gap", "penalty", "score")])


@register("cv_summary", "WITH " + _PRED_SQL + """,
f AS (SELECT model, fold, 1 - SUM((y - p) * (y - p)) / (COUNT(*) * var_pop(y)) AS r2, AVG(abs(y - p)) AS mae
      FROM stacked GROUP BY model, fold)
SELECT model, round(AVG(r2), 9) AS mean_r2, round(AVG(mae), 4) AS mean_mae, COUNT(*) AS folds FROM f GROUP BY model
""")
def q_cv_summary(spark, d):
    per_fold = metrics.regression_metrics(_stacked_preds(spark, d), "y", "p", by=["model", "fold"])
    s = metrics.cv_summary(per_fold, ["model"])
    return s.select("model", F.round("mean_r2", 9).alias("mean_r2"), F.round("mean_mae", 4).alias("mean_mae"), "folds")


@register("ensemble_weights", "WITH " + _PRED_SQL + """,
w AS (SELECT i, i / 20.0 AS w FROM range(21) t(i)),
e AS (SELECT w.i, w.w, p.split, p.y, p.y - (w.w * p.p_a + (1.0 - w.w) * p.p_b) AS e FROM preds p CROSS JOIN w),
a AS (SELECT i, w,
        1 - SUM(CASE WHEN split = 'train' THEN e * e END) / (COUNT(CASE WHEN split = 'train' THEN y END) * var_pop(CASE WHEN split = 'train' THEN y END)) AS train_r2,
        1 - SUM(CASE WHEN split = 'val' THEN e * e END) / (COUNT(CASE WHEN split = 'val' THEN y END) * var_pop(CASE WHEN split = 'val' THEN y END)) AS val_r2,
        AVG(CASE WHEN split = 'val' THEN abs(e) END) AS val_mae
      FROM e GROUP BY i, w),
s AS (SELECT *, train_r2 - val_r2 AS gap, greatest(0.0, (train_r2 - val_r2) - 0.2) * 2.0 AS penalty,
             val_r2 - greatest(0.0, (train_r2 - val_r2) - 0.2) * 2.0 AS score FROM a)
SELECT CAST(i AS INTEGER) AS i, w, round(train_r2, 9) AS train_r2, round(val_r2, 9) AS val_r2, round(val_mae, 4) AS val_mae,
       round(gap, 9) AS gap, round(penalty, 9) AS penalty, round(score, 9) AS score,
       CAST(i = (SELECT arg_min(i, (-score, i)) FROM s) AS INTEGER) AS is_best
FROM s
""")
def q_ensemble_weights(spark, d):
    t = metrics.ensemble_weight_search(_line_preds(spark, d), "y", "p_a", "p_b")
    return t.select("i", "w", *[F.round(c, 9).alias(c) for c in ("train_r2", "val_r2")],
                    F.round("val_mae", 4).alias("val_mae"),
                    *[F.round(c, 9).alias(c) for c in ("gap", "penalty", "score")], "is_best")


@register("residual_histogram", "WITH " + _PRED_SQL + """,
r AS (SELECT y - p_a AS r FROM preds),
mm AS (SELECT MIN(r) AS lo, MAX(r) AS hi FROM r),
b AS (SELECT least(CAST(floor((r.r - mm.lo) / ((mm.hi - mm.lo) / 40)) AS INTEGER), 39) AS bin, mm.lo, (mm.hi - mm.lo) / 40 AS width
      FROM r CROSS JOIN mm)
SELECT bin, COUNT(*) AS n, round(lo + bin * width, 4) AS bin_lo, round(lo + (bin + 1) * width, 4) AS bin_hi
FROM b GROUP BY bin, lo, width
""")
def q_residual_histogram(spark, d):
    h = metrics.residual_histogram(_line_preds(spark, d), "y", "p_a", bins=40)
    return h.select("bin", "n", F.round("bin_lo", 4).alias("bin_lo"), F.round("bin_hi", 4).alias("bin_hi"))


_CORR_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _importances(spark, d):
    li = table(spark, d, "lineitem")
    row = li.agg(*[F.abs(F.corr(F.col(c).cast("double"), "l_extendedprice")).alias(c) for c in _CORR_FEATURES])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(c), 9).alias("importance")) for c in _CORR_FEATURES
    ])).alias("x")).select("x.*")


_IMPORTANCE_SQL = "imp AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr(CAST({c} AS DOUBLE), l_extendedprice)), 9) AS importance FROM lineitem"
    for c in _CORR_FEATURES) + ")"


@register("top_k", "WITH " + _IMPORTANCE_SQL + """
SELECT feature, importance, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank
FROM imp ORDER BY importance DESC, feature LIMIT 3
""")
def q_top_k(spark, d):
    return metrics.top_k(_importances(spark, d), "importance", 3).withColumn("rank", F.col("rank").cast("int"))


@register("least_important", "WITH " + _IMPORTANCE_SQL + """
SELECT arg_min(feature, (importance, feature)) AS feature, MIN(importance) AS importance FROM imp
""")
def q_least_important(spark, d):
    return metrics.arg_min(_importances(spark, d), "importance", "feature")


# ---------------------------------------------------------------------------
# Stage audit
# ---------------------------------------------------------------------------

@register("stage_audit", """
SELECT 'raw' AS stage, COUNT(*) AS n_rows, 6 AS n_cols FROM orders
UNION ALL SELECT 'typed', COUNT(*), 7 FROM orders WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_totalprice IS NOT NULL
UNION ALL SELECT 'enriched', COUNT(*), 9 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
          WHERE o.o_orderkey IS NOT NULL AND o.o_totalprice IS NOT NULL
""")
def q_stage_audit(spark, d):
    raw = cols_.require_columns(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    typed = cols_.not_null_filter(raw, ["o_orderkey", "o_custkey", "o_totalprice"])
    typed = cols_.stamp_version(typed, "__stage1_version", "1.0.0")
    cust = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    enriched = typed.join(cust, typed.o_custkey == cust.c_custkey, "inner")
    return stage_audit({"raw": raw, "typed": typed, "enriched": enriched})


# ---------------------------------------------------------------------------
# K7 / K8: feature-column selection (the matrix columns, before assembling)
# ---------------------------------------------------------------------------

_FLAG_TE = {"A": 1.0, "N": 2.0, "R": 3.0}


@register("feature_columns", """
SELECT l_extendedprice, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax,
       CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'N' THEN 2.0 WHEN 'R' THEN 3.0 END AS l_returnflag_te_price
FROM lineitem
""")
def q_feature_columns(spark, d):
    from gable.ml.features import select_feature_columns
    df = table(spark, d, "lineitem")
    df = encode.add_log_features(df, ["l_quantity"])                       # dropped for trees
    df = df.withColumns({
        "l_returnflag_te_price": codes.lookup("l_returnflag", _FLAG_TE),   # kept for trees
        "price_log": F.log1p("l_extendedprice"),                            # leakage
        "ratio_to_list": F.col("l_extendedprice") / F.col("l_quantity"),    # leakage prefix
        "__stage1_version": F.lit("1.0.0"),                                 # technical
    })
    out, _ = select_feature_columns(df, "l_extendedprice", "rf")
    return out


# ---------------------------------------------------------------------------
# Q7 option: out-of-fold target encoding (each fold encoded by the others)
# ---------------------------------------------------------------------------

_FOLD_SQL = _bucket_sql("CAST(o_orderkey AS VARCHAR)", "fold:42", 5)


@register("target_encode_oof", f"""
WITH f AS (SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS y,
                  CAST({_FOLD_SQL} AS INTEGER) AS fold FROM orders),
pf AS (SELECT o_orderpriority AS key, fold, SUM(y) AS s, COUNT(y) AS n FROM f
       WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2),
tot AS (SELECT key, SUM(s) AS ts, SUM(n) AS tn FROM pf GROUP BY key),
gf AS (SELECT fold, SUM(y) AS gs, COUNT(y) AS gn FROM f GROUP BY fold),
g AS (SELECT fold, CAST((SUM(gs) OVER () - gs) AS DOUBLE) / (SUM(gn) OVER () - gn) AS g FROM gf),
te AS (SELECT pf.key, pf.fold,
              (CAST(tot.ts - pf.s AS DOUBLE) + CAST(100.0 AS DOUBLE) * g.g) / ((tot.tn - pf.n) + CAST(100.0 AS DOUBLE)) AS te
       FROM pf JOIN tot ON pf.key = tot.key JOIN g ON pf.fold = g.fold)
SELECT f.o_orderkey, f.fold, COALESCE(te.te, g.g) AS o_orderpriority_te
FROM f LEFT JOIN g ON f.fold = g.fold LEFT JOIN te ON te.key = f.o_orderpriority AND te.fold = f.fold
""")
def q_target_encode_oof(spark, d):
    from gable.operators.stage3 import per_fold_target_encoding
    df = split.assign_fold(table(spark, d, "orders"), "o_orderkey", 5, seed=42)
    out = per_fold_target_encoding(df, ["o_orderpriority"], "o_totalprice", alpha=100.0, exact_decimal=(18, 2))
    return out.select("o_orderkey", "fold", "o_orderpriority_te")


# ---------------------------------------------------------------------------
# F14 (second half): value range of actual and predicted, per split
# ---------------------------------------------------------------------------

@register("prediction_range", "WITH " + _PRED_SQL + """
SELECT split, MIN(y) AS y_min, MAX(y) AS y_max, MIN(p_a) AS p_min, MAX(p_a) AS p_max,
       MIN(y - p_a) AS r_min, MAX(y - p_a) AS r_max
FROM preds GROUP BY split
""")
def q_prediction_range(spark, d):
    r = F.col("y") - F.col("p_a")
    return _line_preds(spark, d).groupBy("split").agg(
        F.min("y").alias("y_min"), F.max("y").alias("y_max"), F.min("p_a").alias("p_min"),
        F.max("p_a").alias("p_max"), F.min(r).alias("r_min"), F.max(r).alias("r_max"))


@register("ensemble_weights_mae", "WITH " + _PRED_SQL + """,
w AS (SELECT i, i / 20.0 AS w FROM range(21) t(i)),
e AS (SELECT w.i, w.w, p.split, p.y, p.y - (w.w * p.p_a + (1.0 - w.w) * p.p_b) AS e FROM preds p CROSS JOIN w),
a AS (SELECT i, w, AVG(CASE WHEN split = 'val' THEN abs(e) END) AS val_mae FROM e GROUP BY i, w)
SELECT CAST(i AS INTEGER) AS i, w, round(val_mae, 4) AS val_mae,
       CAST(i = (SELECT arg_min(i, (val_mae, i)) FROM a) AS INTEGER) AS is_best
FROM a
""")
def q_ensemble_weights_mae(spark, d):
    """M10 + H4, segment-script criterion: the weight with the lowest
    validation MAE (first weight on ties)."""
    t = metrics.ensemble_weight_search(_line_preds(spark, d), "y", "p_a", "p_b", criterion="mae")
    return t.select("i", "w", F.round("val_mae", 4).alias("val_mae"), "is_best")
