"""DuckDB twin of the end-to-end flow on the star schema (``end_to_end``).

Built from the same parameters as ``gable.plans.star`` so both sides
describe one computation: stage 1-2.5, md5 split, stage 3 fitted on train
(exact medians as the mean of the two middle values, modes smallest on
ties, exact-decimal target encodings) and applied to every split.
"""

from __future__ import annotations

from gable.plans import star
from gable.plans.catalog import _INCOME_SQL, _SPLIT_SQL, _norm_sql, _strip_sql, _values_sql

S3 = star.STAGE3
_MEDIAN_COLS = list(S3.numeric_cols)
_MODE_COLS = list(S3.ordinal_cols)


def _codes_sql(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def _groups_sql(col: str, groups: dict) -> str:
    whens = " ".join(f"WHEN {col} IN ({', '.join(repr(v) for v in vals)}) THEN '{name}'"
                     for name, vals in groups.items())
    return f"CASE {whens} ELSE 'Other' END"


def _flag_sql(c, lo, hi):
    return f"coalesce({c} IS NOT NULL AND {c} <> -1 AND ({c} < {lo} OR {c} > {hi}), false)"


def _median_sql(c: str) -> str:
    return f"""(SELECT CASE WHEN max(n) % 2 = 1 THEN max(CASE WHEN rn = (n + 1) // 2 THEN x END)
                  ELSE (max(CASE WHEN rn = n // 2 THEN x END) + max(CASE WHEN rn = n // 2 + 1 THEN x END)) / 2 END
           FROM (SELECT x, row_number() OVER (ORDER BY x) AS rn, count(*) OVER () AS n
                 FROM (SELECT CAST({c} AS DOUBLE) AS x FROM train3 WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)))))"""


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM train3 WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _te_stats(c: str) -> str:
    return (f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS key, COUNT(price) AS n, "
            f"CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / COUNT(price) AS mean "
            f"FROM train3 WHERE {c} IS NOT NULL GROUP BY 1, 2")


def build() -> str:
    miss = list(S3.missing_cols)
    flags = " OR ".join(_flag_sql(c, lo, hi) for c, (lo, hi) in star.PRICE_RANGES.items())
    prepared_cols = ", ".join(f"CAST(CASE WHEN {c} = -1 THEN NULL ELSE {c} END AS {t}) AS {c}"
                              for c, t in (("status", "INTEGER"), ("priority", "INTEGER"), ("qty_sum", "DOUBLE"),
                                           ("n_lines", "BIGINT"), ("disc_avg", "DOUBLE")))
    miss_flags = ", ".join(f"CAST(coalesce({c} = -1, false) AS INTEGER) AS {c}_missing" for c in miss)
    stats = ",\n  ".join([f"{_median_sql(c)} AS med_{c}" for c in _MEDIAN_COLS] +
                         [f"{_mode_sql(c)} AS mode_{c}" for c in _MODE_COLS])
    te_union = " UNION ALL ".join(_te_stats(c) for c in S3.te_cols)
    imputed = []
    for c in ("status", "priority", "qty_sum", "n_lines", "disc_avg", "tax_avg", "c_acctbal", "median_income",
              "province_benchmark_m2", "region_benchmark_m2", "national_benchmark_m2", "r_name"):
        if c in _MEDIAN_COLS:
            imputed.append(f"coalesce(CAST(p.{c} AS DOUBLE), st.med_{c}) AS {c}")
        elif c == "status":
            imputed.append("CAST(coalesce(p.status, 0) AS INTEGER) AS status")
        elif c == "priority":
            imputed.append("CAST(coalesce(p.priority, st.mode_priority) AS INTEGER) AS priority")
        elif c == "r_name":
            imputed.append("coalesce(p.r_name, st.mode_r_name) AS r_name")
    te_cols = ",\n       ".join(
        f"coalesce(t{i}.te, g.gm) AS {c}{S3.te_suffix}" for i, c in enumerate(S3.te_cols))
    te_joins = "\n".join(
        f"LEFT JOIN te t{i} ON t{i}.feature = '{c}' AND t{i}.key = CAST(p.{c} AS VARCHAR)"
        for i, c in enumerate(S3.te_cols))
    nat = {k.lower(): float(v["avg"]) for k, v in star.NATIONAL_BENCH.items()}
    return f"""
WITH {_INCOME_SQL.strip()},
la AS (SELECT l_orderkey, COUNT(*) AS n_lines, SUM(l_quantity) AS qty_sum,
              CAST(SUM(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) / COUNT(l_discount) AS disc_avg,
              CAST(SUM(CAST(l_tax AS DECIMAL(12,2))) AS DOUBLE) / COUNT(l_tax) AS tax_avg
       FROM lineitem GROUP BY l_orderkey),
s1 AS (SELECT o_orderkey, o_custkey, o_totalprice AS price, o_orderpriority,
              CASE lower({_strip_sql('o_orderstatus')}) WHEN 'f' THEN 1 WHEN 'o' THEN 0 END AS status0,
              {_norm_sql('o_orderpriority')} AS priority_label
       FROM orders WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_totalprice IS NOT NULL),
s2a AS (SELECT s1.o_orderkey, s1.o_custkey, s1.price, s1.priority_label,
               {_groups_sql('s1.priority_label', star.PRIORITY_GROUPS)} AS priority_group,
               CAST(CASE WHEN status0 = 1 THEN 1 WHEN status0 = 0 THEN 0 ELSE -1 END AS INTEGER) AS status,
               CAST({_codes_sql("coalesce(s1.o_orderpriority, 'Missing')", star.PRIORITY_CODES)} AS INTEGER) AS priority,
               coalesce(la.n_lines, -1) AS n_lines, coalesce(la.qty_sum, -1) AS qty_sum,
               coalesce(la.disc_avg, -1) AS disc_avg, coalesce(la.tax_avg, -1) AS tax_avg
        FROM s1 LEFT JOIN la ON s1.o_orderkey = la.l_orderkey),
s2 AS (SELECT * FROM s2a WHERE NOT ({flags})),
s25a AS (SELECT s2.*, c.c_acctbal, c.c_mktsegment, c.c_nationkey, n.n_name, r.r_name,
                CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Apartment' WHEN 'HOUSEHOLD' THEN 'House'
                     ELSE c.c_mktsegment END AS ptype,
                lower({_strip_sql('n.n_name')}) AS nl
         FROM s2 LEFT JOIN customer c ON s2.o_custkey = c.c_custkey
         LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
         LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
s25b AS (SELECT s25a.*, coalesce(l1.v, pg.v) AS median_income
         FROM s25a LEFT JOIN lk l1 ON s25a.nl = l1.name LEFT JOIN pergroup pg ON s25a.c_nationkey = pg.c_nationkey),
prov AS (SELECT * FROM {_values_sql(star.NATION_BENCH)}),
reg AS (SELECT * FROM {_values_sql(star.REGION_BENCH)}),
s25 AS (SELECT s25b.* EXCLUDE (nl, c_nationkey), prov.province,
               CAST(prov.apt_avg_m2 AS DOUBLE) AS apt_avg_m2_province, CAST(prov.house_avg_m2 AS DOUBLE) AS house_avg_m2_province,
               reg.region, CAST(reg.apt_avg_m2 AS DOUBLE) AS apt_avg_m2_region, CAST(reg.house_avg_m2 AS DOUBLE) AS house_avg_m2_region,
               CAST(CASE WHEN ptype = 'Apartment' THEN prov.apt_avg_m2 ELSE prov.house_avg_m2 END AS DOUBLE) AS province_benchmark_m2,
               CAST(CASE WHEN ptype = 'Apartment' THEN reg.apt_avg_m2 ELSE reg.house_avg_m2 END AS DOUBLE) AS region_benchmark_m2,
               CAST(CASE lower(ptype) WHEN 'apartment' THEN {nat['apartment']} WHEN 'house' THEN {nat['house']} END AS DOUBLE) AS national_benchmark_m2
        FROM s25b LEFT JOIN prov ON s25b.n_name = prov.province LEFT JOIN reg ON s25b.r_name = reg.region
        WHERE s25b.median_income IS NOT NULL),
sp AS (SELECT *, {_SPLIT_SQL} AS split FROM s25),
prep AS (SELECT sp.* EXCLUDE (status, priority, qty_sum, n_lines, disc_avg), {miss_flags}, {prepared_cols} FROM sp),
train3 AS (SELECT * FROM prep WHERE split = 'train'),
st AS (SELECT
  {stats}),
g AS (SELECT CAST(SUM(CAST(price AS DECIMAL(18,2))) AS DOUBLE) / COUNT(price) AS gm FROM train3),
te AS (SELECT feature, key, (n * mean + CAST({S3.alpha} AS DOUBLE) * g.gm) / (n + CAST({S3.alpha} AS DOUBLE)) AS te
       FROM ({te_union}) CROSS JOIN g)
SELECT p.o_orderkey, p.o_custkey, p.price, p.priority_label, p.priority_group,
       p.c_mktsegment, p.n_name, p.ptype, p.province, p.apt_avg_m2_province, p.house_avg_m2_province, p.region,
       p.apt_avg_m2_region, p.house_avg_m2_region, p.split,
       {', '.join(f'p.{c}_missing' for c in miss)},
       {', '.join(imputed)},
       round(CASE WHEN coalesce(CAST(p.qty_sum AS DOUBLE), st.med_qty_sum) > 0
                  THEN ln(1 + coalesce(CAST(p.qty_sum AS DOUBLE), st.med_qty_sum)) END, 9) AS qty_sum_log,
       {te_cols}
FROM prep p CROSS JOIN st CROSS JOIN g
{te_joins}
"""
