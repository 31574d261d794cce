"""Plain SQL for the results of the queries, to be run by another engine.

Written from the meaning of each step, without any of the rewriting the Spark
operators do: every cohort and feature has its own statement, rules are re-enacted
one after the other.
"""

from __future__ import annotations

import re

SEED = 27218

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def with_ctes(sql: str, instead: dict[str, str] | None = None) -> str:
    """Prefix a statement with the CTEs it needs, in order of definition.

    ``instead`` gives some of them another body.
    """
    bodies = CTES | (instead or {})
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\b[a-z_0-9]+\b", todo.pop()))
        for name in (words & bodies.keys()) - needed:
            needed.add(name)
            todo.append(bodies[name])
    parts = [f"{name} AS MATERIALIZED (\n{body}\n)" for name, body in bodies.items() if name in needed]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + sql.strip()


# Inputs -----------------------------------------------------------------------------

cte(
    "t_sales",
    """
    SELECT CASE WHEN l_suppkey % 10 = 0 THEN 'CO' ELSE 'CL' END AS country_id,
           CASE WHEN l_suppkey % 17 = 0 THEN 'OTH' ELSE 'ENT' END AS business_unit_id,
           CASE WHEN o_orderkey % 19 = 0 THEN '0' WHEN o_orderkey % 23 = 0 THEN NULL
                ELSE ' ' || CAST(o_custkey AS VARCHAR) || ' ' END AS raw_customer_id,
           CAST(o_custkey AS VARCHAR) AS main_customer_id,
           CASE WHEN l_partkey % 211 = 0 THEN 'X' || CAST(l_partkey AS VARCHAR)
                ELSE lpad(CAST(l_partkey AS VARCHAR), 8, '0') END AS item_id,
           CAST(o_orderdate AS DATE) AS dt,
           CASE WHEN o_custkey % 4 = 0 AND o_orderstatus = 'F' THEN 'fctr'
                WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'ntcr'
                ELSE 'blta' END AS kind,
           o_orderkey AS doc,
           o_orderkey % 25 AS loc,
           CASE WHEN o_orderkey % 31 = 0 THEN 'bad'
                ELSE CAST(o_orderdate + to_hours(o_orderkey % 24) AS VARCHAR) END AS dttm,
           CASE WHEN o_custkey % 11 = 0 AND o_orderpriority = '1-URGENT' THEN 'VE'
                ELSE 'ST' END AS area,
           CASE o_orderpriority WHEN '2-HIGH' THEN ' SR ' WHEN '3-MEDIUM' THEN NULL
                ELSE 'XX' END AS channel,
           CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                      * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2)
                AS DECIMAL(18,2)) AS net,
           CAST(l_quantity AS DECIMAL(18,2)) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
cte(
    "t_lines",
    """
    SELECT country_id, business_unit_id, raw_customer_id, main_customer_id, item_id, dt, kind,
           doc, loc, dttm, area, channel,
           CASE WHEN trim(raw_customer_id) = '0' OR raw_customer_id IS NULL
                THEN trim(main_customer_id) ELSE trim(raw_customer_id) END AS cid,
           CASE WHEN kind = 'ntcr' THEN -net ELSE net END AS amt,
           CASE WHEN kind = 'ntcr' THEN -quantity ELSE quantity END AS units,
           CASE WHEN regexp_full_match(item_id, '\\s*[+-]?\\d+\\s*')
                THEN TRY_CAST(item_id AS BIGINT) END AS ikey,
           country_id || business_unit_id || CAST(dt AS VARCHAR) || kind
               || CAST(doc AS VARCHAR) || CAST(loc AS VARCHAR) AS trx
    FROM t_sales
    """,
)
cte(
    "t_items",
    """
    SELECT country_id, 'ENT' AS business_unit_id, CAST(p_partkey AS VARCHAR) AS item_id,
           p_partkey AS ikey, CAST(p_size % 6 AS VARCHAR) AS dept, family,
           ' ' || family || '-' || p_brand || ' ' AS subfamily, p_brand AS grp,
           CAST(p_size AS VARCHAR) AS item_set
    FROM (SELECT *, CASE p_type WHEN 'ECONOMY' THEN '0626' WHEN 'LARGE' THEN '0601'
                      WHEN 'MEDIUM' THEN '0602' WHEN 'PROMO' THEN '0603'
                      WHEN 'SMALL' THEN '0604' WHEN 'STANDARD' THEN '0605' END AS family
          FROM part)
         CROSS JOIN (VALUES ('CL'), ('CO')) AS c(country_id)
    """,
)
cte("t_excluded", "SELECT ' ' || CAST(c_custkey AS VARCHAR) AS raw_id FROM customer WHERE c_custkey % 97 = 0")
cte("t_excl", "SELECT trim(raw_id) AS id FROM t_excluded")
cte(
    "t_reg",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey % 13 AS tranche
       FROM customer WHERE c_custkey % 7 = 0""",
)
cte("t_lp", "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 53 = 0")
cte(
    "t_companies",
    "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_mktsegment = 'BUILDING'",
)
cte("t_skus", "SELECT p_partkey AS ikey FROM part WHERE p_partkey % 29 = 0")

# Sale lines -------------------------------------------------------------------------

cte(
    "sold",
    """
    SELECT s.*, i.item_id AS cat_item, i.dept, i.family, i.subfamily, i.grp, i.item_set
    FROM t_lines s JOIN t_items i ON s.country_id = i.country_id
         AND s.business_unit_id = i.business_unit_id AND s.ikey = i.ikey
    WHERE s.country_id = 'CL' AND s.business_unit_id = 'ENT'
    """,
)
cte("hist", "SELECT * FROM sold WHERE dt >= DATE '1995-06-01' AND dt < DATE '2001-01-01'")
cte("in_window", "SELECT * FROM sold WHERE dt >= DATE '1999-01-01' AND dt < DATE '2001-01-01'")
cte(
    "valid",
    "SELECT * FROM in_window WHERE kind IN ('blta', 'fctr') AND amt > 0 AND units > 0",
)

# Cohorts ----------------------------------------------------------------------------

ALLOWED = "e.id IS NULL AND (g.id IS NULL OR g.tranche < 7)"
LISTS = "LEFT JOIN t_excl e ON s.cid = e.id LEFT JOIN t_reg g ON s.cid = g.id"
cte(
    "ve",
    f"""SELECT DISTINCT cid FROM hist s {LISTS}
        WHERE area = 'VE' AND kind IN ('blta', 'fctr') AND {ALLOWED}""",
)
cte(
    "ggee",
    """SELECT DISTINCT s.cid, g.tranche FROM hist s LEFT JOIN t_excl e ON s.cid = e.id
       JOIN t_reg g ON s.cid = g.id
       WHERE kind IN ('blta', 'fctr') AND amt > 0 AND units > 0 AND e.id IS NULL""",
)
cte(
    "fctr",
    f"""SELECT DISTINCT s.cid FROM hist s {LISTS} LEFT JOIN ve v ON s.cid = v.cid
        WHERE kind = 'fctr' AND amt > 0 AND units > 0 AND {ALLOWED} AND v.cid IS NULL""",
)
cte(
    "fctr_list",
    """SELECT t.id AS cid FROM t_companies t LEFT JOIN t_excl e ON trim(t.id) = e.id
       LEFT JOIN t_reg g ON trim(t.id) = g.id LEFT JOIN ve v ON trim(t.id) = v.cid
       WHERE e.id IS NULL AND v.cid IS NULL AND (g.id IS NULL OR g.tranche < 7)""",
)
cte(
    "blta",
    f"""SELECT DISTINCT s.cid FROM in_window s {LISTS} LEFT JOIN ve v ON s.cid = v.cid
        LEFT JOIN fctr f ON s.cid = f.cid
        WHERE kind = 'blta' AND amt > 0 AND units > 0 AND {ALLOWED}
              AND v.cid IS NULL AND f.cid IS NULL""",
)
cte("allc", "SELECT cid, 1 AS target FROM fctr UNION ALL SELECT cid, 0 FROM blta")
cte(
    "allve",
    """SELECT cid FROM fctr UNION SELECT cid FROM blta UNION SELECT cid FROM ve
       UNION SELECT cid FROM ggee""",
)
cte(
    "fctr_tot",
    """
    SELECT cid, CAST(sum(n) AS BIGINT) AS trx_all,
           CAST(max(CASE WHEN kind = 'fctr' THEN n ELSE 0 END) AS BIGINT) AS trx_fctr,
           CAST(sum(amt) AS DOUBLE) AS amt_all,
           CAST(max(CASE WHEN kind = 'fctr' THEN amt ELSE 0 END) AS DOUBLE) AS amt_fctr,
           CAST(sum(units) AS DOUBLE) AS units_all,
           CAST(max(CASE WHEN kind = 'fctr' THEN units ELSE 0 END) AS DOUBLE) AS units_fctr
    FROM (SELECT s.cid, kind, count(DISTINCT trx) AS n, sum(amt) AS amt, sum(units) AS units
          FROM valid s JOIN fctr f ON s.cid = f.cid LEFT JOIN ve v ON s.cid = v.cid
          WHERE v.cid IS NULL GROUP BY s.cid, kind)
    GROUP BY cid HAVING max(CASE WHEN kind = 'fctr' THEN amt ELSE 0 END) > 0
    """,
)
cte(
    "tiles",
    """
    SELECT *, ntile(100) OVER (ORDER BY trx_fctr / trx_all, cid) AS trx_tile,
           ntile(100) OVER (ORDER BY amt_fctr / amt_all, cid) AS amt_tile,
           ntile(100) OVER (ORDER BY units_fctr / units_all, cid) AS units_tile
    FROM fctr_tot WHERE trx_all <> 0 AND amt_all <> 0 AND units_all <> 0
    """,
)
cte("pro", "SELECT * FROM tiles WHERE trx_tile > 5 AND amt_tile > 5 AND units_tile > 5")
cte(
    "home",
    f"""SELECT cid FROM (SELECT cid, row_number() OVER (ORDER BY md5(cid || ':{SEED}:rows'), cid) AS rn
                         FROM blta)
        WHERE rn <= 4 * (SELECT count(DISTINCT cid) FROM pro)""",
)
cte("train_cust", "SELECT cid, 1 AS target FROM pro UNION ALL SELECT cid, 0 FROM home")

# Features ---------------------------------------------------------------------------

cte("base", "SELECT v.* FROM valid v JOIN allve a ON v.cid = a.cid")
cte(
    "tot",
    """
    SELECT cid, CAST(sum(units) AS DOUBLE) AS units, CAST(sum(amt) AS DOUBLE) AS amt,
           CAST(count(DISTINCT loc) AS DOUBLE) AS stores,
           CAST(count(DISTINCT item_id) AS DOUBLE) AS items,
           CAST(count(DISTINCT item_set) AS DOUBLE) AS sets,
           CAST(count(DISTINCT dept) AS DOUBLE) / 6 AS depts,
           CAST(count(DISTINCT trx) AS DOUBLE) AS trx,
           date_diff('month', max(dt), DATE '2001-01-01') AS months
    FROM base GROUP BY cid
    """,
)


def share(label: str, where: str = "") -> str:
    return f"""
    SELECT b.cid, {label} AS name, count(DISTINCT b.trx) / t.trx AS val
    FROM base b JOIN tot t ON b.cid = t.cid WHERE ({label}) IS NOT NULL {where}
    GROUP BY b.cid, {label}, t.trx"""


def units_share(label: str) -> str:
    return f"""
    SELECT b.cid, {label} AS name, CAST(sum(b.units) AS DOUBLE) / t.units AS val
    FROM base b JOIN tot t ON b.cid = t.cid WHERE ({label}) IS NOT NULL
    GROUP BY b.cid, {label}, t.units"""


LEVELS = {"N0": "family", "N1": "subfamily", "N2": "grp", "ND": "dept"}


def level_label(prefix: str, level: str) -> str:
    return f"'{prefix}_{level}_' || trim({LEVELS[level]})"


def top(source: str, pattern: str, name: str) -> str:
    return f"""
    SELECT cid, '{name}' AS name, val FROM
      (SELECT cid, val, row_number() OVER (PARTITION BY cid ORDER BY val DESC) AS rn
       FROM {source} WHERE name LIKE '{pattern}') WHERE rn = 1"""


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


cte("f_store", share("'per_trx_store_' || lpad(CAST(b.loc AS VARCHAR), 3, '0')"))
cte("f_top_store", top("f_store", "per_trx_store_%", "per_trx_cuchi_store"))
cte(
    "f_item_pro",
    """SELECT b.cid, 'item_pro_' || b.cat_item AS name,
              CASE WHEN count(DISTINCT b.trx) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS val
       FROM base b JOIN t_skus k ON b.ikey = k.ikey GROUP BY ALL""",
)
cte(
    "f_hour",
    share("'per_trx_hour_' || lpad(CAST(hour(TRY_CAST(b.dttm AS TIMESTAMP)) AS VARCHAR), 2, '0')"),
)
cte("f_weekday", share("'per_trx_weekday_' || lpad(CAST(dayofweek(b.dt) + 1 AS VARCHAR), 2, '0')"))
cte(
    "f_channel",
    share("'per_trx_channel_' || CASE WHEN trim(b.channel) = 'SR' THEN 'SR' ELSE 'NSR' END"),
)
cte(
    "f_totals",
    union(
        *[
            f"SELECT cid, '{name}' AS name, CAST({value} AS DOUBLE) AS val FROM tot"
            for name, value in {
                "per_distinct_department": "depts",
                "months_since_last_trx": "months",
                "avg_units_trx": "units / trx",
                "set_diversity": "sets / items",
                "total_stores": "stores",
                "total_units_cnt": "units",
                "total_sales_amt": "amt",
                "total_transactions": "trx",
                "avg_ticket": "amt / trx",
            }.items()
        ]
    ),
)
cte(
    "fam_size",
    """SELECT trim(family) AS family, count(DISTINCT trim(subfamily)) AS n FROM t_items
       WHERE country_id = 'CL' AND business_unit_id = 'ENT' AND ikey IS NOT NULL GROUP BY 1""",
)
cte(
    "f_family",
    """SELECT b.cid, 'per_family_completeness_' || trim(b.family) AS name,
              count(DISTINCT trim(b.subfamily)) / z.n AS val
       FROM base b JOIN fam_size z ON trim(b.family) = z.family
       WHERE b.family IS NOT NULL AND b.subfamily IS NOT NULL
       GROUP BY b.cid, trim(b.family), z.n""",
)
cte("f_trx_hier", union(*[share(level_label("per_trx", level)) for level in LEVELS]))
cte("f_uni_hier", union(*[units_share(level_label("per_uni", x)) for x in ("N0", "N1", "N2")]))
cte(
    "f_trx_n1",
    """SELECT cid, 'trx_N1_' || trim(subfamily) AS name, CAST(count(DISTINCT trx) AS DOUBLE) AS val
       FROM base WHERE subfamily IS NOT NULL GROUP BY cid, trim(subfamily)""",
)
cte(
    "credit",
    """SELECT s.cid, s.trx AS key, s.amt, t.trx, t.amt AS total
       FROM in_window s JOIN tot t ON s.cid = t.cid WHERE s.kind = 'ntcr'""",
)
cte(
    "f_ntcr",
    """SELECT cid, 'per_trx_ntcr' AS name, count(DISTINCT key) / trx AS val FROM credit
       GROUP BY cid, trx
       UNION ALL SELECT cid, 'per_sales_ntcr', CAST(sum(amt) AS DOUBLE) / total FROM credit
       GROUP BY cid, total""",
)
cte(
    "f_skus",
    """SELECT cid, 'skus_N1_' || trim(subfamily) AS name,
              CAST(count(DISTINCT item_id) AS DOUBLE) AS val
       FROM base WHERE subfamily IS NOT NULL GROUP BY cid, trim(subfamily)""",
)
cte("f_rent", share("'per_trx_rent'", "AND b.family = '0626'"))
cte("f_fctr", share("'per_trx_fctr'", "AND b.kind = 'fctr'"))
cte(
    "f_top",
    union(
        top("f_trx_hier", "per_trx_N0_%", "per_trx_frec_N0"),
        top("f_trx_hier", "per_trx_N1_%", "per_trx_frec_N1"),
        top("f_uni_hier", "per_uni_N0_%", "per_uni_frec_family"),
        top("f_uni_hier", "per_uni_N1_%", "per_uni_frec_subfamily"),
    ),
)
FEATURE_CTES = (
    "f_store f_top_store f_item_pro f_hour f_weekday f_channel f_totals f_family f_trx_hier "
    "f_uni_hier f_trx_n1 f_ntcr f_skus f_rent f_fctr f_top"
).split()
cte("feat", union(*[f"SELECT cid, name, val FROM {x}" for x in FEATURE_CTES]))

# Feature sets -----------------------------------------------------------------------


def like_any(column: str, patterns: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"{column} LIKE '{p}'" for p in patterns) + ")"


# The name patterns of the profile features and of the standardized ones.
PROFILE_PATTERNS = (
    "avg_units_trx", "per_sales_ntcr", "per_trx_channel_%", "per_trx_cuchi_store",
    "per_trx_hour_%", "per_trx_N0%", "per_trx_N1%", "per_trx_N2%", "per_trx_ntcr",
    "per_trx_store_%", "per_trx_weekday_%", "per_uni_N0%", "per_uni_N1%", "per_uni_N2%",
    "set_diversity", "skus_N1%", "total_stores", "trx_N1%", "item_pro_%",
)
SCALED_PATTERNS = (
    "avg_units_trx", "set_diversity", "skus_N1%", "total_stores", "trx_N1%", "per_sales_ntcr",
    "per_trx_ntcr",
)
cte(
    "chosen",
    f"""SELECT f.cid, f.name, f.val FROM feat f JOIN allc c ON f.cid = c.cid
        WHERE {like_any("f.name", PROFILE_PATTERNS)}""",
)
cte(
    "scale",
    f"""SELECT f.name, avg(val) AS av, stddev_pop(val) AS sd, min(val) AS lo, max(val) AS hi
        FROM feat f JOIN allc c ON f.cid = c.cid WHERE {like_any("f.name", SCALED_PATTERNS)}
        GROUP BY f.name HAVING stddev_pop(val) <> 0""",
)
cte(
    "fset",
    """SELECT c.cid, c.name, CASE WHEN s.name IS NULL THEN val ELSE (val - lo) / (hi - lo) END AS val
       FROM chosen c LEFT JOIN scale s ON c.name = s.name""",
)
cte("train_rows", "SELECT t.cid, t.target, f.name, f.val FROM train_cust t JOIN fset f ON t.cid = f.cid")
cte(
    "dict",
    """SELECT name, row_number() OVER (ORDER BY name) - 1 AS fidx
       FROM (SELECT DISTINCT name FROM train_rows)""",
)
cte(
    "cdict",
    """SELECT cid, row_number() OVER (ORDER BY cid) - 1 AS cidx
       FROM (SELECT DISTINCT cid FROM train_rows)""",
)
cte(
    "sdict",
    """SELECT cid, target, row_number() OVER (ORDER BY cid, target) - 1 AS cidx
       FROM (SELECT DISTINCT c.cid, c.target FROM allc c JOIN fset f ON c.cid = f.cid
             JOIN dict d ON f.name = d.name WHERE f.val IS NOT NULL)""",
)
cte(
    "fence",
    """SELECT quantile_cont(coalesce(val, 0), 0.25) AS q25, quantile_cont(coalesce(val, 0), 0.75) AS q75
       FROM feat f JOIN allc c ON f.cid = c.cid WHERE name = 'total_sales_amt'""",
)

# Profile rules, one statement after the other ----------------------------------------

cte(
    "scored",
    f"""SELECT c.cid, c.target, row_number() OVER (ORDER BY c.cid) - 1 AS cidx,
               CAST('0x' || substr(md5(c.cid || ':{SEED}:score'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS prob
        FROM allc c JOIN tot t ON c.cid = t.cid""",
)
NO_SCORE = "CAST(NULL AS BIGINT) AS cidx, CAST(NULL AS DOUBLE) AS prob, CAST(NULL AS INT) AS pred"
cte(
    "r_factura",
    f"""
    SELECT cid, cidx, prob, CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS pred, target,
           CASE WHEN target = 1 THEN 'gbt (BR - Factura)' ELSE 'gbt' END AS model,
           CASE WHEN target = 1 OR prob > 0.5 THEN 'typeB' ELSE 'typeA' END AS profile
    FROM scored
    UNION ALL
    SELECT a.cid, {NO_SCORE}, 1, 'gbt (BR - Factura)', 'typeB'
    FROM fctr a LEFT JOIN scored b ON a.cid = b.cid WHERE b.cid IS NULL
    """,
)
cte(
    "r_lp_in",
    f"""
    SELECT * FROM r_factura
    UNION ALL
    SELECT a.id, {NO_SCORE}, NULL, 'gbt (BR - LP)', 'typeB'
    FROM t_lp a LEFT JOIN r_factura b ON a.id = b.cid LEFT JOIN t_excluded x ON a.id = x.raw_id
         LEFT JOIN ve v ON a.id = v.cid
    WHERE b.cid IS NULL AND x.raw_id IS NULL AND v.cid IS NULL
    """,
)


def update(source: str, ids: str, label: str) -> str:
    test = f"cid IN (SELECT {ids})"
    return f"""
    SELECT cid, cidx, prob, pred, target,
           CASE WHEN {test} THEN 'gbt ({label})' ELSE model END AS model,
           CASE WHEN {test} THEN 'typeB' ELSE profile END AS profile
    FROM {source}"""


cte("r_lp", update("r_lp_in", "id FROM t_lp", "BR - LP"))
cte(
    "r_vvee",
    f"""SELECT * FROM r_lp UNION ALL
        SELECT a.cid, {NO_SCORE}, 1, 'gbt (BR - VVEE PRO)', 'typeB'
        FROM ve a LEFT JOIN r_lp b ON a.cid = b.cid WHERE b.cid IS NULL""",
)
cte(
    "r_sii_in",
    f"""SELECT * FROM r_vvee UNION ALL
        SELECT a.cid, {NO_SCORE}, NULL, 'gbt (BR - SII)', 'typeB'
        FROM ggee a LEFT JOIN r_vvee b ON a.cid = b.cid WHERE a.tranche < 7 AND b.cid IS NULL""",
)
cte("r_sii", update("r_sii_in", "cid FROM ggee", "BR - SII"))
cte(
    "r_ggee",
    f"""SELECT * FROM r_sii UNION ALL
        SELECT cid, {NO_SCORE}, NULL, 'gbt (BR - GGEE SII)', 'GGEE' FROM ggee WHERE tranche >= 7""",
)
cte(
    "r_l2a_in",
    f"""SELECT * FROM r_ggee UNION ALL
        SELECT a.cid, {NO_SCORE}, NULL, 'gbt (BR - L2A SII)', 'typeB'
        FROM ggee a LEFT JOIN r_ggee b ON a.cid = b.cid
        WHERE b.cid IS NULL AND a.tranche >= 4 AND a.tranche < 7""",
)
cte(
    "r_l2a_sii",
    update("r_l2a_in", "cid FROM ggee WHERE tranche >= 4 AND tranche < 7", "BR - L2A SII"),
)

# Necessity, level 2 -----------------------------------------------------------------

cte("l2_cust", "SELECT cid FROM r_l2a_sii WHERE profile = 'typeB'")
cte(
    "l2a",
    """SELECT c.cid FROM l2_cust c JOIN feat f ON c.cid = f.cid
       WHERE f.name = 'total_sales_amt' AND f.val > 600000""",
)
cte(
    "l2b",
    """SELECT c.cid FROM l2_cust c JOIN feat f ON c.cid = f.cid LEFT JOIN l2a a ON c.cid = a.cid
       WHERE a.cid IS NULL AND f.name = 'per_trx_frec_N0' AND f.val > 0.6
         AND c.cid IN (SELECT cid FROM feat WHERE name = 'total_transactions' AND val >= 3)""",
)
cte(
    "l2_seg",
    """SELECT cid, 0 AS cluster, 'L2A' AS seg FROM l2a UNION ALL SELECT cid, 1, 'L2B' FROM l2b
       UNION ALL SELECT c.cid, 2, 'L2C' FROM l2_cust c LEFT JOIN
         (SELECT cid FROM l2a UNION ALL SELECT cid FROM l2b) d ON c.cid = d.cid WHERE d.cid IS NULL""",
)
cte(
    "l2_rec",
    """SELECT *, CASE WHEN cid IN (SELECT cid FROM feat WHERE name = 'months_since_last_trx' AND val <= 6)
                      THEN 'NO FUGADO' ELSE 'FUGADO' END AS recency,
              CASE WHEN cid IN (SELECT cid FROM r_l2a_sii WHERE model LIKE '%L2A%')
                   THEN 'L2A' ELSE seg END AS seg2,
              'K-means - Decision Tree' || CASE
                   WHEN cid IN (SELECT cid FROM r_l2a_sii WHERE model LIKE '%L2A%')
                   THEN ' - BR SSII' ELSE '' END AS model2
       FROM l2_seg""",
)

# One statement per query --------------------------------------------------------------


def _features(name: str, names: str | None = None) -> str:
    where = f" WHERE {names}" if names else ""
    return f"SELECT cid AS customer_id, name AS feature_name, val AS feature_value FROM {name}{where}"


def _rule(name: str) -> str:
    return f"""SELECT 'CL' AS country_id, model, CAST(200101 AS BIGINT) AS period,
        cidx AS customer_idx, prob AS "prob_typeB", CAST(pred AS BIGINT) AS prediction,
        cid AS customer_id, CAST(target AS BIGINT) AS target, profile AS company_profile FROM {name}"""


COUNTED = "(SELECT cid, target, CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS pred FROM scored)"

STATEMENTS: dict[str, str] = {
    "scan_sources": union(
        *[
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"
            for name, table in {
                "sales": "t_sales",
                "items": "t_items",
                "exclusions": "t_excluded",
                "companies": "t_companies",
                "main_skus": "t_skus",
                "main_customers": "t_lp",
                "sii_data": "t_reg",
            }.items()
        ]
    ),
    "period_window": """
        SELECT period, CAST(CAST(date_to - INTERVAL 24 MONTH AS DATE) AS VARCHAR) AS date_from,
               CAST(date_to AS VARCHAR) AS date_to,
               CAST(CAST(date_to - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS date_to_inclusive
        FROM (SELECT DISTINCT CAST(year(dt) * 100 + month(dt) AS BIGINT) AS period,
                     CAST(date_trunc('month', dt) AS DATE) AS date_to FROM t_sales)""",
    "publish_results": "SELECT cid AS customer_id, target FROM allc",
    "csv_gzip_roundtrip": _features("f_totals"),
    "canonical_customer": """
        SELECT cid AS customer_id, raw_customer_id, main_customer_id, count(*) AS sale_lines
        FROM t_lines GROUP BY ALL""",
    "valid_sales": """
        SELECT cid AS customer_id, item_id, CAST(dt AS VARCHAR) AS sales_return_dt,
               kind AS sales_return_type_cd, doc AS sales_return_document_num, loc AS location_id,
               CAST(amt AS DOUBLE) AS st_extended_net_amt, CAST(units AS DOUBLE) AS unit_cnt
        FROM t_lines WHERE country_id = 'CL' AND business_unit_id = 'ENT'
          AND dt >= DATE '1999-01-01' AND dt < DATE '2001-01-01'
          AND kind IN ('blta', 'fctr') AND amt > 0 AND units > 0""",
    "safe_item_key": "SELECT item_id, ikey AS item_key, count(*) AS sale_lines FROM t_lines GROUP BY ALL",
    "months_since_last": """
        SELECT cid AS customer_id,
               date_diff('month', max(dt), DATE '2001-01-01') AS months_since_last_trx
        FROM t_lines WHERE dt < DATE '2001-01-01' GROUP BY cid""",
    "join_sales_items": """
        SELECT cid AS customer_id, doc AS sales_return_document_num, item_id,
               cat_item AS catalog_item_id, family AS hier_family_cd, subfamily AS hier_subfamily_cd
        FROM sold""",
    "join_exclusions_anti": """
        SELECT DISTINCT s.cid AS customer_id FROM t_lines s LEFT JOIN t_excl e ON s.cid = e.id
        WHERE e.id IS NULL""",
    "join_tranche_tristate": """
        SELECT DISTINCT s.cid AS customer_id FROM t_lines s LEFT JOIN t_reg g ON s.cid = g.id
        WHERE g.id IS NULL OR g.tranche < 7""",
    "join_scalar_subquery": """
        SELECT f.cid AS customer_id, f.val AS feature_value FROM feat f JOIN allc c ON f.cid = c.cid
        WHERE f.name = 'total_sales_amt' AND f.val < (SELECT q75 + 3.0::DOUBLE * (q75 - q25) FROM fence)""",
    "distinct_transactions": """
        SELECT cid AS customer_id, kind AS sales_return_type_cd,
               count(DISTINCT trx) AS transactions, CAST(sum(units) AS DOUBLE) AS units,
               CAST(sum(amt) AS DOUBLE) AS amount
        FROM t_lines GROUP BY ALL""",
    "cohort_ve": "SELECT cid AS customer_id FROM ve",
    "cohort_ggee": "SELECT cid AS customer_id, CAST(tranche AS INT) AS sales_tranche FROM ggee",
    "cohort_fctr": "SELECT cid AS customer_id FROM fctr",
    "cohort_fctr_list": "SELECT cid AS customer_id FROM fctr_list",
    "cohort_blta": "SELECT cid AS customer_id FROM blta",
    "all_customers": "SELECT cid AS customer_id, target FROM allc",
    "all_customers_ve": "SELECT cid AS customer_id FROM allve",
    "fctr_data": """
        SELECT cid AS customer_id, trx_all AS total_transactions, trx_fctr AS total_transactions_fctr,
               amt_all AS total_sales_amt, amt_fctr AS total_sales_amt_fctr,
               units_all AS total_units_cnt, units_fctr AS total_units_cnt_fctr FROM fctr_tot""",
    "ntile_filter": """
        SELECT cid AS customer_id, trx_tile AS transactions_tile, amt_tile AS sales_tile,
               units_tile FROM tiles""",
    "pro_customers": """
        SELECT cid AS customer_id, trx_all AS total_transactions, amt_all AS total_sales_amt,
               units_all AS total_units_cnt FROM pro""",
    "cohort_counts": """
        SELECT 'TOTAL_FCTR' AS cohort, count(DISTINCT cid) AS customers FROM fctr_tot
        UNION ALL SELECT 'TOTAL_PRO', count(DISTINCT cid) FROM pro""",
    "sample_exact_n": "SELECT cid AS customer_id FROM home",
    "sample_fraction": f"""
        SELECT cid AS customer_id, target FROM
          (SELECT cid, target, row_number() OVER (PARTITION BY target
                  ORDER BY md5(cid || ':{SEED}:share'), cid) / count(*) OVER (PARTITION BY target) AS part
           FROM train_cust)
        WHERE part <= 0.4""",
    "totals": """
        SELECT cid AS customer_id, units AS total_units_cnt, amt AS total_sales_amt,
               stores AS total_stores, items AS total_distinct_items, sets AS total_distinct_sets,
               depts AS per_distinct_departments, trx AS total_transactions,
               months AS months_since_last_trx FROM tot""",
    "feat_per_trx_store": _features("f_store"),
    "feat_top_store": _features("f_top_store"),
    "feat_item_pro": _features("f_item_pro"),
    "feat_per_trx_hour": _features("f_hour"),
    "feat_per_trx_weekday": _features("f_weekday"),
    "feat_per_trx_channel": _features("f_channel"),
    "feat_from_totals": _features("f_totals"),
    "feat_family_completeness": _features("f_family"),
    "feat_per_trx_hier": _features("f_trx_hier"),
    "feat_per_uni_hier": _features("f_uni_hier"),
    "feat_trx_hier": _features("f_trx_n1"),
    "feat_ntcr": _features("f_ntcr"),
    "feat_skus": _features("f_skus"),
    "feat_per_trx_rent": _features("f_rent"),
    "feat_per_trx_fctr": _features("f_fctr"),
    "feat_top_share": _features("f_top"),
    "feat_label_share": _features(
        "(" + share("'per_trx_type_' || b.kind || '_' || trim(b.dept)") + ") AS x"
    ),
    "top_share": _features("(" + top("feat", "per_trx_N0_%", "top_N0") + ") AS x"),
    "all_features": _features("feat"),
    "feature_select": _features("chosen"),
    "std_fit": """
        SELECT CAST(200101 AS INT) AS period, 'MinMax' AS std_type, name AS feature_name,
               round(av, 6) AS avg_feature, round(sd, 6) AS std_dev_feature, lo AS min_value,
               hi AS max_value FROM scale""",
    "std_apply_minmax": _features("fset"),
    "std_apply_z": """
        SELECT c.cid AS customer_id, c.name AS feature_name,
               round(CASE WHEN s.name IS NULL THEN val ELSE (val - av) / sd END, 6) AS feature_value
        FROM chosen c LEFT JOIN scale s ON c.name = s.name""",
    "std_inverse": """
        SELECT cid AS customer_id, name AS feature_name, round(val, 6) AS feature_value FROM chosen""",
    "outlier_fence": """
        SELECT round(q25, 4) AS q25, round(q75, 4) AS q75,
               round(q75 + 3.0::DOUBLE * (q75 - q25), 4) AS fence FROM fence""",
    "drop_outliers": """
        SELECT f.cid AS customer_id FROM feat f JOIN allc c ON f.cid = c.cid
        WHERE (name = 'total_transactions' AND val >= 3)
           OR (name = 'total_sales_amt' AND val < (SELECT q75 + 3.0::DOUBLE * (q75 - q25) FROM fence))
        GROUP BY f.cid HAVING count(DISTINCT name) = 2""",
    "training_long": """
        SELECT cid AS customer_id, target, name AS feature_name, val AS feature_value
        FROM train_rows""",
    "feature_dictionary": "SELECT name AS feature_name, fidx AS feature_idx FROM dict",
    "customer_dictionary": "SELECT cid AS customer_id, cidx AS customer_idx FROM cdict",
    "training_set": """
        SELECT r.cid AS customer_id, target, r.name AS feature_name, val AS feature_value,
               fidx AS feature_idx, cidx AS customer_idx
        FROM train_rows r JOIN dict d ON r.name = d.name JOIN cdict c ON r.cid = c.cid""",
    "scoring_set": """
        SELECT s.cid AS customer_id, cidx AS customer_idx, f.name AS feature_name,
               fidx AS feature_idx, val AS feature_value, target
        FROM sdict s JOIN fset f ON s.cid = f.cid JOIN dict d ON f.name = d.name""",
    "feature_vectors": """
        SELECT cid AS customer_id, max(target) AS target, (SELECT count(*) FROM dict) AS width,
               count(*) FILTER (WHERE val <> 0) AS nonzero, round(sum(val), 6) AS total
        FROM train_rows GROUP BY cid""",
    "train_test_split": f"""
        SELECT cid AS customer_id, target,
               CAST('0x' || substr(md5(cid || ':{SEED}:split'), 1, 8) AS BIGINT)
                   < CAST(floor(0.7 * 4294967296) AS BIGINT) AS is_train
        FROM train_cust""",
    "classifier_metrics": f"""
        SELECT tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
               round(tn * 100.0::DOUBLE / n, 6) AS true_negatives_pct,
               round(fp * 100.0::DOUBLE / n, 6) AS false_positives_pct,
               round(fn * 100.0::DOUBLE / n, 6) AS false_negatives_pct,
               round(tp * 100.0::DOUBLE / n, 6) AS true_positives_pct,
               round((tp + tn)::DOUBLE / n, 6) AS accuracy,
               round((tp::DOUBLE * tn - fp::DOUBLE * fn)
                     / sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS matthews
        FROM (SELECT count(*) AS n,
                     count(*) FILTER (WHERE target = 0 AND pred = 0) AS tn,
                     count(*) FILTER (WHERE target = 0 AND pred = 1) AS fp,
                     count(*) FILTER (WHERE target = 1 AND pred = 0) AS fn,
                     count(*) FILTER (WHERE target = 1 AND pred = 1) AS tp FROM {COUNTED})""",
    "rule_factura": _rule("r_factura"),
    "rule_lp": _rule("r_lp"),
    "rule_vvee": _rule("r_vvee"),
    "rule_sii": _rule("r_sii"),
    "rule_ggee": _rule("r_ggee"),
    "rule_l2a_sii": _rule("r_l2a_sii"),
    "profile_rules": """
        SELECT company_profile, model, count(*) AS customers,
               count("prob_typeB") AS scored FROM (SELECT profile AS company_profile, model,
               prob AS "prob_typeB" FROM r_l2a_sii) GROUP BY ALL""",
    "profile_subset": "SELECT cid AS customer_id FROM l2_cust",
    "l1_fill": """
        SELECT s.cid AS customer_id, s.cidx AS customer_idx,
               CAST(CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS cluster_id,
               CASE WHEN prob > 0.5 THEN 'typeB_B' ELSE 'typeB_A' END AS necessity_lvl_1
        FROM scored s JOIN (SELECT DISTINCT cid FROM l2_cust) c ON s.cid = c.cid
        UNION ALL
        SELECT c.cid, -1, 0, 'typeB_A' FROM l2_cust c LEFT JOIN scored s ON c.cid = s.cid
        WHERE s.cid IS NULL""",
    "l2_assign": """
        SELECT cid AS customer_id, CAST(cluster AS BIGINT) AS cluster_id, seg AS necessity_lvl_2
        FROM l2_seg""",
    "l2_override": """
        SELECT cid AS customer_id, model2 AS model, CAST(cluster AS BIGINT) AS cluster_id,
               seg2 AS necessity_lvl_2 FROM l2_rec""",
    "l2_recency": "SELECT cid AS customer_id, recency AS necessity_lvl_2_recency FROM l2_rec",
    "final_results": """
        SELECT 'CL' AS country_id, p.cid AS customer_id, p.profile AS company_profile,
               n.seg2 AS company_necessity, n.recency AS company_recency_status
        FROM r_l2a_sii p LEFT JOIN l2_rec n ON p.cid = n.cid""",
}


# Models with fixed coefficients, centres and cuts ---------------------------------------

cte(
    "logit",
    """SELECT r.cid, max(target) AS target, max(cidx) AS cidx,
              1 / (1 + exp(-(sum(coalesce(val, 0) * (fidx % 7 - 3) / 10.0::DOUBLE) - 0.05::DOUBLE)))
                  AS prob,
              sum(val * val) AS squares, sum(val) AS total
       FROM train_rows r JOIN dict d ON r.name = d.name JOIN cdict c ON r.cid = c.cid
       GROUP BY r.cid""",
)
cte("totals_of", "SELECT DISTINCT name FROM f_totals")
cte(
    "totals_wide",
    f"""SELECT cid, CAST('0x' || substr(md5(cid || ':{SEED}:cluster'), 1, 6) AS BIGINT) % 3 AS cluster,
               max(CASE WHEN name = 'total_stores' THEN val ELSE 0 END) AS stores,
               max(CASE WHEN name = 'total_transactions' THEN val ELSE 0 END) AS trx,
               max(CASE WHEN name = 'months_since_last_trx' THEN val ELSE 0 END) AS months,
               sqrt(sum(val * val)) AS from_zero,
               sqrt(sum((val - 1) * (val - 1)) + (SELECT count(*) FROM totals_of) - count(*))
                   AS from_one
        FROM f_totals GROUP BY cid""",
)
IN_HALF = f"CAST('0x' || substr(md5(a.cid || ':{SEED}:half'), 1, 8) AS BIGINT) < 2147483648"
cte(
    "scale_half",
    f"""SELECT f.name, min(val) AS lo, max(val) AS hi
        FROM feat f JOIN allc a ON f.cid = a.cid
        WHERE {like_any("f.name", SCALED_PATTERNS)} AND {IN_HALF}
        GROUP BY f.name HAVING stddev_pop(val) <> 0""",
)

STATEMENTS |= {
    "score_fixed": """
        SELECT cid AS customer_id, cidx AS customer_idx, round(prob, 6) AS "prob_typeB",
               CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS prediction FROM logit""",
    "test_predictions_fixed": f"""
        SELECT cidx AS customer_idx, CAST(target AS BIGINT) AS target, round(prob, 6) AS "prob_typeB",
               CAST(CASE WHEN prob > 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction,
               'CL' AS country_id, 'gbt' AS model, CAST(200101 AS BIGINT) AS period
        FROM logit
        WHERE CAST('0x' || substr(md5(cid || ':{SEED}:split'), 1, 8) AS BIGINT)
              >= CAST(floor(0.7 * 4294967296) AS BIGINT)""",
    "coefficients_fixed": """
        SELECT 'CL' AS country_id, 'gbt' AS model, fidx AS feature_idx,
               (fidx % 7 - 3) / 10.0::DOUBLE AS coef, name AS feature_name FROM dict""",
    "score_l1_fixed": """
        SELECT cid AS customer_id, cidx AS customer_idx, CAST(nearer AS BIGINT) AS cluster_id,
               CASE WHEN nearer = 1 THEN 'typeB_B' ELSE 'typeB_A' END AS necessity_lvl_1
        FROM (SELECT *, CASE WHEN 0.0625::DOUBLE * (SELECT count(*) FROM dict) < 0.5::DOUBLE * total
                             THEN 1 ELSE 0 END AS nearer FROM logit)""",
    "cluster_summary_fixed": """
        SELECT CAST(cluster AS INT) AS cluster, count(*) AS customers,
               round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM totals_wide), 4) AS percentage,
               round(avg(least(from_zero, from_one)), 4) AS distance_mean,
               round(stddev_samp(least(from_zero, from_one)), 4) AS distance_std,
               round(avg(stores), 4) AS total_stores_mean,
               round(stddev_samp(stores), 4) AS total_stores_std,
               round(avg(trx), 4) AS total_transactions_mean,
               round(stddev_samp(trx), 4) AS total_transactions_std
        FROM totals_wide GROUP BY cluster""",
    "surrogate_tree_fixed": """
        SELECT cid AS customer_id, CASE WHEN stores > 3 THEN 2 WHEN months <= 6 THEN 0 ELSE 1 END
               AS cluster FROM totals_wide""",
    "std_apply_subset": """
        SELECT c.cid AS customer_id, c.name AS feature_name,
               round(CASE WHEN s.name IS NULL THEN val ELSE (val - lo) / (hi - lo) END, 6)
                   AS feature_value
        FROM chosen c LEFT JOIN scale_half s ON c.name = s.name""",
}

# Certificates: what a settled fit has to show, for as many customers as SQL counts.
cte(
    "need_fence",
    """SELECT quantile_cont(coalesce(val, 0), 0.25) AS q25, quantile_cont(coalesce(val, 0), 0.75) AS q75
       FROM feat f JOIN l2_cust c ON f.cid = c.cid WHERE f.name = 'total_sales_amt'""",
)
cte(
    "need_kept",
    """SELECT f.cid FROM feat f JOIN l2_cust c ON f.cid = c.cid
       WHERE (name = 'total_transactions' AND val >= 3)
          OR (name = 'total_sales_amt'
              AND val < (SELECT q75 + 3.0::DOUBLE * (q75 - q25) FROM need_fence))
       GROUP BY f.cid HAVING count(DISTINCT name) = 2""",
)
SETTLED = "SELECT count(*) AS customers, count(*) AS nearest, true AS centred FROM {}"
NEED_SETTLED = SETTLED.format("need_kept")
TRAINING_CUSTOMERS = "(SELECT DISTINCT cid FROM train_rows)"

# The exhaustive search for a tree of depth 2: every midpoint of every node.
cte(
    "cut_values",
    """SELECT w.cid, w.cluster, n.name, coalesce(f.val, 0) AS val
       FROM totals_wide w CROSS JOIN totals_of n
       LEFT JOIN f_totals f ON f.cid = w.cid AND f.name = n.name""",
)


def _cuts(level: int, nodes: str) -> None:
    """Best cuts of the nodes (cid, node) of a level, as cut_<level>."""
    parts, wholes = [f"l{c}" for c in range(3)], [f"t{c}" for c in range(3)]
    rests = [f"({t} - {p})" for t, p in zip(wholes, parts)]

    def purity(counts: list[str]) -> str:
        squares = " + ".join(f"{c} * {c}" for c in counts)
        return f"CAST({squares} AS DOUBLE) / CAST({' + '.join(counts)} AS DOUBLE)"

    sums = ", ".join(
        f"sum(n{c}) OVER upto AS l{c}, sum(n{c}) OVER (PARTITION BY node, name) AS t{c}"
        for c in range(3)
    )
    counts = ", ".join(f"count(CASE WHEN cluster = {c} THEN 1 END) AS n{c}" for c in range(3))
    cte(
        f"cut_{level}",
        f"""SELECT node, name, cut FROM (
                SELECT *, row_number() OVER (
                           PARTITION BY node ORDER BY {purity(parts)} + {purity(rests)} DESC,
                                                      name, val) AS place
                FROM (SELECT node, name, val, (val + lead(val) OVER upto) / 2 AS cut, {sums}
                      FROM (SELECT node, name, val, {counts}
                            FROM cut_values v JOIN ({nodes}) p ON v.cid = p.cid
                            GROUP BY node, name, val)
                      WINDOW upto AS (PARTITION BY node, name ORDER BY val))
                WHERE cut IS NOT NULL AND greatest(t0, t1, t2) < t0 + t1 + t2)
            WHERE place = 1""",
    )


_cuts(0, "SELECT cid, 0 AS node FROM totals_wide")
_cuts(
    1,
    """SELECT v.cid, CASE WHEN v.val <= c.cut THEN 1 ELSE 2 END AS node
       FROM cut_values v JOIN cut_0 c ON v.name = c.name""",
)

STATEMENTS |= {
    "kmeans_l2_certificate": NEED_SETTLED,
    "kmeans_pca_certificate": NEED_SETTLED,
    "kmeans_l1_certificate": SETTLED.format(TRAINING_CUSTOMERS),
    "train_logreg_certificate": f"SELECT count(*) AS customers, true AS optimal FROM {TRAINING_CUSTOMERS}",
    "tree_thresholds_fixed": """
        SELECT CAST(node AS BIGINT) AS node, name AS feature_name, round(cut, 6) AS threshold
        FROM (SELECT * FROM cut_0 UNION ALL SELECT * FROM cut_1)""",
}

STATEMENTS |= {
    "publish_partitions": """
        SELECT cid AS customer_id, target, period
        FROM allc CROSS JOIN (VALUES (200101), (200102)) AS p(period)""",
    "csv_quarantine": """
        SELECT CASE WHEN l_orderkey % 50 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS number,
               CASE WHEN l_orderkey % 50 <> 0 THEN code END AS item,
               CASE WHEN l_orderkey % 50 = 0 THEN '?' || CAST(l_orderkey AS VARCHAR) || ',' || code
               END AS line
        FROM (SELECT l_orderkey, CASE WHEN l_partkey % 211 = 0 THEN 'X' || CAST(l_partkey AS VARCHAR)
                                      ELSE lpad(CAST(l_partkey AS VARCHAR), 8, '0') END AS code
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
}

STATEMENTS |= {
    "all_features_merged": STATEMENTS["all_features"],
    "cohort_state_merged": """
        SELECT cid AS customer_id, bool_or(area = 'VE') AS direct,
               bool_or(amt > 0 AND units > 0) AS bought,
               bool_or(amt > 0 AND units > 0 AND kind = 'fctr') AS invoice,
               bool_or(amt > 0 AND units > 0 AND kind = 'blta' AND dt >= DATE '1999-01-01') AS receipt
        FROM hist WHERE kind IN ('blta', 'fctr') GROUP BY cid""",
}

# What another invoice cohort changes.
LISTED = ("all_features", "training_set", "profile_rules", "fctr_data")


def oracle_sql() -> dict[str, str]:
    derived = {name: with_ctes(sql) for name, sql in STATEMENTS.items()}
    listed = {"fctr": CTES["fctr_list"]}
    given = {f"{name}_listed": with_ctes(STATEMENTS[name], listed) for name in LISTED}
    return derived | given | {
        "all_customers_listed": with_ctes(STATEMENTS["publish_results"], listed)
    }
