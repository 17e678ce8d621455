"""The registered queries as SQL over the driver's tables, written independently of the operators."""

from __future__ import annotations

import re

# Common table expressions in dependency order. A statement gets those it names, directly or not.
CTES: dict[str, str] = {
    "lines": """
        SELECT 'X' AS one_type, p.p_type,
               CAST(year(l.l_shipdate) AS INTEGER) AS y, CAST(month(l.l_shipdate) AS INTEGER) AS m,
               c.c_nationkey + 1 AS rep, s.s_nationkey + 1 AS par,
               l.l_returnflag AS rf, l.l_linestatus AS ls, l.l_quantity AS qty, l.l_extendedprice AS val
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey AND n.n_regionkey = 3
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN part p ON l.l_partkey = p.p_partkey""",
    "partners": """
        SELECT n_nationkey + 1 AS "partnerCode",
               CASE WHEN right(n_name, 2) = '_2' THEN n_name || ', NES' ELSE n_name END AS "partnerName",
               lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS iso2,
               'N' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS iso3,
               right(n_name, 2) = '_2' OR n_nationkey + 1 IN (22, 25) AS is_special_partner
        FROM nation""",
    "reporters": """
        SELECT n_nationkey + 1 AS "reporterCode",
               'N' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS "reporterName"
        FROM nation WHERE n_regionkey = 3""",
    "distances": """
        SELECT CASE WHEN right(n_name, 2) = '_2' THEN n_name || ', NES' ELSE n_name END AS "partnerName",
               'PORT_' || CAST(n_nationkey AS VARCHAR) AS port,
               1000 + 137 * n_nationkey AS nm_to_rotterdam,
               CASE n_nationkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'verified_proxy_port'
                    ELSE 'estimated' END AS confidence
        FROM nation WHERE n_nationkey <= 17""",
}

# The chain from raw lines to flows exists twice: for one commodity, and per part type.
_CHAIN = {
    "raw{s}": """
        SELECT y AS "refYear", m AS "refMonth", rep AS "reporterCode",
               CASE WHEN GROUPING(par) = 1 THEN 0 ELSE par END AS "partnerCode",
               0 AS "partner2Code",
               CASE WHEN GROUPING(par) = 1 AND (rep + m) % 7 = 0 THEN 0.0 ELSE SUM(qty) END AS "netWgt",
               round(SUM(val), 2) AS "primaryValue",
               CAST(SUM(qty) AS BIGINT) % 5 = 0 AS "isNetWgtEstimated",
               CASE WHEN GROUPING(rf) = 1 THEN 0 ELSE ascii(rf) END AS "motCode",
               CASE WHEN GROUPING(ls) = 1 THEN 'C00' ELSE 'C0' || ls END AS "customsCode",
               'M' AS "flowCode", {t} AS "cmdCode"
        FROM lines
        GROUP BY GROUPING SETS (({t}, y, m, rep), ({t}, y, m, rep, par),
                                ({t}, y, m, rep, par, rf), ({t}, y, m, rep, par, ls))""",
    "totals{s}": """
        SELECT "refYear", "refMonth", "reporterCode", "partnerCode",
               "netWgt", "primaryValue", "isNetWgtEstimated", "cmdCode"
        FROM raw{s} WHERE "motCode" = 0 AND "customsCode" = 'C00' AND "partner2Code" = 0""",
    "named{s}": """
        SELECT t.*, p."partnerName", p.iso2, p.iso3, p.is_special_partner, r."reporterName"
        FROM totals{s} t
        LEFT JOIN partners p USING ("partnerCode")
        LEFT JOIN reporters r USING ("reporterCode")
        WHERE t."partnerCode" <> 0""",
    "zeros{s}": """
        SELECT g.* FROM
          (SELECT * FROM
             (SELECT DISTINCT "cmdCode", "reporterCode", "refYear", "refMonth" FROM named{s})
             JOIN (SELECT DISTINCT "cmdCode", "reporterCode", "reporterName", "partnerCode", "partnerName",
                          iso2, iso3, is_special_partner FROM named{s})
             USING ("cmdCode", "reporterCode")) g
        ANTI JOIN (SELECT * FROM named{s} WHERE "netWgt" IS NOT NULL) f
          USING ("cmdCode", "reporterCode", "partnerCode", "refYear", "refMonth")""",
    "flows{s}": """
        SELECT "cmdCode", "refYear", "refMonth", "reporterCode", "reporterName", "partnerCode",
               "partnerName", iso2, iso3, is_special_partner, "netWgt", "primaryValue", "isNetWgtEstimated"
        FROM named{s}
        UNION ALL
        SELECT "cmdCode", "refYear", "refMonth", "reporterCode", "reporterName", "partnerCode",
               "partnerName", iso2, iso3, is_special_partner, 0.0, NULL, NULL
        FROM zeros{s}""",
    "extra{s}": """
        SELECT * FROM flows{s}
        WHERE is_special_partner = false
          AND "partnerCode" NOT IN (SELECT DISTINCT "reporterCode" FROM flows)""",
    "top{s}": """
        SELECT * FROM (
          SELECT "cmdCode", "partnerName", SUM("netWgt") / 1000 AS total_t,
                 row_number() OVER (PARTITION BY "cmdCode" ORDER BY SUM("netWgt") DESC, "partnerName") AS rank
          FROM extra{s} GROUP BY "cmdCode", "partnerName") WHERE rank <= 6""",
    "monthly{s}": """
        SELECT e."cmdCode", e."refYear", e."refMonth", coalesce(t."partnerName", 'Other') AS origin,
               SUM(e."netWgt") / 1000 AS tonnes
        FROM extra{s} e LEFT JOIN top{s} t USING ("cmdCode", "partnerName")
        GROUP BY ALL""",
    "shares{s}": """
        SELECT *, tonnes / nullif(SUM(tonnes) OVER (PARTITION BY "cmdCode", "refYear", "refMonth"), 0) * 100
                  AS share_pct
        FROM monthly{s}""",
    "miles{s}": """
        SELECT "cmdCode", "refYear", "refMonth", SUM("netWgt") / 1000 AS extra_zone_tonnes,
               SUM("netWgt" * nm_to_rotterdam) / 1000 AS tonne_nm,
               SUM("netWgt" * nm_to_rotterdam) / nullif(SUM("netWgt"), 0) AS avg_distance_nm
        FROM extra{s} JOIN distances USING ("partnerName")
        GROUP BY "cmdCode", "refYear", "refMonth"
        """,
    "price_flow{s}": """
        SELECT v.*, make_date("refYear", "refMonth", 1) AS d, c.crack_spread_usd_bbl
        FROM (SELECT "cmdCode", "refYear", "refMonth", SUM("netWgt") / 1000 AS extra_zone_tonnes
              FROM extra{s} GROUP BY ALL) v
        JOIN spread c USING ("refYear", "refMonth")""",
    "levels{s}": """
        SELECT "cmdCode", d, extra_zone_tonnes AS x, crack_spread_usd_bbl AS p FROM price_flow{s}""",
}

_PRICES = {
    "points": """
        SELECT 'brent_usd_bbl' AS series, strftime(o_orderdate, '%Y-%m') AS period,
               CAST((20 * SUM(CAST(round(o_totalprice * 100) AS BIGINT)) + COUNT(o_totalprice))
                    // (2 * COUNT(o_totalprice)) AS DOUBLE) / 1000000 AS value
        FROM orders GROUP BY ALL
        UNION ALL
        SELECT 'diesel_usd_gal', strftime(l_shipdate, '%Y-%m'),
               round(AVG(l_extendedprice / nullif(l_quantity, 0)) / 1000, 6)
        FROM lineitem GROUP BY ALL""",
    "prices": """
        SELECT b.value AS brent_usd_bbl, d.value AS diesel_usd_gal,
               CAST(split_part(period, '-', 1) AS INTEGER) AS "refYear",
               CAST(split_part(period, '-', 2) AS INTEGER) AS "refMonth", period
        FROM (SELECT * FROM points WHERE series = 'brent_usd_bbl') b
        FULL JOIN (SELECT * FROM points WHERE series = 'diesel_usd_gal') d USING (period)
        WHERE period BETWEEN '1995-01' AND '2001-12'""",
    "spread": """
        SELECT "refYear", "refMonth", brent_usd_bbl, diesel_usd_gal, diesel_usd_gal * 42 AS diesel_usd_bbl,
               diesel_usd_gal * 42 - brent_usd_bbl AS crack_spread_usd_bbl
        FROM prices""",
}

_DERIVED = {
    "landed_lines": """
        SELECT raw.*, "reporterName" AS iso3 FROM raw JOIN reporters USING ("reporterCode")
        WHERE ("reporterCode" + "refYear") % 13 <> 5 AND ("reporterCode" + "refYear") % 11 <> 0""",
    "landed_files": """
        SELECT DISTINCT "reporterName" AS iso3, "refYear" AS year
        FROM raw JOIN reporters USING ("reporterCode") WHERE ("reporterCode" + "refYear") % 13 <> 5""",
    "grid": """
        SELECT "reporterCode", "reporterName" AS iso3, CAST(y AS INTEGER) AS year
        FROM reporters, range(1995, 2002) AS years(y)""",
    "report": """
        SELECT g.iso3 AS reporter, g.year, f.iso3 IS NOT NULL AS file_exists,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.n_rows, 0) END AS n_rows,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.n_months, 0) END AS n_months,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.months_present, '') END AS months_present,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.n_partners, 0) END AS n_partners,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.has_world_line, false) END AS has_world_line,
               a.world_gap_pct,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.n_zero_netwgt, 0) END AS n_zero_netwgt,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.n_estimated_wgt, 0) END AS n_estimated_wgt,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.mot_codes, '') END AS mot_codes,
               CASE WHEN f.iso3 IS NOT NULL THEN coalesce(a.customs_codes, '') END AS customs_codes
        FROM grid g
        LEFT JOIN landed_files f ON f.iso3 = g.iso3 AND f.year = g.year
        LEFT JOIN (
          SELECT iso3, "refYear" AS year, COUNT(*) AS n_rows,
                 COUNT(DISTINCT "refMonth") AS n_months,
                 array_to_string(CAST(list_sort(list(DISTINCT "refMonth")) AS VARCHAR[]), ',') AS months_present,
                 COUNT(DISTINCT "partnerCode") AS n_partners,
                 bool_or("partnerCode" = 0) AS has_world_line,
                 abs(SUM(CASE WHEN "partnerCode" = 0 THEN coalesce("netWgt", 0) ELSE 0 END)
                     - SUM(CASE WHEN "partnerCode" <> 0 THEN coalesce("netWgt", 0) ELSE 0 END))
                   / nullif(SUM(CASE WHEN "partnerCode" = 0 THEN coalesce("netWgt", 0) ELSE 0 END), 0) * 100
                   AS world_gap_pct,
                 COUNT(*) FILTER (coalesce("netWgt", 0) = 0) AS n_zero_netwgt,
                 COUNT(*) FILTER ("isNetWgtEstimated") AS n_estimated_wgt,
                 array_to_string(CAST(list_sort(list(DISTINCT "motCode")) AS VARCHAR[]), ',') AS mot_codes,
                 array_to_string(list_sort(list(DISTINCT "customsCode")), ',') AS customs_codes
          FROM landed_lines GROUP BY 1, 2) a ON a.iso3 = g.iso3 AND a.year = g.year""",
    "recon": """
        SELECT * FROM
          (SELECT "cmdCode", "reporterCode", "refYear", "refMonth", coalesce(SUM("netWgt"), 0) AS detail
           FROM totals WHERE "partnerCode" <> 0 GROUP BY ALL)
          JOIN (SELECT "cmdCode", "reporterCode", "refYear", "refMonth", coalesce(SUM("netWgt"), 0) AS world
                FROM totals WHERE "partnerCode" = 0 GROUP BY ALL)
          USING ("cmdCode", "reporterCode", "refYear", "refMonth")
        WHERE world > 0""",
    "recon_by_type": """
        SELECT * FROM
          (SELECT "cmdCode", "reporterCode", "refYear", "refMonth", coalesce(SUM("netWgt"), 0) AS detail
           FROM totals_by_type WHERE "partnerCode" <> 0 GROUP BY ALL)
          JOIN (SELECT "cmdCode", "reporterCode", "refYear", "refMonth", coalesce(SUM("netWgt"), 0) AS world
                FROM totals_by_type WHERE "partnerCode" = 0 GROUP BY ALL)
          USING ("cmdCode", "reporterCode", "refYear", "refMonth")
        WHERE world > 0""",
    "all_top": """
        SELECT "partnerName", SUM("netWgt") / 1000 AS total_t FROM flows WHERE is_special_partner = false
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6""",
    "own_shares": """
        SELECT "refYear", "refMonth", "partnerName" AS origin, SUM("netWgt") / 1000 AS tonnes,
               SUM("netWgt") / nullif(SUM(SUM("netWgt")) OVER (PARTITION BY "refYear", "refMonth"), 0) * 100
                 AS share_pct
        FROM extra GROUP BY 1, 2, 3""",
    "cover": """
        SELECT "partnerName", SUM("netWgt") / 1000 AS tonnes,
               SUM(SUM("netWgt")) OVER (ORDER BY SUM("netWgt") DESC)
                 / nullif(SUM(SUM("netWgt")) OVER (), 0) * 100 AS cumulative_pct
        FROM extra GROUP BY 1""",
    "changes": """
        SELECT "cmdCode", d, x - lag(x) OVER w AS x, p - lag(p) OVER w AS p
        FROM levels WINDOW w AS (PARTITION BY "cmdCode" ORDER BY d)""",
}

CTES.update({k.format(s=""): v.format(s="", t="one_type") for k, v in _CHAIN.items()})
CTES.update({k.format(s="_by_type"): v.format(s="_by_type", t="p_type") for k, v in _CHAIN.items()})
# The zone of a chain is read off its own flows.
CTES["extra_by_type"] = CTES["extra_by_type"].replace("FROM flows)", "FROM flows_by_type)")
# Declarations with flaws: World lines that disagree with their partners, lines without a weight.
_FLAWED = {k.format(s="_flawed"): v.format(s="_flawed", t="one_type") for k, v in _CHAIN.items()}
_FLAWED["raw_flawed"] = """
        SELECT * REPLACE (
          CASE WHEN "partnerCode" = 0 AND "motCode" = 0 AND "customsCode" = 'C00' AND ("reporterCode" + "refMonth") % 5 = 0
               THEN "netWgt" * 1.25 + 1
               WHEN "partnerCode" = 0 AND ("reporterCode" + "refMonth") % 11 = 0 THEN NULL
               WHEN "partnerCode" <> 0 AND ("reporterCode" + "refMonth" + "partnerCode") % 9 = 0 THEN NULL
               ELSE "netWgt" END AS "netWgt")
        FROM raw"""
_FLAWED["extra_flawed"] = _FLAWED["extra_flawed"].replace("FROM flows)", "FROM flows_flawed)")
CTES.update(_FLAWED)
# Prices come before the chain, which joins them.
CTES = {**_PRICES, **CTES, **_DERIVED}
CTES["recon_flawed"] = _DERIVED["recon"].replace("FROM totals", "FROM totals_flawed")

FLOW_COLUMNS = (
    '"refYear", "refMonth", "reporterCode", "reporterName", "partnerCode", "partnerName", '
    'iso2, iso3, is_special_partner, "netWgt", "primaryValue", "isNetWgtEstimated"'
)
RAW_COLUMNS = (
    '"refYear", "refMonth", "reporterCode", "partnerCode", "partner2Code", "netWgt", "primaryValue", '
    '"isNetWgtEstimated", "motCode", "customsCode", "flowCode", "cmdCode"'
)
TOTAL_COLUMNS = (
    '"refYear", "refMonth", "reporterCode", "partnerCode", "netWgt", "primaryValue", "isNetWgtEstimated"'
)
DATE = 'CAST(make_date("refYear", "refMonth", 1) AS VARCHAR)'
OUTSIDE = '"partnerCode" NOT IN (SELECT DISTINCT "reporterCode" FROM flows)'
MONTHLY_SHARES = '"refYear", "refMonth", origin, round(tonnes, 6) AS tonnes, round(share_pct, 6) AS share_pct'
MILES = (
    '"refYear", "refMonth", round(extra_zone_tonnes, 6) AS extra_zone_tonnes, '
    "round(tonne_nm, 6) AS tonne_nm, round(avg_distance_nm, 6) AS avg_distance_nm"
)


def _correlation(pairs: str, key: str = "") -> str:
    """Lag correlations over (k, x, py), guarded against constant sides."""
    comma = f"{key}, " if key else ""
    return f"""
        SELECT {comma}CAST(k AS INTEGER) AS lag,
               round(covar_pop(x, py) / nullif(stddev_pop(x) FILTER (py IS NOT NULL)
                                               * stddev_pop(py) FILTER (x IS NOT NULL), 0), 6) AS r,
               COUNT(*) FILTER (x IS NOT NULL AND py IS NOT NULL) AS n
        FROM ({pairs}) GROUP BY {comma}k"""


def _by_row(source: str) -> str:
    shifted = " UNION ALL ".join(
        f'SELECT "cmdCode", {k} AS k, x, lag(p, {k}) OVER (PARTITION BY "cmdCode" ORDER BY d) AS py FROM {source}'
        for k in range(7)
    )
    return shifted


def _by_month(source: str) -> str:
    return (
        f'SELECT a."cmdCode", k, a.x, b.p AS py FROM {source} a CROSS JOIN range(7) AS lags(k) '
        f"LEFT JOIN {source} b ON b.d = a.d - to_months(CAST(k AS INTEGER))"
    )


def _before_after(where: str = "true") -> str:
    before, after = "d < DATE '1998-02-01'", "d >= DATE '1998-02-01'"

    def mean(column: str, side: str) -> str:
        return f"AVG({column}) FILTER ({side})"

    def pooled(side: str) -> str:
        return f"SUM(tonne_nm) FILTER ({side}) / nullif(SUM(extra_zone_tonnes) FILTER ({side}), 0)"

    was, now = mean("tonne_nm", before), mean("tonne_nm", after)
    return f"""
        SELECT COUNT(*) FILTER ({before}) AS months_before, COUNT(*) FILTER ({after}) AS months_after,
               round({was}, 6) AS tonne_nm_before, round({now}, 6) AS tonne_nm_after,
               round(({now} - {was}) / nullif({was}, 0) * 100, 6) AS increase_pct,
               round({mean("avg_distance_nm", before)}, 6) AS avg_distance_before,
               round({mean("avg_distance_nm", after)}, 6) AS avg_distance_after,
               round({pooled(before)}, 6) AS pooled_distance_before,
               round({pooled(after)}, 6) AS pooled_distance_after
        FROM (SELECT *, make_date("refYear", "refMonth", 1) AS d FROM miles) WHERE {where}"""


STATEMENTS: dict[str, str] = {
    "raw_lines": f"SELECT {RAW_COLUMNS} FROM raw",
    "stack_raw": f"SELECT {RAW_COLUMNS} FROM raw",
    "ingest_incremental": f"SELECT {RAW_COLUMNS} FROM raw",
    "ingest_relanded": f"SELECT {RAW_COLUMNS} FROM raw",
    "ingest_compacted": f'SELECT {RAW_COLUMNS} FROM raw WHERE "reporterCode" <> 7',
    "landing_gaps": 'SELECT g.* FROM grid g ANTI JOIN landed_files USING (iso3, year)',
    "completeness": """
        SELECT * REPLACE (round(world_gap_pct, 6) AS world_gap_pct),
               CASE WHEN file_exists THEN FALSE END AS unreadable FROM report""",
    "completeness_empty": "SELECT reporter, year FROM report WHERE file_exists AND n_rows = 0",
    "completeness_partial": """
        SELECT reporter, year, n_months, months_present FROM report WHERE n_rows > 0 AND n_months < 12""",
    "completeness_gap": """
        SELECT reporter, year, round(world_gap_pct, 6) AS world_gap_pct FROM report WHERE world_gap_pct > 0.5""",
    "completeness_codes": """
        SELECT DISTINCT 'mot_codes' AS kind, mot_codes AS codes FROM report WHERE mot_codes IS NOT NULL
        UNION ALL
        SELECT DISTINCT 'customs_codes', customs_codes FROM report WHERE customs_codes IS NOT NULL""",
    "completeness_files": """
        SELECT COUNT(*) AS n_expected, COUNT(*) FILTER (file_exists) AS n_present FROM report""",
    "dq_constants": """
        SELECT 'customsCode' AS "column", "customsCode" AS value, COUNT(*) AS n_rows FROM raw
        WHERE "customsCode" NOT IN ('C00', 'C09') GROUP BY 2
        UNION ALL
        SELECT 'customsCode', 'C09', 0 WHERE NOT EXISTS (SELECT 1 FROM raw WHERE "customsCode" = 'C09')
        UNION ALL
        SELECT 'flowCode', "flowCode", COUNT(*) FROM raw WHERE "flowCode" <> 'M' GROUP BY 2
        UNION ALL
        SELECT 'cmdCode', "cmdCode", COUNT(*) FROM raw WHERE "cmdCode" <> 'X' GROUP BY 2""",
    "totals_only": f"SELECT {TOTAL_COLUMNS} FROM totals",
    "totals_summary": """
        SELECT (SELECT COUNT(*) FROM raw) AS n_lines, (SELECT COUNT(*) FROM totals) AS n_kept,
               (SELECT COUNT(*) FROM raw) - (SELECT COUNT(*) FROM totals) AS n_dropped""",
    "split_detail": f'SELECT {TOTAL_COLUMNS} FROM totals WHERE "partnerCode" <> 0',
    "split_world": f'SELECT {TOTAL_COLUMNS} FROM totals WHERE "partnerCode" = 0',
    "world_recon": """
        SELECT COUNT(*) AS n_reporter_months,
               round(SUM(abs(detail - world)) / nullif(SUM(world), 0) * 100, 6) AS gap_pct,
               (SELECT COUNT(*) FROM (SELECT SUM("netWgt") AS w FROM totals WHERE "partnerCode" = 0
                                      GROUP BY "reporterCode", "refYear", "refMonth") WHERE w = 0)
                 AS n_zero_world
        FROM recon""",
    "world_recon_monthly": """
        SELECT "reporterCode", "refYear", "refMonth", detail, world, abs(detail - world) AS gap FROM recon""",
    "world_recon_flawed": """
        SELECT COUNT(*) AS n_reporter_months,
               round(SUM(abs(detail - world)) / nullif(SUM(world), 0) * 100, 6) AS gap_pct,
               (SELECT COUNT(*) FROM (SELECT coalesce(SUM("netWgt"), 0) AS w FROM totals_flawed WHERE "partnerCode" = 0
                                      GROUP BY "reporterCode", "refYear", "refMonth") WHERE w = 0)
                 AS n_zero_world
        FROM recon_flawed""",
    "world_recon_monthly_flawed": """
        SELECT "reporterCode", "refYear", "refMonth", detail, world, abs(detail - world) AS gap FROM recon_flawed""",
    "zero_fill_flawed": f"SELECT {FLOW_COLUMNS} FROM flows_flawed",
    "zero_fill_summary_flawed": """
        SELECT (SELECT COUNT(*) FROM named_flawed) AS n_before, (SELECT COUNT(*) FROM zeros_flawed) AS n_added,
               (SELECT COUNT(*) FROM named_flawed) + (SELECT COUNT(*) FROM zeros_flawed) AS n_after""",
    "market_share_flawed": f"SELECT {MONTHLY_SHARES} FROM shares_flawed",
    "flows_refreshed": f"SELECT {FLOW_COLUMNS} FROM flows",
    "partner_dim": "SELECT * FROM partners",
    "distances_dim": "SELECT * FROM distances",
    "date_dim": """
        SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS "Date", CAST(year(d) AS INTEGER) AS "Year",
               CAST(month(d) AS INTEGER) AS "Month", strftime(d, '%b') AS "MonthName"
        FROM (SELECT unnest(generate_series(MIN(make_date("refYear", "refMonth", 1)),
                                            MAX(make_date("refYear", "refMonth", 1)),
                                            INTERVAL 1 MONTH)) AS d FROM flows)""",
    "enrich": f"SELECT {FLOW_COLUMNS} FROM named",
    "enrich_unmatched": """
        SELECT DISTINCT "partnerCode" FROM totals WHERE "partnerCode" <> 0 AND "partnerCode" NOT IN
          (SELECT "partnerCode" FROM partners JOIN distances USING ("partnerName"))""",
    "duplicate_keys": """
        SELECT "reporterCode", "partnerCode", "refYear", COUNT(*) AS n_rows FROM raw
        GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
    "special_share": """
        SELECT SUM("netWgt") / 1000 AS total_t,
               coalesce(SUM("netWgt") FILTER (is_special_partner), 0) / 1000 AS special_t,
               round(coalesce(SUM("netWgt") FILTER (is_special_partner), 0) / SUM("netWgt") * 100, 6)
                 AS special_pct
        FROM named""",
    "zero_fill": f"SELECT {FLOW_COLUMNS} FROM flows",
    "flows": f"SELECT {FLOW_COLUMNS} FROM flows",
    "zero_fill_summary": """
        SELECT (SELECT COUNT(*) FROM named) AS n_before, (SELECT COUNT(*) FROM zeros) AS n_added,
               (SELECT COUNT(*) FROM flows) AS n_after""",
    "lane_series": """
        SELECT "refYear", "refMonth", "reporterCode", "partnerCode", "netWgt" FROM flows
        WHERE "reporterCode" = 4 AND "partnerCode" = 10 ORDER BY 1, 2""",
    "lane_summary": """
        SELECT "reporterCode", "partnerCode", COUNT(*) AS n_rows, COUNT(*) FILTER ("netWgt" = 0) AS n_zero
        FROM flows GROUP BY 1, 2""",
    "reporters_per_month": f"""
        SELECT "refYear", "refMonth", COUNT(DISTINCT "reporterCode") AS n_reporters, {DATE} AS date
        FROM flows GROUP BY 1, 2""",
    "extra_zone": f"SELECT {FLOW_COLUMNS} FROM flows WHERE {OUTSIDE}",
    "extra_zone_derived": f"SELECT {FLOW_COLUMNS} FROM extra",
    "zone_flag": f"""
        SELECT "refYear", "refMonth", "reporterCode", "partnerCode", "netWgt", {OUTSIDE} AS "isExtraZone"
        FROM flows""",
    "hub_ratio": f"""
        SELECT "reporterCode", "reporterName", SUM("netWgt") / 1000 AS tonnes,
               coalesce(SUM("netWgt") FILTER (inside), 0) / 1000 AS intra_zone_tonnes,
               round(coalesce(SUM("netWgt") FILTER (inside), 0) / nullif(SUM("netWgt"), 0) * 100, 6)
                 AS intra_zone_pct
        FROM (SELECT *, NOT {OUTSIDE} AS inside FROM flows) GROUP BY 1, 2""",
    "top_origins_all": """
        SELECT "partnerName", total_t,
               CAST(row_number() OVER (ORDER BY total_t DESC, "partnerName") AS INTEGER) AS rank
        FROM all_top""",
    "top_origins_extra": 'SELECT "partnerName", total_t, CAST(rank AS INTEGER) AS rank FROM top',
    "origin_monthly_all": """
        SELECT "refYear", "refMonth",
               CASE WHEN "partnerName" IN (SELECT "partnerName" FROM all_top) THEN "partnerName"
                    ELSE 'Other' END AS origin,
               SUM("netWgt") / 1000 AS tonnes
        FROM flows WHERE is_special_partner = false GROUP BY 1, 2, 3""",
    "origin_monthly_extra": 'SELECT "refYear", "refMonth", origin, tonnes FROM monthly',
    "extra_zone_monthly": """
        SELECT "refYear", "refMonth", "partnerName", SUM("netWgt") AS "netWgt" FROM extra GROUP BY 1, 2, 3""",
    "origin_pivot": f"""
        SELECT {DATE} AS date, """
    + ", ".join(
        f"coalesce(SUM(tonnes) FILTER (rank = {i}), 0) AS top{i}" for i in range(1, 7)
    )
    + """, coalesce(SUM(tonnes) FILTER (origin = 'Other'), 0) AS other
        FROM monthly m LEFT JOIN top t ON m.origin = t."partnerName"
        WHERE make_date("refYear", "refMonth", 1) <= DATE '2000-12-01'
        GROUP BY "refYear", "refMonth"
        """,
    "market_share": f"SELECT {MONTHLY_SHARES} FROM shares",
    "origin_share": f"SELECT {MONTHLY_SHARES} FROM own_shares",
    "transition_speed": """
        SELECT origin, round(AVG(share_pct) FILTER (d < cut), 6) AS baseline_share_pct,
               round(AVG(share_pct) FILTER (d >= cut), 6) AS after_share_pct,
               CAST(MIN(d) FILTER (d >= cut AND share_pct < 2) AS VARCHAR) AS first_low,
               CAST(date_diff('month', MIN(cut), MIN(d) FILTER (d >= cut AND share_pct < 2)) AS INTEGER)
                 AS months_elapsed,
               COUNT(*) FILTER (d >= cut AND share_pct < 2) > 0 AS ever_low
        FROM (SELECT *, make_date("refYear", "refMonth", 1) AS d, DATE '1998-02-01' AS cut FROM own_shares)
        GROUP BY origin""",
    "share_window": f"""
        SELECT {MONTHLY_SHARES} FROM own_shares
        WHERE origin = 'NATION_9' AND (("refYear" = 1997 AND "refMonth" >= 8)
                                       OR ("refYear" = 1998 AND "refMonth" <= 8))""",
    "coverage": 'SELECT "partnerName", tonnes, round(cumulative_pct, 6) AS cumulative_pct FROM cover',
    "coverage_covered": """
        SELECT COUNT(*) AS n_origins, round(MAX(cumulative_pct), 6) AS covered_pct
        FROM cover WHERE "partnerName" IN (SELECT "partnerName" FROM distances)""",
    "prices_tidy": """
        SELECT brent_usd_bbl, diesel_usd_gal, "refYear", "refMonth" FROM prices
        WHERE period BETWEEN '1995-01' AND '2001-08'""",
    "prices_missing": """
        SELECT "refYear", "refMonth", 'brent_usd_bbl' AS series FROM prices WHERE brent_usd_bbl IS NULL
        UNION ALL
        SELECT "refYear", "refMonth", 'diesel_usd_gal' FROM prices WHERE diesel_usd_gal IS NULL""",
    "crack_spread": """
        SELECT "refYear", "refMonth", brent_usd_bbl, diesel_usd_gal, round(diesel_usd_bbl, 6) AS diesel_usd_bbl,
               round(crack_spread_usd_bbl, 6) AS crack_spread_usd_bbl FROM spread""",
    "crack_spread_window": """
        SELECT "refYear", "refMonth", round(crack_spread_usd_bbl, 6) AS crack_spread_usd_bbl FROM spread
        WHERE ("refYear" = 1997 AND "refMonth" >= 6) OR "refYear" = 1998""",
    "price_flow": f"""
        SELECT "refYear", "refMonth", {DATE} AS date, extra_zone_tonnes,
               round(crack_spread_usd_bbl, 6) AS crack_spread_usd_bbl FROM price_flow""",
    "lag_corr_levels": _correlation(_by_row("levels")),
    "lag_corr_changes": _correlation(_by_row("changes")),
    "lag_corr_calendar": _correlation(_by_month("levels")),
    "best_lag": """
        SELECT (SELECT lag FROM fits ORDER BY r DESC, lag LIMIT 1) AS best_lag,
               (SELECT MAX(r) FROM fits) AS best_r,
               (SELECT lag FROM fits ORDER BY abs(r) DESC, lag LIMIT 1) AS best_abs_lag,
               (SELECT MAX(abs(r)) FROM fits) AS best_abs_r""",
    "tonne_miles": f"SELECT {MILES}, {DATE} AS date FROM miles",
    "before_after": _before_after(),
    "before_after_cut": _before_after("d <= DATE '2000-12-01'"),
    "confidence_coverage": """
        SELECT coalesce(confidence, 'none') AS confidence, SUM("netWgt") / 1000 AS tonnes,
               round(SUM("netWgt") / nullif(SUM(SUM("netWgt")) OVER (), 0) * 100, 6) AS volume_pct
        FROM extra LEFT JOIN distances USING ("partnerName") GROUP BY 1""",
    "mart_flows": f"""
        SELECT {FLOW_COLUMNS}, {OUTSIDE} AS "isExtraZone", {DATE} AS "Date" FROM flows
        WHERE "refYear" < 2001""",
    "mart_price_flow": f"""
        SELECT "refYear", "refMonth", extra_zone_tonnes, round(crack_spread_usd_bbl, 6) AS crack_spread_usd_bbl,
               {DATE} AS "Date" FROM price_flow""",
    "mart_market_shares": f'SELECT {MONTHLY_SHARES}, {DATE} AS "Date" FROM shares WHERE "refYear" < 2001',
    "mart_tonne_miles": f'SELECT {MILES}, {DATE} AS "Date" FROM miles WHERE "refYear" < 2001',
    "mart_orphan_dates": f"""
        SELECT DISTINCT {DATE} AS "Date" FROM flows WHERE make_date("refYear", "refMonth", 1) >
          (SELECT MAX(make_date("refYear", "refMonth", 1)) FROM spread WHERE "refYear" <= 2000)""",
    "zero_fill_by_commodity": f'SELECT "cmdCode", {FLOW_COLUMNS} FROM flows_by_type',
    "world_recon_by_commodity": """
        SELECT "cmdCode", n_reporter_months, gap_pct, n_zero_world FROM
          (SELECT "cmdCode", COUNT(*) AS n_reporter_months,
                  round(SUM(abs(detail - world)) / nullif(SUM(world), 0) * 100, 6) AS gap_pct
           FROM recon_by_type GROUP BY 1)
          JOIN (SELECT "cmdCode", COUNT(*) FILTER (w = 0) AS n_zero_world FROM
                  (SELECT "cmdCode", SUM("netWgt") AS w FROM totals_by_type WHERE "partnerCode" = 0
                   GROUP BY "cmdCode", "reporterCode", "refYear", "refMonth") GROUP BY 1)
          USING ("cmdCode")""",
    "top_origins_by_commodity": """
        SELECT "cmdCode", "partnerName", total_t, CAST(rank AS INTEGER) AS rank FROM top_by_type""",
    "market_share_by_commodity": f'SELECT "cmdCode", {MONTHLY_SHARES} FROM shares_by_type',
    "coverage_by_commodity": """
        SELECT "cmdCode", "partnerName", SUM("netWgt") / 1000 AS tonnes,
               round(SUM(SUM("netWgt")) OVER (PARTITION BY "cmdCode" ORDER BY SUM("netWgt") DESC)
                     / nullif(SUM(SUM("netWgt")) OVER (PARTITION BY "cmdCode"), 0) * 100, 6) AS cumulative_pct
        FROM extra_by_type GROUP BY 1, 2""",
    "lag_corr_by_commodity": _correlation(_by_row("levels_by_type"), '"cmdCode"'),
    "tonne_miles_by_commodity": f'SELECT "cmdCode", {MILES}, {DATE} AS date FROM miles_by_type',
}


def _names(sql: str, name: str) -> bool:
    return re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql) is not None


def with_ctes(statement: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the expressions it needs."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []
    text = statement
    for name in reversed(known):
        if _names(text, name):
            needed.insert(0, name)
            text += known[name]
    if not needed:
        return statement
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in needed) + statement


STATEMENTS["rollup_refreshed"] = STATEMENTS["extra_zone_monthly"]
STATEMENTS.update(
    {
        f"lattice_{name}": STATEMENTS[name]
        for name in (
            "world_recon", "world_recon_monthly", "special_share", "zero_fill_summary", "lane_summary", "hub_ratio",
            "reporters_per_month",
        )
    }
)
STATEMENTS["coverage_ranges"] = STATEMENTS["coverage"]

STUDY = (
    "top_origins_extra", "market_share", "transition_speed", "coverage", "coverage_covered", "price_flow",
    "tonne_miles", "before_after", "confidence_coverage",
)
STATEMENTS.update({f"study_{name}": STATEMENTS[name] for name in STUDY})


def oracle_sql() -> dict[str, str]:
    fits = {"fits": _correlation(_by_row("levels"))}
    return {name: with_ctes(sql, fits) for name, sql in STATEMENTS.items()}
