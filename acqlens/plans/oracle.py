"""DuckDB SQL for every driver query (the correctness oracle).

Each statement re-derives the domain tables from the given tables with the
CTEs of ``oracle_bindings`` and then states the operator's rule in plain SQL,
independently of the Spark code.
"""

from __future__ import annotations

from . import oracle_values as V
from .oracle_bindings import with_ctes
from .oracle_values import BASE_LINES, EXPENSE_PARTS, REVENUE_PARTS, STATEMENT_LINES, UBOX_PARTS

SQL: dict[str, str] = {}


def _q(n: str) -> str:
    return '"' + n + '"'


def _sum(parts: list[str]) -> str:
    return " + ".join(_q(p) for p in parts)


FY_LAST, FY_CUR = V.FY_LAST, V.FY_CUR
AS_OF = f"DATE '{V.AS_OF.isoformat()}'"

# ledger rebuilt from the wide form (nulls dropped)
LEDGER_FROM_WIDE = ("ledger_from_wide", """
SELECT FISCAL_YEAR AS fiscal_year, PROFIT_CENTER AS profit_center, GL_ACCOUNT AS account,
       make_date(CASE WHEN (p + 2) % 12 + 1 >= 4 THEN FISCAL_YEAR - 1 ELSE FISCAL_YEAR END,
                 (p + 2) % 12 + 1, 1) AS month, amount
FROM (SELECT *, CAST(replace(period, 'GC_PER_', '') AS INTEGER) AS p
      FROM (UNPIVOT ledger_wide ON COLUMNS('GC_PER_.*') INTO NAME period VALUE amount))""")

LEDGER_FROM_WIDE_NULLS = ("ledger_from_wide_nulls", f"""
SELECT FISCAL_YEAR AS fiscal_year, PROFIT_CENTER AS profit_center, GL_ACCOUNT AS account,
       make_date(CASE WHEN (p + 2) % 12 + 1 >= 4 THEN FISCAL_YEAR - 1 ELSE FISCAL_YEAR END,
                 (p + 2) % 12 + 1, 1) AS month, amount
FROM (SELECT *, CAST(replace(period, 'GC_PER_', '') AS INTEGER) AS p
      FROM ledger_wide UNPIVOT INCLUDE NULLS (amount FOR period IN ({", ".join(f"GC_PER_{n}" for n in range(1, 13))})))""")

# included centres
CENTRES = ("centres", """
SELECT pc AS profit_center, MEntity, "Group"
FROM (SELECT *, CASE WHEN trim(Profit_Center) LIKE '%E9' THEN CAST(CAST(trim(Profit_Center) AS DECIMAL(38,0)) AS VARCHAR)
                     ELSE split_part(trim(Profit_Center), '.', 1) END AS pc FROM acquisitions)
WHERE Include = 'Yes' AND Profit_Center IS NOT NULL AND trim(Profit_Center) <> '' AND length(pc) > 3""")


def statement_ctes(ledger: str, name: str = "stmt") -> list[tuple[str, str]]:
    """CTEs computing the tidy statement ``name`` from CTE ``ledger``."""
    sums = ",\n".join(
        f"  coalesce(sum(l.amount * c.sign) FILTER (WHERE c.line_no = {i}), 0) AS {_q(n)}"
        for i, n in enumerate(BASE_LINES, start=1))
    wide = f"""
SELECT l.profit_center, l.month,
{sums}
FROM {ledger} l JOIN chart c ON c.account = l.account
WHERE l.amount IS NOT NULL
GROUP BY l.profit_center, l.month"""
    d1 = f"""
SELECT * REPLACE (0 AS "INTERCOMPANY RENT"),
       {_sum(UBOX_PARTS)} AS "U-BOX INCOME",
       "SALES" - "COST OF SALES" AS "NET SALES"
FROM {name}_w0"""
    d2 = f"""
SELECT *, {_sum(REVENUE_PARTS)} AS "TOTAL REVENUE", {_sum(EXPENSE_PARTS)} AS "TOTAL OPERATING EXPENSE"
FROM {name}_w1"""
    d3 = f"""
SELECT *, "TOTAL REVENUE" - "TOTAL OPERATING EXPENSE" AS "NET OPERATING INCOME" FROM {name}_w2"""
    cols = ", ".join(f"CAST({_q(n)} AS DECIMAL(18,2)) AS {_q(n)}" for n in STATEMENT_LINES)
    tidy = f"""
SELECT month AS date, profit_center, line_item, value
FROM (UNPIVOT (SELECT profit_center, month, {cols} FROM {name}_w3 WHERE "NET OPERATING INCOME" <> 0)
      ON {", ".join(_q(n) for n in STATEMENT_LINES)} INTO NAME line_item VALUE value)"""
    return [(f"{name}_w0", wide), (f"{name}_w1", d1), (f"{name}_w2", d2), (f"{name}_w3", d3),
            (name, tidy)]


SQL["income_statement"] = with_ctes(
    ["ledger_wide", "chart"], "SELECT * FROM stmt",
    [LEDGER_FROM_WIDE] + statement_ctes("ledger_from_wide"))

SQL["ledger_unpivot"] = with_ctes(
    ["ledger_wide", "chart", "acquisitions"], f"""
SELECT * FROM ledger_from_wide_nulls
WHERE fiscal_year IN ({FY_LAST}, {FY_CUR})
  AND profit_center IN (SELECT profit_center FROM centres)
  AND account IN (SELECT account FROM chart)""",
    [LEDGER_FROM_WIDE_NULLS, CENTRES])

SQL["chart_of_accounts"] = with_ctes(["chart"], "SELECT * FROM chart")

SQL["line_item_amounts"] = with_ctes(["ledger_long", "chart"], """
SELECT l.profit_center, l.month, c.line_item, CAST(sum(l.amount * c.sign) AS DECIMAL(18,2)) AS amount
FROM ledger_long l JOIN chart c ON c.account = l.account
WHERE l.amount IS NOT NULL
GROUP BY ALL""")


def grp_label_sql(g: str) -> str:
    idx = f"({g} - 1 + {V.BASE_Q} - 1)"
    return (f"CASE WHEN {g} >= 1 THEN 'F' || lpad(CAST(({V.BASE_FY} + {idx} // 4) % 100 AS VARCHAR), 2, '0')"
            f" || '_Q' || CAST({idx} % 4 + 1 AS VARCHAR) END")


_FY_LO = f"DATE '{FY_LAST - 1}-04-01'"
_CUT = f"DATE '{V.AS_OF.year}-{V.AS_OF.month:02d}-01'"
PORTFOLIO = [
    CENTRES,
    ("pled", f"""
SELECT * FROM ledger_long
WHERE month BETWEEN {_FY_LO} AND {_CUT} AND profit_center IN (SELECT profit_center FROM centres)"""),
    *statement_ctes("pled", "pstmt"),
    ("portfolio", f"""
SELECT s.date, s.profit_center, c.MEntity, s.line_item, s.value,
       {grp_label_sql('c."Group"')} AS grp_name, c."Group" AS grp_num,
       CAST(month(s.date) AS INTEGER) AS month, CAST(year(s.date) AS INTEGER) AS year,
       CAST(year(s.date + INTERVAL 9 MONTH) AS INTEGER) AS fiscal_year, CAST(month(s.date - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month
FROM pstmt s LEFT JOIN centres c ON c.profit_center = s.profit_center"""),
]

SQL["portfolio_statement"] = with_ctes(["ledger_long", "chart", "acquisitions"],
                                       "SELECT * FROM portfolio", PORTFOLIO)

SQL["group_statement"] = with_ctes(["ledger_long", "chart", "acquisitions"], """
SELECT date, line_item, value, fiscal_year, fiscal_month,
       CASE WHEN month BETWEEN 1 AND 3 THEN 4 WHEN month BETWEEN 4 AND 6 THEN 1
            WHEN month BETWEEN 7 AND 9 THEN 2 ELSE 3 END AS quarter,
       month AS cal_month, replace(replace(grp_name, '_', ' '), 'F', 'FY') AS grp_name, grp_num,
       CAST(value * 0.001 AS DECIMAL(38,5)) AS val_thousands
FROM (SELECT date, line_item, fiscal_year, fiscal_month, month, grp_name, grp_num,
             CAST(sum(value) AS DECIMAL(38,2)) AS value
      FROM portfolio GROUP BY ALL)""", PORTFOLIO)

SQL["statement_cutoff"] = with_ctes(["ledger_long", "chart", "acquisitions"], f"""
SELECT * FROM portfolio WHERE date <= last_day({AS_OF} - INTERVAL 1 MONTH)""", PORTFOLIO)

SQL["list_cutoff"] = with_ctes(["acquisitions"], f"""
SELECT * FROM acquisitions WHERE Close_of_Escrow <= last_day({AS_OF} - INTERVAL 1 MONTH)""")

_MAXM = f"DATE '{V.LAST_MONTH}'"
LINE_AMOUNTS = ("lia", """
SELECT l.profit_center, l.month, c.line_item, CAST(sum(l.amount * c.sign) AS DECIMAL(18,2)) AS amount
FROM ledger_long l JOIN chart c ON c.account = l.account
WHERE l.amount IS NOT NULL GROUP BY ALL""")

SQL["dense_line_items"] = with_ctes(["ledger_long", "chart"], f"""
SELECT s.profit_center, s.month, ln.line_item, CAST(coalesce(a.amount, 0) AS DECIMAL(18,2)) AS amount
FROM (SELECT profit_center,
             CAST(unnest(generate_series(fm, {_MAXM}, INTERVAL 1 MONTH)) AS DATE) AS month
      FROM (SELECT profit_center, min(month) AS fm FROM lia GROUP BY 1) WHERE fm <= {_MAXM}) s
CROSS JOIN (SELECT unnest([{", ".join("'" + n + "'" for n in BASE_LINES)}]) AS line_item) ln
LEFT JOIN (SELECT * FROM lia WHERE month <= {_MAXM}) a
  ON a.profit_center = s.profit_center AND a.month = s.month AND a.line_item = ln.line_item""",
    [LINE_AMOUNTS])

SQL["operations_start"] = with_ctes(["ledger_long", "chart"], """
SELECT profit_center, min(date) AS start_month FROM stmt
WHERE line_item = 'NET OPERATING INCOME' AND value <> 0 GROUP BY profit_center""",
    statement_ctes("ledger_long"))

SQL["fiscal_calendar"] = with_ctes(["ledger_long"], f"""
SELECT month, CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS cal_month, strftime(month, '%b') AS month_abbr,
       fy AS fiscal_year, CAST(month(month - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month, fq AS fiscal_quarter,
       (fy - {V.BASE_FY}) * 4 + fq - {V.BASE_Q} + 1 AS grp_num,
       'F' || lpad(CAST(fy % 100 AS VARCHAR), 2, '0') || '_Q' || CAST(fq AS VARCHAR) AS grp_name,
       replace(replace('F' || lpad(CAST(fy % 100 AS VARCHAR), 2, '0') || '_Q' || CAST(fq AS VARCHAR), '_', ' '), 'F', 'FY') AS grp_display,
       last_day(month) AS month_end
FROM (SELECT month, CAST(year(month + INTERVAL 9 MONTH) AS INTEGER) AS fy, CAST(quarter(month - INTERVAL 3 MONTH) AS INTEGER) AS fq
      FROM (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
            FROM ledger_long))""")


# ---------------------------------------------------------------- occupancy
_LAST = _MAXM   # first of the month before as-of
_FISCAL = lambda d: (f"CAST(year({d} + INTERVAL 9 MONTH) AS INTEGER) AS fiscal_year, CAST(month({d} - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month, "  # noqa: E731
                     f"CAST(quarter({d} - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_quarter, strftime({d}, '%b') AS month_abbr")
ACTUAL = ("actual", f"""
SELECT Date, MEntity, unm_product, CAST(sum(unm_numunits) AS BIGINT) AS unm_numunits, CAST(sum(unm_occunits) AS BIGINT) AS unm_occunits,
       {_FISCAL('Date')}
FROM unit_mix
WHERE upper(unm_product) <> 'UBOX' AND Date <= {_LAST}
  AND MEntity IN (SELECT MEntity FROM acquisitions WHERE Include = 'Yes')
GROUP BY Date, MEntity, unm_product""")

SQL["actual_occupancy"] = with_ctes(["unit_mix", "acquisitions"], "SELECT * FROM actual", [ACTUAL])

SQL["group_occupancy"] = with_ctes(["unit_mix", "acquisitions"], """
SELECT r.*, c.n_entities FROM
 (SELECT a.Date, q."Group", a.fiscal_year, a.fiscal_month, a.fiscal_quarter, a.month_abbr,
         CAST(sum(a.unm_numunits) AS BIGINT) AS Total_Rooms, CAST(sum(a.unm_occunits) AS BIGINT) AS Occupied_Rooms
  FROM actual a JOIN acquisitions q ON q.MEntity = a.MEntity GROUP BY ALL) r
JOIN (SELECT q."Group", count(DISTINCT a.MEntity) AS n_entities
      FROM actual a JOIN acquisitions q ON q.MEntity = a.MEntity GROUP BY ALL) c
  ON c."Group" = r."Group" """, [ACTUAL])

MIX = ("mix", f"""
SELECT Date, MEntity, product, climate,
       ((2 * c + 100 * n) // (200 * n)) / 100.0 AS rent_rate,
       total_units, occ_units,
       CASE WHEN total_units <> 0 THEN ((200 * occ_units + total_units) // (2 * total_units)) / 100.0 END AS occ_pct
FROM (SELECT Date, MEntity, unm_product AS product, unm_climate AS climate,
             CAST(sum(unm_rentrate) * 10000 AS BIGINT) AS c, count(unm_rentrate) AS n,
             CAST(sum(unm_numunits) AS BIGINT) AS total_units, CAST(sum(unm_occunits) AS BIGINT) AS occ_units
      FROM unit_mix
      WHERE Date = {_LAST} AND Date >= DATE '{V.MIN_ACTUAL}' AND upper(unm_product) <> 'UBOX'
        AND MEntity IN (SELECT MEntity FROM forecast)
      GROUP BY ALL)""")

SQL["occupancy_mix"] = with_ctes(["unit_mix", "forecast"], "SELECT * FROM mix", [MIX])

SQL["forecast_splice"] = with_ctes(["unit_mix", "forecast"], """
SELECT Date, MEntity, product, climate, rent_rate, total_units, occ_units, occ_pct,
       NULL::BIGINT AS ID, NULL::DATE AS Start_Date, NULL::DATE AS FC_Date, NULL::DOUBLE AS FC_Occ
FROM mix
UNION ALL
SELECT NULL, MEntity, NULL, NULL, NULL, NULL, NULL, NULL, ID, Start_Date, FC_Date, FC_Occ
FROM forecast
WHERE (SELECT max(Date) FROM mix) IS NULL OR FC_Date > (SELECT max(Date) FROM mix)""", [MIX])

LATEST = ("latest", f"""
SELECT f.ID, f.MEntity, f.Start_Date, f.FC_Date AS MONTH, f.FC_Occ, {_FISCAL('f.FC_Date')}
FROM forecast f
JOIN (SELECT MEntity, Start_Date FROM
        (SELECT MEntity, Start_Date, count(*) AS n,
                max(Start_Date) OVER (PARTITION BY MEntity) AS mx
         FROM forecast GROUP BY MEntity, Start_Date)
      WHERE Start_Date = mx AND n >= 2) k
  ON k.MEntity = f.MEntity AND k.Start_Date = f.Start_Date""")

SQL["forecast_latest_vintage"] = with_ctes(["forecast"], "SELECT * FROM latest", [LATEST])

SQL["forecast_capacity"] = with_ctes(["forecast", "unit_mix", "acquisitions"], """
SELECT l.ID, l.MEntity, l.MONTH, l.FC_Occ AS Forecasted_Rooms, q."Group",
       l.fiscal_year AS FY, l.fiscal_month AS FM, l.fiscal_quarter AS Quarter, l.month_abbr AS Month1,
       r.Total_Rooms
FROM latest l
LEFT JOIN acquisitions q ON q.MEntity = l.MEntity
LEFT JOIN (SELECT MEntity, arg_max(Total_Rooms, Date) AS Total_Rooms
           FROM (SELECT MEntity, Date, CAST(sum(unm_numunits) AS BIGINT) AS Total_Rooms FROM actual GROUP BY ALL)
           GROUP BY MEntity) r ON r.MEntity = l.MEntity""", [LATEST, ACTUAL])

SQL["forecast_listed"] = with_ctes(["forecast", "acquisitions"], """
SELECT * FROM forecast WHERE MEntity IN (SELECT DISTINCT MEntity FROM acquisitions)""")

SQL["forecast_future"] = with_ctes(["forecast", "acquisitions"], f"""
SELECT * FROM forecast WHERE MEntity IN (SELECT DISTINCT MEntity FROM acquisitions)
  AND Start_Date > {_LAST}""")


# ---------------------------------------------------------------- same-store

_EXCL = ", ".join("'" + c + "'" for c in V.SAMESTORE_EXCLUDE)
_PERIODS = ", ".join(f"('{n}', DATE '{lo}', DATE '{hi}')" for n, lo, hi in V.PERIODS)
PANEL = ("panel", f"""
SELECT o.MEntity, o.Date, coalesce(o.occ, 0) AS occ, coalesce(t.total, 0) AS total,
       CASE WHEN coalesce(t.total, 0) <> 0 THEN coalesce(o.occ, 0) / t.total ELSE 0.0 END AS occupancy
FROM (SELECT MEntity, Date, occ FROM rooms) o
LEFT JOIN (SELECT MEntity, Date, total FROM rooms) t ON t.MEntity = o.MEntity AND t.Date = o.Date
WHERE o.MEntity IN (SELECT MEntity FROM entity_info WHERE "Cost Center" IN
                      (SELECT profit_center FROM samestore_centres WHERE profit_center NOT IN ({_EXCL})))""")
ENT = ("ent", f"""
SELECT period, MEntity, sum(occ) AS occ, sum(total) AS total,
       CASE WHEN sum(total) <> 0 THEN sum(occ) / sum(total) ELSE 0.0 END AS occupancy
FROM panel JOIN (VALUES {_PERIODS}) per(period, lo, hi) ON panel.Date BETWEEN per.lo AND per.hi
GROUP BY period, MEntity""")

SQL["occupancy_panel"] = with_ctes(["rooms", "samestore_centres", "entity_info"], "SELECT * FROM panel", [PANEL])

SQL["samestore_metrics"] = with_ctes(["rooms", "samestore_centres", "entity_info"], """
SELECT period, count(*) AS n_entities,
       round(sum(occ) / sum(total), 6) AS weighted_occ,
       round(median(occupancy), 6) AS median_occ,
       count(*) FILTER (WHERE occupancy >= CAST(0.85 AS DOUBLE)) AS n_at_threshold,
       round(CAST(count(*) FILTER (WHERE occupancy >= CAST(0.85 AS DOUBLE)) AS DOUBLE) / count(*), 6)
         AS share_at_threshold
FROM ent GROUP BY period""", [PANEL, ENT])

_B = [f"CAST({e} AS DOUBLE)" for e in V.BUCKET_LOWER]
_BUCKETS = [f"occupancy < {_B[0]}"] + [f"occupancy >= {a} AND occupancy < {b}" for a, b in zip(_B, _B[1:])] \
    + [f"occupancy >= {_B[-1]}"]
SQL["samestore_histogram"] = with_ctes(["rooms", "samestore_centres", "entity_info"], "SELECT period, " + ", ".join(
    f"count(*) FILTER (WHERE {c}) AS bucket_{i}" for i, c in enumerate(_BUCKETS, start=1))
    + " FROM ent GROUP BY period", [PANEL, ENT])


# ---------------------------------------------------------------- lender
_WATERMARK = V.LENDER_WATERMARK
_STORED_UNTIL = f"DATE '{V.LENDER_STORED_UNTIL}'"


def _key(v: str) -> str:
    return f"CASE WHEN trim(CAST({v} AS VARCHAR)) <> '' THEN split_part(trim(CAST({v} AS VARCHAR)), '.', 1) END"


def _after(wm) -> str:
    return f"Date > DATE '{wm}'" if wm else "true"


def trends_load_cte(name: str, wm) -> tuple[str, str]:
    return (name, f"""
SELECT {_key('SAP')} AS SAP_Number, Account_Number, Line_Item AS Account_Description, Line_Item, Date,
       CASE WHEN cell = 'x' THEN CAST(0 AS DECIMAL(18,2)) ELSE TRY_CAST(cell AS DECIMAL(18,2)) END AS Amount
FROM trend_cells WHERE {_key('SAP')} IS NOT NULL AND {_after(wm)}""")


def ubox_load_cte(name: str, wm) -> tuple[str, str]:
    return (name, f"""
SELECT SAP_Number, '52152' AS Account_Number, Account AS Account_Description, Date,
       CAST(Amount AS DECIMAL(18,2)) AS Amount
FROM ubox_cells WHERE {_after(wm)}""")


def adj_load_cte(name: str, wm) -> tuple[str, str]:
    cond = f"AND \"Final Month\" > DATE '{wm}'" if wm else ""
    return (name, f"""
SELECT {_key('SAP')} AS SAP_Number, {_key('Account')} AS Account_Number,
       "Line Item" AS Account_Description, CAST("Final Month" AS DATE) AS Date,
       CAST("Final Adjustment" AS DECIMAL(18,2)) AS Total_Adjustment,
       CAST("Storage Adjustment" AS DECIMAL(18,2)) AS Storage_Adjustment,
       CAST("U-Move Adjustment" AS DECIMAL(18,2)) AS UMove_Adjustment,
       CAST("Storage Split" AS DOUBLE) AS Storage_Split
FROM lender_adjustments_sheet WHERE SAP IS NOT NULL {cond}""")


SQL["lender_trend_load"] = with_ctes(["trend_cells"], "SELECT * FROM tl",
                                     [trends_load_cte("tl", _WATERMARK)])
SQL["lender_ubox_load"] = with_ctes(["ubox_cells"], "SELECT * FROM ul",
                                    [ubox_load_cte("ul", _WATERMARK)])
SQL["lender_adjustment_load"] = with_ctes(["lender_adjustments_sheet"], "SELECT * FROM al",
                                          [adj_load_cte("al", _WATERMARK)])

SQL["lender_reload"] = with_ctes(["trend_cells"], f"""
SELECT * FROM stored
WHERE (SELECT max(Date) FROM stored) IS NULL OR DATE '{_WATERMARK}' >= (SELECT max(Date) FROM stored)
   OR Date IS NULL OR Date <= DATE '{_WATERMARK}'
UNION ALL SELECT * FROM tl""",
    [trends_load_cte("tall", None), ("stored", f"""SELECT * FROM tall WHERE Date <= {_STORED_UNTIL}
UNION ALL SELECT * REPLACE (CAST(NULL AS DATE) AS Date) FROM tall WHERE Date = {_STORED_UNTIL}"""),
     trends_load_cte("tl", _WATERMARK)])

_OLD_ASOF, _OLD_FY_LAST = V.OLD_AS_OF, V.OLD_FY_LAST
PORTFOLIO_OLD = [
    ("pled_old", f"""
SELECT * FROM ledger_long
WHERE month BETWEEN DATE '{_OLD_FY_LAST - 1}-04-01' AND DATE '{_OLD_ASOF.year}-{_OLD_ASOF.month:02d}-01'
  AND profit_center IN (SELECT profit_center FROM centres)"""),
    *statement_ctes("pled_old", "pstmt_old"),
    ("portfolio_old", f"""
SELECT s.date, s.profit_center, c.MEntity, s.line_item, s.value,
       {grp_label_sql('c."Group"')} AS grp_name, c."Group" AS grp_num,
       CAST(month(s.date) AS INTEGER) AS month, CAST(year(s.date) AS INTEGER) AS year,
       CAST(year(s.date + INTERVAL 9 MONTH) AS INTEGER) AS fiscal_year, CAST(month(s.date - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_month
FROM pstmt_old s LEFT JOIN centres c ON c.profit_center = s.profit_center"""),
]
SQL["statement_range_replace"] = with_ctes(["ledger_long", "chart", "acquisitions"], f"""
SELECT * FROM (SELECT * REPLACE (CASE WHEN NOT (line_item = 'SALES' AND month = 4) THEN fiscal_year END AS fiscal_year)
               FROM portfolio_old)
WHERE fiscal_year IS NULL OR NOT (fiscal_year BETWEEN {FY_LAST} AND {FY_CUR})
UNION ALL SELECT * FROM portfolio""", PORTFOLIO + PORTFOLIO_OLD)

SQL["statement_partition_replace"] = SQL["statement_range_replace"]

SQL["statement_incremental"] = with_ctes(["ledger_long", "chart"], "SELECT * FROM istmt",
    [("until", f"SELECT * FROM ledger_long WHERE month <= {_MAXM}"), *statement_ctes("until", "istmt")])

SQL["statement_checks"] = with_ctes(["ledger_long", "chart", "acquisitions"], """
SELECT 'centres rows' AS "check", count(*) AS n FROM centres
UNION ALL SELECT 'centres duplicates', count(*) FROM
  (SELECT profit_center FROM centres GROUP BY profit_center HAVING count(*) > 1)
UNION ALL SELECT 'ledger rows', count(*) FROM pled
UNION ALL SELECT 'ledger unreadable', count(*) FROM pled WHERE amount IS NULL
UNION ALL SELECT 'ledger unmapped', count(*) FROM pled WHERE account NOT IN (SELECT account FROM chart)""", PORTFOLIO[:2])

# the extract's cells; a row is rejected for the first reason that holds
_DIGIT, _MONTH = "right(SAP, 1)", 'month("Final Month")'
EXTRACT = ("extract", f"""
SELECT *, coalesce({_DIGIT} = '5' AND {_MONTH} = 4, false) AS surplus,
       coalesce({_DIGIT} = '3' AND {_MONTH} = 2, false) AS undated,
       coalesce({_DIGIT} = '4' AND {_MONTH} = 3, false) AS broken,
       CASE WHEN {_MONTH} = 6 THEN 'LENDER "ADJUSTMENT",' || chr(10) || 'second line' ELSE "Line Item" END AS item,
       CASE WHEN "Final Adjustment" = 0 THEN 'x' ELSE CAST("Final Adjustment" AS VARCHAR) END AS total
FROM lender_adjustments_sheet""")
SQL["sheet_adjustments"] = with_ctes(["lender_adjustments_sheet"], f"""
SELECT {_key('SAP')} AS SAP_Number, {_key('Account')} AS Account_Number, item AS Account_Description,
       CAST("Final Month" AS DATE) AS Date, CAST("Final Adjustment" AS DECIMAL(18,2)) AS Total_Adjustment,
       CAST("Storage Adjustment" AS DECIMAL(18,2)) AS Storage_Adjustment,
       CAST("U-Move Adjustment" AS DECIMAL(18,2)) AS UMove_Adjustment, CAST("Storage Split" AS DOUBLE) AS Storage_Split
FROM extract WHERE SAP IS NOT NULL AND NOT surplus AND NOT undated AND NOT broken""", [EXTRACT])
SQL["sheet_rejects"] = with_ctes(["lender_adjustments_sheet"], """
SELECT 'year=' || CAST(year("Final Month") AS VARCHAR) AS file,
       CASE WHEN surplus THEN 'surplus cells' WHEN undated THEN 'unreadable Final Month'
            ELSE 'unreadable Final Adjustment' END AS reason,
       CASE WHEN surplus THEN array_to_string(cells, ',') || ',late,entry'
            ELSE '"' || array_to_string(cells, '","') || '"' END AS record
FROM (SELECT *, [SAP, Account, item, CASE WHEN undated THEN 'n/a' ELSE CAST(CAST("Final Month" AS DATE) AS VARCHAR) END,
                 CASE WHEN broken THEN '#REF!' ELSE total END, CAST("Storage Adjustment" AS VARCHAR),
                 CAST("U-Move Adjustment" AS VARCHAR), '0.5'] AS cells FROM extract)
WHERE surplus OR undated OR broken""", [EXTRACT])

SQL["append_batches"] = with_ctes(["lender_adjustments_sheet"], f"""
SELECT CASE WHEN Date <= DATE '{_WATERMARK}' THEN 'until' ELSE 'after' END AS batch_id, Date, count(*) AS n,
       sum(Total_Adjustment) AS total
FROM aall GROUP BY 1, 2""", [adj_load_cte("aall", None)])

_ACCTS = f"SELECT CAST({V.ACCOUNT_BASE} + p_partkey AS VARCHAR) FROM part WHERE p_size <= 25"
SQL["lender_trend_rollup"] = with_ctes(["trend_cells", "samestore_centres"], f"""
SELECT Date, Line_Item, sum(Amount) AS value FROM tall
WHERE Account_Number IN ({_ACCTS}) AND SAP_Number IN (SELECT profit_center FROM samestore_centres)
GROUP BY Date, Line_Item""", [trends_load_cte("tall", None)])

SQL["lender_adjustment_rollup"] = with_ctes(["lender_adjustments_sheet", "samestore_centres"], """
SELECT Date, Account_Description, sum(Total_Adjustment) AS total_adjustment FROM aall
WHERE SAP_Number IN (SELECT profit_center FROM samestore_centres)
GROUP BY Date, Account_Description""", [adj_load_cte("aall", None)])

SQL["lender_ubox_rollup"] = with_ctes(["ubox_cells", "samestore_centres"], """
SELECT Date, Account_Description, sum(Amount) AS value FROM uall
WHERE SAP_Number IN (SELECT profit_center FROM samestore_centres)
GROUP BY Date, Account_Description""", [ubox_load_cte("uall", None)])

SQL["lender_basis_ledger"] = with_ctes(["trend_cells", "account_conversion"], """
SELECT t.SAP_Number AS profit_center, c.ledger_account AS account, t.Line_Item AS line_item,
       t.Date AS month, t.Amount AS amount
FROM tall t LEFT JOIN account_conversion c ON c.old_account = t.Account_Number""",
    [trends_load_cte("tall", None)])


# ---------------------------------------------------------------- move-in
def _window_cte(name: str, lo: str, hi: str, exclude_first: bool) -> tuple[str, str]:
    pre = "AND upper(esc_product) <> 'UBOX'" if exclude_first else ""
    post = "" if exclude_first else "WHERE upper(r.f) <> 'UBOX'"
    return (name, f"""
SELECT con_pk, r.a AS con_entity, r.b AS cus_firstname, r.c AS cus_lastname, r.d AS det_movein,
       r.e AS det_enddate, r.f AS esc_product
FROM (SELECT con_pk, min({{'a': con_entity, 'b': cus_firstname, 'c': cus_lastname, 'd': det_movein,
                           'e': det_enddate, 'f': esc_product}}) AS r
      FROM movein WHERE det_movein BETWEEN DATE '{lo}' AND DATE '{hi}' {pre} GROUP BY con_pk)
{post}""")


WINDOWS = [
    _window_cte("cyw", V.MOVEIN_CY[0], V.MOVEIN_CY[1], False),
    _window_cte("lyw", V.MOVEIN_LY[0], V.MOVEIN_LY[1], True),
    ("wins", """
SELECT con_pk, con_entity, det_movein, det_enddate, esc_product, det_movein = det_enddate AS same_day,
       sha256(concat_ws('|', coalesce(length(con_entity) || ':' || con_entity, 'n'),
         coalesce(length(cus_firstname) || ':' || cus_firstname, 'n'),
         coalesce(length(cus_lastname) || ':' || cus_lastname, 'n'))) AS person_key, 'cy' AS "window" FROM cyw
UNION ALL
SELECT con_pk, con_entity, det_movein, det_enddate, esc_product, det_movein = det_enddate AS same_day,
       sha256(concat_ws('|', coalesce(length(con_entity) || ':' || con_entity, 'n'),
         coalesce(length(cus_firstname) || ':' || cus_firstname, 'n'),
         coalesce(length(cus_lastname) || ':' || cus_lastname, 'n'))) AS person_key, 'ly' AS "window" FROM lyw"""),
]
SQL["movein_windows"] = with_ctes(["movein"], "SELECT * FROM wins", WINDOWS)
SQL["movein_by_day"] = with_ctes(["movein"], """
SELECT "window", det_movein, count(*) AS count FROM wins GROUP BY ALL""", WINDOWS)
SQL["movein_same_day"] = with_ctes(["movein"], """
SELECT n_rows, n_same_day, ((2000000 * n_same_day + n_rows) // (2 * n_rows)) / 1000000.0 AS share_same_day
FROM (SELECT count(*) AS n_rows, count(*) FILTER (WHERE det_movein = det_enddate) AS n_same_day FROM movein)""")


# ---------------------------------------------------------------- checks
SQL["data_presence"] = with_ctes(["acquisitions", "ledger_long", "chart"], """
SELECT c.profit_center, h.pc IS NOT NULL AS has_data,
       CASE WHEN h.pc IS NOT NULL THEN c.profit_center END AS na_key,
       CASE WHEN h.pc IS NOT NULL THEN c.profit_center ELSE 'Error: ' || c.profit_center END AS flag
FROM (SELECT DISTINCT profit_center FROM centres) c
LEFT JOIN (SELECT DISTINCT profit_center AS pc FROM stmt
           WHERE line_item = 'NET OPERATING INCOME' AND value <> 0
             AND CAST(profit_center AS BIGINT) % 3 <> 0 AND month(date) % 2 = 0) h
  ON h.pc = c.profit_center""", [CENTRES] + statement_ctes("ledger_long"))

SQL["centres_without_data"] = with_ctes(["acquisitions", "ledger_long", "chart", "cost_centre_hierarchy"], """
SELECT c.profit_center, h."Hierarchy Area" AS owner_area
FROM (SELECT DISTINCT profit_center FROM centres) c
LEFT JOIN cost_centre_hierarchy h ON h.Profit_Center = c.profit_center
WHERE c.profit_center NOT IN
  (SELECT profit_center FROM stmt WHERE line_item = 'NET OPERATING INCOME' AND value <> 0
     AND CAST(profit_center AS BIGINT) % 3 <> 0 AND month(date) % 2 = 0)""", [CENTRES] + statement_ctes("ledger_long"))

SQL["check_unreadable_amounts"] = with_ctes(["trend_cells"], """
SELECT 'unreadable amount' AS "check", Account_Number AS key, strftime(Date, '%Y-%m-%d') || '=' || cell AS detail
FROM trend_cells WHERE cell <> 'x' AND TRY_CAST(cell AS DECIMAL(18,2)) IS NULL""")

SQL["check_unreadable_flags"] = with_ctes(["acquisitions"], """
SELECT 'unreadable flag' AS "check", MEntity AS key, 'Include=' || Include AS detail
FROM acquisitions WHERE Include NOT IN ('Yes', 'No')""")

SQL["check_account_conflicts"] = with_ctes(["chart_raw"], f"""
SELECT 'account on two lines' AS "check", account AS key, min(line) || ' / ' || max(line) AS detail
FROM (SELECT trim(account) AS account, rtrim(line_item) AS line FROM chart_raw
      UNION ALL
      SELECT CAST({V.ACCOUNT_BASE} + p_partkey AS VARCHAR),
             coalesce([{", ".join("'" + n + "'" for n in BASE_LINES)}][CAST((p_partkey + CASE WHEN p_size = 50 THEN 1 ELSE 0 END) % {V.ACCOUNT_SLOTS} AS INTEGER) + 1],
                      '{V.NOT_REPORTED}')
      FROM part)
GROUP BY account HAVING min(line) <> max(line)""")

SQL["forecast_group_entities"] = with_ctes(["forecast", "acquisitions"], """
SELECT q."Group", count(DISTINCT l.MEntity) AS n_entities
FROM latest l JOIN acquisitions q ON q.MEntity = l.MEntity GROUP BY q."Group" """, [LATEST])

SQL["check_duplicates"] = with_ctes(["movein", "acquisitions"], """
SELECT 'duplicate contract' AS "check", con_pk AS key, 'rows=' || CAST(count(*) AS VARCHAR) AS detail
FROM movein WHERE con_pk IS NOT NULL GROUP BY con_pk HAVING count(*) > 1
UNION ALL
SELECT 'duplicate profit centre', profit_center, 'rows=' || CAST(count(*) AS VARCHAR)
FROM centres WHERE profit_center IS NOT NULL GROUP BY profit_center HAVING count(*) > 1""", [CENTRES])

LATEST_ENTITY = ("latest_entity", """
SELECT * EXCLUDE (rn) FROM
  (SELECT *, row_number() OVER (PARTITION BY MEntity
                                ORDER BY DATE_CLOSED IS NULL DESC, DATE_CLOSED DESC NULLS LAST, RECORD_ID DESC) AS rn
   FROM entity_master)
WHERE rn = 1""")
SQL["check_expected_value"] = with_ctes(["entity_master"], """
SELECT 'latest entity record' AS "check", MEntity AS key,
       'DATE_EXPIRATION=' || coalesce(CAST(DATE_EXPIRATION AS VARCHAR), 'null') AS detail
FROM latest_entity WHERE NOT coalesce(DATE_EXPIRATION = DATE '9999-12-31', false)
UNION ALL
SELECT 'latest entity record', MEntity, 'STATUS=' || coalesce(STATUS, 'null')
FROM latest_entity WHERE NOT coalesce(STATUS = 'O', false)""", [LATEST_ENTITY])

SQL["check_unmapped_accounts"] = with_ctes(["trend_cells", "account_conversion"], """
SELECT 'unmapped account' AS "check", Account_Number AS key, 'no conversion' AS detail
FROM (SELECT DISTINCT Account_Number FROM tall)
WHERE Account_Number NOT IN (SELECT old_account FROM account_conversion)""", [trends_load_cte("tall", None)])


# ---------------------------------------------------------------- acquisition list
def _clean(v: str) -> str:
    return (f"CASE WHEN trim({v}) LIKE '%E9' THEN CAST(CAST(trim({v}) AS DECIMAL(38,0)) AS VARCHAR) "
            f"WHEN trim({v}) <> '' THEN split_part(trim({v}), '.', 1) END")


NEW = ("new_acq", f"""
SELECT *, (FY_Closed - {V.BASE_FY}) * 4 + Quarter_Closed - {V.BASE_Q} + 1 AS "Group"
FROM (SELECT MEntity, Name, Close_of_Escrow, CAST(year(Close_of_Escrow + INTERVAL 9 MONTH) AS INTEGER) AS FY_Closed,
             CAST(quarter(Close_of_Escrow - INTERVAL 3 MONTH) AS INTEGER) AS Quarter_Closed, State, Purchase_Price,
             CAST(k % 40 AS VARCHAR) AS District, CAST(k % 31 AS VARCHAR) AS MCO, 'E' || MEntity AS Entity,
             CAST(k % 999 AS VARCHAR) || ' Main Street' AS Address, 'City of ' || Type AS City,
             CAST(k % 90 AS DOUBLE) AS Latitude, (k % 180) * CAST(-0.5 AS DOUBLE) AS Longitude,
             CAST(k % 4 + 1 AS VARCHAR) || ' floors' AS Property_Description
      FROM (SELECT *, CAST(MEntity AS BIGINT) AS k FROM acquisitions)) d
WHERE (SELECT max(Close_of_Escrow) FROM acquisitions WHERE Close_of_Escrow <= DATE '{V.LIST_AS_OF}') IS NULL
   OR Close_of_Escrow > (SELECT max(Close_of_Escrow) FROM acquisitions WHERE Close_of_Escrow <= DATE '{V.LIST_AS_OF}')""")
SQL["new_acquisitions"] = with_ctes(["acquisitions"], "SELECT * FROM new_acq", [NEW])

SQL["acquisition_enrichment"] = with_ctes(
    ["acquisitions", "entity_master", "index_match", "entity_info", "real_additions"], """
SELECT n."Group", n.Close_of_Escrow, l.ENTITY_NAME, n.District AS DISTRICT_NO, n.MCO AS MCO_NUM, n.Entity,
       ei."Cost Center" AS Profit_Center, n.Address, n.City, n.State, n.Latitude AS LOC_LATITUDE,
       n.Longitude AS LOC_LONGITUDE, ei.CBSA, n.Purchase_Price, n.Property_Description, im."Simple Owner" AS Simple_Owner,
       NOT (im."Parent MEntity" IS NOT NULL OR im.Abutting IS NOT NULL) AS Include,
       ra.Construction_Type AS Type, n.MEntity, im."Parent MEntity" AS Parent_MEntity,
       im.Abutting IS NOT NULL AS Abutting, im."Parent MEntity" IS NOT NULL AS Remote
FROM new_acq n
LEFT JOIN (SELECT * FROM latest_entity WHERE MEntity IN (SELECT MEntity FROM new_acq)) l ON l.MEntity = n.MEntity
LEFT JOIN index_match im ON im.MEntity = n.MEntity
LEFT JOIN entity_info ei ON ei.MEntity = im.MEntity
LEFT JOIN real_additions ra ON ra.MEntity = n.MEntity""", [NEW, LATEST_ENTITY])

SQL["list_maintenance"] = with_ctes(
    ["acquisitions", "entity_master", "index_match", "entity_info", "real_additions"], """
SELECT l.MEntity, l."Group", l.Close_of_Escrow,
       CASE WHEN ei.MEntity IS NOT NULL THEN ei."Cost Center" ELSE l.Profit_Center END AS Profit_Center,
       l.Include,
       CASE WHEN em.MEntity IS NOT NULL THEN em.en ELSE l.Name END AS ENTITY_NAME,
       CASE WHEN em.MEntity IS NOT NULL THEN em.la END AS LOC_LATITUDE,
       CASE WHEN em.MEntity IS NOT NULL THEN em.lo END AS LOC_LONGITUDE,
       CASE WHEN im.MEntity IS NOT NULL THEN im."Simple Owner" END AS Simple_Owner,
       CASE WHEN ei.MEntity IS NOT NULL THEN ei.CBSA END AS CBSA,
       CASE WHEN ra.MEntity IS NOT NULL THEN ra.Construction_Type ELSE l.Type END AS Type
FROM acquisitions l
LEFT JOIN (SELECT MEntity, arg_max(ENTITY_NAME, RECORD_ID) AS en, arg_max(LOC_LATITUDE, RECORD_ID) AS la,
                  arg_max(LOC_LONGITUDE, RECORD_ID) AS lo
           FROM entity_master WHERE STATUS = 'O' GROUP BY MEntity) em ON em.MEntity = l.MEntity
LEFT JOIN index_match im ON im.MEntity = l.MEntity
LEFT JOIN entity_info ei ON ei.MEntity = l.MEntity
LEFT JOIN real_additions ra ON ra.MEntity = l.MEntity""")

SQL["cost_centre_lookup"] = with_ctes(["acquisitions", "cost_centre_hierarchy"], f"""
SELECT c.profit_center, o.owner_area, e.hierarchy_mentity, t.type
FROM (SELECT DISTINCT profit_center FROM centres) c
LEFT JOIN (SELECT "Cost Center" AS pc, min("Hierarchy Area") AS owner_area FROM cost_centre_hierarchy GROUP BY 1) o
  ON o.pc = c.profit_center
LEFT JOIN (SELECT Profit_Center AS pc, min(MEntity) AS hierarchy_mentity FROM cost_centre_hierarchy GROUP BY 1) e
  ON e.pc = c.profit_center
LEFT JOIN (SELECT {_clean('Profit_Center')} AS pc, min(Type) AS type FROM acquisitions
           WHERE {_clean('Profit_Center')} IS NOT NULL GROUP BY 1) t ON t.pc = c.profit_center""", [CENTRES])

COHORTS = ("cohorts", f"""
SELECT "Group", profit_center, {grp_label_sql('"Group"')} AS grp_name
FROM (SELECT DISTINCT "Group", {_clean('Profit_Center')} AS profit_center FROM acquisitions)
WHERE "Group" IS NOT NULL AND profit_center IS NOT NULL""")
SQL["quarter_cohorts"] = with_ctes(["acquisitions"], "SELECT * FROM cohorts", [COHORTS])

SQL["cohort_gaps"] = with_ctes(["acquisitions", "unit_mix", "forecast"], """
SELECT * FROM
 (SELECT q."Group", q.grp_name, q.profit_center, e.MEntity, e.MEntity IS NOT NULL AS has_entity,
         coalesce(o.x, false) AS has_occupancy, coalesce(f.x, false) AS has_forecast
  FROM cohorts q
  LEFT JOIN centres e ON e.profit_center = q.profit_center
  LEFT JOIN (SELECT DISTINCT MEntity, true AS x FROM actual) o ON o.MEntity = e.MEntity
  LEFT JOIN (SELECT DISTINCT MEntity, true AS x FROM latest) f ON f.MEntity = e.MEntity)
WHERE NOT (has_entity AND has_occupancy AND has_forecast)""", [COHORTS, CENTRES, ACTUAL, LATEST])

SQL["check_missing_line_items"] = with_ctes(["chart"], f"""
SELECT 'missing line item' AS "check", line_item AS key, 'no account' AS detail
FROM (SELECT unnest([{", ".join("'" + n + "'" for n in [*BASE_LINES, V.EXTRA_LINE])}]) AS line_item)
WHERE line_item NOT IN (SELECT line_item FROM chart)""")

SQL["check_centre_lines"] = with_ctes(["ledger_long", "chart"], f"""
SELECT 'centre without line' AS "check", c.profit_center AS key,
       n.line_item || ': months=' || CAST(count(*) AS VARCHAR) AS detail
FROM (SELECT DISTINCT profit_center, month FROM ledger_long) c
CROSS JOIN (SELECT unnest([{", ".join("'" + n + "'" for n in BASE_LINES)}]) AS line_item) n
LEFT JOIN (SELECT DISTINCT profit_center, month, line_item FROM ledger_long JOIN chart USING (account)) h
  ON h.profit_center = c.profit_center AND h.month = c.month AND h.line_item = n.line_item
WHERE h.profit_center IS NULL GROUP BY c.profit_center, n.line_item""")

_LIT = [f"CAST({e} AS DOUBLE)" for e in V.LITERAL_UPPER]
_LIT_BUCKETS = [f"occupancy <= {_LIT[0]}"] + [
    f"occupancy >= {lo} AND occupancy <= {hi}" for lo, hi in zip(_B, _LIT[1:-1])] + [
    f"occupancy >= {_B[-1]} AND (occupancy <= {_LIT[-1]} OR period NOT IN ({', '.join(repr(p) for p in V.CAPPED)}))"]
SQL["samestore_histogram_literal"] = with_ctes(
    ["rooms", "samestore_centres", "entity_info"], "SELECT period, " + ", ".join(
        f"count(*) FILTER (WHERE {c}) AS bucket_{i}" for i, c in enumerate(_LIT_BUCKETS, start=1))
    + " FROM ent GROUP BY period", [PANEL, ENT])

SQL["lender_basis_statement"] = with_ctes(
    ["trend_cells", "account_conversion", "chart"], "SELECT * FROM bstmt",
    [trends_load_cte("tall", None),
     ("basis", """
SELECT t.SAP_Number AS profit_center, c.ledger_account AS account, t.Date AS month, t.Amount AS amount
FROM tall t JOIN account_conversion c ON c.old_account = t.Account_Number""")]
    + statement_ctes("basis", "bstmt"))


# Money columns are reported as double (see ``queries.reported``).
DECIMAL_OUTPUTS = {
    "dense_line_items": ["amount"],
    "group_statement": ["value", "val_thousands"],
    "income_statement": ["value"],
    "ledger_unpivot": ["amount"],
    "lender_adjustment_load": ["Total_Adjustment", "Storage_Adjustment", "UMove_Adjustment"],
    "lender_adjustment_rollup": ["total_adjustment"],
    "lender_basis_ledger": ["amount"],
    "lender_basis_statement": ["value"],
    "lender_reload": ["Amount"],
    "lender_trend_load": ["Amount"],
    "lender_trend_rollup": ["value"],
    "lender_ubox_load": ["Amount"],
    "lender_ubox_rollup": ["value"],
    "line_item_amounts": ["amount"],
    "portfolio_statement": ["value"],
    "statement_cutoff": ["value"],
    "sheet_adjustments": ["Total_Adjustment", "Storage_Adjustment", "UMove_Adjustment"],
    "append_batches": ["total"],
    "statement_partition_replace": ["value"],
    "statement_incremental": ["value"],
    "statement_range_replace": ["value"],
}
for _name, _cols in DECIMAL_OUTPUTS.items():
    _casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in _cols)
    SQL[_name] = f"SELECT * REPLACE ({_casts}) FROM (\n{SQL[_name]}\n)"

# Integer columns null on part of the rows are reported as double.
for _name, _cols in {"forecast_splice": ["ID", "total_units", "occ_units"],
                     "forecast_capacity": ["Group", "Total_Rooms"],
                     "statement_range_replace": ["fiscal_year"],
                     "statement_partition_replace": ["fiscal_year"]}.items():
    _casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in _cols)
    SQL[_name] = f"SELECT * REPLACE ({_casts}) FROM (\n{SQL[_name]}\n)"
