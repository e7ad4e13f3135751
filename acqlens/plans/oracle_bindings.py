"""The test-table bindings of ``acqlens.sources.bindings`` written as SQL
common table expressions for DuckDB (the cross-check oracle)."""

from __future__ import annotations

from . import oracle_values as V


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


_INCOME_SLOTS = ", ".join(str(i) for i in V.INCOME_SLOTS)
_RAW_NAMES = ", ".join(_lit(n + " " if n == "THIRD PARTY LEASE" else n) for n in V.BASE_LINES)


CTES: dict[str, tuple[list[str], str]] = {
    "ledger_long": ([], f"""
SELECT CAST({V.CENTRE_BASE} + l_suppkey AS VARCHAR) AS profit_center,
       CAST({V.ACCOUNT_BASE} + l_partkey AS VARCHAR) AS account,
       {_month('l_shipdate')} AS month,
       CASE WHEN l_partkey % {V.ACCOUNT_SLOTS} IN ({_INCOME_SLOTS})
            THEN -CAST(l_extendedprice AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount
FROM lineitem"""),
    "ledger_wide": (["ledger_long"], """
SELECT CAST(year(month + INTERVAL 9 MONTH) AS INTEGER) AS FISCAL_YEAR, profit_center AS PROFIT_CENTER,
       account AS GL_ACCOUNT,
""" + ",\n".join(f"  CAST(sum(CASE WHEN CAST(month(month - INTERVAL 3 MONTH) AS INTEGER) = {n} THEN amount END) AS DECIMAL(18,2)) AS GC_PER_{n}"
                 for n in range(1, 13)) + """
FROM ledger_long GROUP BY ALL"""),
    "chart_raw": ([], f"""
SELECT unnest(CASE WHEN p_partkey % 40 = 0
                   THEN [CAST({V.ACCOUNT_BASE} + p_partkey AS VARCHAR), CAST({V.ACCOUNT_BASE} + p_partkey AS VARCHAR) || ' ']
                   ELSE [CAST({V.ACCOUNT_BASE} + p_partkey AS VARCHAR)] END) AS account,
       CASE WHEN p_partkey % {V.ACCOUNT_SLOTS} < {len(V.BASE_LINES)}
            THEN ([{_RAW_NAMES}])[CAST(p_partkey % {V.ACCOUNT_SLOTS} AS INTEGER) + 1]
            ELSE {_lit(V.NOT_REPORTED)} END AS line_item
FROM part"""),
    "chart": (["chart_raw"], f"""
SELECT DISTINCT trim(account) AS account, rtrim(line_item) AS line_item,
       list_position([{", ".join(_lit(n) for n in V.BASE_LINES)}], rtrim(line_item)) AS line_no,
       CASE WHEN rtrim(line_item) IN ({", ".join(_lit(n) for n in V.INCOME_LINES)}) THEN -1 ELSE 1 END AS sign
FROM chart_raw WHERE line_item <> {_lit(V.NOT_REPORTED)}"""),
    "acquisitions": ([], f"""
SELECT CAST(s.s_suppkey AS VARCHAR) AS MEntity,
       CASE WHEN s.s_suppkey % 17 = 0 THEN NULL
            WHEN s.s_suppkey % 6 = 0 THEN '7.' || substr(CAST({V.CENTRE_BASE} + s.s_suppkey AS VARCHAR), 2) || 'E9'
            WHEN s.s_suppkey % 19 = 0 THEN CAST(s.s_suppkey % 100 AS VARCHAR)
            WHEN s.s_suppkey % 2 = 0 THEN CAST({V.CENTRE_BASE} + s.s_suppkey AS VARCHAR) || '.0'
            ELSE CAST({V.CENTRE_BASE} + s.s_suppkey AS VARCHAR) END AS Profit_Center,
       (CAST(year(f.close + INTERVAL 9 MONTH) AS INTEGER) - {V.BASE_FY}) * 4
         + CAST(quarter(f.close - INTERVAL 3 MONTH) AS INTEGER) - {V.BASE_Q} + 1 AS "Group",
       f.close AS Close_of_Escrow,
       CASE WHEN s.s_suppkey % 23 = 0 THEN 'maybe' WHEN s.s_acctbal > 0 THEN 'Yes' ELSE 'No' END AS Include,
       n.n_name AS Type,
       s.s_name AS Name,
       CAST(s.s_nationkey AS VARCHAR) AS State,
       CAST(trunc(s.s_acctbal * 1000) AS BIGINT) AS Purchase_Price
FROM supplier s
JOIN (SELECT l_suppkey, CAST(min({{'k': l_orderkey, 'd': l_shipdate}}).d AS DATE) AS close
      FROM lineitem GROUP BY l_suppkey) f ON f.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey"""),
    "unit_mix": ([], f"""
SELECT CAST(l_suppkey AS VARCHAR) AS MEntity, {_month('l_shipdate')} AS Date,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Ubox'
            WHEN l_returnflag = 'R' THEN 'UBOX'
            WHEN l_returnflag = 'A' THEN 'STORAGE' ELSE 'PARKING' END AS unm_product,
       CASE WHEN l_linestatus = 'O' THEN 'CLIMATE' ELSE 'STANDARD' END AS unm_climate,
       CAST(trunc(l_quantity) AS BIGINT) AS unm_numunits,
       greatest(0, CAST(trunc(l_quantity) AS BIGINT) - l_suppkey % 11) AS unm_occunits,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS unm_rentrate
FROM lineitem"""),
    "forecast": ([], f"""
SELECT o_orderkey AS ID, CAST(o_custkey // {V.ENTITY_PER_CUSTOMER} AS VARCHAR) AS MEntity,
       CAST(date_trunc('quarter', o_orderdate) AS DATE) AS Start_Date,
       {_month('o_orderdate')} AS FC_Date, o_totalprice AS FC_Occ
FROM orders"""),
    "entity_master": ([], f"""
SELECT o_orderkey AS RECORD_ID, CAST(o_custkey // {V.ENTITY_PER_CUSTOMER} AS VARCHAR) AS MEntity,
       c_name AS ENTITY_NAME, CAST(c_nationkey AS VARCHAR) AS MCO_NUM, o_orderstatus AS STATUS,
       CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS DATE_CLOSED,
       CASE WHEN o_orderstatus = 'O' THEN DATE '9999-12-31'
            ELSE CAST(o_orderdate AS DATE) + 365 END AS DATE_EXPIRATION,
       c_acctbal / 100 AS LOC_LATITUDE, c_nationkey * CAST(-1.5 AS DOUBLE) AS LOC_LONGITUDE
FROM orders JOIN customer ON c_custkey = o_custkey"""),
    "index_match": ([], """
SELECT CAST(s_suppkey AS VARCHAR) AS MEntity,
       CASE WHEN s_suppkey % 7 = 3 THEN CAST(s_suppkey - 1 AS VARCHAR) END AS "Parent MEntity",
       CASE WHEN s_suppkey % 11 = 5 THEN 'Yes' END AS Abutting,
       'Owner ' || CAST(s_suppkey % 4 AS VARCHAR) AS "Simple Owner",
       CAST(s_suppkey % 50 AS VARCHAR) AS District,
       CAST(s_nationkey AS VARCHAR) AS State
FROM supplier"""),
    "entity_info": ([], f"""
SELECT CAST(s_suppkey AS VARCHAR) AS MEntity, 'CBSA-' || CAST(s_suppkey % 37 AS VARCHAR) AS CBSA,
       CAST({V.CENTRE_BASE} + s_suppkey AS VARCHAR) AS "Cost Center"
FROM supplier"""),
    "real_additions": ([], """
SELECT CAST(s_suppkey AS VARCHAR) AS MEntity,
       CASE WHEN s_suppkey % 3 = 0 THEN 'NEW BUILD' ELSE 'CONVERSION' END AS Construction_Type
FROM supplier WHERE s_acctbal >= 0"""),
    "cost_centre_hierarchy": ([], f"""
SELECT CAST({V.CENTRE_BASE} + s_suppkey AS VARCHAR) AS "Cost Center",
       CAST({V.CENTRE_BASE} + s_suppkey AS VARCHAR) AS Profit_Center,
       CAST(s_suppkey AS VARCHAR) AS MEntity, r_name AS "Hierarchy Area"
FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey"""),
    "lender_long": (["ledger_long", "chart"], f"""
SELECT l.profit_center AS SAP_Number, l.acct AS Account_Number, c.line_item AS Line_Item,
       l.month AS Date, l.amount AS Amount
FROM (SELECT *, CAST({V.ACCOUNT_BASE + V.LENDER_ACCOUNTS} + (CAST(account AS BIGINT) - {V.ACCOUNT_BASE}) % {V.LENDER_ACCOUNTS}
                     AS VARCHAR) AS acct FROM ledger_long) l
JOIN chart c ON c.account = l.acct"""),
    "all_months": (["ledger_long"], """
SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS Date FROM ledger_long"""),
    # the sheets, a row a cell: every row of the sheet has a cell for every month
    "trend_cells": (["lender_long", "all_months"], """
SELECT CASE WHEN right(g.SAP_Number, 1) = '9' THEN NULL WHEN right(g.SAP_Number, 1) = '8' THEN '  '
            WHEN right(g.SAP_Number, 1) = '2' THEN g.SAP_Number || '.0' ELSE g.SAP_Number END AS SAP,
       g.Account_Number, g.Line_Item, m.Date,
       CASE WHEN s.Amount IS NULL THEN 'x'
            WHEN right(g.SAP_Number, 1) = '4' AND g.Line_Item = 'UTILITIES' THEN '#REF!'
            ELSE CAST(s.Amount AS VARCHAR) END AS cell
FROM (SELECT DISTINCT SAP_Number, Account_Number, Line_Item FROM lender_long) g CROSS JOIN all_months m
LEFT JOIN (SELECT SAP_Number, Account_Number, Line_Item, Date, sum(Amount) AS Amount FROM lender_long GROUP BY ALL) s
  ON s.SAP_Number = g.SAP_Number AND s.Account_Number = g.Account_Number AND s.Line_Item = g.Line_Item
     AND s.Date = m.Date"""),
    "ubox_cells": (["lender_long", "all_months"], """
SELECT g.SAP_Number, g.Account, m.Date, coalesce(s.Amount, 0) AS Amount
FROM (SELECT DISTINCT SAP_Number, Account FROM ub) g CROSS JOIN all_months m
LEFT JOIN (SELECT SAP_Number, Account, Date, sum(-Amount) AS Amount FROM ub GROUP BY ALL) s
  ON s.SAP_Number = g.SAP_Number AND s.Account = g.Account AND s.Date = m.Date""".replace("FROM ub", """FROM
  (SELECT *, CASE WHEN Line_Item = 'U-BOX DELIVERY INCOME' THEN 'U-BOX ONE-WAY DELIVERY INCOME'
                  ELSE 'U-BOX LOCAL DELIVERY INCOME' END AS Account
   FROM lender_long WHERE Line_Item IN ('U-BOX DELIVERY INCOME', 'U-BOX OTHER INCOME'))""")),
    "lender_adjustments_sheet": (["lender_long"], """
SELECT CASE WHEN right(SAP_Number, 1) <> '9' THEN SAP_Number END AS SAP,
       '40010' AS Account, 'LENDER ADJUSTMENT' AS "Line Item", Date AS "Final Month",
       st + um AS "Final Adjustment", st AS "Storage Adjustment", um AS "U-Move Adjustment",
       CAST(0.5 AS DOUBLE) AS "Storage Split"
FROM (SELECT SAP_Number, Date,
             coalesce(sum(CASE WHEN Line_Item = 'STORAGE INCOME' THEN Amount END), 0) AS st,
             coalesce(sum(CASE WHEN Line_Item = 'U-MOVE NET COMMISSION' THEN Amount END), 0) AS um
      FROM lender_long GROUP BY SAP_Number, Date)"""),
    "account_conversion": ([], f"""
SELECT CAST({V.ACCOUNT_BASE} + p_partkey AS VARCHAR) AS old_account,
       CAST({V.ACCOUNT_BASE} + p_partkey + 50 AS VARCHAR) AS ledger_account
FROM part WHERE p_size <= 40"""),
    "movein": ([], """
SELECT CAST(o_orderkey AS VARCHAR) AS con_pk, CAST(l_suppkey AS VARCHAR) AS con_entity,
       'C' || CAST(o_custkey AS VARCHAR) AS cus_firstname, o_orderpriority AS cus_lastname,
       CAST(o_orderdate AS DATE) AS det_movein, CAST(l_shipdate AS DATE) AS det_enddate,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Ubox'
            WHEN l_returnflag = 'R' THEN 'UBOX'
            WHEN l_returnflag = 'A' THEN 'STORAGE' ELSE 'PARKING' END AS esc_product
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""),
    "rooms": (["unit_mix"], """
SELECT MEntity, Date, CAST(sum(unm_numunits) AS DOUBLE) + CAST(0.5 AS DOUBLE) AS total,
       CAST(sum(unm_occunits) AS DOUBLE) + CAST(0.25 AS DOUBLE) AS occ
FROM unit_mix GROUP BY MEntity, Date"""),
    "samestore_centres": ([], f"""
SELECT CAST({V.CENTRE_BASE} + s_suppkey AS VARCHAR) AS profit_center FROM supplier WHERE s_acctbal > 0"""),
}


def with_ctes(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding the named bindings (and their dependencies) in
    dependency order, then any query-specific CTEs, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in order]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body
