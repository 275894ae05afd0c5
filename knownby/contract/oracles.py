"""The same results in plain SQL over the same tables, written independently of the Spark plans."""

from __future__ import annotations

from knownby.sources import driver_tables as D

# The filing tags of the test tables, with their order of preference.
_SOURCE_TAGS = """VALUES
  ('Revenues', 'revenue', 0, false, 'USD'), ('SalesRevenueNet', 'revenue', 1, false, 'USD'),
  ('NetIncomeLoss', 'net_income', 0, false, 'USD'), ('ProfitLoss', 'net_income', 2, false, 'USD'),
  ('CostOfGoodsAndServicesSold', 'cogs', 0, false, 'USD'), ('CostOfRevenue', 'cogs', 1, false, 'USD'),
  ('OperatingIncomeLoss', 'operating_income', 0, false, 'USD'),
  ('ResearchAndDevelopmentExpense', 'rd_expense', 0, false, 'USD'),
  ('SellingGeneralAndAdministrativeExpense', 'sga_expense', 0, false, 'USD'),
  ('NetCashProvidedByUsedInOperatingActivities', 'operating_cash_flow', 0, false, 'USD'),
  ('PaymentsToAcquirePropertyPlantAndEquipment', 'capex', 0, false, 'USD'),
  ('StockholdersEquity', 'equity', 0, true, 'USD'),
  ('StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest', 'equity', 1, true, 'USD'),
  ('Assets', 'total_assets', 0, true, 'USD'),
  ('CashAndCashEquivalentsAtCarryingValue', 'cash', 0, true, 'USD'),
  ('LongTermDebt', 'long_term_debt', 0, true, 'USD'),
  ('LongTermDebtNoncurrent', 'long_term_debt', 1, true, 'USD'),
  ('ShortTermBorrowings', 'short_term_debt', 0, true, 'USD'),
  ('CommonStockSharesOutstanding', 'shares_outstanding', 0, true, 'shares')"""

# Tags of the daily table, those with annual and with trailing forms, and its columns.
MATRIX_TAGS = ["revenue", "net_income", "cogs", "operating_income", "rd_expense", "sga_expense",
               "operating_cash_flow", "capex", "shares_outstanding", "equity", "total_assets", "cash",
               "long_term_debt", "short_term_debt"]
FY_TAGS = ["revenue", "net_income", "cogs", "operating_income", "rd_expense", "sga_expense"]
TTM_TAGS = ["net_income", "revenue", "operating_income", "operating_cash_flow", "capex"]
MATRIX_COLUMNS = [
    "ticker", "cik", "p_date", "close", "adjClose", "volume", "sector", "industry", "mkt_cap", "pe_ratio",
    "pb_ratio", "roe", "roa", "gross_margin", "rev_growth_yoy", "mom_12m", "adv_20d", "debt_to_equity",
    "fcf_yield", "ev", "ev_to_ebit", "revenue", "net_income", "cogs", "operating_income", "rd_expense",
    "sga_expense", "operating_cash_flow", "capex", "revenue_fy", "net_income_fy", "cogs_fy",
    "operating_income_fy", "rd_expense_fy", "sga_expense_fy", "shares_outstanding", "equity",
    "total_assets", "cash", "long_term_debt", "short_term_debt"]

# Industry-code ranges, the first that holds a code counts; no label keeps the description.
SIC_RULES = [
    (2830, 2836, "Healthcare", None), (8000, 8099, "Healthcare", None),
    (3570, 3579, "Technology", None), (3660, 3679, "Technology", None), (7370, 7379, "Technology", None),
    (6798, 6798, "Real Estate", "REIT"),
    (100, 999, "Consumer Defensive", None), (1000, 1499, "Basic Materials", None),
    (1500, 1799, "Industrials", "Construction"), (2000, 3999, "Industrials", "Manufacturing"),
    (4000, 4899, "Industrials", "Transportation & Comm"), (4900, 4999, "Utilities", None),
    (5000, 5199, "Consumer Cyclical", "Wholesale"), (5200, 5999, "Consumer Cyclical", "Retail"),
    (6000, 6799, "Financial Services", None), (7000, 8999, "Consumer Cyclical", "Services"),
]

_FY = list(dict.fromkeys([*FY_TAGS, *TTM_TAGS]))
_SNAPSHOT = [*MATRIX_TAGS, *[f"{t}_fy" for t in _FY]]
_FILLED = [*MATRIX_TAGS, *[f"{t}_fy" for t in FY_TAGS], *[f"{t}_ttm" for t in TTM_TAGS]]


def _cols(template: str, names: list[str]) -> str:
    return ", ".join(template.format(n=n) for n in names)


def _lag_return(column: str, rows: int) -> str:
    return f"{column} / nullif(lag({column}, {rows}) OVER daily, 0) - 1"


def _rolling(stat: str, column: str, rows: int) -> str:
    frame = f"OVER (PARTITION BY permaTicker ORDER BY p_date ROWS {rows - 1} PRECEDING)"
    return f"CASE WHEN count({column}) {frame} = {rows} THEN {stat}({column}) {frame} END"


_DAILY = "WINDOW daily AS (PARTITION BY permaTicker ORDER BY p_date)"
_FILL = ("last_value({n} IGNORE NULLS) OVER (PARTITION BY permaTicker ORDER BY p_date "
         "ROWS UNBOUNDED PRECEDING) AS {n}")

# Named subqueries in dependency order; a query takes those it names and all they need.
_CTES: dict[str, tuple[list[str], str]] = {
    "fx_prices": ([], D.FX_PRICES),
    "fx_prices_alt": ([], D.FX_PRICES_ALT),
    "fx_actions": ([], D.FX_ACTIONS),
    "fx_facts_raw": ([], D.FX_FACTS_RAW),
    "fx_meta": ([], D.FX_META),
    "classified": (["fx_facts_raw"], f"""
        SELECT cik, tag, end_date, filed_date, val, priority * 1000000000000 + pos AS place, is_instant,
               coalesce(nullif(fp, ''), 'Unknown') AS fp,
               NOT is_instant AND coalesce(end_date - start_date BETWEEN 80 AND 105, false)
                 AS is_quarter,
               NOT is_instant AND coalesce(end_date - start_date BETWEEN 350 AND 380, false)
                 AS is_fy
        FROM fx_facts_raw
        JOIN ({_SOURCE_TAGS}) AS m(sec_tag, tag, priority, is_instant, want_unit) USING (sec_tag)
        WHERE unit = want_unit AND val IS NOT NULL AND end_date IS NOT NULL
          AND filed_date IS NOT NULL"""),
    "facts": (["classified"], """
        SELECT cik, tag, arg_min(val, place) AS val, arg_min(val, place) AS raw_val, end_date,
               filed_date, fp, is_fy, is_quarter
        FROM classified WHERE is_instant OR is_quarter OR is_fy
        GROUP BY cik, tag, end_date, filed_date, fp, is_fy, is_quarter"""),
    "reports": (["facts"], "SELECT cik, end_date AS e_date, filed_date AS f_date, "
                + _cols("arg_max(val, 2 * is_fy::INT + is_quarter::INT) FILTER (tag = '{n}') AS {n}",
                        MATRIX_TAGS) + ", "
                + _cols("max(val) FILTER (tag = '{n}' AND is_fy) AS {n}_fy", _FY)
                + " FROM facts GROUP BY ALL"),
    "snapshot": (["reports"], """
        SELECT * FROM reports
        QUALIFY row_number() OVER (PARTITION BY cik, f_date ORDER BY e_date DESC) = 1"""),
    "shares": (["facts"], """
        SELECT cik, filed_date AS f_date, max(val) AS shares_sec FROM facts
        WHERE tag = 'shares_outstanding' GROUP BY ALL"""),
    "versions": (["facts"], "SELECT cik, end_date AS e_date, filed_date AS f_date, "
                 + _cols("max(val) FILTER (tag = '{n}') AS {n}", TTM_TAGS)
                 + " FROM facts WHERE is_quarter GROUP BY ALL"),
    "known": (["versions"], "SELECT f.f_date AS known_day, v.* FROM "
              "(SELECT DISTINCT cik, f_date FROM versions) f "
              "JOIN versions v ON v.cik = f.cik AND v.f_date <= f.f_date"),
    "seen": (["known"], "SELECT cik, known_day, " + _cols("bool_or({n} IS NOT NULL) AS {n}_seen", TTM_TAGS)
             + " FROM known GROUP BY cik, known_day"),
    "latest4": (["known"], """
        SELECT * FROM (SELECT * FROM known QUALIFY row_number() OVER
                       (PARTITION BY cik, known_day, e_date ORDER BY f_date DESC) = 1)
        QUALIFY row_number() OVER (PARTITION BY cik, known_day ORDER BY e_date DESC) <= 4"""),
    "ttm": (["latest4", "seen"], "SELECT cik, known_day AS f_date, " + _cols(
        "CASE WHEN n = 4 AND span BETWEEN 265 AND 285 AND {n}_seen THEN {n}_sum END AS {n}_ttm",
        TTM_TAGS) + " FROM (SELECT cik, known_day, count(*) AS n, max(e_date) - min(e_date) AS span, "
        + _cols("coalesce(sum({n} ORDER BY e_date DESC), 0) AS {n}_sum", TTM_TAGS)
        + " FROM latest4 GROUP BY cik, known_day) JOIN seen USING (cik, known_day)"),
    "filings": (["snapshot", "ttm"], "SELECT cik, f_date, " + _cols("s.{n}", _SNAPSHOT) + ", "
                + _cols("coalesce(s.{n}_fy, t.{n}_ttm) AS {n}_ttm", TTM_TAGS)
                + " FROM snapshot s LEFT JOIN ttm t USING (cik, f_date)"),
    "securities": (["fx_meta", "facts"], """
        SELECT permaTicker, ticker, cik, sector, industry FROM fx_meta
        WHERE ticker <> '' AND length(ticker) <= 5
          AND NOT regexp_matches(upper(ticker), '-P|_P|PR|WS|-W|\\.U| WRT')
          AND cik IN (SELECT cik FROM facts)"""),
    "bars": (["fx_prices", "securities"], "SELECT * FROM fx_prices JOIN securities USING (permaTicker)"),
    "matched": (["bars", "filings"], "SELECT b.*, f.f_date, " + _cols("f.{n}", _FILLED)
                + " FROM bars b ASOF LEFT JOIN filings f ON b.cik = f.cik AND b.p_date >= f.f_date"),
    "filled": (["matched"], "SELECT * REPLACE (" + _cols(_FILL, _FILLED) + ") FROM matched"),
    "priced": (["bars", "shares"], """
        SELECT b.*, close * shares_sec / nullif(adjClose, 0) AS n_at_filing
        FROM bars b LEFT JOIN shares s ON b.cik = s.cik AND b.p_date = s.f_date"""),
    "caps": (["priced"], "SELECT permaTicker, p_date, n_at_filing, last_value(n_at_filing IGNORE NULLS)"
             " OVER (PARTITION BY permaTicker ORDER BY p_date ROWS UNBOUNDED PRECEDING) AS n_shares"
             " FROM priced"),
    "signals": (["filled", "caps"], f"""
        SELECT *, nullif(adjClose * n_shares, 0) AS mkt_cap,
               {_lag_return("adjClose", 252)} AS mom_12m,
               {_rolling("avg", "dollar_volume", 20)} AS adv_20d,
               {_lag_return("revenue_ttm", 252)} AS rev_growth_yoy,
               {_lag_return("net_income_ttm", 252)} AS ni_growth_yoy,
               coalesce(long_term_debt, 0) + coalesce(short_term_debt, 0) AS debt
        FROM (SELECT *, adjClose * adjVolume AS dollar_volume
              FROM filled JOIN caps USING (permaTicker, p_date)) {_DAILY}"""),
    "matrix": (["signals"], """
        SELECT *, mkt_cap / nullif(net_income_ttm, 0) AS pe_ratio,
               mkt_cap / nullif(equity, 0) AS pb_ratio,
               net_income_ttm / nullif(total_assets, 0) AS roe,
               net_income_ttm / nullif(total_assets, 0) AS roa,
               (coalesce(revenue, 0) - coalesce(cogs, 0)) / nullif(revenue, 0) AS gross_margin,
               debt / nullif(equity, 0) AS debt_to_equity,
               (coalesce(operating_cash_flow_ttm, 0) - abs(coalesce(capex_ttm, 0))) / mkt_cap
                 AS fcf_yield,
               mkt_cap + debt - coalesce(cash, 0) AS ev,
               (mkt_cap + debt - coalesce(cash, 0)) / nullif(operating_income_ttm, 0) AS ev_to_ebit
        FROM signals"""),
    "last_day": (["matrix"], "SELECT max(p_date) AS d FROM matrix"),
    "daily_returns": (["fx_prices"], f"""
        SELECT permaTicker, p_date, close, adjClose, adjVolume, adjClose * adjVolume AS dollars,
               {_lag_return("adjClose", 1)} AS ret FROM fx_prices {_DAILY}"""),
    "registry": (["fx_meta"], """
        SELECT permaTicker, ticker, cik, CASE WHEN sector = 'ASIA' THEN NULL ELSE sector END AS sector,
               CASE WHEN industry < 'G' THEN 'success' WHEN industry < 'K' THEN 'failed_404'
                    WHEN industry < 'S' THEN 'failed_500' END AS status_prices,
               CASE WHEN industry < 'E' THEN 'success' WHEN industry < 'J' THEN 'failed_no_xbrl'
                    ELSE 'pending' END AS status_fundamentals
        FROM fx_meta"""),
}


def _query(body: str, *needs: str) -> str:
    wanted: set[str] = set()

    def visit(name: str) -> None:
        if name not in wanted:
            for parent in _CTES[name][0]:
                visit(parent)
            wanted.add(name)

    for need in needs:
        visit(need)
    ctes = ", ".join(f"{n} AS ({sql})" for n, (_, sql) in _CTES.items() if n in wanted)
    return f"WITH {ctes} {body}" if ctes else body


_MATRIX_SELECT = "permaTicker, " + ", ".join(
    "round(adv_20d, 1) AS adv_20d" if c == "adv_20d" else c for c in MATRIX_COLUMNS)


def _performance(annual: bool, rows: int | None = None) -> str:
    tags = ["revenue", "net_income", "operating_income", "shares_outstanding"]
    names = ", ".join(f"'{t}'" for t in tags)
    older = "lead(revenue, {k}) OVER (PARTITION BY permaTicker ORDER BY end_date DESC)"
    growth = ", ".join(
        f"coalesce(nullif(revenue, 0) / nullif({older.format(k=k)}, 0) - 1, 0) AS {name}"
        for k, name in ((1, "growth_prev"), (4, "growth_4")))
    return _query(f"""
        , periods AS (
          SELECT cik, end_date, {_cols("arg_max(val, filed_date::TEXT || is_quarter::INT) "
                                       "FILTER (tag = '{n}') AS {n}", tags)}
          FROM facts WHERE is_fy = {annual} AND tag IN ({names}) GROUP BY ALL),
        shown AS (
          SELECT m.permaTicker, m.ticker, p.* FROM periods p
          JOIN (SELECT DISTINCT permaTicker, ticker, cik FROM matrix) m USING (cik)
          QUALIFY row_number() OVER (PARTITION BY permaTicker ORDER BY end_date DESC)
            <= {10**9 if rows is None else rows})
        SELECT s.permaTicker, s.ticker, s.end_date, {_cols("s.{n}", tags)},
               coalesce(nullif(s.net_income, 0) / nullif(s.revenue, 0), 0) AS margin,
               {growth.replace("revenue", "s.revenue").replace("permaTicker", "s.permaTicker")
                      .replace("end_date", "s.end_date")},
               m.pe_ratio, m.pb_ratio, m.mkt_cap, m.close
        FROM shown s ASOF LEFT JOIN matrix m
          ON s.permaTicker = m.permaTicker AND s.end_date >= m.p_date""", "matrix", "facts")


def _sic_case(code: str, description: str) -> tuple[str, str]:
    sector = " ".join(f"WHEN {code} BETWEEN {lo} AND {hi} THEN '{s}'" for lo, hi, s, _ in SIC_RULES)
    industry = " ".join(
        f"WHEN {code} BETWEEN {lo} AND {hi} THEN {description if i is None else repr(i)}"
        for lo, hi, _, i in SIC_RULES)
    return (f"CASE {sector} ELSE 'Other' END", f"CASE {industry} ELSE {description} END")


_SECTOR, _INDUSTRY = _sic_case("sicCode", "industry")
_PRICE_COLUMNS = "permaTicker, p_date, close, high, low, open, volume, adjClose, adjVolume"


def oracles() -> dict[str, str]:
    q = _query
    return {
        "clean_facts": q("SELECT * FROM facts", "facts"),
        "quarantined_prices": q("""
            SELECT permaTicker, CASE WHEN kind = 0 THEN bars ELSE 0 END AS bars,
                   CASE kind WHEN 0 THEN '' WHEN 1 THEN 'unreadable number' WHEN 2 THEN 'unreadable date'
                        ELSE 'line of another length' END AS reason
            FROM (SELECT permaTicker, substr(permaTicker, 2)::INT % 5 AS kind, count(*) AS bars
                  FROM fx_prices JOIN fx_meta USING (permaTicker) GROUP BY permaTicker)""",
                                "fx_prices", "fx_meta"),
        "company_ids": """
            SELECT DISTINCT user_id, lpad(user_id::TEXT, 10, '0') AS from_number,
                   lpad(user_id::TEXT, 10, '0') AS from_decimal,
                   CASE WHEN length(event_type) < 10 THEN lpad(event_type, 10, '0')
                        ELSE event_type END AS from_text
            FROM events""",
        "sic_sectors": q(f"""SELECT permaTicker, sicCode, {_SECTOR} AS sic_sector,
                             {_INDUSTRY} AS sic_industry FROM fx_meta""", "fx_meta"),
        "meta_universe": q("""SELECT permaTicker, ticker, cik, sector, industry FROM securities
                              WHERE permaTicker IN (SELECT permaTicker FROM fx_prices)""",
                           "securities", "fx_prices"),
        "filing_snapshot": q(f"SELECT cik, e_date, f_date, {', '.join(_SNAPSHOT)} FROM snapshot",
                             "snapshot"),
        "share_counts": q("SELECT * FROM shares", "shares"),
        "pit_ttm": q("SELECT * FROM ttm", "ttm"),
        "ttm_fy_override": q("SELECT cik, f_date, " + _cols(
            "{n}_ttm", TTM_TAGS) + " FROM filings", "filings"),
        "asof_fundamentals": q("SELECT permaTicker, p_date, f_date, "
                               + _cols("{n}", MATRIX_TAGS) + " FROM matched", "matched"),
        "asof_fundamentals_segmented": q("SELECT permaTicker, p_date, f_date, "
                                         + _cols("{n}", MATRIX_TAGS) + " FROM matched", "matched"),
        "forward_filled": q("SELECT permaTicker, p_date, " + _cols("{n}", MATRIX_TAGS)
                            + " FROM filled", "filled"),
        "forward_filled_segmented": q("SELECT permaTicker, p_date, " + _cols("{n}", MATRIX_TAGS)
                                      + " FROM filled", "filled"),
        "split_invariant_cap": q("""
            SELECT permaTicker, p_date, n_at_filing, n_shares,
                   nullif(adjClose * n_shares, 0) AS mkt_cap
            FROM caps JOIN bars USING (permaTicker, p_date)""", "caps", "bars"),
        "split_invariant_cap_asof": q("""
            , filed AS (
              SELECT permaTicker, f_date, shares_sec FROM securities JOIN shares USING (cik)),
            fixed AS (
              SELECT f.permaTicker, f.f_date, b.close * f.shares_sec / nullif(b.adjClose, 0) AS n
              FROM filed f ASOF JOIN bars b
                ON f.permaTicker = b.permaTicker AND f.f_date >= b.p_date),
            usable AS (SELECT * FROM fixed WHERE n IS NOT NULL)
            SELECT b.permaTicker, b.p_date, u.n AS n_shares, nullif(b.adjClose * u.n, 0) AS mkt_cap
            FROM bars b ASOF LEFT JOIN usable u
              ON b.permaTicker = u.permaTicker AND b.p_date >= u.f_date""",
            "bars", "shares", "securities"),
        "daily_axis": q(f"SELECT {_PRICE_COLUMNS} FROM fx_prices", "fx_prices"),
        "momentum": q("SELECT permaTicker, p_date, " + ", ".join(
            f"{_lag_return('adjClose', n)} AS {c}" for c, n in (
                ("mom_1m", 21), ("mom_3m", 63), ("mom_6m", 126), ("mom_12m", 252)))
            + f" FROM fx_prices {_DAILY}", "fx_prices"),
        "momentum_chunked": q(f"SELECT permaTicker, p_date, {_lag_return('adjClose', 252)} AS mom_12m "
                              f"FROM fx_prices {_DAILY}", "fx_prices"),
        "adv": q(f"SELECT permaTicker, p_date, round({_rolling('avg', 'dollars', 20)}, 1) AS adv_20d"
                 " FROM daily_returns", "daily_returns"),
        "adv_chunked": q(f"SELECT permaTicker, p_date, round({_rolling('avg', 'dollars', 20)}, 1)"
                         " AS adv_20d FROM daily_returns", "daily_returns"),
        "volatility": q("SELECT permaTicker, p_date, " + ", ".join(
            f"round({_rolling('stddev_samp', 'ret', n)}, 6) AS vol_{n}d" for n in (30, 90))
            + " FROM daily_returns", "daily_returns"),
        "amihud": q("SELECT permaTicker, p_date, round(1e9 * amihud, 4) AS amihud_20d FROM (SELECT "
                    f"permaTicker, p_date, {_rolling('avg', 'impact', 20)} AS amihud FROM (SELECT *, "
                    "abs(ret) / nullif(dollars, 0) AS impact FROM daily_returns))", "daily_returns"),
        "period_gaps": q("""
            SELECT cik, e_date,
                   CAST(e_date - lag(e_date, 3) OVER w AS INTEGER) AS days_3,
                   CAST(e_date - lag(e_date, 4) OVER w AS INTEGER) AS days_4
            FROM (SELECT DISTINCT cik, e_date FROM versions)
            WINDOW w AS (PARTITION BY cik ORDER BY e_date)""", "versions"),
        "matrix": q(f"SELECT {_MATRIX_SELECT} FROM matrix", "matrix"),
        "matrix_repeated_registry": q(f"SELECT {_MATRIX_SELECT} FROM matrix", "matrix"),
        "matrix_roe_on_equity": q("""SELECT permaTicker, p_date, roa,
            net_income_ttm / nullif(equity, 0) AS roe FROM matrix""", "matrix"),
        "matrix_extended": q(f"""
            , r AS (SELECT *, {_lag_return("adjClose", 1)} AS ret FROM matrix {_DAILY})
            SELECT permaTicker, p_date, {", ".join(
                f"{_lag_return('adjClose', n)} AS {c}" for c, n in
                (("mom_1m", 21), ("mom_3m", 63), ("mom_6m", 126)))},
                   {", ".join(f"round({_rolling('stddev_samp', 'ret', n)}, 6) AS vol_{n}d"
                              for n in (30, 90))},
                   ni_growth_yoy, rd_expense / nullif(revenue, 0) AS rd_intensity,
                   (net_income_ttm - operating_cash_flow_ttm) / nullif(total_assets, 0) AS accruals
            FROM r {_DAILY}""", "matrix"),
        "status": q("""
            SELECT count(*) AS rows, count(DISTINCT ticker) AS tickers, min(p_date) AS start,
                   max(p_date) AS "end", count(DISTINCT sector) AS sectors FROM matrix""", "matrix"),
        "profile_header": q("""
            SELECT permaTicker, ticker, p_date, sector, industry, """ + _cols(
                "coalesce({n}, 0) AS {n}",
                ["close", "mkt_cap", "pe_ratio", "pb_ratio", "roe"]) + """
            FROM matrix QUALIFY row_number() OVER
              (PARTITION BY permaTicker ORDER BY p_date DESC) = 1""", "matrix"),
        "performance_annual": _performance(True, 10),
        "performance_interim": _performance(False, 24),
        "performance_all": _performance(False),
        "valuation_history": q("""
            SELECT permaTicker, CAST(date_trunc('month', p_date) AS DATE) AS month,
                   any_value(ticker) AS ticker, arg_max(close, p_date) AS close,
                   round(avg(pe_ratio), 4) AS pe_ratio, round(avg(pb_ratio), 4) AS pb_ratio,
                   arg_max_null(mkt_cap, p_date) AS mkt_cap,
                   round(avg(rev_growth_yoy), 4) AS rev_growth_yoy
            FROM matrix GROUP BY 1, 2
            QUALIFY row_number() OVER (PARTITION BY permaTicker ORDER BY month DESC) <= 24""",
            "matrix"),
        "valuation_all": q("""
            SELECT permaTicker, CAST(date_trunc('month', p_date) AS DATE) AS month,
                   any_value(ticker) AS ticker, arg_max(close, p_date) AS close,
                   round(avg(pe_ratio), 4) AS pe_ratio, round(avg(pb_ratio), 4) AS pb_ratio,
                   arg_max_null(mkt_cap, p_date) AS mkt_cap,
                   round(avg(rev_growth_yoy), 4) AS rev_growth_yoy
            FROM matrix GROUP BY 1, 2""",
            "matrix"),
        "screen": q(f"""SELECT {_MATRIX_SELECT} FROM matrix, last_day
            WHERE p_date = d AND pe_ratio < 5000 AND roe > 0.5 AND mom_12m > -0.9
              AND regexp_matches(lower(sector), 'a.*a|europe')""", "matrix", "last_day"),
        "screen_all": q(f"SELECT {_MATRIX_SELECT} FROM matrix, last_day WHERE p_date = d AND close > 0",
                        "matrix", "last_day"),
        "screen_sql": q(f"""SELECT {_MATRIX_SELECT} FROM matrix
            WHERE p_date = DATE '1998-06-15' AND pb_ratio BETWEEN 0 AND 100000
              AND (debt_to_equity = 0 OR ev > mkt_cap)""", "matrix"),
        "universe": q("""SELECT ticker, cik, sector, mkt_cap
                         FROM matrix, last_day WHERE p_date = d AND ticker IS NOT NULL""",
                      "matrix", "last_day"),
        "sector_compare": q("""
            , m AS (SELECT permaTicker, CAST(date_trunc('month', p_date) AS DATE) AS month,
                           any_value(sector) AS sector, arg_max(adjClose, p_date) AS adj
                    FROM matrix GROUP BY 1, 2),
            r AS (SELECT *, adj / nullif(lag(adj) OVER (PARTITION BY permaTicker ORDER BY month), 0)
                         - 1 AS ret FROM m)
            SELECT sector, month, count(*) AS securities, round(avg(ret), 4) AS mean_return
            FROM r WHERE ret IS NOT NULL GROUP BY ALL""", "matrix"),
        "status_upsert": """
            SELECT s_suppkey, coalesce(arg_max(event_type, (ts, event_id)), 'pending') AS status_prices
            FROM supplier LEFT JOIN events ON user_id = s_suppkey GROUP BY s_suppkey""",
        "completeness": q("""
            SELECT count(*) FILTER (status_prices IS NULL OR status_prices NOT IN
                     ('success', 'success_empty', 'failed_404')) AS missing_prices,
                   count(*) FILTER (cik IS NOT NULL AND status_fundamentals NOT IN
                     ('success', 'success_empty', 'failed_404', 'failed_no_xbrl'))
                     AS missing_fundamentals
            FROM registry""", "registry"),
        "worklist": q("""
            SELECT 'metadata' AS kind, permaTicker FROM registry
            WHERE cik IS NOT NULL AND sector IS NULL
            UNION ALL SELECT 'prices', permaTicker FROM registry
            WHERE status_prices IS NULL OR status_prices = 'failed_500'
            UNION ALL SELECT 'fundamentals', permaTicker FROM registry
            WHERE cik IS NOT NULL AND status_fundamentals <> 'success'""", "registry"),
        "hit_list": q("""
            , listed AS (SELECT permaTicker, ticker, cik FROM fx_meta UNION ALL
              SELECT 'C' || c_custkey, 'S' || c_custkey, lpad((c_custkey + 5000000)::TEXT, 10, '0')
              FROM customer WHERE c_custkey % 10 = 0)
            SELECT 'price' AS type, ticker, permaTicker AS id FROM listed
            WHERE permaTicker NOT IN (SELECT permaTicker FROM fx_prices)
            UNION ALL SELECT 'fundamentals', ticker, cik FROM listed
            WHERE cik NOT IN (SELECT cik FROM facts)""",
            "fx_meta", "fx_prices", "facts"),
        "union_dedupe": q("""
            , first AS (SELECT permaTicker, p_date, close, adjClose FROM fx_prices WHERE day(p_date) % 3 <> 0)
            SELECT * FROM first UNION ALL
            SELECT permaTicker, p_date, close, adjClose FROM fx_prices_alt
            ANTI JOIN first USING (permaTicker, p_date)""", "fx_prices", "fx_prices_alt"),
        "last_rows": """
            SELECT user_id, event_id, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "audit_survivorship": q("""
            SELECT permaTicker, any_value(ticker) AS ticker, max(p_date) AS last_seen FROM matrix
            GROUP BY permaTicker HAVING max(p_date) < (SELECT d FROM last_day)""",
            "matrix", "last_day"),
        "audit_lost_securities": q("""
            SELECT permaTicker, max(p_date) AS last_seen FROM fx_prices
            WHERE permaTicker NOT IN (SELECT permaTicker FROM matrix) GROUP BY 1""",
            "fx_prices", "matrix"),
        "audit_trailing_gaps": q("""
            , days AS (SELECT DISTINCT p_date FROM fx_prices),
            ends AS (SELECT permaTicker, max(p_date) AS last_seen FROM fx_prices GROUP BY 1)
            SELECT permaTicker, last_seen, count(*) AS missing FROM ends JOIN days ON p_date > last_seen
            GROUP BY ALL""", "fx_prices"),
        "audit_cap_bounds": q("""
            , y AS (SELECT permaTicker, year(p_date)::INTEGER AS year, avg(mkt_cap) AS mean_cap
                    FROM matrix GROUP BY ALL)
            SELECT permaTicker, year, round(mean_cap, 2) AS mean_cap,
                   abs(s_acctbal) * 1000000 AS ceiling,
                   mean_cap <= abs(s_acctbal) * 1000000 AS passed
            FROM y JOIN supplier ON permaTicker = 'P' || lpad(s_suppkey::TEXT, 6, '0')""", "matrix"),
        "audit_split": q("""
            , c AS (SELECT permaTicker, p_date, mkt_cap, lag(mkt_cap) OVER
                      (PARTITION BY permaTicker ORDER BY p_date) AS cap_before FROM matrix),
            d AS (SELECT c.*, splitFactor, abs(mkt_cap / nullif(cap_before, 0) - 1) AS deviation
                  FROM c JOIN fx_actions USING (permaTicker, p_date) WHERE splitFactor <> 1)
            SELECT *, deviation < 0.05 AS passed FROM d""",
            "matrix", "fx_actions"),
        "audit_gaps": q("""
            , days AS (SELECT p_date, row_number() OVER (ORDER BY p_date) AS i
                       FROM (SELECT DISTINCT p_date FROM fx_prices)),
            pairs AS (SELECT permaTicker, p_date AS after_day, lead(p_date) OVER
                        (PARTITION BY permaTicker ORDER BY p_date) AS before_day FROM fx_prices)
            SELECT permaTicker, after_day, before_day, b.i - a.i - 1 AS missing
            FROM pairs JOIN days a ON a.p_date = after_day JOIN days b ON b.p_date = before_day
            WHERE b.i - a.i > 1""", "fx_prices"),
        "audit_filed_order": q("""
            SELECT sec_tag, count(*) AS entries, count(*) FILTER (filed_date IS NULL) AS no_filed_date,
                   count(*) FILTER (filed_date <= end_date) AS not_after_end,
                   min(filed_date - end_date) AS min_delay, max(filed_date - end_date) AS max_delay
            FROM fx_facts_raw GROUP BY sec_tag""", "fx_facts_raw"),
        "audit_coverage": q("""
            , f AS (SELECT DISTINCT cik FROM facts), m AS (SELECT DISTINCT cik FROM matrix)
            SELECT (SELECT count(*) FROM f) AS in_facts, (SELECT count(*) FROM m) AS in_matrix,
                   (SELECT count(*) FROM f ANTI JOIN m USING (cik)) AS only_facts,
                   (SELECT count(*) FROM m ANTI JOIN f USING (cik)) AS only_matrix""",
            "matrix", "facts"),
        "audit_ghosts": q("""
            SELECT permaTicker, max(p_date) AS last_seen,
                   (SELECT max(p_date) FROM fx_prices) - max(p_date) AS idle_days,
                   (SELECT max(p_date) FROM fx_prices) - max(p_date) > 3 AS inactive
            FROM fx_prices GROUP BY permaTicker""", "fx_prices"),
        "audit_two_sources": q("""
            , d AS (SELECT permaTicker, abs((a.adjClose / nullif(a.close, 0))
                             / nullif(b.adjClose / nullif(b.close, 0), 0) - 1) AS drift
                    FROM fx_prices a JOIN fx_prices_alt b USING (permaTicker, p_date))
            SELECT permaTicker, count(*) AS shared_days,
                   count(*) FILTER (drift > 0.005) AS drifting_days,
                   max(drift) AS max_drift FROM d GROUP BY permaTicker""",
            "fx_prices", "fx_prices_alt"),
        "audit_symbol_change": q("""
            , l AS (SELECT permaTicker, p_date, symbol AS new_ticker, lag(symbol) OVER w AS old_ticker,
                           p_date - lag(p_date) OVER w AS gap_days
                    FROM fx_actions WINDOW w AS (PARTITION BY permaTicker ORDER BY p_date))
            SELECT permaTicker, p_date, old_ticker, new_ticker, gap_days FROM l
            WHERE old_ticker <> new_ticker""", "fx_actions"),
        "price_files": q(f"""
            SELECT {_PRICE_COLUMNS}, splitFactor, ticker
            FROM fx_prices JOIN fx_actions USING (permaTicker, p_date)
            JOIN fx_meta USING (permaTicker)""", "fx_prices", "fx_actions", "fx_meta"),
        "fact_files": q("SELECT * FROM facts", "facts"),
        "registry_files": q(f"""
            SELECT permaTicker, ticker, cik, sicCode::TEXT AS sicCode, {_SECTOR} AS sector,
                   {_INDUSTRY} AS industry, 'success' AS status_metadata,
                   'pending' AS status_prices, 'pending' AS status_fundamentals,
                   '2024-01-01' AS bootstrap_date FROM fx_meta""", "fx_meta"),
        "quarantined_files": q("""
            SELECT DISTINCT cik, 'unreadable JSON' AS reason FROM fx_meta
            WHERE sector = 'EUROPE'""", "fx_meta"),
        "export_history": q(f"SELECT {_MATRIX_SELECT} FROM matrix WHERE ticker = 'T11'", "matrix"),
        "export_research": q("""
            SELECT permaTicker, ticker, p_date, pe_ratio, fcf_yield FROM matrix
            WHERE p_date >= DATE '1997-01-01' AND adv_20d >= 40000""", "matrix"),
        "json_records": q("""
            SELECT '{"permaTicker":"' || permaTicker || '","ticker":"' || ticker || '","cik":"' || cik
                   || '","p_date":"' || p_date::TEXT || '","sector":"' || sector || '"}' AS record
            FROM matrix""", "matrix"),
        "stream_prices": q(f"SELECT {_PRICE_COLUMNS} FROM fx_prices", "fx_prices"),
        "stream_facts": q("SELECT * FROM facts", "facts"),
        "incremental_matrix": q(f"SELECT {_MATRIX_SELECT} FROM matrix", "matrix"),
    }
