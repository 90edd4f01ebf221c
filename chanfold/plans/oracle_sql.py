"""The derived fact, rate table and converted fact written as plain SQL.

These common table expressions are an independent statement of
``chanfold.plans.fixture_fact`` and ``chanfold.operators.fx`` for the
DuckDB oracle (the driver pre-registers the tables as views).  Every oracle
query of the registry starts with ``WITH <BASE_CTES>``.
"""

from __future__ import annotations

OC_CTE = """
oc AS (
  SELECT o.o_orderkey, c.c_custkey, o.o_orderpriority,
         c.c_nationkey % 6 AS country_idx,
         strftime(o.o_orderdate, '%Y-%m') AS year_month
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

COUNTRY_CASE = ("CASE {x} WHEN 0 THEN 'AR' WHEN 1 THEN 'BR' WHEN 2 THEN 'CL' "
                "WHEN 3 THEN 'CO' WHEN 4 THEN 'MX' WHEN 5 THEN 'PE' END")
LOCAL_CCY_CASE = ("CASE {x} WHEN 'AR' THEN 'ARS' WHEN 'BR' THEN 'BRL' WHEN 'CL' THEN 'CLP' "
                  "WHEN 'CO' THEN 'COP' WHEN 'MX' THEN 'MXN' WHEN 'PE' THEN 'PEN' END")

FACT_CTES = OC_CTE + """,
fj AS (
  SELECT
    CASE substr(oc.o_orderpriority, 1, 1) WHEN '1' THEN 'retail' WHEN '2' THEN 'ecomm'
      WHEN '3' THEN 'app' WHEN '4' THEN 'wholesale' WHEN '5' THEN 'franchise' END AS channel,
    oc.c_custkey AS custkey, oc.o_orderkey AS orderkey,
    """ + COUNTRY_CASE.format(x="oc.country_idx") + """ AS country,
    oc.year_month,
    CASE p.p_size % 4 WHEN 0 THEN 'Running' WHEN 1 THEN 'Outdoor' WHEN 2 THEN 'Football'
      WHEN 3 THEN 'Originals' END AS category,
    CAST(p.p_partkey AS VARCHAR) AS product_id,
    CAST(l.l_quantity AS BIGINT) AS qty_ordered,
    CASE WHEN l.l_returnflag = 'R' THEN 'returned'
         WHEN l.l_returnflag = 'A' THEN 'delivered'
         WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'processing'
         WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'cancelled' END AS order_status,
    l.l_linenumber AS linenumber,
    CASE WHEN l.l_quantity <> 0 THEN l.l_extendedprice / l.l_quantity END AS price
  FROM lineitem l
  JOIN oc ON l.l_orderkey = oc.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
fj2 AS (
  SELECT *,
    CASE WHEN order_status IN ('processing', 'cancelled') THEN CAST(0 AS BIGINT)
         ELSE greatest(CAST(0 AS BIGINT), qty_ordered - linenumber % 3) END AS qty_sold
  FROM fj
),
fact AS (
  SELECT channel,
    CASE WHEN channel <> 'wholesale' THEN CAST(custkey AS VARCHAR) END AS consumer_id,
    CASE WHEN channel <> 'wholesale' THEN CAST(orderkey AS VARCHAR) END AS order_id,
    country, year_month, category, product_id, qty_ordered, qty_sold,
    CASE WHEN channel IN ('wholesale', 'app') AND qty_sold = 0 THEN NULL ELSE price END AS unit_price,
    CASE WHEN channel IN ('ecomm', 'wholesale') THEN 'EUR'
         ELSE """ + LOCAL_CCY_CASE.format(x="country") + """ END AS currency,
    CASE WHEN channel = 'wholesale' AND qty_sold = 0 THEN NULL ELSE qty_sold * price END AS revenue_local,
    order_status,
    CASE WHEN channel = 'wholesale' THEN NULL
         WHEN channel = 'app' AND custkey % 3 = 0 THEN NULL
         WHEN channel = 'retail' AND custkey % 50 = 0 THEN NULL
         ELSE custkey % 3 <> 0 END AS member
  FROM fj2
),
rates AS (
  SELECT * FROM (
    SELECT """ + COUNTRY_CASE.format(x="country_idx") + """ AS country, year_month,
      """ + LOCAL_CCY_CASE.format(x=COUNTRY_CASE.format(x="country_idx")) + """ AS currency_from,
      'EUR' AS currency_to,
      CAST((country_idx + 1) * 10 + CAST(substr(year_month, 6, 2) AS INTEGER) * 0.25 AS DOUBLE)
        AS local_units_per_eur
    FROM (SELECT DISTINCT country_idx, year_month FROM oc) k
  ) r
  WHERE NOT (country = 'PE' AND year_month LIKE '2001%')
),
fact_rated AS (
  SELECT f.*, r.local_units_per_eur
  FROM fact f LEFT JOIN rates r ON f.country = r.country AND f.year_month = r.year_month
),
fact_eur AS (
  SELECT channel, consumer_id, order_id, country, year_month, category, product_id,
    qty_ordered, qty_sold, unit_price, currency, revenue_local, order_status, member,
    CASE WHEN currency = 'EUR' THEN revenue_local
         ELSE CASE WHEN local_units_per_eur <> 0 THEN revenue_local / local_units_per_eur END
    END AS revenue_eur,
    CASE WHEN currency = 'EUR' THEN unit_price
         ELSE CASE WHEN local_units_per_eur <> 0 THEN unit_price / local_units_per_eur END
    END AS unit_price_eur
  FROM fact_rated
)"""

FACT_COLS_SQL = ("channel, consumer_id, order_id, country, year_month, category, product_id, "
                 "qty_ordered, qty_sold, unit_price, currency, revenue_local, order_status, member")


# Money is summed as doubles with compensation (the order does not matter).
MONEY_REV = "coalesce(revenue_eur, 0.0)"


def with_base(body: str, extra_ctes: str = "") -> str:
    """``WITH <fact CTEs>[, extra] <body>``."""
    ctes = FACT_CTES + ("," + extra_ctes if extra_ctes else "")
    return "WITH " + ctes + "\n" + body


def kpi_joined_sql(group_by: list[str], source: str = "fact_eur", where: str = "TRUE") -> str:
    """The three-aggregations-and-two-joins formulation of one KPI cut."""
    g = ", ".join(group_by)
    real = "order_status IN ('delivered', 'returned')"
    extra = f"""
kin AS (SELECT * FROM {source} WHERE {where}),
rev AS (SELECT {g}, kahan_sum({MONEY_REV}) AS revenue_bruto_eur
        FROM kin WHERE {real} GROUP BY {g}),
ret AS (SELECT {g},
          coalesce(kahan_sum(CASE WHEN order_status = 'delivered' THEN {MONEY_REV} END), 0) AS d,
          coalesce(kahan_sum(CASE WHEN order_status = 'returned' THEN {MONEY_REV} END), 0) AS r
        FROM kin WHERE {real} GROUP BY {g}),
ful AS (SELECT {g}, sum(qty_sold) AS s, sum(qty_ordered) AS o FROM kin GROUP BY {g})"""
    # Null keys never match in the join (plain equality), as in the source
    # system, so their rates come out null.
    on_ret = " AND ".join(f"rev.{c} = ret.{c}" for c in group_by)
    on_ful = " AND ".join(f"rev.{c} = ful.{c}" for c in group_by)
    cols = ", ".join(f"rev.{c}" for c in group_by)
    body = f"""
SELECT {cols},
  CAST(round(rev.revenue_bruto_eur, 4) AS DOUBLE) AS revenue_bruto_eur,
  round(CASE WHEN ret.d + ret.r = 0 THEN 0.0
        ELSE CAST(ret.r AS DOUBLE) / CAST(ret.d + ret.r AS DOUBLE) END, 6) AS return_rate,
  round(CAST(ful.s AS DOUBLE) / CAST(ful.o AS DOUBLE), 6) AS fulfillment_rate
FROM rev LEFT JOIN ret ON {on_ret} LEFT JOIN ful ON {on_ful}"""
    return with_base(body, extra)


# ---------------------------------------------------------------------------
# Raw channel dialects encoded from the fact (mirrors plans/raw_dialects.py).
# ---------------------------------------------------------------------------

def sql_case(expr: str, mapping: dict, passthrough: bool = False) -> str:
    """``CASE expr WHEN k THEN v ... END``; with ``passthrough`` unmapped values
    keep their input value (and null stays null)."""
    def q(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    case = f"CASE {expr} {whens} END"
    return f"coalesce({case}, {expr})" if passthrough else case


# Fixed values, written out here once more so that the oracle does not share
# them with the code under test.
ISO2_OF_NAME = {"Brazil": "BR", "Mexico": "MX", "Colombia": "CO", "Chile": "CL", "Argentina": "AR", "Peru": "PE"}
ISO2_OF_ISO3 = {"BRA": "BR", "MEX": "MX", "COL": "CO", "PER": "PE", "ARG": "AR", "CHL": "CL"}
CATEGORY_OF_TEXT = {"Runing": "Running", "Outdor": "Outdoor", "Footbal": "Football", "Originls": "Originals",
                    "Running": "Running", "Outdoor": "Outdoor", "Football": "Football", "Originals": "Originals"}
CATEGORY_OF_NUMBER = {1: "Running", 2: "Outdoor", 3: "Football", 4: "Originals"}
CATEGORY_OF_CODE = {"RUN": "Running", "OUT": "Outdoor", "FBL": "Football", "ORG": "Originals"}
NUMBER_OF_MONTH = {"Ene": "01", "Feb": "02", "Mar": "03", "Abr": "04", "May": "05", "Jun": "06",
                   "Jul": "07", "Ago": "08", "Sep": "09", "Oct": "10", "Nov": "11", "Dic": "12"}
STATUS_OF_TEXT = {"En proceso": "processing", "Entregado": "delivered", "Cancelado": "cancelled",
                  "Devuelto": "returned"}
# End of fixed values.


def _raw_ctes() -> str:
    def inv(m):
        return {v: k for k, v in m.items()}
    typo = {v: k for k, v in CATEGORY_OF_TEXT.items() if k != v}
    misspelt = (f"CASE WHEN CAST(product_id AS BIGINT) % 10 = 0 "
                f"THEN {sql_case('category', typo, passthrough=True)} ELSE category END")
    return f"""
raw_retail AS (
  SELECT order_id AS transaction_id, consumer_id,
    {sql_case('country', inv(ISO2_OF_NAME))} AS store_country,
    year_month AS order_month, {misspelt} AS product_category,
    product_id AS sku, qty_ordered AS units_ordered, qty_sold AS units_sold, unit_price, currency,
    CASE WHEN member THEN 'Y' WHEN NOT member THEN 'N' ELSE '?' END AS loyalty_flag,
    upper(order_status) AS order_state
  FROM fact WHERE channel = 'retail'),
raw_ecomm_flat AS (
  SELECT order_id AS orderId, consumer_id AS customerId, country AS market,
    CAST(replace(year_month, '-', '') AS BIGINT) AS period, currency, member AS adiClub,
    order_status AS status,
    CAST({sql_case('category', inv(CATEGORY_OF_NUMBER))} AS BIGINT) AS catCode,
    product_id AS article, qty_ordered AS qtyOrd, qty_sold AS qtySold, unit_price AS priceFinal
  FROM fact WHERE channel = 'ecomm'),
raw_app AS (
  SELECT consumer_id AS uid, {sql_case('country', inv(ISO2_OF_ISO3))} AS cc,
    replace(year_month, '-', '/') AS yearmonth, {misspelt} AS category,
    CAST(product_id AS BIGINT) AS productId, qty_ordered AS qty, qty_sold AS sold,
    revenue_local AS amount, currency, order_id AS orderRef,
    CASE WHEN member THEN 'Y' ELSE 'N' END AS member,
    upper(substr(order_status, 1, 1)) || substr(order_status, 2) AS fulfillment
  FROM fact WHERE channel = 'app'),
raw_wholesale AS (
  SELECT country AS country_code,
    {sql_case('category', inv(CATEGORY_OF_CODE))} AS category_code,
    CAST(year_month || '-01' AS TIMESTAMP) AS yr_month, product_id AS material_id,
    qty_ordered AS sell_in_units, qty_sold AS sell_out_units, unit_price AS avg_price,
    currency, order_status AS status
  FROM fact WHERE channel = 'wholesale'),
raw_franchise AS (
  SELECT order_id AS Num_Orden, consumer_id AS Consumidor, country AS Pais,
    {sql_case('substr(year_month, 6, 2)', inv(NUMBER_OF_MONTH))} || '-' || substr(year_month, 1, 4) AS Mes,
    {misspelt} AS Categoria, product_id AS Codigo_Producto,
    qty_ordered AS Cant_Pedida, qty_sold AS Cant_Vendida, unit_price AS Precio_Unitario,
    currency AS Moneda,
    CASE WHEN member THEN 'Si' WHEN NOT member THEN 'No' ELSE '?' END AS AdiClub,
    {sql_case('order_status', inv(STATUS_OF_TEXT))} AS Estado_Orden
  FROM fact WHERE channel = 'franchise')"""


RAW_CTES = _raw_ctes()


def with_raw(body: str) -> str:
    return with_base(body, RAW_CTES)


# Conformed fact as the silver step produces it: identical to ``fact`` except
# app unit prices, which are recomputed from the amount by division.
CONFORMED_CTE_BODY = ("SELECT channel, consumer_id, order_id, country, year_month, category, "
                      "product_id, qty_ordered, qty_sold, "
                      "CASE WHEN channel = 'app' THEN CASE WHEN qty_sold > 0 THEN revenue_local / qty_sold END "
                      "ELSE unit_price END AS unit_price, currency, revenue_local, order_status, member "
                      "FROM fact")
