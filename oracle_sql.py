"""DuckDB SQL for every registered query (the correctness oracle).

plain SQL constructs: ``UNION ALL`` copies for the roll-up members,
``quantile_cont`` for the edges, window aggregates for the outlier filter and
shares, and ``NOT EXISTS`` for the unique largest data partner (a formulation
independent of the Spark code's window ranking).  Every query starts from the
one extract with its date bound and positivity guards.  Double outputs are rounded
to 6 decimals with ``floor(x * 1e6 + 0.5) / 1e6`` on both sides (identical IEEE
arithmetic in both engines, unlike their ``round`` functions).
"""

from __future__ import annotations

QS = (0.2, 0.4, 0.6, 0.8, 1.0)
# shares compared at 12 decimals (ties within order-dependent float noise)
KEY = "floor({0}.dp_volume_share * CAST(1e12 AS DOUBLE) + CAST(0.5 AS DOUBLE))"
PINTS = "('STANDARD', 'PROMO', 'MEDIUM', 'LARGE')"
ZONE_A = "(" + ", ".join(str(k) for k in range(25) if k % 3 == 0) + ")"
ZONE_B = "(" + ", ".join(str(k) for k in range(25) if k % 3 == 1) + ")"

VIEW = """
v AS (
  SELECT l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_shipdate,
         o.o_custkey, c.c_mktsegment, n.n_nationkey, n.n_name, r.r_name, p.p_name, p.p_type, p.p_size
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

DATE = "CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE)"
PERIOD = "CAST(year(l_shipdate) AS INTEGER)"
SEGMENT = "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Core' ELSE 'Other' END"
PARTNER = "CAST(l_suppkey % 10 AS VARCHAR)"
SUMS = ("SUM(l_extendedprice) AS value, SUM(l_quantity) AS quantity, "
        "SUM(l_quantity * CAST(568 AS DOUBLE)) AS volume")

GUARDS = ("o_custkey > 0 AND l_partkey > 0 AND l_quantity * CAST(568 AS DOUBLE) > 0 "
          "AND l_extendedprice > 0 AND l_quantity > 0")
FROM_DATE = "l_shipdate >= TIMESTAMP '1995-02-01'"
TAKEN = f"{FROM_DATE} AND {GUARDS}"

FACT = f"""
fact AS (
  SELECT {DATE} AS date, {PERIOD} AS period, CAST(o_custkey AS BIGINT) AS outlet, p_type AS product,
         r_name AS region, {SEGMENT} AS segment, {PARTNER} AS data_partner, {SUMS}
  FROM v
  WHERE {TAKEN}
  GROUP BY 1, 2, 3, 4, 5, 6, 7, c_mktsegment
)"""

FACT_COLS = ["date", "period", "outlet", "product", "region", "segment", "data_partner", "value", "quantity", "volume"]
NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in FACT_COLS)

UNIT = f"""
unit AS (
  SELECT * REPLACE (
    CASE WHEN product IN ('SMALL') THEN quantity
         WHEN product IN {PINTS} THEN volume / CAST(568 AS DOUBLE)
         ELSE volume END AS volume)
  FROM fact
)"""


def _sigma(src: str, dst: str, metric: str, groups: str) -> str:
    return f"""
{dst}_s AS (
  SELECT *, avg({metric}) OVER w AS __m, stddev_samp({metric}) OVER w AS __s
  FROM {src} WINDOW w AS (PARTITION BY {groups})
),
{dst} AS (SELECT * EXCLUDE (__m, __s) FROM {dst}_s WHERE abs(__m - {metric}) < 3 * __s)"""


CLEAN = (
    f"""
nn AS (SELECT * FROM unit WHERE {NOT_NULL}),"""
    + _sigma("nn", "c1", "volume", "date, region, segment, product")
    + ","
    + _sigma("c1", "clean", "value", "date, region, segment, product")
)

BASE = "WITH " + ",".join([VIEW, FACT, UNIT]) + "," + CLEAN


def _copies(src: str, cols: str, members: list[tuple[int, str, str, str]]) -> str:
    """UNION ALL of labelled copies: (cell_id, region expr, segment expr, where)."""
    parts = []
    for cid, reg, seg, where in members:
        labels = "".join(f", {e} AS {n}" for e, n in ((reg, "region"), (seg, "segment")) if e)
        parts.append(f"SELECT {cols}, {cid} AS cell_id{labels} FROM {src}{(' WHERE ' + where) if where else ''}")
    return "\n  UNION ALL ".join(parts)


CUBE_A = [
    (0, "region", "segment", "region IS NOT NULL AND segment IS NOT NULL"),
    (1, "'GB'", "segment", "segment IS NOT NULL"),
    (2, "region", "'All Pubs'", "region IS NOT NULL"),
    (3, "'GB'", "'All Pubs'", ""),
]
NODIM = [(0, "", "", "")]
REGIONS_B = ["region1", "region2", "region3", "region4"]
CUBE_B = []
for _i, _r in enumerate(REGIONS_B):
    _ok = f"{_r} IS NOT NULL AND {_r} <> 'n'"
    _labelled = f"'{_r}' AS region_dim, {_r}"  # becomes "... AS region"
    CUBE_B.append((10 * (_i + 1) + 1000, _labelled, "segment", _ok + " AND segment IS NOT NULL"))
    CUBE_B.append((10 * (_i + 1) + 1, _labelled, "'All Pubs'", _ok))
LABELS_B = ("region_dim", "region", "segment")

BAND_CARRY = "date, period, outlet, data_partner, price, 'product' AS product_type, product, volume, value"


def _bands(prefix: str, src: str, members, labels=("region", "segment"), min_outlets: int = 50, carry: str = BAND_CARRY) -> str:
    """CTE chain of the price-band job over period-filtered rows ``src`` (with price)."""
    lab = ", ".join(["cell_id", *labels])
    ck = f"period, product_type, product, {lab}"
    dk = f"date, {ck}"
    bk = f"{ck}, percentile"
    q = ", ".join(f"CAST({x} AS DOUBLE)" for x in QS)
    case = " ".join(f"WHEN l.price <= e.e[{i + 1}] THEN {x}" for i, x in enumerate(QS))
    means = ", ".join(f"avg(e[{i + 1}]) AS m{i + 1}" for i in range(len(QS)))
    melt = "\n  UNION ALL ".join(
        f"SELECT {ck}, CAST({x} AS DOUBLE) AS percentile, m{i + 1} AS percentile_price FROM {prefix}bpm"
        for i, x in enumerate(QS)
    )

    def eq(a, b, keys):
        return " AND ".join(f"{a}.{k.strip()} IS NOT DISTINCT FROM {b}.{k.strip()}" for k in keys.split(","))

    return f"""
{prefix}lab AS (
  {_copies(src, carry, members)}
),
{prefix}edges AS (
  SELECT {dk}, quantile_cont(price, [{q}]) AS e FROM {prefix}lab GROUP BY {dk}
),
{prefix}bpm AS (SELECT {ck}, {means} FROM {prefix}edges GROUP BY {ck}),
{prefix}bprices AS (
  {melt}
),
{prefix}totals AS (SELECT {ck}, count(DISTINCT outlet) AS total_outlet_count FROM {prefix}lab GROUP BY {ck}),
{prefix}banded AS (
  SELECT l.*, CAST(CASE {case} END AS DOUBLE) AS percentile
  FROM {prefix}lab l JOIN {prefix}edges e USING ({dk})
),
{prefix}weekly AS (
  SELECT {dk}, percentile, sum(volume) AS sum_volume, sum(value) AS sum_value, count(DISTINCT outlet) AS outlets,
         sum(volume) / count(DISTINCT outlet) AS volume_ros, sum(value) / count(DISTINCT outlet) AS value_ros
  FROM {prefix}banded GROUP BY {dk}, percentile
),
{prefix}pros AS (
  SELECT {bk}, avg(volume_ros) AS volume_ros, avg(value_ros) AS value_ros FROM {prefix}weekly GROUP BY {bk}
),
{prefix}counts AS (
  SELECT {bk}, count(DISTINCT outlet) AS outlet_count, count(DISTINCT data_partner) AS data_partner_count
  FROM {prefix}banded GROUP BY {bk}
),
{prefix}dpv AS (SELECT {bk}, data_partner, sum(volume) AS dp_volume FROM {prefix}banded GROUP BY {bk}, data_partner),
{prefix}shares AS (
  SELECT *, sum(dp_volume) OVER w AS total_dp_volume, dp_volume / sum(dp_volume) OVER w AS dp_volume_share,
         count(*) OVER w AS data_partner_count
  FROM {prefix}dpv WINDOW w AS (PARTITION BY {bk})
),
{prefix}dom AS (
  SELECT {bk}, data_partner_count, data_partner AS nda_data_partner_with_max_share, dp_volume_share AS nda_max_data_partner_share
  FROM {prefix}shares s
  WHERE s.dp_volume_share IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM {prefix}shares t
    WHERE {eq('t', 's', bk)} AND t.data_partner <> s.data_partner AND {KEY.format('t')} >= {KEY.format('s')})
),
{prefix}res AS (
  SELECT c.*, p.volume_ros, p.value_ros, t.total_outlet_count,
         d.nda_data_partner_with_max_share, d.nda_max_data_partner_share
  FROM {prefix}counts c
  JOIN {prefix}pros p USING ({bk})
  JOIN {prefix}totals t USING ({ck})
  JOIN {prefix}dom d USING ({bk})
),
{prefix}joined AS (
  SELECT b.period, b.product, b.product_type, {''.join('b.' + x + ', ' for x in labels)}b.percentile, b.percentile_price,
         r.volume_ros, r.value_ros, r.outlet_count, r.total_outlet_count, r.data_partner_count,
         r.nda_data_partner_with_max_share, r.nda_max_data_partner_share
  FROM {prefix}bprices b LEFT JOIN {prefix}res r USING ({bk})
),
{prefix}published AS (
  SELECT period, product, product_type, {''.join(x + ', ' for x in labels)}percentile, percentile_price, volume_ros, value_ros,
         outlet_count, total_outlet_count
  FROM {prefix}joined
  WHERE outlet_count >= {min_outlets} AND data_partner_count >= 3 AND floor(nda_max_data_partner_share * CAST(1e12 AS DOUBLE) + CAST(0.5 AS DOUBLE)) <= 500000000000
)"""


def _avg(prefix: str, src: str, members, labels=("region", "segment"), min_outlets: int = 50) -> str:
    lab = ", ".join(["cell_id", *labels])
    out = ", ".join(labels)
    c_out = ", ".join(f"c.{x}" for x in labels)
    k = f"date, product, {lab}"

    def eq(a, b):
        return " AND ".join(f"{a}.{x.strip()} IS NOT DISTINCT FROM {b}.{x.strip()}" for x in k.split(","))

    return f"""
{prefix}lab AS (
  {_copies(src, "date, product, outlet, data_partner, price, volume, value", members)}
),
{prefix}cube AS (
  SELECT {k}, sum(volume) AS sum_volume, sum(value) AS sum_value, count(DISTINCT outlet) AS outlet_count,
         avg(price) AS avg_price, count(DISTINCT data_partner) AS data_partner_count,
         sum(volume) / count(DISTINCT outlet) AS volume_ros, sum(value) / count(DISTINCT outlet) AS value_ros
  FROM {prefix}lab GROUP BY {k}
),
{prefix}dpv AS (SELECT {k}, data_partner, sum(volume) AS dp_volume FROM {prefix}lab GROUP BY {k}, data_partner),
{prefix}shares AS (
  SELECT *, sum(dp_volume) OVER w AS total_dp_volume, dp_volume / sum(dp_volume) OVER w AS dp_volume_share,
         count(*) OVER w AS data_partner_count
  FROM {prefix}dpv WINDOW w AS (PARTITION BY {k})
),
{prefix}dom AS (
  SELECT {k}, data_partner_count, data_partner AS nda_data_partner_with_max_share, dp_volume_share AS nda_max_data_partner_share
  FROM {prefix}shares s
  WHERE s.dp_volume_share IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM {prefix}shares t
    WHERE {eq('t', 's')} AND t.data_partner <> s.data_partner AND {KEY.format('t')} >= {KEY.format('s')})
),
{prefix}joined AS (
  SELECT c.date, c.product, {c_out}, c.avg_price, c.volume_ros, c.value_ros, c.outlet_count,
         c.data_partner_count, d.nda_data_partner_with_max_share, d.nda_max_data_partner_share
  FROM {prefix}cube c JOIN {prefix}dom d USING ({k})
),
{prefix}published AS (
  SELECT date, product, {out}, avg_price, volume_ros, value_ros, outlet_count FROM {prefix}joined
  WHERE outlet_count >= {min_outlets} AND data_partner_count >= 3 AND floor(nda_max_data_partner_share * CAST(1e12 AS DOUBLE) + CAST(0.5 AS DOUBLE)) <= 500000000000
)"""


# ---- variant B ---------------------------------------------------------------
ROLLUPS = [("Any Device", ("widget", "gear", "gizmo", "anvil")), ("Any Fitting", ("ring", "bolt", "rod", "plate"))]
ITEM = "CASE " + " ".join(
    f"WHEN lower(p_name) LIKE '%{k}%' THEN '{label}'" for label, keys in ROLLUPS for k in keys
) + " ELSE p_name END"
SIZE = "CASE WHEN p_size <= 25 THEN '25ml' ELSE 'pint' END"
FORMAT = "CASE WHEN p_type = 'STANDARD' THEN 'Draught' WHEN p_type = 'PROMO' THEN 'Packaged' ELSE 'Other' END"
LABEL = ("CASE WHEN format IN ('Draught', 'Packaged') THEN format || ' ' || item || ' ' || size "
         "ELSE item || ' ' || size END")
REGION_EXPRS = {
    "region1": "CASE WHEN r_name IN ('EUROPE') THEN 'Europe' ELSE 'n' END",
    "region2": "CASE WHEN n_nationkey < 5 THEN 'Core Nations' ELSE 'n' END",
    "region3": "CASE WHEN n_name = 'NATION_1' THEN 'Nation 1' WHEN n_name = 'NATION_2' THEN 'Nation 2' ELSE 'n' END",
    "region4": f"CASE WHEN n_nationkey IN {ZONE_A} THEN 'Zone A' WHEN n_nationkey IN {ZONE_B} THEN 'Zone B' ELSE 'n' END",
}
MULTI_COLS = ["date", "period", "outlet", *REGIONS_B, "segment", "data_partner", "value", "quantity", "volume", "product"]


QUARTER = "CAST(date_trunc('quarter', CAST(l_shipdate AS DATE)) AS DATE)"


def _multi(src: str = "v", where: str = TAKEN) -> str:
    regs = ", ".join(f"{e} AS {k}" for k, e in REGION_EXPRS.items())
    return f"""
mview AS (SELECT *, {SIZE} AS size, {FORMAT} AS format FROM {src} WHERE {where}),
magg AS (
  SELECT {QUARTER} AS date, {PERIOD} AS period, CAST(o_custkey AS BIGINT) AS outlet, p_name, size, format, {regs},
         {SEGMENT} AS segment, {PARTNER} AS data_partner, {SUMS}
  FROM mview
  GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, c_mktsegment, n_nationkey
),
multi AS (
  SELECT date, period, outlet, region1, region2, region3, region4, segment, data_partner, value, quantity, volume,
         {LABEL} AS product
  FROM (SELECT *, {ITEM} AS item FROM magg)
)"""


MULTI_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in MULTI_COLS)
DIVISOR = ("CASE WHEN size = '25ml' AND format = 'Packaged' THEN 200.0 WHEN size = '25ml' THEN 25.0 "
           "WHEN format = 'Draught' THEN 568.0 WHEN format = 'Packaged' THEN 330.0 ELSE 500.0 END")
MRULES = f"""
mrules AS (
  SELECT DISTINCT {LABEL} AS product, CAST({DIVISOR} AS DOUBLE) AS divisor
  FROM (SELECT {ITEM} AS item, {SIZE} AS size, {FORMAT} AS format FROM part)
),
munit AS (
  SELECT m.* REPLACE (CASE WHEN r.product IS NULL THEN m.volume ELSE m.volume / r.divisor END AS volume)
  FROM (SELECT * FROM multi WHERE {MULTI_NOT_NULL}) m LEFT JOIN mrules r ON m.product = r.product
),""" + _sigma("munit", "mc1", "volume", "date, region1, region2, region3, region4, segment, product") + "," + _sigma(
    "mc1", "mclean", "value", "date, region1, region2, region3, region4, segment, product"
)

MBASE = "WITH " + VIEW + "," + _multi() + "," + MRULES


def _round_expr(c: str) -> str:
    def step(x, d):
        return f"(floor({x} * CAST({10**d} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({10**d} AS DOUBLE))"

    return step(step(c, 9), 6)


def rounded(sql: str, doubles: list[str]) -> str:
    if not doubles:
        return sql
    rep = ", ".join(f"{_round_expr(c)} AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS __r"


def _lists(src_sql_with: str, pub: str, cols: list[str]) -> str:
    parts = [
        f"l{i} AS (SELECT row_number() OVER (ORDER BY {c}) AS position, {c} "
        f"FROM (SELECT DISTINCT {c} FROM {pub} WHERE {c} IS NOT NULL))"
        for i, c in enumerate(cols)
    ]
    joins = " ".join(f"FULL OUTER JOIN l{i} USING (position)" for i in range(1, len(cols)))
    return f"{src_sql_with}, {', '.join(parts)} SELECT position, {', '.join(cols)} FROM l0 {joins}"


PRICES = "prices AS (SELECT *, value / quantity AS price FROM clean WHERE period IN (1995, 1999))"
CPRICE = "cprice AS (SELECT *, value / quantity AS price FROM clean)"
A_BANDS = BASE + ",\n" + PRICES + "," + _bands("", "prices", CUBE_A)
A_NODIM = BASE + ",\n" + PRICES + "," + _bands("n_", "prices", NODIM, labels=())
A_AVG = BASE + ",\n" + CPRICE + "," + _avg("a_", "cprice", CUBE_A)
MPRICES = "mprices AS (SELECT *, value / quantity AS price FROM mclean WHERE period IN (1995, 1999))"
MCPRICE = "mcprice AS (SELECT *, value / quantity AS price FROM mclean)"
B_BANDS = MBASE + ",\n" + MPRICES + "," + _bands("m_", "mprices", CUBE_B, LABELS_B)
B_AVG = MBASE + ",\n" + MCPRICE + "," + _avg("ma_", "mcprice", CUBE_B, LABELS_B)

ITEM_PRICES = """iprices AS (
  SELECT *, 'product' AS level, product AS item FROM prices WHERE product IN ('STANDARD', 'SMALL', 'Pints')
  UNION ALL
  SELECT * EXCLUDE (grp), 'product_group', grp FROM (
    SELECT *, CASE WHEN product IN ('STANDARD', 'PROMO', 'MEDIUM', 'LARGE') THEN 'Pints' ELSE 'Others' END AS grp FROM prices)
  WHERE grp IN ('STANDARD', 'SMALL', 'Pints')
)"""
ITEM_CARRY = "date, period, outlet, data_partner, price, level AS product_type, item AS product, volume, value"
A_ITEMS = BASE + ",\n" + PRICES + ",\n" + ITEM_PRICES + "," + _bands("i_", "iprices", CUBE_A, carry=ITEM_CARRY)

ROS = ["volume_ros", "value_ros"]
EDGE_COLS = [f"q{round(x * 100)}" for x in QS]
EDGE_WIDE = ", ".join(f"e[{i + 1}] AS {c}" for i, c in enumerate(EDGE_COLS))
EDGE_LONG = "\n  UNION ALL ".join(
    f"SELECT date, period, product_type, product, region, segment, CAST({x} AS DOUBLE) AS percentile, e[{i + 1}] AS edge FROM edges"
    for i, x in enumerate(QS)
)

SELECTION = """
names AS (SELECT DISTINCT p_name FROM part),
sel AS (
  SELECT p_name AS sel_product, 'pint' AS sel_size, 'Draught' AS sel_format FROM names
   WHERE string_split(p_name, ' ')[-1] IN ('widget', 'gear', 'ring')
  UNION ALL
  SELECT p_name, 'pint', 'Packaged' FROM names WHERE string_split(p_name, ' ')[-1] IN ('widget', 'gear', 'ring')
  UNION ALL
  SELECT upper(p_name), '25ml', NULL FROM names WHERE string_split(p_name, ' ')[-1] IN ('bolt', 'rod')
),
vsel AS (
  SELECT * FROM (SELECT *, %s AS size, %s AS format FROM v) m
  WHERE EXISTS (SELECT 1 FROM sel s WHERE lower(m.p_name) = lower(s.sel_product)
                AND (s.sel_size IS NULL OR lower(m.size) = lower(s.sel_size))
                AND (s.sel_format IS NULL OR lower(m.format) = lower(s.sel_format)))
)""" % (SIZE, FORMAT)

FILTERED = f"{TAKEN} AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND r_name = 'EUROPE'"
BAND_KEYS_OUT = "period, product_type, product, region, segment, percentile"

SQL: dict[str, str] = {
    "sales_extract": rounded(
        "WITH " + VIEW + f"""
SELECT {DATE} AS date, {PERIOD} AS period, CAST(quarter(l_shipdate) AS INTEGER) AS qtr,
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(o_custkey AS BIGINT) AS outlet, p_type AS product,
       r_name AS region, {SEGMENT} AS segment, {PARTNER} AS data_partner, {SUMS}
FROM v
WHERE {TAKEN}
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, c_mktsegment""",
        ["value", "quantity", "volume"],
    ),
    "sales_extract_multi": rounded("WITH " + VIEW + "," + _multi() + " SELECT * FROM multi", ["value", "quantity", "volume"]),
    "sales_extract_filtered": rounded(
        "WITH " + VIEW + "," + FACT.replace(TAKEN, FILTERED) + " SELECT * FROM fact", ["value", "quantity", "volume"]
    ),
    "sales_extract_multi_filtered": rounded(
        "WITH " + VIEW + "," + _multi(where=f"{TAKEN} AND c_mktsegment = 'BUILDING' AND r_name = 'EUROPE'") + " SELECT * FROM multi",
        ["value", "quantity", "volume"],
    ),
    "product_selection": rounded(
        BASE + " SELECT * FROM fact WHERE product IN ('STANDARD', 'PROMO', 'MEDIUM', 'LARGE', 'SMALL')",
        ["value", "quantity", "volume"],
    ),
    "product_selection_multi": rounded(
        "WITH " + VIEW + "," + SELECTION + ","
        + _multi("vsel").replace(f"SELECT *, {SIZE} AS size, {FORMAT} AS format FROM vsel", "SELECT * FROM vsel")
        + " SELECT * FROM multi",
        ["value", "quantity", "volume"],
    ),
    "region_dims": "SELECT c.c_custkey, " + ", ".join(f"{e} AS {k}" for k, e in REGION_EXPRS.items())
    + " FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey",
    "product_rollup": f"SELECT p_partkey, p_name, {ITEM} AS product FROM part",
    "product_label": f"SELECT p_partkey, {LABEL} AS product FROM (SELECT p_partkey, {ITEM} AS item, {SIZE} AS size, {FORMAT} AS format FROM part)",
    "snapshot_roundtrip": rounded(BASE + " SELECT * FROM fact", ["value", "quantity", "volume"]),
    "unit_volume": rounded(BASE + " SELECT * FROM unit", ["value", "quantity", "volume"]),
    "unit_volume_multi": rounded(
        "WITH " + VIEW + "," + _multi() + "," + MRULES.split("munit AS")[0] + """
twice AS (
  SELECT m.* REPLACE (CASE WHEN r.product IS NULL THEN m.volume
      WHEN m.product = 'Draught Any Device pint' THEN m.volume / r.divisor / CAST(25 AS DOUBLE)
      ELSE m.volume / r.divisor END AS volume)
  FROM multi m LEFT JOIN mrules r ON m.product = r.product
) SELECT * FROM twice""",
        ["value", "quantity", "volume"],
    ),
    "unit_price": rounded(BASE + " SELECT *, value / quantity AS price FROM fact", ["value", "quantity", "volume", "price"]),
    "remove_outliers": rounded(BASE + " SELECT * FROM clean", ["value", "quantity", "volume"]),
    "outlier_report": BASE + """,
ri AS (SELECT product, count(*) AS rows_in FROM nn GROUP BY product),
ro AS (SELECT product, count(*) AS rows_out FROM clean GROUP BY product)
SELECT ri.product, ri.rows_in, ri.rows_in - coalesce(ro.rows_out, 0) AS rows_removed FROM ri LEFT JOIN ro USING (product)""",
    "continuous_items": rounded(
        BASE + """,
k AS (SELECT period, outlet, product FROM fact GROUP BY period, outlet, product HAVING count(DISTINCT date) > 2)
SELECT f.* FROM fact f WHERE EXISTS (
  SELECT 1 FROM k WHERE k.period = f.period AND k.outlet = f.outlet AND k.product = f.product)""",
        ["value", "quantity", "volume"],
    ),
    "label_expand": rounded(A_BANDS + " SELECT * EXCLUDE (cell_id) FROM lab", ["price", "volume", "value"]),
    "price_quantile_cube": rounded(
        A_BANDS + f" SELECT date, period, product_type, product, region, segment, {EDGE_WIDE} FROM edges", EDGE_COLS
    ),
    "price_quantile_nodim": rounded(
        A_NODIM + f" SELECT date, period, product_type, product, {EDGE_WIDE} FROM n_edges", EDGE_COLS
    ),
    "band_edges": rounded(A_BANDS + " " + EDGE_LONG, ["edge"]),
    "band_assign": rounded(A_BANDS + " SELECT * EXCLUDE (cell_id) FROM banded", ["price", "volume", "value"]),
    "band_prices": rounded(A_BANDS + " SELECT * EXCLUDE (cell_id) FROM bprices", ["percentile_price"]),
    "outlet_count_cube": A_BANDS + " SELECT * EXCLUDE (cell_id) FROM totals",
    "weekly_ros": rounded(A_BANDS + " SELECT * EXCLUDE (cell_id) FROM weekly", ["sum_volume", "sum_value", *ROS]),
    "period_ros": rounded(A_BANDS + " SELECT * EXCLUDE (cell_id) FROM pros", ROS),
    "band_counts": A_BANDS + " SELECT * EXCLUDE (cell_id) FROM counts",
    "partner_share": rounded(
        A_BANDS + " SELECT * EXCLUDE (cell_id) FROM shares", ["dp_volume", "total_dp_volume", "dp_volume_share"]
    ),
    "partner_dominance": rounded(A_BANDS + " SELECT * EXCLUDE (cell_id) FROM dom", ["nda_max_data_partner_share"]),
    "band_prices_left": rounded(
        A_BANDS + " SELECT * FROM joined", ["percentile_price", *ROS, "nda_max_data_partner_share"]
    ),
    "price_bands": rounded(A_BANDS + " SELECT * FROM published", ["percentile_price", *ROS]),
    "outlet_totals": A_BANDS + " SELECT DISTINCT period, product, product_type, region, segment, total_outlet_count FROM published",
    "price_bands_items": rounded(A_ITEMS + " SELECT * FROM i_published", ["percentile_price", *ROS]),
    "price_bands_multi": rounded(B_BANDS + " SELECT * FROM m_published", ["percentile_price", *ROS]),
    "outlet_totals_multi": B_BANDS
    + " SELECT DISTINCT period, product, product_type, region_dim, region, segment, total_outlet_count FROM m_published",
    "avg_price_cube": rounded(
        A_AVG + " SELECT * EXCLUDE (cell_id) FROM a_cube", ["sum_volume", "sum_value", "avg_price", *ROS]
    ),
    "partner_share_daily": rounded(
        A_AVG + " SELECT * EXCLUDE (cell_id) FROM a_shares", ["dp_volume", "total_dp_volume", "dp_volume_share"]
    ),
    "suppression": rounded(
        A_AVG + """ SELECT *,
  coalesce(outlet_count >= 50, false) AS pass_outlets,
  coalesce(data_partner_count >= 3, false) AS pass_partners,
  coalesce(floor(nda_max_data_partner_share * CAST(1e12 AS DOUBLE) + CAST(0.5 AS DOUBLE)) <= 500000000000, false) AS pass_share,
  coalesce(outlet_count >= 50, false) AND coalesce(data_partner_count >= 3, false)
    AND coalesce(floor(nda_max_data_partner_share * CAST(1e12 AS DOUBLE) + CAST(0.5 AS DOUBLE)) <= 500000000000, false) AS publish
FROM a_joined""",
        ["avg_price", *ROS, "nda_max_data_partner_share"],
    ),
    "avg_price": rounded(A_AVG + " SELECT * FROM a_published", ["avg_price", *ROS]),
    "avg_price_multi": rounded(B_AVG + " SELECT * FROM ma_published", ["avg_price", *ROS]),
    "report_lists_prices": _lists(A_BANDS, "published", ["region", "segment", "product"]),
    "report_lists_avg": _lists(A_AVG, "a_published", ["region", "segment", "product", "date"]),
}
# the whole job writes these and the queries read them back
SQL |= {
    job: SQL[query]
    for job, query in {
        "job_prices": "price_bands", "job_outlet_totals": "outlet_totals", "job_lists": "report_lists_prices",
        "job_edges": "price_quantile_cube", "job_banded": "band_assign", "job_totals": "outlet_count_cube",
        "job_prices_multi": "price_bands_multi", "job_avg": "avg_price", "job_avg_lists": "report_lists_avg",
        "job_avg_multi": "avg_price_multi", "job_shared_prices": "price_bands", "job_shared_avg": "avg_price",
        "snapshot_incremental": "snapshot_roundtrip",
    }.items()
}


def _removed(base: str, complete: str, first: str, second: str) -> str:
    """Rows in and removed of the two sigma steps, volume first."""
    n = "(SELECT count(*) FROM {})".format
    return base + f"""
SELECT 1 AS step, 'volume' AS metric, {n(complete)} AS rows_in, {n(complete)} - {n(first)} AS rows_removed
UNION ALL SELECT 2, 'value', {n(first)}, {n(first)} - {n(second)}"""


SQL["job_shared_removed"] = _removed(BASE, "nn", "c1", "clean")
SQL["job_shared_removed_multi"] = _removed(MBASE, "munit", "mc1", "mclean")
