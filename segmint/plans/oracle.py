"""SQL twins of the registered queries (DuckDB dialect, over the test tables
registered as views). Written independently of the Spark code from the same
semantics, so agreement is evidence of both."""

from __future__ import annotations

from ..functions.stopwords import ENGLISH
from . import params as P

SQL_WS = "[ \\t\\n\\x0B\\f\\r]"


def _probs(n: int) -> str:
    return "[" + ", ".join(repr(j / n) for j in range(n + 1)) + "]"


def _bin(x: str, e: str, n: int) -> str:
    """Ordinal bin of x for the edge list e (DuckDB lists are 1-based)."""
    m = n + 1
    kept = {i: ("TRUE" if i == 1 else f"({e}[{i}] - {e}[{i - 1}] > 1e-8)") for i in range(1, m + 1)}
    terms = []
    for i in range(2, m):
        later = " OR ".join(kept[j] for j in range(i + 1, m + 1))
        terms.append(f"(CASE WHEN {kept[i]} AND ({later}) AND {x} >= {e}[{i}] THEN 1 ELSE 0 END)")
    body = " + ".join(terms) if terms else "0"
    return f"CAST(CASE WHEN {x} IS NULL THEN NULL ELSE {body} END AS INTEGER)"


def _uniform_edges(x: str, n: int) -> str:
    parts = [f"({j} * ((max({x}) - min({x})) / {n}) + min({x}))" for j in range(n)]
    return "[" + ", ".join(parts + [f"max({x})"]) + "]"


TYPES = """types AS (
  SELECT CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS ProductCategoryID,
         p_type AS ProductCategoryName
  FROM (SELECT DISTINCT p_type FROM part) t)"""


def _lines(with_type: bool) -> str:
    sign = "(CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END)"
    extra = ", t.ProductCategoryID, t.ProductCategoryName" if with_type else ""
    tjoin = "LEFT JOIN types t ON p.p_type = t.ProductCategoryName" if with_type else ""
    return f"""
  SELECT CAST(o.o_orderkey AS VARCHAR) AS InvoiceNo,
         CAST(l.l_partkey AS VARCHAR) AS StockCode,
         p.p_name AS Description,
         CAST(trunc(l.l_quantity) AS BIGINT) * {sign} AS Quantity,
         o.o_orderdate AS InvoiceDate,
         l.l_extendedprice / l.l_quantity AS UnitPrice,
         CAST(o.o_custkey AS VARCHAR) AS CustomerID,
         n.n_name AS Country,
         CAST(l.l_extendedprice * {sign} AS DECIMAL(18,2)) AS SalesAmount{extra}
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN (SELECT p_partkey, max(p_name) AS p_name, max(p_type) AS p_type FROM part GROUP BY p_partkey) p
    ON l.l_partkey = p.p_partkey
  {tjoin}
  LEFT JOIN (SELECT c.c_custkey, max(n.n_name) AS n_name FROM customer c
             LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY c.c_custkey) n
    ON o.o_custkey = n.c_custkey"""


KEYS = "CustomerID, ProductCategoryID, ProductCategoryName"

CHAIN = f"""{TYPES},
silver AS ({_lines(True)}),
daily AS (
  SELECT {KEYS}, CAST(InvoiceDate AS DATE) AS InvoiceDate,
         CAST(SUM(SalesAmount) AS DECIMAL(18,2)) AS DailySales
  FROM silver WHERE SalesAmount > 0
  GROUP BY {KEYS}, CAST(InvoiceDate AS DATE)),
per AS (
  SELECT {KEYS}, MAX(InvoiceDate) AS last_day, COUNT(*) AS Frequency, SUM(DailySales) AS total
  FROM daily GROUP BY {KEYS}),
metrics AS (
  SELECT {KEYS},
         CAST(date_diff('day', last_day, (SELECT MAX(last_day) FROM per)) AS INTEGER) AS Recency,
         Frequency,
         CAST(total AS DOUBLE) / Frequency AS MonetaryValue
  FROM per),
capped AS (
  SELECT {KEYS}, Recency,
         CASE WHEN Frequency > {P.FREQ_CAP} THEN {P.FREQ_CAP} ELSE Frequency END AS Frequency,
         CASE WHEN MonetaryValue > {P.MONETARY_CAP!r} THEN {P.MONETARY_CAP!r} ELSE MonetaryValue END AS MonetaryValue
  FROM metrics)"""


def _edges_cte(name: str, src: str, n: int, strategy: str = "quantile") -> str:
    cols = {"er": "CAST(-Recency AS DOUBLE)", "ef": "CAST(Frequency AS DOUBLE)", "em": "CAST(MonetaryValue AS DOUBLE)"}
    if strategy == "quantile":
        sel = ", ".join(f"quantile_cont({x}, {_probs(n)}) AS {k}" for k, x in cols.items())
    else:
        sel = ", ".join(f"{_uniform_edges(x, n)} AS {k}" for k, x in cols.items())
    return f"{name} AS (SELECT {sel} FROM {src})"


def _binned(name: str, src: str, edges: str, n: int) -> str:
    return f"""{name} AS (
  SELECT s.*, {_bin('CAST(-s.Recency AS DOUBLE)', 'g.er', n)} AS r_bin,
         {_bin('CAST(s.Frequency AS DOUBLE)', 'g.ef', n)} AS f_bin,
         {_bin('s.MonetaryValue', 'g.em', n)} AS m_bin
  FROM {src} s, {edges} g)"""


GOLD = f"""{CHAIN},
{_edges_cte('gold_edges', 'capped', P.N_BINS)},
{_binned('gold', 'capped', 'gold_edges', P.N_BINS)}"""

FAV = f"""{GOLD},
fav AS (
  SELECT CustomerID, ProductCategoryID AS FavoriteCategoryID, ProductCategoryName AS FavoriteCategoryName,
         Recency, Frequency, MonetaryValue, r_bin, f_bin, m_bin
  FROM (SELECT *, row_number() OVER (
          PARTITION BY CustomerID
          ORDER BY Frequency DESC NULLS LAST, MonetaryValue DESC NULLS LAST, Recency ASC NULLS FIRST,
                   ProductCategoryID ASC NULLS LAST, ProductCategoryName ASC NULLS LAST) AS rn
        FROM gold) r
  WHERE rn = 1)"""

_CENTS = ", ".join(f"({c}, {r!r}, {f!r}, {m!r})" for c, r, f, m in P.FIXED_CENTROIDS)
_NB = P.N_BINS

ASSIGNED = f"""{FAV},
{_edges_cte('model_edges', 'fav', _NB)},
cents AS (SELECT * FROM (VALUES {_CENTS}) v(cluster, r, f, m)),
grid AS (SELECT CAST(a.range AS INTEGER) AS r_bin, CAST(b.range AS INTEGER) AS f_bin, CAST(c.range AS INTEGER) AS m_bin
         FROM range({_NB}) a, range({_NB}) b, range({_NB}) c),
cellmap AS (
  SELECT r_bin, f_bin, m_bin, CAST(cluster AS INTEGER) AS cluster FROM (
    SELECT g.r_bin, g.f_bin, g.m_bin, k.cluster,
           row_number() OVER (PARTITION BY g.r_bin, g.f_bin, g.m_bin
                              ORDER BY (g.r_bin - k.r) * (g.r_bin - k.r) + (g.f_bin - k.f) * (g.f_bin - k.f)
                                       + (g.m_bin - k.m) * (g.m_bin - k.m), k.cluster) AS rn
    FROM grid g, cents k) x WHERE rn = 1),
fav_model AS (
  SELECT f.CustomerID, f.FavoriteCategoryID, f.FavoriteCategoryName, f.Recency, f.Frequency, f.MonetaryValue,
         {_bin('CAST(-f.Recency AS DOUBLE)', 'g.er', _NB)} AS r_bin,
         {_bin('CAST(f.Frequency AS DOUBLE)', 'g.ef', _NB)} AS f_bin,
         {_bin('f.MonetaryValue', 'g.em', _NB)} AS m_bin
  FROM fav f, model_edges g),
assigned AS (
  SELECT a.*, cm.cluster FROM fav_model a
  LEFT JOIN cellmap cm ON a.r_bin = cm.r_bin AND a.f_bin = cm.f_bin AND a.m_bin = cm.m_bin),
member_cents AS (
  SELECT cluster, AVG(CAST(r_bin AS DOUBLE)) AS r, AVG(CAST(f_bin AS DOUBLE)) AS f, AVG(CAST(m_bin AS DOUBLE)) AS m
  FROM assigned WHERE cluster IS NOT NULL GROUP BY cluster),
levels AS (
  SELECT cluster, CAST(abs(CAST(round_even(r, 0) AS INTEGER)) AS INTEGER) AS r_bin,
         CAST(abs(CAST(round_even(f, 0) AS INTEGER)) AS INTEGER) AS f_bin,
         CAST(abs(CAST(round_even(m, 0) AS INTEGER)) AS INTEGER) AS m_bin
  FROM member_cents),
labels AS (
  SELECT *, concat('Cluster ', CAST(cluster AS VARCHAR), ': r=', CAST(r_bin AS VARCHAR), ', f=',
                   CAST(f_bin AS VARCHAR), ', m=', CAST(m_bin AS VARCHAR)) AS label
  FROM levels),
orders_seg AS (
  SELECT s.*, a.cluster AS Cluster, a.Recency, a.Frequency, a.MonetaryValue
  FROM silver s LEFT JOIN assigned a ON s.CustomerID = a.CustomerID)"""

_STOP = ", ".join("('" + w.replace("'", "''") + "')" for w in ENGLISH)

TOKENS = f"""stop(token) AS (VALUES {_STOP}),
split_docs AS (SELECT doc_id, string_split_regex(lower(text), '{SQL_WS}') AS toks FROM documents),
raw_tokens AS (SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS token
               FROM split_docs),
tokens AS (SELECT doc_id, pos, token FROM raw_tokens
           WHERE token <> '' AND token NOT IN (SELECT token FROM stop))"""


def _murmur3(t: str) -> str:
    """MurmurHash3 (32 bits, seed 42) of a string's UTF-8 bytes in integer
    arithmetic; an unsigned number."""
    full, n = 1 << 32, f"strlen({t})"
    hexed = lambda *at: "CAST('0x' || " + " || ".join(f"substr(hex({t}), {a}, 2)" for a in at) + " AS UBIGINT)"
    times = lambda x, c: f"(({x}) * {c}::UBIGINT % {full})"
    turn = lambda x, r: f"((({x}) * {1 << r} % {full}) + (({x}) // {1 << 32 - r}))"
    word = lambda k: times(turn(times(k, 0xCC9E2D51), 15), 0x1B873593)
    block = hexed("8 * j + 7", "8 * j + 5", "8 * j + 3", "8 * j + 1")
    body = f"list_reduce(list_prepend(42::UBIGINT, list_transform(range({n} // 4), lambda j: {word(block)})), " \
           f"lambda h, k: ({turn('xor(h, k)', 13)} * 5 + {0xE6546B64}::UBIGINT) % {full})"
    last = f"(8 * ({n} // 4))"
    rest = f"CASE {n} % 4 WHEN 0 THEN 0::UBIGINT WHEN 1 THEN {word(hexed(last + ' + 1'))} " \
           f"WHEN 2 THEN {word(hexed(last + ' + 3', last + ' + 1'))} ELSE {word(hexed(last + ' + 5', last + ' + 3', last + ' + 1'))} END"
    out = f"xor(xor({body}, {rest}), {n}::UBIGINT)"
    for shift, c in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        out = f"list_transform([{out}], lambda x: xor(x, x // {1 << shift}))[1]"
        out = times(out, c) if c else out
    return out


def _axes(cells: str, sweeps: int = 8) -> str:
    """CTEs from weighted cells to ``axes`` (a1..a3, b1..b3): the two leading
    eigenvectors of the covariance, by Jacobi rotations."""
    c = ["r_bin", "f_bin", "m_bin"]
    pair = [(i, j) for i in range(3) for j in range(i, 3)]
    name = lambda i, j: f"s{min(i, j)}{max(i, j)}"
    moment = ", ".join(f"(SUM(w) * 1.0 * SUM(w * {c[i]} * {c[j]}) - SUM(w * {c[i]}) * 1.0 * SUM(w * {c[j]})) / (SUM(w) * 1.0 * SUM(w)) "
                       f"AS {name(i, j)}" for i, j in pair)
    unit = ", ".join(f"{float(i == j)}::DOUBLE AS v{i}{j}" for i in range(3) for j in range(3))
    out = [f"jac0 AS (SELECT {', '.join(f'{name(i, j)}::DOUBLE AS {name(i, j)}' for i, j in pair)}, {unit} FROM (SELECT {moment} FROM {cells}) x)"]
    for step in range(3 * sweeps):
        p, q = ((0, 1), (0, 2), (1, 2))[step % 3]
        r = 3 - p - q
        theta = f"(({name(q, q)} - {name(p, p)}) / (2 * {name(p, q)}))"
        turn = f"CASE WHEN abs({name(p, q)}) < 1e-300 THEN 0.0 ELSE (CASE WHEN {theta} >= 0 THEN 1.0 ELSE -1.0 END) " \
               f"/ (abs({theta}) + sqrt({theta} * {theta} + 1)) END"
        new = {name(p, p): f"{name(p, p)} - t * {name(p, q)}", name(q, q): f"{name(q, q)} + t * {name(p, q)}", name(p, q): "0.0::DOUBLE",
               name(r, r): name(r, r), name(p, r): f"co * {name(p, r)} - co * t * {name(q, r)}",
               name(q, r): f"co * t * {name(p, r)} + co * {name(q, r)}"}
        for i in range(3):
            new |= {f"v{i}{p}": f"co * v{i}{p} - co * t * v{i}{q}", f"v{i}{q}": f"co * t * v{i}{p} + co * v{i}{q}", f"v{i}{r}": f"v{i}{r}"}
        cols = ", ".join(f"{e} AS {k}" for k, e in new.items())
        out.append(f"jac{step + 1} AS (SELECT {cols} FROM (SELECT *, 1 / sqrt(t * t + 1) AS co FROM (SELECT *, {turn} AS t FROM jac{step}) a) b)")
    last = f"jac{3 * sweeps}"
    out.append("eig AS (" + " UNION ALL ".join(f"SELECT {name(k, k)} AS val, v0{k} AS x, v1{k} AS y, v2{k} AS z FROM {last}" for k in range(3)) + ")")
    big = "greatest(abs(round(x, 9)), abs(round(y, 9)), abs(round(z, 9)))"
    sign = f"CASE WHEN abs(round(x, 9)) = {big} THEN sign(x) WHEN abs(round(y, 9)) = {big} THEN sign(y) ELSE sign(z) END"
    out.append(f"ranked AS (SELECT x * {sign} AS x, y * {sign} AS y, z * {sign} AS z, row_number() OVER (ORDER BY val DESC) AS k FROM eig)")
    out.append("axes AS (SELECT " + ", ".join(f"max(CASE WHEN k = {k} THEN {e} END) AS {n}{i}" for n, k in (("a", 1), ("b", 2))
                                              for i, e in enumerate("xyz", 1)) + " FROM ranked)")
    return ", ".join(out)


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def oracle() -> dict[str, str]:
    nb = P.N_BINS
    names = ", ".join(f"({k}, '{v}')" for k, v in sorted(P.FIXED_SEGMENT_NAMES.items()))
    q: dict[str, str] = {}
    q["bronze_orders"] = f"SELECT * FROM ({_lines(False)}) b"
    q["category_labels"] = _q(TYPES, "SELECT * FROM types")
    q["silver_typed"] = _q(f"{TYPES}, silver AS ({_lines(True)})", "SELECT * FROM silver")
    q["silver_roundtrip"] = q["silver_typed"]
    q["distinct_descriptions"] = (f"SELECT DISTINCT Description FROM ({_lines(False)}) b "
                                  "WHERE Description IS NOT NULL")
    q["daily_sales"] = _q(CHAIN, "SELECT * FROM daily")
    q["snapshot_date"] = _q(CHAIN, "SELECT MAX(CAST(InvoiceDate AS DATE)) AS GlobalLastDate FROM silver "
                                   "WHERE SalesAmount > 0")
    q["rfmp_metrics"] = _q(CHAIN, "SELECT * FROM metrics")
    q["rfmp_capped"] = _q(CHAIN, "SELECT * FROM capped")
    hist = []
    for col in ("Recency", "Frequency", "MonetaryValue"):
        x = f"CAST({col} AS DOUBLE)"
        hist.append(f"""SELECT '{col}' AS metric, bin, lo + bin * w AS lo,
              CASE WHEN bin = {P.HIST_BINS - 1} THEN hi ELSE lo + (bin + 1) * w END AS hi, COUNT(*) AS n
            FROM (SELECT CASE WHEN mm.hi > mm.lo THEN CAST(least(floor(({x} - mm.lo) / (mm.hi - mm.lo) * {P.HIST_BINS}),
                                {P.HIST_BINS - 1}) AS INTEGER) ELSE 0 END AS bin,
                         mm.lo, mm.hi, CASE WHEN mm.hi > mm.lo THEN (mm.hi - mm.lo) / {P.HIST_BINS} ELSE 0.0 END AS w
                  FROM capped, (SELECT MIN({x}) AS lo, MAX({x}) AS hi FROM capped) mm
                  WHERE {col} IS NOT NULL) t
            GROUP BY bin, lo, hi, w""")
    q["metric_histogram"] = _q(CHAIN, " UNION ALL ".join(hist))
    q["bin_edges"] = _q(f"{CHAIN}, {_edges_cte('e', 'capped', nb)}", f"""
      SELECT metric, CAST(i - 1 AS INTEGER) AS i, edge,
             (i = 1 OR edge - prev > 1e-8) AS kept
      FROM (SELECT metric, i, edge, lag(edge) OVER (PARTITION BY metric ORDER BY i) AS prev
            FROM (SELECT 'r_bin' AS metric, generate_subscripts(er, 1) AS i, unnest(er) AS edge FROM e
                  UNION ALL SELECT 'f_bin', generate_subscripts(ef, 1), unnest(ef) FROM e
                  UNION ALL SELECT 'm_bin', generate_subscripts(em, 1), unnest(em) FROM e) u) v""")
    q["rfmp_bins"] = _q(GOLD, f"SELECT {KEYS}, r_bin, f_bin, m_bin FROM gold")
    q["rfmp_gold"] = _q(GOLD, "SELECT * FROM gold")
    q["rfmp_bins_uniform"] = _q(f"{CHAIN}, {_edges_cte('ue', 'capped', nb, 'uniform')}, "
                                f"{_binned('ub', 'capped', 'ue', nb)}", "SELECT * FROM ub")
    q["rfmp_bins_10"] = _q(f"{CHAIN}, {_edges_cte('te', 'capped', 10)}, {_binned('tb', 'capped', 'te', 10)}",
                           "SELECT * FROM tb")
    bh = []
    for col in ("r_bin", "f_bin", "m_bin"):
        x = f"CAST({col} AS DOUBLE)"
        bh.append(f"""SELECT '{col}' AS metric, bin, lo + bin * w AS lo,
              CASE WHEN bin = {nb - 1} THEN hi ELSE lo + (bin + 1) * w END AS hi, COUNT(*) AS n
            FROM (SELECT CASE WHEN mm.hi > mm.lo THEN CAST(least(floor(({x} - mm.lo) / (mm.hi - mm.lo) * {nb}),
                                {nb - 1}) AS INTEGER) ELSE 0 END AS bin,
                         mm.lo, mm.hi, CASE WHEN mm.hi > mm.lo THEN (mm.hi - mm.lo) / {nb} ELSE 0.0 END AS w
                  FROM gold, (SELECT MIN({x}) AS lo, MAX({x}) AS hi FROM gold) mm WHERE {col} IS NOT NULL) t
            GROUP BY bin, lo, hi, w""")
    q["bin_histogram"] = _q(GOLD, " UNION ALL ".join(bh))
    q["level_counts"] = _q(GOLD, """
      SELECT metric, levels, rows FROM (
        SELECT COUNT(*) AS rows, COUNT(DISTINCT r_bin) AS lr, COUNT(DISTINCT f_bin) AS lf,
               COUNT(DISTINCT m_bin) AS lm FROM gold) a,
      LATERAL (VALUES ('r_bin', a.lr), ('f_bin', a.lf), ('m_bin', a.lm)) v(metric, levels)""")
    q["customer_lookup"] = _q(GOLD, f"SELECT * FROM gold WHERE CustomerID = '{P.LOOKUP_CUSTOMER}'")
    q["category_rank"] = _q(GOLD, f"""
      SELECT {KEYS}, Frequency, CAST(row_number() OVER (
          PARTITION BY CustomerID
          ORDER BY Frequency DESC NULLS LAST, MonetaryValue DESC NULLS LAST, Recency ASC NULLS FIRST,
                   ProductCategoryID ASC NULLS LAST, ProductCategoryName ASC NULLS LAST) AS INTEGER) AS rn
      FROM gold""")
    q["favorite_category"] = _q(FAV, "SELECT * FROM fav")
    q["gold_preview"] = _q(GOLD, f"""SELECT * FROM gold
      ORDER BY CustomerID ASC NULLS FIRST, ProductCategoryID ASC NULLS FIRST, ProductCategoryName ASC NULLS FIRST
      LIMIT {P.PREVIEW_ROWS}""")
    q["category_samples"] = _q(f"{TYPES}, silver AS ({_lines(True)})", f"""
      SELECT ProductCategoryID, Description, CAST(sample_rank AS INTEGER) AS sample_rank FROM (
        SELECT ProductCategoryID, Description,
               row_number() OVER (PARTITION BY ProductCategoryID ORDER BY Description DESC NULLS LAST) AS sample_rank
        FROM (SELECT DISTINCT ProductCategoryID, Description FROM silver WHERE Description IS NOT NULL) d) r
      WHERE sample_rank <= {P.SAMPLES_PER_CATEGORY}""")
    q["segment_assign"] = _q(ASSIGNED, "SELECT CustomerID, r_bin, f_bin, m_bin, cluster FROM assigned")
    q["centroid_levels"] = _q(ASSIGNED, "SELECT * FROM levels")
    q["segment_labels"] = _q(ASSIGNED, """SELECT l.* FROM labels l
      WHERE l.cluster IN (SELECT cluster FROM assigned WHERE cluster IS NOT NULL)""")
    q["score_gold"] = _q(ASSIGNED, f"""
      SELECT g.*, cm.cluster AS Cluster FROM gold g, model_edges me
      LEFT JOIN cellmap cm
        ON cm.r_bin = {_bin('CAST(-g.Recency AS DOUBLE)', 'me.er', nb)}
       AND cm.f_bin = {_bin('CAST(g.Frequency AS DOUBLE)', 'me.ef', nb)}
       AND cm.m_bin = {_bin('g.MonetaryValue', 'me.em', nb)}""")
    q["orders_with_segment"] = _q(ASSIGNED, "SELECT * FROM orders_seg")
    q["map_labels"] = _q(f"{ASSIGNED}, names AS (SELECT * FROM (VALUES {names}) v(cluster, name))", """
      SELECT a.CustomerID, a.cluster AS Cluster, n.name AS ClusterNames
      FROM assigned a LEFT JOIN names n ON a.cluster = n.cluster""")
    q["silhouette_fixed"] = _q(f"""{ASSIGNED},
      cells AS (SELECT r_bin, f_bin, m_bin, COUNT(*) AS w FROM assigned WHERE r_bin IS NOT NULL
                GROUP BY r_bin, f_bin, m_bin),
      lab AS (SELECT c.*, cm.cluster FROM cells c JOIN cellmap cm USING (r_bin, f_bin, m_bin)),
      csize AS (SELECT cluster, SUM(w) AS W FROM lab GROUP BY cluster),
      pair AS (SELECT i.r_bin, i.f_bin, i.m_bin, i.w, i.cluster AS ci, j.cluster AS cj,
                      SUM(j.w * sqrt((i.r_bin - j.r_bin) ^ 2 + (i.f_bin - j.f_bin) ^ 2 + (i.m_bin - j.m_bin) ^ 2)) AS s
               FROM lab i, lab j GROUP BY ALL),
      ab AS (SELECT p.r_bin, p.f_bin, p.m_bin, p.w, p.ci, cs.W AS Wown,
                    MAX(CASE WHEN p.cj = p.ci THEN p.s END) AS sown,
                    MIN(CASE WHEN p.cj <> p.ci THEN p.s / c2.W END) AS b
             FROM pair p JOIN csize c2 ON p.cj = c2.cluster JOIN csize cs ON p.ci = cs.cluster GROUP BY ALL),
      sil AS (SELECT w, CASE WHEN Wown <= 1 THEN 0.0
                             ELSE (b - sown / (Wown - 1)) / greatest(sown / (Wown - 1), b) END AS s FROM ab)""",
                                  """SELECT round(SUM(w * coalesce(s, 0.0)) / SUM(w), 9) AS silhouette,
              CAST(SUM(w) AS BIGINT) AS customers, CAST(COUNT(*) AS INTEGER) AS cells FROM sil""")
    q["segment_profile"] = _q(f"""{ASSIGNED},
      prof AS (
        SELECT cluster, COUNT(*) AS customers,
               round(AVG(CAST(Recency AS DOUBLE)), 6) AS avg_recency,
               round(AVG(CAST(Frequency AS DOUBLE)), 6) AS avg_frequency,
               round(AVG(MonetaryValue), 6) AS avg_monetary,
               round(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS customer_share
        FROM assigned GROUP BY cluster),
      rev AS (
        SELECT Cluster AS cluster, CAST(SUM(SalesAmount) AS DECIMAL(38,2)) AS revenue
        FROM orders_seg WHERE SalesAmount > 0 AND Cluster IS NOT NULL GROUP BY Cluster)""", """
      SELECT p.*, r.revenue,
             round(CAST(r.revenue AS DOUBLE) / CAST(SUM(r.revenue) OVER () AS DOUBLE), 6) AS revenue_share
      FROM prof p LEFT JOIN rev r USING (cluster)""")
    q["segment_top_categories"] = _q(ASSIGNED, f"""
      SELECT * FROM (
        SELECT Cluster, ProductCategoryID, ProductCategoryName, Sales,
               CAST(row_number() OVER (PARTITION BY Cluster ORDER BY Sales DESC, ProductCategoryID ASC NULLS LAST,
                                       ProductCategoryName ASC NULLS LAST) AS INTEGER) AS category_rank
        FROM (SELECT Cluster, ProductCategoryID, ProductCategoryName, SUM(SalesAmount) AS Sales
              FROM orders_seg WHERE SalesAmount > 0 AND Cluster IS NOT NULL
              GROUP BY Cluster, ProductCategoryID, ProductCategoryName) g) r
      WHERE category_rank <= {P.TOP_CATEGORIES}""")
    q["segment_bin_counts"] = _q(ASSIGNED, """
      SELECT cluster, metric, level, COUNT(*) AS n FROM (
        SELECT cluster, 'r_bin' AS metric, r_bin AS level FROM assigned
        UNION ALL SELECT cluster, 'f_bin', f_bin FROM assigned
        UNION ALL SELECT cluster, 'm_bin', m_bin FROM assigned) s
      GROUP BY cluster, metric, level""")
    q["audience_export"] = _q(ASSIGNED, """
      SELECT a.cluster, a.CustomerID, a.FavoriteCategoryID, a.FavoriteCategoryName, l.label
      FROM assigned a LEFT JOIN labels l ON a.cluster = l.cluster""")
    q["k_candidates"] = _q(f"{FAV}, cells AS (SELECT DISTINCT r_bin, f_bin, m_bin FROM fav WHERE r_bin IS NOT NULL)",
                           f"SELECT range AS k, range <= (SELECT COUNT(*) FROM cells) AS possible FROM range(2, {P.MAX_K} + 1)")
    q["customer_sample"] = _q(FAV, f"""SELECT * FROM fav
      WHERE CAST('0x' || substr(md5(concat('{P.SEED}:', CustomerID)), 1, 6) AS BIGINT) % 10000 < {round(P.SAMPLE_FRACTION * 10000)}
        AND CustomerID IS NOT NULL""")
    # The elbow rule on the within-cell sums of squares of one-dimensional
    # groupings: a sweep that SQL can make (see the catalog's k_choice_levels).
    q["k_choice_levels"] = _q(f"""{FAV},
      cells AS (SELECT r_bin + f_bin + m_bin AS total, COUNT(*) AS w FROM fav WHERE r_bin IS NOT NULL GROUP BY 1),
      ks AS (SELECT range AS k FROM range(2, 13)),
      grp AS (SELECT k, least(CAST(floor(total * k / 13.0) AS BIGINT), k - 1) AS g, SUM(w) AS w, SUM(w * total) AS t,
                     SUM(w * total * total) AS t2 FROM cells, ks GROUP BY 1, 2),
      sweep AS (SELECT k, round(SUM(t2 - t * t * 1.0 / w), 6) AS inertia FROM grp GROUP BY k),
      tot AS (SELECT SUM(w * total * total) - SUM(w * total) * SUM(w * total) * 1.0 / SUM(w) AS all_ss FROM cells),
      s AS (SELECT k, inertia, round(1 - inertia / all_ss, 6) AS silhouette FROM sweep, tot),
      g AS (SELECT *, round(lead(silhouette) OVER (ORDER BY k) - silhouette, 6) AS gain FROM s)""", """
      SELECT k, inertia, silhouette, gain,
             coalesce(gain < 0.01 AND k = (SELECT MIN(k) FROM g WHERE gain < 0.01), FALSE) AS chosen FROM g""")
    q["silver_structured"] = _q(f"""{TYPES}, bronze AS ({_lines(False)}),
      cats AS (SELECT max(p_name) AS d, min(t.ProductCategoryID) AS id FROM part p JOIN types t ON p.p_type = t.ProductCategoryName
               GROUP BY p_name)""", """
      SELECT c.id AS ProductCategoryID, b.*, t.ProductCategoryName
      FROM bronze b LEFT JOIN cats c ON b.Description = c.d LEFT JOIN types t ON c.id = t.ProductCategoryID""")
    q["silver_catalog"] = q["silver_typed"]
    q["tokens_raw"] = f"""SELECT doc_id, list_transform(string_split_regex(lower(text), '{SQL_WS}'), lambda t: t) AS words
      FROM documents"""
    q["stream_daily_all"] = """
      SELECT CAST(user_id AS VARCHAR) AS CustomerID, event_type AS ProductCategoryName,
             CAST(ts AS DATE) AS InvoiceDate, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DailySales
      FROM events WHERE value > 0 GROUP BY ALL"""
    q["tokens"] = _q(TOKENS, "SELECT * FROM tokens")
    q["term_frequency"] = _q(TOKENS, "SELECT doc_id, token, COUNT(*) AS tf FROM tokens GROUP BY doc_id, token")
    q["tfidf_terms"] = _q(f"""{TOKENS},
      tf AS (SELECT doc_id, token, COUNT(*) AS tf FROM tokens GROUP BY doc_id, token),
      dfreq AS (SELECT token, COUNT(DISTINCT doc_id) AS df FROM tokens GROUP BY token),
      nd AS (SELECT COUNT(*) AS n FROM documents)""", """
      SELECT tf.doc_id, tf.token, tf.tf, d.df,
             round(CASE WHEN d.df >= 2 THEN ln((nd.n + 1.0) / (d.df + 1.0)) ELSE 0.0 END, 9) AS idf,
             round(tf.tf * CASE WHEN d.df >= 2 THEN ln((nd.n + 1.0) / (d.df + 1.0)) ELSE 0.0 END, 9) AS tfidf
      FROM tf JOIN dfreq d USING (token), nd""")
    q["category_terms"] = _q(f"""{TYPES}, silver AS ({_lines(True)}),
      d AS (SELECT DISTINCT ProductCategoryID, Description FROM silver WHERE Description IS NOT NULL),
      docs AS (SELECT DISTINCT Description FROM d),
      stop(token) AS (VALUES {_STOP}),
      raw AS (SELECT Description, unnest(string_split_regex(lower(Description), '{SQL_WS}')) AS token FROM docs),
      tok AS (SELECT * FROM raw WHERE token <> '' AND token NOT IN (SELECT token FROM stop)),
      tf AS (SELECT Description, token, COUNT(*) AS tf FROM tok GROUP BY ALL),
      dfreq AS (SELECT token, COUNT(DISTINCT Description) AS df FROM tok GROUP BY token),
      nd AS (SELECT COUNT(*) AS n FROM docs),
      tfidf AS (SELECT tf.Description, tf.token,
                       round(tf.tf * CASE WHEN d.df >= 2 THEN ln((nd.n + 1.0) / (d.df + 1.0)) ELSE 0.0 END, 9) AS tfidf
                FROM tf JOIN dfreq d USING (token), nd),
      w AS (SELECT d.ProductCategoryID, t.token, round(SUM(t.tfidf), 6) AS weight
            FROM tfidf t JOIN d USING (Description) GROUP BY ALL)""", f"""
      SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ProductCategoryID ORDER BY weight DESC, token)
                                    AS INTEGER) AS term_rank FROM w) r
      WHERE term_rank <= {P.TOP_CATEGORIES}""")
    q["stream_daily_sales"] = """
      WITH pos AS (SELECT * FROM events WHERE value > 0),
      wm AS (SELECT MAX(ts) - INTERVAL 2 DAY AS wm FROM pos)
      SELECT CAST(user_id AS VARCHAR) AS CustomerID, event_type AS ProductCategoryName,
             CAST(ts AS DATE) AS InvoiceDate, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DailySales
      FROM pos, wm
      WHERE CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= wm.wm
      GROUP BY ALL"""
    q["segment_projection"] = _q(f"""{ASSIGNED},
      cells AS (SELECT r_bin, f_bin, m_bin, COUNT(*) AS w FROM assigned WHERE r_bin IS NOT NULL AND f_bin IS NOT NULL
                AND m_bin IS NOT NULL GROUP BY ALL), {_axes('cells')}""", """
      SELECT CustomerID, round(r_bin * a1 + f_bin * a2 + m_bin * a3, 6) + 0.0 AS x,
             round(r_bin * b1 + f_bin * b2 + m_bin * b3, 6) + 0.0 AS y FROM assigned, axes""")
    q["stream_late_rows"] = f"""
      WITH pos AS (SELECT *, event_id % {P.ARRIVALS} AS batch, epoch_us(ts) AS us FROM events WHERE value > 0),
      m AS (SELECT b.range AS batch, (SELECT MAX(us) FROM pos WHERE pos.batch < b.range) - 2 * 86400000000 AS mark
            FROM range(1, {P.ARRIVALS}) b)
      SELECT pos.batch, CAST(user_id AS VARCHAR) AS CustomerID, event_type AS ProductCategoryName,
             CAST(value AS DECIMAL(18,2)) AS SalesAmount, us AS event_us, (mark - us) / 1e6 AS delay_seconds
      FROM pos JOIN m USING (batch) WHERE (us // 86400000000 + 1) * 86400000000 <= mark"""
    q["stream_score_production"] = _q(ASSIGNED, """
      SELECT CustomerID, r_bin, f_bin, m_bin, CAST(cluster + 10 * (CAST(CustomerID AS BIGINT) % 2) AS INTEGER) AS cluster,
             CAST(CAST(CustomerID AS BIGINT) % 2 + 1 AS INTEGER) AS model_version, CAST(CustomerID AS BIGINT) % 2 AS batch
      FROM assigned WHERE CustomerID IS NOT NULL""")
    q["order_reject_counts"] = """
      WITH l AS (SELECT o_orderkey % 101 AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
      SELECT CASE k WHEN 3 THEN 'bad Quantity' WHEN 5 THEN 'bad InvoiceDate' WHEN 8 THEN 'missing UnitPrice' ELSE 'read' END AS reason,
             COUNT(*) AS lines FROM l GROUP BY 1"""
    q["hashed_tf"] = _q(f"""{TOKENS},
      tf AS (SELECT doc_id, token, COUNT(*) AS tf FROM tokens GROUP BY doc_id, token),
      terms AS (SELECT DISTINCT token FROM tf),
      bucket AS (SELECT token, CAST({_murmur3('token')} % {P.NUM_FEATURES} AS INTEGER) AS bucket FROM terms)""", """
      SELECT doc_id, bucket, CAST(SUM(tf) AS BIGINT) AS tf FROM tf JOIN bucket USING (token) GROUP BY doc_id, bucket""")
    width = len(P.STORED_CENTRES[0])
    cells = ", ".join(f"({c}, {b}, {v})" for c, row in enumerate(P.STORED_CENTRES) for b, v in enumerate(row))
    q["category_assign"] = _q(f"""d AS (SELECT DISTINCT Description FROM ({_lines(False)}) b WHERE Description IS NOT NULL),
      stop(token) AS (VALUES {_STOP}),
      raw AS (SELECT Description, unnest(string_split_regex(lower(Description), '{SQL_WS}')) AS token FROM d),
      tok AS (SELECT * FROM raw WHERE token <> '' AND token NOT IN (SELECT token FROM stop)),
      terms AS (SELECT DISTINCT token FROM tok),
      bucket AS (SELECT token, {_murmur3('token')} % {width} AS b FROM terms),
      tf AS (SELECT Description, b, COUNT(*) AS tf FROM tok JOIN bucket USING (token) GROUP BY ALL),
      centre(c, b, v) AS (VALUES {cells}),
      far AS (SELECT d.Description, k.c, SUM((coalesce(tf.tf, 0) - k.v) * (coalesce(tf.tf, 0) - k.v)) AS s
              FROM d CROSS JOIN centre k LEFT JOIN tf ON tf.Description = d.Description AND tf.b = k.b GROUP BY ALL)""", """
      SELECT Description, CAST(c AS INTEGER) AS ProductCategoryID
      FROM (SELECT *, row_number() OVER (PARTITION BY Description ORDER BY s, c) AS rn FROM far) x WHERE rn = 1""")
    q["stream_score"] = q["segment_assign"]
    q["latest_model"] = q["segment_assign"]
    return q
