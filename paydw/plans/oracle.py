"""DuckDB SQL that states each registered query independently (correctness gate).

The views ``customer``, ``orders``, ``events`` are the driver tables. The
common table expressions rebuild the star schema with plain SQL, so every Spark job is
checked against a formulation it does not share code with; contract
resolution is stated by its definition (no contract of the client expires
later), not by the per-client maximum the Spark job uses.
"""

from __future__ import annotations

# A DOUBLE as the decimal that it is written as, and an exact decimal as the nearest
# DOUBLE: both go by way of text, as a direct cast scales by 10^10 in floating point.
def _c(x: str, width: int = 36) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL({width},10))"


def _f(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def _ms(x: str) -> str:
    return _f(f"SUM({_c(x)})")


def _rev(rate: str, value: str) -> str:
    return _c(f"{rate} * {value}")


TYPES = ("payin", "payout", "boleto")

BASE = f"""
cli AS (
  SELECT CAST(c_custkey AS BIGINT) AS id_cliente, c_name AS razao_social,
         CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS data_inicio_relacionamento,
         'ativo' AS status, CAST(NULL AS DATE) AS data_fim_relacionamento, c_mktsegment AS segmento
  FROM customer),
con AS (
  SELECT CAST(c_custkey * 10 + k AS BIGINT) AS id_contrato, CAST(c_custkey AS BIGINT) AS id_cliente,
         CAST((c_custkey % 4 + 1) / 2.0 AS DOUBLE) AS taxa_payout,
         CAST((c_custkey % 3 + 1) / 4.0 AS DOUBLE) AS taxa_payin,
         CAST((c_custkey % 5 + 1) / 2.0 AS DOUBLE) AS taxa_boleto,
         CAST(DATE '1997-01-01' + CAST((c_custkey * 37) % 1000 + k * 800 AS INTEGER) AS DATE)
           AS data_vencimento_contrato
  FROM customer CROSS JOIN (VALUES (1), (2)) AS ks(k)
  WHERE NOT (k = 2 AND c_custkey % 7 = 0)),
tx AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id_transacao, CAST(o_custkey AS BIGINT) AS id_cliente,
         CASE o_orderstatus WHEN 'F' THEN 'payin' WHEN 'O' THEN 'payout' ELSE 'boleto' END AS tipo_transacao,
         CAST(o_totalprice AS DOUBLE) AS valor_transacao,
         CAST(o_orderdate AS DATE) AS data_movimentacao,
         o_orderdate AS hora_movimentacao
  FROM orders),
fact AS (
  -- the rule stated literally: a contract of the client, valid on the day, at the
  -- latest expiry among the client's contracts (ties keep every tied contract)
  SELECT t.id_transacao, t.id_cliente, c.id_contrato, t.tipo_transacao, t.valor_transacao,
         t.data_movimentacao, t.hora_movimentacao
  FROM tx t JOIN con c ON c.id_cliente = t.id_cliente AND t.data_movimentacao <= c.data_vencimento_contrato
  WHERE NOT EXISTS (SELECT 1 FROM con later
                    WHERE later.id_cliente = t.id_cliente
                      AND later.data_vencimento_contrato > c.data_vencimento_contrato)),
fd AS (
  SELECT id_cliente, data_movimentacao, id_contrato,
         CAST(COUNT(id_cliente) AS INTEGER) AS quantidade_movimentacoes,
         {", ".join(f"CAST(SUM(CASE WHEN tipo_transacao = '{t}' THEN 1 ELSE 0 END) AS INTEGER) AS quantidade_{t}" for t in TYPES)},
         {_ms("valor_transacao")} AS total_movimentacao,
         {", ".join(f"{_f(f"SUM(CASE WHEN tipo_transacao = '{t}' THEN {_c('valor_transacao')} ELSE 0 END)")} AS total_{t}" for t in TYPES)}
  FROM fact GROUP BY id_cliente, data_movimentacao, id_contrato),
tempo AS (
  SELECT CAST(d AS DATE) AS data, CAST(year(d) AS INTEGER) AS ano, CAST(month(d) AS INTEGER) AS mes,
         CAST(day(d) AS INTEGER) AS dia, CAST(isodow(d) AS INTEGER) AS dia_da_semana,
         CAST(dayofyear(d) AS INTEGER) AS dia_do_ano, CAST(quarter(d) AS INTEGER) AS trimestre
  FROM (SELECT unnest(generate_series((SELECT MIN(data_movimentacao) FROM tx),
                                      (SELECT MAX(data_movimentacao) FROM tx), INTERVAL 1 DAY)) AS d)),
seg_all AS (
  SELECT cli.segmento, fd.data_movimentacao,
         CAST(SUM(fd.quantidade_movimentacoes) AS BIGINT) AS quantidade_movimentacoes,
         {_ms("fd.total_movimentacao")} AS total_movimentacao,
         {_f("SUM(" + " + ".join(_rev(f"con.taxa_{t}", f"fd.total_{t}") for t in ("boleto", "payin", "payout")) + ")")} AS faturamento
  FROM fd JOIN cli ON cli.id_cliente = fd.id_cliente JOIN con ON con.id_contrato = fd.id_contrato
  GROUP BY cli.segmento, fd.data_movimentacao),
seg_dense AS (
  SELECT g.segmento, g.data_movimentacao,
         COALESCE(s.quantidade_movimentacoes, 0) AS quantidade_movimentacoes,
         COALESCE(s.total_movimentacao, 0.0) AS total_movimentacao,
         COALESCE(s.faturamento, 0.0) AS faturamento
  FROM (SELECT segmento, CAST(d AS DATE) AS data_movimentacao
        FROM (SELECT DISTINCT segmento FROM seg_all) k
        CROSS JOIN (SELECT unnest(generate_series((SELECT MIN(data_movimentacao) FROM seg_all),
                                                  (SELECT MAX(data_movimentacao) FROM seg_all),
                                                  INTERVAL 1 DAY)) AS d) days) g
  LEFT JOIN seg_all s ON s.segmento = g.segmento AND s.data_movimentacao = g.data_movimentacao),
revenue_day AS (
  SELECT t.data,
         {", ".join(f"{_f(f'SUM({_rev(f'con.taxa_{t}', f'fd.total_{t}')})')} AS faturamento_{t}" for t in ("boleto", "payin", "payout"))},
         {_f("SUM(" + " + ".join(_rev(f"con.taxa_{t}", f"fd.total_{t}") for t in ("boleto", "payin", "payout")) + ")")} AS faturamento_total,
         {", ".join(f"{_ms(f'fd.total_{t}')} AS total_{t}" for t in ("boleto", "payin", "payout"))},
         {_f("SUM(" + " + ".join(_c(f"fd.total_{t}") for t in ("boleto", "payin", "payout")) + ")")} AS total
  FROM fd JOIN con ON con.id_contrato = fd.id_contrato JOIN tempo t ON fd.data_movimentacao = t.data
  GROUP BY t.data),
ts AS (
  SELECT 'total' AS serie, data_movimentacao, {_ms("total_movimentacao")} AS valor
  FROM fd GROUP BY data_movimentacao
  UNION ALL
  SELECT segmento AS serie, data_movimentacao, total_movimentacao AS valor FROM seg_dense),
split AS (
  SELECT serie, data_movimentacao, valor, posicao, n, 'treino' AS conjunto FROM (
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY serie ORDER BY data_movimentacao) - 1 AS INTEGER) AS posicao,
           COUNT(*) OVER (PARTITION BY serie) AS n FROM ts) x WHERE posicao <= n // 2
  UNION ALL
  SELECT serie, data_movimentacao, valor, posicao, n, 'teste' AS conjunto FROM (
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY serie ORDER BY data_movimentacao) - 1 AS INTEGER) AS posicao,
           COUNT(*) OVER (PARTITION BY serie) AS n FROM ts) x WHERE posicao >= n // 2)
"""


def _with(body: str) -> str:
    rec = "RECURSIVE " if "dl(serie" in body else ""
    return f"WITH {rec}{BASE.strip()}\n{body}"


def _trend_cte(series: str) -> str:
    """Least squares per series in closed form: exact sums of days, values and their products."""
    return f""",
ser AS ({series}),
xy AS (
  SELECT serie, data_movimentacao, valor,
         CAST(date_diff('day', DATE '1970-01-01', data_movimentacao) AS DECIMAL(10,0)) AS x,
         {_c("valor", 27)} AS y
  FROM ser),
sums AS (
  SELECT serie, COUNT(y) AS n, CAST(COUNT(y) AS DOUBLE) AS dn,
         CAST(SUM(x) AS DOUBLE) AS sx, CAST(SUM(x * x) AS DOUBLE) AS sxx, {_f("SUM(y)")} AS sy,
         {_f("SUM(x * y)")} AS sxy, SUM(valor * valor) AS syy
  FROM xy GROUP BY serie),
fit AS (
  SELECT serie, n, dn, sx, sy, sxy, syy, dn * sxx - sx * sx AS den,
         CASE WHEN dn * sxx - sx * sx <> 0 THEN (dn * sxy - sx * sy) / (dn * sxx - sx * sx) END AS slope
  FROM sums),
fit2 AS (
  SELECT serie, n, slope, (sy - slope * sx) / dn AS intercept,
         CASE WHEN den <> 0 AND (syy - sy * sy / dn) <> 0
              THEN (dn * sxy - sx * sy) * (dn * sxy - sx * sy) / (den * (dn * syy - sy * sy)) END AS r2
  FROM fit),
pred AS (
  SELECT xy.serie, xy.data_movimentacao, xy.valor,
         f.intercept + f.slope * CAST(xy.x AS DOUBLE) AS prediction
  FROM xy JOIN fit2 f USING (serie))
"""


def _trend_report(series: str, kind: str) -> str:
    ds, di, dr = {"count": (10, 8, 6), "money": (6, 4, 2)}[kind]
    return _with(_trend_cte(series) + f"""
SELECT f.serie, CAST(f.n AS BIGINT) AS n, ROUND(f.slope, {ds}) AS inclinacao_dia,
       ROUND(f.intercept, {di}) AS intercepto, ROUND(f.r2, 8) AS r2,
       ROUND(SQRT(AVG((p.valor - p.prediction) * (p.valor - p.prediction))), {dr}) AS rmse
FROM fit2 f JOIN pred p USING (serie)
GROUP BY f.serie, f.n, f.slope, f.intercept, f.r2""")


_VALUE_SERIES = """
  SELECT 'boleto' AS serie, data AS data_movimentacao, total_boleto AS valor FROM revenue_day
  UNION ALL SELECT 'payin', data, total_payin FROM revenue_day
  UNION ALL SELECT 'payout', data, total_payout FROM revenue_day
  UNION ALL SELECT 'total', data, total FROM revenue_day"""

_REVENUE_SERIES = """
  SELECT 'boleto' AS serie, data AS data_movimentacao, faturamento_boleto AS valor FROM revenue_day
  UNION ALL SELECT 'payin', data, faturamento_payin FROM revenue_day
  UNION ALL SELECT 'payout', data, faturamento_payout FROM revenue_day
  UNION ALL SELECT 'total', data, faturamento_total FROM revenue_day"""


def _seg_series(measure: str) -> str:
    return f"SELECT segmento AS serie, data_movimentacao, CAST({measure} AS DOUBLE) AS valor FROM seg_dense"


_ACF_LAGS = 30
Z975 = 1.959963984540054

_ACF_CTE = f""",
tr AS (SELECT serie, data_movimentacao, valor FROM split WHERE conjunto = 'treino'),
cc AS (SELECT serie, data_movimentacao, valor - AVG(valor) OVER (PARTITION BY serie) AS c,
              ROW_NUMBER() OVER (PARTITION BY serie ORDER BY data_movimentacao) AS rn,
              COUNT(*) OVER (PARTITION BY serie) AS n
       FROM tr),
lags AS (SELECT CAST(range AS INTEGER) AS lag FROM range(0, {_ACF_LAGS + 1})),
grid AS (SELECT DISTINCT serie, n, lag FROM cc CROSS JOIN lags),
prods AS (SELECT a.serie, l.lag, SUM(a.c * b.c) AS s
          FROM cc a CROSS JOIN lags l JOIN cc b ON b.serie = a.serie AND b.rn = a.rn - l.lag
          GROUP BY a.serie, l.lag),
r AS (SELECT g.serie, g.n, g.lag,
             CASE WHEN g.lag < g.n AND s0.s <> 0 THEN COALESCE(p.s, 0.0) / s0.s END AS acf
      FROM grid g LEFT JOIN prods p ON p.serie = g.serie AND p.lag = g.lag
      JOIN prods s0 ON s0.serie = g.serie AND s0.lag = 0),
v AS (SELECT serie, n, lag, acf,
             CASE WHEN lag = 0 THEN 0.0 ELSE (1.0 + 2.0 * COALESCE(SUM(CASE WHEN lag >= 1 THEN acf * acf ELSE 0.0 END)
                  OVER (PARTITION BY serie ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / CAST(n AS DOUBLE)
             END AS var_bartlett
      FROM r),
band AS (SELECT *, {Z975} * SQRT(var_bartlett) AS band FROM v)
"""


# PACF: lag-adjusted autocorrelations, then the Durbin-Levinson recursion over lists
_PACF_CTE = _ACF_CTE.split("\nr AS (")[0] + f"""\nra AS (
  SELECT g.serie, g.n,
         list(CASE WHEN g.lag < g.n AND s0.s <> 0
                   THEN COALESCE(p.s / (g.n - g.lag), 0.0) / (s0.s / g.n) ELSE 0.0 END ORDER BY g.lag) AS r
  FROM grid g LEFT JOIN prods p ON p.serie = g.serie AND p.lag = g.lag
  JOIN prods s0 ON s0.serie = g.serie AND s0.lag = 0
  GROUP BY g.serie, g.n),
dl(serie, n, k, p, pk) AS (
  SELECT serie, n, 1, [r[2]], r[2] FROM ra
  UNION ALL
  SELECT dl.serie, dl.n, dl.k + 1,
         list_append(list_transform(range(1, dl.k + 1), lambda j: dl.p[j] - x.pkn * dl.p[dl.k + 1 - j]), x.pkn),
         x.pkn
  FROM dl JOIN ra USING (serie),
       LATERAL (SELECT (ra.r[dl.k + 2] - list_sum(list_transform(range(1, dl.k + 1), lambda i: dl.p[i] * ra.r[dl.k + 2 - i])))
                       / (1 - list_sum(list_transform(range(1, dl.k + 1), lambda i: dl.p[i] * ra.r[i + 1]))) AS pkn) x
  WHERE dl.k < {_ACF_LAGS}),
pacf AS (
  SELECT serie, 0 AS lag, CAST(1.0 AS DOUBLE) AS pacf, n FROM ra
  UNION ALL SELECT serie, k AS lag, pk AS pacf, n FROM dl)
"""
_PACF_CTE = _PACF_CTE.replace("WITH RECURSIVE", "")


def _seasonality_sql(attr: str) -> str:
    return f"""
SELECT s.segmento, t.{attr}, COUNT(*) AS dias,
       CAST(SUM(s.quantidade_movimentacoes) AS DOUBLE) / COUNT(*) AS quantidade_media,
       {_ms("s.total_movimentacao")} / COUNT(*) AS valor_medio
FROM seg_all s JOIN tempo t ON s.data_movimentacao = t.data
GROUP BY s.segmento, t.{attr}"""


def _streaks(days: str) -> str:
    """Runs of use by gaps and islands, and the idle runs between them."""
    return f""",
days AS ({days}),
isl AS (SELECT id_cliente, d, d - CAST(ROW_NUMBER() OVER (PARTITION BY id_cliente ORDER BY d) AS INTEGER) AS island FROM days),
u AS (SELECT id_cliente, MIN(d) AS a, MAX(d) AS z FROM isl GROUP BY id_cliente, island),
i AS (SELECT id_cliente, z, LEAD(a) OVER (PARTITION BY id_cliente ORDER BY a) AS next FROM u)
SELECT id_cliente, TRUE AS uso, a AS primeiro_dia, z AS ultimo_dia, CAST(date_diff('day', a, z) + 1 AS INTEGER) AS dias FROM u
UNION ALL
SELECT id_cliente, FALSE, CAST(z + 1 AS DATE), CAST(next - 1 AS DATE), CAST(date_diff('day', z, next) - 1 AS INTEGER)
FROM i WHERE next IS NOT NULL"""


# events in three batches; late: more than a day before the latest second of the batches before
_LATE_EVENTS = """
part AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN 2 WHEN day(ts) <= 15 THEN 0 ELSE 1 END AS batch FROM events),
high AS (SELECT b.batch, MAX(date_trunc('second', p.ts)) AS high FROM (VALUES (1), (2)) b(batch) JOIN part p ON p.batch < b.batch GROUP BY b.batch),
ev AS (SELECT part.*, COALESCE(date_trunc('second', ts) < high - INTERVAL 1 DAY, FALSE) AS late
       FROM part LEFT JOIN high ON high.batch = part.batch)"""


SQL: dict[str, str] = {
    "dim_clientes": _with("SELECT * FROM cli"),
    "dim_contratos": _with("SELECT * FROM con"),
    "calendar": _with("SELECT * FROM tempo"),
    "resolve_contract": _with("SELECT * FROM fact"),
    "merge_insert_only": _with("SELECT * FROM fact"),
    "stream_ingest": _with("SELECT * FROM fact"),
    "incremental_fact": _with("SELECT * FROM fact"),
    "incremental_summary": _with("SELECT * FROM fd"),
    "incremental_calendar": _with("SELECT * FROM tempo"),
    "incremental_revenue_day": _with("SELECT * FROM revenue_day"),
    "stream_daily_totals": f"""
SELECT CAST(ts AS DATE) AS dia, CAST(user_id AS BIGINT) AS id_cliente, COUNT(*) AS eventos,
       {_ms("value")} AS valor_total
FROM events GROUP BY 1, 2""",
    "daily_summary": _with("SELECT * FROM fd"),
    "warehouse_fact": _with("SELECT * FROM fact"),
    "warehouse_summary": _with("SELECT * FROM fd"),
    "daily_join_calendar": _with(
        "SELECT * FROM fd JOIN tempo t ON fd.data_movimentacao = t.data "
        "WHERE t.mes = 4 AND t.dia > 5 AND t.dia < 20"),
    "daily_with_calendar": _with("SELECT * FROM fd JOIN tempo t ON fd.data_movimentacao = t.data"),
    "daily_with_client_contract": _with("""
SELECT fd.*, cli.razao_social, cli.data_inicio_relacionamento, cli.status, cli.data_fim_relacionamento,
       cli.segmento, con.taxa_payout, con.taxa_payin, con.taxa_boleto, con.data_vencimento_contrato
FROM fd JOIN cli ON cli.id_cliente = fd.id_cliente JOIN con ON con.id_contrato = fd.id_contrato"""),
    "volume_client_day": _with("""
SELECT t.data, fd.id_cliente,
       CAST(SUM(quantidade_boleto) AS BIGINT) AS quantidade_boleto,
       CAST(SUM(quantidade_payout) AS BIGINT) AS quantidade_payout,
       CAST(SUM(quantidade_payin) AS BIGINT) AS quantidade_payin
FROM fd JOIN tempo t ON fd.data_movimentacao = t.data
GROUP BY t.data, fd.id_cliente"""),
    "volume_one_client": _with("""
SELECT t.data, fd.id_cliente,
       CAST(SUM(quantidade_boleto) AS BIGINT) AS quantidade_boleto,
       CAST(SUM(quantidade_payout) AS BIGINT) AS quantidade_payout,
       CAST(SUM(quantidade_payin) AS BIGINT) AS quantidade_payin
FROM fd JOIN tempo t ON fd.data_movimentacao = t.data
WHERE fd.id_cliente = (SELECT MIN(id_cliente) FROM fd)
GROUP BY t.data, fd.id_cliente"""),
    "usage_one_year": _with(f"""
SELECT fact.id_cliente, t.data, t.dia, t.mes, t.ano, fact.tipo_transacao,
       {_ms("fact.valor_transacao")} AS total_movimentacao,
       COUNT(fact.id_cliente) AS quantidade_movimentacoes
FROM fact JOIN tempo t ON fact.data_movimentacao = t.data
WHERE t.ano = (SELECT year(MIN(data_movimentacao)) + 1 FROM fd)
GROUP BY fact.id_cliente, t.data, t.dia, t.mes, t.ano, fact.tipo_transacao"""),
    "volume_moving_avg": _with(""", v AS (
SELECT t.data, fd.id_cliente,
       CAST(SUM(quantidade_boleto) AS BIGINT) AS quantidade_boleto,
       CAST(SUM(quantidade_payout) AS BIGINT) AS quantidade_payout,
       CAST(SUM(quantidade_payin) AS BIGINT) AS quantidade_payin
FROM fd JOIN tempo t ON fd.data_movimentacao = t.data
GROUP BY t.data, fd.id_cliente)
SELECT *, """ + ", ".join(
        f"AVG(quantidade_{t}) OVER (PARTITION BY id_cliente ORDER BY data ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS media_movel_{t}"
        for t in ("boleto", "payout", "payin")) + " FROM v"),
    "date_bounds": _with("""
SELECT MIN(data_movimentacao) AS primeiro_dia, MAX(data_movimentacao) AS ultimo_dia,
       COUNT(DISTINCT data_movimentacao) AS dias_com_dados FROM fd"""),
    "usage_client_day_type": _with(f"""
SELECT fact.id_cliente, t.data, t.dia, t.mes, t.ano, fact.tipo_transacao,
       {_ms("fact.valor_transacao")} AS total_movimentacao,
       COUNT(fact.id_cliente) AS quantidade_movimentacoes
FROM fact JOIN tempo t ON fact.data_movimentacao = t.data
GROUP BY fact.id_cliente, t.data, t.dia, t.mes, t.ano, fact.tipo_transacao"""),
    "usage_dense": _with(f""",
bounds AS (SELECT CAST(MAX(data) - INTERVAL 3 MONTH AS DATE) AS s, CAST(MAX(data) - INTERVAL 1 MONTH AS DATE) AS e
           FROM tempo),
w AS (SELECT id_cliente, data_movimentacao,
             CAST(SUM(quantidade_movimentacoes) AS BIGINT) AS quantidade_movimentacoes,
             {", ".join(f"CAST(SUM(quantidade_{t}) AS BIGINT) AS quantidade_{t}" for t in ("boleto", "payin", "payout"))},
             {_ms("total_movimentacao")} AS total_movimentacao
      FROM fd, bounds WHERE data_movimentacao BETWEEN bounds.s AND bounds.e
      GROUP BY id_cliente, data_movimentacao),
g AS (SELECT k.id_cliente, CAST(d AS DATE) AS data_movimentacao
      FROM (SELECT DISTINCT id_cliente FROM w) k
      CROSS JOIN (SELECT unnest(generate_series((SELECT s FROM bounds), (SELECT e FROM bounds), INTERVAL 1 DAY)) AS d) days)
SELECT g.id_cliente, g.data_movimentacao,
       COALESCE(w.quantidade_movimentacoes, 0) AS quantidade_movimentacoes,
       {", ".join(f"COALESCE(w.quantidade_{t}, 0) AS quantidade_{t}" for t in ("boleto", "payin", "payout"))},
       COALESCE(w.total_movimentacao, 0.0) AS total_movimentacao,
       COALESCE(w.quantidade_movimentacoes, 0) > 0 AS uso,
       isodow(g.data_movimentacao) = 7 AS is_domingo
FROM g LEFT JOIN w ON w.id_cliente = g.id_cliente AND w.data_movimentacao = g.data_movimentacao"""),
    "usage_window": _with(f""",
bounds AS (SELECT CAST(MAX(data) - INTERVAL 3 MONTH AS DATE) AS s, CAST(MAX(data) - INTERVAL 1 MONTH AS DATE) AS e
           FROM tempo)
SELECT fact.id_cliente, t.data, t.dia, t.mes, t.ano, fact.tipo_transacao,
       {_ms("fact.valor_transacao")} AS total_movimentacao,
       COUNT(fact.id_cliente) AS quantidade_movimentacoes
FROM fact JOIN tempo t ON fact.data_movimentacao = t.data, bounds
WHERE t.data BETWEEN bounds.s AND bounds.e
GROUP BY fact.id_cliente, t.data, t.dia, t.mes, t.ano, fact.tipo_transacao"""),
    "usage_pivot_type": _with("""
SELECT fact.id_cliente, t.data,
       CAST(SUM(CASE WHEN tipo_transacao = 'boleto' THEN 1 ELSE 0 END) AS BIGINT) AS boleto,
       CAST(SUM(CASE WHEN tipo_transacao = 'payin' THEN 1 ELSE 0 END) AS BIGINT) AS payin,
       CAST(SUM(CASE WHEN tipo_transacao = 'payout' THEN 1 ELSE 0 END) AS BIGINT) AS payout
FROM fact JOIN tempo t ON fact.data_movimentacao = t.data
GROUP BY fact.id_cliente, t.data"""),
    "usage_gaps": _with(""", d AS (SELECT DISTINCT id_cliente, data_movimentacao FROM fd)
SELECT id_cliente, data_movimentacao,
       LAG(data_movimentacao) OVER (PARTITION BY id_cliente ORDER BY data_movimentacao) AS dia_anterior,
       CAST(date_diff('day', LAG(data_movimentacao) OVER (PARTITION BY id_cliente ORDER BY data_movimentacao),
                      data_movimentacao) - 1 AS INTEGER) AS dias_sem_uso
FROM d"""),
    "event_use_days": f"""
WITH d AS (
  SELECT CAST(user_id AS BIGINT) AS id_cliente, CAST(ts AS DATE) AS data_movimentacao,
         COUNT(*) AS eventos, {_ms("value")} AS valor_total
  FROM events GROUP BY 1, 2)
SELECT id_cliente, data_movimentacao, eventos, valor_total,
       LAG(data_movimentacao) OVER (PARTITION BY id_cliente ORDER BY data_movimentacao) AS dia_anterior,
       CAST(date_diff('day', LAG(data_movimentacao) OVER (PARTITION BY id_cliente ORDER BY data_movimentacao),
                      data_movimentacao) - 1 AS INTEGER) AS dias_sem_uso
FROM d""",
    "revenue_client_day": _with(f"""
SELECT t.data, fd.id_cliente,
       {", ".join(f"{_f(f'SUM({_rev(f'con.taxa_{x}', f'fd.total_{x}')})')} AS faturamento_{x}" for x in ("boleto", "payin", "payout"))},
       {", ".join(f"{_ms(f'fd.total_{x}')} AS total_{x}" for x in ("boleto", "payin", "payout"))}
FROM fd JOIN con ON con.id_contrato = fd.id_contrato JOIN tempo t ON fd.data_movimentacao = t.data
GROUP BY t.data, fd.id_cliente"""),
    "revenue_day": _with("SELECT * FROM revenue_day"),
    "clients_per_segment": _with("SELECT segmento, COUNT(id_cliente) AS clientes FROM cli GROUP BY segmento"),
    "segment_day": _with(
        "SELECT segmento, data_movimentacao, quantidade_movimentacoes, total_movimentacao FROM seg_all"),
    "segment_revenue_day": _with("SELECT segmento, data_movimentacao, faturamento FROM seg_all"),
    "segment_day_dense": _with("SELECT * FROM seg_dense"),
    "trend_value_type": _trend_report(_VALUE_SERIES, "money"),
    "trend_revenue_type": _trend_report(_REVENUE_SERIES, "money"),
    "trend_segment_count": _trend_report(_seg_series("quantidade_movimentacoes"), "count"),
    "trend_segment_value": _trend_report(_seg_series("total_movimentacao"), "money"),
    "trend_segment_revenue": _trend_report(_seg_series("faturamento"), "money"),
    "trend_extrapolate": _with(_trend_cte(_VALUE_SERIES) + """,
last AS (SELECT serie, MAX(data_movimentacao) AS ultimo FROM ser GROUP BY serie)
SELECT f.serie, CAST(d AS DATE) AS data_movimentacao,
       ROUND(f.intercept + f.slope * CAST(date_diff('day', DATE '1970-01-01', CAST(d AS DATE)) AS DOUBLE), 4) AS prediction
FROM fit2 f JOIN last USING (serie),
     LATERAL (SELECT unnest(generate_series(last.ultimo, last.ultimo + INTERVAL 29 DAY, INTERVAL 1 DAY)) AS d) g"""),
    "trend_predictions": _with(_trend_cte(_VALUE_SERIES) + """
SELECT serie, data_movimentacao, valor, ROUND(prediction, 4) AS prediction FROM pred"""),
    "trend_predictions_revenue": _with(_trend_cte(_REVENUE_SERIES) + """
SELECT serie, data_movimentacao, valor, ROUND(prediction, 4) AS prediction FROM pred"""),
    "trend_predictions_segment": " UNION ALL ".join(
        "SELECT * FROM (" + _with(_trend_cte(_seg_series(m)) + f"""
SELECT '{name}' AS medida, serie, data_movimentacao, valor, ROUND(prediction, 4) AS prediction FROM pred""") + ")"
        for name, m in (("quantidade", "quantidade_movimentacoes"), ("valor", "total_movimentacao"),
                        ("faturamento", "faturamento"))),
    "daily_total": _with(f"SELECT data_movimentacao, {_ms('total_movimentacao')} AS total_movimentacao "
                         "FROM fd GROUP BY data_movimentacao"),
    "series_split": _with("SELECT * FROM split"),
    "acf": _with(_ACF_CTE + """
SELECT serie, lag, CAST(n AS BIGINT) AS n, ROUND(acf, 8) AS acf, ROUND(var_bartlett, 10) AS var_bartlett,
       ROUND(band, 8) AS band FROM band"""),
    "acf_first_lag": _with(_ACF_CTE + """
SELECT serie, CAST(COALESCE(MIN(CASE WHEN lag >= 1 AND ABS(acf) > band THEN lag END), 0) AS INTEGER) AS acf_first_lag
FROM band GROUP BY serie"""),
    "pacf": _with(_PACF_CTE + """
SELECT serie, CAST(lag AS INTEGER) AS lag, ROUND(pacf, 8) AS pacf, CAST(n AS BIGINT) AS n,
       ROUND(2.0 / SQRT(CAST(n AS DOUBLE)), 8) AS band FROM pacf"""),
    "pacf_first_lag": _with(_PACF_CTE + """
SELECT serie, CAST(COALESCE(MIN(CASE WHEN lag >= 1 AND ABS(pacf) > 2.0 / SQRT(CAST(n AS DOUBLE)) THEN lag END), 0)
       AS INTEGER) AS pacf_first_lag
FROM pacf GROUP BY serie"""),
    "type_by_segment": _with(f""",
j AS (SELECT cli.segmento, fd.* FROM fd JOIN cli ON cli.id_cliente = fd.id_cliente
      JOIN con ON con.id_contrato = fd.id_contrato),
l AS ({" UNION ALL ".join(f"SELECT segmento, '{t}' AS tipo_transacao, data_movimentacao, quantidade_{t} AS quantidade, total_{t} AS total FROM j" for t in TYPES)})
SELECT segmento, tipo_transacao, data_movimentacao, CAST(SUM(quantidade) AS BIGINT) AS quantidade_movimentacoes,
       {_ms("total")} AS total_movimentacao
FROM l GROUP BY segmento, tipo_transacao, data_movimentacao"""),
    "client_profile": _with(f""",
j AS (SELECT cli.segmento, fd.* FROM fd JOIN cli ON cli.id_cliente = fd.id_cliente
      JOIN con ON con.id_contrato = fd.id_contrato),
per AS (SELECT id_cliente, segmento, CAST(SUM(quantidade_movimentacoes) AS BIGINT) AS quantidade_movimentacoes,
               {", ".join(f"CAST(SUM(quantidade_{t}) AS BIGINT) AS q_{t}" for t in TYPES)}
        FROM j GROUP BY id_cliente, segmento),
sh AS (SELECT id_cliente, segmento, quantidade_movimentacoes,
              {", ".join(f"CAST(q_{t} AS DOUBLE) / CAST(quantidade_movimentacoes AS DOUBLE) AS participacao_{t}" for t in TYPES)}
       FROM per),
m AS (SELECT segmento, {", ".join(f"AVG(participacao_{t}) AS m_{t}" for t in TYPES)} FROM sh GROUP BY segmento)
SELECT id_cliente, segmento, quantidade_movimentacoes,
       {", ".join(f"ROUND(participacao_{t}, 8) AS participacao_{t}" for t in TYPES)},
       {", ".join(f"ROUND(participacao_{t} - m_{t}, 8) AS desvio_{t}" for t in TYPES)}
FROM sh JOIN m USING (segmento)"""),
    "weekday_seasonality": _with(_seasonality_sql("dia_da_semana")),
    "month_seasonality": _with(_seasonality_sql("mes")),
    "usage_streaks": _with(_streaks("SELECT DISTINCT id_cliente, data_movimentacao AS d FROM fd")),
    "event_streaks": "WITH " + _streaks("SELECT DISTINCT CAST(user_id AS BIGINT) AS id_cliente, CAST(ts AS DATE) AS d FROM events")
                     .lstrip(", "),
    "movement_cube": _with(f""",
j AS (SELECT cli.segmento, fd.* FROM fd JOIN cli ON cli.id_cliente = fd.id_cliente
      JOIN con ON con.id_contrato = fd.id_contrato),
l AS ({" UNION ALL ".join(f"SELECT segmento, '{t}' AS tipo_transacao, year(data_movimentacao) * 100 + month(data_movimentacao) AS mes_ref, quantidade_{t} AS quantidade, total_{t} AS total FROM j" for t in TYPES)})
SELECT segmento, tipo_transacao, CAST(mes_ref AS INTEGER) AS mes_ref,
       CAST(GROUPING(segmento, tipo_transacao, mes_ref) AS INTEGER) AS nivel,
       CAST(SUM(quantidade) AS BIGINT) AS quantidade_movimentacoes, {_ms("total")} AS total_movimentacao
FROM l GROUP BY CUBE (segmento, tipo_transacao, mes_ref)"""),
    "residual_summary": _with(_trend_cte(_VALUE_SERIES) + """,
res AS (SELECT serie, valor - prediction AS r FROM pred)
SELECT serie, COUNT(r) AS n, ROUND(AVG(r), 4) + 0.0 AS media, ROUND(STDDEV_SAMP(r), 2) + 0.0 AS desvio,
       ROUND(MIN(r), 2) + 0.0 AS minimo, ROUND(QUANTILE_CONT(r, 0.25), 2) + 0.0 AS q25,
       ROUND(QUANTILE_CONT(r, 0.5), 2) + 0.0 AS q50, ROUND(QUANTILE_CONT(r, 0.75), 2) + 0.0 AS q75,
       ROUND(MAX(r), 2) + 0.0 AS maximo
FROM res GROUP BY serie"""),
    "stream_late_events": f"WITH {_LATE_EVENTS} SELECT event_id, user_id, event_type, value FROM ev WHERE late",
    "stream_sessions": f"""
WITH {_LATE_EVENTS},
s AS (SELECT CAST(user_id AS BIGINT) AS id_cliente, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS t, value
      FROM ev WHERE NOT late),
b AS (SELECT *, CASE WHEN t - LAG(t) OVER (PARTITION BY id_cliente ORDER BY t) <= 1800 THEN 0 ELSE 1 END AS first FROM s),
g AS (SELECT *, SUM(first) OVER (PARTITION BY id_cliente ORDER BY t ROWS UNBOUNDED PRECEDING) AS nr FROM b)
SELECT id_cliente, MIN(t) AS inicio, MAX(t) + 1800 AS fim, COUNT(*) AS eventos, {_ms("value")} AS valor_total
FROM g GROUP BY id_cliente, nr HAVING MAX(t) + 1800 <= (SELECT MAX(t) FROM s) - 86400""",
}
# the same fits and lags by another way of computing them
SQL["trend_incremental"] = SQL["trend_value_type"]
SQL["acf_blocks"] = SQL["acf"]
