"""DuckDB SQL for the derived panels; every oracle query starts from these CTEs.

Each string is a ``WITH`` list that ends with a comma-free CTE, so a query is
``with_p1("SELECT ... FROM p1")``.
"""

from __future__ import annotations

P1_CTES = """
hourly AS (
  SELECT event_type AS market, date_trunc('hour', ts) AS delivery_start,
         sum(round(value * 100)) AS target,
         CAST(count(*) AS DOUBLE) AS load_forecast,
         CAST(sum(user_id) AS DOUBLE) AS wind_forecast,
         round((max(value) - min(value)) * 100) AS solar_forecast,
         CAST(min(user_id) AS DOUBLE) AS wind_speed_10m
  FROM events WHERE ts IS NOT NULL GROUP BY 1, 2),
mk AS (
  SELECT market, dense_rank() OVER (ORDER BY market) - 1 AS mrank,
         count(*) OVER () AS n_markets, min(lo) OVER () AS g_lo, max(hi) OVER () AS g_hi
  FROM (SELECT market, min(delivery_start) AS lo, max(delivery_start) AS hi
        FROM hourly GROUP BY market) m),
grid AS (
  SELECT market, mrank, n_markets, g_lo,
         unnest(generate_series(g_lo, g_hi, INTERVAL 1 HOUR)) AS delivery_start
  FROM mk),
p1 AS (
  SELECT CAST(g.n_markets * CAST(epoch(g.delivery_start - g.g_lo) / 3600 AS BIGINT) + g.mrank AS BIGINT) AS id,
         g.market, g.delivery_start, g.delivery_start + INTERVAL 1 HOUR AS delivery_end,
         h.target, h.load_forecast, h.wind_forecast, h.solar_forecast, h.wind_speed_10m
  FROM grid g LEFT JOIN hourly h ON g.market = h.market AND g.delivery_start = h.delivery_start)
"""

P2_CTES = """
lines AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS load_forecast, sum(l_quantity) AS wind_forecast,
         sum(round(l_discount * 100)) AS solar_forecast, sum(round(l_tax * 100)) AS air_temperature_2m,
         CAST(max(l_linenumber) AS DOUBLE) AS wind_speed_10m
  FROM lineitem GROUP BY l_orderkey),
p2 AS (
  SELECT o.o_orderkey AS id, o.o_orderpriority AS market, CAST(o.o_orderdate AS TIMESTAMP) AS delivery_start,
         CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY AS delivery_end,
         round(o.o_totalprice * 100) AS target,
         l.load_forecast, l.wind_forecast, l.solar_forecast, l.air_temperature_2m, l.wind_speed_10m
  FROM orders o LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey),
p2_train AS (SELECT * FROM p2 WHERE delivery_start < TIMESTAMP '2001-01-01 00:00:00'),
p2_test AS (SELECT * EXCLUDE (target) FROM p2 WHERE delivery_start >= TIMESTAMP '2001-01-01 00:00:00')
"""

VOLUME_CTES = """
vol AS (
  SELECT l_orderkey * 8 + l_linenumber AS id, l_returnflag || l_linestatus AS market,
         CAST(l_shipdate AS TIMESTAMP) AS delivery_start,
         CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 DAY AS delivery_end,
         round(l_extendedprice * 100) AS target,
         round(l_extendedprice / l_quantity) AS load_forecast,
         l_quantity AS wind_forecast, round(l_discount * 100) AS solar_forecast,
         round(l_tax * 100) AS air_temperature_2m, CAST(l_linenumber AS DOUBLE) AS wind_speed_10m
  FROM lineitem)
"""


def with_ctes(body: str, *ctes: str, extra: str = "") -> str:
    parts = [c.strip() for c in ctes]
    if extra:
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n" + body


def with_p1(body: str, extra: str = "") -> str:
    return with_ctes(body, P1_CTES, extra=extra)


def with_p2(body: str, extra: str = "") -> str:
    return with_ctes(body, P2_CTES, extra=extra)


def with_vol(body: str, extra: str = "") -> str:
    return with_ctes(body, VOLUME_CTES, extra=extra)


def rnd(expr: str, digits: int = 4) -> str:
    """Rounding used identically on both sides: floor(x * 10^d + 0.5) / 10^d."""
    scale = f"1e{digits}"
    return f"(floor(({expr}) * {scale} + 0.5) / {scale})"


def qr_coefs(source: str, features, target: str = "target", key: str = "market", alpha: float = 0.0,
             unpenalised=(), digits: int = 4, prefix: str = "qr") -> tuple[str, str]:
    """Least squares of any width in SQL, by orthogonalising one column after the other (modified Gram-Schmidt on centred
    columns), which shares nothing with a solver of normal equations. A ridge penalty adds one row of sqrt(alpha) for
    each penalised column. Returns (CTEs, query): ``feature, coef, n_obs`` by ``key``; complete rows only. ``prefix``
    names the CTEs, for several fits in one query."""
    features = list(features)
    k, a = len(features), [f"a{j}" for j in range(len(features))]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*features, target])
    ctes = [f"qr_x AS MATERIALIZED (SELECT {key} AS k, "
            + ", ".join(f"CAST({c} AS DOUBLE) AS {n}" for c, n in zip([*features, target], [*a, "b"]))
            + f" FROM {source} WHERE {complete})",
            "qr_m AS MATERIALIZED (SELECT k, count(*) AS n, "
            + ", ".join(f"avg({n}) AS m_{n}" for n in [*a, "b"]) + " FROM qr_x GROUP BY k)"]
    rows = "SELECT x.k, " + ", ".join(f"x.{n} - m.m_{n} AS {n}" for n in [*a, "b"]) + " FROM qr_x x JOIN qr_m m ON x.k = m.k"
    if alpha:
        for j, f in enumerate(features):
            if f not in unpenalised:
                rows += " UNION ALL SELECT k, " + ", ".join(
                    f"{'sqrt(' + repr(float(alpha)) + ')' if i == j else '0.0'}" for i in range(k)) + ", 0.0 FROM qr_m"
    ctes.append(f"qr_c0 AS MATERIALIZED ({rows})")
    for j in range(k):
        later = [*a[j + 1:], "b"]
        ctes.append(f"qr_q{j} AS MATERIALIZED (SELECT k, " + ", ".join(
            f"sum({a[j]} * {n}) / sum({a[j]} * {a[j]}) AS r_{n}" for n in later) + f" FROM qr_c{j} GROUP BY k)")
        ctes.append(f"qr_c{j + 1} AS MATERIALIZED (SELECT c.k, " + ", ".join(
            f"c.{n} - q.r_{n} * c.{a[j]} AS {n}" for n in later) + f" FROM qr_c{j} c JOIN qr_q{j} q ON c.k = q.k)")
    # back substitution, from the last column to the first
    done = "SELECT k FROM qr_m"
    for j in reversed(range(k)):
        known = "".join(f" - q.r_{a[i]} * w.w{i}" for i in range(j + 1, k))
        ctes.append(f"qr_w{j} AS MATERIALIZED (SELECT w.*, q.r_b{known} AS w{j} FROM ({done}) w JOIN qr_q{j} q ON w.k = q.k)")
        done = f"SELECT * FROM qr_w{j}"
    const = "m.m_b" + "".join(f" - w.w{j} * m.m_{a[j]}" for j in range(k))
    ctes.append(f"qr_out AS MATERIALIZED (SELECT w.*, {const} AS w_const, m.n FROM qr_w0 w JOIN qr_m m ON w.k = m.k)")
    name = "" if key == "0" else f"k AS {key}, "
    body = " UNION ALL ".join(f"SELECT {name}'{f}' AS feature, {rnd(c, digits)} AS coef, n AS n_obs FROM qr_out"
                              for f, c in [("const", "w_const"), *[(f, f"w{j}") for j, f in enumerate(features)]])
    return ",\n".join(ctes).replace("qr_", f"{prefix}_"), body.replace("qr_", f"{prefix}_")
