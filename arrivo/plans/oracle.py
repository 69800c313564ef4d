"""SQL twins of the driver queries, written for DuckDB over the raw parquet views.

Each twin re-derives its input from the base tables through the common table
expressions below (the same mapping as ``arrivo.sources.fixtures``), so it is
an independent statement of the same result.
"""

from __future__ import annotations

from arrivo.plans.pipeline import DEFAULT

QUARTERLY_IN = "('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED')"


def title(expr: str) -> str:
    """Python ``str.title`` in DuckDB."""
    return ("array_to_string(list_transform(regexp_extract_all({e}, '(\\p{{L}}+|[^\\p{{L}}]+)'), "
            "lambda x: upper(x[1]) || lower(x[2:])), '')").format(e=expr)


def rnd(expr: str, digits: int = 2) -> str:
    """Half-even rounding on the scaled double (same form as the Spark side)."""
    scale = 10 ** digits
    return f"(round_even(({expr}) * {scale}.0, 0) / {scale}.0)"


def significant(expr: str, digits: int = 12) -> str:
    """Rounding to significant digits."""
    e = f"CAST(floor(log10(abs({expr}))) AS INTEGER)"
    up, down = f"pow(10.0, greatest({digits - 1} - {e}, 0))", f"pow(10.0, greatest({e} - {digits - 1}, 0))"
    return f"CASE WHEN ({expr}) = 0 THEN 0.0 ELSE round_even(({expr}) / {down} * {up}, 0) / {up} * {down} END"


def mean_of(expr: str) -> str:
    return significant(f"avg(CAST({expr} AS DOUBLE))")


def std_of(expr: str) -> str:
    return significant(f"stddev_samp(CAST({expr} AS DOUBLE))")


P = DEFAULT

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("lines", [], """
  SELECT CAST(o.o_orderdate AS DATE) AS d, n.n_name AS origin, o.o_orderpriority AS gateway,
         CAST(trunc(l.l_quantity) AS BIGINT) - 1 AS visitors
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey""")

cte("landed", ["lines"], f"""
  SELECT gateway AS src,
         CASE WHEN gateway IN {QUARTERLY_IN} THEN CAST(date_trunc('quarter', d) AS DATE)
              ELSE CAST(date_trunc('month', d) AS DATE) END AS periodo,
         origin AS pais_residencia,
         CAST(sum(visitors) AS BIGINT) AS turistas_no_residentes
  FROM lines GROUP BY 1, 2, 3""")

cte("std", ["landed"], f"""
  SELECT x.src,
         strftime(CAST(x.periodo + to_months(t.k) AS DATE), '%Y-%m') AS indice_tiempo,
         CAST(x.periodo + to_months(t.k) AS DATE) AS fecha_std,
         {title("trim(x.pais_residencia)")} AS pais_origen,
         x.src AS punto_entrada,
         CASE WHEN x.quarterly THEN CAST(trunc(x.turistas_no_residentes / 3) AS BIGINT)
              ELSE x.turistas_no_residentes END AS turistas
  FROM (SELECT *, src IN {QUARTERLY_IN} AS quarterly FROM landed
        WHERE periodo >= DATE '{P.start}') x
  JOIN (VALUES (0), (1), (2)) t(k) ON t.k < CASE WHEN x.quarterly THEN 3 ELSE 1 END""")

cte("fact", ["std"], """
  SELECT indice_tiempo, pais_origen, punto_entrada, CAST(sum(turistas) AS BIGINT) AS turistas
  FROM std GROUP BY 1, 2, 3""")

cte("quotes_clean", [], f"""
  SELECT o_orderstatus AS casa, o_orderdate AS fecha, o_totalprice AS venta FROM orders
  WHERE contains(lower(o_orderstatus), '{P.house_word}')
    AND o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL
    AND o_orderdate >= TIMESTAMP '{P.start}' AND o_orderdate <= TIMESTAMP '{P.run_ts}'""")

cte("quotes_monthly", ["quotes_clean"], f"""
  SELECT indice_tiempo,
         {rnd("m")} AS precio_promedio_usd, {rnd("mn")} AS precio_minimo_usd, {rnd("mx")} AS precio_maximo_usd,
         dias, {rnd("mx - mn")} AS variacion_usd_mensual,
         {rnd("(mx - mn) / nullif(mn, 0) * 100.0")} AS variacion_porcentual_usd
  FROM (SELECT strftime(fecha, '%Y-%m') AS indice_tiempo, {mean_of("venta")} AS m,
               min(venta) AS mn, max(venta) AS mx, count(venta) AS dias
        FROM quotes_clean GROUP BY 1)""")

cte("interest_clean", [], f"""
  SELECT l_shipdate AS fecha, l_discount * 100.0 AS interes_google FROM lineitem
  WHERE l_shipdate IS NOT NULL AND l_discount IS NOT NULL AND l_shipdate >= TIMESTAMP '{P.start}'""")

cte("interest_monthly", ["interest_clean"], f"""
  SELECT g.*, CAST(coalesce(g.interes_google_promedio > (SELECT quantile_cont(interes_google_promedio, 0.5)
                                FROM (SELECT {rnd(mean_of("interes_google"), 1)} AS interes_google_promedio
                                      FROM interest_clean GROUP BY strftime(fecha, '%Y-%m'))), false) AS INTEGER)
              AS interes_alto
  FROM (SELECT strftime(fecha, '%Y-%m') AS indice_tiempo,
               {rnd(mean_of("interes_google"), 1)} AS interes_google_promedio,
               max(interes_google) AS interes_google_max, min(interes_google) AS interes_google_min,
               count(interes_google) AS registros
        FROM interest_clean GROUP BY 1) g""")

cte("joined_q", ["fact", "quotes_monthly"], """
  SELECT f.*, q.precio_promedio_usd, q.precio_minimo_usd, q.precio_maximo_usd, q.dias,
         q.variacion_usd_mensual, q.variacion_porcentual_usd
  FROM fact f LEFT JOIN quotes_monthly q USING (indice_tiempo)""")

MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio",
          "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
_dummies = ",\n         ".join(f"CAST(coalesce(mes = {i + 1}, false) AS INTEGER) AS es_{m}" for i, m in enumerate(MONTHS))

cte("final", ["joined_q", "interest_monthly"], f"""
  SELECT indice_tiempo, pais_origen, punto_entrada, turistas,
         precio_promedio_usd, precio_minimo_usd, precio_maximo_usd, dias,
         variacion_usd_mensual, variacion_porcentual_usd, usd_alto, usd_alta_variabilidad,
         interes_google_promedio, interes_alto, "año", mes,
         {_dummies},
         CAST(coalesce(mes IN (2, 3), false) AS INTEGER) AS mes_vendimia,
         CAST(coalesce(mes IN (7, 8), false) AS INTEGER) AS vacaciones_invierno,
         CAST(coalesce(mes IN (1, 2, 3, 7, 8, 12), false) AS INTEGER) AS temporada_alta
  FROM (
    SELECT j.*,
      CASE WHEN (SELECT count(precio_promedio_usd) FROM joined_q) > 0 THEN
        CAST(coalesce(j.precio_promedio_usd > (SELECT quantile_cont(precio_promedio_usd, 0.5) FROM joined_q), false) AS INTEGER) END AS usd_alto,
      CASE WHEN (SELECT count(precio_promedio_usd) FROM joined_q) > 0 THEN
        CAST(coalesce(j.variacion_usd_mensual > (SELECT quantile_cont(variacion_usd_mensual, 0.5) FROM joined_q), false) AS INTEGER) END AS usd_alta_variabilidad,
      i.interes_google_promedio, i.interes_alto,
      CAST(split_part(j.indice_tiempo, '-', 1) AS INTEGER) AS "año",
      CAST(split_part(j.indice_tiempo, '-', 2) AS INTEGER) AS mes
    FROM joined_q j LEFT JOIN interest_monthly i USING (indice_tiempo))""")


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_(needs: list[str], body: str) -> str:
    """``WITH`` clause holding ``needs`` and their dependencies, then ``body``."""
    names = _order(needs)
    if not names:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in names)
    return f"WITH {parts}\n{body}"


def with_extra(needs: list[str], extra: str, body: str) -> str:
    """Like ``with_`` with further query-local CTEs (``name AS (...)``, comma separated) appended."""
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in _order(needs)] + [extra.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + body
