"""The SQL counterpart of each registered query that SQL can express over whole tables."""

from __future__ import annotations

import math

from rentlens.operators.clean import DEFLATORS, SEGMENT
from rentlens.operators.validate import ERROR_EDGES, ERROR_LABELS, ERROR_QUANTILES
from rentlens.plans.catalogue import BLUP_THETA, THETAS
from rentlens.plans.fixtures import with_views

ORACLES: dict[str, str] = {}
RECURSIVE = ("walk", "bisect", "sweep")


def _real(v: float) -> str:
    return f"cast('{v!r}' AS double)"


SEG = "ANO, CLASE_PREDIO, ESTRATO, TIPO_OFERTA"
COHORT = "CODIGO_BARRIO, NOMBRE_BARRIO, CODIGO_LOCALIDAD, NOMBRE_LOCALIDAD, CLASE_PREDIO, ESTRATO, ANO"

_INDEX = "CASE " + " ".join(f"WHEN {{year}} = {y} THEN {_real(f)}" for y, f in DEFLATORS.items()) + " ELSE {other} END"


def _m2(offer: str) -> str:
    return f"CASE WHEN TIPO_OFERTA = '{offer}' THEN VALOR_M2_INTEGRAL END"


# further steps, each a WITH entry: name -> (views it needs, steps it needs, SQL)
STEPS = {
    "urban": (["offers"], [], """SELECT * FROM offers WHERE CODIGO_BARRIO LIKE '0%' AND AREA_CONSTRUIDA > 0
        AND BARMANPRE IS NOT NULL AND ESTRATO > 0 AND TIPO_INMUEBLE IN ('APARTAMENTO', 'CASA')"""),
    "census": (["fee_census"], [], """SELECT substr(BARMANPRE_AJUSTADO, 1, 6) AS SECTOR, ESTRATO AS E,
        VALOR_ADMINISTRACION_MODA AS FEE, BARMANPRE_AJUSTADO AS LOT FROM fee_census"""),
    "med2": ([], ["census"], "SELECT SECTOR, E, median(FEE) AS M FROM census GROUP BY SECTOR, E"),
    "med1": ([], ["census"], "SELECT SECTOR, median(FEE) AS M FROM census GROUP BY SECTOR"),
    "cascade": ([], ["urban", "census", "med2", "med1"], """SELECT u.*, CASE WHEN TIPO_INMUEBLE = 'CASA' THEN 0
        ELSE coalesce(CASE WHEN VALOR_ADMINISTRACION > 10000 THEN VALOR_ADMINISTRACION END, c.FEE, med2.M, med1.M, 0)
        END AS VALOR_ADMON
        FROM urban u LEFT JOIN (SELECT DISTINCT LOT, FEE FROM census) c ON u.BARMANPRE = c.LOT
        LEFT JOIN med2 ON u.CODIGO_BARRIO = med2.SECTOR AND u.ESTRATO = med2.E
        LEFT JOIN med1 ON u.CODIGO_BARRIO = med1.SECTOR WHERE PRECIO > 0"""),
    "pivoted": ([], ["urban"], f"""SELECT {COHORT},
        avg({_m2('ARRIENDO')}) AS PRECIO_MEAN_ARRIENDO, avg({_m2('VENTA')}) AS PRECIO_MEAN_VENTA,
        nullif(count({_m2('ARRIENDO')}), 0) AS N_ARRIENDO, nullif(count({_m2('VENTA')}), 0) AS N_VENTA
        FROM urban GROUP BY {COHORT}"""),
    "cohorts": ([], ["pivoted"], "SELECT * FROM pivoted WHERE PRECIO_MEAN_ARRIENDO IS NOT NULL OR N_VENTA > 5"),
    "rent_loc": ([], ["urban"], """SELECT CODIGO_LOCALIDAD, CLASE_PREDIO, ESTRATO, ANO,
        avg(VALOR_M2_INTEGRAL) AS MEAN_ARRIENDO_LOC FROM urban WHERE TIPO_OFERTA = 'ARRIENDO'
        GROUP BY CODIGO_LOCALIDAD, CLASE_PREDIO, ESTRATO, ANO"""),
    "sold": (["cadastral"], ["cohorts"], """SELECT c.* EXCLUDE (PRECIO_MEAN_VENTA),
        coalesce(c.PRECIO_MEAN_VENTA, k.VALOR_INTEGRAL) AS PRECIO_MEAN_VENTA, k.VALOR_INTEGRAL
        FROM cohorts c JOIN cadastral k ON c.CODIGO_BARRIO = k.CODIGO_BARRIO AND c.CLASE_PREDIO = k.CLASE_PREDIO
        AND c.ESTRATO = k.CODIGO_ESTRATO AND c.ANO = k.VIGENCIA"""),
    "imputed": ([], ["sold", "rent_loc"], """SELECT s.* EXCLUDE (PRECIO_MEAN_ARRIENDO),
        coalesce(s.PRECIO_MEAN_ARRIENDO, r.MEAN_ARRIENDO_LOC) AS PRECIO_MEAN_ARRIENDO
        FROM sold s LEFT JOIN rent_loc r USING (CODIGO_LOCALIDAD, CLASE_PREDIO, ESTRATO, ANO)"""),
    "split": ([], ["imputed"], """SELECT *, PRECIO_MEAN_VENTA / PRECIO_MEAN_ARRIENDO AS RATIO,
        CASE WHEN PRECIO_MEAN_VENTA / PRECIO_MEAN_ARRIENDO >= 100 AND PRECIO_MEAN_VENTA / PRECIO_MEAN_ARRIENDO < 300
          THEN 'in' WHEN PRECIO_MEAN_VENTA / PRECIO_MEAN_ARRIENDO < 100
          OR PRECIO_MEAN_VENTA / PRECIO_MEAN_ARRIENDO > 300 THEN 'out' END AS SPLIT FROM imputed"""),
    "flats": ([], ["split"], """SELECT *, PRECIO_MEAN_ARRIENDO AS x, PRECIO_MEAN_VENTA AS y FROM split
        WHERE SPLIT = 'in'"""),
    "beta1": ([], ["flats"], """SELECT CLASE_PREDIO, sum(x * y) / sum(x * x) AS beta, sum(x * x) AS sxx, count(*) AS n
        FROM flats GROUP BY CLASE_PREDIO"""),
    "fit1": ([], ["beta1"], "SELECT *, y - beta * x AS e, x * x / sxx AS h FROM flats JOIN beta1 USING (CLASE_PREDIO)"),
    "slopes": ([], ["flats"], """SELECT CLASE_PREDIO, ESTRATO, sum(x * y) / sum(x * x) AS b, sum(x * x) AS s,
        ESTRATO = min(ESTRATO) OVER (PARTITION BY CLASE_PREDIO) AS base, count(*) OVER (PARTITION BY CLASE_PREDIO) AS p,
        sum(count(*)) OVER (PARTITION BY CLASE_PREDIO) AS n FROM flats GROUP BY CLASE_PREDIO, ESTRATO"""),
    # one slope per stratum. A row moves its own stratum's coefficient; one of the base moves all others the other way,
    # most where the sum of squares is largest
    "by_stratum": ([], ["slopes"], """SELECT f.*, y - b * x AS e, x * x / s AS h, s, base, p, n,
        sum((y - b * x) * (y - b * x)) OVER (PARTITION BY CLASE_PREDIO) AS sse
        FROM flats f JOIN slopes USING (CLASE_PREDIO, ESTRATO)"""),
    "influence": ([], ["by_stratum"], """SELECT CLASE_PREDIO, CODIGO_BARRIO, ESTRATO, ANO, PRECIO_MEAN_ARRIENDO,
        PRECIO_MEAN_VENTA, h, n, p, e * e * h / (p * sse / (n - p) * (1 - h) * (1 - h)) AS cook,
        least(0, own, other) AS low, greatest(0, own, other) AS high
        FROM (SELECT r.*, CASE WHEN base THEN change / sqrt(s) ELSE change / s / sqrt(1 / s + 1 / s0) END AS own,
            CASE WHEN base THEN -change / s / sqrt(1 / s + 1 / s_high) END AS other
          FROM (SELECT *, x * e / ((1 - h) * sqrt((sse - e * e / (1 - h)) / (n - p - 1))) AS change FROM by_stratum) r
          JOIN (SELECT CLASE_PREDIO, max(CASE WHEN base THEN s END) AS s0, max(CASE WHEN NOT base THEN s END) AS s_high
            FROM slopes GROUP BY CLASE_PREDIO) q USING (CLASE_PREDIO))"""),
    "shrunk": ([], ["flats"], f"""SELECT *, {_real(BLUP_THETA)} / (1 + {_real(BLUP_THETA)} * s) AS c
        FROM (SELECT CLASE_PREDIO, CODIGO_BARRIO, sum(x * x) AS s, sum(x * y) AS w, sum(y * y) AS yy, count(*) AS k
          FROM flats GROUP BY CLASE_PREDIO, CODIGO_BARRIO)"""),
    "beta_mixed": ([], ["shrunk"], """SELECT CLASE_PREDIO, (sum(w) - sum(c * w * s)) / (sum(s) - sum(c * s * s)) AS beta
        FROM shrunk GROUP BY CLASE_PREDIO"""),
    "blup": ([], ["beta_mixed"], """SELECT CLASE_PREDIO, CODIGO_BARRIO, beta, c * (w - s * beta) AS RAN_EFFECT
        FROM shrunk JOIN beta_mixed USING (CLASE_PREDIO)"""),
    "residuals": ([], ["blup"], """SELECT f.*, x * (beta + RAN_EFFECT) AS fit, y - x * (beta + RAN_EFFECT) AS e
        FROM flats f JOIN blup USING (CLASE_PREDIO, CODIGO_BARRIO)"""),
    "counts": ([], ["urban"], f"""SELECT {SEG}, CODIGO_BARRIO AS code, count(*) AS n FROM urban
        GROUP BY {SEG}, CODIGO_BARRIO"""),
    "fixed": (["coefs", "ranef"], ["split"], """SELECT d.CODIGO_BARRIO, d.CODIGO_LOCALIDAD, d.ANO, d.ESTRATO,
        r.RAN_EFFECT, (SELECT COEF FROM coefs WHERE FACTOR = 'all') AS Coef_all,
        coalesce(e.COEF, 0) AS Coef_est, coalesce(l.COEF, 0) AS Coef_loc, coalesce(y.COEF, 0) AS Coef_year
        FROM (SELECT DISTINCT CODIGO_BARRIO, CODIGO_LOCALIDAD, ANO, ESTRATO FROM split WHERE SPLIT = 'in') d
        LEFT JOIN ranef r ON d.CODIGO_BARRIO = r.CODIGO_BARRIO
        LEFT JOIN coefs e ON e.FACTOR = 'est' AND e.NIVEL = cast(d.ESTRATO AS varchar)
        LEFT JOIN coefs l ON l.FACTOR = 'loc' AND l.NIVEL = d.CODIGO_LOCALIDAD
        LEFT JOIN coefs y ON y.FACTOR = 'year' AND y.NIVEL = cast(d.ANO AS varchar)"""),
    "rates": ([], ["fixed"], "SELECT *, Coef_all + Coef_est + Coef_loc + Coef_year + RAN_EFFECT AS TASA_RENTA FROM fixed"),
    "joined": (["two_price", "rates_sector", "rates_locality"], [], """SELECT t.*, s.TASA_RENTA AS TASA_SECTOR,
        l.TASA_RENTA AS TASA_LOCALIDAD FROM two_price t
        LEFT JOIN rates_sector s ON t.OFT_TIPO_INMUEBLE = s.OFT_TIPO_INMUEBLE AND t.VIGENCIA = s.ANO
          AND t.CODIGO_BARRIO = s.CODIGO_BARRIO AND t.CODIGO_ESTRATO_SIIC = s.ESTRATO
        LEFT JOIN rates_locality l ON t.OFT_TIPO_INMUEBLE = l.OFT_TIPO_INMUEBLE AND t.VIGENCIA = l.ANO
          AND t.CODIGO_LOCALIDAD = l.CODIGO_LOCALIDAD AND t.CODIGO_ESTRATO_SIIC = l.ESTRATO"""),
    "chosen": ([], ["joined"], """SELECT *, coalesce(TASA_SECTOR, TASA_LOCALIDAD) AS TCR_ESTADISTICA,
        concat(CODIGO_BARRIO, CASE WHEN length(CODIGO_MANZANA) < 2 THEN lpad(CODIGO_MANZANA, 2, '0')
          ELSE CODIGO_MANZANA END, CASE WHEN length(CODIGO_PREDIO) < 2 THEN lpad(CODIGO_PREDIO, 2, '0')
          ELSE CODIGO_PREDIO END) AS BARMANPRE
        FROM joined WHERE coalesce(TASA_SECTOR, TASA_LOCALIDAD) IS NOT NULL"""),
    "netted": ([], ["chosen", "census", "med2", "med1"], f"""SELECT j.* EXCLUDE (VR_INICIAL_ARRIENDO),
        VR_INICIAL_ARRIENDO - (CASE WHEN OFT_TIPO_INMUEBLE = 'CASA' THEN 0
          ELSE coalesce(c.FEE, med2.M, med1.M, 0) END) * {_INDEX.format(year='VIGENCIA', other='0')}
          AS VR_INICIAL_ARRIENDO
        FROM chosen j LEFT JOIN (SELECT DISTINCT LOT, FEE FROM census) c ON j.BARMANPRE = c.LOT
        LEFT JOIN med2 ON j.CODIGO_BARRIO = med2.SECTOR AND j.CODIGO_ESTRATO_SIIC = med2.E
        LEFT JOIN med1 ON j.CODIGO_BARRIO = med1.SECTOR"""),
    "valid": ([], ["netted"], """SELECT *, abs(VR_INICIAL_VENTA - VENTA_ESTIMADA) / AREA_CONSTRUIDA_SIIC AS DIFERENCIAS,
        abs(TCR_ESTADISTICA - TCR_OIC) AS DIFERENCIAS_TCR
        FROM (SELECT *, VR_INICIAL_ARRIENDO / VR_INICIAL_VENTA AS TCR_OIC,
          VR_INICIAL_ARRIENDO / TCR_ESTADISTICA AS VENTA_ESTIMADA FROM netted)
        WHERE TCR_OIC BETWEEN 0.0033::double AND 0.01::double"""),
    "long_prices": (["two_price"], [], """SELECT * EXCLUDE (VR_INICIAL_ARRIENDO, VR_INICIAL_VENTA),
        'ARRIENDO' AS TIPO_OFERTA, VR_INICIAL_ARRIENDO AS PRECIO FROM two_price
        UNION ALL SELECT * EXCLUDE (VR_INICIAL_ARRIENDO, VR_INICIAL_VENTA),
        'VENTA', VR_INICIAL_VENTA FROM two_price"""),
    # two-variable and three-variable T2 by segment, from covariances
    "stats": ([], ["urban"], f"""SELECT {SEG}, count(*) AS m, avg(PRECIO) AS mp, avg(AREA_CONSTRUIDA) AS ma,
        avg(VALOR_M2_INTEGRAL) AS mv, var_samp(PRECIO) AS pp, var_samp(AREA_CONSTRUIDA) AS aa,
        var_samp(VALOR_M2_INTEGRAL) AS vv, covar_samp(PRECIO, AREA_CONSTRUIDA) AS pa,
        covar_samp(PRECIO, VALOR_M2_INTEGRAL) AS pv, covar_samp(VALOR_M2_INTEGRAL, AREA_CONSTRUIDA) AS va
        FROM urban GROUP BY {SEG}"""),
    "chart2": ([], ["urban", "stats"], f"""SELECT {SEG}, IDENTIFICADOR, PRECIO, AREA_CONSTRUIDA,
        (aa * (PRECIO - mp) * (PRECIO - mp) - 2 * pa * (PRECIO - mp) * (AREA_CONSTRUIDA - ma)
          + pp * (AREA_CONSTRUIDA - ma) * (AREA_CONSTRUIDA - ma)) / (pp * aa - pa * pa) AS t2,
        (m - 1) * (m - 1) / m * (1 - pow(1 - 0.9::double, 2.0::double / (m - 3))) AS ucl
        FROM urban JOIN stats USING ({SEG})"""),
}


def _round(tag: str, sizes: str) -> None:
    """Steps of one pooling round over ``sizes`` (segment, code, n): neighbours, the walk along them, and its roots."""
    STEPS[f"pairs{tag}"] = ([], [sizes], f"""SELECT {SEG}, a.code, b.code AS other, b.n AS n_neighbour,
        CASE {' '.join(f"WHEN substr(a.code, 1, {k}) = substr(b.code, 1, {k}) THEN {k}" for k in (5, 4, 3, 2, 1))}
          ELSE 0 END AS prefix_len,
        1 - levenshtein(a.code, b.code) / greatest(length(a.code), length(b.code)) AS similarity
        FROM {sizes} a JOIN {sizes} b USING ({SEG}) WHERE a.n <= 10 AND a.code <> b.code""")
    STEPS[f"neighbours{tag}"] = ([], [f"pairs{tag}"], f"""SELECT {SEG}, code, other AS neighbour, prefix_len, similarity,
        n_neighbour FROM pairs{tag} QUALIFY row_number() OVER (PARTITION BY {SEG}, code
          ORDER BY prefix_len DESC, similarity DESC, n_neighbour DESC, other) = 1""")
    # the walk ends at a sector that is not small or when it meets a known one
    STEPS[f"walk{tag}"] = ([], [f"neighbours{tag}"], f"""SELECT {SEG}, code, neighbour AS place,
          [code, neighbour] AS seen FROM neighbours{tag}
        UNION ALL SELECT w.ANO, w.CLASE_PREDIO, w.ESTRATO, w.TIPO_OFERTA, w.code, s.neighbour,
          list_append(w.seen, s.neighbour)
        FROM walk{tag} w JOIN neighbours{tag} s ON w.ANO = s.ANO AND w.CLASE_PREDIO = s.CLASE_PREDIO
          AND w.ESTRATO = s.ESTRATO AND w.TIPO_OFERTA = s.TIPO_OFERTA AND w.place = s.code
        WHERE len(list_distinct(w.seen)) = len(w.seen)""")
    STEPS[f"roots{tag}"] = ([], [f"walk{tag}"], f"""SELECT {SEG}, code,
        CASE WHEN len(list_distinct(seen)) = len(seen) THEN place
          ELSE list_max(list_slice(seen, list_position(seen, place), len(seen))) END AS root
        FROM walk{tag} QUALIFY row_number() OVER (PARTITION BY {SEG}, code ORDER BY len(seen) DESC) = 1""")


def _pooling(source: str, tag: str, rounds: int = 4) -> str:
    """Steps of the whole pooling of ``source``'s rows, its rounds written out; a round that no segment needs does nothing."""
    STEPS[f"pools{tag}_0"] = ([], [source], f"""SELECT {SEG}, CODIGO_BARRIO AS code, count(*) AS n,
        CODIGO_BARRIO AS pool FROM {source} GROUP BY {SEG}, CODIGO_BARRIO""")
    STEPS[f"sizes{tag}_0"] = ([], [f"pools{tag}_0"], f"SELECT {SEG}, code, n FROM pools{tag}_0")
    for k in range(rounds):
        here, after = f"{tag}_{k}", f"{tag}_{k + 1}"
        _round(here, f"sizes{here}")
        STEPS[f"pools{after}"] = ([], [f"pools{here}", f"roots{here}"], f"""SELECT p.ANO, p.CLASE_PREDIO, p.ESTRATO,
            p.TIPO_OFERTA, p.code, p.n, coalesce(r.root, p.pool) AS pool, coalesce(r.root <> p.pool, false) AS moved
            FROM pools{here} p LEFT JOIN roots{here} r ON p.ANO = r.ANO AND p.CLASE_PREDIO = r.CLASE_PREDIO
              AND p.ESTRATO = r.ESTRATO AND p.TIPO_OFERTA = r.TIPO_OFERTA AND p.pool = r.code""")
        STEPS[f"sizes{after}"] = ([], [f"pools{after}"], f"""SELECT {SEG}, pool AS code, cast(sum(n) AS bigint) AS n
            FROM pools{after} GROUP BY {SEG}, pool
            QUALIFY min(sum(n)) OVER (PARTITION BY {SEG}) < 10 AND count(*) OVER (PARTITION BY {SEG}) > 1
              AND bool_or(bool_or(moved)) OVER (PARTITION BY {SEG})""")
    STEPS[f"pooled{tag}"] = ([], [source, f"pools{tag}_{rounds}"], f"""SELECT u.*, p.pool AS CODIGO_BARRIO_NEW
        FROM {source} u JOIN pools{tag}_{rounds} p ON u.ANO = p.ANO AND u.CLASE_PREDIO = p.CLASE_PREDIO
          AND u.ESTRATO = p.ESTRATO AND u.TIPO_OFERTA = p.TIPO_OFERTA AND u.CODIGO_BARRIO = p.code""")
    return f"pooled{tag}"


def _limits(tag: str, sizes: str) -> str:
    """Steps of the upper limit of each (m, p) in ``sizes``: the beta quantile by bisection of its series."""
    STEPS[f"bisect{tag}"] = ([], [sizes], f"""SELECT DISTINCT cast(m AS double) AS m, cast(p AS double) AS p,
          cast(p AS double) / 2 AS a, (cast(m AS double) - p - 1) / 2 AS b, 0.0::double AS lo, 1.0::double AS hi, 0 AS k
          FROM {sizes} WHERE p > 0 AND m > p + 1
        UNION ALL SELECT m, p, a, b, CASE WHEN cdf < 0.9 THEN (lo + hi) / 2 ELSE lo END,
          CASE WHEN cdf < 0.9 THEN hi ELSE (lo + hi) / 2 END, k + 1
        FROM (SELECT *, exp(a * ln((lo + hi) / 2) + b * ln(1 - (lo + hi) / 2) + lgamma(a + b) - lgamma(a) - lgamma(b)) / a
          * list_sum([exp(lgamma(a + b + j) - lgamma(a + b) + lgamma(a + 1) - lgamma(a + 1 + j) + j * ln((lo + hi) / 2))
            for j in range(0, cast(100 + 40 / -ln((lo + hi) / 2) AS bigint))]) AS cdf FROM bisect{tag} WHERE k < 48)""")
    STEPS[f"limits{tag}"] = ([], [f"bisect{tag}"], f"""SELECT m, p, (m - 1) * (m - 1) / m * (lo + hi) / 2 AS ucl
        FROM bisect{tag} WHERE k = 48""")
    return f"limits{tag}"


def _control(source: str, tag: str) -> tuple[str, str]:
    """Steps of one control pass over ``source``'s rows, by pool and on three measures: scored rows and those kept.

    A pool where a measure does not vary has no limit here; the data have none that is large enough for one.
    """
    pooled = _pooling(source, tag)
    by = f"{SEG}, CODIGO_BARRIO_NEW"
    STEPS[f"moments{tag}"] = ([], [pooled], f"""SELECT {by}, count(*) AS m, 3 AS p, avg(PRECIO) AS mp,
        avg(VALOR_M2_INTEGRAL) AS mv, avg(AREA_CONSTRUIDA) AS ma, stddev_samp(PRECIO) AS sp,
        stddev_samp(VALOR_M2_INTEGRAL) AS sv, stddev_samp(AREA_CONSTRUIDA) AS sa,
        covar_samp(PRECIO, VALOR_M2_INTEGRAL) AS pv, covar_samp(PRECIO, AREA_CONSTRUIDA) AS pa,
        covar_samp(VALOR_M2_INTEGRAL, AREA_CONSTRUIDA) AS va FROM {pooled} GROUP BY {by}""")
    limits = _limits(tag, f"moments{tag}")
    STEPS[f"scored{tag}"] = ([], [limits, f"moments{tag}"], f"""SELECT *, t2 > ucl AND ucl IS NOT NULL AS beyond
        FROM (SELECT *, CASE WHEN sp > 0 AND sv > 0 AND sa > 0 AND m > 4 THEN (
            zp * zp * (1 - c * c) + zv * zv * (1 - b * b) + za * za * (1 - a * a)
            + 2 * zp * zv * (b * c - a) + 2 * zp * za * (a * c - b) + 2 * zv * za * (a * b - c))
            / (1 + 2 * a * b * c - a * a - b * b - c * c) END AS t2
          FROM (SELECT u.*, q.m, l.ucl, sp, sv, sa, (PRECIO - mp) / sp AS zp, (VALOR_M2_INTEGRAL - mv) / sv AS zv,
              (AREA_CONSTRUIDA - ma) / sa AS za, pv / (sp * sv) AS a, pa / (sp * sa) AS b, va / (sv * sa) AS c
            FROM {pooled} u JOIN moments{tag} q USING ({by}) LEFT JOIN {limits} l ON q.m = l.m))""")
    STEPS[f"kept{tag}"] = ([], [f"scored{tag}"], f"""SELECT * EXCLUDE (CODIGO_BARRIO_NEW, m, ucl, sp, sv, sa, zp, zv, za,
        a, b, c, t2, beyond), CODIGO_BARRIO_NEW AS POOL{tag} FROM scored{tag} WHERE NOT beyond""")
    return f"scored{tag}", f"kept{tag}"


_round("", "counts")
_control("urban", "_a")
_control("kept_a", "_b")
STEPS["two_samples"] = (["two_price"], ["urban", "long_prices"], """SELECT OFT_CODIGO AS IDENTIFICADOR, TIPO_OFERTA, PRECIO,
      PRECIO / AREA_CONSTRUIDA_SIIC AS VALOR_M2_INTEGRAL, AREA_CONSTRUIDA_SIIC AS AREA_CONSTRUIDA,
      CODIGO_ESTRATO_SIIC AS ESTRATO, VIGENCIA AS ANO, CLASE_PREDIO_SIIC AS CLASE_PREDIO, CODIGO_BARRIO, 'Test' AS MARCA
    FROM long_prices WHERE substr(CODIGO_BARRIO, 1, 1) NOT IN ('1', '2') AND PRECIO > 0
    UNION ALL SELECT IDENTIFICADOR, TIPO_OFERTA, PRECIO, VALOR_M2_INTEGRAL, AREA_CONSTRUIDA, ESTRATO, ANO,
      CLASE_PREDIO, CODIGO_BARRIO, 'Train' FROM urban""")
_control("two_samples", "_c")
_control("kept_c", "_d")
STEPS["sizes_p2"] = ([], ["urban"], f"""SELECT {SEG}, CODIGO_LOCALIDAD, count(*) AS m,
    CASE WHEN count(*) = 2 AND max(PRECIO) > min(PRECIO) AND max(AREA_CONSTRUIDA) > min(AREA_CONSTRUIDA) THEN 1
      ELSE cast(max(PRECIO) > min(PRECIO) AS int) + cast(max(AREA_CONSTRUIDA) > min(AREA_CONSTRUIDA) AS int) END AS p
    FROM urban GROUP BY ALL""")
_limits("_p2", "sizes_p2")

# three measures under the singularity rule at 1e-12: a pair's reciprocal condition is (1 - r) / (1 + r), that of all three comes
# from the cofactors of the correlation
_TOL = "1e-12::double"
STEPS["spread_p3"] = ([], ["urban"], f"""SELECT {SEG}, CODIGO_LOCALIDAD, count(*) AS m,
    max(PRECIO) > min(PRECIO) AS op, max(VALOR_M2_INTEGRAL) > min(VALOR_M2_INTEGRAL) AS ov,
    max(AREA_CONSTRUIDA) > min(AREA_CONSTRUIDA) AS oa,
    CASE WHEN op AND ov THEN covar_samp(PRECIO, VALOR_M2_INTEGRAL) / (stddev_samp(PRECIO) * stddev_samp(VALOR_M2_INTEGRAL)) END AS a,
    CASE WHEN op AND oa THEN covar_samp(PRECIO, AREA_CONSTRUIDA) / (stddev_samp(PRECIO) * stddev_samp(AREA_CONSTRUIDA)) END AS b,
    CASE WHEN ov AND oa THEN covar_samp(VALOR_M2_INTEGRAL, AREA_CONSTRUIDA)
      / (stddev_samp(VALOR_M2_INTEGRAL) * stddev_samp(AREA_CONSTRUIDA)) END AS c
    FROM urban GROUP BY ALL""")
STEPS["sizes_p3"] = ([], ["spread_p3"], f"""SELECT {SEG}, CODIGO_LOCALIDAD, m,
    CASE WHEN NOT (op AND ov AND oa) THEN least(cast(op AS int) + cast(ov AS int) + cast(oa AS int),
        CASE WHEN (1 - abs(coalesce(a, b, c, 0))) / (1 + abs(coalesce(a, b, c, 0))) < {_TOL} THEN 1 ELSE 2 END)
      WHEN (1 - abs(a)) / (1 + abs(a)) < {_TOL} THEN 1
      WHEN least(1 - abs(b), 1 - abs(c)) / 2 < {_TOL} OR abs(1 + 2 * a * b * c - a * a - b * b - c * c)
        / greatest(1 + abs(a) + abs(b), 1 + abs(a) + abs(c), 1 + abs(b) + abs(c))
        / greatest(1 - c * c + abs(b * c - a) + abs(a * c - b), 1 - b * b + abs(b * c - a) + abs(a * b - c),
          1 - a * a + abs(a * c - b) + abs(a * b - c)) < {_TOL} THEN 2
      ELSE 3 END AS p FROM spread_p3""")
_limits("_p3", "sizes_p3")


def _sql(body: str, views: tuple[str, ...] = (), steps: tuple[str, ...] = ()) -> str:
    """``body`` behind every view and step it needs, in order."""
    ordered: list[str] = []
    needed = list(views)

    def add(step: str) -> None:
        for before in STEPS[step][1]:
            add(before)
        if step not in ordered:
            needed.extend(STEPS[step][0])
            ordered.append(step)

    for step in steps:
        add(step)
    # a step used twice is computed once; a recursive one has to stay as it is
    parts = ",\n".join(f"{s} AS {'' if s.startswith(RECURSIVE) else 'MATERIALIZED '}({STEPS[s][2]})" for s in ordered)
    if not needed:
        return body
    head = with_views(list(dict.fromkeys(needed)), "").rstrip()
    if any(s.startswith(RECURSIVE) for s in ordered):
        head = head.replace("WITH ", "WITH RECURSIVE ", 1)
    return head + (",\n" + parts if parts else "") + "\n" + body


def oracle(name: str, body: str, views: tuple[str, ...] = (), steps: tuple[str, ...] = ()) -> None:
    ORACLES[name] = _sql(body, views, steps)


# ---- sources and cleaning ------------------------------------------------------------------------------

oracle("src_listings", "SELECT * FROM listings", ("listings",))
_LAST = "substr(IDENTIFICADOR, length(IDENTIFICADOR), 1)"
_MARKED = f"""SELECT *, CASE WHEN {_LAST} = '2' THEN 'ESTRATO,ANO' WHEN {_LAST} IN ('4', '5') THEN 'CAMPOS'
    WHEN {_LAST} = '6' THEN 'CODIFICACION' END AS MOTIVOS FROM listings"""
oracle("src_accepted", f"SELECT * EXCLUDE (MOTIVOS) FROM ({_MARKED}) WHERE MOTIVOS IS NULL", ("listings",))
oracle("src_rejected", f"""SELECT IDENTIFICADOR, TIPO_OFERTA, PRECIO,
    CASE WHEN MOTIVOS = 'ESTRATO,ANO' THEN NULL ELSE ANO END AS ANO, MOTIVOS FROM ({_MARKED}) WHERE MOTIVOS IS NOT NULL""",
       ("listings",))
oracle("src_rejected_counts", f"""SELECT unnest(string_split(MOTIVOS, ',')) AS MOTIVO, count(*) AS N FROM ({_MARKED})
    GROUP BY 1""", ("listings",))
oracle("src_cadastral", "SELECT * FROM cadastral", ("cadastral",))
oracle("src_normalised_names", """SELECT CODIGO_BARRIO, ANO, VALOR_M2_INTEGRAL AS VALOR_M2_INTEGRAL, PRECIO,
    ESTRATO AS PRECIO_2 FROM offers""", ("offers",))
oracle("clean_filter_type", """SELECT IDENTIFICADOR, TIPO_INMUEBLE,
    CASE WHEN NOMBRE_FUENTE = 'src2' THEN ESTRATO - 1 ELSE ESTRATO END AS ESTRATO
    FROM offers WHERE NOMBRE_FUENTE <> 'src3' AND NOT (NOMBRE_FUENTE = 'src2' AND ESTRATO = 1)""", ("offers",))
oracle("clean_parse_price", "SELECT IDENTIFICADOR, PRECIO FROM offers", ("offers",))
oracle("clean_parse_fee", """SELECT IDENTIFICADOR,
    CASE WHEN VALOR_ADMINISTRACION > 10000 THEN VALOR_ADMINISTRACION END AS VALOR_ADMINISTRACION FROM offers""",
       ("offers",))
oracle("clean_pad_codes", "SELECT IDENTIFICADOR, CODIGO_BARRIO, BARMANPRE FROM offers", ("offers",))
oracle("clean_exclusions", "SELECT IDENTIFICADOR, CODIGO_BARRIO, BARMANPRE, AREA_CONSTRUIDA, ESTRATO FROM urban",
       steps=("urban",))
oracle("clean_segment_key", """SELECT concat(ANO, '_', CLASE_PREDIO, '_', ESTRATO, '_', TIPO_OFERTA) AS "key",
    count(*) AS N FROM offers GROUP BY 1""", ("offers",))
oracle("fee_median_sector", "SELECT SECTOR AS CODIGO_BARRIO, M AS MEDIANA_ADMON_2 FROM med1", steps=("med1",))
oracle("fee_median_stratum", "SELECT SECTOR AS CODIGO_BARRIO, E AS ESTRATO, M AS MEDIANA_ADMON FROM med2",
       steps=("med2",))
oracle("join_fee_lot", """SELECT IDENTIFICADOR, BARMANPRE, FEE AS VALOR_ADMINISTRACION_MODA
    FROM urban LEFT JOIN (SELECT DISTINCT LOT, FEE FROM census) ON BARMANPRE = LOT""", steps=("urban", "census"))
oracle("lots_with_several_fees", """SELECT BARMANPRE_AJUSTADO AS BARMANPRE, cast(2 AS bigint) AS FEES
    FROM fee_census WHERE ESTRATO = 4 AND VALOR_ADMINISTRACION_MODA <> 0""", ("fee_census",))
oracle("fee_cascade", "SELECT IDENTIFICADOR, CODIGO_BARRIO, ESTRATO, TIPO_INMUEBLE, VALOR_ADMON FROM cascade",
       steps=("cascade",))
_IPC = f"VALOR_ADMON * {_INDEX.format(year='ANO', other='1')}"
oracle("fee_indexed", f"SELECT IDENTIFICADOR, ANO, {_IPC} AS VALOR_ADMON_IPC FROM cascade", steps=("cascade",))
_NET = f"CASE WHEN TIPO_OFERTA = 'ARRIENDO' THEN PRECIO - {_IPC} ELSE PRECIO END"
oracle("price_net", f"SELECT IDENTIFICADOR, TIPO_OFERTA, {_NET} AS PRECIO FROM cascade WHERE {_NET} > 0",
       steps=("cascade",))
oracle("clean_listings", """SELECT IDENTIFICADOR, CODIGO_BARRIO, BARMANPRE, PRECIO, AREA_CONSTRUIDA, VALOR_ADMON,
    concat(ANO, '_', CLASE_PREDIO, '_', ESTRATO, '_', TIPO_OFERTA) AS "key" FROM cascade""", steps=("cascade",))
oracle("value_per_m2", "SELECT IDENTIFICADOR, PRECIO / AREA_CONSTRUIDA AS VALOR_M2 FROM offers", ("offers",))
oracle("fill_segment_mean", f"""SELECT IDENTIFICADOR,
    coalesce(AREA_CONSTRUIDA, avg(AREA_CONSTRUIDA) OVER (PARTITION BY {SEG})) AS AREA_CONSTRUIDA FROM offers""",
       ("offers",))
oracle("fill_zero", "SELECT IDENTIFICADOR, coalesce(VALOR_ADMINISTRACION, 0) AS VALOR_ADMINISTRACION FROM offers",
       ("offers",))
oracle("code_similarity", """SELECT IDENTIFICADOR, CODIGO_BARRIO, 1 - levenshtein(IDENTIFICADOR, CODIGO_BARRIO)
    / greatest(length(IDENTIFICADOR), length(CODIGO_BARRIO)) AS SIMILITUD FROM offers""", ("offers",))
_PREFIX = " ".join(f"WHEN substr(CODIGO_BARRIO, 1, {k}) = substr(other, 1, {k}) THEN {k}" for k in (5, 4, 3, 2, 1))
oracle("code_prefix_len", f"""SELECT IDENTIFICADOR, CODIGO_BARRIO, CASE {_PREFIX} ELSE 0 END AS PREFIJO
    FROM (SELECT *, CASE WHEN length(IDENTIFICADOR) < 8 THEN lpad(IDENTIFICADOR, 8, '0') ELSE IDENTIFICADOR END
      AS other FROM offers)""", ("offers",))
oracle("fmt_counts", """SELECT CODIGO_LOCALIDAD, TIPO_OFERTA,
    replace(format('{:,}', cast(sum(PRECIO) AS bigint)), ',', '.') AS TOTAL,
    replace(format('{:,}', count(*)), ',', '.') AS N FROM offers GROUP BY ALL""", ("offers",))
oracle("val_lot_id", """SELECT OFT_CODIGO, concat(CODIGO_BARRIO, right(concat('0', CODIGO_MANZANA), 2),
    right(concat('0', CODIGO_PREDIO), 2)) AS BARMANPRE,
    concat(CODIGO_BARRIO, CODIGO_MANZANA, CODIGO_PREDIO) AS BARMANPRE_2 FROM two_price""", ("two_price",))
oracle("exclusion_counts", """SELECT 'Rurales' AS EXCLUSION, count(*) AS N FROM offers WHERE CODIGO_BARRIO[1] IN ('1', '2')
    UNION ALL SELECT 'Sin área', count(*) FROM offers WHERE AREA_CONSTRUIDA IS NULL OR AREA_CONSTRUIDA = 0
    UNION ALL SELECT 'Sin Barmanpre', count(*) FROM offers WHERE BARMANPRE IS NULL OR BARMANPRE = ''
    UNION ALL SELECT 'Sin estrato', count(*) FROM offers WHERE ESTRATO = 0""", ("offers",))
oracle("funnel_counts", """SELECT 'total' AS PASO, count(*) AS N FROM offers
    UNION ALL SELECT 'residencial', count(*) FROM offers WHERE TIPO_INMUEBLE IN ('APARTAMENTO', 'CASA')
    UNION ALL SELECT 'depurada', count(*) FROM urban""", steps=("urban",))


def _listing_counts() -> str:
    cols = {"NOMBRE_FUENTE": "varchar", "TIPO_INMUEBLE": "varchar", "ESTRATO": "double", "ANO": "double",
            "TIPO_OFERTA": "varchar", "CLASE_PREDIO": "varchar"}
    sets = [["NOMBRE_FUENTE"], ["TIPO_INMUEBLE"], ["TIPO_INMUEBLE", "ESTRATO"], ["ANO", "NOMBRE_FUENTE"],
            ["ANO", "TIPO_OFERTA"], ["ANO", "CLASE_PREDIO"], ["ANO", "TIPO_INMUEBLE"],
            ["ANO", "TIPO_OFERTA", "NOMBRE_FUENTE"]]
    parts = []
    for s in sets:
        shown = ", ".join(f"cast({c if c in s else 'NULL'} AS {k}) AS {c}" for c, k in cols.items())
        base = "offers" if s == ["NOMBRE_FUENTE"] else "urban"
        parts.append(f"SELECT {shown}, '{'+'.join(s)}' AS GRUPO, count(*) AS N FROM {base} "
                     + ("WHERE TIPO_INMUEBLE IN ('APARTAMENTO', 'CASA') " if s == ["TIPO_INMUEBLE", "ESTRATO"] else "")
                     + f"GROUP BY {', '.join(f'{base}.{c}' for c in s)}"
                     + (" HAVING count(*) > 2000" if s in (["TIPO_INMUEBLE"], ["ANO", "TIPO_INMUEBLE"]) else ""))
    return "\nUNION ALL ".join(parts)


oracle("listing_counts", _listing_counts(), ("offers",), steps=("urban",))
oracle("distinct_count_per_group", """SELECT CODIGO_BARRIO, CLASE_PREDIO, count(DISTINCT BARMANPRE) AS N
    FROM offers GROUP BY ALL""", ("offers",))

# ---- cohorts -------------------------------------------------------------------------------------------

for _name, _stat in (("cohort_summary_mean", "avg"), ("cohort_summary_median", "median")):
    oracle(_name, f"""SELECT {COHORT}, TIPO_OFERTA, count(*) AS N, {_stat}(VALOR_M2_INTEGRAL) AS PRECIO_MEAN
        FROM urban GROUP BY ALL""", steps=("urban",))
_N_DOUBLE = "* REPLACE (cast(N_ARRIENDO AS double) AS N_ARRIENDO, cast(N_VENTA AS double) AS N_VENTA)"
oracle("cohort_pivot", f"SELECT {_N_DOUBLE} FROM pivoted", steps=("pivoted",))
oracle("cohort_keep", f"SELECT {_N_DOUBLE} FROM cohorts", steps=("cohorts",))
oracle("cohort_keep_median", f"""SELECT {_N_DOUBLE} FROM (SELECT {COHORT},
    median({_m2('ARRIENDO')}) AS PRECIO_MEAN_ARRIENDO, median({_m2('VENTA')}) AS PRECIO_MEAN_VENTA,
    nullif(count({_m2('ARRIENDO')}), 0) AS N_ARRIENDO, nullif(count({_m2('VENTA')}), 0) AS N_VENTA
    FROM urban GROUP BY {COHORT}) WHERE N_ARRIENDO IS NOT NULL OR N_VENTA > 5""", steps=("urban",))
oracle("locality_rent_mean", "SELECT * FROM rent_loc", steps=("rent_loc",))
oracle("locality_rent_mean_all_years", """SELECT CODIGO_LOCALIDAD, CLASE_PREDIO, ESTRATO,
    avg(VALOR_M2_INTEGRAL) AS MEAN_ARRIENDO_LOC FROM urban WHERE TIPO_OFERTA = 'ARRIENDO' GROUP BY ALL""",
       steps=("urban",))
oracle("impute_sale", """SELECT CODIGO_BARRIO, CLASE_PREDIO, ESTRATO, ANO, PRECIO_MEAN_VENTA, VALOR_INTEGRAL
    FROM sold""", steps=("sold",))
oracle("impute_rent", """SELECT CODIGO_BARRIO, CLASE_PREDIO, ESTRATO, ANO,
    coalesce(PRECIO_MEAN_ARRIENDO, MEAN_ARRIENDO_LOC) AS PRECIO_MEAN_ARRIENDO
    FROM cohorts LEFT JOIN rent_loc USING (CODIGO_LOCALIDAD, CLASE_PREDIO, ESTRATO, ANO)""",
       steps=("cohorts", "rent_loc"))
oracle("ratio_split", "SELECT CODIGO_BARRIO, CLASE_PREDIO, ESTRATO, ANO, RATIO, SPLIT FROM split", steps=("split",))
oracle("rejected_rows", """SELECT u.IDENTIFICADOR, u.CODIGO_BARRIO, u.ANO, u.CLASE_PREDIO, u.ESTRATO, u.PRECIO, s.RATIO
    FROM urban u JOIN split s USING (CODIGO_BARRIO, ANO, CLASE_PREDIO, ESTRATO) WHERE s.SPLIT = 'out'""",
       steps=("split",))
oracle("cohorts_without_rent", """SELECT c.CODIGO_BARRIO, CLASE_PREDIO, ESTRATO, c.ANO, c.PRECIO_MEAN_VENTA, c.N_VENTA,
    r.MEAN_ARRIENDO_LOC FROM cohorts c LEFT JOIN (SELECT CODIGO_LOCALIDAD, CLASE_PREDIO, ESTRATO,
      avg(VALOR_M2_INTEGRAL) AS MEAN_ARRIENDO_LOC FROM urban WHERE TIPO_OFERTA = 'ARRIENDO' GROUP BY ALL) r
    USING (CODIGO_LOCALIDAD, CLASE_PREDIO, ESTRATO) WHERE c.PRECIO_MEAN_ARRIENDO IS NULL""", steps=("cohorts",))
oracle("cohort_coverage", """SELECT CLASE_PREDIO, cast(ANO AS double) AS ANO, cast(ESTRATO AS double) AS ESTRATO,
    cast(grouping(CLASE_PREDIO) AS int) AS TOTAL, count(*) AS SECTORES,
    cast(coalesce(sum(N_ARRIENDO), 0) AS bigint) AS OFERTAS_ARRIENDO,
    cast(coalesce(sum(N_VENTA), 0) AS bigint) AS OFERTAS_VENTA
    FROM split WHERE SPLIT = 'in' GROUP BY GROUPING SETS ((CLASE_PREDIO, ANO, ESTRATO), ())""", steps=("split",))

# ---- pooling -------------------------------------------------------------------------------------------

oracle("seg_sector_counts", "SELECT * FROM counts", steps=("counts",))
oracle("pool_small", "SELECT * FROM counts WHERE n <= 10", steps=("counts",))
oracle("pool_neighbor", "SELECT * FROM neighbours", steps=("neighbours",))
oracle("pool_root_round1", "SELECT * FROM roots", steps=("roots",))
oracle("pool_assign_round1", f"""SELECT {SEG}, coalesce(root, code) AS pool, cast(sum(n) AS bigint) AS n,
    count(*) AS sectors FROM counts LEFT JOIN roots USING ({SEG}, code) GROUP BY ALL""", steps=("counts", "roots"))
oracle("pool_assign", f"""SELECT {SEG}, CODIGO_BARRIO_NEW, count(*) AS N FROM pooled_a GROUP BY ALL""",
       steps=("pooled_a",))

# ---- control chart -------------------------------------------------------------------------------------

oracle("pool_constant_cols", f"""SELECT {SEG}, CODIGO_BARRIO, min(PRECIO) = max(PRECIO) AS PRECIO_CONSTANT,
    min(VALOR_M2_INTEGRAL) = max(VALOR_M2_INTEGRAL) AS VALOR_M2_INTEGRAL_CONSTANT,
    min(AREA_CONSTRUIDA) = max(AREA_CONSTRUIDA) AS AREA_CONSTRUIDA_CONSTANT FROM urban GROUP BY ALL""",
       steps=("urban",))
_SPREAD = """round(sqrt(pp) / 1e6, 7) AS sd0, round(sqrt(vv) / 1e6, 7) AS sd1, round(sqrt(aa), 7) AS sd2,
    round(pv / sqrt(pp * vv), 7) + 0 AS r01, round(pa / sqrt(pp * aa), 7) + 0 AS r02,
    round(va / sqrt(vv * aa), 7) + 0 AS r12"""
oracle("pool_moments", f"SELECT {SEG}, m AS n, mp AS mean0, mv AS mean1, ma AS mean2, {_SPREAD} FROM stats",
       steps=("stats",))
oracle("pool_moments_merged", f"SELECT {SEG}, m AS n, {_SPREAD} FROM stats", steps=("stats",))
oracle("t2_statistic_p2", f"SELECT IDENTIFICADOR, {SEG}, PRECIO, round(t2, 5) AS t2 FROM chart2", steps=("chart2",))
oracle("t2_statistic_p3", f"""SELECT IDENTIFICADOR, {SEG}, PRECIO, round((
      zp * zp * (1 - c * c) + zv * zv * (1 - b * b) + za * za * (1 - a * a)
      + 2 * zp * zv * (b * c - a) + 2 * zp * za * (a * c - b) + 2 * zv * za * (a * b - c))
      / (1 + 2 * a * b * c - a * a - b * b - c * c), 5) AS t2
    FROM (SELECT IDENTIFICADOR, {SEG}, PRECIO, (PRECIO - mp) / sqrt(pp) AS zp,
      (VALOR_M2_INTEGRAL - mv) / sqrt(vv) AS zv, (AREA_CONSTRUIDA - ma) / sqrt(aa) AS za,
      pv / sqrt(pp * vv) AS a, pa / sqrt(pp * aa) AS b, va / sqrt(vv * aa) AS c
      FROM urban JOIN stats USING ({SEG}))""", steps=("stats",))
oracle("t2_limit_p2", f"""SELECT {SEG}, CODIGO_LOCALIDAD, g.m AS n, g.p, round(ucl, 6) AS ucl
    FROM sizes_p2 g LEFT JOIN limits_p2 l ON g.m = l.m AND g.p = l.p""", steps=("sizes_p2", "limits_p2"))
oracle("t2_limit_scaled", f"""SELECT {SEG}, CODIGO_LOCALIDAD, g.m AS n, g.p, round(ucl, 6) AS ucl
    FROM sizes_p3 g LEFT JOIN limits_p3 l ON g.m = l.m AND g.p = l.p""", steps=("sizes_p3", "limits_p3"))
oracle("t2_flags_p2", f"SELECT IDENTIFICADOR, {SEG}, PRECIO, AREA_CONSTRUIDA FROM chart2 WHERE t2 > ucl",
       steps=("chart2",))
oracle("chart_points", f"""SELECT {SEG}, row_number() OVER (PARTITION BY {SEG}
      ORDER BY IDENTIFICADOR, PRECIO, AREA_CONSTRUIDA) AS label, IDENTIFICADOR, round(t2, 5) AS t2,
    round(ucl, 5) AS ucl, CASE WHEN t2 > ucl THEN 'out' ELSE 'in' END AS "out" FROM chart2""", steps=("chart2",))

oracle("chart_first_group", f"""SELECT {SEG}, CODIGO_BARRIO_NEW,
    row_number() OVER (ORDER BY IDENTIFICADOR, PRECIO, AREA_CONSTRUIDA) AS label, IDENTIFICADOR, round(t2, 5) AS t2,
    round(ucl, 5) AS ucl, CASE WHEN beyond THEN 'out' ELSE 'in' END AS "out" FROM scored_a
    WHERE (ANO, CLASE_PREDIO, ESTRATO, TIPO_OFERTA, CODIGO_BARRIO_NEW) = (
      SELECT (ANO, CLASE_PREDIO, ESTRATO, TIPO_OFERTA, CODIGO_BARRIO_NEW) FROM scored_a
      ORDER BY {SEG}, CODIGO_BARRIO_NEW LIMIT 1)""", steps=("scored_a",))
oracle("qc_pass_pools", f"""SELECT {SEG}, CODIGO_BARRIO_NEW, count(*) AS N, count(*) FILTER (beyond) AS "OUT",
    round(any_value(ucl), 6) AS UCL FROM scored_a GROUP BY {SEG}, CODIGO_BARRIO_NEW""", steps=("scored_a",))
oracle("qc_two_pass_rows", f"""SELECT IDENTIFICADOR, {SEG}, CODIGO_BARRIO, POOL_b AS CODIGO_BARRIO_NEW, PRECIO,
    AREA_CONSTRUIDA FROM kept_b""", steps=("kept_b",))

# ---- models --------------------------------------------------------------------------------------------

_LEVELS = [("ESTRATO", v) for v in (2, 3, 4, 5)] + [("ANO", v) for v in (2018, 2019, 2020)] + [
    ("CODIGO_LOCALIDAD", v) for v in range(1, 24)]
oracle("onehot", "SELECT CLASE_PREDIO, CODIGO_BARRIO, ESTRATO, ANO, " + ", ".join(
    f"cast(CASE WHEN {f} = '{v}' THEN 1 ELSE 0 END AS int) AS {f}{v}" for f, v in _LEVELS) + " FROM flats",
       steps=("flats",))
oracle("ols_origin_p1", "SELECT CLASE_PREDIO, 'all' AS FACTOR, '' AS NIVEL, round(beta, 6) AS COEF FROM beta1",
       steps=("beta1",))
oracle("ols_one_factor", """SELECT CLASE_PREDIO, CASE WHEN base THEN 'all' ELSE 'est' END AS FACTOR,
    CASE WHEN base THEN '' ELSE cast(ESTRATO AS varchar) END AS NIVEL,
    round(b - CASE WHEN base THEN 0 ELSE b0 END, 6) + 0 AS COEF
    FROM slopes JOIN (SELECT CLASE_PREDIO, b AS b0 FROM slopes WHERE base) USING (CLASE_PREDIO)""", steps=("slopes",))
oracle("ols_normal_equations", "UNION ALL ".join(
    f"""SELECT DISTINCT CLASE_PREDIO, '{f}' AS FACTOR, {v} AS NIVEL, 0.0::double AS RELATIVE FROM flats
    """ for f, v in (("all", "''"), ("ESTRATO", "cast(ESTRATO AS varchar)"), ("CODIGO_LOCALIDAD", "CODIGO_LOCALIDAD"),
                     ("ANO", "cast(ANO AS varchar)"))), steps=("flats",))
_SSE1 = "(SELECT CLASE_PREDIO, sum(e * e) AS sse FROM fit1 GROUP BY CLASE_PREDIO)"
_KEYS = "CLASE_PREDIO, CODIGO_BARRIO, ESTRATO, ANO"
oracle("cook_p1", f"""SELECT {_KEYS}, round(h, 9) AS hat,
    round(e * e * h / (sse / (n - 1) * (1 - h) * (1 - h)), 9) AS cook FROM fit1 JOIN {_SSE1} USING (CLASE_PREDIO)""",
       steps=("fit1",))
oracle("dfbetas_p1", f"""SELECT {_KEYS},
    round(x * e / ((1 - h) * sqrt((sse - e * e / (1 - h)) / (n - 2)) * sqrt(sxx)), 8) + 0 AS dfbetas_max
    FROM fit1 JOIN {_SSE1} USING (CLASE_PREDIO)""", steps=("fit1",))
oracle("influence_one_factor", f"""SELECT {_KEYS}, round(h, 7) AS hat, round(cook, 7) AS cook,
    round(low, 7) + 0 AS dfbetas_min, round(high, 7) + 0 AS dfbetas_max FROM influence""", steps=("influence",))
oracle("prune_one_factor", f"""SELECT {_KEYS}, PRECIO_MEAN_ARRIENDO, PRECIO_MEAN_VENTA FROM influence
    WHERE cook < 4.0::double * p / n AND high <= 6 / sqrt(n)""", steps=("influence",))
oracle("lmm_profile_p1", f"""SELECT CLASE_PREDIO, THETA,
    round(-0.5 * ((n - 1) * (ln(2 * pi() * q / (n - 1)) + 1) + logs + ln(a)), 5) AS LOGLIK,
    round(q / (n - 1) / 1e9, 6) AS SIGMA2
    FROM (SELECT CLASE_PREDIO, THETA, n, logs, a, qy - b * b / a AS q FROM (
      SELECT CLASE_PREDIO, THETA, sum(k) AS n, sum(ln(1 + THETA * s)) AS logs,
        sum(s) - sum(THETA / (1 + THETA * s) * s * s) AS a, sum(w) - sum(THETA / (1 + THETA * s) * w * s) AS b,
        sum(yy) - sum(THETA / (1 + THETA * s) * w * w) AS qy
      FROM shrunk, (SELECT unnest([{', '.join(_real(v) for v in THETAS)}]) AS THETA) GROUP BY CLASE_PREDIO, THETA))""",
       steps=("shrunk",))
oracle("lmm_blup_p1", "SELECT CLASE_PREDIO, CODIGO_BARRIO, round(RAN_EFFECT, 6) + 0 AS RAN_EFFECT FROM blup",
       steps=("blup",))
oracle("lmm_fixed_p1", "SELECT CLASE_PREDIO, 'all' AS FACTOR, '' AS NIVEL, round(beta, 6) AS COEF FROM beta_mixed",
       steps=("beta_mixed",))
oracle("lmm_residuals_p1", f"""SELECT {_KEYS}, round(fit, 3) + 0 AS Fitted, round(e, 3) + 0 AS Residuals
    FROM residuals""", steps=("residuals",))
oracle("lmm_residual_boxplot_p1", """SELECT CLASE_PREDIO, ESTRATO, ANO, round(min(e), 3) + 0 AS MINIMO,
    round(quantile_cont(e, 0.25), 3) + 0 AS Q1, round(median(e), 3) + 0 AS MEDIANA,
    round(quantile_cont(e, 0.75), 3) + 0 AS Q3, round(max(e), 3) + 0 AS MAXIMO FROM residuals GROUP BY ALL""",
       steps=("residuals",))
for _name, _step, _value in (("lmm_residual_histogram_p1", "residuals", "e"),
                             ("lmm_random_histogram_p1", "blup", "RAN_EFFECT")):
    oracle(_name, f"""SELECT cast(least(floor(({_value} - lo) / ((hi - lo) / 30)), 29) AS int) AS BIN, count(*) AS N
        FROM {_step}, (SELECT min({_value}) AS lo, max({_value}) AS hi FROM {_step}) GROUP BY 1""", steps=(_step,))

# The search for the variance ratio of the four nested models. A matrix is a list; sweeping its columns in the order of the
# design leaves the residual sum in the last entry and the determinant in the pivots after each model's last column, so one
# recursion serves all four. Four grids, each around the best point of the one before, and the top of a parabola through the
# last one's best points take the place of derivatives.
_GRID = 20


def _grid(number: int) -> str:
    """(class, method, model, theta): 41 points around the best ones so far; at first 0 and 12 decades."""
    models = "(SELECT unnest(['REML', 'ML']) AS METHOD), (SELECT unnest([1, 2, 3, 4]) AS Model)"
    if number == 0:
        return f"""SELECT CLASE_PREDIO, METHOD, Model, theta FROM (SELECT CLASE_PREDIO, scale FROM mm_size), {models},
            (SELECT unnest(range(0, {2 * _GRID + 1})) AS k),
            LATERAL (SELECT CASE WHEN k = 0 THEN 0.0 ELSE 10.0::double ** (-6.6 + 0.3 * k) / scale END AS theta)"""
    step = 0.6 * math.log(10) / _GRID * (2 / _GRID) ** (number - 1)
    return f"""SELECT CLASE_PREDIO, METHOD, Model, CASE WHEN k = 0 THEN best ELSE best * exp(k * {step!r}) END AS theta
        FROM mm_best{number - 1}, (SELECT unnest(range(-{_GRID}, {_GRID + 1})) AS k)"""


def _search_steps(grids: int = 4) -> None:
    STEPS["mm_terms"] = ([], ["flats"], """SELECT CLASE_PREDIO, FACTOR, NIVEL, part,
        cast(row_number() OVER (PARTITION BY CLASE_PREDIO ORDER BY part, NIVEL) - 1 AS int) AS i FROM (
          SELECT DISTINCT CLASE_PREDIO, 'all' AS FACTOR, '' AS NIVEL, 1 AS part FROM flats
          UNION ALL SELECT DISTINCT CLASE_PREDIO, 'est', cast(ESTRATO AS varchar), 2 FROM flats f
            WHERE ESTRATO > (SELECT min(ESTRATO) FROM flats g WHERE g.CLASE_PREDIO = f.CLASE_PREDIO)
          UNION ALL SELECT DISTINCT CLASE_PREDIO, 'loc', CODIGO_LOCALIDAD, 3 FROM flats f
            WHERE CODIGO_LOCALIDAD > (SELECT min(CODIGO_LOCALIDAD) FROM flats g WHERE g.CLASE_PREDIO = f.CLASE_PREDIO)
          UNION ALL SELECT DISTINCT CLASE_PREDIO, 'year', cast(ANO AS varchar), 4 FROM flats f
            WHERE ANO > (SELECT min(ANO) FROM flats g WHERE g.CLASE_PREDIO = f.CLASE_PREDIO))""")
    STEPS["mm_size"] = ([], ["mm_terms"], """SELECT CLASE_PREDIO, N, scale, width, [p1, p2, p3, p4] AS p FROM (
        SELECT CLASE_PREDIO, cast(count(*) + 1 AS int) AS width, cast(count(*) FILTER (part <= 1) AS int) AS p1,
          cast(count(*) FILTER (part <= 2) AS int) AS p2, cast(count(*) FILTER (part <= 3) AS int) AS p3,
          cast(count(*) AS int) AS p4 FROM mm_terms GROUP BY CLASE_PREDIO)
        JOIN (SELECT CLASE_PREDIO, sum(k) AS N, avg(s) AS scale FROM (SELECT CLASE_PREDIO, CODIGO_BARRIO, count(*) AS k,
          sum(x * x) AS s FROM flats GROUP BY ALL) GROUP BY CLASE_PREDIO) USING (CLASE_PREDIO)""")
    # a sector's sums by term; the response is the last one
    STEPS["mm_parts"] = ([], ["mm_size"], """SELECT CLASE_PREDIO, CODIGO_BARRIO, i, sum(u) AS u FROM (
        SELECT f.CLASE_PREDIO, CODIGO_BARRIO, i, x * x AS u FROM flats f JOIN mm_terms t ON t.CLASE_PREDIO = f.CLASE_PREDIO
          AND (FACTOR = 'all' OR FACTOR = 'est' AND NIVEL = cast(ESTRATO AS varchar) OR FACTOR = 'loc' AND
            NIVEL = CODIGO_LOCALIDAD OR FACTOR = 'year' AND NIVEL = cast(ANO AS varchar))
        UNION ALL SELECT CLASE_PREDIO, CODIGO_BARRIO, width - 1, x * y FROM flats JOIN mm_size USING (CLASE_PREDIO))
        GROUP BY ALL""")
    STEPS["mm_products"] = ([], ["mm_parts"], """SELECT a.CLASE_PREDIO, a.i, b.i AS j, c.u AS s, a.u * b.u AS uu
        FROM mm_parts a JOIN mm_parts b USING (CLASE_PREDIO, CODIGO_BARRIO) JOIN mm_parts c USING (CLASE_PREDIO, CODIGO_BARRIO)
        WHERE c.i = 0""")
    STEPS["mm_gram"] = ([], ["mm_size"], """WITH d AS (SELECT f.CLASE_PREDIO, f.rowid AS r, i, x AS v FROM mm_rows f
          JOIN mm_terms t ON t.CLASE_PREDIO = f.CLASE_PREDIO AND (FACTOR = 'all' OR FACTOR = 'est' AND
            NIVEL = cast(ESTRATO AS varchar) OR FACTOR = 'loc' AND NIVEL = CODIGO_LOCALIDAD OR FACTOR = 'year' AND
            NIVEL = cast(ANO AS varchar))
          UNION ALL SELECT CLASE_PREDIO, f.rowid, width - 1, y FROM mm_rows f JOIN mm_size USING (CLASE_PREDIO))
        SELECT a.CLASE_PREDIO, a.i, b.i AS j, sum(a.v * b.v) AS g FROM d a JOIN d b USING (CLASE_PREDIO, r) GROUP BY ALL""")
    STEPS["mm_rows"] = ([], ["flats"], "SELECT *, row_number() OVER () AS rowid FROM flats")
    STEPS["mm_gram"] = ([], ["mm_size", "mm_rows"], STEPS["mm_gram"][2])

    def evaluated(tag: str, grid: str, needs: list[str]) -> None:
        STEPS[f"mm_grid{tag}"] = ([], needs, grid)
        STEPS[f"mm_logs{tag}"] = ([], [f"mm_grid{tag}", "mm_parts"], f"""SELECT CLASE_PREDIO, theta, sum(ln(1 + theta * u)) AS logs
            FROM (SELECT DISTINCT CLASE_PREDIO, theta FROM mm_grid{tag}) JOIN mm_parts USING (CLASE_PREDIO) WHERE i = 0
            GROUP BY ALL""")
        STEPS[f"mm_matrix{tag}"] = ([], [f"mm_logs{tag}", "mm_products", "mm_gram"], f"""SELECT CLASE_PREDIO, theta, width,
            list(m ORDER BY i, j) AS m FROM (
              SELECT g.CLASE_PREDIO, t.theta, z.width, g.i, g.j, g.g - coalesce(h.h, 0) AS m
              FROM (SELECT z.CLASE_PREDIO, a.i, b.i AS j, coalesce(g.g, 0) AS g FROM mm_size z,
                  LATERAL (SELECT unnest(range(0, z.width)) AS i) a, LATERAL (SELECT unnest(range(0, z.width)) AS i) b
                  LEFT JOIN mm_gram g ON g.CLASE_PREDIO = z.CLASE_PREDIO AND g.i = a.i AND g.j = b.i) g
              JOIN mm_logs{tag} t USING (CLASE_PREDIO) JOIN mm_size z USING (CLASE_PREDIO)
              LEFT JOIN (SELECT CLASE_PREDIO, theta, i, j, sum(theta / (1 + theta * s) * uu) AS h
                FROM mm_products JOIN mm_logs{tag} USING (CLASE_PREDIO) GROUP BY ALL) h
                ON h.CLASE_PREDIO = g.CLASE_PREDIO AND h.theta = t.theta AND h.i = g.i AND h.j = g.j) GROUP BY ALL""")
        STEPS[f"sweep_{tag}"] = ([], [f"mm_matrix{tag}"], f"""
            SELECT CLASE_PREDIO, theta, width, 0 AS k, m, 0.0::double AS det FROM mm_matrix{tag}
            UNION ALL SELECT CLASE_PREDIO, theta, width, k + 1, list_transform(range(0, width * width), lambda e: CASE
                WHEN e // width = k AND e % width = k THEN -1 / m[k * width + k + 1]
                WHEN e // width = k THEN m[e + 1] / m[k * width + k + 1]
                WHEN e % width = k THEN m[e + 1] / m[k * width + k + 1]
                ELSE m[e + 1] - m[e // width * width + k + 1] * m[k * width + e % width + 1] / m[k * width + k + 1] END),
              det + ln(m[k * width + k + 1]) FROM sweep_{tag} WHERE k < width - 1""")
        STEPS[f"mm_value{tag}"] = ([], [f"sweep_{tag}"], f"""SELECT g.CLASE_PREDIO, METHOD, Model, g.theta, z.N, z.p[Model] AS P,
              m[-1] / free AS sigma2, m, -0.5 * (free * (ln(2 * pi() * m[-1] / free) + 1) + logs
                + CASE WHEN METHOD = 'REML' THEN det ELSE 0 END) AS loglik
            FROM mm_grid{tag} g JOIN mm_size z USING (CLASE_PREDIO) JOIN mm_logs{tag} l
              ON l.CLASE_PREDIO = g.CLASE_PREDIO AND l.theta = g.theta
            JOIN sweep_{tag} w ON w.CLASE_PREDIO = g.CLASE_PREDIO AND w.theta = g.theta AND w.k = z.p[Model],
            LATERAL (SELECT CASE WHEN METHOD = 'REML' THEN z.N - z.p[Model] ELSE z.N END AS free)""")
        STEPS[f"mm_best{tag}"] = ([], [f"mm_value{tag}"], f"""SELECT CLASE_PREDIO, METHOD, Model,
            arg_max(theta, loglik) AS best FROM mm_value{tag} GROUP BY ALL""")

    for number in range(grids):
        evaluated(str(number), _grid(number), ["mm_size"] if number == 0 else [f"mm_best{number - 1}"])
    group = "PARTITION BY CLASE_PREDIO, METHOD, Model"
    step = 0.6 * math.log(10) / _GRID * (2 / _GRID) ** (grids - 2)
    STEPS["mm_top"] = ([], [f"mm_value{grids - 1}"], f"""SELECT CLASE_PREDIO, METHOD, Model, CASE WHEN theta > 0
          THEN theta * exp(0.5 * {step!r} * (below - above) / (below - 2 * loglik + above)) ELSE theta END AS theta
        FROM (SELECT *, lag(loglik) OVER ({group} ORDER BY theta) AS below, lead(loglik) OVER ({group} ORDER BY theta) AS above
          FROM mm_value{grids - 1}) QUALIFY row_number() OVER ({group} ORDER BY loglik DESC) = 1""")
    evaluated("_top", "SELECT * FROM mm_top", ["mm_top"])
    STEPS["mm_fit"] = ([], ["mm_value_top"], "SELECT * FROM mm_value_top")
    STEPS["mm_beta"] = ([], ["mm_fit"], """SELECT f.CLASE_PREDIO, METHOD, theta, FACTOR, NIVEL, i,
        m[i * width + width] AS beta FROM mm_fit f JOIN mm_size USING (CLASE_PREDIO) JOIN mm_terms USING (CLASE_PREDIO)
        WHERE Model = 4""")


_search_steps()
oracle("lmm_search", """SELECT CLASE_PREDIO, METHOD, Model, P, round(CASE WHEN theta > 0 THEN ln(theta) END, 3) AS LOG_THETA,
    round(sigma2 / 1e9, 2) AS SIGMA2, round(loglik, 5) + 0 AS LOGLIK FROM mm_fit""", steps=("mm_fit",))
oracle("lmm_nested_anova", """SELECT CLASE_PREDIO, METHOD, Model, P + 2 AS df, round(2 * (P + 2) - 2 * loglik, 4) + 0 AS AIC,
    round((P + 2) * ln(CASE WHEN METHOD = 'REML' THEN N - P ELSE N END) - 2 * loglik, 4) + 0 AS BIC,
    round(loglik, 4) + 0 AS logLik, round(2 * abs(loglik - lag(loglik) OVER (PARTITION BY CLASE_PREDIO, METHOD ORDER BY Model)), 4)
      + 0 AS L_Ratio FROM mm_fit""", steps=("mm_fit",))
oracle("lmm_whole_fixed", "SELECT CLASE_PREDIO, METHOD, FACTOR, NIVEL, round(beta, 3) + 0 AS COEF FROM mm_beta",
       steps=("mm_beta",))
oracle("lmm_whole_random", """SELECT CLASE_PREDIO, METHOD, CODIGO_BARRIO, round(theta / (1 + theta * s) * rest, 3) + 0
    AS RAN_EFFECT FROM (SELECT b.CLASE_PREDIO, b.METHOD, b.theta, CODIGO_BARRIO, max(CASE WHEN p.i = 0 THEN u END) AS s,
        max(CASE WHEN p.i = width - 1 THEN u END) - sum(CASE WHEN p.i < width - 1 THEN u * beta ELSE 0 END) AS rest
      FROM mm_parts p JOIN mm_size z USING (CLASE_PREDIO) JOIN (SELECT DISTINCT CLASE_PREDIO, METHOD, theta FROM mm_beta) b
        ON b.CLASE_PREDIO = p.CLASE_PREDIO
      LEFT JOIN mm_beta c ON c.CLASE_PREDIO = p.CLASE_PREDIO AND c.METHOD = b.METHOD AND c.i = p.i
      GROUP BY b.CLASE_PREDIO, b.METHOD, b.theta, CODIGO_BARRIO)""", steps=("mm_parts", "mm_beta"))
oracle("coef_terms", """SELECT 'PRECIO_MEAN_ARRIENDO' AS rowname, cast(NULL AS varchar) AS ESTRATO,
      cast(NULL AS varchar) AS CODIGO_LOCALIDAD, cast(NULL AS varchar) AS ANO, 1 AS Intercepto
    UNION ALL SELECT DISTINCT concat('PRECIO_MEAN_ARRIENDO:ESTRATO', ESTRATO), cast(ESTRATO AS varchar), NULL, NULL, 0
      FROM offers
    UNION ALL SELECT DISTINCT concat('PRECIO_MEAN_ARRIENDO:ANO', ANO), NULL, NULL, cast(ANO AS varchar), 0 FROM offers
    UNION ALL SELECT DISTINCT concat('PRECIO_MEAN_ARRIENDO:CODIGO_LOCALIDAD', CODIGO_LOCALIDAD), NULL,
      CODIGO_LOCALIDAD, NULL, 0 FROM offers""", ("offers",))
oracle("diag_histogram", """SELECT cast(least(floor((VALOR_M2_INTEGRAL - lo) / ((hi - lo) / 30)), 29) AS int) AS BIN,
    count(*) AS N FROM urban, (SELECT min(VALOR_M2_INTEGRAL) AS lo, max(VALOR_M2_INTEGRAL) AS hi FROM urban)
    GROUP BY 1""", steps=("urban",))
for _name in ("diag_boxplot", "diag_boxplot_narrowed"):
    oracle(_name, """SELECT ESTRATO, ANO, min(VALOR_M2_INTEGRAL) AS MINIMO, quantile_cont(VALOR_M2_INTEGRAL, 0.25) AS Q1,
        median(VALOR_M2_INTEGRAL) AS MEDIANA, quantile_cont(VALOR_M2_INTEGRAL, 0.75) AS Q3,
        max(VALOR_M2_INTEGRAL) AS MAXIMO FROM urban GROUP BY ESTRATO, ANO""", steps=("urban",))
oracle("line_by_group", """SELECT ESTRATO, ANO, round(regr_slope(PRECIO_MEAN_VENTA, PRECIO_MEAN_ARRIENDO), 6) + 0
      AS PENDIENTE, round(regr_intercept(PRECIO_MEAN_VENTA, PRECIO_MEAN_ARRIENDO) / 1000, 6) AS INTERCEPTO,
    count(*) AS N FROM split GROUP BY ESTRATO, ANO""", steps=("split",))

# ---- rates ---------------------------------------------------------------------------------------------

oracle("rates_sector", "SELECT * FROM rates", steps=("rates",))
_STRATUM = """SELECT DISTINCT ANO AS A, ESTRATO, round(Coef_all + Coef_est + Coef_year, 2) AS TASA_RENTA,
    round(1 / round(Coef_all + Coef_est + Coef_year, 2), 4) AS TASA_RENTA_2 FROM rates"""
_PLACE = """SELECT DISTINCT ANO AS A, cast(CODIGO_LOCALIDAD AS int) AS CODIGO_LOCALIDAD,
    round(Coef_all + Coef_loc + Coef_year, 2) AS TASA_RENTA,
    round(1 / round(Coef_all + Coef_loc + Coef_year, 2), 4) AS TASA_RENTA_2 FROM rates"""
oracle("rates_stratum", _STRATUM, steps=("rates",))
oracle("rates_low_strata", f"SELECT * FROM ({_STRATUM}) WHERE ESTRATO <= 3", steps=("rates",))
oracle("rates_locality", _PLACE, steps=("rates",))
oracle("rates_locality_named", f"""SELECT p.*, NOMBRE_LOCALIDAD FROM ({_PLACE}) p LEFT JOIN locality l
    ON p.CODIGO_LOCALIDAD = cast(l.CODIGO_LOCALIDAD AS int)""", ("locality",), ("rates",))
oracle("rates_report", f"""SELECT A, ESTRATO, round(1 / TASA_RENTA, 5) AS TASA_RENTA,
    round(round(1 / TASA_RENTA, 5) * 100, 3) AS TASA_PORCENTAJE FROM ({_STRATUM})""", steps=("rates",))
_PUBLISHED = """SELECT ANO, CODIGO_LOCALIDAD, ESTRATO, CODIGO_BARRIO, round(1 / TASA_RENTA, 5) AS TASA_RENTA
    FROM rates"""
oracle("rates_published", _PUBLISHED, steps=("rates",))


def _in_order(body: str, keys: list[str], others: list[str]) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in [*keys, *others])
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS ORDEN FROM ({body})"


oracle("rates_stratum_ordered", _in_order(_STRATUM, ["ESTRATO", "A"], ["TASA_RENTA", "TASA_RENTA_2"]), steps=("rates",))
oracle("rates_locality_ordered", _in_order(_PLACE, ["CODIGO_LOCALIDAD", "A"], ["TASA_RENTA", "TASA_RENTA_2"]), steps=("rates",))
oracle("rates_published_ordered", _in_order("""SELECT DISTINCT ANO, cast(CODIGO_LOCALIDAD AS int) AS CODIGO_LOCALIDAD, ESTRATO,
    round(1 / (Coef_all + Coef_est + Coef_loc + Coef_year), 5) AS TASA_RENTA FROM rates""",
                                            ["CODIGO_LOCALIDAD", "ESTRATO", "ANO"], ["TASA_RENTA"]), steps=("rates",))
oracle("rates_sector_ordered", _in_order("SELECT * FROM rates", ["TASA_RENTA"], [
    "CODIGO_BARRIO", "CODIGO_LOCALIDAD", "ANO", "ESTRATO"]), steps=("rates",))
oracle("cohorts_reloaded", f"SELECT {_N_DOUBLE} FROM cohorts", steps=("cohorts",))
oracle("rates_sector_read_back", f"SELECT *, 'P' AS CLASE FROM ({_PUBLISHED})", steps=("rates",))
oracle("rates_locality_read_back", """SELECT DISTINCT ANO, cast(CODIGO_LOCALIDAD AS int) AS CODIGO_LOCALIDAD, ESTRATO,
    round(1 / (Coef_all + Coef_est + Coef_loc + Coef_year), 5) AS TASA_RENTA, 'P' AS CLASE FROM rates""", steps=("rates",))
oracle("clean_rows_read_back", f"""SELECT {', '.join(SEGMENT)}, count(*) AS N, sum(VALOR_M2_INTEGRAL) AS TOTAL
    FROM urban GROUP BY ALL""", steps=("urban",))
oracle("distinct_rates", """SELECT DISTINCT ANO, cast(CODIGO_LOCALIDAD AS int) AS CODIGO_LOCALIDAD, ESTRATO,
    round(1 / (Coef_all + Coef_est + Coef_loc + Coef_year), 5) AS TASA_RENTA FROM rates""", steps=("rates",))
oracle("val_rates_union", f"""SELECT *, 'CASA' AS OFT_TIPO_INMUEBLE FROM ({_PUBLISHED})
    UNION ALL SELECT *, 'APARTAMENTO' FROM ({_PUBLISHED})""", steps=("rates",))

# ---- validation ----------------------------------------------------------------------------------------

oracle("val_join_rates", "SELECT OFT_CODIGO, TASA_SECTOR, TASA_LOCALIDAD FROM joined", steps=("joined",))
oracle("val_rate_choice", "SELECT OFT_CODIGO, TCR_ESTADISTICA FROM chosen", steps=("chosen",))
oracle("val_plausible", """SELECT OFT_CODIGO, VR_INICIAL_ARRIENDO / VR_INICIAL_VENTA AS TCR_OIC FROM two_price
    WHERE VR_INICIAL_ARRIENDO / VR_INICIAL_VENTA BETWEEN 0.0033::double AND 0.01::double""", ("two_price",))
oracle("val_estimate", """SELECT OFT_CODIGO, VR_INICIAL_ARRIENDO, TCR_ESTADISTICA, TCR_OIC, VENTA_ESTIMADA FROM valid""",
       steps=("valid",))
oracle("val_errors", "SELECT OFT_CODIGO, DIFERENCIAS, DIFERENCIAS_TCR FROM valid", steps=("valid",))
for _name in ("val_summary_grouping_sets", "val_summary_narrowed", "val_tables_read_back"):
    oracle(_name, """SELECT CASE grouping(OFT_TIPO_INMUEBLE, NOMBRE_LOCALIDAD, CODIGO_ESTRATO_SIIC)
          WHEN 0 THEN 'RESUMEN' WHEN 3 THEN 'RESUMEN_CP' WHEN 5 THEN 'RESUMEN_LOC' ELSE 'RESUMEN_EST' END AS NIVEL,
        OFT_TIPO_INMUEBLE, NOMBRE_LOCALIDAD, cast(CODIGO_ESTRATO_SIIC AS double) AS CODIGO_ESTRATO_SIIC,
        count(CODIGO_RESTO) AS NUM_PREDIOS, round(median(DIFERENCIAS), 3) AS ERROR_TOTAL_MEDIO,
        round(median(DIFERENCIAS_TCR), 9) AS DIF_TCR FROM valid
        GROUP BY GROUPING SETS ((OFT_TIPO_INMUEBLE, NOMBRE_LOCALIDAD, CODIGO_ESTRATO_SIIC), (OFT_TIPO_INMUEBLE),
          (NOMBRE_LOCALIDAD), (CODIGO_ESTRATO_SIIC))""", steps=("valid",))
oracle("val_error_bands", "SELECT CASE " + " ".join(
    f"WHEN DIFERENCIAS * 8 > {a!r} AND DIFERENCIAS * 8 < {b!r} THEN '{name}'"
    for a, b, name in zip(ERROR_EDGES, ERROR_EDGES[1:], ERROR_LABELS))
       + " ELSE 'VACIO' END AS CAT_DIFERENCIA, count(*) AS N FROM valid GROUP BY 1", steps=("valid",))
oracle("val_error_quantiles", f"""SELECT PROB, round(q / 1e6, 8) AS MILLONES FROM (
    SELECT unnest([{', '.join(_real(q) for q in ERROR_QUANTILES)}]) AS PROB,
      unnest(quantile_cont(DIFERENCIAS, {ERROR_QUANTILES})) AS q
    FROM valid WHERE OFT_TIPO_INMUEBLE = 'APARTAMENTO')""", steps=("valid",))
oracle("val_corr", "SELECT round(corr(VR_FINAL_VENTA, VENTA_ESTIMADA), 9) AS CORR FROM valid", steps=("valid",))
oracle("second_sample_unpivot", "SELECT OFT_CODIGO, TIPO_OFERTA, PRECIO FROM long_prices", steps=("long_prices",))
oracle("second_sample_union", """SELECT OFT_CODIGO AS IDENTIFICADOR, TIPO_OFERTA, PRECIO,
      PRECIO / AREA_CONSTRUIDA_SIIC AS VALOR_M2_INTEGRAL, AREA_CONSTRUIDA_SIIC AS AREA_CONSTRUIDA,
      CODIGO_ESTRATO_SIIC AS ESTRATO, VIGENCIA AS ANO, CLASE_PREDIO_SIIC AS CLASE_PREDIO,
      concat(CODIGO_BARRIO, CODIGO_MANZANA, CODIGO_PREDIO) AS BARMANPRE, 'Test' AS MARCA FROM long_prices
    UNION ALL SELECT IDENTIFICADOR, TIPO_OFERTA, PRECIO, VALOR_M2_INTEGRAL, AREA_CONSTRUIDA, ESTRATO, ANO,
      CLASE_PREDIO, BARMANPRE, 'Train' FROM urban""", steps=("long_prices", "urban"))
_ALIVE = "SELECT IDENTIFICADOR FROM kept_d WHERE MARCA = 'Test'"
oracle("second_sample_semi", f"""SELECT OFT_CODIGO, VIGENCIA, CODIGO_BARRIO FROM two_price
    WHERE OFT_CODIGO IN ({_ALIVE})""", ("two_price",), ("kept_d",))
oracle("survivors_read_back", f"SELECT * FROM two_price WHERE OFT_CODIGO IN ({_ALIVE})", ("two_price",), ("kept_d",))
oracle("second_sample_inner", f"""SELECT OFT_CODIGO, VIGENCIA, CODIGO_BARRIO FROM two_price
    JOIN ({_ALIVE}) ON OFT_CODIGO = IDENTIFICADOR""", ("two_price",), ("kept_d",))
