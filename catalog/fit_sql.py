"""The fit and transform as one DuckDB statement, generated from a spec.

Written independently of the library: plain CTEs, window functions and joins.
"""

from __future__ import annotations

from urlsift.operators.fit import Spec


def q(c: str) -> str:
    return f'"{c}"'


def fit_ctes(spec: Spec, raw_sql: str, staged_cols: dict[str, str] | None = None,
             pre: str = "", train: str = "split = 'train'") -> str:
    """CTEs raw, cat, catg, staged_all, fills, s0..sN, clip_b, clipped, sc, scaled.

    ``staged_cols`` replaces columns of the raw table when the record's derived
    values are filled; ``pre`` holds CTEs those expressions use.
    """
    rep = staged_cols or {}
    feats = list(spec.features)
    share, cat = spec.category_share, spec.category
    zero = f"CASE WHEN {rep.get(spec.category_zero, q(spec.category_zero))} = 1 THEN 0e0 END," if spec.category_zero else ""
    cols = ", ".join(
        f"{rep[c]} AS {q(c)}" if c in rep else f"r.{q(c)} AS {q(c)}" for c in feats if c != share
    )
    fills = ", ".join(
        f"CASE WHEN abs(skewness({q(c)})) > 3 THEN median({q(c)}) ELSE avg({q(c)}) END AS {q('f_' + c)}"
        for c in spec.numeric
    )
    filled = ", ".join(f"coalesce({q(c)}, {q('f_' + c)}) AS {q(c)}" for c in spec.numeric)
    keys = ", ".join(spec.keys)
    out = [
        f"raw AS MATERIALIZED ({raw_sql})",
        f"tr AS (SELECT * FROM raw WHERE {train})",
    ]
    if pre:
        out.append(pre)
    out += [
        f"cat AS (SELECT {q(cat)} AS ckey, avg({q(share)}) AS cmean FROM tr WHERE {q(cat)} IS NOT NULL GROUP BY 1)",
        f"catg AS (SELECT CASE WHEN abs(skewness({q(share)})) > 1 THEN median({q(share)}) ELSE avg({q(share)}) END AS g, "
        f"skewness({q(share)}) AS sk FROM tr)",
        f"staged_all AS MATERIALIZED (SELECT {', '.join('r.' + k for k in spec.keys)}, r.label, r.split, {cols}, "
        f"coalesce(r.{q(share)}, {zero} cat.cmean, catg.g) AS {q(share)} FROM "
        f"{'derived' if pre else 'raw'} r LEFT JOIN cat ON {rep.get(cat, 'r.' + q(cat))} = cat.ckey, catg)",
        f"fills AS (SELECT {fills} FROM staged_all WHERE {train})",
        f"s0 AS MATERIALIZED (SELECT * REPLACE ({filled}) FROM staged_all, fills)",
    ]
    on = list(spec.cascade_key)
    for i, c in enumerate(spec.cascade_order, start=1):
        grp = ", ".join(q(k) for k in on)
        out.append(
            f"g{i} AS (SELECT {q(c)} AS gm FROM s{i - 1} WHERE {train} AND {q(c)} IS NOT NULL GROUP BY {q(c)} "
            f"ORDER BY count(*) DESC, {q(c)} LIMIT 1)"
        )
        out.append(
            f"m{i} AS MATERIALIZED (SELECT {grp}, {q(c)} AS md FROM (SELECT {grp}, {q(c)}, row_number() OVER "
            f"(PARTITION BY {grp} ORDER BY count(*) DESC, {q(c)}) AS rn FROM s{i - 1} WHERE {train} AND {q(c)} IS NOT NULL "
            f"AND {' AND '.join(q(k) + ' IS NOT NULL' for k in on)} GROUP BY {grp}, {q(c)}) WHERE rn = 1)"
        )
        join = " AND ".join(f"s.{q(k)} = m.{q(k)}" for k in on)
        out.append(
            f"s{i} AS MATERIALIZED (SELECT s.* REPLACE (coalesce(s.{q(c)}, m.md, (SELECT gm FROM g{i}), 0e0) AS {q(c)}), "
            f"s.{q(c)} IS NULL AND m.md IS NULL AS {q('missed_' + c)} FROM s{i - 1} s LEFT JOIN m{i} m ON {join})"
        )
        on.append(c)
    last = f"s{len(spec.cascade_order)}"
    bounds = ", ".join(
        f"quantile_cont({q(c)}, 0.01) AS {q('lo_' + c)}, quantile_cont({q(c)}, 0.99) AS {q('hi_' + c)}"
        for c in spec.numeric
    )
    clipped = {c: f"greatest(least({q(c)}, {q('hi_' + c)}), {q('lo_' + c)})" for c in spec.numeric}
    whole = []
    for c in feats:
        e = clipped.get(c, q(c))
        whole.append(f"CAST(trunc({e}) AS BIGINT) AS {q(c)}" if c in spec.integral else f"{e} AS {q(c)}")
    scale = ", ".join(
        f"avg({q(c)}) AS {q('m_' + c)}, CASE WHEN min({q(c)}) = max({q(c)}) THEN 1e0 ELSE stddev_pop({q(c)}) END AS {q('d_' + c)}"
        for c in spec.numeric
    )
    std = ", ".join(
        f"({q(c)} - {q('m_' + c)}) / {q('d_' + c)} AS {q(c)}" if c in spec.numeric else q(c) for c in feats
    )
    out += [
        f"clip_b AS (SELECT {bounds} FROM {last} WHERE {train})",
        f"clipped AS MATERIALIZED (SELECT {keys}, label, split, {', '.join(whole)} FROM {last}, clip_b)",
        f"sc AS (SELECT {scale} FROM clipped WHERE {train})",
        f"scaled AS MATERIALIZED (SELECT {keys}, label, split, {std} FROM clipped, sc)",
    ]
    return "WITH " + ",\n".join(out)
