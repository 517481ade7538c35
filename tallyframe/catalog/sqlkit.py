"""SQL text builders for the oracle side: least squares by sweeping, tail areas."""

from __future__ import annotations

import math


def sweep(name: str, source: str, xs: list[str], y: str, by: str | None = None) -> str:
    """CTEs ending in ``name``: n, m0.. (means), b0.. (slopes), a (intercept), cij, rss, tss."""
    v, p = [*xs, y], len(xs)
    g = "g, " if by else ""
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
    carried = ["n", *[f"m{i}" for i in range(p + 1)], "tss"]
    out = [
        f"{name}_0 AS (SELECT {by + ' AS g, ' if by else ''}count(*)::DOUBLE AS n, "
        + ", ".join(f"avg({e})::DOUBLE AS m{i}" for i, e in enumerate(v))
        + f", var_pop({y}) * count(*) AS tss, "
        + ", ".join(f"covar_pop({v[i]}, {v[j]}) * count(*) AS s{i}_{j}" for i, j in pairs)
        + f" FROM {source}{' GROUP BY 1' if by else ''})"
    ]

    def s(i, j):
        return f"s{min(i, j)}_{max(i, j)}"

    for k in range(p):
        cells = []
        for i, j in pairs:
            if i == k and j == k:
                e = f"-1 / {s(k, k)}"
            elif k in (i, j):
                e = f"{s(i, j)} / {s(k, k)}"
            else:
                e = f"{s(i, j)} - {s(i, k)} * {s(k, j)} / {s(k, k)}"
            cells.append(f"{e} AS {s(i, j)}")
        out.append(f"{name}_{k + 1} AS (SELECT {g}{', '.join(carried)}, {', '.join(cells)} FROM {name}_{k})")
    final = [*[f"{s(i, p)} AS b{i}" for i in range(p)],
             *[f"-{s(i, j)} AS c{i}{j}" for i in range(p) for j in range(i, p)], f"{s(p, p)} AS rss",
             f"m{p}" + "".join(f" - {s(i, p)} * m{i}" for i in range(p)) + " AS a"]
    out.append(f"{name} AS (SELECT {g}{', '.join(carried)}, {', '.join(final)} FROM {name}_{p})")
    return ",\n".join(out)


def pred(xs: list[str], f: str = "f") -> str:
    return "(" + f"{f}.a" + "".join(f" + {f}.b{i} * {x}" for i, x in enumerate(xs)) + ")"


def hat(xs: list[str], f: str = "f") -> str:
    """Leverage of a row."""
    d = [f"({x} - {f}.m{i})" for i, x in enumerate(xs)]
    terms = [f"1 / {f}.n"]
    for i in range(len(xs)):
        for j in range(i, len(xs)):
            terms.append(f"{'2 * ' if i != j else ''}{f}.c{i}{j} * {d[i]} * {d[j]}")
    return "(" + " + ".join(terms) + ")"


def intercept_var(p: int) -> str:
    terms = ["1 / n"]
    for i in range(p):
        for j in range(i, p):
            terms.append(f"{'2 * ' if i != j else ''}c{i}{j} * m{i} * m{j}")
    return "(" + " + ".join(terms) + ")"


def f_tail(f: str, d1: str, d2: str) -> str:
    """Upper tail of F by Simpson's rule over the square root of the statistic."""
    top, n = f"least(sqrt({f}), 12.0)", 2000
    u = f"(i * {top} / {n})"
    k = f"2 * exp({d1} / 2.0 * ln({d1} / ({d2})::DOUBLE) + lgamma(({d1} + {d2}) / 2.0) - lgamma({d1} / 2.0) - lgamma({d2} / 2.0))"
    w = f"CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    area = (f"list_sum(list_transform(range(0, {n + 1}), lambda i: ({w}) * pow({u}, {d1} - 1) * "
            f"exp(-({d1} + {d2}) / 2.0 * ln(1 + {d1} * {u} * {u} / ({d2})::DOUBLE))))")
    return f"abs(round(1 - ({k}) * {top} / {n} / 3 * {area}, 6))"


def t_tail(t: str, df: str) -> str:
    """Two-sided tail of Student t."""
    return f_tail(f"pow({t}, 2)", "1", df)


def t_crit(df: str) -> str:
    """97.5 % Student-t quantile for large df, by its expansion around the normal."""
    z = 1.959963984540054
    a, b = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96
    return f"({z} + {a!r} / ({df}) + {b!r} / pow({df}, 2))"


def bagged_trees(rows: str, target: str, xs: list[str], key: str, trees: int, depth: int, bins: int, least: int, seed: int) -> str:
    """CTEs ending in bag_v (key, value): bagged trees over ``rows`` (a table with the key,
    the target and the predictors, none of them NULL but the target), level by level."""
    cuts, upto, each = [], 0.0, 1.0
    for k in range(8):
        each = math.exp(-1) / math.factorial(k)
        upto += each
        cuts.append(round(16**5 * upto))
    quantiles = ", ".join(repr(i / bins) for i in range(1, bins))
    cells = ", ".join(f"{{'axis': {j}, 'bin': b{j}}}" for j in range(len(xs)))
    side = "CASE axis " + " ".join(f"WHEN {j} THEN b{j}" for j in range(len(xs))) + " END"
    out = [
        "bag_e AS (SELECT " + ", ".join(f"list_distinct(quantile_cont({x}, [{quantiles}])) AS e{j}" for j, x in enumerate(xs))
        + f" FROM {rows} WHERE {target} IS NOT NULL)",
        f"bag_a AS (SELECT {key} AS key, {target} AS y, "
        + ", ".join(f"len(list_filter(e{j}, lambda e: e < {x})) AS b{j}" for j, x in enumerate(xs)) + f" FROM {rows}, bag_e)",
        f"bag_d AS (SELECT bag_a.*, tree, ('0x' || substr(md5(concat_ws('|', {seed}, tree // 6, key)), (tree % 6 * 5 + 1)::INT, 5))::BIGINT AS d"
        f" FROM bag_a, range({trees}) r(tree))",
        f"bag_r0 AS (SELECT * EXCLUDE (d), 1 AS node, CASE WHEN y IS NULL THEN 0 ELSE len(list_filter({cuts}, lambda c: c <= d)) END AS w FROM bag_d)",
    ]
    for n in range(depth):
        out += [
            f"bag_h{n} AS (SELECT tree, node, c.axis AS axis, c.bin AS bin, sum(w) AS n, sum(w * y) AS s"
            f" FROM (SELECT tree, node, w, y, unnest([{cells}]) AS c FROM bag_r{n} WHERE w > 0 AND node >= {1 << n}) GROUP BY ALL)",
            f"bag_c{n} AS (SELECT *, sum(n) OVER q AS nl, sum(s) OVER q AS sl, sum(n) OVER p AS nn, sum(s) OVER p AS ss FROM bag_h{n}"
            " WINDOW q AS (PARTITION BY tree, node, axis ORDER BY bin), p AS (PARTITION BY tree, node, axis))",
            f"bag_s{n} AS (SELECT tree, node, axis, bin, sl * sl / nl + (ss - sl) * (ss - sl) / (nn - nl) AS gain FROM bag_c{n}"
            f" WHERE nl >= {least} AND nn - nl >= {least} AND gain > ss * ss / nn * (1 + 1e-12)"
            " QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, axis, bin) = 1)",
            f"bag_r{n + 1} AS (SELECT r.* REPLACE (CASE WHEN axis IS NULL THEN r.node ELSE 2 * r.node + ({side} > bin)::INT END AS node)"
            f" FROM bag_r{n} r LEFT JOIN bag_s{n} s ON r.tree = s.tree AND r.node = s.node)",
        ]
    out += [f"bag_l AS (SELECT tree, node, sum(w * y) / sum(w) AS leaf FROM bag_r{depth} WHERE w > 0 GROUP BY ALL)",
            f"bag_v AS (SELECT key, avg(leaf) AS value FROM bag_r{depth} JOIN bag_l USING (tree, node) GROUP BY key)"]
    return ",\n".join(out)


def key_hash(keys: list[str], salt: str = "0") -> str:
    """The 52-bit key hash that splits, folds and samples go by."""
    shown = ", ".join(f"coalesce(length({k}::VARCHAR)::VARCHAR || ':' || {k}::VARCHAR, '-')" for k in keys)
    return f"('0x' || substr(md5(concat_ws('|', {salt}, {shown})), 1, 13))::BIGINT"


def bucket(keys: list[str], n: int, salt: str = "0") -> str:
    return f"({key_hash(keys, salt)} % {n})"


def chi2_tail_3(x: str) -> str:
    """Upper tail of chi-square with three degrees of freedom by Simpson's rule."""
    top, n = f"least(sqrt({x}), 12.0)", 2000
    u = f"(i * {top} / {n})"
    w = f"CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    area = f"list_sum(list_transform(range(0, {n + 1}), lambda i: ({w}) * pow({u}, 2) * exp(-pow({u}, 2) / 2)))"
    return f"abs(round(1 - sqrt(2 / pi()) * {top} / {n} / 3 * {area}, 6))"
