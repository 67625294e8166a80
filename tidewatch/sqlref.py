"""SQL text of the same tails for engines without ``erf`` (oracle side).

Closed forms with ``lgamma`` and list folds; these mirror
``tidewatch.functions.stats`` and are used by ``oracle_sql()``.
"""

from __future__ import annotations


def ks_pvalue_sql(d: str, n: str, m: str) -> str:
    lam = f"((sqrt(({n})*({m})/(({n})+({m}))) + 0.12 + 0.11/sqrt(({n})*({m})/(({n})+({m})))) * ({d}))"
    series = f"list_sum(list_transform(range(1, 101), lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * {lam} * {lam})))"
    return (
        f"CASE WHEN ({n}) IS NULL OR ({m}) IS NULL OR ({n}) <= 0 OR ({m}) <= 0 OR ({d}) IS NULL THEN NULL "
        f"WHEN {lam} < 0.2 THEN 1.0 ELSE least(greatest(2.0 * {series}, 0.0), 1.0) END"
    )


def _erfc_sql(z: str) -> str:
    erf_terms = (
        f"list_sum(list_transform(range(0, 201), lambda n: exp(ln({z}) - ({z})*({z}) + n * ln(2.0 * ({z})*({z})) "
        f"- (lgamma(2 * n + 2) - n * ln(2.0) - lgamma(n + 1)))))"
    )
    return (
        f"(CASE WHEN ({z}) <= 0 THEN 1.0 WHEN ({z})*({z}) > 50.0 THEN 0.0 "
        f"ELSE greatest(1.0 - 2.0 / sqrt(pi()) * {erf_terms}, 0.0) END)"
    )


def chi2_sf_sql(x: str, dof: str) -> str:
    h = f"(({x}) / 2.0)"
    even = f"list_sum(list_transform(range(0, ({dof}) // 2), lambda i: exp(-{h} + i * ln({h}) - lgamma(i + 1))))"
    odd_sum = (
        f"coalesce(list_sum(list_transform(range(1, (({dof}) - 1) // 2 + 1), "
        f"lambda i: exp(-{h} + (i - 0.5) * ln({h}) - lgamma(i + 0.5)))), 0.0)"
    )
    odd = f"({_erfc_sql(f'sqrt({h})')} + {odd_sum})"
    return (
        f"(CASE WHEN ({x}) IS NULL OR ({dof}) IS NULL THEN NULL WHEN ({dof}) <= 0 THEN 1.0 WHEN ({x}) <= 0 THEN 1.0 "
        f"ELSE least(greatest(CASE WHEN ({dof}) % 2 = 0 THEN {even} ELSE {odd} END, 0.0), 1.0) END)"
    )
