"""Two-sided tail of Student's t in SQL, for the oracles of coefficient statistics.

p = I_x(dof / 2, 1 / 2) at x = dof / (dof + t * t), the regularised incomplete
beta function by its continued fraction. Each pair of coefficients is one step
of a recursive table; beyond the point where the fraction converges slowly the
mirrored form 1 - I_(1-x)(b, a) is taken.
"""

from __future__ import annotations

#: Steps after which the fraction ends at the latest; it needs about sqrt(dof) of them.
MOST_STEPS = 20_000


def t_tail_cte(source: str) -> str:
    """CTEs ending in ``t_tail (k, p)`` from the rows (k, t, dof) of ``source``; for ``WITH RECURSIVE``. t = 0 gives 1, an infinite t 0."""
    near = "(dof / (dof + t * t) < (dof / 2 + 1) / (dof / 2 + 2.5))"
    even = "(i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i)))"
    odd = "(-(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1)))"
    return (
        f"t_arg as (select k, case when {near} then dof / 2 else 0.5 end as a, case when {near} then 0.5 else dof / 2 end as b, "
        f"case when {near} then dof / (dof + t * t) else t * t / (dof + t * t) end as x, {near} as direct "
        f"from {source} where t <> 0 and not isinf(t)), "
        # num / den of the fraction's last two convergents, kept as ratios c and d with value h
        f"t_step as (select k, a, b, x, direct, 1.0::double as i, 1.0::double as c, 1 / (1 - (a + b) * x / (a + 1)) as d, "
        f"1 / (1 - (a + b) * x / (a + 1)) as h, 1.0::double as change from t_arg "
        f"union all select k, a, b, x, direct, i + 1, c2, d2, h * c1 * d1 * c2 * d2, abs(c2 * d2 - 1) from ("
        f"select *, 1 + {odd} / c1 as c2, 1 / (1 + {odd} * d1) as d2 from ("
        f"select *, 1 + {even} / c as c1, 1 / (1 + {even} * d) as d1 from t_step where change > 1e-15 and i < {MOST_STEPS}))), "
        f"t_last as (select * from t_step qualify row_number() over (partition by k order by i desc) = 1), "
        f"t_part as (select k, direct, h * exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) / a as w from t_last), "
        f"t_tail as (select k, case when direct then w else 1 - w end as p from t_part "
        f"union all select k, case when t = 0 then 1.0::double else 0.0::double end from {source} where t = 0 or isinf(t))")
