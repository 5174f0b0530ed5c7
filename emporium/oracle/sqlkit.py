"""DuckDB expression helpers for the oracle SQL (rules N2, N3, N4, N9)."""

from __future__ import annotations

MONEY = "DECIMAL(18,2)"


def div_round(n: str, d: str, mid: int, fin: int, prec: int = 18) -> str:
    """Exact MySQL ``ROUND(n / d, fin)`` with the division kept to ``mid``
    places, for non-negative integer-valued ``n`` and ``d``; NULL if d = 0."""
    N = f"CAST(({n}) AS HUGEINT)"
    D = f"CAST(NULLIF(({d}), 0) AS HUGEINT)"
    r_mid = f"((2 * {N} * {10 ** mid} + {D}) // (2 * {D}))"
    step = 10 ** (mid - fin)
    r_fin = f"((2 * {r_mid} + {step}) // {2 * step})"
    unit = "1" if fin == 0 else "0." + "0" * (fin - 1) + "1"
    return f"CAST(CAST({r_fin} AS DECIMAL(38,0)) * CAST({unit} AS DECIMAL({fin + 1},{fin})) AS DECIMAL({prec},{fin}))"


def avg_money(sum_expr: str, cnt_expr: str) -> str:
    """ROUND(COALESCE(AVG(decimal(12,2)),0),2) from a sum and a count."""
    return f"COALESCE({div_round(f'({sum_expr}) * 100', f'({cnt_expr}) * 100', 6, 2)}, CAST(0 AS {MONEY}))"


def fold(x: str) -> str:
    """Grouping key under the case/accent/trailing-space-insensitive collation."""
    return f"strip_accents(lower(rtrim({x})))"


def _month_steps(a: str, b: str) -> str:
    tod = "(epoch_us({x}) - epoch_us(date_trunc('day', {x})))"
    key_a = f"(day({a}) * 86400000000 + {tod.format(x=a)})"
    key_b = f"(day({b}) * 86400000000 + {tod.format(x=b)})"
    return (f"((year({b}) - year({a})) * 12 + month({b}) - month({a}) "
            f"- CASE WHEN {key_b} < {key_a} THEN 1 ELSE 0 END)")


def whole_months(a: str, b: str) -> str:
    """TIMESTAMPDIFF(MONTH, a, b): complete months, truncated toward zero."""
    return f"(CASE WHEN {b} >= {a} THEN {_month_steps(a, b)} ELSE -{_month_steps(b, a)} END)"


def whole_years(a: str, b: str) -> str:
    """TIMESTAMPDIFF(YEAR, a, b) = complete months // 12, toward zero."""
    m = whole_months(a, b)
    return f"(CASE WHEN {m} >= 0 THEN {m} // 12 ELSE -((-{m}) // 12) END)"


def guarded_greatest(lower: str, x: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest({lower}, {x}) END)"


def days_between(end: str, start: str) -> str:
    """DATEDIFF(end, start): calendar dates."""
    return f"(CAST({end} AS DATE) - CAST({start} AS DATE))"


def local_city(city: str) -> str:
    return f"({fold(f'lower(trim(COALESCE({city}, {chr(39)}{chr(39)})))')} = 'medellin')"


def full_name(first: str, last: str) -> str:
    def cap(x):
        return f"(CASE WHEN strlen({x}) > 0 THEN upper(left({x}, 1)) || lower(substr({x}, 2)) ELSE '' END)"
    f = f"trim(COALESCE({first}, ''))"
    l = f"trim(COALESCE({last}, ''))"
    return f"(CASE WHEN {first} IS NULL AND {last} IS NULL THEN '' ELSE trim({cap(f)} || ' ' || {cap(l)}) END)"


TIER = ("CASE WHEN {t} IS NULL OR {t} < 0 THEN 'Bronce' WHEN {t} >= 1000000.00 THEN 'Platino' "
        "WHEN {t} >= 500000.00 THEN 'Oro' WHEN {t} >= 100000.00 THEN 'Plata' ELSE 'Bronce' END")
EMAIL_RE = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$"
