"""Column expressions shared by all jobs.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference -------------------------
# Order states (ENUM of ventas.estado), cart states, loyalty tiers with
# their lower bounds, shipping and tax constants.
ORDER_STATES = ("Pendiente de Pago", "Procesando", "Enviado", "Entregado", "Cancelado")
CART_STATES = ("Activo", "Abandonado", "Convertido")
TIERS = ("Bronce", "Plata", "Oro", "Platino")
TIER_PLATINO = Decimal("1000000.00")
TIER_ORO = Decimal("500000.00")
TIER_PLATA = Decimal("100000.00")
CANCELLED = "Cancelado"
DELIVERED = "Entregado"
PENDING = "Pendiente de Pago"
FREE_SHIPPING_FROM = Decimal("200000.00")
SHIPPING_LOCAL = Decimal("8000.00")
SHIPPING_OTHER = Decimal("15000.00")
LOCAL_CITY = "medellin"
LOCAL_DELIVERY_DAYS = 2
OTHER_DELIVERY_DAYS = 5
VAT_RATE = Decimal("0.19")
NO_CATEGORY = "Sin Categoria"
SKU_FALLBACK = "GEN"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
LOW_STOCK = 15
# Allowed order-state transitions of the status procedure (from, to).
TRANSITIONS = (
    ("Pendiente de Pago", "Procesando"),
    ("Procesando", "Enviado"),
    ("Enviado", "Entregado"),
    ("Pendiente de Pago", "Cancelado"),
    ("Procesando", "Cancelado"),
    ("Enviado", "Cancelado"),
)
# -------------------------------------------------------------------------

# Case-, accent- and trailing-space-insensitive comparison (utf8mb4_unicode_ci).
CI_COLLATION = "UNICODE_CI_AI_RTRIM"


def dec(v, p: int = 12, s: int = 2) -> Column:
    return F.lit(Decimal(str(v))).cast(f"decimal({p},{s})")


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collated(x) -> Column:
    """The value under the case/accent-insensitive collation (rule N4)."""
    return F.collate(c(x), CI_COLLATION)


def ci_equals(x, literal: str) -> Column:
    return collated(x) == F.lit(literal)


def not_cancelled(col="estado") -> Column:
    return c(col) != F.lit(CANCELLED)


def div_round(num, den, mid_scale: int, final_scale: int, out_precision: int = 18) -> Column:
    """MySQL ``ROUND(num / den, final)`` for non-negative integer-valued inputs.

    MySQL keeps ``mid_scale`` digits after a decimal division (scale of the
    dividend + 4) and ROUND then rounds that value half away from zero, so
    the value is rounded twice.  Both roundings are done exactly with
    integral division on decimal(38,0), so no binary float is involved.
    NULL when ``den`` is 0 or NULL (the reference's NULLIF guard).
    """
    n = c(num).cast("decimal(38,0)")
    d = F.nullif(c(den).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    two = F.lit(2).cast("decimal(38,0)")
    scale_mid = F.lit(10 ** mid_scale).cast("decimal(38,0)")
    step = F.lit(10 ** (mid_scale - final_scale)).cast("decimal(38,0)")
    r_mid = int_div(two * n * scale_mid + d, two * d)
    r_fin = int_div(two * r_mid + step, two * step)
    unit = F.lit(Decimal(1).scaleb(-final_scale)).cast(f"decimal({final_scale + 1},{final_scale})")
    return (r_fin * unit).cast(f"decimal({out_precision},{final_scale})")


def int_div(a: Column, b: Column) -> Column:
    """Exact floor(a / b) for non-negative decimal(38,0) columns.

    The decimal quotient is rounded to 6 places, so its floor can be one
    too high; a single multiply-back correction makes it exact.
    """
    a = a.cast("decimal(38,0)")
    b = b.cast("decimal(38,0)")
    q = F.floor(a / b).cast("decimal(38,0)")
    return F.when(q * b > a, q - 1).otherwise(q).cast("decimal(38,0)")


def guarded_greatest(lower, x) -> Column:
    """MySQL GREATEST returns NULL if any argument is NULL (rule N2)."""
    return F.when(c(x).isNull(), F.lit(None)).otherwise(F.greatest(F.lit(lower), c(x)))


def cents(x) -> Column:
    """An amount of up to decimal(12,2) as whole cents: sums of them are exact in
    a long, where decimals of more than 18 digits allocate per row."""
    return (c(x) * 100).cast("bigint")


def from_cents(x) -> Column:
    return (c(x).cast("decimal(19,0)") * dec("0.01", 3, 2)).cast("decimal(21,2)")


def loyalty_tier(total) -> Column:
    """tier for an accumulated spend."""
    t = c(total)
    return (F.when(t.isNull() | (t < 0), F.lit("Bronce"))
             .when(t >= TIER_PLATINO, F.lit("Platino"))
             .when(t >= TIER_ORO, F.lit("Oro"))
             .when(t >= TIER_PLATA, F.lit("Plata"))
             .otherwise(F.lit("Bronce")))


def _cap_first(x: Column) -> Column:
    return F.when(F.octet_length(x) > 0,
                  F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 1 << 30)))
                  ).otherwise(F.lit(""))


def full_name(first, last) -> Column:
    """trim, capitalise the first letter of each part, join by a space."""
    f = F.trim(F.coalesce(c(first), F.lit("")))
    l = F.trim(F.coalesce(c(last), F.lit("")))
    joined = F.trim(F.concat(_cap_first(f), F.lit(" "), _cap_first(l)))
    return F.when(c(first).isNull() & c(last).isNull(), F.lit("")).otherwise(joined)


def normalise_part(x) -> Column:
    """The same capitalisation for one name part; blank stays as is."""
    t = F.trim(c(x))
    return F.when(c(x).isNull() | (F.octet_length(t) == 0), c(x)).otherwise(
        F.concat(F.upper(F.left(t, F.lit(1))), F.lower(F.substring(t, 2, 1 << 30))))


def email_ok(x) -> Column:
    """1 when the address has user@domain.tld form, else 0."""
    e = c(x)
    return (F.when(e.isNull() | (F.trim(e) == ""), F.lit(0))
             .when(e.rlike(EMAIL_PATTERN), F.lit(1)).otherwise(F.lit(0)))


def sku(category_name, product_id) -> Column:
    """SKU-<first 3 of category upper>-<lpad(id,4)>; GEN fallback."""
    prefix = F.upper(F.left(c(category_name), F.lit(3)))
    prefix = F.when(prefix.isNull() | (F.octet_length(prefix) < 3), F.lit(SKU_FALLBACK)).otherwise(prefix)
    pid = F.coalesce(c(product_id).cast("string"), F.lit("0"))
    return F.concat(F.lit("SKU-"), prefix, F.lit("-"), F.lpad(pid, 4, "0"))


def is_local_city(city) -> Column:
    """``LOWER(TRIM(COALESCE(city,''))) = 'medellin'`` under the collation."""
    return collated(F.lower(F.trim(F.coalesce(c(city), F.lit(""))))) == F.lit(LOCAL_CITY)


def shipping_cost(total, city) -> Column:
    """F07."""
    t = F.when(c(total).isNull() | (c(total) < 0), dec(0)).otherwise(c(total))
    return (F.when(t >= FREE_SHIPPING_FROM, dec(0, 10, 2))
             .when(is_local_city(city), dec(SHIPPING_LOCAL, 10, 2))
             .otherwise(dec(SHIPPING_OTHER, 10, 2))).cast("decimal(10,2)")


def apply_discount(price, pct) -> Column:
    """price after a percentage discount (inputs coerced to their declared types)."""
    p = c(price).cast("decimal(10,2)")
    r = c(pct).cast("decimal(5,2)")
    # MySQL: pct/100.00 keeps scale 2+4 = 6 digits, then price*that, ROUND 2.
    frac = F.round(r / F.lit(Decimal("100.00")), 6)
    return (F.when(p.isNull() | (p < 0), dec(0, 10, 2))
             .when(r.isNull() | (r <= 0), p)
             .when(r >= 100, dec(0, 10, 2))
             .otherwise(F.round(p - p * frac, 2))).cast("decimal(10,2)")


def vat(amount) -> Column:
    """F16: 19 % tax rounded to cents; NULL/negative -> 0.00."""
    a = c(amount).cast("decimal(12,2)")
    return F.when(a.isNull() | (a < 0), dec(0)).otherwise(F.round(a * VAT_RATE, 2)).cast("decimal(12,2)")


def convert_currency(amount, rate) -> Column:
    """round(amount*rate, 2); any NULL or negative input -> 0.00."""
    a = c(amount).cast("decimal(12,2)")
    r = c(rate).cast("decimal(10,4)")
    bad = a.isNull() | r.isNull() | (a < 0) | (r < 0)
    return F.when(bad, dec(0)).otherwise(F.round(a * r, 2)).cast("decimal(12,2)")


def delivery_date(order_ts, city, as_of) -> Column:
    """date + 2 calendar days for the local city, else + 5; NULL -> as_of."""
    ts = F.coalesce(c(order_ts), F.lit(as_of).cast("timestamp_ntz"))
    days = F.when(is_local_city(city), F.lit(LOCAL_DELIVERY_DAYS)).otherwise(F.lit(OTHER_DELIVERY_DAYS))
    return F.date_add(F.to_date(ts), days)


def whole_years(start_date, as_of) -> Column:
    """TIMESTAMPDIFF(YEAR, d, CURDATE()): complete years."""
    return F.timestamp_diff("YEAR", c(start_date).cast("timestamp_ntz"),
                           F.to_date(F.lit(as_of)).cast("timestamp_ntz"))


def whole_months(start_ts, end_ts) -> Column:
    return F.timestamp_diff("MONTH", c(start_ts), c(end_ts))
