"""Security views V1-V3 and the role column allow-list R1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: columns of the customers table readable by the
# marketing and analyst roles (no password hash, no shipping address) ---
CUSTOMER_READ_COLUMNS = (
    "id_cliente", "nombre", "apellido", "email", "ciudad", "pais", "fecha_nacimiento",
    "fecha_registro", "fecha_ultima_compra", "total_gastado", "nivel_lealtad",
    "referido_por", "activo",
)
ROLE_ALLOW_LIST = {
    ("Gerente_Marketing", "clientes"): CUSTOMER_READ_COLUMNS,
    ("Analista_Datos", "clientes"): CUSTOMER_READ_COLUMNS,
}
# ---------------------------------------------------------------------------


def v_customers_basic(t) -> DataFrame:
    return t.clientes.select("id_cliente", "nombre", "apellido", "ciudad", "pais", "nivel_lealtad", "activo")


def v_public_catalog(t) -> DataFrame:
    cat = t.categorias.select("id_categoria", F.col("nombre").alias("categoria"))
    p = t.productos.where(F.col("activo") == 1).join(cat, "id_categoria", "left")
    return p.select("id_producto", "sku", "nombre", "categoria", "descripcion", "precio",
                    (F.col("stock") > 0).cast("int").alias("disponible"))


def v_public_orders(t) -> DataFrame:
    return t.ventas.select("id_venta", "id_cliente", "fecha_venta", "estado", "total")


def role_projection(t, role: str, table: str) -> DataFrame:
    """Columns of ``table`` a role may read; tables without an entry are not readable."""
    cols = ROLE_ALLOW_LIST.get((role, table))
    if cols is None:
        raise PermissionError(f"role {role!r} has no column grant on {table!r}")
    return t.table(table).select(*cols)
