"""Mutating procedures re-aimed as request-batch jobs.

Contract: ``(state tables, requests) -> accepted / rejected rows with the
reason the reference would have raised, plus the new state``.  Requests
carry ``request_id`` and ``ts``; within a key they apply in (ts, id) order.
Row locks and transactions become per-key ordered folds
(:mod:`emporium.operators.admission`); everything else is joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions import semantics as S
from emporium.operators.admission import greedy_admission, sequential_balance
from emporium.operators.kept import kept
from emporium.operators.ledger import floored_totals
from emporium.operators.scan import keyed_running
from emporium.operators.scalars import attach_scalars

# --- fixed values: messages and texts of the reference's procedures -------
MSG_QTY = "La cantidad comprada debe ser mayor a cero"
MSG_NO_CUSTOMER = "El cliente especificado no existe"
MSG_INACTIVE = "El cliente se encuentra inactivo o suspendido"
MSG_NO_STOCK = "Inventario insuficiente para el producto seleccionado"
MSG_PRICE = "El precio debe ser un valor positivo"
MSG_COST_STOCK = "El costo y el stock no pueden ser valores negativos"
MSG_RETURN_QTY = "La cantidad a devolver debe ser mayor a cero"
MSG_NO_ORDER_RETURN = "La orden de venta especificada no existe"
MSG_NOT_DELIVERED = "Solo se pueden devolver productos de ordenes en estado Entregado"
MSG_NOT_IN_ORDER = "El producto no pertenece a la orden especificada"
MSG_RETURN_EXCEEDS = "La cantidad devuelta supera la cantidad pendiente de devolver en la orden"
MSG_ADJ_ZERO = "El ajuste de inventario debe ser distinto de cero"
MSG_ADJ_NO_PRODUCT = "El producto a ajustar no existe"
MSG_ADJ_NEGATIVE = "El ajuste solicitado resulta en un stock negativo"
MSG_PCT = "El porcentaje de descuento debe ubicarse entre 0.01 y 100"
MSG_DATES = "La fecha de fin debe ser posterior a la fecha de inicio"
MSG_NO_CATEGORY = "La categoria ingresada no existe"
MSG_BAD_STATE = "Estado no valido para la orden de compra"
MSG_NO_ORDER = "La orden especificada no existe"
MSG_TRANSITION = "Transicion de estado no permitida (una orden Entregada solo se revierte con sp_ProcesarDevolucion)"
MSG_EMAIL = "El formato del correo electronico es invalido"
MSG_DUPLICATE_EMAIL = "Duplicate entry for key 'email'"
MSG_SELF_MERGE = "No es posible fusionar un cliente consigo mismo"
MSG_NO_PRIMARY = "La cuenta principal no existe"
MSG_NO_SECONDARY = "La cuenta secundaria no existe"
MSG_MERGE_CONFLICT = "customer appears in more than one merge of the batch"
MSG_NO_PRODUCT_SUPPLIER = "El producto o el proveedor especificado no existe"
MSG_NOT_PENDING = "La orden no se encuentra en estado Pendiente de Pago"
MSG_UNDERPAID = "El monto pagado es insuficiente para cubrir el total de la venta"
MSG_RATING = "La calificacion debe encontrarse en el rango de 1 a 5"
MSG_NULL = "Column cannot be null"
MSG_FOREIGN_KEY = "Cannot add or update a child row: a foreign key constraint fails"
MSG_DUPLICATE_NAME = "Duplicate entry for key 'nombre'"
MSG_NO_CATEGORIES = "Alguna de las categorias ingresadas no existe"
ADJUST_TEXT = "Ajuste de inventario producto id "
ANON_NAME, ANON_SURNAME = "CLIENTE", "ANONIMIZADO"
ANON_EMAIL_PREFIX, ANON_EMAIL_DOMAIN = "anonimo_", "@eliminado.invalid"
ANON_ADDRESS, ANON_HASH = "DIRECCION_ELIMINADA", "[CUENTA_CERRADA]"
ERASE_ANON_TEXT = " desactivado y anonimizado por presencia de historial transaccional"
ERASE_DELETE_TEXT = " eliminado fisicamente (sin ventas asociadas)"
PROMO_NAME = "Descuento Categoria "
# ---------------------------------------------------------------------------

ORDER = ("ts", "request_id")
ORDER_ROWS = 1_000_000  # return requests of one order that one window holds


def _decision(df: DataFrame, accepted, reason) -> DataFrame:
    return df.withColumn("accepted", accepted).withColumn("reason", reason)


def _first_reason(*pairs):
    """CASE WHEN c1 THEN m1 WHEN c2 THEN m2 ... (NULL = passes)."""
    out = None
    for cond, msg in pairs:
        out = F.when(cond, F.lit(msg)) if out is None else out.when(cond, F.lit(msg))
    return out


# -- P01 ---------------------------------------------------------------------------
def bat_orders(t, requests: DataFrame) -> dict[str, DataFrame]:
    """One order of one product per request.  Static checks, then the
    stock check (F02: active product, enough stock) decided in order per
    product; accepted requests become an order 'Pendiente de Pago' plus a
    line at the list price (F03), stock and sold follow (T03), the order
    total follows (T10)."""
    c = t.clientes.select("id_cliente", F.col("activo").alias("_cact"))
    r = requests.join(c, "id_cliente", "left")
    why = _first_reason((F.col("cantidad").isNull() | (F.col("cantidad") <= 0), MSG_QTY), (F.col("_cact").isNull(), MSG_NO_CUSTOMER),
                        (F.col("_cact") == 0, MSG_INACTIVE))
    r = r.withColumn("_why", why)
    static_rej = r.where(F.col("_why").isNotNull()).select("request_id", F.lit(False).alias("accepted"),
                                                          F.col("_why").alias("reason"))
    passing = r.where(F.col("_why").isNull())
    cap = t.productos.where(F.col("activo") == 1).select("id_producto", F.col("stock").alias("cap"))
    dec = greedy_admission(passing.select("request_id", "id_producto", F.col("cantidad").alias("qty"), "ts"),
                           cap, "id_producto", "qty")
    dec = dec.withColumn("reason", F.when(~F.col("accepted"), F.lit(MSG_NO_STOCK)))
    decisions = static_rej.unionByName(dec)
    max_id = t.ventas.agg(F.max("id_venta").alias("_max"))
    acc = (requests.join(decisions.where("accepted").select("request_id"), "request_id")
           .join(t.productos.select("id_producto", "precio"), "id_producto"))
    acc = attach_scalars(acc, max_id)
    new_orders = acc.select((F.col("_max") + F.col("request_id") + 1).alias("id_venta"), "id_cliente", "id_sucursal",
                            F.col("ts").alias("fecha_venta"), F.lit(S.PENDING).alias("estado"),
                            (F.col("cantidad") * F.col("precio")).cast("decimal(12,2)").alias("total"),
                            "request_id", "id_producto", "cantidad", F.col("precio").alias("precio_unitario_congelado"))
    sold = new_orders.groupBy("id_producto").agg(F.sum("cantidad").alias("_q"))
    stock = (t.productos.select("id_producto", "stock", "total_vendido").join(sold, "id_producto", "left")
             .select(F.col("id_producto").alias("product_id"),
                     (F.col("stock") - F.coalesce("_q", F.lit(0))).cast("bigint").alias("stock"),
                     (F.col("total_vendido") + F.coalesce("_q", F.lit(0))).cast("bigint").alias("total_sold")))
    out = (requests.select("request_id").join(decisions, "request_id")
           .join(new_orders.select("request_id", "id_venta", "total"), "request_id", "left")
           .select("request_id", "accepted", "reason", F.col("id_venta").alias("order_id"),
                   F.col("total").alias("order_total")))
    return {"decisions": out, "stock": stock, "orders": new_orders}


# -- P02 ---------------------------------------------------------------------------
def bat_new_products(t, requests: DataFrame) -> DataFrame:
    """Price > 0; cost and stock >= 0; no missing value; category (the
    default one if none, T19) and supplier exist; name not taken by the table or
    an earlier request that is in order -> new product with an id and its SKU (F15)."""
    categories = t.categorias.select(F.col("id_categoria").alias("_cid"), F.col("nombre").alias("_cname"))
    suppliers = t.proveedores.select(F.col("id_proveedor").alias("_sid"))
    r = (requests.withColumn("_cat", F.coalesce(F.col("id_categoria"), F.lit(1)))
         .join(categories, F.col("_cat") == F.col("_cid"), "left")
         .join(suppliers, F.col("id_proveedor") == F.col("_sid"), "left"))
    missing = F.col("nombre").isNull() | F.col("precio").isNull() | F.col("costo").isNull() | F.col("stock").isNull()
    orphan = F.col("_cid").isNull() | (F.col("id_proveedor").isNotNull() & F.col("_sid").isNull())
    r = r.withColumn("_why", _first_reason(
        (F.col("precio") <= 0, MSG_PRICE), ((F.col("costo") < 0) | (F.col("stock") < 0), MSG_COST_STOCK),
        (missing, MSG_NULL), (orphan, MSG_FOREIGN_KEY)))
    # Names meet under the collation in one hash join (a sort makes a collation key per
    # comparison, an aggregate compares by it); equal spellings are one row before.
    passing = r.where(F.col("_why").isNull()).select("request_id", "ts", "nombre")
    asked = passing.groupBy("nombre").agg(F.min(F.struct(*ORDER)).alias("_first"))
    taken = t.productos.select("nombre").distinct().withColumn("_first", F.lit(None).cast(asked.schema["_first"].dataType))
    names = asked.unionByName(taken).select(S.collated("nombre").alias("_name"), "_first").hint("shuffle_hash")
    before = F.col("_first").isNull() | (F.struct(*ORDER) > F.col("_first"))
    again = (passing.withColumn("_k", S.collated("nombre")).join(names, (F.col("_k") == F.col("_name")) & before, "left_semi")
             .select("request_id", F.lit(MSG_DUPLICATE_NAME).alias("_again")))
    r = attach_scalars(r.join(again, "request_id", "left").withColumn("reason", F.coalesce("_why", "_again")),
                       t.productos.agg(F.max("id_producto").alias("_max")))
    ok = F.col("reason").isNull()
    pid = F.col("_max") + F.col("request_id") + 1
    return r.select("request_id", ok.alias("accepted"), "reason",
                    F.when(ok, pid).alias("product_id"), F.when(ok, F.col("_cat")).alias("id_categoria"),
                    F.when(ok, S.sku(F.col("_cname"), pid)).alias("sku"))


# -- P03 ---------------------------------------------------------------------------
def bat_address_updates(t, requests: DataFrame) -> dict[str, DataFrame]:
    """Address, city and country overwritten (NULLs too) for existing
    customers; the last request per customer wins.  The audit (T22) gets
    one row per request that really changed the address byte-wise."""
    cur = t.clientes.select("id_cliente", F.col("direccion_envio").alias("_cur"), F.lit(True).alias("_ok"))
    r = requests.join(cur, "id_cliente", "left")
    decisions = r.select("request_id", F.col("_ok").isNotNull().alias("accepted"),
                         F.when(F.col("_ok").isNull(), F.lit(MSG_NO_CUSTOMER)).alias("reason"))
    acc = r.where(F.col("_ok").isNotNull())
    latest = (acc.groupBy("id_cliente")
              .agg(F.max_by(F.struct("direccion_envio", "ciudad", "pais"), F.struct(*ORDER)).alias("_l")))
    state = latest.select(F.col("id_cliente").alias("customer_id"), F.col("_l.direccion_envio").alias("direccion_envio"),
                          F.col("_l.ciudad").alias("ciudad"), F.col("_l.pais").alias("pais"))
    a = keyed_running(acc.select("request_id", "id_cliente", "ts", "direccion_envio", "_cur"), ["id_cliente"],
                      list(ORDER), rank="_rn", lags={"_lag": "direccion_envio"})
    a = a.withColumn("_prev", F.when(F.col("_rn") == 1, F.col("_cur")).otherwise(F.col("_lag")))
    audit = (a.where(~F.col("_prev").eqNullSafe(F.col("direccion_envio")))
             .select(F.col("id_cliente").alias("customer_id"), F.lit("direccion_envio").alias("field"),
                     F.col("_prev").alias("old_value"), F.col("direccion_envio").alias("new_value"),
                     F.col("ts").alias("modified_at")))
    return {"decisions": decisions, "state": state, "audit": audit}


# -- P04 ---------------------------------------------------------------------------
def bat_returns(t, requests: DataFrame) -> Mapping[str, DataFrame]:
    """Returns checked against the order (exists, delivered), the line
    (product bought) and what is left to return, in order per line.  An
    order is cancelled once everything bought was returned; requests after
    that see a cancelled order.  Requests that fail the first checks are stored
    for the decisions only."""
    line = ["id_venta", "id_producto"]
    r = requests.join(t.ventas.select("id_venta", F.col("estado").alias("_st")), "id_venta", "left")
    why = _first_reason((F.col("cantidad").isNull() | (F.col("cantidad") <= 0), MSG_RETURN_QTY),
                        (F.col("_st").isNull(), MSG_NO_ORDER_RETURN), (F.col("_st") != S.DELIVERED, MSG_NOT_DELIVERED))
    r = r.select("request_id", "ts", *line, "cantidad", why.alias("_why"))

    def passing() -> DataFrame:
        return kept(r.where(F.col("_why").isNull()).drop("_why"), "returns")

    def decisions() -> DataFrame:
        rows = kept(r, "returns")
        static_rej = rows.where(F.col("_why").isNotNull()).select("request_id", F.lit(False).alias("accepted"),
                                                                 F.col("_why").alias("reason"))
        return static_rej.unionByName(_decided_returns(t, rows.where(F.col("_why").isNull()))
                                      .select("request_id", "accepted", "reason"))

    def cancelled() -> DataFrame:
        return (_decided_returns(t, passing()).where("_closes").select("id_venta").join(t.ventas, "id_venta")
                .select(F.col("id_venta").alias("order_id"), "id_cliente", "total"))

    def stock() -> DataFrame:
        moved = _decided_returns(t, passing()).where("accepted").groupBy("id_producto").agg(F.sum("cantidad").alias("_q"))
        return (t.productos.select("id_producto", "stock", "total_vendido").join(moved, "id_producto")
                .select(F.col("id_producto").alias("product_id"), (F.col("stock") + F.col("_q")).cast("bigint").alias("stock"),
                        F.greatest(F.lit(0), F.col("total_vendido") - F.col("_q")).cast("bigint").alias("total_sold")))

    return _OnDemand(decisions=decisions, cancelled=cancelled, stock=stock)


def _decided_returns(t, passing: DataFrame) -> DataFrame:
    """Requests for delivered orders, decided: ``accepted``, ``reason`` and
    whether the request completes its order (``_closes``)."""
    line = ["id_venta", "id_producto"]
    done = t.devoluciones.groupBy(*line).agg(F.sum("cantidad").alias("_done"))
    cap = (t.detalle_ventas.select(*line, "cantidad").join(done, line, "left")
           .select(*line, (F.col("cantidad") - F.coalesce("_done", F.lit(0))).alias("cap")))
    dec = greedy_admission(passing, cap, line, "cantidad", unknown=MSG_NOT_IN_ORDER, keep=("ts", *line, "cantidad"))
    # order completeness: running returned units per order over accepted requests
    back = F.when(F.col("accepted"), F.col("cantidad")).otherwise(F.lit(0))
    run = keyed_running(dec.withColumn("_back", back), ["id_venta"], list(ORDER), sums={"_run": "_back"},
                        whole=ORDER_ROWS)
    tot_bought = t.detalle_ventas.groupBy("id_venta").agg(F.sum("cantidad").alias("_tb"))
    tot_done = t.devoluciones.groupBy("id_venta").agg(F.sum("cantidad").alias("_td"))
    run = run.join(tot_bought, "id_venta", "left").join(tot_done, "id_venta", "left")
    # requests after the closing one find the order cancelled
    td, before = F.coalesce("_td", F.lit(0)), F.col("_run") - F.col("_back")
    late = F.coalesce((before > 0) & (td + before >= F.col("_tb")), F.lit(False))
    return run.select(
        "request_id", *line, "cantidad", (F.col("accepted") & ~late).alias("accepted"),
        F.when(F.col("reason") == MSG_NOT_IN_ORDER, F.lit(MSG_NOT_IN_ORDER)).when(late, F.lit(MSG_NOT_DELIVERED))
        .when(~F.col("accepted"), F.lit(MSG_RETURN_EXCEEDS)).alias("reason"),
        (F.col("accepted") & ~late & (td + F.col("_run") >= F.col("_tb"))).alias("_closes"))


# -- P06 ---------------------------------------------------------------------------
def bat_stock_adjust(t, requests: DataFrame) -> dict[str, DataFrame]:
    """Non-zero adjustments of existing products, applied in order per
    product, refused when the stock would go negative; each accepted one is
    logged."""
    p = t.productos.select("id_producto", F.col("stock").alias("bal"))
    r = requests.join(p.select("id_producto", F.lit(True).alias("_ex")), "id_producto", "left")
    why = _first_reason((F.col("ajuste").isNull() | (F.col("ajuste") == 0), MSG_ADJ_ZERO),
                        (F.col("_ex").isNull(), MSG_ADJ_NO_PRODUCT))
    r = r.withColumn("_why", why)
    static_rej = r.where(F.col("_why").isNotNull()).select("request_id", F.lit(False).alias("accepted"),
                                                          F.col("_why").alias("reason"))
    dec = sequential_balance(r.where(F.col("_why").isNull()).select("request_id", "id_producto",
                                                                   F.col("ajuste").alias("delta"), "ts"),
                             p, "id_producto", "delta")
    dec = dec.withColumn("reason", F.when(~F.col("accepted"), F.lit(MSG_ADJ_NEGATIVE)))
    decisions = static_rej.unionByName(dec)
    acc = requests.join(decisions.where("accepted").select("request_id"), "request_id")
    log = acc.select("request_id", F.concat(F.lit(ADJUST_TEXT), F.col("id_producto").cast("string"), F.lit(": "),
                                            F.col("ajuste").cast("string"), F.lit(" unidades. Motivo: "),
                                            F.col("motivo")).alias("action"), F.col("ts").alias("logged_at"))
    moved = acc.groupBy("id_producto").agg(F.sum("ajuste").alias("_d"))
    stock = (t.productos.select("id_producto", "stock").join(moved, "id_producto")
             .select(F.col("id_producto").alias("product_id"), (F.col("stock") + F.col("_d")).cast("bigint").alias("stock")))
    return {"decisions": decisions, "log": log, "stock": stock}


# -- P07 ---------------------------------------------------------------------------
def bat_customer_erasure(t, requests: DataFrame) -> DataFrame:
    """Customers with orders (any state) are anonymised, others deleted;
    one log line each.  (City, country and referrer are kept; older emails
    and addresses stay in the audit and new-customer logs, as in the
    reference.)"""
    has_orders = t.ventas.select("id_cliente").distinct().withColumn("_has", F.lit(True))
    r = (requests.join(t.clientes.select("id_cliente", F.lit(True).alias("_ex")), "id_cliente", "left")
         .join(has_orders, "id_cliente", "left"))
    ok = F.col("_ex").isNotNull()
    anon = F.col("_has").isNotNull()
    cid = F.col("id_cliente").cast("string")
    text = F.concat(F.lit("Cliente id "), cid, F.when(anon, F.lit(ERASE_ANON_TEXT)).otherwise(F.lit(ERASE_DELETE_TEXT)))
    return r.select("request_id", F.col("id_cliente").alias("customer_id"), ok.alias("accepted"),
                    F.when(~ok, F.lit(MSG_NO_CUSTOMER)).alias("reason"),
                    F.when(ok, F.when(anon, F.lit("anonymised")).otherwise(F.lit("deleted"))).alias("action"),
                    F.when(ok & anon, F.concat(F.lit(ANON_EMAIL_PREFIX), cid, F.lit(ANON_EMAIL_DOMAIN))).alias("new_email"),
                    F.when(ok, text).alias("log_text"))


def erased_customers(t, requests: DataFrame) -> DataFrame:
    """New customers table after P07 (anonymised rows rewritten, others dropped)."""
    res = bat_customer_erasure(t, requests).where("accepted")
    gone = res.where(F.col("action") == "deleted").select(F.col("customer_id").alias("id_cliente"))
    anon = res.where(F.col("action") == "anonymised").select(F.col("customer_id").alias("id_cliente"),
                                                             F.lit(True).alias("_anon"))
    c = t.clientes.join(gone, "id_cliente", "left_anti").join(anon, "id_cliente", "left")
    a = F.col("_anon").isNotNull()
    cid = F.col("id_cliente").cast("string")
    repl = {"activo": F.lit(0), "nombre": F.lit(ANON_NAME), "apellido": F.lit(ANON_SURNAME),
            "email": F.concat(F.lit(ANON_EMAIL_PREFIX), cid, F.lit(ANON_EMAIL_DOMAIN)),
            "direccion_envio": F.lit(ANON_ADDRESS), "fecha_nacimiento": F.lit(None).cast("date"),
            "contrasena_hash": F.lit(ANON_HASH)}
    return c.select(*[F.when(a, repl[x]).otherwise(F.col(x)).alias(x) if x in repl else F.col(x)
                      for x in t.clientes.columns])


# -- P08 ---------------------------------------------------------------------------
def bat_category_promos(t, requests: DataFrame) -> DataFrame:
    """0 < pct <= 100, end after start, category exists -> promotion."""
    cats = t.categorias.select("id_categoria", F.lit(True).alias("_ex"))
    r = requests.join(cats, "id_categoria", "left")
    why = _first_reason(((F.col("pct") <= 0) | (F.col("pct") > 100), MSG_PCT),
                        (F.col("fin") <= F.col("inicio"), MSG_DATES), (F.col("_ex").isNull(), MSG_NO_CATEGORY))
    ok = F.col("reason").isNull()
    r = r.withColumn("reason", why)
    return r.select("request_id", ok.alias("accepted"), "reason", F.col("id_categoria").alias("category_id"),
                    F.when(ok, F.concat(F.lit(PROMO_NAME), F.col("id_categoria").cast("string"))).alias("promotion_name"),
                    F.when(ok, F.col("pct").cast("decimal(5,2)")).alias("discount_pct"))


# -- P10 ---------------------------------------------------------------------------
def _longest_path(edges) -> int:
    """Edges of the longest path in the transition graph; the graph must be
    acyclic (an order can then change state at most that many times)."""
    succ: dict[str, list[str]] = {}
    for a, b in edges:
        succ.setdefault(a, []).append(b)
    memo: dict[str, int] = {}

    def depth(v, seen=()):
        if v in seen:
            raise ValueError("transition whitelist has a cycle")
        if v not in memo:
            memo[v] = max((1 + depth(w, seen + (v,)) for w in succ.get(v, [])), default=0)
        return memo[v]

    return max(depth(v) for v in succ)


def bat_order_transitions(t, requests: DataFrame) -> dict[str, DataFrame]:
    """P10: state changes checked against the whitelist and the order's state
    at that moment.  A request is accepted exactly when it is the first
    request after the order's last accepted change whose (state, new state)
    is in the whitelist, so each round finds, per order, that first request
    with one aggregate (a hot order is pre-aggregated map-side, never
    gathered).  The whitelist is acyclic, so an order changes state at most
    ``_longest_path`` times: that is the number of rounds, whatever the data.
    A cancel puts the lines back in stock and takes them off the sold
    counter (floor 0)."""
    valid = F.col("nuevo_estado").isin(*S.ORDER_STATES)
    r = requests.join(t.ventas.select("id_venta", F.col("estado").alias("_st0")), "id_venta", "left")
    why = _first_reason((F.col("nuevo_estado").isNull() | ~valid, MSG_BAD_STATE), (F.col("_st0").isNull(), MSG_NO_ORDER))
    r = r.withColumn("_why", why)
    static_rej = r.where(F.col("_why").isNotNull()).select("request_id", F.lit(False).alias("accepted"),
                                                          F.col("_why").alias("reason"))
    live = r.where(F.col("_why").isNull()).select("request_id", "id_venta", "nuevo_estado", "ts")
    allowed = t.spark.createDataFrame(list(S.TRANSITIONS), "_from string, _to string")
    me = F.struct(*ORDER)
    # per touched order: current state and the position of its last accepted change
    state = (t.ventas.join(live, "id_venta", "left_semi")
             .select("id_venta", F.col("estado").alias("_cur"), F.lit(None).cast(live.select(me).schema[0].dataType)
                     .alias("_pos")))
    taken = []
    for _ in range(_longest_path(S.TRANSITIONS)):
        state = state.checkpoint(eager=True)
        step = (live.join(state, "id_venta")
                .where(F.col("_pos").isNull() | (me > F.col("_pos")))
                .join(F.broadcast(allowed), (F.col("_cur") == F.col("_from")) & (F.col("nuevo_estado") == F.col("_to")))
                .groupBy("id_venta").agg(F.min(F.struct(*ORDER, "nuevo_estado")).alias("_acc")))
        step = step.checkpoint(eager=True)
        taken.append(step.select("id_venta", F.col("_acc.request_id").alias("request_id"),
                                 F.col("_acc.nuevo_estado").alias("nuevo_estado")))
        state = (state.join(step, "id_venta", "left")
                 .select("id_venta", F.coalesce("_acc.nuevo_estado", "_cur").alias("_cur"),
                         F.when(F.col("_acc").isNotNull(),
                                F.struct(F.col("_acc.ts").alias("ts"), F.col("_acc.request_id").alias("request_id")))
                         .otherwise(F.col("_pos")).alias("_pos")))
    acc = taken[0]
    for d in taken[1:]:
        acc = acc.unionByName(d)
    ok = F.col("_ok").isNotNull()
    dyn = live.join(acc.select("request_id", F.lit(True).alias("_ok")), "request_id", "left").select(
        "request_id", ok.alias("accepted"), F.when(~ok, F.lit(MSG_TRANSITION)).alias("reason"))
    decisions = static_rej.unionByName(dyn)
    cancels = acc.where(F.col("nuevo_estado") == S.CANCELLED).select("id_venta")
    back = (t.detalle_ventas.join(cancels, "id_venta", "left_semi").groupBy("id_producto")
            .agg(F.sum("cantidad").alias("_q")))
    stock = (t.productos.select("id_producto", "stock", "total_vendido").join(back, "id_producto")
             .select(F.col("id_producto").alias("product_id"), (F.col("stock") + F.col("_q")).cast("bigint").alias("stock"),
                     F.greatest(F.lit(0), F.col("total_vendido") - F.col("_q")).cast("bigint").alias("total_sold")))
    final_state = (t.ventas.select("id_venta", "estado").join(state, "id_venta", "left")
                   .select(F.col("id_venta").alias("order_id"), F.coalesce("_cur", "estado").alias("state")))
    return {"decisions": decisions, "stock": stock, "orders": final_state}


# -- P11 ---------------------------------------------------------------------------
def bat_register_customers(t, requests: DataFrame) -> DataFrame:
    """Valid email (F10), email not taken (case-insensitive UNIQUE, by
    the table or an earlier request of the batch) -> customer with
    normalised names (T09)."""
    key = S.collated(F.col("email"))
    taken = t.clientes.select(key.alias("_k")).withColumn("_taken", F.lit(True))
    bad = S.email_ok(F.col("email")) == 0
    r = requests.withColumn("_k", key).join(taken, "_k", "left")
    firsts = r.where(~bad).groupBy("_k").agg(F.min(F.struct(*ORDER)).alias("_first"))
    r = r.join(firsts, "_k", "left")
    later = F.struct(*ORDER) > F.col("_first")
    why = _first_reason((bad, MSG_EMAIL), (F.col("_taken").isNotNull() | later, MSG_DUPLICATE_EMAIL))
    r = r.withColumn("reason", why)
    ok = F.col("reason").isNull()
    return r.select("request_id", ok.alias("accepted"), "reason",
                    F.when(ok, S.normalise_part(F.col("nombre"))).alias("nombre"),
                    F.when(ok, S.normalise_part(F.col("apellido"))).alias("apellido"), "email")


# -- P13 ---------------------------------------------------------------------------
class _OnDemand(Mapping):
    """Outputs of a job by name; each is built, and its tables derived, when it is taken."""

    def __init__(self, **build):
        self._build = build

    def __getitem__(self, name: str) -> DataFrame:
        return self._build[name]()

    def __iter__(self):
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)


def bat_merge_accounts(t, requests: DataFrame) -> Mapping[str, DataFrame]:
    """Secondary accounts folded into primaries.  A primary may absorb
    several accounts.  Of the requests that pass the checks, those that name an
    account as secondary twice, or in both roles, are all refused (chains), so
    the result does not depend on order."""
    ids = t.clientes.select("id_cliente")
    r = (requests.join(ids.select(F.col("id_cliente").alias("primario"), F.lit(True).alias("_pex")), "primario", "left")
         .join(ids.select(F.col("id_cliente").alias("secundario"), F.lit(True).alias("_sex")), "secundario", "left"))
    r = r.withColumn("_why", _first_reason((F.col("primario") == F.col("secundario"), MSG_SELF_MERGE),
                                           (F.col("_pex").isNull(), MSG_NO_PRIMARY),
                                           (F.col("_sex").isNull(), MSG_NO_SECONDARY)))
    fair = r.where(F.col("_why").isNull())
    leaving = fair.groupBy("secundario").agg(F.count(F.lit(1)).alias("_n"))
    staying = fair.select(F.col("primario").alias("secundario"), F.lit(True).alias("_stays")).distinct()
    r = (r.join(leaving, "secundario", "left").join(staying, "secundario", "left")
         .join(leaving.select(F.col("secundario").alias("primario"), F.lit(True).alias("_leaves")), "primario", "left"))
    clash = (F.col("_n") > 1) | F.col("_stays").isNotNull() | F.col("_leaves").isNotNull()
    r = r.withColumn("reason", F.coalesce("_why", F.when(clash, F.lit(MSG_MERGE_CONFLICT))))
    decisions = r.select("request_id", F.col("reason").isNull().alias("accepted"), "reason")
    merges = r.where(F.col("reason").isNull())
    m = merges.select(F.col("secundario").alias("id_cliente"), F.col("primario").alias("_to"))

    def rekey(df: DataFrame, col: str = "id_cliente") -> DataFrame:
        j = df.join(m.withColumnRenamed("id_cliente", col), col, "left")
        return j.withColumn(col, F.coalesce("_to", col)).drop("_to").select(*df.columns)

    def reviews() -> DataFrame:
        # UPDATE IGNORE: a moved review that meets one of the primary, or of an
        # account merged before it, is left on the secondary and dies with it
        turn = merges.select(F.col("secundario").alias("id_cliente"), F.col("primario").alias("_to"),
                             F.struct(*ORDER).alias("_turn"))
        own = t.resenas_productos.select(F.col("id_cliente").alias("_to"), "id_producto")
        moving = t.resenas_productos.join(turn, "id_cliente").join(own, ["_to", "id_producto"], "left_anti")
        first = moving.groupBy("_to", "id_producto").agg(F.min("_turn").alias("_turn"))
        moved = (moving.join(first, ["_to", "id_producto", "_turn"]).withColumn("id_cliente", F.col("_to"))
                 .select(*t.resenas_productos.columns))
        return t.resenas_productos.join(m, "id_cliente", "left_anti").select(*moved.columns).unionByName(moved)

    def customers() -> DataFrame:
        c = t.clientes.join(m, "id_cliente", "left_anti")
        sec_spend = (t.clientes.join(m, "id_cliente").groupBy(F.col("_to").alias("id_cliente"))
                     .agg(F.sum("total_gastado").alias("_add")))
        c = c.join(sec_spend, "id_cliente", "left")
        spent = (F.col("total_gastado") + F.coalesce("_add", F.lit(0))).cast("decimal(12,2)")
        m2 = m.select(F.col("id_cliente").alias("referido_por"), F.col("_to").alias("_ref_to"))
        c = c.join(m2, "referido_por", "left")
        ref = F.when(F.col("_ref_to").isNotNull() & (F.col("_ref_to") == F.col("id_cliente")), F.lit(None)) \
            .otherwise(F.coalesce("_ref_to", "referido_por"))
        return c.select(*[spent.alias(x) if x == "total_gastado" else
                               F.when(F.col("_add").isNotNull(), S.loyalty_tier(spent)).otherwise(F.col("nivel_lealtad"))
                               .alias(x) if x == "nivel_lealtad" else
                               ref.cast("bigint").alias(x) if x == "referido_por" else F.col(x)
                               for x in t.clientes.columns])

    return _OnDemand(decisions=lambda: decisions, customers=customers, orders=lambda: rekey(t.ventas), reviews=reviews,
                     views=lambda: rekey(t.vistas_productos), carts=lambda: rekey(t.carritos))


# -- P14 ---------------------------------------------------------------------------
def bat_assign_supplier(t, requests: DataFrame) -> DataFrame:
    """Product and supplier must exist -> supplier set."""
    r = (requests.join(t.productos.select("id_producto", F.lit(True).alias("_p")), "id_producto", "left")
         .join(t.proveedores.select("id_proveedor", F.lit(True).alias("_s")), "id_proveedor", "left"))
    ok = F.col("_p").isNotNull() & F.col("_s").isNotNull()
    return r.select("request_id", ok.alias("accepted"), F.when(~ok, F.lit(MSG_NO_PRODUCT_SUPPLIER)).alias("reason"),
                    F.col("id_producto").alias("product_id"), F.col("id_proveedor").alias("supplier_id"))


# -- P17 ---------------------------------------------------------------------------
def bat_payments(t, requests: DataFrame) -> DataFrame:
    """A payment moves a pending order to 'Procesando' when it covers
    the total (overpayment accepted, a NULL amount passes as in the
    reference).  Per order the first covering payment wins; earlier ones
    were short, later ones find the order no longer pending."""
    r = requests.join(t.ventas.select("id_venta", "estado", "total"), "id_venta", "left")
    covers = ~(F.col("monto") < F.col("total")) | F.col("monto").isNull()
    pend = F.col("estado") == S.PENDING
    firsts = (r.where(pend & covers).groupBy("id_venta").agg(F.min(F.struct(*ORDER)).alias("_win")))
    r = r.join(firsts, "id_venta", "left")
    me = F.struct(*ORDER)
    why = (F.when(F.col("estado").isNull(), F.lit(MSG_NO_ORDER))
           .when(~pend, F.lit(MSG_NOT_PENDING))
           .when(F.col("_win").isNotNull() & (me > F.col("_win")), F.lit(MSG_NOT_PENDING))
           .when(~covers, F.lit(MSG_UNDERPAID)))
    return r.select("request_id", F.col("id_venta").alias("order_id"), why.isNull().alias("accepted"), why.alias("reason"))


# -- P18 ---------------------------------------------------------------------------
def bat_review_upsert(t, requests: DataFrame) -> dict[str, DataFrame]:
    """Ratings 1-5 of known products by known customers insert or
    overwrite the review of (customer, product); the last valid request per key
    wins and stamps the time; an existing review keeps its id."""
    r = (requests.join(t.productos.select("id_producto", F.lit(True).alias("_p")), "id_producto", "left")
         .join(t.clientes.select("id_cliente", F.lit(True).alias("_c")), "id_cliente", "left"))
    why = _first_reason((~F.coalesce(F.col("calificacion").between(1, 5), F.lit(False)), MSG_RATING),
                        (F.col("_p").isNull() | F.col("_c").isNull(), MSG_FOREIGN_KEY))
    r = r.withColumn("reason", why)
    decisions = r.select("request_id", F.col("reason").isNull().alias("accepted"), "reason")
    ok = r.where(F.col("reason").isNull())
    latest = (ok.groupBy("id_cliente", "id_producto")
              .agg(F.max_by(F.struct("calificacion", "comentario", "ts", "request_id"), F.struct(*ORDER)).alias("_l")))
    old = t.resenas_productos.select("id_cliente", "id_producto", "id_resena")
    j = latest.join(old, ["id_cliente", "id_producto"], "left")
    state = j.select(F.coalesce("id_resena", F.col("_l.request_id")).alias("review_id"),
                     F.col("id_producto").alias("product_id"), F.col("id_cliente").alias("customer_id"),
                     F.col("_l.calificacion").alias("rating"), F.col("_l.comentario").alias("comment"),
                     F.col("_l.ts").alias("reviewed_at"), F.col("id_resena").isNull().alias("inserted"))
    return {"decisions": decisions, "state": state}


# -- P20 ---------------------------------------------------------------------------
def bat_move_category(t, requests: DataFrame) -> dict[str, DataFrame]:
    """P20: both categories must exist -> every product of the origin moves
    to the destination; the two categories' counters are recounted; moved
    products are stamped (T07: only when the category really changed).

    Accepted moves apply in (ts, request_id) order, so a product follows a
    chain of moves (A->B, later B->C ends in C).  The walk runs on the small
    category domain, not on products: per category that is the origin of
    some move, each round follows the first later move out of the category
    reached so far (one join + one aggregate), until no category moves.
    Products then take their category's end point with one join.  Counters
    of categories no accepted move touched keep their stored value."""
    cats = t.categorias.select("id_categoria")
    r = (requests.join(cats.select(F.col("id_categoria").alias("origen"), F.lit(True).alias("_o")), "origen", "left")
         .join(cats.select(F.col("id_categoria").alias("destino"), F.lit(True).alias("_d")), "destino", "left"))
    ok = F.col("_o").isNotNull() & F.col("_d").isNotNull()
    decisions = r.select("request_id", ok.alias("accepted"), F.when(~ok, F.lit(MSG_NO_CATEGORIES)).alias("reason"))
    moves = r.where(ok).select("request_id", "ts", "origen", "destino").checkpoint(eager=True)
    me = F.struct(*ORDER)
    walk = moves.select(F.col("origen").alias("_start")).distinct().select(
        "_start", F.col("_start").alias("_cur"), F.lit(None).cast(moves.select(me).schema[0].dataType).alias("_pos"),
        F.lit(False).alias("_changed"))
    while True:
        walk = walk.checkpoint(eager=True)
        step = (walk.join(moves, F.col("_cur") == F.col("origen"))
                .where(F.col("_pos").isNull() | (me > F.col("_pos")))
                .groupBy("_start").agg(F.min(F.struct(*ORDER, "destino")).alias("_m"))
                .checkpoint(eager=True))
        if step.isEmpty():
            break
        walk = (walk.join(step, "_start", "left")
                .select("_start", F.coalesce("_m.destino", "_cur").alias("_cur"),
                        F.when(F.col("_m").isNotNull(), F.struct(F.col("_m.ts").alias("ts"),
                                                                  F.col("_m.request_id").alias("request_id")))
                        .otherwise(F.col("_pos")).alias("_pos"),
                        (F.col("_changed") | F.coalesce(F.col("_m.destino") != F.col("_cur"), F.lit(False)))
                        .alias("_changed")))
    ends = walk.select(F.col("_start").alias("id_categoria"), "_cur", "_changed")
    p = t.productos.select("id_producto", "id_categoria").join(ends, "id_categoria", "left")
    products = p.select("id_producto", F.coalesce("_cur", "id_categoria").alias("id_categoria"),
                        F.coalesce("_changed", F.lit(False)).alias("stamped"))
    touched = (moves.select(F.col("origen").alias("id_categoria"))
               .unionByName(moves.select(F.col("destino").alias("id_categoria"))).distinct()
               .withColumn("_touched", F.lit(True)))
    counts = products.groupBy("id_categoria").agg(F.count(F.lit(1)).alias("_n"))
    cat_state = (t.categorias.select("id_categoria", "total_productos").join(touched, "id_categoria", "left")
                 .join(counts, "id_categoria", "left")
                 .select(F.col("id_categoria").alias("category_id"),
                         F.when(F.col("_touched").isNotNull(), F.coalesce("_n", F.lit(0)))
                         .otherwise(F.col("total_productos")).cast("bigint").alias("total_products")))
    return {"decisions": decisions, "categories": cat_state, "products": products}


__all__ = [n for n in dir() if n.startswith("bat_")] + ["erased_customers", "floored_totals"]
