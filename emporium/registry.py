"""Name -> job wiring used by ``__spark_entry__`` and ``bench.py``.

Every entry takes ``(spark, sf_dir)``, builds the reference-shaped catalog
for that folder and returns the job's DataFrame.  ``ORACLE`` holds the
DuckDB SQL twin for the keys that have one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.operators import report_sink
from emporium.oracle.adapter_sql import with_adapter
from emporium.plans import analytics as Q
from emporium.plans import batch as B
from emporium.plans import changes as C
from emporium.plans import enrich as F_
from emporium.plans import periodic as E
from emporium.plans import quality as DQ
from emporium.plans import reports as P
from emporium.plans import views as V
from emporium.session import ensure_checkpoint_dir
from emporium.streaming import streams as ST
from emporium.sources.testdata import AS_OF, AS_OF_EVENTS, AS_OF_EVENTS_NEXT, AS_OF_NEXT, RETENTION_AS_OF, TestdataCatalog

Job = Callable[[SparkSession, str], DataFrame]


def _cat(fn, **kw) -> Job:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(TestdataCatalog(spark, sf_dir), **kw)
    run.__name__ = getattr(fn, "__name__", "job")
    return run


def _sink(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/reports/{uuid.uuid4().hex}"


def _history(fn, first: str = AS_OF, then: str = AS_OF_NEXT) -> Job:
    """A report run twice for one point in time and once for the next, read
    back from its sink."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, folder = TestdataCatalog(spark, sf_dir), _sink(spark)
        for as_of in (first, first, then):
            report_sink.publish(fn(t, as_of), folder, as_of[:10])
        return report_sink.history(spark, folder)
    return run


def _over_stored(before, after) -> Job:
    """``after(t, target)`` over a target that ``before(t)`` stored."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t, folder = TestdataCatalog(spark, sf_dir), _sink(spark)
        report_sink.publish(before(t), folder, AS_OF[:10])
        return after(t, report_sink.history(spark, folder).drop("run_date"))
    return run


def _velocity(t, as_of: str) -> DataFrame:
    return E.job_order_velocity(t.order_requests.select("id_cliente", F.col("ts").alias("fecha_venta")), as_of,
                                window_hours=24, min_orders=2)


def _line_requests(t) -> DataFrame:
    return t.order_requests.select("request_id", "ts", "id_producto", "cantidad")


def _inserts(df: DataFrame, key: str) -> DataFrame:
    return C.as_inserts(df, [key], AS_OF, C.ACTOR)


def _purge_feed(t) -> DataFrame:
    from emporium.operators.changes import diff_snapshots
    from emporium.operators.overlay import delete_keys
    gone = E.job_purge_products(t, AS_OF).select(F.col("product_id").alias("id_producto"))
    return diff_snapshots(t.productos, delete_keys(t.productos, gone, ["id_producto"]), ["id_producto"], AS_OF, C.ACTOR)


QUERIES: dict[str, Job] = {
    "q01_top_revenue_products": _cat(Q.q01_top_revenue_products),
    "q02_slowest_10pct": _cat(Q.q02_slowest_10pct),
    "q03_customer_ltv": _cat(Q.q03_customer_ltv),
    "q04_monthly_trend": _cat(Q.q04_monthly_trend),
    "q05_new_customers_quarter": _cat(Q.q05_new_customers_quarter),
    "q06_repeat_rate": _cat(Q.q06_repeat_rate),
    "q07_basket_pairs": _cat(Q.q07_basket_pairs),
    "q08_category_turnover": _cat(Q.q08_category_turnover),
    "q09_critical_stock": _cat(Q.q09_critical_stock),
    "q10_abandoned_carts": _cat(Q.q10_abandoned_carts, as_of=AS_OF_EVENTS),
    "q11_supplier_revenue": _cat(Q.q11_supplier_revenue),
    "q12_geo_sales": _cat(Q.q12_geo_sales),
    "q13_hourly": _cat(Q.q13_hourly),
    "q14_promo_effect": _cat(Q.q14_promo_effect),
    "q15_cohorts": _cat(Q.q15_cohorts),
    "q16_gross_margin": _cat(Q.q16_gross_margin),
    "q17_days_between": _cat(Q.q17_days_between),
    "q18_view_conversion": _cat(Q.q18_view_conversion),
    "q19_rfm": _cat(Q.q19_rfm, as_of=AS_OF),
    "q20_run_rate": _cat(Q.q20_run_rate, as_of=AS_OF),
    # F: enrichment jobs
    "enr_orders": _cat(F_.enr_orders, as_of=AS_OF),
    "enr_customers": _cat(F_.enr_customers, as_of=AS_OF),
    "enr_products": _cat(F_.enr_products),
    "enr_availability": _cat(F_.enr_availability),
    "enr_promo_prices": _cat(F_.enr_promo_prices),
    "enr_category_stock": _cat(F_.enr_category_stock),
    # V, R: views and role projection
    "v_customers_basic": _cat(V.v_customers_basic),
    "v_public_catalog": _cat(V.v_public_catalog),
    "v_public_orders": _cat(V.v_public_orders),
    "r1_role_projection": _cat(V.role_projection, role="Analista_Datos", table="clientes"),
    # P (read): reports
    "rpt_purchase_history": _cat(P.rpt_purchase_history),
    "rpt_monthly_sales": _cat(P.rpt_monthly_sales, year=2001, month=7),
    "rpt_product_360": _cat(P.rpt_product_360),
    "rpt_search_products": _cat(P.rpt_search_products, term=" blue "),
    "rpt_dashboard": _cat(P.rpt_dashboard),
    "rpt_related_products": _cat(P.rpt_related_products),
    # E, S: periodic jobs
    "job_weekly_sales": _cat(E.job_weekly_sales, as_of=AS_OF),
    "job_converted_cart_cleanup": _cat(E.job_converted_cart_cleanup),
    "job_log_retention_actions": _cat(lambda t: E.job_log_retention(t, RETENTION_AS_OF)["log_permisos"]),
    "job_log_retention_logins": _cat(lambda t: E.job_log_retention(t, RETENTION_AS_OF)["logins_fallidos"]),
    "job_expire_promos": _cat(E.job_expire_promos, as_of=AS_OF),
    "job_loyalty_tiers": _cat(E.job_loyalty_tiers),
    "job_reorder_list": _cat(E.job_reorder_list, as_of=AS_OF),
    "job_suspend_inactive": _cat(E.job_suspend_inactive, as_of=AS_OF),
    "job_daily_sales": _cat(E.job_daily_sales, as_of=AS_OF, backfill_from="first_order"),
    "job_order_total_audit": _cat(E.job_order_total_audit),
    "job_birthdays": _cat(E.job_birthdays, as_of=AS_OF),
    "job_product_ranking": _cat(E.job_product_ranking, as_of=AS_OF),
    "job_catalog_snapshot": _cat(E.job_catalog_snapshot, as_of=AS_OF),
    "job_mark_abandoned": _cat(E.job_mark_abandoned, as_of=AS_OF_EVENTS),
    "job_monthly_kpis": _cat(E.job_monthly_kpis, as_of=AS_OF),
    "job_refresh_counters": _cat(E.job_refresh_counters),
    "job_order_velocity": _cat(_velocity, as_of=AS_OF_EVENTS),
    "job_supplier_month": _cat(E.job_supplier_month, as_of=AS_OF),
    "job_purge_products": _cat(E.job_purge_products, as_of=AS_OF),
    "job_seed_category_count": _cat(E.job_seed_category_count),
    "job_seed_product_counters": _cat(E.job_seed_product_counters),
    # E: reports appended by run date, and upsert / insert-ignore over a stored table
    "job_weekly_sales_history": _history(E.job_weekly_sales),
    "job_reorder_list_history": _history(E.job_reorder_list),
    "job_catalog_snapshot_history": _history(E.job_catalog_snapshot),
    "job_monthly_kpis_history": _history(E.job_monthly_kpis),
    "job_order_velocity_history": _history(_velocity, AS_OF_EVENTS, AS_OF_EVENTS_NEXT),
    "job_daily_sales_upsert": _over_stored(lambda t: E.job_daily_sales(t, AS_OF, backfill_from="first_order"),
                                           lambda t, old: E.job_daily_sales(t, AS_OF_NEXT, old, backfill_from=AS_OF[:10])),
    "job_catalog_snapshot_ignore": _over_stored(lambda t: E.job_catalog_snapshot(t, AS_OF), lambda t, old: E.job_catalog_snapshot(
        t, AS_OF_NEXT, E.job_catalog_snapshot(t, AS_OF, old))),
    # DQ: constraints as data-quality reports
    "dq_checks": _cat(DQ.dq_checks),
    "dq_unique": _cat(DQ.dq_unique),
    "dq_orphans": _cat(DQ.dq_orphans),
    "dq_not_null": _cat(DQ.dq_not_null),
    # T: change-feed jobs
    "chg_price_log": _cat(lambda t: C.chg_price_log(C.product_feed(t, AS_OF))),
    "chg_stock_admission": _cat(lambda t: C.chg_stock_admission(_line_requests(t), t.productos)),
    "chg_stock_ledger": _cat(lambda t: C.chg_stock_ledger(C.chg_stock_admission(_line_requests(t), t.productos),
                                                          t.productos)),
    "chg_category_delete_guard": _cat(lambda t: C.chg_category_delete_guard(t.categorias.select("id_categoria"),
                                                                            t.productos)),
    "chg_new_customer_log": _cat(lambda t: C.chg_new_customer_log(_inserts(t.clientes, "id_cliente"))),
    "chg_customer_spend": _cat(lambda t: C.chg_customer_spend(C.order_feed(t, AS_OF), t.clientes)),
    "chg_catalog_stamp": _cat(lambda t: C.chg_catalog_stamp(C.product_feed(t, AS_OF))),
    "chg_negative_stock": _cat(lambda t: C.chg_negative_stock(C.product_feed(t, AS_OF))),
    "chg_name_normalise": _cat(lambda t: C.chg_name_normalise(_inserts(t.clientes, "id_cliente"))),
    "chg_order_total": _cat(lambda t: C.chg_order_total(C.line_feed(t, AS_OF), t.ventas, t.detalle_ventas_after)),
    "chg_order_status_log": _cat(lambda t: C.chg_order_status_log(C.order_feed(t, AS_OF))),
    "chg_price_positive": _cat(lambda t: C.chg_price_positive(_inserts(t.productos_base, "id_producto"))),
    "chg_low_stock_alert": _cat(lambda t: C.chg_low_stock_alert(C.product_feed(t, AS_OF))),
    "chg_archive_orders": _cat(lambda t: C.chg_archive_orders(C.order_feed(t, AS_OF))),
    "chg_email_valid": _cat(lambda t: C.chg_email_valid(_inserts(t.clientes, "id_cliente"))),
    "chg_last_order_date": _cat(lambda t: C.chg_last_order_date(
        t.order_requests.select("id_cliente", F.col("ts").alias("fecha_venta")), t.clientes)),
    "chg_self_referral": _cat(lambda t: C.chg_self_referral(C.customer_feed(t, AS_OF))),
    "chg_default_category": _cat(lambda t: C.chg_default_category(_inserts(t.productos_base, "id_producto"))),
    "chg_category_count": _cat(lambda t: C.chg_category_count(
        _inserts(t.productos_base, "id_producto"), _purge_feed(t),
        t.categorias.withColumn("total_productos", F.lit(0)))),
    "chg_customer_audit": _cat(lambda t: C.chg_customer_audit(C.customer_feed(t, AS_OF))),
    # P (write): request batches
    "bat_orders": _cat(lambda t: B.bat_orders(t, t.order_requests)["decisions"]),
    "bat_orders_stock": _cat(lambda t: B.bat_orders(t, t.order_requests)["stock"]),
    "bat_new_products": _cat(lambda t: B.bat_new_products(t, t.product_requests)),
    "bat_address_updates": _cat(lambda t: B.bat_address_updates(t, t.address_requests)["decisions"]),
    "bat_address_state": _cat(lambda t: B.bat_address_updates(t, t.address_requests)["state"]),
    "bat_address_audit": _cat(lambda t: B.bat_address_updates(t, t.address_requests)["audit"]),
    "bat_returns": _cat(lambda t: B.bat_returns(t, t.return_requests)["decisions"]),
    "bat_returns_cancelled": _cat(lambda t: B.bat_returns(t, t.return_requests)["cancelled"]),
    "bat_returns_stock": _cat(lambda t: B.bat_returns(t, t.return_requests)["stock"]),
    "bat_stock_adjust": _cat(lambda t: B.bat_stock_adjust(t, t.stock_adjust_requests)["decisions"]),
    "bat_stock_adjust_stock": _cat(lambda t: B.bat_stock_adjust(t, t.stock_adjust_requests)["stock"]),
    "bat_stock_adjust_log": _cat(lambda t: B.bat_stock_adjust(t, t.stock_adjust_requests)["log"]),
    "bat_customer_erasure": _cat(lambda t: B.bat_customer_erasure(t, t.erasure_requests)),
    "bat_category_promos": _cat(lambda t: B.bat_category_promos(t, t.category_promo_requests)),
    "bat_order_transitions": _cat(lambda t: B.bat_order_transitions(t, t.transition_requests)["decisions"]),
    "bat_order_transitions_stock": _cat(lambda t: B.bat_order_transitions(t, t.transition_requests)["stock"]),
    "bat_register_customers": _cat(lambda t: B.bat_register_customers(t, t.registration_requests)),
    "bat_merge_accounts": _cat(lambda t: B.bat_merge_accounts(t, t.merge_requests)["decisions"]),
    "bat_merge_customers": _cat(lambda t: B.bat_merge_accounts(t, t.merge_requests)["customers"]),
    "bat_merge_reviews": _cat(lambda t: B.bat_merge_accounts(t, t.merge_requests)["reviews"]),
    "bat_merge_orders": _cat(lambda t: B.bat_merge_accounts(t, t.merge_requests)["orders"]),
    "bat_merge_views": _cat(lambda t: B.bat_merge_accounts(t, t.merge_requests)["views"]),
    "bat_merge_carts": _cat(lambda t: B.bat_merge_accounts(t, t.merge_requests)["carts"]),
    "bat_assign_supplier": _cat(lambda t: B.bat_assign_supplier(t, t.supplier_requests)),
    "bat_payments": _cat(lambda t: B.bat_payments(t, t.payment_requests)),
    "bat_review_upsert": _cat(lambda t: B.bat_review_upsert(t, t.review_requests)["state"]),
    "bat_review_decisions": _cat(lambda t: B.bat_review_upsert(t, t.review_requests)["decisions"]),
    "bat_move_category": _cat(lambda t: B.bat_move_category(t, t.category_move_requests)["categories"]),
    "bat_move_category_products": _cat(lambda t: B.bat_move_category(t, t.category_move_requests)["products"]),
    # ST: streaming jobs (availableNow runs into file sinks)
    "st_order_velocity": lambda spark, sf_dir: ST.st_order_velocity(spark, sf_dir),
    "st_order_velocity_sliding": lambda spark, sf_dir: ST.st_order_velocity_sliding(spark, sf_dir),
    "st_cart_abandonment": lambda spark, sf_dir: ST.st_cart_abandonment(spark, sf_dir),
    "st_open_carts": lambda spark, sf_dir: ST.st_open_carts(spark, sf_dir),
    "st_price_log": _cat(ST.st_price_log, ts=AS_OF),
    "st_status_log": _cat(ST.st_status_log, ts=AS_OF),
    "st_customer_audit": _cat(ST.st_customer_audit, ts=AS_OF),
    "st_low_stock": _cat(ST.st_low_stock, as_of=AS_OF),
    "st_daily_sales": _cat(ST.st_daily_sales),
}


def _oracle() -> dict[str, str]:
    from emporium.oracle.analytics_sql import SQL as QSQL
    from emporium.oracle.enrich_sql import SQL as FSQL
    from emporium.oracle.periodic_sql import SQL as ESQL
    from emporium.oracle.quality_sql import SQL as DSQL
    from emporium.oracle.changes_sql import SQL as TSQL
    from emporium.oracle.batch_sql import SQL as BSQL
    from emporium.oracle.streams_sql import SQL as SSQL
    out: dict[str, str] = {}
    for src in (QSQL, FSQL, ESQL, DSQL, TSQL, BSQL, SSQL):
        for k, v in src.items():
            out[k] = with_adapter(v)
    return out


ORACLE: dict[str, str] = _oracle()
