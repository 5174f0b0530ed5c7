"""Promotion scope join without a nested loop.

A promotion applies to a product when ``promo.product = product`` or, when
the promotion has no product, ``promo.category = product.category``.  The
OR-condition cannot be hashed, so it is split into two equi joins whose
outputs are disjoint (the second requires ``promo.product IS NULL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scoped_products(promos: DataFrame, products: DataFrame,
                    promo_product: str = "id_producto", promo_category: str = "id_categoria") -> DataFrame:
    """Rows of ``promos`` extended with the ``id_producto`` of every product
    in scope.  ``products`` needs ``id_producto`` and ``id_categoria``."""
    p = products.select(F.col("id_producto").alias("_pid"), F.col("id_categoria").alias("_pcat"))
    by_product = (promos.where(F.col(promo_product).isNotNull())
                  .join(p, F.col(promo_product) == F.col("_pid")))
    by_category = (promos.where(F.col(promo_product).isNull() & F.col(promo_category).isNotNull())
                   .join(p, F.col(promo_category) == F.col("_pcat")))
    both = by_product.unionByName(by_category)
    return both.drop(promo_product, "_pcat").withColumnRenamed("_pid", "id_producto")
