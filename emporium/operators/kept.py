"""A result that later steps read more than once, stored as Parquet in the
shared checkpoint folder: columnar and compressed, so it takes a fraction of
``checkpoint()``'s rows, and a filter or a few columns reach the reader."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from emporium.session import ensure_checkpoint_dir


def kept(df: DataFrame, name: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/kept/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
