"""Governance steps advertised by the source system (O2, O3).

Both are plain projections / joins applied as a last step, so they compose
with any dataset and keep pushdown below them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: columns holding personal data in the driver/vehicle master.
PII_COLUMNS = ("driver_phone", "driver_license_no")

# environment -> masking method for PII columns (None = visible)
MASKING_BY_ENV = {"dev": None, "uat": "hash", "prod": "redact"}


#: Session setting with the secret key of hashed columns.
MASKING_KEY_CONF = "fleetspark.masking.key"


def masking_key(spark: SparkSession) -> str:
    key = spark.conf.get(MASKING_KEY_CONF, None)
    if not key:
        raise ValueError(f"set {MASKING_KEY_CONF}: a hash without a key can be reversed by trying all values")
    return key


def mask_columns(df: DataFrame, columns: Sequence[str], method: str = "hash", keep_last: int = 2, key: str | None = None) -> DataFrame:
    """O2: ``hash`` -> SHA-256 hex of key, value and key (joins on it still work; the key is ``key`` or the
    session's ``fleetspark.masking.key``, and is an error if neither is set);
    ``redact`` -> every character but the last ``keep_last`` replaced by '*'.
    NULL stays NULL."""
    out = df
    for c in columns:
        col = F.col(c).cast("string")
        if method == "hash":
            secret = F.lit(key or masking_key(df.sparkSession))
            masked = F.sha2(F.concat(secret, F.lit(":"), col, F.lit(":"), secret), 256)
        elif method == "redact":
            n = F.length(col)
            masked = F.concat(F.expr(f"repeat('*', greatest(length(`{c}`) - {keep_last}, 0))"), F.substring(col, -keep_last, keep_last))
            masked = F.when(n <= keep_last, F.expr(f"repeat('*', length(`{c}`))")).otherwise(masked)
        else:
            raise ValueError(method)
        out = out.withColumn(c, F.when(col.isNull(), F.lit(None).cast("string")).otherwise(masked))
    return out


def mask_for_environment(df: DataFrame, env: str, columns: Sequence[str] = PII_COLUMNS, key: str | None = None) -> DataFrame:
    method = MASKING_BY_ENV[env.lower()]
    present = [c for c in columns if c in df.columns]
    return df if method is None or not present else mask_columns(df, present, method, key=key)


def restrict_rows(df: DataFrame, grants: DataFrame, principal: str, column: str, grant_column: str | None = None) -> DataFrame:
    """O3: keep the rows whose ``column`` value is granted to ``principal``
    in ``grants(principal, <grant_column>)``. A left-semi join: each row is
    kept at most once whatever the number of matching grants, and the grants
    side is reduced to its distinct values for the principal first.

    No broadcast hint: a grants table that measures small is broadcast by AQE. Grants that are configuration
    belong in ``restrict_rows_to``."""
    grant_column = grant_column or column
    allowed = grants.where(F.col("principal") == principal).select(F.col(grant_column).alias("_granted")).distinct()
    return df.join(allowed, F.col(column) == F.col("_granted"), "left_semi")


def restrict_rows_to(df: DataFrame, grants: Iterable[tuple[str, str]], principal: str, column: str) -> DataFrame:
    """O3 with grants from configuration, as (principal, value): a plain predicate, which reaches the scan and
    moves no row. A principal without grants sees nothing."""
    values = sorted({value for who, value in grants if who == principal})
    return df.where(F.col(column).isin(values) if values else F.lit(False))
