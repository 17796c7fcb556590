"""Table contracts. Tables may have more columns than these."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType


def _schema(**kinds) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in kinds.items()])


DAILY = _schema(
    permno=LongType, date=DateType, price_raw=DoubleType, market_cap_kusd=DoubleType, ret_total=DoubleType, ret_ex_div=DoubleType,
    volume_raw_shares=DoubleType, delist_flag=StringType, price_flag=StringType, market_cap_flag=StringType, ret_missing_flag=StringType,
    distribution_return_flag=StringType,
)
HISTORY = _schema(
    permno=LongType, valid_from=DateType, valid_to=DateType, ticker=StringType, cusip=StringType, primary_exchange=StringType,
    share_type=StringType, security_type=StringType, security_subtype=StringType, us_incorporated_flag=StringType, issuer_type=StringType,
    trading_status_flag=StringType, conditional_type=StringType, share_class=StringType,
)
TERMINAL = _schema(
    permno=LongType, event_date=DateType, delisting_return=DoubleType, action_type=StringType, status_type=StringType,
    reason_type=StringType, payment_type=StringType, successor_permno=LongType, successor_permco=LongType,
)


class ContractError(ValueError):
    """A table breaks its contract."""


def require_columns(df: DataFrame, columns, types: bool = False) -> DataFrame:
    """``df`` itself, if it has all of ``columns`` (names or a schema), and with ``types``
    those of the schema; only names and types are read."""
    names = columns.names if isinstance(columns, StructType) else list(columns)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ContractError(f"columns missing: {', '.join(missing)}")
    wrong = [f"{c.name} is {df.schema[c.name].dataType.simpleString()}, not {c.dataType.simpleString()}" for c in columns if df.schema[c.name].dataType != c.dataType] if types else []
    if wrong:
        raise ContractError("; ".join(wrong))
    return df
