from txnguard.functions.expressions import (
    calendar_columns, epoch_micros, haversine_km, rounded, zscore, zscore_unit,
)

__all__ = ["calendar_columns", "epoch_micros", "haversine_km", "rounded",
           "zscore", "zscore_unit"]
