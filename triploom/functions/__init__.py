from triploom.functions.columns import (
    any_null,
    epoch_micros,
    epoch_seconds,
    money_sum,
    none_null,
)

__all__ = ["any_null", "epoch_micros", "epoch_seconds", "money_sum", "none_null"]
