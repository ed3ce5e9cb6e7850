from ledgerlake.functions.scalars import (  # noqa: F401
    coalesce_default,
    decode_object_key,
    exact_decimal,
    rounded,
    money,
    money_sum,
    month_start,
    nonempty,
    period_key,
    period_literal,
    to_day,
)
