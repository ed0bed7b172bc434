from millrace.functions.columns import (
    held_out,
    hash_share,
    key_hash,
    micros,
    money,
    rounded,
    rounded_all,
    seconds_between,
    unit_interval,
)

__all__ = ["hash_share", "held_out", "key_hash", "micros", "money", "rounded", "rounded_all", "seconds_between", "unit_interval"]
