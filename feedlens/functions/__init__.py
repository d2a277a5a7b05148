from feedlens.functions.columns import (
    age_group, bucket_of, day_of, gender_label, hash_u32, hm, md5_u32,
    ratio, round_doubles, slot_start, time_range, week_start, xx_u32,
)

__all__ = [
    "age_group", "bucket_of", "day_of", "gender_label", "hash_u32", "hm", "md5_u32",
    "ratio", "round_doubles", "slot_start", "time_range",
    "week_start", "xx_u32",
]
