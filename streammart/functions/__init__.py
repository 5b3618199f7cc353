from streammart.functions.scalars import (  # noqa: F401
    as_decimal,
    as_int,
    camel_name,
    colon_key,
    day_of,
    day_start_ms,
    epoch_ms,
    event_time,
    is_blank,
    json_map,
    keep_keys,
    not_blank,
    parsed_once,
    partition_day,
    snake_columns,
    snake_name,
    stamp_of,
    today_partition,
)
from streammart.functions.text import explode_words, register_functions, words_of  # noqa: F401
