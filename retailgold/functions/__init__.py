from retailgold.functions.keys import check_id, card_prefix, card_suffix, is_missing, key_part
from retailgold.functions.lenient import lenient_date, lenient_double, lenient_int, settlement_date
from retailgold.functions.names import (
    date_from_name, feed_folder, feed_from_name, file_name, partition_value, shift_day,
)

__all__ = [
    "check_id", "card_prefix", "card_suffix", "is_missing", "key_part",
    "lenient_date", "lenient_double", "lenient_int", "settlement_date",
    "date_from_name", "feed_folder", "feed_from_name", "file_name", "partition_value", "shift_day",
]
