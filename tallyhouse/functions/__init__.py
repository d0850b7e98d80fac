from tallyhouse.functions.cleaning import label_missing, text_to_float, text_to_int
from tallyhouse.functions.text import access_log_fields, whitespace_field, without_quotes
from tallyhouse.functions.years import day_text, decade, realistic_year

__all__ = [
    "access_log_fields",
    "day_text",
    "decade",
    "label_missing",
    "realistic_year",
    "text_to_float",
    "text_to_int",
    "whitespace_field",
    "without_quotes",
]
