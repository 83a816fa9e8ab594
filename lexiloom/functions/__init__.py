from lexiloom.functions.registry import register_functions
from lexiloom.functions.stats import finite, llr, mutual_information, safe_long
from lexiloom.functions.stopwords import HEBREW, StopWords, is_stopword
from lexiloom.functions.text import clean_token, decade, parse_int, strip_control

__all__ = [
    "HEBREW",
    "StopWords",
    "clean_token",
    "decade",
    "finite",
    "is_stopword",
    "llr",
    "mutual_information",
    "parse_int",
    "register_functions",
    "safe_long",
    "strip_control",
]
