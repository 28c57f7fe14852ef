"""Column expressions: all JVM-side, no Python UDFs.

Each function takes and returns ``pyspark.sql.Column`` so that it fuses into
the surrounding whole-stage-codegen span.
"""

from tallyframe.functions.common import round6, strip_ws, null_if_na_word, NA_WORDS
from tallyframe.functions.numbers import (
    num_mean, num_or_listcount, num_range, num_first, num_strict,
)
from tallyframe.functions.text import (
    WORD_PATTERN, STOP_WORDS, tokens, split_options,
)
from tallyframe.functions.hashing import md5_bucket
from tallyframe.functions.categorical import ordinal_map, HOT_SAUCE_ORDER, PRIORITY_ORDER

__all__ = [
    "round6", "strip_ws", "null_if_na_word", "NA_WORDS",
    "num_mean", "num_or_listcount", "num_range", "num_first", "num_strict",
    "WORD_PATTERN", "STOP_WORDS", "tokens", "split_options",
    "md5_bucket", "ordinal_map", "HOT_SAUCE_ORDER", "PRIORITY_ORDER",
]
