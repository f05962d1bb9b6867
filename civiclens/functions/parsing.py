"""Lenient readings of untidy text. Text that does not fit becomes NULL, also under ANSI."""

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclens import contracts


def lenient_int(text: Column) -> Column:
    """Whole number or NULL. Blanks around it are fine; ``12.7`` is not a whole number."""
    return text.try_cast("int")


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def parse_date_any(
    text: Column, formats: Sequence[tuple[int, str]] = contracts.DATE_FORMATS
) -> Column:
    """Date read by the first format that fits, from as many leading tokens as it needs.

    A failed parse costs far more than a successful one. A pattern with a
    separator of its own, such as a slash, can fit only text that has it, so
    those patterns come first and are tried on such text only.
    """
    routed, plain = [], []
    for tokens, pattern in formats:
        parsed = F.try_to_date(F.substring_index(text, " ", tokens), pattern)
        separator = re.search(r"[^A-Za-z ']", pattern)
        if separator:
            routed.append(F.when(text.contains(separator.group()), parsed))
        else:
            plain.append(parsed)
    return F.coalesce(*routed, *plain)


def money_to_int(text: Column) -> Column:
    """``$52,806`` to 52806; a dash, a blank or a decimal to NULL."""
    return lenient_int(F.regexp_replace(text, contracts.MONEY_NOISE, ""))


def timer_label(line: Column) -> Column:
    """Label of a timer line, up to its last colon; NULL for any other line."""
    return F.nullif(F.regexp_extract(line, contracts.TIMER_LINE, 1), F.lit(""))


def timer_seconds(line: Column) -> Column:
    return lenient_double(F.regexp_extract(line, contracts.TIMER_LINE, 2))
