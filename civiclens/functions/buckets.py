"""Part of the day from HHMM text, as an expression and as a Python UDF."""

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclens import contracts
from civiclens.functions.parsing import lenient_int


def day_part(time_text: Column, labels: Sequence[str] = contracts.DAY_PART_LABELS) -> Column:
    """Label of the half-open range the time falls in; NULL if it is no number.

    Numbers are not checked to be clock times: whatever lies before the first
    start or after the last is in the last part.
    """
    time = lenient_int(time_text)
    starts = contracts.DAY_PART_STARTS
    bucket = F.when(time < starts[0], labels[-1])
    for end, label in zip(starts[1:], labels):
        bucket = bucket.when(time < end, label)
    return bucket.when(time.isNotNull(), labels[-1])


def day_part_udf(labels: Sequence[str] = contracts.DAY_PART_LABELS):
    """The same as an Arrow-batched UDF, for comparison with the expression."""
    starts = np.array(contracts.DAY_PART_STARTS)
    names = np.array([labels[-1], *labels], dtype=object)

    @F.pandas_udf("string")
    def bucket(time_text: pd.Series) -> pd.Series:
        whole = time_text.str.extract(
            r"\A[\x00-\x20\x7f]*([+-]?[0-9]+)[\x00-\x20\x7f]*\Z", expand=False
        )
        time = pd.to_numeric(whole, errors="coerce").astype("float64")
        int_type = np.iinfo(np.int32)
        known = time.between(int_type.min, int_type.max)
        part = names[np.searchsorted(starts, time.fillna(0), side="right")]
        return pd.Series(part, index=time_text.index).where(known, None)

    return bucket
