"""Id -> name lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def with_names(df: DataFrame, names: DataFrame, key: str, name_key: str = "code",
               name_col: str = "description", out: str = "name") -> DataFrame:
    """Left join of a name onto ``df[key]``; unknown ids get a null name.

    The lookup key is cast to the type of ``df[key]`` once on the lookup side
    (text ids in the lookup file, integer ids in the data); a code that does
    not parse matches nothing. No size is probed while the plan is built:
    adaptive execution broadcasts the lookup if its measured size allows it
    and shuffles both sides otherwise.
    """
    key_type = df.schema[key].dataType
    lk = (names.select(F.col(name_key).try_cast(key_type).alias("_lk"), F.col(name_col).alias(out))
               .groupBy("_lk").agg(F.max(out).alias(out)))
    return df.join(lk, df[key] == lk["_lk"], "left").drop("_lk")
