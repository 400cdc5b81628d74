"""64-bit hashes of user names. Outside they are unsigned: DECIMAL(20,0); inside, keys are the same bits as a signed long."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

METHODS = ("sha256_64", "md5_64", "xxh64", "pandas_64")
TWO64 = "18446744073709551616"


def _little_endian(hex_text: Column) -> Column:
    """The first eight bytes of a hex text, last byte first, as a signed long."""
    swapped = F.concat(*[F.substring(hex_text, 2 * i + 1, 2) for i in range(7, -1, -1)])
    return F.conv(swapped, 16, -10).cast("long")


@F.arrow_udf(LongType())
def _xxh64(texts: pa.Array) -> pa.Array:
    import numpy as np
    import xxhash

    return pa.array(np.array([xxhash.xxh64_intdigest(t.encode(), 0) if t else 0 for t in texts.to_pylist()], np.uint64).view(np.int64))


@F.arrow_udf(LongType())
def _pandas64(texts: pa.Array) -> pa.Array:
    import numpy as np

    values = pd.util.hash_pandas_object(pd.Series(texts.to_pylist(), dtype=object), index=False).to_numpy()
    return pa.array(values.view(np.int64))


def uid_key(name: Column, method: str = "sha256_64") -> Column:
    """The hash as a signed long: the key for grouping and joining. Empty and null names hash to 0 (but for pandas_64)."""
    text = F.coalesce(name, F.lit(""))
    if method == "sha256_64":
        return F.when(text == "", F.lit(0).cast("long")).otherwise(_little_endian(F.sha2(text, 256)))
    if method == "md5_64":
        return F.when(text == "", F.lit(0).cast("long")).otherwise(_little_endian(F.md5(text)))
    if method == "xxh64":
        return _xxh64(text)
    if method == "pandas_64":
        return _pandas64(text)
    raise ValueError(f"unknown hash method: {method}")


def unsigned(key: Column) -> Column:
    """A signed long's bits as an unsigned number."""
    wide = key.cast("decimal(20,0)")
    return F.when(key < 0, (wide + F.lit(TWO64).cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(wide)


def uid64(name: Column, method: str = "sha256_64") -> Column:
    return unsigned(uid_key(name, method))
