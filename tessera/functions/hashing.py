"""The deterministic hash that samples entities and deals folds, the same on every machine."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

# Multipliers of the 64-bit finaliser.
MULTIPLIERS = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def hash01_of(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) of each key: 53 bits of a finaliser over key + salt, modulo 2**64."""
    v = keys.astype(np.int64).view(np.uint64) + np.uint64(salt)
    half = np.uint64(33)
    for m in MULTIPLIERS:
        v ^= v >> half
        v *= np.uint64(m)
    v ^= v >> half
    return np.ldexp((v >> np.uint64(11)).astype(np.float64), -53)


def _hash01(keys: pd.Series, salts: pd.Series) -> pd.Series:
    out = pd.Series(np.nan, index=keys.index)
    for s in salts.unique():
        at = (salts == s) & keys.notna()
        out[at] = hash01_of(keys[at].to_numpy(np.int64), int(s))
    return out


def hash01_udf():  # made when a session is there
    """hash01(key, salt) as a vectorised function; null keys give null."""
    return F.pandas_udf(_hash01, "double")
