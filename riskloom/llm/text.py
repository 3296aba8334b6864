"""Text helpers shared by the operators: ASCII lower-casing, words, and column names that cannot clash."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that ends a word, as bytes 0x20 and 0x09-0x0D.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept.

    ``lower`` also changes other alphabets, so it is used only where it changes
    nothing else: texts without characters beyond ASCII, or whose characters
    beyond ASCII have no other lower form.
    """
    beyond = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    plain = (F.octet_length(text) == F.char_length(text)) | (F.lower(beyond) == beyond)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_digest(df: DataFrame) -> Column:
    """MD5 of a whole row, as hexadecimal digits: every value with its length in front, nulls as ``-``."""
    parts = []
    for name in df.columns:
        value = F.col(f"`{name}`").cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.char_length(value), F.lit(":"), value)))
    return F.md5(F.concat(*parts))


def whole(column: pa.Array) -> pa.Array:
    """Texts with null as the empty text."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array]:
    """Words of every text: the number of words per text, and all words in order."""
    texts = whole(column)
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_trim(texts, characters=SPACE))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    counts[pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)] = 0
    blank = pc.equal(pc.binary_length(flat), 0)
    if pc.any(blank).as_py():
        # a text of white space alone splits into one empty word
        owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        keep = ~blank.to_numpy(zero_copy_only=False)
        counts = np.bincount(owner[keep], minlength=len(texts)).astype(np.int64)
        flat = flat.filter(pa.array(keep))
    return counts, flat


def mixed(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit mix (SplitMix64) of integer arrays, equal on every machine."""
    state = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for part in parts:
            part = np.asarray(part).astype(np.int64, copy=False).view(np.uint64)
            z = (part ^ state) + np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            state = z ^ (z >> np.uint64(31))
    return state


def uniform(*parts: np.ndarray | int) -> np.ndarray:
    """Numbers in [0, 1) from the mix, 53 bits each."""
    return (mixed(*parts) >> np.uint64(11)).astype(np.float64) * 2.0**-53
