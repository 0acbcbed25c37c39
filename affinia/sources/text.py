"""Delimited text input, columns picked by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fields(lines: DataFrame, sep: str) -> DataFrame:
    """Fields of each line, split by the regular expression ``sep``; trailing empty
    fields do not count."""
    kept = F.regexp_replace("value", f"(?:{sep})+$", "")
    return lines.select(F.split(kept, sep).alias("_f"))


def _at(position: int) -> Column:
    return F.get("_f", F.lit(position))


def parse_interactions(
    lines: DataFrame, sep: str = "\t", user_idx: int = 0, item_idx: int = 1, pref_idx: int | None = None
) -> DataFrame:
    """``user, item[, pref]`` from a text column ``value``.

    Lines with a single field are malformed and dropped; so are lines that end before
    one of the picked columns. A preference that is not a number becomes null.
    """
    picked = [_at(user_idx).alias("user"), _at(item_idx).alias("item")]
    if pref_idx is not None:
        picked.append(_at(pref_idx).try_cast("double").alias("pref"))
    last = max(user_idx, item_idx, -1 if pref_idx is None else pref_idx)
    return _fields(lines, sep).where(F.size("_f") > max(1, last)).select(*picked)


def read_interactions(
    spark: SparkSession, path: str, sep: str = "\t", user_idx: int = 0, item_idx: int = 1, pref_idx: int | None = None
) -> DataFrame:
    """Delimited text files as interactions; without ``pref_idx`` the data is boolean."""
    return parse_interactions(spark.read.text(path), sep, user_idx, item_idx, pref_idx)


def parse_criteria(
    lines: DataFrame,
    sep: str = "\t",
    user_idx: int = 0,
    item_idx: int = 1,
    pref_idxs: Sequence[int] | str = (2,),
    pref_count: int | None = None,
) -> DataFrame:
    """``user, item, c1 .. cm`` from a text column ``value``.

    ``pref_idxs`` is a list of positions or text such as ``"2-3-4"``. If ``pref_count``
    is given it must agree. Lines with m + 1 fields or fewer are dropped.
    """
    positions = [int(p) for p in pref_idxs.split("-")] if isinstance(pref_idxs, str) else list(pref_idxs)
    if pref_count is not None and pref_count != len(positions):
        raise ValueError(f"{pref_count} criteria announced, {len(positions)} positions given: {positions}")
    last = max(user_idx, item_idx, *positions)
    criteria = [_at(p).try_cast("double").alias(f"c{i + 1}") for i, p in enumerate(positions)]
    kept = _fields(lines, sep).where(F.size("_f") > max(len(positions) + 1, last))
    return kept.select(_at(user_idx).alias("user"), _at(item_idx).alias("item"), *criteria)


def read_criteria(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    user_idx: int = 0,
    item_idx: int = 1,
    pref_idxs: Sequence[int] | str = (2,),
    pref_count: int | None = None,
) -> DataFrame:
    """Delimited text files as interactions with several criteria."""
    return parse_criteria(spark.read.text(path), sep, user_idx, item_idx, pref_idxs, pref_count)
