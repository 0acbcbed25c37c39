"""Item-item similarity measures as Column expressions.

A measure says how one preference enters the dot product (``weight``) and how the
aggregates of a pair give its similarity (``similarity``). Both return Columns, so a
user-supplied measure stays inside the generated code like the built-in ones.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Stats = Mapping[str, Column]

# Columns of ``item_stats`` a measure may ask for.
ITEM_STATS = ("n", "total", "norm2", "peak", "low", "mean", "ssd", "spread")


@dataclass(frozen=True)
class Pair:
    """Aggregates of one item pair: shared users, dot product, item statistics, all users."""

    co: Column
    dot: Column
    a: Stats
    b: Stats
    users: Column | None = None


def _raw(pref: Column, stats: Stats) -> Column:
    return pref


@dataclass(frozen=True)
class Measure:
    """A similarity measure.

    ``row_stats`` are the item statistics ``weight`` reads, ``pair_stats`` those
    ``similarity`` reads, ``bound_stats`` those ``upper_bound`` reads. ``upper_bound``,
    if given, is never below the similarity of a pair and lets pairs that cannot reach
    a threshold be skipped before they are aggregated. With ``uses_users`` the statistics it
    gets also hold ``users``, the number of all users.

    ``lower_bound``, if given, is never above the similarity of a pair when the aggregates
    are those of some of its users only, and null where nothing can be said; it reads
    ``lower_stats`` besides ``pair_stats``. Such a measure must not grow when users are left
    out wherever it is not null.

    ``light``, if given, says whether rows of an item cannot reach a threshold with any partner:
    from their number, their summed squared weights, the item's statistics and the threshold.

    ``weigh``, if given, computes ``weight`` from numpy arrays, to the bit, so that preferences can travel as they are.

    ``estimate``, if given, computes ``similarity`` from a ``Pair`` of numpy arrays. It only decides which pairs are
    surely not among the best of an item before ``similarity`` is taken of the others.

    Similarities are rounded half-up to ``digits`` before they are compared: sums of
    doubles depend on the order of their terms, so unrounded values could order near-ties
    differently from run to run. None is for measures that are exact by themselves.
    """

    name: str
    similarity: Callable[[Pair], Column]
    weight: Callable[[Column, Stats], Column] = _raw
    row_stats: tuple[str, ...] = ()
    pair_stats: tuple[str, ...] = ()
    uses_dot: bool = True
    uses_users: bool = False
    upper_bound: Callable[[Stats, Stats], Column] | None = None
    bound_stats: tuple[str, ...] = ()
    lower_bound: Callable[[Pair], Column] | None = None
    lower_stats: tuple[str, ...] = ()
    light: Callable[[Column, Column, Stats, float], Column] | None = None
    light_stats: tuple[str, ...] = ()
    digits: int | None = 9
    estimate: Callable[[Pair], np.ndarray] | None = None
    weigh: Callable[[np.ndarray, Mapping[str, np.ndarray]], np.ndarray] | None = None

    def rounded(self, pair: Pair) -> Column:
        """The similarity at ``digits`` decimals. Written as a floor, which unlike ``round``
        on doubles does not go through decimal text for every pair."""
        return self.at_digits(self.similarity(pair))

    def at_digits(self, value: Column) -> Column:
        if self.digits is None:
            return value
        scale = 10.0**self.digits
        shifted = value * scale + 0.5
        # Not F.floor, whose result is a whole number of 64 bits and saturates.
        return (shifted - F.pmod(shifted, F.lit(1.0))) / scale

    def __post_init__(self) -> None:
        unknown = set(self.row_stats + self.pair_stats + self.bound_stats + self.lower_stats + self.light_stats) - set(ITEM_STATS)
        if unknown:
            raise ValueError(f"unknown item statistics: {sorted(unknown)}")


# Keep an empty cell's logarithm finite.
_TINY, _NEARLY_NONE = 1e-300, -1 + 1e-15


def _log_likelihood(p: Pair) -> Column:
    """Dunning's log-likelihood ratio of the 2x2 table of users, mapped into [0, 1).

    The table counts users of both items, of one only, and of neither. The ratio is twice the sum of
    observed * ln(observed / expected). Every cell is off its expectation by the same d, up to sign, so
    the logarithm is that of 1 + d / expected. Written so, terms of nearly independent items are about as
    large as d, not as all users times their logarithm, and their sum loses nothing to cancellation. An
    empty cell counts 0, also where its expectation is 0. (No branches: the code of a pair stays small.)
    """
    users, with_a, with_b = (c.cast("double") for c in (p.users, p.a["n"], p.b["n"]))
    both = p.co.cast("double")
    off = both - with_a * with_b / users
    cells = [
        (both, off, with_a * with_b),
        (with_a - both, -off, with_a * (users - with_b)),
        (with_b - both, -off, (users - with_a) * with_b),
        (users - with_a - with_b + both, off, (users - with_a) * (users - with_b)),
    ]
    terms = [n * F.log1p(F.greatest(d * users / (product + _TINY), F.lit(_NEARLY_NONE))) for n, d, product in cells]
    ratio = F.greatest(F.lit(0.0), 2.0 * sum(terms[1:], terms[0]))
    return 1.0 - 1.0 / (1.0 + ratio)


def _log_likelihood_bound(a: Stats, b: Stats) -> Column:
    """The ratio is convex in the shared users: it is largest where they are as many or as few as they can be."""
    most = F.least(a["n"], b["n"])
    least = F.greatest(F.lit(1), a["n"] + b["n"] - a["users"])
    none = F.lit(0.0)
    ends = (_log_likelihood(Pair(co, none, a, b, a["users"])) for co in (most, least))
    return F.greatest(*ends)


def _log_likelihood_estimate(p: Pair) -> np.ndarray:
    users, with_a, with_b, both = float(p.users), p.a["n"], p.b["n"], p.co
    off = both - with_a * with_b / users
    cells = [
        (both, off, with_a * with_b),
        (with_a - both, -off, with_a * (users - with_b)),
        (with_b - both, -off, (users - with_a) * with_b),
        (users - with_a - with_b + both, off, (users - with_a) * (users - with_b)),
    ]
    terms = [n * np.log1p(np.maximum(d * users / (product + _TINY), _NEARLY_NONE)) for n, d, product in cells]
    return 1.0 - 1.0 / (1.0 + np.maximum(0.0, 2.0 * sum(terms[1:], terms[0])))


def _at_most_one(value: Column) -> Column:
    return F.least(F.lit(1.0), value)


def _without_negatives(similarity: Callable[[Pair], Column]) -> Callable[[Pair], Column]:
    """A bound that grows with the dot product; users left out can only add to it if no preference is negative."""
    return lambda p: F.when((p.a["low"] >= 0) & (p.b["low"] >= 0), similarity(p))


def _largest_dot(a: Stats, b: Stats) -> Column:
    by_peaks = F.least(a["n"], b["n"]) * a["peak"] * b["peak"]
    return F.least(by_peaks, F.sqrt(a["norm2"]) * F.sqrt(b["norm2"]))


def _euclidean(p: Pair) -> Column:
    return 1.0 / (1.0 + F.sqrt(F.greatest(F.lit(0.0), p.a["norm2"] - 2 * p.dot + p.b["norm2"])))


# Sums of doubles are compared with a margin.
_MARGIN = 1e-9


def _shared(p: Pair) -> Column:
    return p.co.cast("double")


def _tanimoto(p: Pair) -> Column:
    return p.co / (p.a["n"] + p.b["n"] - p.co)


def _city_block(p: Pair) -> Column:
    return 1.0 / (1.0 + p.a["n"] + p.b["n"] - 2 * p.co)


def _cosine(p: Pair) -> Column:
    return F.try_divide(p.dot, F.sqrt(p.a["norm2"]) * F.sqrt(p.b["norm2"]))


COOCCURRENCE = Measure(
    "cooccurrence",
    _shared,
    uses_dot=False,
    digits=None,
    upper_bound=lambda a, b: F.least(a["n"], b["n"]).cast("double"),
    bound_stats=("n",),
    lower_bound=_shared,
    light=lambda count, square, stats, threshold: count < threshold,
    estimate=lambda p: p.co,
)
TANIMOTO = Measure(
    "tanimoto",
    _tanimoto,
    pair_stats=("n",),
    uses_dot=False,
    upper_bound=lambda a, b: F.least(a["n"], b["n"]) / F.greatest(a["n"], b["n"]),
    bound_stats=("n",),
    lower_bound=_tanimoto,
    # Shared users are at least threshold times those of the larger item.
    light=lambda count, square, stats, threshold: count < (threshold - _MARGIN) * stats["n"],
    light_stats=("n",),
    estimate=_tanimoto,
)
LOGLIKELIHOOD = Measure(
    "loglikelihood",
    _log_likelihood,
    pair_stats=("n",),
    uses_dot=False,
    uses_users=True,
    upper_bound=_log_likelihood_bound,
    bound_stats=("n",),
    estimate=_log_likelihood_estimate,
)
CITY_BLOCK = Measure(
    "city_block",
    _city_block,
    pair_stats=("n",),
    uses_dot=False,
    upper_bound=lambda a, b: 1.0 / (1.0 + F.abs(a["n"] - b["n"])),
    bound_stats=("n",),
    lower_bound=_city_block,
    # Users of this item only are at most 1 / threshold - 1.
    light=lambda count, square, stats, threshold: count < stats["n"] + 1 - 1 / (threshold - _MARGIN),
    light_stats=("n",),
    estimate=_city_block,
)
COSINE = Measure(
    "cosine",
    _cosine,
    pair_stats=("norm2",),
    upper_bound=lambda a, b: F.try_divide(_largest_dot(a, b), F.sqrt(a["norm2"]) * F.sqrt(b["norm2"])),
    bound_stats=("n", "peak", "norm2"),
    lower_bound=_without_negatives(_cosine),
    lower_stats=("low",),
    # What rows add to the dot product is at most their norm times that of the partner.
    light=lambda count, square, stats, threshold: square < (threshold - _MARGIN) ** 2 * stats["norm2"],
    light_stats=("norm2",),
    estimate=lambda p: p.dot / (np.sqrt(p.a["norm2"]) * np.sqrt(p.b["norm2"])),
)
PEARSON = Measure(
    "pearson",
    lambda p: F.try_divide(p.dot, F.sqrt(p.a["ssd"]) * F.sqrt(p.b["ssd"])),
    weight=lambda pref, stats: pref - stats["mean"],
    weigh=lambda pref, stats: pref - stats["mean"],
    row_stats=("mean",),
    pair_stats=("ssd",),
    upper_bound=lambda a, b: _at_most_one(
        F.try_divide(
            F.least(a["n"], b["n"]) * a["spread"] * b["spread"], F.sqrt(a["ssd"]) * F.sqrt(b["ssd"])
        )
    ),
    bound_stats=("n", "spread", "ssd"),
    light=lambda count, square, stats, threshold: square < (threshold - _MARGIN) ** 2 * stats["ssd"],
    light_stats=("ssd",),
    estimate=lambda p: p.dot / (np.sqrt(p.a["ssd"]) * np.sqrt(p.b["ssd"])),
)
EUCLIDEAN = Measure(
    "euclidean",
    _euclidean,
    pair_stats=("norm2",),
    upper_bound=lambda a, b: 1.0
    / (1.0 + F.sqrt(F.greatest(F.lit(0.0), a["norm2"] - 2 * _largest_dot(a, b) + b["norm2"]))),
    bound_stats=("n", "peak", "norm2"),
    lower_bound=_without_negatives(_euclidean),
    lower_stats=("low",),
    # For any partner, the squared distance is at least the squared norm of the other rows.
    light=lambda count, square, stats, threshold: square
    < (1 - _MARGIN) * stats["norm2"] - (1 / (threshold - _MARGIN) - 1) ** 2,
    light_stats=("norm2",),
    estimate=lambda p: 1.0 / (1.0 + np.sqrt(np.maximum(0.0, p.a["norm2"] - 2 * p.dot + p.b["norm2"]))),
)

MEASURES = {
    m.name: m for m in (COOCCURRENCE, TANIMOTO, LOGLIKELIHOOD, CITY_BLOCK, COSINE, PEARSON, EUCLIDEAN)
}


def measure_named(measure: str | Measure) -> Measure:
    """A built-in measure by name, or a user-supplied one as it is."""
    if isinstance(measure, Measure):
        return measure
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}; known: {sorted(MEASURES)}")
    return MEASURES[measure]
