"""Secret scan: fixed patterns, and random-looking strings by character Markov models.

Trigram models of random strings are compared with one of ordinary identifiers by the log-likelihood
ratio. The labelled samples of random strings are the values that the patterns find in the texts, and strings drawn from each of
``ALPHABETS``; those of ordinary ones are all other words of the texts, and identifiers, paths, dates and numbers
made by rule (``ordinary_samples``). A long token is judged by its best stretch between separators, so a key
in a path or behind a name is found and a name behind it does not hide it. UUIDs count as random.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import map_batches, values

# The patterns of the base scan.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # the same spans as AKIA[A-Z0-9]+ of 20 and more
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_EDGE = len(ALPHABET)
_SIZE = len(ALPHABET) + 1
_CODE = np.full(256, _EDGE, np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i

#: Alphabets of random strings, each with a model of its own.
ALPHABETS = {
    "letters and digits": ALPHABET[:62],
    "lower case and digits": ALPHABET[26:62],
    "upper case and digits": ALPHABET[:26] + ALPHABET[52:62],
    "base 32": ALPHABET[:26] + "234567",
    "base 64": ALPHABET[:64],
}
#: Labelled samples drawn for each alphabet, and in all for ordinary strings.
RANDOM_SAMPLES, ORDINARY_SAMPLES = 4_000, 12_000
# Words of which sample identifiers are made.
NAMES = (
    "access account action address archive article balance batch binary block bridge buffer build bundle button cache calendar "
    "catalog category channel class client cluster collection column command comment common component config connection "
    "container content context control counter country create current customer daily data default delete detail device "
    "directory document domain download editor element engine entry error event example export factory feature field file "
    "filter folder format function gateway global group handler header history home host image import index input instance "
    "internal invoice item journal language layout library license linux listener local manager mapping master member "
    "message method metric model module monitor network number object option order output package page parser partner "
    "password payment platform plugin point policy process product profile project property provider public query queue "
    "record region register release remote report request resource response result root route schedule schema script search "
    "server service session setting shared source state static status storage stream string subject support system table target "
    "template thread token train transfer update upload user util value version view warehouse window worker write"
).split()

#: Words that train the ordinary model, and tokens that are judged.
WORD, TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}"), re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: Where a stretch may begin or end inside a token.
PART = re.compile(r"[+/_.=-]*([A-Za-z0-9]*)")
#: A stretch is this long at least, and its ratio this many nats, in all and for each character.
LENGTH, LEAST, LEAST_EACH = 16, 20.0, 0.8


def random_samples(alphabet: str, n: int = RANDOM_SAMPLES, seed: int = 1) -> list[str]:
    """Strings of 16 to 64 characters, each drawn evenly from ``alphabet``."""
    draw = np.random.default_rng(seed)
    letters = np.array(list(alphabet))
    return ["".join(letters[draw.integers(0, len(letters), k)]) for k in draw.integers(16, 65, n)]


def ordinary_samples(n: int = ORDINARY_SAMPLES, seed: int = 2) -> list[str]:
    """Identifiers in the usual spellings, paths, host names, dates, times, versions, addresses, numbers and filling."""
    draw = random.Random(seed)

    def made(k: int) -> str:
        words = draw.choices(NAMES, k=draw.randint(2, 4))
        year, month, day, hour, minute, second = (draw.randint(*x) for x in ((1970, 2099), (1, 12), (1, 28), (0, 23), (0, 59), (0, 59)))
        date = draw.choice("-/._").join((f"{year}", f"{month:02}", f"{day:02}"))
        time = draw.choice("-/._").join((f"{hour:02}", f"{minute:02}", f"{second:02}"))
        return (
            words[0] + "".join(w.title() for w in words[1:]),
            "".join(w.title() for w in words),
            "_".join(words),
            "_".join(words).upper(),
            "-".join(words),
            "/" + "/".join(words) + draw.choice(("", ".txt", ".json", ".html", ".py", "/index.php", f"/{draw.randint(0, 9999)}")),
            ".".join(words) + draw.choice((".com", ".org", ".net", "", f".{draw.randint(0, 99)}")),
            f"{words[0]}={words[1]}{draw.randint(0, 999)}",
            date + draw.choice("T_-/") + time,
            f"{year}{month:02}{day:02}{draw.choice('T_-')}{hour:02}{minute:02}{second:02}Z",
            f"{words[0]}-{draw.randint(0, 20)}.{draw.randint(0, 99)}.{draw.randint(0, 999)}{draw.choice(('', '-beta', '.jar', '-SNAPSHOT'))}",
            ".".join(str(draw.randint(0, 255)) for _ in range(4)),
            str(draw.randrange(10 ** draw.randint(8, 24))),
            draw.choice(ALPHABET) * draw.randint(8, 40),
            ALPHABET[draw.randint(0, 40) :][: draw.randint(8, 26)],
        )[k % 15]

    return [made(k) for k in range(n)]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind as listed."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _codes(tokens: list[str]) -> np.ndarray:
    """Two edges, then each token followed by two edges."""
    joined = "\0\0" + "".join(f"{t}\0\0" for t in tokens)
    return _CODE[np.frombuffer(joined.encode("ascii"), np.uint8)]


def _trigrams(tokens: list[str]) -> np.ndarray:
    c = _codes(tokens)
    at = (c[:-2] * _SIZE + c[1:-1]) * _SIZE + c[2:]
    return at[c[1:-1] + c[2:] < 2 * _EDGE]  # without the step from one edge to the next


def _labelled(text: str, prior: np.ndarray) -> tuple[list[str], list[str]]:
    """The values of the secrets that the patterns find in a text, and the words outside their spans.

    Words that ``prior``, the table of the samples alone, finds random are in neither: a key that stands
    in many texts must not become ordinary by that.
    """
    spans = base_spans(text)
    secret = [m.group(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    secret += ACCESS.findall(text) + HEX.findall(text)
    pieces, at = [], 0
    for _, start, end in spans:
        if start > at:
            pieces.append(text[at:start])
        at = max(at, end)
    words = WORD.findall(" ".join([*pieces, text[at:]]) if spans else text)
    return secret, [w for w in words if len(w) < LENGTH or not best_stretches(w, prior)]


def _count(batches, prior: np.ndarray) -> Iterator[dict]:
    counts = np.zeros((2, _SIZE**3), np.int64)
    for batch in batches:
        both: tuple[list, list] = ([], [])
        for (text,) in values(batch, "text"):
            for row, mine, found in zip(counts, both, _labelled(text, prior), strict=True):
                mine += found
                if len(mine) > 100_000:
                    row += np.bincount(_trigrams(mine), minlength=_SIZE**3)
                    mine.clear()
        for row, mine in zip(counts, both, strict=True):
            if mine:
                row += np.bincount(_trigrams(mine), minlength=_SIZE**3)
    for label in (0, 1):
        at = np.flatnonzero(counts[label])
        yield {"label": np.full(len(at), label, np.int32), "gram": at, "n": counts[label][at]}


def _model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a character after two others, each order smoothed by the one below."""
    c = counts.reshape(_SIZE, _SIZE, _SIZE).astype(float)
    below = np.full(_SIZE, 1.0 / _SIZE)
    one = c.sum((0, 1))
    p1 = (one + _SIZE * below) / (one.sum() + _SIZE)
    two = c.sum(0)
    p2 = (two + _SIZE * p1) / (two.sum(1, keepdims=True) + _SIZE)
    p3 = (c + _SIZE * p2[None]) / (c.sum(2, keepdims=True) + _SIZE)
    return np.log(p3)


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratios of trigrams against the ordinary model: a row for each model of random strings.

    All texts are counted. The counts that reach the driver are bounded by the alphabet (two tables of
    69^3). The first row is the model of the texts' own secrets; it is left out where they hold none.
    """
    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    counts = np.zeros((2, _SIZE**3))
    prior = ratios(*counts)
    counted = map_batches(rows, lambda batches: _count(batches, prior), "label int, gram bigint, n bigint")
    counted = counted.groupBy("label", "gram").agg(F.sum("n"))
    for label, gram, n in counted.collect():
        counts[label, gram] = n
    return ratios(*counts)


def ratios(secret: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The table of ``train`` from trigram counts of secrets and of ordinary words."""

    def counted(tokens: list[str]) -> np.ndarray:
        return np.bincount(_trigrams(tokens), minlength=_SIZE**3).astype(float)

    made = counted(ordinary_samples())
    # Many words must not outvote the samples: both kinds weigh alike.
    ordinary = _model(made + words * min(1.0, made.sum() / max(words.sum(), 1.0)))
    models = [_model(secret)] if secret.any() else []
    models += [_model(counted(random_samples(a, seed=k))) for k, a in enumerate(ALPHABETS.values())]
    return np.stack([(m - ordinary).reshape(-1) for m in models]).astype(np.float32)


def best_stretches(token: str, ratio: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches of a token that one model of random strings explains far better.

    The model with the highest-scoring stretch is taken. A stretch is made of whole parts between separators
    and begins with no separator; it ends where its sum is highest before falling below 0, in one pass.
    """
    c = _codes([token])[: len(token) + 2]
    grams = (c[:-2] * _SIZE + c[1:-1]) * _SIZE + c[2:]
    parts = [(m.start(1), m.end()) for m in PART.finditer(token) if m.end() > m.start()]
    best: tuple[float, list[tuple[int, int]]] = (0.0, [])
    for row in ratio:
        upto = np.concatenate([[0.0], row[grams].cumsum(dtype=float)])
        found: list[tuple[float, int, int]] = []
        start = end = -1
        peak = 0.0
        for inner, cut in parts:
            if start < 0:
                start = end = inner
            total = upto[cut] - upto[start]
            if total > peak:
                peak, end = total, cut
            if total <= 0:
                found.append((peak, start, end))
                start, peak = -1, 0.0
        if start >= 0:
            found.append((peak, start, end))
        kept = [x for x in found if x[2] - x[1] >= LENGTH and x[0] >= LEAST and x[0] >= LEAST_EACH * (x[2] - x[1])]
        top = max((x[0] for x in kept), default=0.0)
        if top > best[0]:
            best = (top, [x[1:] for x in kept])
    return best[1]


def spans_of(text: str, ratio: np.ndarray | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans of a text, and those with the Markov spans that overlap none of them."""
    base = base_spans(text)
    if ratio is None:
        return base, base
    more, k, covered = [], 0, 0
    for m in TOKEN.finditer(text):
        for start, end in best_stretches(m.group(), ratio):
            a, b = m.start() + start, m.start() + end
            while k < len(base) and base[k][1] < b:
                covered = max(covered, base[k][2])  # the furthest end of base spans that start before b
                k += 1
            if covered <= a:
                more.append(("markov", a, b))
    both = sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))
    return base, both


def scan(docs: DataFrame, ratio: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, n_markov, base_spans and spans (arrays of kind, start, end).

    Positions are code points, ends exclusive. Null and empty texts have no spans. Columns of
    ``docs`` with these names are replaced; repeated rows get equal results.
    """
    held = ratio if ratio.any() else None
    kind = "array<struct<kind: string, start: bigint, end: bigint>>"

    @F.pandas_udf(f"struct<base: {kind}, spans: {kind}>")
    def found(texts):
        import pandas as pd

        both = [spans_of(t or "", held) for t in texts]
        row = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        return pd.DataFrame({"base": [row(b) for b, _ in both], "spans": [row(s) for _, s in both]})

    made = docs.withColumn("_found", found(F.col(text)))
    counts = {f"n_{k}": _count_of("_found.spans", k) for k in KINDS}
    made = made.withColumns(counts).withColumn("base_spans", F.col("_found.base")).withColumn("spans", F.col("_found.spans"))
    return made.drop("_found")


def _count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spans_text(spans: Column) -> Column:
    """Column of spans as kind:start:end, comma-joined; empty text without spans."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def spans_sha256(spans: Column) -> Column:
    return F.sha2(spans_text(spans), 256)


def digest_sha256(text: str) -> str:
    """The same for one text, used by tests."""
    return hashlib.sha256(digest(base_spans(text)).encode()).hexdigest()
