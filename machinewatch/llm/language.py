"""Language of a text by rank-order n-gram profiles.

A language's profile is its most frequent character n-grams in order of
frequency. A document's own most frequent n-grams are compared with each
profile: an n-gram costs the distance of its two ranks, one that the profile
lacks costs the profile's size, and the language of the least sum is
predicted.

Profiles are fitted on a bounded sample of labelled rows (``SAMPLE`` per
language, by a hash of id and text); whole texts are used both here and in
predictions. Sample counts are summed per task before they are shuffled; the
driver gets at most ``PROFILE`` n-grams per language.

Defined results: null text, or one without a letter: ``und`` with score 0;
equal sums: the first language in alphabetical order; equal frequencies: the
first n-gram in code point order; no labelled rows at all: ``und``.

Whether a text is in a learned language at all is told by the mean cost of its
n-grams under the best profile. It has a bound for each size of ranking (powers
of two), learned from windows of 1 to 64 words of the labelled sample: the
median plus ``SPREAD`` times the way to the 95th percentile, the largest over
the languages, so mislabelled rows do not move it. Rankings of few n-grams vary
much and get loose bounds: a word or two are refused only without any known
n-gram. A size without enough windows has the next smaller one's bound.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from machinewatch.llm.common import map_rows, per_text

#: N-grams (of one to three code points) of a profile, and labelled rows per language used to fit (bound of the sample).
PROFILE, SAMPLE = 300, 2000
UNKNOWN = "und"
#: Words of the windows that bounds are learned from, windows of a size and language needed, and steps from
#: the median to the 95th percentile of their mean costs up to the bound.
WINDOWS, ENOUGH, SPREAD = (1, 2, 4, 8, 16, 32, 64), 20, 4.0
#: Words whose n-grams are counted at once, and bits of a code point in an n-gram's number.
BLOCK, _BITS = 50_000, 21
_MARK = ord("_")

_LETTERS = re.compile(r"[^\W\d_]+")


def _grams(words: list[str]) -> np.ndarray:
    """N-grams of words marked at both ends, repeats included, as 64-bit numbers that sort as the n-grams do.

    Code points stand from the top, 0 where an n-gram is shorter. A mark
    between two words ends one and begins the other: it is no n-gram of its
    own, and three code points around it are none either.
    """
    points = np.frombuffer(f"_{'_'.join(words)}_".encode("utf-32-le"), "<u4").astype(np.int64)
    first, letters = points << (2 * _BITS), points != _MARK
    pairs = first[:-1] | points[1:] << _BITS
    return np.concatenate([first[letters], pairs, (pairs[:-1] | points[2:])[letters[1:-1]]])


def gram_number(gram: str) -> int:
    return sum(ord(c) << (_BITS * (2 - i)) for i, c in enumerate(gram))


def gram_text(number: int) -> str:
    points = (number >> (_BITS * i) & ((1 << _BITS) - 1) for i in (2, 1, 0))
    return "".join(chr(p) for p in points if p)


def count_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a whole text's words, in lower case: their numbers (ascending) and counts."""
    words = _LETTERS.findall(text.lower())
    numbers, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(words), BLOCK):
        found, times = np.unique(_grams(words[at:at + BLOCK]), return_counts=True)
        if at:
            numbers, where = np.unique(np.concatenate([numbers, found]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, times]), len(numbers)).astype(np.int64)
        else:
            numbers, counts = found, times
    return numbers, counts


def ranked(numbers: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, equal ones in code point order."""
    if len(counts) > size:
        frequent = counts >= np.partition(counts, -size)[-size]
        numbers, counts = numbers[frequent], counts[frequent]
    # The numbers ascend, so a stable sort keeps equal counts in their order.
    return numbers[np.argsort(-counts, kind="stable")[:size]]


class RankOrder:
    """Out-of-place distance to each language's profile."""

    def __init__(self, profiles: dict[str, list[str]], size: int = PROFILE):
        self.languages, self.size = sorted(profiles), size
        known = sorted({gram_number(g) for grams in profiles.values() for g in grams})
        # One row of places for each known n-gram, and a last one for all others.
        self.known = np.array(known, dtype=np.int64)
        self.places = np.full((len(known) + 1, len(self.languages)), size, dtype=np.int64)
        for column, language in enumerate(self.languages):
            rows = np.searchsorted(self.known, [gram_number(g) for g in profiles[language]])
            self.places[rows, column] = np.arange(len(rows))

    def ranking(self, text: str) -> np.ndarray:
        return ranked(*count_grams(text), self.size)

    def distances(self, ranking: np.ndarray) -> list[int]:
        if not len(ranking) or not len(self.known):
            return [self.size * len(ranking)] * len(self.languages)
        rows = np.searchsorted(self.known, ranking)
        rows[rows == len(self.known)] = 0
        rows = np.where(self.known[rows] == ranking, rows, len(self.known))
        places = self.places[rows]
        costs = np.where(places == self.size, self.size, np.abs(places - np.arange(len(ranking))[:, None]))
        return costs.sum(axis=0).tolist()

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Predicted language, and how far it is ahead: 1 - best / (best + second), or the share of known places."""
        if text is None or not self.languages or not _LETTERS.search(text):
            return UNKNOWN, 0.0
        return self.best(self.distances(self.ranking(text)))

    def best(self, total: list[int]) -> tuple[str, float]:
        order = sorted(range(len(total)), key=lambda c: (total[c], c))
        best = total[order[0]]
        if len(order) == 1:
            return self.languages[0], 1.0
        second = total[order[1]]
        return self.languages[order[0]], 0.5 if best + second == 0 else 1.0 - best / (best + second)


def size_class(n_grams: int) -> int:
    return n_grams.bit_length()


class KnownLanguage:
    """Whether a text is near enough to a profile, and that language is one of ``languages`` (any by default)."""

    def __init__(self, profiles: dict[str, list[str]], bounds: dict[int, float], languages: list[str] | None = None,
                 size: int = PROFILE):
        self.rank_order, self.bounds = RankOrder(profiles, size), bounds
        self.languages = set(profiles if languages is None else languages)

    def __call__(self, text: str | None) -> tuple[bool]:
        own = self.rank_order
        if text is None or not own.languages or not _LETTERS.search(text):
            return (False,)
        ranking = own.ranking(text)
        total = own.distances(ranking)
        mean = min(total) / len(ranking)
        near = mean < own.size and mean <= self.bounds.get(size_class(len(ranking)), own.size)
        return (near and own.best(total)[0] in self.languages,)


def _sampled(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int) -> DataFrame:
    """Rows with language and text whose hash of id and text is below the share of ``sample`` in the language's rows."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("t"), F.col(id_col).alias("d"))
    share = rows.groupBy("lang").count().select(
        "lang", F.least(F.lit(1.0), F.lit(float(sample)) / F.col("count")).alias("share"))
    return rows.join(F.broadcast(share), "lang").where(  # one row per language
        F.pmod(F.xxhash64("d", "t"), F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("lang", "t")


def fit_profiles(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 sample: int = SAMPLE, size: int = PROFILE) -> dict[str, list[str]]:
    """Profiles from rows with a language; rows without text or language are left out.

    The expected number of sampled rows of a language is ``sample`` (all, if
    it has fewer); they are those whose hash of id and text is below its share.
    """
    picked = _sampled(labelled, id_col, text_col, lang_col, sample)

    def start():
        def run(batch: Iterator[tuple]) -> Iterator[tuple]:
            counts: dict[str, Counter] = {}
            for lang, text in batch:
                own = counts.setdefault(lang, Counter())
                for number, n in zip(*(values.tolist() for values in count_grams(text)), strict=True):
                    own[number] += n
                if len(own) > 200_000:  # hand over what there is; sums are taken later
                    yield from ((lang, gram_text(g), n) for g, n in counts.pop(lang).items())
            for lang, own in counts.items():
                yield from ((lang, gram_text(g), n) for g, n in own.items())

        return run

    counts = map_rows(picked, "lang string, gram string, n long", start, batch_rows=20_000)
    sums = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    profiles: dict[str, list[str]] = {}
    for row in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):  # size * languages rows
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def windows(text: str) -> Iterator[str]:
    """The words in the text's middle, as many as ``WINDOWS`` say; the whole text where it has fewer."""
    words = text.split()
    for n in WINDOWS:
        start = max(0, (len(words) - n) // 2)
        yield " ".join(words[start:start + n])
        if n >= len(words):
            return


def fit_bounds(labelled: DataFrame, profiles: dict[str, list[str]], id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", sample: int = SAMPLE, size: int = PROFILE) -> dict[int, float]:
    """Bound of the mean cost by size class of the ranking, from the rows that ``fit_profiles`` samples."""

    def start():
        rank_order = RankOrder(profiles, size)

        def run(batch: Iterator[tuple]) -> Iterator[tuple]:
            counts: Counter = Counter()
            for lang, text in batch if profiles else ():
                for window in windows(text):
                    ranking = rank_order.ranking(window)
                    if len(ranking):
                        mean = min(rank_order.distances(ranking)) / len(ranking)
                        counts[lang, size_class(len(ranking)), math.ceil(mean)] += 1
            yield from ((*key, n) for key, n in counts.items())

        return run

    picked = _sampled(labelled, id_col, text_col, lang_col, sample)
    counts = map_rows(picked, "lang string, class long, cost long, n long", start).groupBy("lang", "class", "cost").agg(
        F.sum("n").alias("n")).collect()  # at most languages * classes * size rows
    costs: dict[tuple[int, str], Counter] = {}
    for r in counts:
        costs.setdefault((r["class"], r["lang"]), Counter())[r["cost"]] += r["n"]
    learned: dict[int, float] = {}
    for (of, _), own in costs.items():
        if own.total() >= ENOUGH:
            middle, high = (_quantile(own, q) for q in (0.5, 0.95))
            learned[of] = max(learned.get(of, 0.0), middle + SPREAD * (high - middle))
    bounds: dict[int, float] = {}
    for of in range(1, size_class(size) + 1):
        # No bound is below half of the size, where a sample of few, equal texts would put it.
        bounds[of] = max(size / 2, learned[of]) if of in learned else bounds.get(of - 1, float(size))
    return bounds


def _quantile(counts: Counter, q: float) -> int:
    below = 0
    for value in sorted(counts):
        below += counts[value]
        if below >= q * counts.total():
            break
    return value


def language_udf(profiles: dict[str, list[str]], size: int = PROFILE):
    """A column function from text to ``struct<lang_pred, score>``."""
    return per_text("lang_pred string, score double", lambda: RankOrder(profiles, size))


def identified(text: Column, profiles: dict[str, list[str]], bounds: dict[int, float],
               languages: list[str] | None = None) -> Column:
    """Whether a text is near a profile and predicted as one of ``languages`` (all learned ones by default)."""
    return per_text("known boolean", lambda: KnownLanguage(profiles, bounds, languages))(text)["known"]
