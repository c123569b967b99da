"""Toxicity by a lexicon that also catches misspelled terms.

The lexicon is learned: words, and stems that start many words, which mark
labelled toxic texts beyond chance; of near copies within a class one text
teaches, before any term is counted. Its trie is intersected with Levenshtein automata (one
edit for terms of 5 to 8 letters, two beyond; stems only if long): a state is
the set of trie nodes that a word's letters may have reached with their edits,
and is determinized as words ask for it. Hits weigh by log-odds learned for
the term and the number of edits; a window of words around a hit tells a
quotation (in quotation marks, more so beside a word of reporting) from abuse.
A hit's probability is the share of toxic texts among the labelled ones with
it. Distinct unquoted hits of one half or more add up (1 minus the product of
their complements); weaker and quoted ones do not.

Fitting uses a bounded sample of labelled rows (``SAMPLE`` per class); texts
are whole. Only ids of that bounded sample are broadcast.

Defined results: null, empty and hit-free texts get ``BASE``; rows with a null
label or id teach nothing; an id with both labels counts as toxic; of an id's
texts the one with the least hash teaches; without toxic rows the lexicon is empty.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machinewatch.llm.common import map_rows, per_text, written
from machinewatch.llm.tokenizers import Memo

#: Labelled rows per class used to fit (bound of the sample), terms of the lexicon at most.
SAMPLE, TERMS = 5000, 2000
#: Toxic texts that a term must mark, its least precision, and its least log-likelihood ratio
#: against chance (over a million terms are tried, so chance alone reaches about 28).
SUPPORT, PRECISION, EVIDENCE = 4, 0.9, 36.0
#: Stem lengths.
STEM = (4, 10)
#: Values of a MinHash, and the share of equal ones from which a text is a near copy.
SIGNATURE, COPY = 32, 0.6
BASE = 0.02
#: Words on each side of a hit.
WINDOW = 8
#: What is left of a hit's probability in quotation marks, and beside a word of reporting too.
QUOTED, REPORTED = 0.5, 0.25
#: Words of reporting (fixed values).
REPORTING = frozenset(
    "said says wrote writes quote quoted called term word phrase insult slur "
    "sagte schrieb zitat wort begriff dit écrit mot terme dijo escribió palabra término".split())

_WORD = re.compile(r"\w+")
_OPEN, _CLOSE = "\"'“‘«„", "\"'”’»“"
#: States and transitions kept per worker.
_STATES = 100_000


def edits(term: str, stem: bool) -> int:
    if stem:
        return 0 if len(term) < 7 else 1
    return 0 if len(term) < 5 else 1 if len(term) <= 8 else 2


class LexiconAutomaton:
    """The trie of a lexicon intersected with each term's Levenshtein automaton."""

    def __init__(self, words: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.limit = [0]  # most edits of any term below
        self.ends: list[list[tuple[str, int, bool]]] = [[]]
        for term, stem in [*((w, False) for w in words), *((s, True) for s in stems)]:
            k, node = edits(term, stem), 0
            self.limit[0] = max(self.limit[0], k)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.limit.append(0)
                    self.ends.append([])
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], k)
            self.ends[node].append((term, k, stem))
        self._reset()

    def _reset(self) -> None:
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.step: list[dict[str, int]] = []
        self.final: list[tuple[str, int] | None] = []
        self.stem: list[tuple[str, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """Number of the state with these nodes and edits, closed under skipped term letters."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            e = reached[node] + 1
            for child in self.children[node].values():
                if e <= self.limit[child] and e < reached.get(child, 99):
                    reached[child] = e
                    todo.append(child)
        key = tuple(sorted(reached.items()))
        if key not in self.known:
            self.known[key] = len(self.states)
            self.states.append(key)
            self.step.append({})
            whole = [(e, t) for n, e in key for t, k, stem in self.ends[n] if e <= k and not stem]
            stems = [(e, t) for n, e in key for t, k, stem in self.ends[n] if e <= k and stem]
            self.final.append(min(whole)[::-1] if whole else None)
            self.stem.append(min(stems)[::-1] if stems else None)
        return self.known[key]

    def _next(self, state: int, c: str) -> int:
        reached: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.limit[node] and e < reached.get(node, 99):
                reached[node] = e

        for node, e in self.states[state]:
            for letter, child in self.children[node].items():
                put(child, e if letter == c else e + 1)
            put(node, e + 1)
        return self._state(reached) if reached else -1

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term of the word (or of a start of it, for a stem) and its edits."""
        if len(self.states) > _STATES:
            self._reset()
        state, found = self.start, None
        for c in word:
            to = self.step[state].get(c)
            if to is None:
                to = self.step[state][c] = self._next(state, c)
            if to < 0:
                return found
            state = to
            stem = self.stem[state]
            if stem and (found is None or stem[1] < found[1]):
                found = stem
        whole = self.final[state]
        return whole if whole and (found is None or whole[1] <= found[1]) else found


@dataclass
class ToxicLexicon:
    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    #: Log-odds of a toxic text by term and edits, the labelled rows' share of toxic ones included.
    weights: dict[tuple[str, int], float] = field(default_factory=dict)


class ToxicScorer:
    """Score of a text under a lexicon."""

    def __init__(self, lexicon: ToxicLexicon):
        self.lexicon = lexicon
        automaton = LexiconAutomaton(lexicon.words, lexicon.stems)
        # 0 stands for no hit, as a memo remembers any value but None.
        self.of = Memo(lambda w: automaton.match(w) or 0)

    def hits(self, text: str) -> list[tuple[str, int, float]]:
        """Term, edits and context factor of every hit."""
        found = [(m, hit) for m in _WORD.finditer(text) if (hit := self.of[m.group().lower()])]
        return [(*hit, self._context(text, m.start(), m.end())) for m, hit in found]

    @staticmethod
    def _context(text: str, start: int, end: int) -> float:
        """1 for abuse; less if the window shows a quotation.

        Windows are cut from 24 characters per word on each side, so a hit
        costs the same in a text of any length.
        """
        left, right = text[max(0, start - 24 * WINDOW):start], text[end:end + 24 * WINDOW]
        left, right = left.rpartition("\n")[2], right.partition("\n")[0]
        before = [m for m in re.finditer(r"\S+", left)][-WINDOW:]
        after = [m for m in re.finditer(r"\S+", right)][:WINDOW]
        opened = left.endswith(tuple(_OPEN)) or any(m.group()[0] in _OPEN and m.group()[-1] not in _CLOSE for m in before)
        closed = bool(right) and right[0] in _CLOSE or any(
            m.group().rstrip(".,;:!?")[-1:] in tuple(_CLOSE) and m.group()[0] not in _OPEN for m in after)
        if not (opened and closed):
            return 1.0
        cues = {m.group().strip(".,;:!?\"'“”«»„").lower() for m in [*before, *after]}
        return REPORTED if cues & REPORTING else QUOTED

    def weight(self, term: str, e: int) -> float:
        known = self.lexicon.weights.get((term, e))
        return known if known is not None else self.lexicon.weights.get((term, 0), 0.0) - 0.5 * e

    def __call__(self, text: str | None) -> tuple[float, int]:
        clean, most = 1.0, BASE
        for term, e, context in sorted(set(self.hits(text))) if text else ():
            p = 1.0 / (1.0 + math.exp(-self.weight(term, e)))
            if context == 1.0 and p >= 0.5:
                clean *= 1.0 - p
            else:
                most = max(most, p * context)
        score = max(1.0 - clean, most)
        return score, int(score >= 0.5)


def _log_odds(toxic: float, clean: float) -> float:
    return math.log((toxic + 0.5) / (clean + 0.5))


def fit_lexicon(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "toxic", sample: int = SAMPLE) -> ToxicLexicon:
    """Learn terms and weights from labelled rows."""
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("d")).agg(F.max(label_col).alias("toxic"))

    rows_of = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}

    def pick(value: int) -> DataFrame:
        return marked.where(F.col("toxic") == value).orderBy(F.xxhash64("d"), "d").limit(sample)

    picked = pick(1).unionByName(pick(0))  # at most 2 * sample ids
    # One text per id, so rows of a repeated id count once; written, as several passes read it.
    texts = written(documents.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("d"), F.col(text_col).alias("t")).join(F.broadcast(picked), "d").groupBy("d", "toxic").agg(
            F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t")), "labelled")

    def signatures():
        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            for number, toxic, text in rows:
                yield number, toxic, _signature(set(_WORD.findall(text.lower())))

        return run

    # Of near copies within a class only the first counts from here on: at most 2 * sample rows.
    signed = map_rows(texts.select(F.xxhash64("d").alias("n"), "toxic", "t"), "n long, toxic int, signature array<long>",
                      signatures).collect()
    sampled = Counter(r["toxic"] for r in signed)
    leaders = []
    for value in sampled:
        own = sorted((r["signature"], r["n"]) for r in signed if r["toxic"] == value)
        leaders += [own[i][1] for i, of in enumerate(_copies([x for x, _ in own])) if i == of]
    lead = documents.sparkSession.createDataFrame([(n,) for n in leaders], "n long")
    texts = texts.join(F.broadcast(lead), F.xxhash64("d") == F.col("n"), "left_semi").select("t", "toxic")

    def terms():
        def run(rows: Iterator[tuple]) -> Iterator[tuple]:
            counts: dict[tuple, list[int]] = {}
            for text, toxic in rows:
                words = {w for w in _WORD.findall(text.lower()) if len(w) >= 3 and not w.isdigit()}
                own = {(w, False) for w in words if len(w) <= 40}
                own |= {(w[:n], True) for w in words for n in range(STEM[0], min(STEM[1], len(w) - 1) + 1)}
                own.add(("", False))
                for term in own:
                    counts.setdefault(term, [0, 0])[toxic] += 1
                if len(counts) > 300_000:
                    yield from ((t, s, *n) for (t, s), n in counts.items())
                    counts = {}
            yield from ((t, s, *n) for (t, s), n in counts.items())

        return run

    counted = map_rows(texts, "term string, stem boolean, clean_docs long, toxic_docs long", terms, batch_rows=20_000)
    sums = counted.groupBy("term", "stem").agg(F.sum("clean_docs").alias("c"), F.sum("toxic_docs").alias("t"))
    total = sums.where((F.col("term") == "") & ~F.col("stem")).collect()
    if not total or not total[0]["t"]:
        return ToxicLexicon()
    n_toxic, n_clean = total[0]["t"], total[0]["c"]
    # A class whose sample is a part of it counts with all its rows.
    up_toxic, up_clean = rows_of[1] / sampled[1], rows_of.get(0, 0) / max(sampled[0], 1)
    share, t, c = n_toxic / (n_toxic + n_clean), F.col("t"), F.col("c")
    evidence = 2 * (t * F.log(t / (t + c) / F.lit(share)) + F.when(c > 0, c * F.log(c / (t + c) / F.lit(1 - share)))
                    .otherwise(0.0)) if n_clean else F.lit(EVIDENCE)
    rows = sums.where((F.col("term") != "") & (t >= SUPPORT) & (evidence >= EVIDENCE) & (
        t * up_toxic >= PRECISION * (t * up_toxic + c * up_clean))).orderBy(
            F.desc("t"), "term", "stem").limit(4 * TERMS).collect()
    found = {(r["term"], r["stem"]): (r["t"], r["c"]) for r in rows}
    words, stems = _choose({term: t for term, (t, _) in found.items()})
    kept = [*((t, False) for t in sorted(words)), *((t, True) for t in sorted(stems))]
    first = {(t, 0): _log_odds(up_toxic * found[t, stem][0], up_clean * found[t, stem][1]) for t, stem in kept}
    lexicon = ToxicLexicon(sorted(words), sorted(stems), first)

    def variants():
        scorer = ToxicScorer(lexicon)

        def run(batch: Iterator[tuple]) -> Iterator[tuple]:
            counts: dict[tuple, list[int]] = {}
            for text, toxic in batch:
                for hit in {h[:2] for h in scorer.hits(text)}:
                    counts.setdefault(hit, [0, 0])[toxic] += 1
            yield from ((*h, *n) for h, n in counts.items())

        return run

    # A misspelling that clean texts hold as well loses its weight.
    seen = map_rows(texts, "term string, e long, clean_docs long, toxic_docs long", variants).groupBy("term", "e").agg(
        F.sum("clean_docs").alias("c"), F.sum("toxic_docs").alias("t")).collect()
    for r in seen:
        lexicon.weights[r["term"], r["e"]] = _log_odds(up_toxic * r["t"], up_clean * r["c"]) if r["c"] or r["t"] >= SUPPORT \
            else lexicon.weights.get((r["term"], 0), 0.0) - 0.5 * r["e"]
    return lexicon


def _signature(words: set[str]) -> list[int]:
    """MinHash of a text's words."""
    hashes = np.fromiter((crc32(w.encode()) for w in words or {""}), dtype=np.uint64, count=max(len(words), 1))
    seeds = np.arange(1, SIGNATURE + 1, dtype=np.uint64)[:, None]
    mixed = (hashes[None, :] + seeds) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(33)).min(axis=1).astype(np.int64).tolist()


def _copies(signatures: list[list[int]]) -> list[int]:
    """For each text, the first text that it is a near copy of (itself, if none)."""
    buckets: dict[tuple, list[int]] = {}
    out = []
    for number, own in enumerate(signatures):
        of = number
        for start in range(0, SIGNATURE, 4):
            leaders = buckets.setdefault((start, *own[start:start + 4]), [])
            near = next((x for x in leaders if sum(map(eq, own, signatures[x])) >= COPY * SIGNATURE), None)
            if near is not None:
                of = near
                break
        if of == number:
            for start in range(0, SIGNATURE, 4):
                buckets.setdefault((start, *own[start:start + 4]), []).append(number)
        out.append(of)
    return out


def _choose(support: dict[tuple[str, bool], int]) -> tuple[set[str], set[str]]:
    """Stems that no longer stem nearly replaces, and words that no chosen stem starts."""
    stems: list[str] = []
    for (term, stem), n in sorted(support.items(), key=lambda x: (len(x[0][0]), x[0][0])):
        if not stem or any(term.startswith(s) for s in stems):
            continue
        longer = [m for (t, _), m in support.items() if len(t) == len(term) + 1 and t.startswith(term)]
        # One continuation only: the longer one says the same.
        if longer and max(longer) >= 0.9 * n:
            continue
        stems.append(term)
    words = {t for (t, stem) in support if not stem and not any(t.startswith(s) for s in stems)}
    return words, set(stems)


def toxicity_udf(lexicon: ToxicLexicon):
    """A column function from text to ``struct<score, predicted>``."""
    return per_text("score double, predicted int", lambda: ToxicScorer(lexicon))
