"""Token counts at every prefix of a text, by prefix dynamic programming.

Within one pre-token, the encoding of a prefix ends in exactly one token
``t`` whose neighbour, the last token of the prefix before it, stays apart
from it under the merge rules; so ``last[i]`` and ``count[i]`` follow from
``count[i - len(t)] + 1``. Text is cut into units (white space and the
characters up to the next white space) that the pre-tokenizer never joins,
and the counts of a distinct unit are computed once per worker.

The store of a text has one signed byte per code point: the change of the
count when the prefix grows by it (a count can fall: "th" + "e" may merge).
``count_at`` and ``longest_within`` answer questions from it without
encoding again.

Defined results: a null text counts as empty (0 tokens, empty store); a
special string of the vocabulary inside a text is one token at its last
character, as the library's default has it; repeated rows are counted each.
"""

from __future__ import annotations

import json
from operator import sub

import numpy as np
import regex
from pyspark.sql import DataFrame

from machinewatch.llm.common import per_text, with_struct
from machinewatch.llm.tokenizers import MEMO, SPACE, Memo, byte_letters, encoder, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
#: Limit of the ``over_limit`` flag.
LIMIT = 1024

_UNITS = regex.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: The byte-level pre-tokenizer's pattern (fixed value); one blank may lead a run.
_SEGMENTS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
)
#: Numbers of first bytes of pre-tokens whose states are remembered.
HEADS = (8, 5)
_CONTRACTIONS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}


class PrefixCounter:
    """Counts of all prefixes under one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = {c: b for b, c in enumerate(byte_letters())}
        self.library = encoder(path).library
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        special_ids = {t["id"] for t in spec["added_tokens"]}
        vocab = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if i not in special_ids}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        # Tokens are numbered by the order in which the merge rules make them; single bytes come first.
        made = [bytes(letters[c] for c in a + b) for a, b in merges]
        self.number = {t: n for n, t in enumerate([*(bytes([b]) for b in range(256)), *made])}
        if len(self.number) != len(vocab):
            raise ValueError("the vocabulary is not one token for each byte and merge rule")
        parts = [tuple(self.number[bytes(letters[c] for c in x)] for x in m) for m in merges]
        self.parts = [*((n, n) for n in range(256)), *parts]
        self.merged = {p: n for n, p in enumerate(parts, 256)}
        # Lengths, from the longest, of the tokens that end with the same three (or both) bytes.
        lengths: dict[bytes, set[int]] = {}
        for token in self.number:
            lengths.setdefault(token[-3:], set()).add(len(token))
        # A two-byte token may end a longer prefix; every byte is a token.
        self.lengths = {
            t: tuple(sorted(x | {2} if t[-2:] in self.number else x, reverse=True)) for t, x in lengths.items()
        }
        self.apart = Memo(lambda pair: self._apart(*pair), MEMO // 2)
        self.heads = Memo(self._head, MEMO // 3)
        self.units = Memo(self._unit, 2 * MEMO)

    def _apart(self, a: int, b: int) -> bool:
        """Whether neighbouring tokens ``a``, ``b`` stay apart: no rule that joins across
        their border applies before the rules that made them.

        The merges that made both tokens are undone from the latest to the
        first; at each step the parts that touch at the border must not be a
        pair that an earlier rule joins.
        """
        before = len(self.parts)
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < before:
                return False
            if a < 256 and b < 256:
                return True
            # Of two equal ones the left is made first, so the right is undone first.
            if a > b:
                before, a = a, self.parts[a][1]
            else:
                before, b = b + 1, self.parts[b][0]

    def _run(self, raw: bytes) -> list[int]:
        """Counts of all byte prefixes (1, 2, ...) of a pre-token."""
        return self._head(raw)[1][1:]

    def _head(self, raw: bytes) -> tuple[list[int], list[int]]:
        """The program's states; words share their first bytes, and with them the first states."""
        for n in HEADS:
            if len(raw) > n:
                last, count = self.heads[raw[:n]]
                return self._extend(raw, last[:], count[:])
        return self._extend(raw, [-1], [0])

    def _extend(self, raw: bytes, last: list[int], count: list[int]) -> tuple[list[int], list[int]]:
        """Last token and count of each prefix, from those of the first prefixes on."""
        number, apart, lengths = self.number, self.apart, self.lengths
        for end in range(len(last), len(raw) + 1):
            tail = raw[end - 3 if end > 3 else 0:end]
            for length in lengths.get(tail) or lengths.get(tail[-2:], ()):
                start = end - length
                if start < 0:
                    continue
                token = number.get(raw[start:end])
                if token is not None and (not start or apart[last[start], token]):
                    break
            else:
                start, token = end - 1, number[raw[end - 1:end]]
            last.append(token)
            count.append(count[start] + 1)
        return last, count

    def _prefixes(self, segment: str) -> list[int]:
        """Counts of the prefixes of a pre-token, by code points."""
        counts = self._run(segment.encode())
        if segment.isascii():
            return counts
        out, end = [], 0
        for c in segment:
            end += 1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4
            out.append(counts[end - 1])
        return out

    def _unit(self, unit: str) -> bytes:
        """Changes of the count over a unit's code points."""
        rest = unit.lstrip(SPACE)
        space = unit[:len(unit) - len(rest)]
        if rest.isalpha() and (not space or space == " "):
            counts = self._prefixes(unit)  # one pre-token
        else:
            counts = list(self._prefixes(space)) if space else []
            lead, base = "", 0
            if rest and space:
                before, last = space[:-1], space[-1]
                base = self._prefixes(before)[-1] if before else 0
                if last == " ":
                    lead = " "
                else:
                    base += self._prefixes(last)[-1]
            for match in _SEGMENTS.finditer(lead + rest) if rest else ():
                segment = match.group()
                own = self._prefixes(segment)
                if segment in _CONTRACTIONS:
                    # Until its last letter it is a mark and letters.
                    mark = self._prefixes("'")[-1]
                    own = [mark, *(mark + n for n in self._prefixes(segment[1:])[:-1]), own[-1]]
                counts += [base + n for n in (own[1:] if lead and match.start() == 0 else own)]
                base += own[-1]
        changes = list(map(sub, counts, [0, *counts]))
        if min(changes) < -128 or max(changes) > 127:
            raise ValueError("a change of the count does not fit one byte")
        return bytes([c & 255 for c in changes])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, _UNITS.findall(text)))

    def __call__(self, text: str) -> tuple[bytes, int]:
        """The store of a text and its token count."""
        at, parts = 0, []
        if any(s in text for s in self.specials):
            for match in self.special.finditer(text):
                # Up to its last character the special string is ordinary text; then it is one token.
                shown = self._plain(text[at:match.end() - 1])
                before = _total(self._plain(text[at:match.start()]))
                jump = before + 1 - _total(shown)
                if not -128 <= jump <= 127:
                    raise ValueError("a change of the count does not fit one byte")
                parts += [shown, bytes([jump & 255])]
                at = match.end()
        store = b"".join([*parts, self._plain(text[at:])])
        return store, _total(store)


def _total(changes: bytes) -> int:
    return int(np.frombuffer(changes, dtype=np.int8).sum(dtype=np.int64))


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The process's counter for a vocabulary file; workers keep it between tasks."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def count_at(store: bytes, n_chars: int) -> int:
    """Tokens of the prefix of ``n_chars`` code points."""
    return _total(store[:n_chars])


def longest_within(store: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    counts = np.cumsum(np.frombuffer(store, dtype=np.int8), dtype=np.int64)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def token_counts(documents: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, with_store: bool = True) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` and, if asked for, ``prefix_changes``, the store.

    A row's work and memory grow with its own text only; there is no shuffle.
    """
    path = path or vocabulary_path(VOCABULARY)

    def start():
        counts = counter(path)

        def one(text: str | None) -> tuple:
            text = text or ""
            store, n = counts(text)
            return (len(text.encode()), n, n > limit, *([store] if with_store else []))

        return one

    udf = per_text("n_bytes long, n_tokens long, over_limit boolean" + ", prefix_changes binary" * with_store, start)
    return with_struct(documents, [id_col], udf, text_col)
