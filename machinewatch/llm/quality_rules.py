"""Line-first cleaning and the quality rules of a document.

Each line is judged by itself; failing lines are removed, and a document is
rejected if too much of it went with them (or by the base rules, which look
at the text as it came). Per-line rules: no end punctuation in a short line,
navigation (separators between short entries), boilerplate (licence, cookie,
privacy, sign-up notices), symbol noise, and a line that was there before.

Defined results: null and empty texts have no words, fail the base rules and
are not kept; the first of equal lines stays; repeated rows are judged each.
A row's work grows with its own text; there is no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

from machinewatch.llm.common import per_text, with_struct

#: Base rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Largest share of word characters that removed lines may take.
MAX_LOST = 0.5
#: A line without end punctuation must have this many words.
SHORT_LINE = 5
#: Symbols per word from which a line is noise.
SYMBOL_NOISE = 0.3
#: Separators per word from which a line is a menu.
MENU_SHARE = 0.3

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_END = tuple(".!?…\"'”’»)。！？:;")
_SEPARATOR = re.compile(r"^(?:[|»›•·/>-]|::)$")
_BOILERPLATE = re.compile(
    r"all rights reserved|^\W*(?:this work is )?(?:licensed|released) under\b|terms (?:of|and) (?:use|service|conditions)"
    r"|privacy policy|cookie policy|uses? cookies|accept (?:all )?cookies|sign up for|subscribe to|click here"
    r"|enable javascript|^\W*(?:copyright|©|\(c\))", re.IGNORECASE)


def line_verdict(line: str, words: list[str]) -> str:
    """Why a line with words is removed, or ``ok``."""
    symbols = len(_SYMBOLS.findall(line))
    separators = sum(1 for w in words if _SEPARATOR.match(w))
    if separators >= 2 and separators >= MENU_SHARE * len(words):
        return "navigation"
    if symbols >= SYMBOL_NOISE * len(words) and symbols >= 3:
        return "symbols"
    if _BOILERPLATE.search(line):
        return "boilerplate"
    if len(words) < SHORT_LINE and not words[-1].endswith(_END):
        return "punctuation"
    return "ok"


def repeated_words(words: list[str]) -> int:
    """Words in three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    n, covered = 0, 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            n += at + 3 - max(at, covered)
            covered = at + 3
    return n


def judge(text: str | None, max_lost: float = MAX_LOST) -> tuple:
    """Base figures, the two verdicts, the share of lost characters and the cleaned text."""
    text = text or ""
    words = _WORD.findall(text)
    chars = sum(map(len, words))
    n_repeat = repeated_words(words)
    seen, kept_lines, duplicates, lost = set(), [], 0, 0
    for line in text.split("\n"):
        own = _WORD.findall(line)
        if not own:
            kept_lines.append(line)
            continue
        again = line in seen
        duplicates += again
        seen.add(line)
        if again or line_verdict(line, own) != "ok":
            lost += sum(map(len, own))
        else:
            kept_lines.append(line)
    base_failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * len(words)
    share = lost / chars if chars else 0.0
    return (len(words), chars, len(_SYMBOLS.findall(text)), duplicates, n_repeat, base_failed,
            not base_failed and share <= max_lost, share, "\n".join(kept_lines))


def quality_rules(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_lost: float = MAX_LOST, with_text: bool = True) -> DataFrame:
    """One row per document: the figures, ``base_failed``, ``kept``, ``lost_share`` and the cleaned text."""
    ddl = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, lost_share double" + ", cleaned string" * with_text)

    def start():
        return lambda text: judge(text, max_lost)[:9 if with_text else 8]

    return with_struct(documents, [id_col], per_text(ddl, start), text_col)
