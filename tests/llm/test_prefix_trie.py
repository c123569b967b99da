import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from machinewatch.llm import prefix_trie as module
from machinewatch.llm.prefix_trie import prefix_trie, rebuilt_turns

SCHEMA = "conv_id long, turn long, role string, text string"


def _digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def expected(rows):
    """A trie of dictionaries, turn by turn."""
    of = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            of.setdefault(conv, []).append((turn is not None, turn or 0, _digest(role, text), role, text))
    original = {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in of.items()}
    rebuilt = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c - 20 * int(c / 20))
        rebuilt[c] = original.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    kids = {}
    for key in nodes:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    totals = {}
    for key in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        below = [totals[k] for k in kids.get(key, [])]
        totals[key] = (sum(b[0] for b in below) or 1, (len(nodes[key]) - 1) * words + sum(b[1] for b in below))
        ends = ",".join(str(c) for c in sorted(nodes[key]) if len(rebuilt[c]) == len(key))
        out[min(nodes[key]), len(key)] = (
            min(nodes[key[:-1]]) if key else None, len(nodes[key]), len(kids.get(key, [])), *totals[key],
            hashlib.sha256(ends.encode()).hexdigest())
    return out


def got(df):
    rows = prefix_trie(rebuilt_turns(df)).collect()
    out = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in rows}
    assert len(out) == len(rows)
    return out


def _shared():
    """Families that share turns, copies, null and tied turns, and ids on both sides of zero."""
    rows = []
    for c in range(-45, 70):
        for i in range((c * 7) % 9):
            rows.append((c, i, "user" if i % 2 == 0 else "assistant", f"turn {i} of {(c // (9 - i)) % 3} words " * (1 + i % 2)))
    rows += [(200, None, "user", "no number"), (200, None, None, None), (200, 1, "user", "tied"), (200, 1, "assistant", "tied"),
             (200, 1, "user", "tied"), (None, 0, "user", "no conversation"), (201, 0, "user", ""), (10 ** 15, 0, "user", "far")]
    return rows


@pytest.mark.parametrize("rows", [
    _shared(), [(5, 0, "user", "alone")], [(20, 0, None, None)], [(7, 0, "user", "x")] * 3,
    [(41, 0, "a", "b:c"), (42, 0, "a", "b:c"), (43, 0, "ab", ":c")]])
def test_equals_a_trie_built_turn_by_turn(ready, rows):
    assert got(ready.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_one_long_conversation_and_its_copies(ready):
    rows = [(c, i, "user", f"word {i}") for c in (20, 21, 22, 40) for i in range(75 + c % 3)] + [
        (23, i, "user", f"word {i}") for i in range(30)] + [(24, i, "user", "same") for i in range(33)]
    assert got(ready.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_blocks_of_copies_and_ids(ready, monkeypatch):
    monkeypatch.setattr(module, "COPIES", 3)
    monkeypatch.setattr(module, "ID_BITS", 1)
    monkeypatch.setattr(module, "CHUNK_BITS", 1)
    rows = [(3, 1, "user", "again")] * 17 + [(c, i, "user", "t") for c in range(100, 140) for i in range(6)]
    assert got(ready.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_clashing_columns_and_no_rows(ready):
    rows = _shared()
    df = ready.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 as conv", "2 as d", "'n' as name", "3 as part", "4 as rep", "5 as h", "6 as k", "7 as t", "8 as words")
    assert got(df) == expected(rows)
    assert prefix_trie(rebuilt_turns(df.where(F.lit(False)))).collect() == []
