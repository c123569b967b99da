import hashlib
import re

import pytest

from machinewatch.llm.decontaminate import clean, decontaminate, windows_of, words_of

SMALL = "/root/testdata/sf0.001"


def _slow_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _slow(text, items):
    words, hit, found = _slow_words(text), set(), set()
    for item_id, item in items:
        own = _slow_words(item)
        for k in range(max(1, len(own) - 9) if own else 0):
            window = own[k:k + 10]
            for i in range(len(words) - len(window) + 1):
                if words[i:i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item_id)
    found.discard(None)
    digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit)


def _result(frame):
    return [tuple(r)[1:] for r in sorted(frame.collect(), key=lambda r: (r[0] is None, r[0] or 0))]


def test_words_equal_the_pattern():
    text = "Ab-C9 été\x7f日本_x@Z\x00q  ÀB İx"
    assert [w.decode() for w in words_of(text)] == _slow_words(text)
    assert windows_of([]) == [] and windows_of([b"a"] * 12) == [(b"a",) * 10] * 3


@pytest.mark.parametrize("block_bytes", [4 << 20, 600])
def test_documents_equal_brute_force(ready, documents, texts, block_bytes):
    benchmark = ready.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    short = {i: t for i, t in texts.items() if len(t) < 8000}
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate(documents, benchmark, block_bytes=block_bytes).collect()}
    assert len(got) == len(texts)
    assert {i: got[i] for i in short} == {i: _slow(t, items) for i, t in short.items()}
    kept = clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r[-1]}


ITEMS = [(10, "One two three four five six seven eight nine ten eleven"), (2, "short item"), (3, "word"), (4, None), (5, " .,"),
         (6, "One two three four five six seven eight nine ten eleven"), (7, "a a a a a a a a a a a a"), (None, "no id"), (None, None),
         (None, "one two three four five six seven eight nine ten eleven")]
TEXTS = ["zero ONE, two three four five six seven eight nine ten! Eleven twelve", "one two three four five six seven eight nine",
         "a SHORT item and a word", "short", "a " * 30, None, "", "two three four five six seven eight nine ten eleven",
         "ten eleven one two three", "the word word word", "found by no id alone"]


@pytest.mark.parametrize("block_bytes", [4 << 20, 20])
def test_small_windows_and_nulls(ready, block_bytes):
    docs = ready.createDataFrame(list(enumerate(TEXTS)) + [(10, TEXTS[10])], "doc_id long, text string")
    benchmark = ready.createDataFrame(ITEMS, "item_id long, text string")
    expected = [_slow(t, ITEMS) for t in [*TEXTS, TEXTS[10]]]
    assert _result(decontaminate(docs, benchmark, block_bytes=block_bytes)) == expected
    assert expected[-1][1:] == (2, 0, hashlib.sha256(b"").hexdigest(), True)
    kept = clean(docs, benchmark, block_bytes=block_bytes).collect()
    assert sorted(r["doc_id"] for r in kept) == [i for i, e in enumerate(expected[:-1]) if not e[-1]]


def test_odd_rows(ready, odd, empty):
    benchmark = ready.createDataFrame([(1, "quick brown fox"), (2, "word5 word6")], "item_id long, text string")
    rows = decontaminate(odd, benchmark).collect()
    assert len(rows) == odd.count()
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {3, 4, 5}
    assert {r["doc_id"]: r["n_hit"] for r in rows}[3] == 18_000
    assert decontaminate(empty, benchmark).count() == 0
    nothing = decontaminate(odd, benchmark.where("false")).collect()
    assert len(nothing) == odd.count() and not any(r["contaminated"] for r in nothing)
    assert clean(odd, benchmark).columns == odd.columns and clean(odd, benchmark).count() == odd.count() - 4
