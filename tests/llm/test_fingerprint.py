import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from machinewatch.llm import fingerprint as module
from machinewatch.llm.fingerprint import added, as_text, fingerprint, fingerprint_edits, likeness, removed

PIECE = re.compile(r"(?s).{0,63}?(?:\n|[.!?] )|.{1,64}")


def vector(text):
    """Lanes of one text, added up piece by piece."""
    lanes, dense, n = [0] * 120, [0] * 8, 0
    for piece in PIECE.findall(text + "\n"):
        digest, n = hashlib.sha256(piece.encode()).hexdigest().encode(), n + 1
        hashes = [xxhash.xxh64_intdigest(digest, seed=xxhash.xxh64_intdigest(i.to_bytes(4, "little"), seed=42)) for i in range(6)]
        for i in range(120):
            h, shift, slot = hashes[i // 60], i % 60 // 3, i % 3
            lanes[i] += h >> (shift + 20 * slot) & 1
        for i in range(8):
            dense[i] += hashes[2 + i // 2] >> (32 * (i % 2)) & 0xFFFFFFFF
    return n, [d % 2 ** 32 for d in dense], [x % 2 ** 16 for x in lanes]


def text_of(v):
    n, dense, lanes = v
    packed = [lanes[i] + (lanes[i + 1] << 20) + (lanes[i + 2] << 40) for i in range(0, 120, 3)]
    return f"{n:08x}" + "".join(f"{d:08x}" for d in dense) + "".join(f"{p:014x}" for p in packed)


def alike(a, b):
    if a == b:
        return 1.0
    x, y = [[2 * c - v[0] for c in v[2]] for v in (a, b)]
    norms = sum(c * c for c in x) + sum(c * c for c in y)
    return min(1.0, max(0.0, 2 * sum(c * d for c, d in zip(x, y)) / norms)) if norms else 0.0


def expected(rows):
    """One list of all rows in order: descending id (null last), then the text's digest."""
    def place(row):
        i, text = row
        digest = hashlib.sha256(text.encode()).hexdigest()
        return (i is None, -(i or 0), digest if i is None else f"{digest}:{i}")

    ordered = sorted(((i, t or "") for i, t in rows), key=place)
    out = []
    for at, (i, text) in enumerate(ordered):
        after = ordered[(at + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, changed, other = vector(text), vector(edited), vector(after)
        out.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), text_of(own), text_of(changed),
                    round(alike(own, changed), 9), round(alike(own, other), 9)))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                   round(r["near_edited"], 9), round(r["near_next"], 9)) for r in fingerprint_edits(df).collect())


def test_documents_equal_the_sum_piece_by_piece(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(documents) == expected(rows)


def test_odd_documents(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(odd) == expected(rows)


def test_copies_in_blocks(ready, monkeypatch):
    monkeypatch.setattr(module, "COPIES", 4)
    rows = [(3, "a row. with copies\nof itself")] * 11 + [(2, "another\n"), (2, "another one"), (None, "x"), (None, "x"), (1, None)]
    df = ready.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == expected(rows)


def test_one_document_and_none(ready, empty):
    df = ready.createDataFrame([(1, "Only. One!\n")], "doc_id long, text string")
    assert got(df) == expected([(1, "Only. One!\n")])
    assert fingerprint_edits(empty).collect() == []


@pytest.mark.parametrize("a, b", [
    ("", "\n"), ("one. two! three?\nfour", "five\n\nsix. "), ("x" * 300, "y. " * 90), ("\U0001f600" * 130, "é\n" * 5)])
def test_insertion_deletion_and_order(ready, a, b):
    df = ready.createDataFrame([(a, b)], "a string, b string").select(
        fingerprint(F.concat("a", F.lit("\n"), "b")).alias("both"), fingerprint(F.concat("b", F.lit("\n"), "a")).alias("turned"),
        fingerprint(F.col("a")).alias("a"), fingerprint(F.col("b")).alias("b"))
    row = df.select(*[as_text(c).alias(n) for n, c in {
        "both": F.col("both"), "turned": F.col("turned"), "sum": added(F.col("a"), F.col("b")), "a": F.col("a"),
        "left": removed(F.col("both"), F.col("b"))}.items()]).first()
    assert row["both"] == row["turned"] == row["sum"] and row["left"] == row["a"]
    assert row["a"] == text_of(vector(a))


def test_lanes_wrap(ready):
    text = "a\n" * 70_000
    df = ready.createDataFrame([(text, "a\n" * 4_463)], "a string, b string")
    row = df.select(as_text(fingerprint(F.col("a"))).alias("a"), fingerprint(F.col("a")).alias("x"),
                    fingerprint(F.col("b")).alias("y")).select(
        "a", as_text(added(removed(F.col("x"), F.col("y")), F.col("y"))).alias("back"), likeness(F.col("x"), F.col("x")).alias("same")).first()
    assert row["a"] == row["back"] == text_of(vector(text)) and row["same"] == 1.0


def test_likeness_follows_the_shared_part(ready):
    lines = [f"paragraph number {i} stands alone" for i in range(400)]
    rows = [(s, "\n".join(lines[:200]), "\n".join(lines[200 - s:400 - s])) for s in (0, 50, 100, 150, 200)]
    out = ready.createDataFrame(rows, "shared int, a string, b string").select(
        "shared", likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("l")).collect()
    assert all(abs(r["l"] - r["shared"] / 200) < 0.3 for r in out)
