import re

import numpy as np
import xxhash

from machinewatch.llm.simhash import WIDE, components, fingerprint, links, near_duplicates, one_of_each


def _slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _slow_components(prints: dict, radius=4):
    least = {i: i for i in prints}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], dtype=np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= radius):
            a, b = root(i), root(ids[j])
            least[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_documents_equal_brute_force(documents, texts):
    short = {i: t for i, t in texts.items() if len(t) < 20_000}
    got = {r["doc_id"]: r for r in near_duplicates(documents).collect()}
    assert all(int(got[i]["fingerprint"], 16) == _slow_fingerprint(t) for i, t in short.items())
    expected = _slow_components({i: int(r["fingerprint"], 16) for i, r in got.items()})
    assert {i: r["component_id"] for i, r in got.items()} == expected


def _random_nodes(ready, n, flips, seed):
    """Fingerprints scattered around a few centres."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 5, dtype=np.uint64)
    values = {int(c) for c in centres}
    while len(values) < n:
        value = int(rng.choice(centres))
        for bit in rng.integers(0, 64, rng.integers(0, flips + 1)):
            value ^= 1 << int(bit)
        values.add(value)
    signed = [v - 2**64 if v >= 2**63 else v for v in sorted(values)]
    return signed, ready.createDataFrame([(v,) for v in signed], "fp long")


def _joined(ready, signed, nodes, **sizes):
    found = {r["node"]: r["component"] for r in components(links(nodes, **sizes)).collect()}
    groups = {}
    for v in signed:
        groups.setdefault(found.get(v, v), set()).add(v)
    return sorted(map(sorted, groups.values()))


def test_links_of_common_and_crowded_buckets_equal_brute_force(ready):
    for radius, flips in ((4, 6), (2, 3), (7, 9)):
        signed, nodes = _random_nodes(ready, 300, flips, radius)
        expected = {}
        for v, c in _slow_components({v: v % 2**64 for v in signed}, radius).items():
            expected.setdefault(c, set()).add(v)
        expected = sorted(map(sorted, expected.values()))
        assert _joined(ready, signed, nodes, radius=radius) == expected
        # Small limits send nearly all buckets through the chunks.
        assert _joined(ready, signed, nodes, radius=radius, crowd=8, chunk=16) == expected
        # As many nodes would have it: two wide segments.
        assert _joined(ready, signed, nodes, radius=radius, segments=WIDE) == expected
        assert _joined(ready, signed, nodes, radius=radius, segments=WIDE, crowd=8, chunk=16) == expected


def test_a_crowd_that_agrees_in_two_segments(ready):
    """All in one bucket of two segments: few links of each node, and no bucket of probes alone."""
    rng = np.random.default_rng(1)
    high = int(rng.integers(0, 2**42)) << 22
    signed = sorted({high + int(v) for v in rng.integers(0, 1 << 21, 6000)})
    nodes = ready.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in signed], "fp long")
    found = links(nodes).collect()
    assert len(found) < 10 * len(signed)
    expected = {}
    for v, c in _slow_components({v: v for v in signed}).items():
        expected.setdefault(c, set()).add(v)
    parent = {v: v for v in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in ((r["a"] % 2**64, r["b"] % 2**64) for r in found):
        assert (a ^ b).bit_count() <= 4
        parent[root(a)] = root(b)
    groups = {}
    for v in signed:
        groups.setdefault(root(v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_chain(ready):
    edges = ready.createDataFrame([(i, i + 1) for i in range(1, 64)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 65), 1), 100: 100, 101: 100}


def test_odd_rows(odd, empty):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == by_id[6]["fingerprint"] == "0" * 16
    assert {by_id[i]["component_id"] for i in (1, 2, 6)} == {1}
    assert by_id[4]["component_id"] == by_id[5]["component_id"] == 4
    assert by_id[None]["component_id"] is None
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.select("doc_id").collect()) == [0, 1, 3, 4, 7, 8, 9]
    assert near_duplicates(empty).count() == 0 and one_of_each(empty).count() == 0


def test_fingerprint_of_a_long_text_in_stretches():
    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert fingerprint(text) % 2**64 == _slow_fingerprint(text)


def test_one_row_of_each_component_with_repeated_and_missing_ids(ready):
    a, b, c, e = (" ".join(f"{x}{i}" for i in range(60)) for x in ("ant", "bee", "cat", "elk"))
    rows = [(1, a), (2, a), (2, b), (3, b), (None, a), (None, b), (None, c), (None, c), (None, c.upper()), (4, e), (4, e.upper())]
    kept = [tuple(r) for r in one_of_each(ready.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(kept) == 4
    assert (1, a) in kept and (2, b) in kept
    assert {(i, t.lower()) for i, t in kept} == {(1, a), (2, b), (None, c), (4, e)}
