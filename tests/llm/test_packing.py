import zlib

import numpy as np
import pytest

from machinewatch.llm.cutting_stock import price, solve
from machinewatch.llm.packing import VOCABULARY, make_plan, pack_documents, with_crc
from machinewatch.llm.tokenizers import encoder, vocabulary_path


def test_pricing_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = np.unique(rng.integers(1, 12, 4))
        values = rng.random(len(sizes)) - 0.1
        best = 0.0
        counts = [range(20 // s + 1) for s in sizes]
        for choice in np.array(np.meshgrid(*counts)).T.reshape(-1, len(sizes)):
            if choice @ sizes <= 20:
                best = max(best, float(choice @ values))
        value, pattern = price(sizes, values, 20)
        assert value == pytest.approx(best) and pattern @ sizes <= 20 and pattern @ values == pytest.approx(best)


def test_program_meets_the_demand_near_its_bound():
    rng = np.random.default_rng(4)
    sizes = np.array([3, 20, 35, 41, 64, 90, 127, 128, 129, 200, 256])
    demand = rng.integers(1, 5000, len(sizes)).astype(float)
    patterns, used = solve(sizes, demand, 256)
    assert (patterns @ sizes <= 256).all() and (used >= 0).all()
    assert used @ patterns == pytest.approx(demand)
    assert used.sum() >= sizes @ demand / 256 - 1e-6
    # The homogeneous patterns are no better.
    assert used.sum() <= (demand / (256 // sizes)).sum()


@pytest.mark.parametrize("lengths", [{}, {5: 1}, {1: 3, 4095: 2}, {1000: 10_000, 3096: 10_000}, {700: 5, 16: 90, 2049: 7}])
def test_plan_places_each_item_once(lengths):
    plan, places, line = make_plan(lengths), {}, []
    for n, k in lengths.items():
        for rank in range(k):
            found = plan.pattern_place(n, rank)
            if found:
                assert found not in places
                places[found] = n
            else:
                at = plan.filler_place(n, rank)
                line.append((at, at + n))
    line.sort()
    assert [a for a, _ in line] == [0, *[b for _, b in line[:-1]]][:len(line)]
    assert plan.filler == (line[-1][1] if line else 0) >= plan.room
    filled = {}
    for (sequence, _), n in places.items():
        filled[sequence] = filled.get(sequence, 0) + n
    assert sorted(filled) == list(range(plan.n_pattern)) and all(n <= 4096 for n in filled.values())
    assert sum(4096 - n for n in filled.values()) == plan.room


def _check(rows, texts):
    """Every id in one piece, sequences gapless, full or of a power of two."""
    encode = encoder(vocabulary_path(VOCABULARY))
    of_doc, of_sequence = {}, {}
    for r in rows:
        of_doc.setdefault(r["doc_id"], []).append(r)
        of_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids, at = encode(text or "") + (2).to_bytes(4, "little"), 0
        for r in sorted(of_doc.pop(doc_id), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) // 4
            assert r["ids_crc32"] == zlib.crc32(ids[4 * at:4 * (at + r["length"])])
            at += r["length"]
        assert at == len(ids) // 4
    for pieces in of_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    return of_doc


def test_documents_fill_their_sequences(documents, texts):
    assert not _check(with_crc(pack_documents(documents)).collect(), texts)


def test_odd_rows(odd, empty):
    rows = with_crc(pack_documents(odd)).collect()
    encode = encoder(vocabulary_path(VOCABULARY))
    given = [(r["doc_id"], len(encode(r["text"] or "")) // 4 + 1) for r in odd.select("doc_id", "text").collect()]
    assert sum(r["length"] for r in rows) == sum(n for _, n in given)
    # Id 4 is there twice: each of its rows is packed.
    single = {r["doc_id"]: r["text"] for r in odd.select("doc_id", "text").collect() if r["doc_id"] != 4}
    rest = _check(rows, single)
    assert set(rest) == {4} and sum(r["length"] for r in rest[4]) == 2 * dict(given)[4]
    assert with_crc(pack_documents(empty)).count() == 0
