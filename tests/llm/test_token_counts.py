import random

from machinewatch.llm.token_counts import VOCABULARY, count_at, counter, longest_within, token_counts
from machinewatch.llm.tokenizers import Memo, encoder, vocabulary_path

PATH = vocabulary_path(VOCABULARY)
PARTS = list("ab'sStdré .,!\n\t  12\x1c\x85\xa0　éÉΣ日ı’re<|>​----") + [
    "<|endoftext|>", "it's", "don't", "<|endo", " the", "  ", "\n\n", "'ll", "ing"]


def _random_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_every_prefix_equals_the_library():
    counts = counter(PATH)
    for text in [*_random_texts(300), "Worthwhile tokenization, isn't it?\n\n  Yes: 'twas 1234567 naïve!"]:
        store, total = counts(text)
        assert len(store) == len(text)
        for i in range(len(text) + 1):
            expected = len(counts.library.encode(text[:i], add_special_tokens=False).ids)
            assert count_at(store, i) == expected
        assert total == count_at(store, len(text))


def test_truncation_from_the_store():
    counts = counter(PATH)
    text = "The store answers budgets without encoding the text again."
    store, total = counts(text)
    for budget in range(total + 2):
        cut = longest_within(store, budget)
        assert count_at(store, cut) <= budget
        assert all(count_at(store, i) > budget for i in range(cut + 1, len(text) + 1))


def test_whole_documents_equal_the_library(documents, texts):
    library = counter(PATH).library
    for r in token_counts(documents).collect():
        expected = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"]) == (expected, len(texts[r["doc_id"]].encode()))
        assert r["over_limit"] == (expected > 1024)
        assert count_at(r["prefix_changes"], len(texts[r["doc_id"]])) == expected


def test_odd_rows(odd, empty):
    library = counter(PATH).library
    rows = token_counts(odd).collect()
    assert len(rows) == odd.count()
    got = sorted((r["n_tokens"], r["n_bytes"]) for r in rows)
    expected = sorted((len(library.encode(t, add_special_tokens=False).ids), len(t.encode()))
                      for t in (r["text"] or "" for r in odd.select("text").collect()))
    assert got == expected
    assert token_counts(empty).count() == 0


def test_encoder_equals_the_library():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        encode = encoder(vocabulary_path(name))
        for text in _random_texts(2000, seed=9):
            ids = encode.library.encode(text, add_special_tokens=False).ids
            assert encode(text) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_memo_keeps_two_generations():
    asked = []
    memo = Memo(lambda k: asked.append(k) or len(k), 4)
    for key in ["a", "bb", "ccc", "dddd", "a", "eeeee", "a", "x" * 100, "x" * 100]:
        assert memo[key] == len(key)
    assert asked.count("a") == 1 and asked.count("x" * 100) == 2 and len(memo) <= 4
