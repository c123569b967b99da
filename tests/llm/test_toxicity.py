import random

import pytest
from pyspark.sql import functions as F

from machinewatch.llm.common import crc_mod, with_struct
from machinewatch.llm.toxicity import BASE, LexiconAutomaton, ToxicLexicon, ToxicScorer, edits, fit_lexicon, toxicity_udf

SMALL = "/root/testdata/sf0.01"


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def test_automaton_equals_edit_distances():
    rng = random.Random(2)
    words, stems = ["idiot", "scum", "worthless", "disgusting", "loser", "losers"], ["veju", "lostrando"]
    automaton = LexiconAutomaton(words, stems)
    for _ in range(4000):
        word = list(rng.choice([*words, *stems, "idol", "wordless"]))
        for _ in range(rng.randint(0, 3)):
            at, c = rng.randint(0, len(word)), rng.choice("abdeilorstv")
            kind = rng.randint(0, 2)
            word[at:at + (kind > 0)] = [c] if kind < 2 else []
        word = "".join(word)
        near = [(_distance(word, w), w) for w in words if _distance(word, w) <= edits(w, False)]
        near += [(e, s) for s in stems for e in [min(_distance(word[:n], s) for n in range(len(word) + 1))]
                 if e <= edits(s, True)]
        found = automaton.match(word)
        assert (found is None) == (not near), word
        if near:
            assert found[1] == min(near)[0] and found[::-1] in near


def test_quotation_is_not_abuse():
    scorer = ToxicScorer(ToxicLexicon(["idiot"], [], {("idiot", 0): 6.0, ("idiot", 1): 4.0}))
    assert scorer("You are an idiot and that is all.")[1] == 1
    assert scorer("You are an idiott and that is all.")[1] == 1
    assert scorer('She said "idiot" is a word from Greek.')[1] == 0
    assert scorer('He wrote: "what an idiot that man was", and left.' * 3)[1] == 0
    assert scorer('The word "idiot" again. You idiot, go away.')[1] == 1
    assert scorer(None) == scorer("") == scorer("A calm day.") == (BASE, 0)


def test_long_text_is_scored_whole():
    scorer = ToxicScorer(ToxicLexicon(["idiot"], [], {("idiot", 0): 6.0}))
    assert scorer("calm words here. " * 50_000 + "you idiot")[1] == 1


@pytest.fixture(scope="module")
def planted(ready):
    rng = random.Random(7)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows = []
    for i in range(600):
        words = [rng.choice(plain) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["moronic", "zzkarta" + rng.choice(plain), "zzkartu"])
        rows.append((i, " ".join(words), int(toxic)))
    docs = ready.createDataFrame([(i, t, "src") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = ready.createDataFrame([(i, x) for i, _, x in rows] + [(None, 1), (5, None), (99_999, 1)],
                                   "doc_id long, toxic int")
    return docs, labels, {i: x for i, _, x in rows}


def test_terms_and_stems_are_learned(planted):
    docs, labels, truth = planted
    lexicon = fit_lexicon(docs, labels)
    assert lexicon.words == ["moronic"] and lexicon.stems == ["zzkart"]
    rows = with_struct(docs, ["doc_id"], toxicity_udf(lexicon), "text").collect()
    assert {r["doc_id"]: r["predicted"] for r in rows} == truth
    assert ToxicScorer(lexicon)("a morronic thing")[1] == 1


def test_held_out_labels_of_the_tables(ready):
    docs, labels = ready.read.parquet(f"{SMALL}/documents.parquet"), ready.read.parquet(f"{SMALL}/labels.parquet")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    udf = toxicity_udf(fit_lexicon(docs, labels.where(~held_out)))
    rows = with_struct(docs.join(labels, "doc_id").where(held_out), ["toxic"], udf, "text").collect()
    clean = [r for r in rows if r["toxic"] == 0]
    assert len(rows) > 50 and sum(r["predicted"] for r in clean) <= 0.05 * len(clean)
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.9 * len(rows)


def test_odd_rows(ready, odd, empty):
    labels = ready.createDataFrame([(4, 1), (4, 0), (3, 0), (1, 1)], "doc_id long, toxic int")
    for lexicon in (fit_lexicon(odd, labels), fit_lexicon(empty, labels), fit_lexicon(odd, labels.where("false"))):
        rows = with_struct(odd, ["doc_id"], toxicity_udf(lexicon), "text").collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 6)} == {BASE}


def test_rows_of_a_repeated_id_teach_once(planted):
    docs, labels, _ = planted
    often = docs.unionByName(docs.where("doc_id in (0, 1)").crossJoin(docs.sparkSession.range(200)).drop("id"))
    assert often.count() == 1000 and fit_lexicon(often, labels) == fit_lexicon(docs, labels)


def test_copies_of_a_long_toxic_text_do_not_crowd_out_terms(ready):
    rng = random.Random(11)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    long_words = ["".join(rng.choice("klmnopqrst") for _ in range(12)) for _ in range(3000)]
    rows = []
    for i in range(360):
        words = [rng.choice(plain) for _ in range(40)]
        if i < 60:  # a third of the toxic texts: near copies, each with a few words of its own
            words = long_words + words
        elif i < 100:
            words[7] = "moronic"
        rows.append((i, " ".join(words), int(i < 180)))
    docs, labels = ready.createDataFrame(rows, "doc_id long, text string, toxic int").drop("toxic"), ready.createDataFrame(
        [(i, x) for i, _, x in rows], "doc_id long, toxic int")
    assert fit_lexicon(docs, labels).words == ["moronic"]
