from collections import Counter

from pyspark.sql import functions as F

from machinewatch.llm import language
from machinewatch.llm.common import crc_mod, with_struct
from machinewatch.llm.language import PROFILE, RankOrder, fit_profiles, language_udf


def _slow_counts(text):
    counts = Counter()
    word = ""
    for c in [*text.lower(), " "]:
        if c.isalpha():
            word += c
            continue
        if word:
            padded = f"_{word}_"
            for n in (1, 2, 3):
                for i in range(len(padded) - n + 1):
                    if padded[i:i + n] != "_":
                        counts[padded[i:i + n]] += 1
        word = ""
    return counts


def _slow_rank(counts, size=PROFILE):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


def _slow_predict(text, profiles):
    mine = _slow_rank(_slow_counts(text))
    cost = {}
    for lang, p in profiles.items():
        places = {g: i for i, g in enumerate(p)}
        cost[lang] = sum(abs(places[g] - i) if g in places else PROFILE for i, g in enumerate(mine))
    return min(sorted(cost), key=cost.get)


def test_profiles_and_predictions_equal_brute_force(documents, texts):
    train = documents.where(crc_mod(F.col("doc_id"), 4) != 2)
    profiles = fit_profiles(train)
    sums = {}
    for r in train.select("lang", "text").collect():
        sums.setdefault(r["lang"], Counter()).update(_slow_counts(r["text"]))
    assert profiles == {lang: _slow_rank(c) for lang, c in sums.items()}
    rows = with_struct(documents, ["doc_id", "lang"], language_udf(profiles), "text").collect()
    assert [r["lang_pred"] for r in rows] == [_slow_predict(texts[r["doc_id"]], profiles) for r in rows]
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_rankings_of_any_script_and_length(monkeypatch):
    hard = ["", "_ a _b_ c1d", "aaa a aa", "ı İ ß ǅ 日本語 \U0001d49c\U0001d4b7 \U00010400", "x" * 3000 + " y",
            " ".join(f"w{i} été" for i in range(500)), "12 34", "e\u0301e \u0301"]
    for block in (50_000, 7, 1):
        monkeypatch.setattr(language, "BLOCK", block)
        for text in hard:
            for size in (1, 5, PROFILE):
                got = [language.gram_text(int(n)) for n in language.ranked(*language.count_grams(text), size)]
                assert got == _slow_rank(_slow_counts(text), size)


def test_held_out_accuracy(documents):
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    profiles = fit_profiles(documents.where(~held_out))
    rows = with_struct(documents.where(held_out), ["lang"], language_udf(profiles), "text").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 20


def test_sample_is_bounded(ready):
    rows = ready.range(4000).selectExpr("id as doc_id", "'ab' as text", "'xx' as lang")
    profiles = fit_profiles(rows, sample=100)
    assert profiles == {"xx": ["_a", "_ab", "a", "ab", "ab_", "b", "b_"]}


def test_a_shared_id_does_not_stretch_the_sample(ready):
    """A third of the rows without an id, a third with one id."""
    rows = ready.range(30_000).selectExpr("case when id % 3 = 0 then null when id % 3 = 1 then 5 else id end as doc_id",
                                          "concat('text ', id) as text", "'xx' as lang")
    n = language._sampled(rows, "doc_id", "text", "lang", 2000).count()
    assert 1800 < n < 2200


def test_odd_rows(odd, empty):
    profiles = fit_profiles(odd)
    rows = with_struct(odd, ["doc_id"], language_udf(profiles), "text").collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert len(rows) == odd.count() and set(profiles) == {"en", "de", "fr"}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 6, 9))
    assert got[3][0] == "en" and got[4][0] == "de"
    assert fit_profiles(empty) == {} and RankOrder({})("text") == ("und", 0.0)
    assert with_struct(empty, ["doc_id"], language_udf(profiles), "text").count() == 0


def test_ties_go_to_the_first_language():
    assert RankOrder({"b": ["x"], "a": ["x"]})("x")[0] == "a"
