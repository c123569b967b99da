import random
import re

from machinewatch.llm.quality_rules import judge, quality_rules, repeated_words


def _slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    covered = set()
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update((i, i + 1, i + 2))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(covered), failed)


def test_repeated_words_overlap():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 25))]
        assert repeated_words(words) == _slow(" ".join(words))[4]


def test_documents_equal_brute_force(documents, texts):
    rows = {r["doc_id"]: tuple(r)[1:7] for r in quality_rules(documents).collect()}
    short = {i: t for i, t in texts.items() if len(t) < 4000}
    assert {i: rows[i] for i in short} == {i: _slow(t) for i, t in short.items()}


GOOD = " ".join(f"Sentence{i} number{i} tells{i} something{i} plain{i} and ends{i} well{i}." for i in range(12))


def test_lines_are_judged_one_by_one():
    *_, kept, lost, cleaned = judge(f"Home | News | Sport | About\n{GOOD}\nAll rights reserved.\nRead more\n{GOOD[:80]}.\n{GOOD[:80]}.")
    assert kept and 0 < lost < 0.3
    assert cleaned == f"{GOOD}\n{GOOD[:80]}."


def test_too_much_lost_is_rejected():
    menu = "\n".join(f"Entry{i} | page{i} | more{i} | item{i}" for i in range(40))
    result = judge(f"{menu}\n{GOOD}")
    assert not result[5] and not result[6] and result[7] > 0.5
    noise = " ".join(f"word{i}{s}" for i, s in enumerate(["###", "&&&", "%%%"] * 40))
    assert not judge(noise)[6]
    assert judge(GOOD)[6:8] == (True, 0.0)


def test_odd_rows(odd, empty):
    rows = quality_rules(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    for i in (1, 2, 6):
        assert by_id[i]["n_words"] == 0 and by_id[i]["base_failed"] and not by_id[i]["kept"]
    assert by_id[3]["n_words"] == 60_000 and by_id[3]["base_failed"]
    assert by_id[4]["kept"] and by_id[5]["kept"]
    assert quality_rules(empty).count() == 0
