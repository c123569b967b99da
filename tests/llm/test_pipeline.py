import corpus_pipeline
import pytest

import __spark_entry__
from machinewatch.llm.common import written
from machinewatch.llm.decontaminate import windows_of, words_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(ready):
    """The rows after each stage."""
    docs, out = ready.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = written(stage(ready, docs, SMALL), f"test-{name}")
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "near_duplicates", "decontamination", "packing"]
    for name in list(stages)[1:-1]:
        assert stages[name].columns == stages["documents"].columns
    sizes = [stages[n].count() for n in list(stages)[:-1]]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 100


def test_no_benchmark_passage_and_no_copy_is_left(ready, stages):
    windows = {w for r in ready.read.parquet(f"{SMALL}/benchmark.parquet").collect() for w in windows_of(words_of(r["text"]))}
    rows = stages["decontamination"].collect()
    assert len({r["text"] for r in rows}) == len(rows)
    for r in rows:
        words = words_of(r["text"])
        assert not any(tuple(words[i:i + 10]) in windows for i in range(len(words)))
    gone = {r["doc_id"] for r in stages["near_duplicates"].collect()} - {r["doc_id"] for r in rows}
    for r in stages["near_duplicates"].collect():
        words = words_of(r["text"])
        assert (r["doc_id"] in gone) == any(tuple(words[i:i + 10]) in windows for i in range(len(words)))


def test_every_kept_document_is_packed_whole(stages):
    ids = {r["doc_id"] for r in stages["decontamination"].collect()}
    pieces = stages["packing"].collect()
    assert {r["doc_id"] for r in pieces} == ids
    got = {}
    for r in pieces:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == {r["doc_id"]: r["doc_tokens"] for r in pieces}


def test_stages_take_odd_rows(ready, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = stage(ready, docs, SMALL)
            assert docs.columns == before or "sequence_id" in docs.columns
        assert docs.count() >= 0


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


def test_language_stage_refuses_what_was_not_learned(ready, stages):
    """French is not learned here; planted texts in other languages and letter junk go, clean ones stay, short ones too."""
    rows = stages["toxicity"].where("lang <> 'fr'").select("doc_id", "text", "lang")
    foreign = stages["toxicity"].where("lang = 'fr' and length(text) > 200").selectExpr(
        "doc_id + 1000000 as doc_id", "text", "cast(null as string) as lang")
    junk = " ".join(f"{a}{b}{c}q{a}w{b}" for a in "xzkvj" for b in "qwkgp" for c in "zjxvb")
    planted = ready.createDataFrame([
        (2000000, "Все люди рождаются свободными и равными в своем достоинстве и правах.", None),
        (2000001, "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. "
                  "Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.", None),
        (2000002, "日本語", None), (2000003, junk, None)], rows.schema)
    short = rows.selectExpr("doc_id + 3000000 as doc_id", "substring_index(text, ' ', 1 + doc_id % 40) as text",
                            "cast(null as string) as lang").where("text rlike '[a-z]{2}'")
    n_foreign, n_short = foreign.count(), short.count()
    docs = rows.unionByName(foreign).unionByName(planted).unionByName(short)
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["language_id"](ready, docs, SMALL).select("doc_id").collect()}
    assert not kept & set(range(2000000, 2000004))
    assert n_foreign >= 15 and sum(1000000 <= i < 2000000 for i in kept) <= 0.15 * n_foreign
    assert sum(i >= 3000000 for i in kept) >= 0.98 * n_short
    assert {r["doc_id"] for r in rows.collect()} <= kept
