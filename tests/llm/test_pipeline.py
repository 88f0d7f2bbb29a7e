from collections import Counter

import corpus_pipeline as cp
import pytest
from webloom.llm import toxicity
from webloom.llm.line_dedup import line_groups
from webloom.llm.ngram_join import ngram_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark):
    docs, out = cp.documents(spark, SF), [cp.documents(spark, SF)]
    for _, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, SF))
        out.append(docs)
    return out


def test_stages_are_named_and_return_documents(staged):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]
    assert all(d.columns == staged[0].columns for d in staged[:-1])


def test_each_stage_decides_on_its_own_input(staged, spark):
    raw, clean, lines, distinct, mixed, packed = staged
    bad = {r.doc_id for r in toxicity.rate(raw, spark.read.parquet(f"{SF}/labels.parquet")).where("toxic").collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in raw.collect()} - bad
    gone = Counter()
    for r in line_groups(clean, every_line=True).where("not kept").collect():
        gone[r.doc_id] += 1
    before = {r.doc_id: r.text for r in clean.collect()}
    for r in lines.collect():
        assert r.n_chars == len(r.text)
        kept = before[r.doc_id].split("\n")
        assert len(kept) - gone[r.doc_id] == (len(r.text.split("\n")) if r.text else len(kept) - gone[r.doc_id])
    copies = {r.doc_id for r in ngram_components(lines).where("component_id <> doc_id").collect()}
    assert {r.doc_id for r in distinct.collect()} == {r.doc_id for r in lines.collect()} - copies
    texts = {r.doc_id: r for r in distinct.collect()}
    assert all(tuple(r) == tuple(texts[r.doc_id]) for r in mixed.collect())
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3
    assert packed.select("row_id").distinct().count() == mixed.count()


def test_run_gives_the_last_stage(staged, spark):
    got = cp.run(spark, SF)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert Counter(map(key, got.collect())) == Counter(map(key, staged[-1].collect()))


def test_messy_rows_and_nothing_pass_all_stages(messy, nothing, spark):
    for docs in (messy, nothing):
        for _, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert stage is cp.pack_windows or out.columns == docs.columns
            docs = cp.materialize(out)
    assert docs.count() == 0


def test_near_copies_keep_the_smallest_and_one_of_equal_rows(spark):
    text = " ".join(f"w{k}" for k in range(50))
    df = spark.createDataFrame([(3, text), (1, text + " more"), (7, "other words here"), (7, "other words here"), (None, None), (8, None)],
                               "doc_id long, text string")
    got = sorted(map(tuple, cp.drop_near_copies(spark, df, SF).collect()), key=str)
    assert got == sorted([(1, text + " more"), (7, "other words here"), (None, None), (8, None)], key=str)
