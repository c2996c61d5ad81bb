"""The pipeline's stages, each against a plain version of what it does to its own input."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from crawlspark.llm import catalog, mixing, surrogates, toxicity

from test_llm_operators import WORD, brute_components, texts_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into and comes out of each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp(name)) + "/rows"
        stage(spark, docs, FOLDER).write.parquet(folder)
        out = spark.read.parquet(folder)
        found[name] = (docs, out)
        docs = out
    return found


def test_order_and_columns(spark, stages):
    assert list(stages) == ["toxicity", "near_duplicates", "surrogates", "mixing", "sentencepiece"]
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(sorted(out.columns) == sorted(columns) for name, (_, out) in stages.items() if name != "sentencepiece")


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    score = toxicity.fit(before, spark.read.parquet(f"{FOLDER}/labels.parquet")).scorer()
    assert set(texts_of(after)) == {i for i, t in texts_of(before).items() if score(t) < 0.5}
    assert after.count() > 0.8 * before.count()


def test_one_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    components = brute_components(texts_of(before), 5, 80)
    assert set(texts_of(after)) == {c for _, c in components.values()}


def test_private_data_goes(stages):
    before, after = stages["surrogates"]
    new = texts_of(after)
    changed = 0
    for i, text in texts_of(before).items():
        spans = surrogates.entities(text)
        changed += bool(spans)
        assert (new[i] == text) == (not spans)
        assert not any(kind in ("email", "card", "ip", "phone", "secret") and text[a:b] in new[i] for a, b, kind in spans)
    assert changed and len(new) == before.count()


def test_mix_meets_its_targets(stages):
    before, after = stages["mixing"]
    sizes = {r.doc_id: (r.source, len(WORD.findall(r.text))) for r in before.collect()}
    taken, words = Counter(), Counter()
    originals = texts_of(before)
    for r in after.collect():
        n = len(WORD.findall(r.text))
        words[r.doc_id] += n
        taken[r.source] += n
        assert Counter(WORD.findall(r.text)) <= Counter(WORD.findall(originals[r.doc_id])) and r.n_chars == len(r.text)
    assert all(n <= 3 * sizes[i][1] for i, n in words.items())
    for s in mixing.plan(mixing.sizes(before)).collect():
        assert abs(taken[s["source"]] - s["target"]) <= 2 * mixing.BLOCK


def test_last_stage_encodes(stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=catalog.tokenizer_path())
    before, after = stages["sentencepiece"]
    texts = Counter(r.text for r in before.collect())
    assert Counter(r.decoded for r in after.collect()) == texts
    for r in after.collect():
        assert r.ids == library.encode(r.decoded) + [library.eos_id()] and r.n_tokens == len(r.ids)


def test_run_is_the_stages(spark, stages):
    out = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "n_tokens"]
    assert sorted(map(tuple, out.select(*key).collect())) == sorted(map(tuple, stages["sentencepiece"][1].select(*key).collect()))
    assert re.fullmatch(r"\w+", out.columns[0])
