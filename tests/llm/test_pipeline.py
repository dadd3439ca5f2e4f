"""Each stage of the pipeline against the plain versions of the operators' own tests."""

import test_line_dedup
import test_mixing
import test_packing
import test_simhash
from collections import defaultdict

import pytest

import corpus_pipeline as cp
from eventloom.llm.common import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(cp.STAGES):
        docs = stored(stage(spark, docs, SF), f"test-{k}")
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").orderBy("doc_id").collect()]


def test_columns_stay(outputs):
    for df in outputs[:-1]:
        assert df.columns == outputs[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in outputs[0].schema]
    for df in outputs[2:-1]:
        assert df.where("n_chars != char_length(text)").count() == 0


def test_quality_drops_what_labels_call_bad(spark, outputs):
    before, after = (set(r[0] for r in rows(df)) for df in outputs[:2])
    told = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = sum((d in after) == (told[d] == 1) for d in told if d in before)
    assert after < before and right >= 0.97 * sum(d in before for d in told)


def test_lines(outputs):
    wanted = [(d, t) for d, t, n, gone in test_line_dedup.plain(rows(outputs[1])) if not gone or gone < n]
    assert rows(outputs[2]) == sorted(wanted)


def test_near_copies(outputs):
    before = rows(outputs[2])
    prints = [(d, test_simhash.plain_fingerprint(t)) for d, t in before]
    assert [r[0] for r in rows(outputs[3])] == sorted(set(test_simhash.plain_components(prints)))


def test_mixture(outputs):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in outputs[3].collect():
        sizes[r.source] += len((r.text or "").split())
    for r in outputs[4].collect():
        taken[r.source] += len((r.text or "").split())
    for source, target in test_mixing.plain_targets(dict(sizes)).items():
        assert abs(taken[source] - target) <= 3


def test_packed(spark, outputs):
    total = sum(r.length for r in outputs[5].collect())
    tokenizer = test_packing.Tokenizer.from_str(test_packing.pk.word_vocabulary())
    texts = [t or "" for _, t in rows(outputs[4])]
    assert total == sum(len(e.ids) + 1 for e in tokenizer.encode_batch(texts, add_special_tokens=False))


def test_run_gives_the_last_stage(spark, outputs):
    got = cp.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, outputs[5].select(key).collect()))
