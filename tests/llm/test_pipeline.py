"""The pipeline, stage by stage, against plain Python on the smallest table."""

import base64
import os
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from gatehouse.llm import entropy_mix, secrets_battery, simhash_bk, toxicity_cnn
from gatehouse.llm.common import table
from tests.llm.frames import docs
from tests.llm.test_mix import plain_targets, words
from tests.llm.test_secrets import plain as plain_secrets
from tests.llm.test_simhash import plain_components, plain_simhash

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned, as rows."""
    out, df = [], table(spark, SF, "documents")
    root = tmp_path_factory.mktemp("pipeline")
    for name, stage in corpus_pipeline.STAGES:
        before = df
        path = str(root / name)
        stage(spark, df, SF).write.parquet(path)
        df = spark.read.parquet(path)
        out.append((name, before, df, before.collect(), df.collect()))
    return {n: rest for n, *rest in out}


def test_order_and_columns(spark, stages):
    assert list(stages) == ["toxicity", "simhash_near_dedup", "secret_scan", "mixing", "bpe_tokens"]
    columns = table(spark, SF, "documents").columns
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == columns


def test_toxicity_keeps_what_scores_low(spark, stages):
    before, _, rows, kept = stages["toxicity"]
    scorer = toxicity_cnn.Scorer(toxicity_cnn.train(before, table(spark, SF, "labels")))
    want = {r.doc_id for r in rows if scorer(r.text.encode())[0] < 0.5}
    assert {r.doc_id for r in kept} == want and len(kept) == len(want) < len(rows)


def test_near_duplicates_keep_one_of_each_component(stages):
    _, _, rows, kept = stages["simhash_near_dedup"]
    comp = plain_components([plain_simhash(r.text) for r in rows])
    low = {}
    for r in rows:
        c = min(comp[plain_simhash(r.text)])
        low[c] = min(low.get(c, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in kept) == sorted(low.values())


def test_secrets_are_masked(stages):
    _, _, rows, kept = stages["secret_scan"]
    after = {r.doc_id: r for r in kept}
    assert set(after) == {r.doc_id for r in rows}
    for r in rows:
        text, end, parts = r.text, 0, []
        for _, s, e in plain_secrets(text):
            if e <= end:
                continue
            if s >= end:
                parts += [text[end:s], "[SECRET]"]
            end = e
        assert after[r.doc_id].text == "".join([*parts, text[end:]])     # the battery adds nothing in this table
        assert after[r.doc_id].n_chars == len(after[r.doc_id].text)


def test_mixing_repeats_documents_to_the_targets(stages):
    _, _, rows, kept = stages["mixing"]
    times = Counter(r.doc_id for r in kept)
    assert set(times) <= {r.doc_id for r in rows} and max(times.values()) <= 2
    size, taken = Counter(), Counter()
    for r in rows:
        size[r.source] += words(r.text)
    for r in kept:
        taken[r.source] += words(r.text)
    for s, t in plain_targets(dict(size)).items():
        assert taken[s] <= t + 1e-6 and taken[s] >= t - min(words(r.text) for r in rows if r.source == s) * 3 - 0.03 * t


def test_tokens_are_the_librarys(stages):
    _, _, rows, out = stages["bpe_tokens"]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(corpus_pipeline.RANKS), "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r.doc_id, r.source, e.encode_ordinary(r.text)) for r in rows)
    assert sorted((r.doc_id, r.source, list(r.ids)) for r in out) == want
    assert all(r.n_tokens == len(r.ids) for r in out)


def test_awkward_documents_go_through(spark):
    df = docs(spark, [(1, None), (2, ""), (None, "text without id"), (3, "same text here"), (3, "same text here")], extra=False)
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF)
    assert {r.doc_id for r in df.collect()} <= {None, 3}
