"""The pipeline against a brute-force version of its stages."""

import collections

import sentencepiece

import corpus_pipeline
from mortar.llm.pieces import model_path
from mortar.llm.toxicity import toxicity_digest

from .conftest import words
from .test_jaccard import brute as groups
from .test_lines import BLANKS, lower

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    toxic = {r.doc_id for r in toxicity_digest(docs, labels).collect() if r.predicted}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}
    # line dedup
    holders = collections.defaultdict(set)
    for i, t in rows.items():
        for line in t.split("\n"):
            key = lower(line).strip(BLANKS)
            if len(key) >= 40:
                holders[key].add(i)
    for i, t in rows.items():
        rows[i] = "\n".join(x for x in t.split("\n") if len(who := holders.get(lower(x).strip(BLANKS), ())) < 5
                            or i == max(who))
    # near copies
    rows = {i: rows[i] for i, n, c in groups(list(rows.items())) if n == 0 or i == c}
    # benchmark passages
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[s:s + 10]) for s in range(max(len(w) - 10, 0) + 1 if w else 0)}
    sizes = {len(w) for w in windows}
    rows = {i: t for i, t in rows.items()
            if not any(tuple(w[s:s + n]) in windows for w in [words(t)] for n in sizes for s in range(len(w) - n + 1))}
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.text, r.ids, r.n_tokens, r.n_chars) for r in out} == {
        i: (t, ",".join(map(str, ids)), len(ids), len(t)) for i, t in rows.items() for ids in [library.encode(t)]}
    assert len(out) == len(rows)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    from mortar.llm.text import ARROW_BYTES, _ARROW_CONF

    before, seen = spark.conf.get(_ARROW_CONF), []
    real = corpus_pipeline.cut
    monkeypatch.setattr(corpus_pipeline, "cut", lambda df: (seen.append(spark.conf.get(_ARROW_CONF)), real(df))[1])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    corpus_pipeline.encoding(spark, docs, SF)
    assert seen == [str(ARROW_BYTES)] and spark.conf.get(_ARROW_CONF) == before
