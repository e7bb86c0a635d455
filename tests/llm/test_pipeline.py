"""The pipeline, stage by stage, against the brute-force versions of its operators."""

from brute import contamination, failures, measures
from test_lines import brute as brute_lines
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _saved(spark, df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding"]
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = _saved(spark, stage(spark, docs, SF), tmp_path, str(k))
        seen[name] = docs
        if k < 4:
            assert docs.columns == COLUMNS
    raw = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r.doc_id: r.text for r in seen["quality rules"].collect()}
    assert good == {i: r.text for i, r in raw.items() if not failures(measures(r.text))}
    lined = {r.doc_id: r.text for r in seen["line dedup"].collect()}
    rows = sorted(good.items())
    want = dict(zip((i for i, _ in rows), brute_lines(rows)))
    assert set(lined) == set(good) and sum(lined[i] != want[i] for i in want) <= 2
    prints = [(i, brute_fingerprint(t)) for i, t in sorted(lined.items())]
    component = brute_components(prints)
    unique = {r.doc_id: r.text for r in seen["SimHash near-dedup"].collect()}
    assert unique == {i: lined[i] for n, (i, _) in enumerate(prints) if component[n] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id: r for r in seen["benchmark decontamination"].collect()}
    assert {i: r.text for i, r in clean.items()} == {i: t for i, t in unique.items() if not contamination(t, items)[0]}
    assert all(r.n_chars == len(r.text or "") for r in clean.values())
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    coded = {r.doc_id: r for r in seen["BPE encoding and decoding"].collect()}
    assert set(coded) == set(clean)
    for i, r in coded.items():
        ids = library.encode(clean[i].text or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), library.decode(ids, skip_special_tokens=False))
    assert len(raw) > len(good) and len(lined) > len(unique) > len(clean) > 0


def test_edge_rows_pass_through_every_stage(spark, tmp_path):
    plain = "some quite ordinary words that make up one line of a document"
    rows = [(None, plain + " a", None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, plain + " b c", "en", "s", 5),
            (3, plain + " b c", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, start in (("rows", docs), ("none", docs.limit(0))):
        step = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            step = _saved(spark, stage(spark, step, SF), tmp_path, f"{name}{k}")
        assert step.count() == (2 if name == "rows" else 0)
