"""PCA and truncated SVD: properties and agreement with numpy on small matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from itemscope.operators import decomposition as DC
from itemscope.operators import gram as GR
from itemscope.operators import svd as SV
from itemscope.operators import text as TX
from itemscope.plans.context import Tables

from conftest import SF001


@pytest.fixture(scope="module")
def emb(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    p = 16
    cols = [F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(p)]
    wide = df.select("vec_id", *cols, F.lit(3.0).alias("const"))
    names = [f"f{i}" for i in range(p)] + ["const"]
    x = np.array([[r[c] for c in names] for r in wide.orderBy("vec_id").collect()])
    return wide, names, x


def test_pca_matches_numpy(spark, emb):
    wide, names, x = emb
    fit = DC.fit_pca(wide, names)
    mu, sd = x.mean(0), x.std(0)
    sd[sd == 0] = 1.0
    xs = (x - mu) / sd
    _, s, vt = np.linalg.svd(xs, full_matrices=False)
    ratio = s ** 2 / (s ** 2).sum()
    assert np.allclose(fit.ratio, ratio, atol=1e-10)
    assert fit.cumulative[-1] == pytest.approx(1.0)
    v = fit.components
    assert np.allclose(v.T @ v, np.eye(len(names)), atol=1e-10)
    # same subspace as numpy for the leading components (signs are a convention)
    for j in range(3):
        assert abs(abs(v[:, j] @ vt[j]) - 1.0) < 1e-8
    # closed form equals the explicit reconstruction, both distributed and numpy
    for k in (1, 5, 12):
        tail = (s[k:] ** 2).sum()
        mse_np = tail / xs.size
        rel_np = np.sqrt(tail / (s ** 2).sum())
        closed = DC.reconstruction_error(spark, fit, [k]).first()
        assert closed.mse == pytest.approx(mse_np, rel=1e-9, abs=1e-12)
        assert closed.relative_frobenius_error == pytest.approx(rel_np, rel=1e-9)
        mse_d, rel_d = DC.reconstruction_error_explicit(fit, k)
        assert mse_d == pytest.approx(mse_np, rel=1e-8, abs=1e-12) and rel_d == pytest.approx(rel_np, rel=1e-8)
    # scores = Xs V
    sc = DC.pca_scores(fit, ["vec_id"], 2).orderBy("vec_id").collect()
    ref = xs @ v[:, :2]
    assert np.allclose([[r.pc1, r.pc2] for r in sc], ref, atol=1e-9)


def test_pca_thresholds_and_few_features(spark, emb):
    wide, names, _ = emb
    fit = DC.fit_pca(wide, names)
    cum = fit.cumulative
    k = fit.components_for(0.9)
    assert cum[k - 1] >= 0.9 and (k == 1 or cum[k - 2] < 0.9)
    ks = fit.components_for(cum[k - 1], strict=True)
    assert ks == min(k + 1, fit.p)
    one = DC.fit_pca(wide.select("vec_id", "f0"), ["f0"])
    sc = DC.pca_scores(one, ["vec_id"], 3, pad_to=3).first()
    assert sc.pc2 == 0.0 and sc.pc3 == 0.0
    assert DC.reconstruction_candidates(one) == [1]


def test_tfidf_matches_bruteforce(spark):
    """TF-IDF long form equals a direct Python computation of the rule."""
    import math
    import re
    t = Tables(spark, SF001)
    parts = t.catalog.select("movieId", F.col("title").alias("text")).unionByName(
        t.tags_clean.select("movieId", F.col("tag").alias("text")).distinct())
    w, vocab = TX.tfidf(parts, "movieId", "text", 300, 2, all_ids=t.catalog.select("movieId"))
    got = {(r.movieId, r.term): r.weight for r in w.collect()}
    stop = set(TX.ENGLISH)
    docs = {}
    for r in parts.collect():
        toks = [m for m in re.findall(r"[^\W]{2,}", (r.text or "").lower()) if m not in stop]
        docs.setdefault(r.movieId, []).extend(toks)
    n = t.catalog.count()
    df, total = {}, {}
    for toks in docs.values():
        for term in set(toks):
            df[term] = df.get(term, 0) + 1
        for term in toks:
            total[term] = total.get(term, 0) + 1
    keep = sorted((term for term in df if df[term] >= 2), key=lambda x: (-total[x], x))[:300]
    keep = set(keep)
    want = {}
    for d, toks in docs.items():
        counts = {}
        for term in toks:
            if term in keep:
                counts[term] = counts.get(term, 0) + 1
        ws = {term: c * (math.log((1 + n) / (1 + df[term])) + 1) for term, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in ws.values()))
        for term, v in ws.items():
            want[(d, term)] = v / norm
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert vocab.count() == len(keep)


def test_truncated_svd_matches_numpy(spark):
    rng = np.random.default_rng(7)
    n, m = 120, 40
    dense = rng.random((n, m)) * (rng.random((n, m)) < 0.2)
    rows = [(int(i), int(j), float(dense[i, j])) for i, j in zip(*np.nonzero(dense))]
    x = spark.createDataFrame(rows, "rid bigint, col_idx int, value double")
    x = SV.prepare(x, "rid")
    k = 10
    fit = SV.truncated_svd(x, "rid", n, m, k, tol=1e-8)
    s = np.linalg.svd(dense, compute_uv=False)
    assert np.allclose(fit.singular_values, s[:k], rtol=1e-9)
    loose = SV.truncated_svd(x, "rid", n, m, k, oversamples=0)
    assert np.allclose(loose.singular_values, s[:k], rtol=1e-6)
    wide = SV.truncated_svd(x, "rid", n, m, k, tol=1e-8, gram_cols=0)  # every step reads X
    assert np.allclose(wide.singular_values, s[:k], rtol=1e-9)
    # when the blocks span all columns the result is exact
    full = SV.truncated_svd(x, "rid", n, m, m - 1)
    assert np.allclose(full.singular_values, s[: m - 1], rtol=1e-9)
    ids = spark.createDataFrame([(i,) for i in range(n)], "rid bigint")
    emb = SV.embeddings(x, "rid", ids, fit)
    from_pass = fit.explained_variance.copy()
    norm_pass = fit.projected_norm2
    fit = SV.with_explained_variance(fit, emb)
    assert np.allclose(from_pass, fit.explained_variance, rtol=1e-9, atol=1e-12)
    assert norm_pass == pytest.approx(fit.projected_norm2, rel=1e-9)
    u = np.array([[r[f"svd_{j + 1}"] for j in range(k)] for r in emb.orderBy("rid").collect()])
    assert np.allclose(np.abs(u), np.abs(dense @ fit.components.T), atol=1e-9)
    exp_var = u.var(axis=0)
    assert np.allclose(fit.explained_variance_ratio, exp_var / dense.var(axis=0).sum(), rtol=1e-9)
    err = ((dense - u @ fit.components) ** 2).sum() / n
    assert SV.reconstruction_error_per_row(fit) == pytest.approx(err, rel=1e-6, abs=1e-10)


@pytest.mark.parametrize("density", [0.02, 0.6])
def test_gram_blocks_match_numpy(spark, density):
    rng = np.random.default_rng(3)
    n, m = 700, 300
    values = rng.normal(size=(n, m)) * (rng.random((n, m)) < density)
    rows = [(int(i), int(j), float(values[i, j])) for i, j in zip(*np.nonzero(values))]
    x = SV.prepare(spark.createDataFrame(rows, "rid bigint, col_idx int, value double"), "rid")
    gram = GR.blocks(x, "rid", m)
    assert np.allclose(GR.dense(gram, m), values.T @ values, atol=1e-9)
    z = rng.normal(size=(m, 7))
    assert np.allclose(GR.times(gram, z), values.T @ (values @ z), atol=1e-8)
    empty = SV.prepare(spark.createDataFrame([], "rid bigint, col_idx int, value double"), "rid")
    assert not GR.times(GR.blocks(empty, "rid", 3), np.ones((3, 2))).any()


def test_outer_products_of_many_batches_at_once():
    import pandas as pd
    rng = np.random.default_rng(3)
    for density in (0.02, 0.6):  # column by column, and by dense products
        values = rng.random((60, 300)) * (rng.random((60, 300)) < density)
        rid, col = np.nonzero(values)
        shuffled = rng.permutation(len(rid))
        shuffled = shuffled[np.argsort(rid[shuffled], kind="stable")]  # rows together, their columns in any order
        table = pd.DataFrame({"rid": rid[shuffled], "col_idx": col[shuffled], "value": values[rid, col][shuffled]})
        batches = (table[lo:lo + 50] for lo in range(0, len(table), 50))
        stretches = list(GR._stretches(GR.whole_rows(batches, "rid")))
        assert len(stretches) == 1
        acc = np.zeros((300, 300))
        for s in stretches:
            GR._add_outer(*s, acc)
        assert np.allclose(np.triu(acc), np.triu(values.T @ values))


def test_embeddings_meet_their_items_without_a_sort(spark):
    cells = [(r, c, float(r + 2 * c + 1)) for r in range(40) for c in range(6) if (r + c) % 3]
    x = SV.prepare(spark.createDataFrame(cells, "rid bigint, col_idx int, value double"), "rid")
    ids = spark.createDataFrame([(r,) for r in [*range(40), 7, 90]], "rid bigint")  # an item twice, one without cells
    fit = SV.truncated_svd(x, "rid", 41, 6, 3)
    found = SV.embeddings(x, "rid", ids, fit)
    assert "Sort [" not in found._jdf.queryExecution().executedPlan().toString()
    dense = np.zeros((91, 6))
    for r, c, v in cells:
        dense[r, c] = v
    rows = sorted(map(tuple, found.collect()))
    assert [r[0] for r in rows] == sorted([*range(40), 7, 90])
    assert np.allclose([r[1:] for r in rows], [(dense @ fit.components.T)[r[0]] for r in rows])


def test_terms_are_counted_where_the_words_are(spark):
    from itemscope.plans import queries as Q
    t = Tables(spark, SF001)
    plan = TX.term_counts(Q._text_parts(t), "movieId", "text")._jdf.queryExecution().executedPlan().toString()
    counted = plan[:plan.index("Union")]
    assert counted.count("HashAggregate") == 2 and "Exchange" not in counted  # words stay in their item's partition
