"""PCA on a wide numeric DataFrame (M2-M9, M13-M15, M17, A13, A14, WN1, WN2, O3, O4).

Plan at scale (n rows, p features, p small - tens to a few hundred):
  1. the input matrix is checkpointed once to the reliable checkpoint folder,
     so its lineage (joins, aggregates over the raw tables) runs one time;
  2. one aggregate gives the column means and population std (A13);
  3. one pass builds per-partition partial Gram matrices of the standardised
     columns with numpy (Arrow batches), emitted as (i, j, value) rows and
     summed by a grouped aggregate - only p*p numbers per partition move;
  4. the p x p matrix is eigen-decomposed on the driver (bounded by p);
  5. scores are plain column expressions over the checkpointed matrix.
Reconstruction errors come from the eigenvalues in closed form: for the
standardised matrix Z with eigenvalues l of Z'Z/n,
  mse(k) = sum_{i>k} l_i / p  and  rel_frobenius(k) = sqrt(sum_{i>k} l_i / sum l).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from itemscope.functions import scalars as X


@dataclass
class PCAFit:
    features: list[str]
    n: int
    means: np.ndarray
    stds: np.ndarray            # population std, 0 replaced by 1
    raw_stds: np.ndarray        # population std as measured
    eigenvalues: np.ndarray     # of Z'Z/n, descending, clipped at 0
    components: np.ndarray      # p x p, column j = loadings of component j+1
    gram: np.ndarray            # Z'Z/n (the correlation matrix for non-constant columns)
    matrix: DataFrame | None = field(default=None, repr=False)

    @property
    def p(self) -> int:
        return len(self.features)

    @property
    def ratio(self) -> np.ndarray:
        total = self.eigenvalues.sum()
        return self.eigenvalues / total if total > 0 else np.zeros_like(self.eigenvalues)

    @property
    def cumulative(self) -> np.ndarray:
        return np.cumsum(self.ratio)

    @property
    def explained_variance(self) -> np.ndarray:
        """Variance along each component with ddof 1 (S^2 / (n-1))."""
        return self.eigenvalues * self.n / max(self.n - 1, 1)

    def components_for(self, threshold: float, strict: bool = False) -> int:
        """Smallest k with cumulative >= threshold (``strict``: > threshold)."""
        side = "right" if strict else "left"
        return int(min(np.searchsorted(self.cumulative, threshold, side=side) + 1, self.p))

    def tail_variance(self, k: int) -> float:
        return float(self.eigenvalues[k:].sum())


# --- passes ---------------------------------------------------------------------

def column_moments(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Row count, means and population std of every column (one aggregate)."""
    aggs = [F.count(F.lit(1)).alias("__n__")]
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}"),
                 F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    n = int(row["__n__"])
    means = np.array([row[f"m{i}"] if row[f"m{i}"] is not None else 0.0 for i in range(len(cols))], dtype=float)
    stds = np.array([row[f"s{i}"] if row[f"s{i}"] is not None else 0.0 for i in range(len(cols))], dtype=float)
    stds = np.nan_to_num(stds, nan=0.0)
    return n, means, stds


def standardized_columns(cols: list[str], means: np.ndarray, stds: np.ndarray):
    """M2: (x - mean) / std (ddof 0, zero std -> 1) as column expressions."""
    return [((F.col(f"`{c}`").cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(c)
            for c, m, s in zip(cols, means, stds)]


def gram_matrix(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Sum over rows of x x' for the given double columns.

    Each task folds its Arrow batches into one p x p partial with numpy and
    emits it as (i, j, value) rows of the upper triangle; a grouped sum adds
    the partials. Nothing but p*(p+1)/2 numbers per partition is shuffled.
    """
    p = len(cols)
    iu = np.triu_indices(p)

    def partial(batches):
        acc = np.zeros((p, p))
        for pdf in batches:
            m = pdf.to_numpy(dtype=float, na_value=0.0)
            acc += m.T @ m
        yield pd.DataFrame({"i": iu[0].astype("int32"), "j": iu[1].astype("int32"), "v": acc[iu]})

    renamed = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    parts = renamed.mapInPandas(partial, "i int, j int, v double")
    sums = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    g = np.zeros((p, p))
    for row in sums:
        g[row["i"], row["j"]] = row["v"]
        g[row["j"], row["i"]] = row["v"]
    return g


def _fix_signs(vectors: np.ndarray) -> np.ndarray:
    """Make the largest-magnitude entry of every component positive
    (ties: first feature), so results do not depend on the solver's sign."""
    out = vectors.copy()
    for j in range(out.shape[1]):
        idx = int(np.argmax(np.abs(out[:, j])))
        if out[idx, j] < 0:
            out[:, j] = -out[:, j]
    return out


def fit_pca(df: DataFrame, cols: list[str], checkpoint: bool = True) -> PCAFit:
    """Full PCA of the standardised columns (all p components)."""
    if checkpoint:
        from itemscope.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
    mat = df.checkpoint(eager=True) if checkpoint else df
    n, means, raw_stds = column_moments(mat, cols)
    stds = np.where(raw_stds > 0, raw_stds, 1.0)
    z = mat.select(*standardized_columns(cols, means, stds))
    g = gram_matrix(z, cols) / max(n, 1)
    vals, vecs = np.linalg.eigh(g)
    order = np.argsort(vals)[::-1]
    vals = np.clip(vals[order], 0.0, None)
    vecs = _fix_signs(vecs[:, order])
    return PCAFit(list(cols), n, means, stds, raw_stds, vals, vecs, g, mat)


def column_index(names: DataFrame, key: str) -> DataFrame:
    """(key, col_idx): the distinct values of a dictionary table numbered from 0 in their order (a table of p rows)."""
    return names.select(key).filter(F.col(key).isNotNull()).distinct().select(key, (F.row_number().over(Window.orderBy(key)) - 1).cast("int").alias("col_idx"))


def fit_pca_long(cells: DataFrame, row_id: str, p: int, n: int, names: list[str] | None = None) -> PCAFit:
    """PCA of the standardised columns of a sparse matrix in long form (row_id, col_idx, value), p columns, n rows
    (empty ones included), absent cells 0. No wide frame is built: X'X comes from ``operators.gram``, and
    Z'Z/n = (X'X/n - m m') / (s s') from it and the column sums."""
    from itemscope.operators import gram as GR
    from itemscope.operators.svd import prepare
    x = prepare(cells.select(row_id, "col_idx", F.col("value").cast("double").alias("value")), row_id)
    sums = np.zeros(p)
    for r in x.groupBy("col_idx").agg(F.sum("value").alias("s")).collect():  # p rows at most
        sums[r["col_idx"]] = r["s"]
    rows = max(n, 1)
    second = GR.dense(GR.blocks(x, row_id, p), p) / rows
    means = sums / rows
    cov = second - np.outer(means, means)
    # what rounding leaves of a constant column counts as nothing
    raw = np.where(np.diag(cov) > 1e-14 * np.maximum(np.diag(second), 1e-300), np.diag(cov), 0.0)
    stds = np.where(raw > 0, np.sqrt(raw), 1.0)
    g = cov / np.outer(stds, stds)
    g[raw == 0, :] = 0.0
    g[:, raw == 0] = 0.0
    vals, vecs = np.linalg.eigh((g + g.T) / 2)
    order = np.argsort(vals)[::-1]
    return PCAFit(names or [str(i) for i in range(p)], n, means, stds, np.sqrt(raw), np.clip(vals[order], 0.0, None),
                  _fix_signs(vecs[:, order]), g)


# --- outputs ------------------------------------------------------------------------

def pca_scores(fit: PCAFit, keep: list[str], k: int, names: list[str] | None = None,
               pad_to: int = 0) -> DataFrame:
    """M6: ``keep`` columns plus pc1..pck (components beyond p are 0.0)."""
    names = names or [f"pc{j + 1}" for j in range(max(k, pad_to))]
    z = {c: (F.col(f"`{c}`").cast("double") - F.lit(float(m))) / F.lit(float(s))
         for c, m, s in zip(fit.features, fit.means, fit.stds)}
    cols = [F.col(c) for c in keep]
    for j, name in enumerate(names):
        if j < min(k, fit.p):
            expr = None
            for i, c in enumerate(fit.features):
                term = z[c] * F.lit(float(fit.components[i, j]))
                expr = term if expr is None else expr + term
            cols.append(expr.alias(name))
        else:
            cols.append(F.lit(0.0).alias(name))
    return fit.matrix.select(*cols)


def variance_table(spark: SparkSession, fit: PCAFit, k: int | None = None,
                   cumulative_name: str = "cumulative_explained_variance") -> DataFrame:
    """M4 + WN1: component, ratio, running sum (window over at most p rows)."""
    k = fit.p if k is None else k
    rows = [(j + 1, float(fit.ratio[j])) for j in range(k)]
    df = spark.createDataFrame(rows, "component int, explained_variance_ratio double")
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(cumulative_name, F.sum("explained_variance_ratio").over(w))


def thresholds_table(spark: SparkSession, fit: PCAFit, levels=(0.8, 0.9, 0.95)) -> DataFrame:
    """M5: components needed for each level (cumulative >= level) and for all."""
    cum = fit.cumulative
    rows = []
    for t in levels:
        k = fit.components_for(t)
        rows.append((f"{int(round(t * 100))}%", k, float(cum[k - 1])))
    rows.append(("all_features", fit.p, float(cum[-1]) if fit.p else 0.0))
    return spark.createDataFrame(rows, "threshold string, components_needed int, cumulative_variance double")


def pca_profile(spark: SparkSession, fit: PCAFit) -> DataFrame:
    """M7."""
    r = fit.ratio
    pc2 = float(r[1]) if fit.p > 1 else 0.0
    rows = [("movies", float(fit.n)), ("features", float(fit.p)), ("pc1_variance", float(r[0])),
            ("pc2_variance", pc2), ("pc1_pc2_variance", float(r[0]) + pc2)]
    return spark.createDataFrame(rows, "metric string, value double")


def reconstruction_candidates(fit: PCAFit) -> list[int]:
    p = fit.p
    ks = {2, 5, 10, 20, min(50, p), fit.components_for(0.8), fit.components_for(0.9), fit.components_for(0.95)}
    return sorted(k for k in ks if 1 <= k <= p)


def reconstruction_error(spark: SparkSession, fit: PCAFit, ks: list[int] | None = None) -> DataFrame:
    """M8 in closed form: retained variance, mse per cell, relative Frobenius error."""
    ks = reconstruction_candidates(fit) if ks is None else ks
    total = float(fit.eigenvalues.sum())
    rows = []
    for k in ks:
        tail = fit.tail_variance(k)
        rows.append((k, float(fit.cumulative[k - 1]), tail / fit.p,
                     float(np.sqrt(tail / total)) if total > 0 else 0.0))
    return spark.createDataFrame(rows, "components int, retained_variance double, mse double, "
                                       "relative_frobenius_error double")


def reconstruction_error_explicit(fit: PCAFit, k: int) -> tuple[float, float]:
    """M8 by a distributed pass (used to check the closed form):
    per row, |z - V_k V_k' z|^2 = |z|^2 - |V_k' z|^2."""
    scores = pca_scores(fit, [], k, names=[f"_s{j}" for j in range(k)])
    z = fit.matrix.select(*standardized_columns(fit.features, fit.means, fit.stds))
    zz = z.select(sum((F.col(f"`{c}`") * F.col(f"`{c}`") for c in fit.features), F.lit(0.0)).alias("zz")) \
        .agg(F.sum("zz")).first()[0]
    ss = scores.select(sum((F.col(f"_s{j}") * F.col(f"_s{j}") for j in range(k)), F.lit(0.0)).alias("ss")) \
        .agg(F.sum("ss")).first()[0]
    resid = max(zz - ss, 0.0)
    mse = resid / (fit.n * fit.p)
    rel = float(np.sqrt(resid / zz)) if zz > 0 else 0.0
    return mse, rel


def loadings_long(spark: SparkSession, fit: PCAFit, n_components: int = 2) -> DataFrame:
    """p x k loadings as (component, feature, loading); missing components are 0."""
    rows = []
    for j in range(n_components):
        for i, f in enumerate(fit.features):
            v = float(fit.components[i, j]) if j < fit.p else 0.0
            rows.append((f"pc{j + 1}", f, v))
    return spark.createDataFrame(rows, "component string, feature string, loading double")


def top_loadings(spark: SparkSession, fit: PCAFit, k: int = 12) -> DataFrame:
    """M13 + WN2 + O3: top-k features by |loading| within pc1 and pc2."""
    ld = loadings_long(spark, fit, 2).withColumn("abs_loading", F.abs("loading"))
    w = Window.partitionBy("component").orderBy(F.desc("abs_loading"), F.asc("feature"))
    return ld.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("component", "rank", "feature", "loading", "abs_loading")


def loading_magnitude(spark: SparkSession, fit: PCAFit, k: int = 5) -> DataFrame:
    """sqrt(l1^2 + l2^2) on pc1-pc2, top k (biplot data)."""
    ld = loadings_long(spark, fit, 2).groupBy("feature").pivot("component", ["pc1", "pc2"]).agg(F.first("loading"))
    ld = ld.withColumn("magnitude", F.sqrt(F.col("pc1") ** 2 + F.col("pc2") ** 2))
    w = Window.orderBy(F.desc("magnitude"), F.asc("feature"))
    return ld.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("rank", "feature", F.col("pc1").alias("pc1_loading"), F.col("pc2").alias("pc2_loading"), "magnitude")


# The feature pairs the redundancy check looks at.
REDUNDANCY_PAIRS = [
    ("tag_event_count_log", "unique_tag_count_log"),
    ("rating_count_log", "tag_event_count_log"),
    ("rating_count_log", "avg_rating_z"),
    ("genre_count_log", "rating_count_log"),
]
DIVERSITY_PAIR = ("genre_count_log", "unique_tag_count_log")


def feature_redundancy(spark: SparkSession, fit: PCAFit) -> DataFrame:
    """Pearson r of the unscaled features (one aggregate), angle of their
    pc1-pc2 loading vectors, label. Pairs with a missing feature are skipped."""
    idx = {f: i for i, f in enumerate(fit.features)}
    pairs = [(a, b, "redundancy") for a, b in REDUNDANCY_PAIRS if a in idx and b in idx]
    if DIVERSITY_PAIR[0] in idx and DIVERSITY_PAIR[1] in idx:
        pairs.append((*DIVERSITY_PAIR, "diversity"))
    schema = "feature_a string, feature_b string, check string, correlation double, angle_deg double, label string"
    if not pairs:
        return spark.createDataFrame([], schema)
    corr = fit.matrix.agg(*[F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias(f"r{n}")
                            for n, (a, b, _) in enumerate(pairs)]).first()
    load = np.zeros((fit.p, 2))
    load[:, :min(2, fit.p)] = fit.components[:, :min(2, fit.p)]
    rows = []
    for n, (a, b, kind) in enumerate(pairs):
        la, lb = load[idx[a]], load[idx[b]]
        dot = float(la @ lb)
        rows.append((a, b, kind, corr[f"r{n}"], dot, float(np.linalg.norm(la)), float(np.linalg.norm(lb))))
    df = spark.createDataFrame(rows, "feature_a string, feature_b string, check string, correlation double, "
                                     "dot double, na double, nb double")
    label = F.when(F.col("check") == "diversity",
                   F.when(F.abs("correlation") > 0.6, F.lit("potentially redundant")).otherwise(F.lit("diverse signals"))) \
        .otherwise(X.correlation_label(F.col("correlation")))
    return df.select("feature_a", "feature_b", "check", "correlation",
                     X.angle_degrees(F.col("dot"), F.col("na"), F.col("nb")).alias("angle_deg"),
                     label.alias("label"))


def correlation_long(spark: SparkSession, fit: PCAFit) -> DataFrame:
    """A14 for all feature pairs from the Gram of the standardised matrix:
    r_ij = (Z'Z/n)_ij; NULL where a feature is constant."""
    g = fit.gram
    rows = []
    for i, a in enumerate(fit.features):
        for j, b in enumerate(fit.features):
            ok = fit.raw_stds[i] > 0 and fit.raw_stds[j] > 0
            rows.append((a, b, float(g[i, j]) if ok else None))
    return spark.createDataFrame(rows, "feature_a string, feature_b string, correlation double")


def scatter_sample(scores: DataFrame, id_col: str, n: int = 10000, seed: int = 42) -> DataFrame:
    """Deterministic sample of min(n, rows) rows without replacement
    (top-n by a seeded hash; the limit is the feature)."""
    return scores.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), F.col(id_col)).limit(n)


def certificate(fit: PCAFit) -> list[tuple[str, float]]:
    """What must hold of the spectrum whoever computes it: its power sums are the traces of powers of the correlation
    matrix, and the residuals of eigenvectors are 0."""
    lam, v, g = fit.eigenvalues, fit.components, fit.gram
    return [("items", float(fit.n)), ("features", float(fit.p)), ("trace", float(lam.sum())), ("trace_of_square", float((lam ** 2).sum())),
            ("trace_of_cube", float((lam ** 3).sum())), ("eigen_residual", float(np.abs(g @ v - v * lam).max())),
            ("orthogonality_residual", float(np.abs(v.T @ v - np.eye(fit.p)).max()))]


def score_certificate(fit: PCAFit, k: int) -> list[tuple[str, float]]:
    """The scores' mean squares are the eigenvalues, and the closed error is that of an explicit distributed pass."""
    k = min(k, fit.p)
    scores = pca_scores(fit, [], k)
    row = scores.agg(*[F.avg(F.col(c) * F.col(c)).alias(c) for c in scores.columns]).first()
    mse, _ = reconstruction_error_explicit(fit, k)
    return [("score_residual", max(abs(row[f"pc{j + 1}"] - float(fit.eigenvalues[j])) for j in range(k))),
            ("reconstruction_residual", abs(mse - fit.tail_variance(k) / fit.p))]
