"""Truncated SVD of a sparse long-form matrix.

The matrix X is given as rows (row_id, col_idx, value) with ``n_cols`` columns
(a TF-IDF vocabulary: at most ``max_features``). The solver is block Lanczos on
X'X: the first block is random, every further one is X'X times the last,
made orthogonal to all blocks so far, and Rayleigh-Ritz over all blocks gives the
singular triplets. It stops when the residuals of the k kept pairs are below
``tol`` (the values' own error is quadratic in it), or when the blocks span
the whole column space, so the answer does not hang on a number of iterations.

The long-form matrix is hash-partitioned by row, sorted by row and checkpointed
once. One distributed pass over it builds X'X in blocks (``operators.gram``); every step
then multiplies the stored blocks, n_cols^2 numbers whatever the number of rows, and sends n_cols x l back.

Z (n_cols x l) travels as a broadcast bounded by n_cols * l; only n_cols x l
matrices reach the driver. The n x k embeddings are one more pass over X and stay
distributed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemscope.operators import gram as GR

EMBEDDED_ROWS = 1024  # rows of embeddings handed to Spark at once
GRAM_COLS = 8192  # up to so many columns X'X is stored once and X is read no more


@dataclass
class SVDFit:
    n_rows: int
    n_cols: int
    k: int
    singular_values: np.ndarray      # k, descending
    components: np.ndarray           # k x n_cols (right singular vectors)
    frob2: float                     # |X|_F^2
    col_var_total: float             # sum of the population variances of the columns
    explained_variance: np.ndarray = field(default_factory=lambda: np.zeros(0))
    projected_norm2: float | None = None  # |X V_k|_F^2, set from the embeddings
    gram: DataFrame | None = field(default=None, repr=False)  # the stored X'X

    @property
    def explained_variance_ratio(self) -> np.ndarray:
        return self.explained_variance / self.col_var_total if self.col_var_total > 0 else np.zeros(self.k)


def _gram_times(x: DataFrame, row_id: str, z: np.ndarray) -> np.ndarray:
    """One pass over X: X'(X z), for vocabularies too wide for a stored Gram matrix. A task
    emits the touched blocks of its n_cols x l sum; they are added as streams."""
    n_cols, l = z.shape
    side = -(-n_cols // GR.BLOCK) * GR.BLOCK
    zb = x.sparkSession.sparkContext.broadcast(z)

    def partial(batches):
        acc = np.zeros((side, l))
        for rows in GR.whole_rows(batches, row_id):
            rows.add_transpose_times(rows.times(zb.value), acc)
        group = GR.task_group()
        touched = ((group, i // GR.BLOCK, acc[i:i + GR.BLOCK]) for i in range(0, side, GR.BLOCK) if acc[i:i + GR.BLOCK].any())
        for b in GR.batches_of(touched, ["grp", "bi", "data"]):
            yield b.to_pandas()

    parts = GR.slots(x).mapInPandas(partial, "grp int, bi int, data binary")
    out = np.zeros((side, l))
    for r in GR.tree(parts, ["bi"], x).collect():
        out[r["bi"] * GR.BLOCK:(r["bi"] + 1) * GR.BLOCK] = np.frombuffer(r["data"]).reshape(GR.BLOCK, l)
    zb.unpersist()
    return out[:n_cols]


def prepare(x: DataFrame, row_id: str) -> DataFrame:
    """Partition the long-form matrix by row, sort by row and cut its lineage
    (reliable checkpoint), so every pass streams whole rows without recomputing them."""
    from itemscope.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(x.sparkSession)
    return x.repartition(row_id).sortWithinPartitions(row_id).checkpoint(eager=True)


def _outside(block: np.ndarray, basis: np.ndarray, size: float, rtol: float = 1e-10) -> np.ndarray:
    """Orthonormal directions of ``block`` outside the span of ``basis``; what is
    left of a direction below ``rtol`` times ``size`` counts as nothing."""
    for _ in range(2):  # once more against rounding
        block = block - basis @ (basis.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > rtol * max(size, 1e-300)]
    u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def truncated_svd(x: DataFrame, row_id: str, n_rows: int, n_cols: int, k: int, tol: float = 1e-4,
                  oversamples: int = 10, seed: int = 42, gram_cols: int = GRAM_COLS) -> SVDFit:
    """Top-k singular values/vectors of X (n_rows x n_cols). ``x`` must come
    from ``prepare`` (rows co-located); ``n_rows`` counts all-zero rows too.

    ``tol`` bounds the residual |X'Xv - s^2 v| / s^2 of every kept pair whose s^2
    is above rounding. Up to ``gram_cols`` columns every step reads the stored X'X; beyond it, X."""
    k = max(1, min(k, n_cols))
    l = min(k + oversamples, n_cols)
    gram = GR.blocks(x, row_id, n_cols) if n_cols <= gram_cols else None
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_cols, l)))[0]
    images, small, block, steps = np.zeros((n_cols, 0)), np.zeros((0, 0)), basis, 0
    while True:
        new = GR.times(gram, block) if gram is not None else _gram_times(x, row_id, block)
        images = np.hstack([images, new])
        steps += 1
        side = basis.T @ new            # the new columns of basis' X'X basis, which is symmetric
        small = np.block([[small, side[:len(small)]], [side[:len(small)].T, side[len(small):]]])
        top = float(np.linalg.norm(new, 2)) if steps == 1 else top
        spans = basis.shape[1] >= n_cols
        block = basis[:, :0] if spans else _outside(new, basis, top)
        if steps % 2 and steps > 1 and block.shape[1]:
            grow = True                 # the check costs more than a step: every other time
        else:
            theta, s = np.linalg.eigh((small + small.T) / 2)
            theta, s = theta[::-1][:k], s[:, ::-1][:, :k]
            ritz = basis @ s
            residual = np.linalg.norm(images @ s - ritz * theta, axis=0)
            largest = max(float(theta[0]), 0.0) if len(theta) else 0.0
            # no block is left where the blocks span everything X'X reaches
            grow = bool(block.shape[1]) and not (residual <= tol * np.maximum(theta, 1e-9 * largest)).all()
        if not grow:
            break
        block = block[:, :n_cols - basis.shape[1]]
        basis = np.hstack([basis, block])
    vt = ritz.T.copy()
    for j in range(len(vt)):  # sign rule: largest-magnitude loading positive
        if vt[j, int(np.argmax(np.abs(vt[j])))] < 0:
            vt[j] = -vt[j]
    # column sums and squares of X (n_cols rows, bounded by the vocabulary)
    col = {r["col_idx"]: (r["s1"], r["s2"]) for r in
           x.groupBy("col_idx").agg(F.sum("value").alias("s1"), F.sum(F.col("value") ** 2).alias("s2")).collect()}
    s1 = np.zeros(n_cols)
    s2 = np.zeros(n_cols)
    for c, (a, b) in col.items():
        s1[c], s2[c] = a, b
    nr = float(max(n_rows, 1))
    # the sum of squares of embedding column j is v_j'X'Xv_j, its mean (column sums of X) . v_j / n
    sq = np.maximum(theta, 0.0)
    means = (s1 @ vt.T) / nr
    fit = SVDFit(n_rows, n_cols, len(vt), np.sqrt(sq), vt, float(s2.sum()), float((s2 / nr - (s1 / nr) ** 2).sum()))
    fit.explained_variance = sq / nr - means ** 2
    fit.gram = gram
    fit.projected_norm2 = float(sq.sum())
    return fit


def embeddings(x: DataFrame, row_id: str, all_rows: DataFrame, fit: SVDFit, prefix: str = "svd_") -> DataFrame:
    """U*Sigma = X V_k for every row of ``all_rows`` (all-zero rows get zeros)."""
    vb = x.sparkSession.sparkContext.broadcast(fit.components.T.copy())
    names = [f"{prefix}{j + 1}" for j in range(fit.k)]
    id_type = dict(x.dtypes)[row_id]

    def project(batches):
        held, count = [], 0

        def together():
            whole = np.concatenate([y for _, y in held])
            ids = pa.concat_arrays([pa.array(i) for i, _ in held])
            return pa.RecordBatch.from_arrays([ids, *(pa.array(np.ascontiguousarray(c)) for c in whole.T)], names=[row_id, *names])

        for rows in GR.whole_rows((b.to_pandas() for b in batches), row_id):
            held.append((rows.ids, rows.times(vb.value)))
            count += len(rows.ids)
            if count >= EMBEDDED_ROWS:
                yield together()
                held, count = [], 0
        if held:
            yield together()

    schema = f"`{row_id}` {id_type}, " + ", ".join(f"`{n}` double" for n in names)
    y = x.mapInArrow(project, schema)
    # the ids are hashed, so that the wide rows need not be sorted to meet them
    full = all_rows.select(row_id).hint("shuffle_hash").join(y, row_id, "left")
    return full.select(row_id, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names])


def with_explained_variance(fit: SVDFit, emb: DataFrame, prefix: str = "svd_") -> SVDFit:
    """Population variance of every embedding column (one aggregate)."""
    cols = [F.col(f"{prefix}{j + 1}") for j in range(fit.k)]
    sq = sum((c * c for c in cols), F.lit(0.0))
    row = emb.agg(*[F.var_pop(c).alias(f"v{j}") for j, c in enumerate(cols)], F.sum(sq).alias("ss")).first()
    fit.explained_variance = np.array([row[f"v{j}"] or 0.0 for j in range(fit.k)])
    fit.projected_norm2 = float(row["ss"] or 0.0)
    return fit


def reconstruction_error_per_row(fit: SVDFit) -> float:
    """Squared error per row of the reconstruction X V_k V_k', closed form
    (|X|_F^2 - |X V_k|_F^2) / n; before the embeddings exist, sum sigma_k^2
    stands in for |X V_k|_F^2 (equal for exact singular vectors)."""
    kept = fit.projected_norm2 if fit.projected_norm2 is not None else float((fit.singular_values ** 2).sum())
    return max(fit.frob2 - kept, 0.0) / max(fit.n_rows, 1)
