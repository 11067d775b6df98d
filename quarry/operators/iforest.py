"""Isolation Forest (Liu, Ting & Zhou, ICDM 2008) as Spark jobs.

1. Sample.  Every tree needs psi = min(max_samples, N) rows.  A pool of the
   m = min(N, n_trees * psi) rows with the smallest ``xxhash64(id, seed)`` is
   taken by a hash threshold (functions.sampling): the pool never exceeds
   n_trees * psi rows, whatever N is, and a large one is cut without any task
   merging it.  Every tree draws the psi pool rows with the smallest hashes of
   (id, tree).  Only the pool is replicated, never the input.
2. Train.  ``groupBy("tree").applyInPandas``: one task per tree, rows sorted
   by id (arrival order is not deterministic), RNG seeded by (seed, tree);
   random non-constant feature, uniform cut in (min, max), height limit
   ceil(log2 psi).  One output row per node.
3. Score.  The node table is bounded by n_trees * (2*psi - 1) rows, so it is
   collected once and shipped with an Arrow scalar pandas UDF that walks all
   trees vectorised; only the feature columns cross into Python.
   isolation_score = -2^(-E[h(x)] / c(psi)); lower is more anomalous.
4. Threshold.  Exact percentile of the scores at ``contamination``; strictly
   below it -> -1 (Anomaly), else 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from quarry import schemas as S
from quarry.session import materialize
from quarry.functions.quantile import exact_percentile
from quarry.functions.sampling import MERGED_ROWS, smallest_by_hash

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left_child int, right_child int, "
               "size int, depth int")
EULER_GAMMA = 0.5772156649015329


def average_path_length(n):
    """c(n): mean path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def sample_for_trees(features: DataFrame, feature_cols=S.FEATURE_COLS, id_col: str = "id",
                     n_trees: int = S.N_TREES, max_samples: int = S.MAX_SAMPLES, seed: int = S.SEED,
                     n_rows: int | None = None, oversample: float = 4.0,
                     verify: bool = True, merged_rows: int = MERGED_ROWS) -> tuple[DataFrame, int]:
    """``(tree, id, features...)`` training rows, and psi."""
    n = features.count() if n_rows is None else n_rows
    if n == 0:
        raise ValueError("cannot train an isolation forest on zero rows")
    psi = min(max_samples, n)
    m = min(n, n_trees * psi)
    cols = [F.col(id_col).alias("id")] + [F.col(c).cast("double").alias(c) for c in feature_cols]
    pool = smallest_by_hash(features.select(*cols), m, seed, "id", n_rows=n, keep_hash="_h",
                            oversample=oversample, verify=verify, merged_rows=merged_rows)
    # each tree takes the psi pool rows with the smallest (id, tree) hashes: an
    # independent sample without replacement.  A hash threshold leaves about
    # oversample * psi candidates per tree before the ranking within the tree.
    keep = min(1.0, oversample * psi / m)
    key = lambda t: F.xxhash64(F.col("id"), t, F.lit(seed))
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    if keep < 1.0:
        trees = F.filter(trees, lambda t: key(t) < F.lit(int(-(2 ** 63) + keep * 2 ** 64)))
    drawn = pool.select(F.explode(trees).alias("tree"), "id", *feature_cols).withColumn("_k", key(F.col("tree")))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("_k", "id", *feature_cols))
    return drawn.withColumn("_r", rank).where(F.col("_r") <= psi).drop("_k", "_r"), psi


def _fit_tree_fn(feature_cols, psi: int, seed: int):
    height_limit = int(math.ceil(math.log2(max(psi, 2))))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", *feature_cols], kind="mergesort")  # repeated ids: by value
        tree = int(pdf["tree"].iloc[0])
        x = np.nan_to_num(pdf[list(feature_cols)].to_numpy(dtype=np.float64), nan=0.0, posinf=1e300, neginf=-1e300)
        rng = np.random.default_rng(np.random.SeedSequence([seed, tree]))
        rows = []
        stack = [(np.arange(len(x)), 0, 0)]  # (row indices, node id, depth)
        next_id = 1
        while stack:
            idx, node, depth = stack.pop()
            part = x[idx]
            if depth >= height_limit or len(idx) <= 1:
                rows.append((tree, node, -1, np.nan, -1, -1, len(idx), depth))
                continue
            lo, hi = part.min(axis=0), part.max(axis=0)
            varying = np.flatnonzero(hi > lo)
            if varying.size == 0:
                rows.append((tree, node, -1, np.nan, -1, -1, len(idx), depth))
                continue
            f = int(varying[rng.integers(varying.size)])
            thr = float(rng.uniform(lo[f], hi[f]))
            go_left = part[:, f] <= thr
            left, right = next_id, next_id + 1
            next_id += 2
            rows.append((tree, node, f, thr, left, right, len(idx), depth))
            stack.append((idx[~go_left], right, depth + 1))
            stack.append((idx[go_left], left, depth + 1))
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left_child",
                                           "right_child", "size", "depth"])

    return fit


@dataclass
class IsolationForestModel:
    nodes: DataFrame
    psi: int
    n_trees: int
    feature_cols: tuple
    seed: int
    node_table: pd.DataFrame | None = None   # collected nodes, once trained eagerly

    def collect_nodes(self) -> pd.DataFrame:
        """The node table on the driver (bounded by n_trees * (2 psi - 1) rows)."""
        if self.node_table is None:
            bound = self.n_trees * (2 * self.psi - 1)
            # bounded by construction: every split sends >= 1 row each way, so a
            # tree on psi rows has <= psi leaves and <= 2 psi - 1 nodes
            pdf = self.nodes.toPandas()
            if len(pdf) > bound:
                raise RuntimeError(f"forest has {len(pdf)} nodes, above its bound {bound}")
            self.node_table = pdf
        return self.node_table

    def node_arrays(self) -> dict:
        """Flat arrays of all trees for vectorised scoring."""
        pdf = self.collect_nodes().sort_values(["tree", "node"]).reset_index(drop=True)
        base = np.zeros(self.n_trees, dtype=np.int64)
        counts = pdf.groupby("tree").size().reindex(range(self.n_trees), fill_value=0).to_numpy()
        base[1:] = np.cumsum(counts)[:-1]
        tree = pdf["tree"].to_numpy()
        g = lambda col: np.where(pdf[col].to_numpy() >= 0, pdf[col].to_numpy() + base[tree], -1)
        leaf_val = pdf["depth"].to_numpy(np.float64) + average_path_length(pdf["size"].to_numpy())
        feat = pdf["feature"].to_numpy(np.int64)
        leaf = feat < 0
        own = np.arange(len(pdf), dtype=np.int64)
        left = np.where(leaf, own, g("left_child"))
        right = np.where(leaf, own, g("right_child"))
        return {
            "roots": base.astype(np.int32),
            # leaves loop to themselves with an infinite threshold, so the walk
            # needs no per-level masks
            "feature": np.where(leaf, 0, feat).astype(np.int32),
            "threshold": np.where(leaf, np.inf, pdf["threshold"].to_numpy(np.float64)),
            "children": np.stack([left, right], axis=1).ravel().astype(np.int32),
            "leaf_value": leaf_val,
            "max_depth": int(pdf["depth"].max()) if len(pdf) else 0,
            "c_psi": float(average_path_length([self.psi])[0]),
        }

    def score_column(self, arrays: dict | None = None):
        """A pandas UDF ``(features...) -> isolation_score``: each tree walked
        level by level over the whole batch with flat gathers only."""
        a = arrays or self.node_arrays()
        roots, feat, thr, children = a["roots"], a["feature"], a["threshold"], a["children"]
        leaf_val, max_depth, c_psi = a["leaf_value"], a["max_depth"], a["c_psi"]
        n_feat = len(self.feature_cols)

        @pandas_udf("double")
        def isolation_score(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in cols]).ravel()
            n = len(x) // n_feat
            base = np.arange(n, dtype=np.int64) * n_feat
            paths = np.empty((n, len(roots)))
            for t, root in enumerate(roots):  # one tree at a time: the arrays stay in cache
                node = np.full(n, root, dtype=np.int32)
                for _ in range(max_depth):
                    go_right = ~(x[base + feat[node]] <= thr[node])  # NaN goes right
                    node = children[2 * node + go_right]
                paths[:, t] = leaf_val[node]
            depth = paths.mean(axis=1)
            return pd.Series(-np.power(2.0, -depth / c_psi) if c_psi > 0 else -np.ones(n))

        return isolation_score

    def score(self, features: DataFrame, out_col: str = "isolation_score") -> DataFrame:
        udf = self.score_column()
        return features.withColumn(out_col, udf(*[F.col(c).cast("double") for c in self.feature_cols]))


def _train_partitions(df: DataFrame, n_trees: int) -> int:
    return max(1, min(n_trees, df.sparkSession.sparkContext.defaultParallelism))


def train_isolation_forest(features: DataFrame, feature_cols=S.FEATURE_COLS, id_col: str = "id",
                           n_trees: int = S.N_TREES, max_samples: int = S.MAX_SAMPLES,
                           seed: int = S.SEED, n_rows: int | None = None,
                           merged_rows: int = MERGED_ROWS) -> IsolationForestModel:
    """Train and collect the (bounded) node table.  The sample pool is not
    counted separately: each tree's root size is in the node table, so a pool
    the hash filter left short (practically impossible) is detected there and
    the training repeats without the filter."""
    for oversample in (4.0, float("inf")):
        train, psi = sample_for_trees(features, feature_cols, id_col, n_trees, max_samples, seed, n_rows,
                                      oversample=oversample, verify=False, merged_rows=merged_rows)
        fit = _fit_tree_fn(tuple(feature_cols), psi, seed)
        # the training rows are few (<= n_trees * psi), so adaptive execution
        # would coalesce them into one task and fit every tree serially; an
        # explicit partition count keeps one tree (or a few) per task
        nodes = (train.repartition(_train_partitions(features, n_trees), "tree")
                 .groupBy("tree").applyInPandas(fit, NODE_SCHEMA))
        model = IsolationForestModel(nodes, psi, n_trees, tuple(feature_cols), seed)
        roots = model.collect_nodes().query("node == 0")
        if len(roots) == n_trees and bool((roots["size"] == psi).all()):
            return model
    raise RuntimeError("isolation forest sample is short even without the hash filter")


def threshold_for(scored: DataFrame, contamination: float = S.CONTAMINATION,
                  col: str = "isolation_score", n_rows: int | None = None) -> float:
    return exact_percentile(scored, col, contamination, max_rows=n_rows)


def label_by_threshold(scored: DataFrame, threshold: float, col: str = "isolation_score") -> DataFrame:
    pred = F.when(F.col(col) < F.lit(threshold), F.lit(-1)).otherwise(F.lit(1))
    return scored.withColumn("anomaly_score", pred).withColumn(
        "anomaly_label", F.when(F.col("anomaly_score") == -1, F.lit(S.LABEL_ANOMALY)).otherwise(F.lit(S.LABEL_NORMAL)))


def fit_predict(features: DataFrame, contamination: float = S.CONTAMINATION, n_trees: int = S.N_TREES,
                max_samples: int = S.MAX_SAMPLES, seed: int = S.SEED, feature_cols=S.FEATURE_COLS,
                id_col: str = "id", checkpoint: bool = True,
                n_rows: int | None = None) -> tuple[DataFrame, IsolationForestModel, float]:
    """Train, score every row, threshold, label.  With ``checkpoint`` the
    scored rows are written once as a parquet table in the shared checkpoint
    folder (lineage cut, survives executor loss); the threshold pass then
    reads only the score column and the labelling pass reads the table."""
    model = train_isolation_forest(features, feature_cols, id_col, n_trees, max_samples, seed, n_rows)
    scored = model.score(features)
    if checkpoint:
        scored = materialize(scored, "scored")
    thr = threshold_for(scored, contamination, n_rows=n_rows)
    return label_by_threshold(scored, thr), model, thr
