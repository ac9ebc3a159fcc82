"""Feature attribution for tree ensembles.

X1 computes path-dependent tree Shapley values (Lundberg, Erion & Lee,
"Consistent Individualized Feature Attribution for Tree Ensembles", 2018)
inside `mapInPandas`: the rows stay partitioned, the model (at most
rounds x 2^(depth+1) nodes) is shipped to every task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.contract import FEATURE_ORDER


def load_trees(spark: SparkSession, model_path: str) -> list[dict]:
    """Model nodes as per-tree arrays (bounded by the model size, not the data)."""
    from retailcast.operators.model import tree_table
    rows = tree_table(spark, model_path).orderBy("treeID", "id").collect()
    trees: dict[int, dict] = {}
    for r in rows:
        t = trees.setdefault(r["treeID"], {"weight": r["tree_weight"], "nodes": {}})
        t["nodes"][r["id"]] = (r["leftChild"], r["rightChild"], r["featureIndex"], r["threshold"],
                               r["prediction"], float(r["rawCount"]), r["missing_left"])
    out = []
    for tid in sorted(trees):
        nd = trees[tid]["nodes"]
        n = max(nd) + 1
        arr = {k: np.zeros(n) for k in ("thr", "val", "cover")}
        left, right, feat, miss = np.full(n, -1), np.full(n, -1), np.full(n, -1), np.zeros(n, bool)
        for i, (lc, rc, fi, th, pv, cv, ml) in nd.items():
            left[i], right[i], feat[i], miss[i] = lc, rc, fi if fi is not None else -1, bool(ml)
            arr["thr"][i] = th if th is not None else 0.0
            arr["val"][i], arr["cover"][i] = pv, cv
        out.append({"weight": trees[tid]["weight"], "left": left, "right": right, "feat": feat, "miss": miss, **arr})
    return out


def went_left(v: np.ndarray, threshold, missing_left) -> np.ndarray:
    """Whether values pass a split to the left; a missing value has the split's own side."""
    return np.where(np.isnan(v), missing_left, v <= threshold)


def leaf_paths(tree: dict) -> list[tuple[float, list[tuple[int, float, bool, float, bool]]]]:
    """Root-to-leaf paths: (leaf value, [(feature, cover ratio, went left, threshold, missing left), ...])."""
    left, right, feat, thr, val, cover, miss = (tree[k] for k in ("left", "right", "feat", "thr", "val", "cover", "miss"))
    out, stack = [], [(0, [])]
    while stack:
        j, path = stack.pop()
        if left[j] < 0:
            out.append((float(val[j]), path))
            continue
        for child, is_left in ((left[j], True), (right[j], False)):
            stack.append((child, path + [(int(feat[j]), cover[child] / cover[j], is_left, float(thr[j]), bool(miss[j]))]))
    return out


#: Most features of a path whose shares are tabulated.
TABLED = 8


def path_shares(zs: np.ndarray, os_: np.ndarray, value: float) -> list[np.ndarray]:
    """Contribution of each feature of a leaf's path, from its zero fractions ``zs`` and one fractions ``os_``
    (element by row; element 0 is the root's dummy)."""
    d, n = len(zs) - 1, os_.shape[1]                                         # path elements after the dummy: 1..d
    pw, out = np.zeros((d + 1, n)), []
    pw[0] = 1.0
    for u in range(1, d + 1):                                                # EXTEND with element u
        for i in range(u - 1, -1, -1):
            pw[i + 1] += os_[u] * pw[i] * (i + 1) / (u + 1)
            pw[i] = zs[u] * pw[i] * (u - i) / (u + 1)
    for k in range(1, d + 1):                                                # UNWOUND SUM of element k
        one, zero = os_[k], zs[k]
        nxt = pw[d].copy()
        total = np.zeros(n)
        safe_one = np.where(one != 0, one, 1.0)
        for i in range(d - 1, -1, -1):
            tmp = nxt * (d + 1) / ((i + 1) * safe_one)
            t_one = tmp
            t_zero = pw[i] / (zero * (d - i) / (d + 1))
            total += np.where(one != 0, t_one, t_zero)
            nxt = np.where(one != 0, pw[i] - tmp * zero * (d - i) / (d + 1), nxt)
        out.append(total * (one - zero) * value)
    return out


def leaf_shares(tree: dict) -> list[tuple[float, dict[int, list], np.ndarray, list[np.ndarray] | None]]:
    """Per leaf: value, conditions by feature, zero fractions, and each feature's contribution for every combination of
    conditions met (bit k: those of the k-th feature); kept with the tree, as it doesn't depend on rows."""
    if "shares" not in tree:
        out = []
        for value, path in leaf_paths(tree):
            feats: dict[int, list] = {}
            z: dict[int, float] = {}
            for f, ratio, is_left, t, missing_left in path:
                z[f] = z.get(f, 1.0) * ratio
                feats.setdefault(f, []).append((t, missing_left, is_left))
            d, zs = len(feats), np.array([1.0, *z.values()])
            met = np.vstack([np.ones(2**d), *((np.arange(2**d) >> k & 1).astype(np.float64) for k in range(d))]) if d <= TABLED else None
            out.append((value, feats, zs, None if met is None else path_shares(zs, met, value)))
        tree["shares"] = out
    return tree["shares"]


def tree_shap_batch(X: np.ndarray, tree: dict, phi: np.ndarray) -> None:
    """Vectorized path-dependent tree Shapley values for all rows of X.

    Leaf by leaf: the unique features of the path get a zero fraction (product
    of cover ratios along their splits) and a per-row one fraction (1 when the
    row satisfies all of that feature's conditions on the path). Extending the
    path polynomial is order-independent, so each leaf's contribution is the
    same as in the recursive algorithm. It depends on a row only by which features'
    conditions are met, so it is worked out once for each combination and looked up."""
    n, own = X.shape[0], np.zeros(phi.shape[::-1])
    went: dict[tuple, np.ndarray] = {}
    for value, feats, zs, shares in leaf_shares(tree):
        met = []
        for f, conditions in feats.items():
            every = None
            for t, missing_left, is_left in conditions:
                if (f, t, missing_left) not in went:
                    went[f, t, missing_left] = went_left(X[:, f], t, missing_left)
                this = went[f, t, missing_left] if is_left else ~went[f, t, missing_left]
                every = this if every is None else every & this
            met.append(every)
        if shares is None:
            by_row = path_shares(zs, np.vstack([np.ones(n), *(m.astype(np.float64) for m in met)]), value)
        else:
            which = np.zeros(n, np.uint8)
            for k, m in enumerate(met):
                which |= m.view(np.uint8) << np.uint8(k)
            by_row = [share.take(which) for share in shares]
        for f, share in zip(feats, by_row, strict=True):
            own[f] += share
    phi += own.T


def predict_batch(X: np.ndarray, tree: dict) -> np.ndarray:
    """Leaf values of all rows (left when x <= threshold)."""
    j = np.zeros(X.shape[0], dtype=np.int64)
    while True:
        inner = tree["left"][j] >= 0
        if not inner.any():
            return tree["val"][j]
        f = tree["feat"][j]
        go_left = went_left(X[np.arange(X.shape[0]), np.where(inner, f, 0)], tree["thr"][j], tree["miss"][j])
        j = np.where(inner, np.where(go_left, tree["left"][j], tree["right"][j]), j)


def expected_value(trees: list[dict]) -> float:
    """Cover-weighted mean output of the ensemble (the SHAP base value)."""
    total = 0.0
    for t in trees:
        leaves = t["left"] < 0
        leaves &= t["cover"] > 0
        total += t["weight"] * float(np.sum(t["val"][leaves] * t["cover"][leaves]) / t["cover"][0])
    return total


def shap_values(spark: SparkSession, df: DataFrame, model_path: str, features=FEATURE_ORDER,
                id_col: str = "record_id") -> DataFrame:
    """Per row, one Shapley value per feature plus base value and model
    output (base + Σ shap = output). Rows are processed where they live."""
    trees = load_trees(spark, model_path)
    base = expected_value(trees)
    feats = list(features)
    schema = f"{id_col} bigint, base_value double, model_output double, " + \
        ", ".join(f"shap_{c} double" for c in feats)

    def run(batches):
        for pdf in batches:
            X = pdf[feats].to_numpy(dtype=np.float64)
            phi = np.zeros((len(X), len(feats)))
            pred = np.zeros(len(X))
            for t in trees:
                part = np.zeros_like(phi)
                tree_shap_batch(X, t, part)
                phi += t["weight"] * part
                pred += t["weight"] * predict_batch(X, t)
            res = pd.DataFrame(phi, columns=[f"shap_{c}" for c in feats])
            res.insert(0, "model_output", pred)
            res.insert(0, "base_value", base)
            res.insert(0, id_col, pdf[id_col].astype("int64").to_numpy())
            yield res
    cols = [F.col(id_col).cast("bigint")] + [F.col(c).cast("double").alias(c) for c in feats]
    return df.select(*cols).mapInPandas(run, schema)


def shap_importance(shap: DataFrame, features=FEATURE_ORDER) -> DataFrame:
    """Mean |shap| per feature, largest first (unpivot + grouped mean)."""
    stack = ", ".join(f"'{c}', shap_{c}" for c in features)
    long = shap.selectExpr(f"stack({len(features)}, {stack}) as (feature, v)")
    return (long.groupBy("feature").agg(F.avg(F.abs("v")).alias("mean_abs_shap"))
            .orderBy(F.desc("mean_abs_shap"), "feature"))


def shap_topk(importance: DataFrame, k: int = 20) -> DataFrame:
    """The top min(k, n) features (TakeOrderedAndProject)."""
    return importance.orderBy(F.desc("mean_abs_shap"), "feature").limit(k)
