"""Recursive path-dependent tree Shapley values, row at a time: the plain form the vectorized kernel is tested against."""

import numpy as np


def _extend(path, zero, one, feat):
    """Add a split to the unique path and update the permutation weights."""
    d = len(path)
    path = [list(p) for p in path] + [[feat, zero, one, 1.0 if d == 0 else 0.0]]
    for i in range(d - 1, -1, -1):
        path[i + 1][3] += one * path[i][3] * (i + 1) / (d + 1)
        path[i][3] = zero * path[i][3] * (d - i) / (d + 1)
    return path


def _unwind(path, k):
    """Remove element k from the path, undoing its weight contribution."""
    d = len(path) - 1
    one, zero = path[k][2], path[k][1]
    path = [list(p) for p in path]
    nxt = path[d][3]
    for i in range(d - 1, -1, -1):
        if one != 0:
            tmp = path[i][3]
            path[i][3] = nxt * (d + 1) / ((i + 1) * one)
            nxt = tmp - path[i][3] * zero * (d - i) / (d + 1)
        else:
            path[i][3] = path[i][3] * (d + 1) / (zero * (d - i))
    for i in range(k, d):
        path[i][0], path[i][1], path[i][2] = path[i + 1][0], path[i + 1][1], path[i + 1][2]
    return path[:d]


def _unwound_sum(path, k):
    """Total permutation weight of the path with element k removed."""
    d = len(path) - 1
    one, zero = path[k][2], path[k][1]
    nxt, total = path[d][3], 0.0
    for i in range(d - 1, -1, -1):
        if one != 0:
            tmp = nxt * (d + 1) / ((i + 1) * one)
            total += tmp
            nxt = path[i][3] - tmp * zero * (d - i) / (d + 1)
        else:
            total += path[i][3] / (zero * (d - i) / (d + 1))
    return total


def tree_shap(x: np.ndarray, tree: dict, phi: np.ndarray) -> None:
    """Add one tree's path-dependent Shapley values for row x into phi
    (recursive reference form; `tree_shap_batch` is the vectorized one)."""
    left, right, feat, thr, val, cover = (tree[k] for k in ("left", "right", "feat", "thr", "val", "cover"))

    def rec(j, path, zero, one, fidx):
        path = _extend(path, zero, one, fidx)
        if left[j] < 0:
            for i in range(1, len(path)):
                w = _unwound_sum(path, i)
                phi[path[i][0]] += w * (path[i][2] - path[i][1]) * val[j]
            return
        f = feat[j]
        hot, cold = (left[j], right[j]) if x[f] <= thr[j] else (right[j], left[j])
        iz, io = 1.0, 1.0
        k = next((i for i in range(1, len(path)) if path[i][0] == f), None)
        if k is not None:
            iz, io = path[k][1], path[k][2]
            path = _unwind(path, k)
        rec(hot, path, iz * cover[hot] / cover[j], io, f)
        rec(cold, path, iz * cover[cold] / cover[j], 0.0, f)
    rec(0, [], 1.0, 1.0, -1)
