"""Numpy kernel for trailing-frame statistics inside one Arrow batch / group.

For each query (sender, t): count, sum, avg and sample stddev of the amounts of
the same sender with t - span <= ts <= t (RANGE semantics: ties count). Many
senders are handled at once on a composite (sender code, time) key.

Two evaluation paths, same results up to floating-point association:
* small total frame size: every frame is gathered and reduced (two-pass
  variance, the most accurate form);
* otherwise: an array segment tree of (count, sum, mean, M2) merged with Chan's
  formula, O(log n) per frame, so a dense sender costs O(n log n), not O(n * w).
"""

from __future__ import annotations

import numpy as np
import pandas as pd

GATHER_LIMIT = 2_000_000  # total frame rows up to which frames are gathered exactly


def _merge(na, ma, m2a, sa, nb, mb, m2b, sb):
    n = na + nb
    safe = np.maximum(n, 1)
    delta = mb - ma
    mean = np.where(na == 0, mb, np.where(nb == 0, ma, ma + delta * (nb / safe)))
    m2 = np.where(na == 0, m2b, np.where(nb == 0, m2a, m2a + m2b + delta * delta * (na * nb / safe)))
    return n, mean, m2, sa + sb


def _tree_stats(vals: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    n_leaves = 1 << max(0, int(len(vals) - 1).bit_length())
    size = 2 * n_leaves
    cnt = np.zeros(size, dtype=np.float64)
    mean = np.zeros(size)
    m2 = np.zeros(size)
    sm = np.zeros(size)
    cnt[n_leaves:n_leaves + len(vals)] = 1.0
    mean[n_leaves:n_leaves + len(vals)] = vals
    sm[n_leaves:n_leaves + len(vals)] = vals
    level = n_leaves
    while level > 1:  # build bottom-up, one vectorized merge per level
        parents = np.arange(level // 2, level)
        left, right = 2 * parents, 2 * parents + 1
        cnt[parents], mean[parents], m2[parents], sm[parents] = _merge(
            cnt[left], mean[left], m2[left], sm[left], cnt[right], mean[right], m2[right], sm[right])
        level //= 2
    q = len(lo)
    acc = [np.zeros(q), np.zeros(q), np.zeros(q), np.zeros(q)]
    left_i, right_i = lo + n_leaves, hi + n_leaves
    while True:
        active = left_i < right_i
        if not active.any():
            break
        take = active & (left_i & 1).astype(bool)
        idx = np.where(take, left_i, 0)
        merged = _merge(*acc, cnt[idx] * take, mean[idx], m2[idx] * take, sm[idx] * take)
        acc = [np.where(take, m, a) for m, a in zip(merged, acc)]
        left_i = left_i + take
        take = (left_i < right_i) & (right_i & 1).astype(bool)
        right_i = right_i - take
        idx = np.where(take, right_i, 0)
        merged = _merge(*acc, cnt[idx] * take, mean[idx], m2[idx] * take, sm[idx] * take)
        acc = [np.where(take, m, a) for m, a in zip(merged, acc)]
        left_i, right_i = left_i >> 1, right_i >> 1
    n, _, m2_q, s = acc
    return s, m2_q, n


def frame_stats(snd: np.ndarray, ts: np.ndarray, amt: np.ndarray, q_snd: np.ndarray, q_ts: np.ndarray,
                span: int, gather_limit: int = GATHER_LIMIT):
    """Returns (count int64, sum, avg, stddev) arrays aligned with the queries; avg
    and stddev are NaN where undefined (NaN becomes null on the way to Arrow)."""
    q = len(q_ts)
    if q == 0:
        e = np.zeros(0)
        return np.zeros(0, dtype=np.int64), e, e, e
    codes, uniques = pd.factorize(np.concatenate([snd, q_snd]))
    c_all, c_q = codes[:len(snd)].astype(np.int64), codes[len(snd):].astype(np.int64)
    base = int(min(ts.min(), q_ts.min())) - span
    width = int(max(ts.max(), q_ts.max())) - base + 1  # a frame never reaches a neighbour sender
    if len(uniques) * width >= 2 ** 62:
        raise OverflowError("too many senders in one group for the composite key")
    key = c_all * width + (ts - base)
    order = np.argsort(key, kind="stable")
    key, vals = key[order], amt[order]
    q_key = c_q * width + (q_ts - base)
    lo = np.searchsorted(key, q_key - span, side="left")
    hi = np.searchsorted(key, q_key, side="right")
    cnt = hi - lo
    total = int(cnt.sum())
    if total == 0:
        nan = np.full(q, np.nan)
        return cnt, np.zeros(q), nan, nan
    if total <= gather_limit:
        starts = np.concatenate([[0], np.cumsum(cnt)[:-1]])
        idx = np.repeat(lo - starts, cnt) + np.arange(total)
        frame_vals = vals[idx]
        safe_starts = np.minimum(starts, total - 1)
        sums = np.where(cnt > 0, np.add.reduceat(frame_vals, safe_starts), 0.0)
        mean = np.where(cnt > 0, sums / np.maximum(cnt, 1), np.nan)
        dev2 = (frame_vals - np.repeat(mean, cnt)) ** 2
        ss = np.where(cnt > 0, np.add.reduceat(dev2, safe_starts), 0.0)
    else:
        sums, ss, _ = _tree_stats(vals, lo, hi)
        mean = np.where(cnt > 0, sums / np.maximum(cnt, 1), np.nan)
    std = np.where(cnt > 1, np.sqrt(np.maximum(ss, 0.0) / np.maximum(cnt - 1, 1)), np.nan)
    return cnt, sums, mean, std
