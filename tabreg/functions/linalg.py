"""Solvers on sufficient statistics (a collected Gram matrix), run on the driver.

Inputs are p x p matrices from one distributed pass (``operators.matrix.gram``); nothing
here sees data rows. Covers least squares, ridge, elastic net / lasso by coordinate descent
with covariance updates (the penalised least-squares objective
``1/(2n) ||y - b0 - X b||^2 + lambda (alpha ||b||_1 + (1 - alpha)/2 ||b||^2)`` on standardised
X, coefficients reported on the original scale), stepwise AIC search, and the fold metrics
RMSE / R^2 of a linear predictor on another Gram block.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class LinearFit:
    features: list[str]
    intercept: float
    coef: np.ndarray

    def as_dict(self) -> dict[str, float]:
        return {"(Intercept)": self.intercept, **dict(zip(self.features, map(float, self.coef)))}


def _stats(g, feats: Sequence[str], label: str):
    return g.n, g.means(feats), g.means([label])[0], g.centred(feats), g.centred(feats, [label])[:, 0]


def ols(g, feats: Sequence[str], label: str) -> LinearFit:
    """Least squares; the system is solved on scaled columns, so that columns of very different
    size (a fifth power beside an indicator) keep their part."""
    n, mx, my, sxx, sxy = _stats(g, feats, label)
    sd = np.sqrt(np.clip(np.diag(sxx), 0.0, None))
    sd[sd == 0] = 1.0
    b = np.linalg.lstsq(sxx / np.outer(sd, sd), sxy / sd, rcond=None)[0] / sd if len(feats) else np.zeros(0)
    return LinearFit(list(feats), float(my - mx @ b), b)


def _on_block(g, fit: LinearFit, label: str) -> tuple[float, float, float, float]:
    """Squared errors, and the centred sums of prediction x label, prediction, label."""
    n, mx, my, sxx, sxy = _stats(g, fit.features, label)
    gap = fit.intercept + float(mx @ fit.coef) - my
    vp, cov, vy = float(fit.coef @ sxx @ fit.coef), float(fit.coef @ sxy), float(g.centred([label])[0, 0])
    return n * gap * gap + vp - 2 * cov + vy, cov, vp, vy


def rss(g, fit: LinearFit, label: str) -> float:
    """Residual sum of squares of ``fit`` on the rows summarised by ``g``."""
    return _on_block(g, fit, label)[0]


def metrics_on(g, fit: LinearFit, label: str) -> dict[str, float]:
    """RMSE and squared correlation of predictions vs label on the rows of ``g``."""
    sse, cov, vp, vy = _on_block(g, fit, label)
    r2 = cov * cov / (vp * vy) if vp > 0 and vy > 0 else float("nan")
    return {"n": g.n, "rmse": float(np.sqrt(max(sse, 0) / g.n)) if g.n else float("nan"), "rsquared": float(r2)}


def elastic_net(g, feats: Sequence[str], label: str, lam: float, alpha: float,
                standardize: bool = True, tol: float = 1e-10, max_iter: int = 10000,
                warm: "LinearFit | None" = None) -> LinearFit:
    """Coordinate descent with covariance updates on the Gram statistics; ``warm`` (a fit
    at a nearby lambda) starts the descent from its coefficients. Every tenth round the system of
    the columns in use is solved with their signs held: if the signs and the bounds of the others
    agree, that is the solution (correlated columns make plain rounds slow). Without a penalty the
    least-squares solution of the smallest length is returned."""
    n, mx, my, sxx, sxy = _stats(g, feats, label)
    p = len(feats)
    if p == 0:
        return LinearFit([], float(my), np.zeros(0))
    sd = np.sqrt(np.clip(np.diag(sxx) / n, 1e-300, None)) if standardize else np.ones(p)
    c = sxx / n / np.outer(sd, sd)          # covariance of standardised x
    r = sxy / n / sd                        # covariance of standardised x with y
    b = np.zeros(p) if warm is None else np.asarray(warm.coef, dtype=float) * sd
    l1, l2 = lam * alpha, lam * (1 - alpha)
    if lam == 0:
        coef = np.linalg.lstsq(c, r, rcond=1e-12)[0] / sd
        return LinearFit(list(feats), float(my - mx @ coef), coef)
    for round_ in range(max_iter):
        if round_ % 10 == 9 and (exact := _signed_solution(c, r, b, l1, l2)) is not None:
            b = exact
            break
        dmax = 0.0
        for j in range(p):
            if c[j, j] <= 1e-300:
                continue
            grad = r[j] - c[j] @ b + c[j, j] * b[j]
            nb = np.sign(grad) * max(abs(grad) - l1, 0.0) / (c[j, j] + l2)
            d = nb - b[j]
            if d != 0.0:
                b[j] = nb
                dmax = max(dmax, abs(d) * np.sqrt(c[j, j]))
        if dmax < tol:
            break
    else:
        warnings.warn(f"coordinate descent stopped after {max_iter} rounds (last step {dmax:.3g})", RuntimeWarning)
    coef = b / sd
    return LinearFit(list(feats), float(my - mx @ coef), coef)


def _signed_solution(c: np.ndarray, r: np.ndarray, b: np.ndarray, l1: float, l2: float) -> np.ndarray | None:
    """The elastic-net solution if it has the non-zero places and signs of ``b``, else None."""
    used = np.flatnonzero(b)
    if not len(used):
        return None
    sign = np.sign(b[used])
    system, target = c[np.ix_(used, used)] + l2 * np.eye(len(used)), r[used] - l1 * sign
    x = np.linalg.lstsq(system, target, rcond=1e-12)[0]
    if (np.sign(x) != sign).any() or np.abs(system @ x - target).max() > 1e-10 * max(np.abs(target).max(), 1e-300):
        return None
    out = np.zeros_like(b)
    out[used] = x
    slack = np.abs(r - c @ out)
    slack[used] = 0.0
    return out if (slack <= l1 * (1 + 1e-9) + 1e-14).all() else None


def ridge(g, feats: Sequence[str], label: str, lam: float, standardize: bool = True) -> LinearFit:
    """Closed form of the alpha = 0 objective: (C + lam I) b = r on standardised x."""
    n, mx, my, sxx, sxy = _stats(g, feats, label)
    p = len(feats)
    sd = np.sqrt(np.clip(np.diag(sxx) / n, 1e-300, None)) if standardize else np.ones(p)
    c = sxx / n / np.outer(sd, sd)
    r = sxy / n / sd
    b = np.linalg.lstsq(c + lam * np.eye(p), r, rcond=None)[0]
    coef = b / sd
    return LinearFit(list(feats), float(my - mx @ coef), coef)


def aic(g, feats: Sequence[str], label: str) -> tuple[float, LinearFit]:
    fit = ols(g, feats, label)
    n = g.n
    k = len(feats) + 1
    return float(n * np.log(max(rss(g, fit, label), 1e-300) / n) + 2 * k), fit


def stepwise_aic(g, feats: Sequence[str], label: str, direction: str = "both",
                 max_steps: int = 1000) -> tuple[list[str], list[dict]]:
    """Stepwise search by AIC = n ln(RSS/n) + 2k starting from the full model; each step
    takes the single drop (or add, for ``both``) that lowers AIC most. Returns the chosen
    features and the trace."""
    cur = list(feats)
    best, _ = aic(g, cur, label)
    trace = [{"step": 0, "action": "start", "variable": None, "aic": best}]
    for step in range(1, max_steps + 1):
        cands = [("drop", v, [c for c in cur if c != v]) for v in cur]
        if direction == "both":
            cands += [("add", v, cur + [v]) for v in feats if v not in cur]
        scored = [(aic(g, s, label)[0], a, v, s) for a, v, s in cands]
        if not scored:
            break
        val, a, v, s = min(scored, key=lambda t: t[0])
        if val >= best - 1e-9:
            break
        best, cur = val, [c for c in feats if c in s]
        trace.append({"step": step, "action": a, "variable": v, "aic": best})
    return cur, trace


def gcv(rss_value: float, n: float, n_terms: int, penalty: float = 2.0) -> float:
    """Generalised cross-validation of an additive hinge model with ``n_terms`` terms
    (intercept included): RSS / n / (1 - C/n)^2 with C = n_terms + penalty (n_terms - 1)/2."""
    c = n_terms + penalty * (n_terms - 1) / 2
    return float(rss_value / n / (1 - c / n) ** 2) if c < n else float("inf")


def forward_pairs(g, pairs: Sequence[Sequence[str]], label: str, max_terms: int, tol: float = 1e-9) -> list[tuple[str, ...]]:
    """Forward search over groups of one or two columns: in every step the group that lowers the
    residual sum of squares most joins, up to ``max_terms`` terms with the intercept or until a step
    gains less than ``tol`` of the start. The centred cross products are kept as residuals on the
    chosen columns (one rank-1 update a column), so a step costs a few operations a candidate."""
    names = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(names)}
    cross = g.centred([*names, label]).astype(float).copy()
    start = np.clip(np.diag(cross), 0.0, None)
    least = 1e-9 * start + 1e-300             # below: a combination of the chosen columns
    y = len(names)
    left = {i: tuple(at[c] for c in p) for i, p in enumerate(pairs)}
    chosen: list[tuple[str, ...]] = []
    terms = 1
    while left:
        open_ = [i for i, p in left.items() if terms + len(p) <= max_terms]
        if not open_:
            break
        a = np.array([left[i][0] for i in open_])
        b = np.array([left[i][-1] for i in open_])
        caa, cbb, cab, cay, cby = cross[a, a], cross[b, b], cross[a, b], cross[a, y], cross[b, y]
        ok_a, ok_b = caa > least[a], (cbb > least[b]) & (a != b)
        gain_a = np.where(ok_a, cay ** 2 / np.where(ok_a, caa, 1.0), 0.0)
        gain_b = np.where(ok_b, cby ** 2 / np.where(ok_b, cbb, 1.0), 0.0)
        det = caa * cbb - cab ** 2
        both = ok_a & ok_b & (det > 1e-9 * caa * cbb)
        gain = np.where(both, (cay ** 2 * cbb - 2 * cay * cby * cab + cby ** 2 * caa) / np.where(both, det, 1.0),
                        np.maximum(gain_a, gain_b))
        best = int(gain.argmax())
        if not gain[best] > tol * start[y]:
            break
        group = left.pop(open_[best])
        taken = []
        for c in group:
            if cross[c, c] > least[c]:
                cross = cross - np.outer(cross[:, c], cross[c]) / cross[c, c]
                taken.append(names[c])
        chosen.append(tuple(taken))
        terms += len(taken)
    return chosen


def backward_path(g, names: Sequence[str], label: str) -> list[tuple[float, list[str]]]:
    """``(residual sum of squares, columns)`` from all of ``names`` to none: every step drops the
    column whose loss raises the sum least (b_j^2 over the diagonal of the inverse)."""
    cur = list(names)
    total = float(g.centred([label])[0, 0])
    if not cur:
        return [(total, [])]
    c, r = g.centred(cur), g.centred(cur, [label])[:, 0]
    sd = np.sqrt(np.clip(np.diag(c), 1e-300, None))
    inv = np.linalg.pinv(c / np.outer(sd, sd), rcond=1e-13, hermitian=True)
    b = inv @ (r / sd)
    left = max(total - float(b @ (r / sd)), 0.0)
    out = [(left, list(cur))]
    while cur:
        rise = b ** 2 / np.clip(np.diag(inv), 1e-300, None)
        j = int(rise.argmin())
        left += float(rise[j])
        b = np.delete(b - inv[:, j] * (b[j] / inv[j, j]), j)
        inv = inv - np.outer(inv[:, j], inv[j]) / inv[j, j]
        inv = np.delete(np.delete(inv, j, axis=0), j, axis=1)
        cur.pop(j)
        out.append((left, list(cur)))
    return out


def pruned(path: Sequence[tuple[float, list[str]]], n: float, most: int | None = None, penalty: float = 2.0) -> list[str]:
    """The columns of the path's smallest generalised cross-validation among those of at most
    ``most`` terms, intercept included."""
    sized = [p for p in path if most is None or len(p[1]) + 1 <= most]
    return min(sized, key=lambda p: (gcv(p[0], n, len(p[1]) + 1, penalty), len(p[1])))[1]
