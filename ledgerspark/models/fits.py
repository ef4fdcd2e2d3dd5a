"""Per-series numeric fits used inside grouped maps (M1, M3, M4, M5, M6).

Each function takes one series' training values (already resampled, split and,
where the model needs it, windowed and scaled by Spark) and returns the
``h`` predictions. They are deterministic: the neural fits are seeded from
``seed``. None of them touches Spark; the grouped map in ``models.runner``
calls them once per series.

Fit specifications are ours (the reference calls external libraries with
"""

from __future__ import annotations

import numpy as np

# Least training length per model (shorter series get an error row).
MIN_TRAIN = {"Prophet": 2, "Holt-Winters": 24, "SARIMA": 27, "ARIMA": 11, "MLPRegressor": 13, "LSTM": 13}


# ---- M4: ARIMA(5,1,0), conditional least squares, no constant ----------------------------------

def arima_510(y: np.ndarray, h: int, p: int = 5) -> np.ndarray:
    z = np.diff(y)
    if len(z) <= p:
        raise ValueError("series too short for ARIMA(5,1,0)")
    X = np.column_stack([z[p - i - 1:len(z) - i - 1] for i in range(p)])  # lag 1..p
    coef, _res, rank, _sv = np.linalg.lstsq(X, z[p:], rcond=None)
    if rank < p:
        raise ValueError("singular ARIMA system")
    hist = list(z[-p:])
    level, out = y[-1], []
    for _ in range(h):
        nz = float(np.dot(coef, hist[::-1][:p]))
        hist.append(nz)
        level += nz
        out.append(level)
    return np.asarray(out)


# ---- M3: SARIMA(1,1,1)(1,1,1,12), conditional sum of squares -----------------------------------

def _sarima_resid(params, w, s):
    phi, theta, sphi, stheta = params
    n = len(w)
    e = np.zeros(n)
    for t in range(n):
        def W(k):
            return w[t - k] if t - k >= 0 else 0.0

        def E(k):
            return e[t - k] if t - k >= 0 else 0.0
        ar = phi * W(1) + sphi * W(s) - phi * sphi * W(s + 1)
        ma = theta * E(1) + stheta * E(s) + theta * stheta * E(s + 1)
        e[t] = w[t] - ar - ma
    return e


def sarima_111_111(y: np.ndarray, h: int, s: int = 12, iters: int = 50) -> np.ndarray:
    if len(y) < s + 1 + 14:
        raise ValueError("series too short for SARIMA(1,1,1)(1,1,1,12)")
    w = y[s + 1:] - y[s:-1] - y[1:-s] + y[:-s - 1]  # (1-B)(1-B^s) y
    params = np.zeros(4)
    lam = 1e-2
    cost = float(np.sum(_sarima_resid(params, w, s) ** 2))
    for _ in range(iters):  # Levenberg-Marquardt on the conditional sum of squares
        e = _sarima_resid(params, w, s)
        J = np.empty((len(w), 4))
        for j in range(4):
            d = np.zeros(4)
            d[j] = 1e-6
            J[:, j] = (_sarima_resid(params + d, w, s) - e) / 1e-6
        A = J.T @ J
        g = J.T @ e
        step = np.linalg.solve(A + lam * np.diag(np.diag(A) + 1e-12), -g)
        cand = params + step  # neither stationarity nor invertibility is enforced
        c_cost = float(np.sum(_sarima_resid(cand, w, s) ** 2))
        if c_cost < cost:
            params, cost, lam = cand, c_cost, lam / 3
            if np.max(np.abs(step)) < 1e-8:
                break
        else:
            lam *= 5
    phi, theta, sphi, stheta = params
    e = list(_sarima_resid(params, w, s))
    wl = list(w)
    yl = list(y)
    for _ in range(h):
        t = len(wl)
        W = lambda k: wl[t - k] if t - k >= 0 else 0.0
        E = lambda k: e[t - k] if t - k >= 0 else 0.0
        nxt = (phi * W(1) + sphi * W(s) - phi * sphi * W(s + 1)
               + theta * E(1) + stheta * E(s) + theta * stheta * E(s + 1))
        wl.append(nxt)
        e.append(0.0)
        yl.append(nxt + yl[-1] + yl[-s] - yl[-s - 1])
    return np.asarray(yl[len(y):])


# ---- M1: additive trend with changepoints + Fourier seasonality ---------------------------------

def _fourier(t_days: np.ndarray, period: float, order: int) -> np.ndarray:
    cols = []
    for k in range(1, order + 1):
        ang = 2 * np.pi * k * t_days / period
        cols += [np.sin(ang), np.cos(ang)]
    return np.column_stack(cols) if cols else np.empty((len(t_days), 0))


def prophet_like(y: np.ndarray, ds: np.ndarray, future: np.ndarray, n_changepoints: int = 25,
                 cp_range: float = 0.8, cp_scale: float = 0.05, iters: int = 20) -> np.ndarray:
    day = np.timedelta64(1, "D")
    t_days = (ds - ds[0]) / day
    f_days = (future - ds[0]) / day
    span = float(t_days[-1]) if len(t_days) > 1 and t_days[-1] > 0 else 1.0
    step_days = float(np.median(np.diff(t_days))) if len(t_days) > 1 else 1.0
    t, tf = t_days / span, f_days / span
    scale = float(np.max(np.abs(y))) or 1.0
    ys = y / scale
    n_hist = max(int(np.floor(len(y) * cp_range)), 1)
    n_cp = min(n_changepoints, max(n_hist - 1, 0))
    cps = t[np.linspace(0, n_hist - 1, n_cp + 2).round().astype(int)[1:-1]] if n_cp else np.empty(0)

    def design(tt, tdays):
        parts = [np.ones_like(tt), tt] + [np.maximum(tt - c, 0.0) for c in cps]
        X = np.column_stack(parts)
        if span >= 730:
            X = np.column_stack([X, _fourier(tdays, 365.25, 10)])
        if step_days <= 1 and span >= 14:
            X = np.column_stack([X, _fourier(tdays, 7.0, 3)])
        return X

    X, Xf = design(t, t_days), design(tf, f_days)
    k = X.shape[1]
    cp_idx = np.arange(2, 2 + len(cps))
    base_pen = np.full(k, 1.0 / 100.0)       # seasonality prior scale 10 -> 1/10^2
    base_pen[:2] = 1e-8                        # trend intercept and slope: flat prior
    beta = np.linalg.lstsq(X, ys, rcond=None)[0]
    sigma2 = max(float(np.mean((ys - X @ beta) ** 2)), 1e-6)
    for _ in range(iters):  # iteratively reweighted ridge ~ Laplace(0, cp_scale) on slope changes
        pen = base_pen.copy()
        pen[cp_idx] = sigma2 / (cp_scale * (np.abs(beta[cp_idx]) + 1e-4))
        beta = np.linalg.solve(X.T @ X + np.diag(pen) * len(ys) / max(len(ys), 1), X.T @ ys)
    return (Xf @ beta) * scale


# ---- M5: one-hidden-layer ReLU network, full-batch Adam ----------------------------------------

def _adam():
    return {"m": None, "v": None, "t": 0}


def _adam_step(params, grads, state, lr=1e-3, b1=0.9, b2=0.999, eps=1e-8):
    if state["m"] is None:
        state["m"] = [np.zeros_like(p) for p in params]
        state["v"] = [np.zeros_like(p) for p in params]
    state["t"] += 1
    t = state["t"]
    for p, g, m, v in zip(params, grads, state["m"], state["v"]):
        m *= b1
        m += (1 - b1) * g
        v *= b2
        v += (1 - b2) * g * g
        p -= lr * (m / (1 - b1 ** t)) / (np.sqrt(v / (1 - b2 ** t)) + eps)


def mlp_fit_predict(X: np.ndarray, y: np.ndarray, seed_window: np.ndarray, h: int, seed: int,
                    hidden: int = 100, iters: int = 1000, alpha: float = 1e-4) -> np.ndarray:
    rng = np.random.default_rng(seed)
    n, w = X.shape
    b1 = np.sqrt(6.0 / (w + hidden))
    b2 = np.sqrt(6.0 / (hidden + 1))
    W1, c1 = rng.uniform(-b1, b1, (w, hidden)), rng.uniform(-b1, b1, hidden)
    W2, c2 = rng.uniform(-b2, b2, (hidden, 1)), rng.uniform(-b2, b2, 1)
    params, state = [W1, c1, W2, c2], _adam()
    yy = y.reshape(-1, 1)
    for _ in range(iters):
        a = X @ W1 + c1
        hdn = np.maximum(a, 0)
        out = hdn @ W2 + c2
        d = (out - yy) / n
        gW2 = hdn.T @ d + alpha * W2 / n
        gc2 = d.sum(0)
        dh = (d @ W2.T) * (a > 0)
        gW1 = X.T @ dh + alpha * W1 / n
        gc1 = dh.sum(0)
        _adam_step(params, [gW1, gc1, gW2, gc2], state)
    win = list(seed_window)
    preds = []
    for _ in range(h):
        x = np.asarray(win[-w:]).reshape(1, -1)
        p = float((np.maximum(x @ W1 + c1, 0) @ W2 + c2)[0, 0])
        preds.append(p)
        win.append(p)
    return np.asarray(preds)


# ---- M6: LSTM(50, relu) + Dense(1), mini-batch Adam, back-propagation through time -------------

def _sig(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def _lstm_forward(Xb, Wx, Wh, b, H):
    B, T = Xb.shape
    xz = Xb[:, :, None] * Wx[0] + b          # input projection of every step at once: (B, T, 4H)
    h = np.zeros((B, H))
    c = np.zeros((B, H))
    cache = []
    for t in range(T):
        z = xz[:, t] + h @ Wh
        i, f, o = _sig(z[:, :H]), _sig(z[:, H:2 * H]), _sig(z[:, 3 * H:])
        g = np.maximum(z[:, 2 * H:3 * H], 0)
        c_new = f * c + i * g
        h_new = o * np.maximum(c_new, 0)
        cache.append((h, c, z, i, f, g, o, c_new))
        h, c = h_new, c_new
    return h, cache


def lstm_fit_predict(X: np.ndarray, y: np.ndarray, seed_window: np.ndarray, h: int, seed: int,
                     units: int = 50, epochs: int = 100, batch: int = 32) -> np.ndarray:
    rng = np.random.default_rng(seed)
    H = units
    lim_x = np.sqrt(6.0 / (1 + 4 * H))
    Wx = rng.uniform(-lim_x, lim_x, (1, 4 * H))
    q, _ = np.linalg.qr(rng.normal(size=(4 * H, H)))
    Wh = q.T.copy()                                  # orthogonal recurrent kernel (H x 4H)
    b = np.zeros(4 * H)
    b[H:2 * H] = 1.0                                 # unit forget bias
    lim_d = np.sqrt(6.0 / (H + 1))
    Wd, bd = rng.uniform(-lim_d, lim_d, (H, 1)), np.zeros(1)
    params, state = [Wx, Wh, b, Wd, bd], _adam()
    n = len(y)
    for _ in range(epochs):
        order = rng.permutation(n)
        for s in range(0, n, batch):
            idx = order[s:s + batch]
            Xb, yb = X[idx], y[idx].reshape(-1, 1)
            hT, cache = _lstm_forward(Xb, Wx, Wh, b, H)
            out = hT @ Wd + bd
            d = 2 * (out - yb) / len(idx)
            gWd, gbd = hT.T @ d, d.sum(0)
            dh = d @ Wd.T
            dc = np.zeros_like(dh)
            T = Xb.shape[1]
            dzs = np.empty((len(idx), T, 4 * H))
            hs = np.empty((len(idx), T, H))
            for t in range(T - 1, -1, -1):
                h_prev, c_prev, z, i, f, g, o, c_new = cache[t]
                dct = dc + dh * o * (c_new > 0)
                dz = np.concatenate([dct * g * i * (1 - i), dct * c_prev * f * (1 - f),
                                     dct * i * (z[:, 2 * H:3 * H] > 0), dh * np.maximum(c_new, 0) * o * (1 - o)],
                                    axis=1)
                dzs[:, t] = dz
                hs[:, t] = h_prev
                dh = dz @ Wh.T
                dc = dct * f
            gWx = np.einsum("bt,btk->k", Xb, dzs)[None, :]
            gWh = np.einsum("bth,btk->hk", hs, dzs)
            gb = dzs.sum(axis=(0, 1))
            _adam_step(params, [gWx, gWh, gb, gWd, gbd], state)
    win = list(seed_window)
    T = X.shape[1]
    preds = []
    for _ in range(h):
        hT, _c = _lstm_forward(np.asarray(win[-T:]).reshape(1, -1), Wx, Wh, b, H)
        p = float((hT @ Wd + bd)[0, 0])
        preds.append(p)
        win.append(p)
    return np.asarray(preds)
