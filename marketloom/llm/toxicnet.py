"""A bidirectional gated recurrent network with attention pooling, trained and applied in numpy.

A word enters by three embeddings, all looked up by hash: of the word itself, the mean of those of
its byte trigrams, and the mean of those of its first 4 to 8 bytes; so unseen words are known by
their characters. Two gated recurrent units read a window in both directions, attention weighs their
states, and a logistic unit scores the window. All tables have a fixed size.
"""

from __future__ import annotations

import numpy as np

from marketloom.llm.hashing import Words, mix, words_of

WORD_ROWS, WORD_DIM = 1 << 15, 8
GRAM_ROWS, GRAM_DIM = 1 << 13, 8
START_ROWS, START_DIM, STARTS = 1 << 15, 8, (4, 5, 6, 7, 8)
DIM = WORD_DIM + GRAM_DIM + START_DIM
HIDDEN = 12
WINDOW, STEP = 32, 16
G = 3 * HIDDEN  # update, reset and candidate


class Vocabulary:
    """Distinct words of some texts with their table rows; the last id is padding."""

    def __init__(self, w: Words):
        _, where, self.ids = np.unique(w.hashes, return_index=True, return_inverse=True)
        self.word_rows = (w.hashes[where] % np.uint64(WORD_ROWS)).astype(np.int64)
        starts, ends = w.starts[where], w.ends[where]
        data = np.concatenate((np.zeros(1, np.uint8), w.data))  # a separator in front of the first word
        self.n_grams = (ends - starts).astype(np.int64)
        self.gram_first = np.concatenate(([0], np.cumsum(self.n_grams)))
        at = np.arange(self.gram_first[-1]) - np.repeat(self.gram_first[:-1], self.n_grams) + np.repeat(starts, self.n_grams)
        left, middle, right = (np.where(data[at + k] <= 32, 0, data[at + k]).astype(np.uint64) for k in range(3))
        self.grams = (mix((left << np.uint64(16)) | (middle << np.uint64(8)) | right) % np.uint64(GRAM_ROWS)).astype(np.int64)
        # One column per length; a shorter word has its whole self in the first.
        self.start_rows = np.empty((len(where), len(STARTS)), np.int64)
        length = ends - starts
        self.has_start = np.stack([length >= n if n > STARTS[0] else length > 0 for n in STARTS], axis=1)
        seen = np.zeros(len(where), np.uint64)
        for k in range(STARTS[-1]):
            byte = data[np.minimum(starts + 1 + k, len(data) - 1)].astype(np.uint64)
            seen = np.where(k < length, mix(seen * np.uint64(257) + byte + np.uint64(1)), seen)
            if k + 1 in STARTS:
                self.start_rows[:, STARTS.index(k + 1)] = seen % np.uint64(START_ROWS)

    def starts_mean(self, table: np.ndarray, used) -> np.ndarray:
        has = self.has_start[used]
        return (table[self.start_rows[used]] * has[:, :, None]).sum(1) / has.sum(1)[:, None]

    def __len__(self) -> int:
        return len(self.word_rows)


def windows(first: np.ndarray, ids: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows, WINDOW) word ids and the text of each window: all overlapping windows of all
    texts, the last one ending with the text; shorter texts are one padded window."""
    n = np.diff(first)
    per = np.where(n > WINDOW, -(-(n - WINDOW) // STEP) + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), per)
    k = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    start = np.minimum(k * STEP, np.maximum(n[text] - WINDOW, 0))
    out = np.full((len(text), WINDOW), pad, np.int32)
    for k in range(WINDOW):
        inside = start + k < n[text]
        out[inside, k] = ids[(first[text] + start + k)[inside]]
    return out, text


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values of equal rows, in a table of n rows."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(rows):
        order = np.argsort(rows, kind="stable")
        some, begin = np.unique(rows[order], return_index=True)
        out[some] = np.add.reduceat(values[order], begin)
    return out


def _sigmoid(x):
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class ToxicNet:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        d = DIM
        self.p = {
            "word": f(WORD_ROWS, WORD_DIM, scale=0.1), "gram": f(GRAM_ROWS, GRAM_DIM, scale=0.3),
            "start": f(START_ROWS, START_DIM, scale=0.2),
            "x": f(d, 2 * G, scale=d ** -0.5), "bias": np.zeros(2 * G, np.float32),
            "u0": f(HIDDEN, G, scale=HIDDEN ** -0.5), "u1": f(HIDDEN, G, scale=HIDDEN ** -0.5),
            "att": f(2 * HIDDEN, scale=0.3), "out": f(2 * HIDDEN, scale=0.3), "off": np.zeros(1, np.float32),
            "line": np.array([1, 0], np.float32),  # from a text's highest window to its logit
        }

    def inputs(self, v: Vocabulary) -> np.ndarray:
        """Embeddings of the distinct words, a zero row for padding last."""
        e = np.zeros((len(v) + 1, DIM), np.float32)
        if len(v):
            e[:-1, :WORD_DIM] = self.p["word"][v.word_rows]
            for lo in range(0, len(v), 20_000):
                hi = min(lo + 20_000, len(v))
                a, z = v.gram_first[lo], v.gram_first[hi]
                total = np.add.reduceat(self.p["gram"][v.grams[a:z]], v.gram_first[lo:hi] - a)
                e[lo:hi, WORD_DIM:WORD_DIM + GRAM_DIM] = total / v.n_grams[lo:hi, None]
                e[lo:hi, WORD_DIM + GRAM_DIM:] = v.starts_mean(self.p["start"], slice(lo, hi))
        return e

    def inputs_for(self, v: Vocabulary, used: np.ndarray, r: np.random.Generator, drop: float = 0.5) -> np.ndarray:
        """Embeddings as a mapping of word ids; some words are left to their characters."""
        used = used[used < len(v)]
        e = np.zeros((len(used) + 1, DIM), np.float32)
        e[:-1, :WORD_DIM] = self.p["word"][v.word_rows[used]] * (r.random(len(used)) >= drop)[:, None]
        n = v.n_grams[used]
        first = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(v.gram_first[used], n)
        if len(used):
            e[:-1, WORD_DIM:WORD_DIM + GRAM_DIM] = np.add.reduceat(self.p["gram"][v.grams[at]], first) / n[:, None]
            e[:-1, WORD_DIM + GRAM_DIM:] = v.starts_mean(self.p["start"], used)
        return e

    def _read(self, x: np.ndarray, u: np.ndarray, order, keep: list | None):
        """States (steps, windows, HIDDEN) of one direction; x is (steps, windows, G)."""
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        out = np.empty((x.shape[0], x.shape[1], HIDDEN), np.float32)
        for t in order:
            g = h @ u
            zr = _sigmoid(x[t, :, :2 * HIDDEN] + g[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            gn = g[:, 2 * HIDDEN:]
            n = np.tanh(x[t, :, 2 * HIDDEN:] + r * gn)
            if keep is not None:
                keep.append((t, h, z, r, n, gn))
            h = n + z * (h - n)
            out[t] = h
        return out

    def forward(self, table: np.ndarray, idx: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows; ``table`` has the gate inputs of each word id, (words + 1, 2 G)."""
        x = table[idx.T]  # steps first
        k0, k1 = ([], []) if keep is not None else (None, None)
        h = np.concatenate([self._read(x[:, :, :G], self.p["u0"], range(WINDOW), k0),
                            self._read(x[:, :, G:], self.p["u1"], range(WINDOW - 1, -1, -1), k1)], axis=2)
        e = h @ self.p["att"]
        e = np.where(idx.T == len(table) - 1, np.float32(-1e9), e)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        pooled = np.einsum("tb,tbh->bh", a, h)
        if keep is not None:
            keep.update(k0=k0, k1=k1, h=h, a=a, pooled=pooled)
        return pooled @ self.p["out"] + self.p["off"][0]

    def _unread(self, u: np.ndarray, kept: list, dh_all: np.ndarray):
        dx = np.empty((WINDOW, dh_all.shape[1], G), np.float32)
        du = np.zeros_like(u)
        dh = np.zeros(dh_all.shape[1:], np.float32)
        for t, h, z, r, n, gn in reversed(kept):
            dh = dh + dh_all[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            dx[t] = np.concatenate([dz, dr, dn], axis=1)
            dg = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ dg
            dh = dh * z + dg @ u.T
        return dx, du

    def gradients(self, v: Vocabulary, idx: np.ndarray, y: np.ndarray, embedded: np.ndarray) -> tuple[float, dict]:
        """Mean log loss of windows and its gradients; ``embedded`` has a row for each word id in
        ``idx`` in increasing order, then one for padding."""
        used, local = np.unique(idx, return_inverse=True)
        if used[-1] != len(v):
            used = np.append(used, len(v))
        local = local.reshape(idx.shape)
        e = embedded  # rows in the order of ``used``
        keep: dict = {}
        table = e @ self.p["x"] + self.p["bias"]
        logit = self.forward(table, local, keep)
        prob = _sigmoid(logit)
        loss = float(-np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7)))
        d = ((prob - y) / len(y)).astype(np.float32)
        g = {"off": np.array([d.sum()], np.float32), "out": keep["pooled"].T @ d}
        dpooled = d[:, None] * self.p["out"][None, :]
        h, a = keep["h"], keep["a"]
        da = np.einsum("tbh,bh->tb", h, dpooled)
        de = a * (da - (a * da).sum(0))
        dh = a[:, :, None] * dpooled[None] + de[:, :, None] * self.p["att"]
        g["att"] = np.einsum("tbh,tb->h", h, de)
        dx0, g["u0"] = self._unread(self.p["u0"], keep["k0"], dh[:, :, :HIDDEN])
        dx1, g["u1"] = self._unread(self.p["u1"], keep["k1"], dh[:, :, HIDDEN:])
        dx = np.concatenate([dx0, dx1], axis=2).reshape(-1, 2 * G)
        dt = _summed(local.T.reshape(-1), dx, len(table))
        g["bias"], g["x"] = dt.sum(0), e.T @ dt
        real = used < len(v)
        w, dw = used[real], (dt @ self.p["x"].T)[real]
        g["word"] = _summed(v.word_rows[w], dw[:, :WORD_DIM], WORD_ROWS)
        n = v.n_grams[w]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(v.gram_first[w], n)
        g["gram"] = _summed(v.grams[at], np.repeat(dw[:, WORD_DIM:WORD_DIM + GRAM_DIM] / n[:, None], n, axis=0), GRAM_ROWS)
        has = v.has_start[w]
        of, col = np.nonzero(has)
        g["start"] = _summed(v.start_rows[w][of, col], (dw[:, WORD_DIM + GRAM_DIM:] / has.sum(1)[:, None])[of], START_ROWS)
        return loss, g

    def prime(self, v: Vocabulary, first: np.ndarray, labels: np.ndarray, use: np.ndarray) -> None:
        """Starts the first dimension of each table with the smoothed log odds of a row in toxic
        against other texts, so that few texts are enough to find the words that matter."""
        share = max(float(labels[use].mean()), 1e-3)
        seen = {name: np.zeros((2, len(self.p[name]))) for name in ("word", "gram", "start")}
        for d in np.flatnonzero(use):  # text by text: no table of all words and texts
            word = np.unique(v.ids[first[d]:first[d + 1]])
            n = v.n_grams[word]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(v.gram_first[word], n)
            for name, rows in (("word", v.word_rows[word]), ("gram", v.grams[at]),
                               ("start", v.start_rows[word][v.has_start[word]])):
                seen[name][int(labels[d] > 0), np.unique(rows)] += 1
        for name, (no, yes) in seen.items():
            odds = np.log((yes + 4 * share) / (no + 4 * (1 - share))) - np.log(share / (1 - share))
            self.p[name][:, 0] = np.where(yes + no >= 3, odds, 0)

    def first_guess(self, v: Vocabulary, idx: np.ndarray) -> np.ndarray:
        """Before any step, windows are ranked by their three highest log odds."""
        odds = self.inputs(v)
        return np.sort(odds[idx, 0] + odds[idx, WORD_DIM] + odds[idx, WORD_DIM + GRAM_DIM], axis=1)[:, -3:].sum(1)

    def calibrate(self, best: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 40) -> None:
        """Fits the line from a text's highest window to the logit of its score, on texts that the
        network hasn't learned from; the ridge bounds the slope where all are told apart."""
        middle, scale = float(best.mean()), max(float(np.std(best)), 1e-3)
        x = np.stack([(best - middle) / scale, np.ones(len(best))])
        ab = np.zeros(2)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-(ab @ x)))
            slope = x @ (p - y) / len(y) + ridge * ab
            ab -= np.linalg.solve((x * (p * (1 - p))) @ x.T / len(y) + ridge * np.eye(2), slope)
        self.p["line"] = np.array([ab[0] / scale, ab[1] - ab[0] * middle / scale], np.float32)

    def text_scores(self, best: np.ndarray) -> np.ndarray:
        a, b = self.p["line"].astype(np.float64)
        return np.where(np.isfinite(best), 1 / (1 + np.exp(-np.clip(a * best + b, -60, 60))), 0.0)

    def window_logits(self, v: Vocabulary, idx: np.ndarray, batch: int = 1024) -> np.ndarray:
        table = self.inputs(v) @ self.p["x"] + self.p["bias"]
        parts = [self.forward(table, idx[i:i + batch]) for i in range(0, len(idx), batch)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def train(texts: list[str], labels: np.ndarray, seed: int = 7, rounds: int = 3, steps: int = 130, batch: int = 256) -> ToxicNet:
    """Fits the network to labelled texts. Only windows are scored, so each round picks windows to
    learn from: the two highest of each toxic text, and the three highest of each other text
    besides any others. Every fourth text is kept for the calibration of scores."""
    r = np.random.default_rng(seed)
    net = ToxicNet(seed)
    w = words_of(texts)
    v = Vocabulary(w)
    idx, text = windows(w.first, v.ids, len(v))
    if not len(idx) or len(set(labels)) < 2:
        net.p["off"][0] = -4.0
        net.p["out"][:] = 0
        return net
    kept = r.permutation(len(texts)) % 4 == 0
    every, every_text = idx, text
    idx, text = idx[~kept[text]], text[~kept[text]]
    net.prime(v, w.first, labels, ~kept)
    y = labels[text].astype(np.float32)
    m, s = ({k: np.zeros_like(x) for k, x in net.p.items()} for _ in range(2))
    done = 0
    for turn in range(rounds):
        logit = net.window_logits(v, idx) if turn else net.first_guess(v, idx)
        rank = np.empty(len(idx), np.int64)
        order = np.lexsort((-logit, text))
        rank[order] = np.arange(len(idx)) - np.searchsorted(text, text[order])
        positive = np.flatnonzero((y > 0) & (rank < 2))
        hard = np.flatnonzero((y == 0) & (rank < 3))
        other = np.flatnonzero((y == 0) & (rank >= 3))
        negative = [x for x in (hard, other) if len(x)]
        if not len(positive) or not negative:
            break
        for step in range(steps):
            done += 1
            share = batch // 2 // len(negative)
            pick = np.concatenate([r.choice(positive, batch // 2), *(r.choice(x, share) for x in negative)])
            embedded = net.inputs_for(v, np.unique(idx[pick]), r)
            _, g = net.gradients(v, idx[pick], y[pick], embedded)
            rate = 0.01 * (1 - step / steps) + 0.001
            for k, x in g.items():
                np.clip(x, -1, 1, out=x)
                m[k] += 0.1 * (x - m[k])
                s[k] += 0.01 * (x * x - s[k])
                net.p[k] -= (rate / (1 - 0.9 ** done) * m[k] / (np.sqrt(s[k] / (1 - 0.99 ** done)) + 1e-6)).astype(np.float32)
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, every_text, net.window_logits(v, every))
    judged = np.isfinite(best) & (kept if len(set(labels[kept & np.isfinite(best)])) > 1 else True)
    net.calibrate(best[judged].astype(np.float64), labels[judged])
    return net
