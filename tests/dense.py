"""A small dense model in NumPy, the independent answer for the tests."""

import numpy as np


def normalized(a):
    a = a + np.eye(len(a))
    d = a.sum(axis=1)
    s = np.where(d > 0, 1 / np.sqrt(np.where(d > 0, d, 1)), 0.0)
    return a * s[:, None] * s[None, :]


def whole(n, edges):
    a = np.zeros((n, n))
    for u, v, w in edges:
        a[u, v] += w
    return np.minimum(a + a.T, 1.0)


def blocks(n, edges, parts, local_input):
    base = whole(n, edges)
    if local_input == "normalized":
        base = normalized(base)
    pid = np.arange(n) % parts
    inside = (base != 0) & (pid[:, None] == pid[None, :])
    return normalized(inside.astype(float))


def forward(a, x, weights):
    h, hs, zs = x, [], []
    for layer, w in enumerate(weights):
        hs.append(h)
        z = a @ (h @ w)
        zs.append(z)
        h = np.maximum(z, 0) if layer < len(weights) - 1 else z
    return h, hs, zs


def softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def loss(logits, labels, train):
    if not train.any():
        return 0.0
    p = softmax(logits)[train, labels[train]]
    return float(-np.log(np.clip(p, 1e-15, 1)).mean())


def gradients(a, x, labels, row_weight, weights):
    logits, hs, zs = forward(a, x, weights)
    onehot = np.eye(logits.shape[1])[labels]
    d = (softmax(logits) - onehot) * row_weight[:, None]
    grads = [None] * len(weights)
    for layer in reversed(range(len(weights))):
        if layer < len(weights) - 1:
            d = d * (zs[layer] > 0)
        dm = a @ d
        grads[layer] = hs[layer].T @ dm
        d = dm @ weights[layer].T
    return logits, grads


def macro_f1(pred, label, mask):
    pred, label = pred[mask], label[mask]
    found = []
    for c in sorted(set(pred) | set(label)):
        tp = ((pred == c) & (label == c)).sum()
        found.append(2 * tp / ((pred == c).sum() + (label == c).sum()))
    return float(np.mean(found)) if found else 0.0


def train(a, x, labels, masks, row_weight, weights, lr, epochs):
    rows, weights = [], [w.copy() for w in weights]
    for _ in range(epochs):
        logits, grads = gradients(a, x, labels, row_weight, weights)
        pred = logits.argmax(axis=1)
        tr, va, te = masks
        rows.append(
            {
                "loss": loss(logits, labels, tr),
                "train_acc": float((pred == labels)[tr].mean()) if tr.any() else 0.0,
                "val_f1": macro_f1(pred, labels, va),
                "test_f1": macro_f1(pred, labels, te),
            }
        )
        weights = [w - lr * g for w, g in zip(weights, grads, strict=True)]
    return weights, rows


def standardized(x):
    s = x.std(axis=0)
    s[s == 0] = 1
    return (x - x.mean(axis=0)) / s


class Toy:
    """A random attributed graph with repeats and loops; ids with ``id % 10 > 5`` never train."""

    def __init__(self, spark, n=40, width=5, classes=3, seed=1, trained=True):
        rng = np.random.default_rng(seed)
        self.n, self.classes = n, classes
        self.x = standardized(rng.normal(size=(n, width)))
        self.labels = np.arange(n) % classes
        code = np.where(np.arange(n) % 10 < 6, 1, np.where(np.arange(n) % 10 < 8, 2, 3))
        if not trained:
            code = np.where(code == 1, 2, code)
        self.masks = [code == 1, code == 2, code == 3]
        ends = rng.integers(0, n, size=(3 * n, 2)).tolist() + [[1, 1], [2, 3], [2, 3]]
        self.edges = [(u, v, 1.0) for u, v in ends]
        rows = [
            (i, self.x[i].tolist(), int(self.labels[i]), *[bool(m[i]) for m in self.masks])
            for i in range(n)
        ]
        self.nodes_df = spark.createDataFrame(
            rows,
            "id bigint, features array<double>, label bigint, is_train boolean, "
            "is_val boolean, is_test boolean",
        )
        self.edges_df = spark.createDataFrame(self.edges, "src bigint, dst bigint, w double")

    def row_weight(self, parts=None):
        train = self.masks[0]
        if parts is None:
            return train / max(train.sum(), 1)
        pid = np.arange(self.n) % parts
        counts = np.array([train[pid == p].sum() for p in range(parts)])
        return np.where(train, 1 / (parts * np.maximum(counts[pid], 1)), 0.0)


def matrix(df, n, width, column="vec"):
    out = np.zeros((n, width))
    for r in df.collect():
        out[r["id"]] = r[column]
    return out


def edge_matrix(df, n):
    out = np.zeros((n, n))
    for r in df.collect():
        assert out[r["src"], r["dst"]] == 0
        out[r["src"], r["dst"]] = r["w"]
    return out
