"""Decision trees grown level by level from sums that add up over blocks of rows.

Features are bytes: the number of a feature's cut points below the value. Whatever a level
needs of the rows is a sum, a minimum or a maximum per node, so blocks can be anywhere;
targets are whole multiples of a unit, so that the sums don't depend on their order. The
same rows thus give the same trees in one task or in many.

Two kinds of splits. ``best`` takes the best of all cut points, from a histogram of each
node and feature. ``random`` takes from each feature one threshold between the node's
least and greatest value, and the best of those. Both compare G^2/W, which is variance
for numbers and the Gini index for classes.

Everything random (rows of a tree, features of a node, thresholds) is a hash of seed, tree,
node and row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 64
#: Targets are multiples of this share of their scale.
UNIT = 1 << 22
#: A tree without a bound of its own ends here.
DEEPEST = 40
#: Cells of a level's working arrays.
CELLS = 1 << 22
#: Cells counted at once: few enough to stay near the processor.
ROWS_AT_ONCE = 1 << 15
#: Rows from which on a node keeps a histogram for its random thresholds; more where many nodes would have one.
LARGE = 128
#: Cells of the smaller nodes looked at together.
NEAR = 1 << 17
#: Residuals are counted in this many steps a factor of two to find their median.
STEPS = 32
MEDIAN_CELLS = 2 * STEPS * 24 + 1


@dataclass(frozen=True)
class Spec:
    """One ensemble. ``features`` of a node: a count rule or a share; ``depth`` None has no bound.

    A node whose drawn features are all constant stays a leaf.

    ``held_out`` is the fold that teaches nothing, -1 for none. ``loss`` is logistic,
    squared or absolute; forests are squared, which on classes is the Gini index.
    """

    classes: bool
    boosted: bool
    trees: int
    depth: int | None = None
    min_leaf: int = 1
    min_split: int = 2
    features: str | float | None = None
    split: str = "best"
    step: float = 1.0
    subsample: float = 1.0
    bootstrap: bool = False
    balanced: bool = False
    loss: str = "squared"
    seed: int = 42
    held_out: int = -1
    #: Rows that the trees so far get wrong weigh more in the next one.
    adaptive: bool = False

    @property
    def sequential(self) -> bool:
        """Whether a tree depends on those before it."""
        return self.boosted or self.adaptive

    def n_features(self, width: int) -> int:
        rule = {None: width, "all": width, "sqrt": int(width**0.5), "log2": int(np.log2(max(2, width)))}
        share = self.features if isinstance(self.features, float) else None
        return max(1, min(width, int(share * width) if share else rule[self.features]))


def hashed(*parts) -> np.ndarray:
    """Uniform numbers in [0, 1) from whole numbers or arrays that fit together."""
    x = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            x = (x ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(32))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


_POISSON = np.cumsum(np.exp(-1) / np.cumprod(np.r_[1, np.arange(1, 12)]))


def multiplicity(spec: Spec, tree: int, key: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """How often each row counts in a tree."""
    learns = fold != spec.held_out
    if spec.bootstrap:
        return np.searchsorted(_POISSON, hashed(spec.seed, 1, tree, key), side="right") * learns
    if spec.subsample < 1:
        return (hashed(spec.seed, 1, tree, key) < spec.subsample) & learns
    return learns


def poisson(mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Poisson counts of the given means from uniform numbers; means beyond 500 are rounded."""
    out, k = np.where(mean > 500, np.rint(mean), 0.0), 0
    p = np.exp(-np.minimum(mean, 500))
    upto, open_ = p.copy(), np.flatnonzero((mean <= 500) & (u >= p))
    while len(open_) and k < 2000:
        k += 1
        out[open_] += 1
        p[open_] *= mean[open_] / k
        upto[open_] += p[open_]
        open_ = open_[u[open_] >= upto[open_]]
    return out


def sampled(spec: Spec, tree: int, key: np.ndarray, fold: np.ndarray, margin: np.ndarray, norm) -> np.ndarray:
    """How much each row counts in a tree.

    Adaptive models keep the logarithm of a row's weight as its margin; ``norm`` is their greatest,
    the sum of weights relative to it, and the number of rows. Classes take the weights,
    numbers a bootstrap sample by weight.
    """
    if not spec.adaptive:
        return np.asarray(multiplicity(spec, tree, key, fold), np.float64)
    top, total, n = norm
    weight = np.exp(margin - top) * (n / total) * (fold != spec.held_out)
    return weight if spec.classes else poisson(weight, hashed(spec.seed, 4, tree, key))


@dataclass
class Tree:
    """Nodes side by side; the children of a node stand together, a leaf has feature -1.

    ``say`` is its weight in an adaptive vote, ``worst`` its greatest error on the rows.
    """

    feature: np.ndarray = field(default_factory=lambda: np.full(1, -1, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint8))
    child: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(1))
    gain: np.ndarray = field(default_factory=lambda: np.zeros(1))
    say: float = 1.0
    worst: float = 1.0

    def node_of(self, bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The leaf (so far) of each row."""
        rows = np.arange(len(bins)) if rows is None else rows
        node = np.zeros(len(rows), np.int32)
        moving = np.arange(len(rows)) if self.feature[0] >= 0 else np.empty(0, np.int64)
        while len(moving):
            at = node[moving]
            node[moving] = self.child[at] + (bins[rows[moving], self.feature[at]] > self.cut[at])
            moving = moving[self.feature[node[moving]] >= 0]
        return node

    def split(self, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Two children for each of the nodes; returns the number of each first child."""
        first = len(self.feature) + 2 * np.arange(len(at))
        self.feature[at], self.cut[at], self.child[at], self.gain[at] = feature, cut, first, gain
        more = 2 * len(at)
        self.feature = np.r_[self.feature, np.full(more, -1, np.int32)]
        self.cut = np.r_[self.cut, np.zeros(more, np.uint8)]
        self.child = np.r_[self.child, np.zeros(more, np.int32)]
        self.value, self.gain = np.r_[self.value, np.zeros(more)], np.r_[self.gain, np.zeros(more)]
        return first


def mass(weights: tuple[float, float] | None, n, s):
    """Weight and weighted target of a count and a sum, under weights of class 0 and 1."""
    if weights is None:
        return n, s
    return weights[0] * (n - s) + weights[1] * s, weights[1] * s


@dataclass
class Asked:
    """The nodes of one model that a level looks at, and which features each of them may take."""

    spec: Spec
    tree: np.ndarray
    node: np.ndarray
    n: np.ndarray
    s: np.ndarray
    choice: np.ndarray
    weights: tuple[float, float] | None

    def only(self, at: np.ndarray) -> Asked:
        """Some of the nodes."""
        return Asked(self.spec, self.tree[at], self.node[at], self.n[at], self.s[at], self.choice[at], self.weights)

    def gains(self, n: np.ndarray, s: np.ndarray) -> np.ndarray:
        """Gain of a split with n rows and sum s on the left, -1 where it isn't allowed."""
        more = (1,) * (n.ndim - 1)
        all_n, all_s = self.n.reshape(-1, *more), self.s.reshape(-1, *more)
        least = 1e-9 if self.spec.adaptive and self.spec.classes else self.spec.min_leaf
        (wl, gl), (w, g) = mass(self.weights, n, s), mass(self.weights, all_n, all_s)
        wr, gr = w - wl, g - gl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl * gl / wl + gr * gr / wr - g * g / w
        return np.where((n >= least) & (all_n - n >= least), gain, -1.0)


@dataclass
class Found:
    """The best split of each asked node."""

    gain: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    n: np.ndarray
    s: np.ndarray


def choices(spec: Spec, tree: np.ndarray, node: np.ndarray, width: int) -> np.ndarray:
    """Features that each node may take, in order."""
    k = spec.n_features(width)
    if k == width:
        return np.broadcast_to(np.arange(width), (len(node), width))
    order = hashed(spec.seed, 2, tree[:, None], node[:, None], np.arange(width))
    return np.sort(np.argpartition(order, k - 1, axis=1)[:, :k], axis=1)


def _cells(bins: np.ndarray, row: np.ndarray, choice: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The bytes that each row's node may take."""
    width = bins.shape[1]
    if choice.shape[1] == width:
        return bins[row]
    if 8 * choice.shape[1] < width:
        return bins[row[:, None], choice[at]]
    return np.take_along_axis(bins[row], choice[at], axis=1)


def histogram(bins, row, at, m, y, choice) -> np.ndarray:
    """(2, nodes, features, bins): counts and sums of the targets."""
    n_nodes, k = choice.shape
    out = np.zeros((2, n_nodes * k * BINS))
    for a in range(0, len(row), max(1, CELLS // k)):
        part = slice(a, a + max(1, CELLS // k))
        cell = (at[part, None] * k + np.arange(k)) * BINS + _cells(bins, row[part], choice, at[part])
        for i, w in enumerate((m[part], m[part] * y[part])):
            out[i] += np.bincount(cell.ravel(), np.repeat(w, k), out.shape[1])
    return out.reshape(2, n_nodes, k, BINS)


def _by_node(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by node, where each node present begins, and which those are."""
    order = np.argsort(at, kind="stable")
    begin = np.flatnonzero(np.r_[True, np.diff(at[order]) != 0])
    return order, begin, at[order][begin]


def ranges(bins, row, at, choice) -> np.ndarray:
    """(2, nodes, features): least and greatest bin; BINS and -1 without rows."""
    out = np.empty((2, *choice.shape), np.int16)
    out[0], out[1] = BINS, -1
    if len(at):
        order, begin, here = _by_node(at)
        cells = _cells(bins, row[order], choice, at[order])
        out[0][here] = np.minimum.reduceat(cells, begin, axis=0)
        out[1][here] = np.maximum.reduceat(cells, begin, axis=0)
    return out


#: A count below this and a sum share a whole number of 64 bits.
_COUNTS = 1 << 20


def left_sums(bins, row, at, m, y, choice, cut) -> np.ndarray:
    """(2, nodes, features): counts and sums at or below each node's cut points; counts and targets are whole."""
    out = np.zeros((2, *choice.shape))
    if len(at):
        order, begin, here = _by_node(at)
        left = _cells(bins, row[order], choice, at[order]) <= cut[at[order]]
        both = (m + m * y * _COUNTS).astype(np.int64)[order]
        sums = np.add.reduceat(np.where(left, both[:, None], 0), begin, axis=0)
        out[0][here], out[1][here] = sums & (_COUNTS - 1), sums >> 20
    return out


def thresholds(asked: Asked, span: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One cut for each node and feature, even between least and greatest value: below the greatest bin that is there."""
    low, high = np.minimum(span[0], BINS - 1).astype(np.int64), np.maximum(span[1], 0).astype(np.int64)
    u = hashed(asked.spec.seed, 3, asked.tree[:, None], asked.node[:, None], asked.choice)
    a, b = values[asked.choice, low], values[asked.choice, high]
    t = a + u * (b - a)
    under = low.copy()  # becomes the last bin whose value is at most t
    wide = np.nonzero(high - low > 1)
    if len(wide[0]):
        goal, lo, hi = t[wide], low[wide], high[wide]
        first, flat = asked.choice[wide] * values.shape[1], values.ravel()
        step = 1 << (int((hi - lo).max()) - 1).bit_length() >> 1
        while step:
            at = lo + step
            inside = np.minimum(at, hi - 1)
            np.copyto(lo, at, where=(flat.take(first + inside) <= goal) & (at == inside))
            step >>= 1
        under[wide] = lo
    return under


def best_of_histogram(asked: Asked, hist: np.ndarray) -> Found:
    upto = hist.cumsum(axis=3)
    gain = asked.gains(upto[0], upto[1]).reshape(len(asked.node), -1)
    best = gain.argmax(axis=1)
    place, cut = best // BINS, best % BINS
    of = np.arange(len(best))
    return Found(gain[of, best], asked.choice[of, place], cut, upto[0][of, place, cut], upto[1][of, place, cut])


def best_of_random(asked: Asked, cut: np.ndarray, span: np.ndarray, left: np.ndarray) -> Found:
    gain = np.where(span[0] < span[1], asked.gains(left[0], left[1]), -1.0)
    best = gain.argmax(axis=1)
    of = np.arange(len(best))
    return Found(gain[of, best], asked.choice[of, best], cut[of, best], left[0][of, best], left[1][of, best])


class Splits:
    """The best splits of level after level, with all rows at hand as columns of bytes, some features at a time.

    Where every node takes all features, of two siblings only the smaller is counted; the other's sums are
    their parent's less the sibling's. Counts and sums of whole targets share one number while both fit.
    """

    def __init__(self, columns: np.ndarray, spec: Spec) -> None:
        self.columns, self.spec = columns, spec
        self.whole = not (spec.adaptive and spec.classes)  # weights that are no whole numbers don't subtract exactly
        self.old: list[np.ndarray] | None = None
        self.parent = self.sibling = np.empty(0, np.int64)

    def follow(self, feature: np.ndarray, child: np.ndarray, kept: np.ndarray, *rows: np.ndarray) -> None:
        """Take over which nodes of the next level come from which of this one (see ``Growth.take``)."""
        up = np.flatnonzero(feature >= 0)
        left, right = kept[child[up]], kept[child[up] + 1]
        self.parent = np.full(int((kept >= 0).sum()), -1)
        self.sibling = self.parent.copy()
        for a, b in ((left, right), (right, left)):
            self.parent[a[a >= 0]], self.sibling[a[a >= 0]] = up[a >= 0], b[a >= 0]

    def _derived(self, asked: Asked) -> np.ndarray:
        """Nodes whose sums follow from their parent's and a smaller sibling's."""
        if self.old is None or len(self.sibling) != len(asked.node):
            return np.empty(0, np.int64)
        own, other = np.arange(len(self.sibling)), self.sibling
        more = (asked.n > asked.n[other]) | ((asked.n == asked.n[other]) & (own > other))
        return np.flatnonzero((other >= 0) & more)

    def search(self, asked: Asked, row, at, m, y) -> Found:
        n, k = asked.choice.shape
        all_features = k == len(self.columns)
        derived = self._derived(asked)
        slot = np.ones(n, np.int64)
        slot[derived] = 0
        if len(derived):
            here = slot[at] > 0
            row, at, m, y = row[here], at[here], m[here], y[here]
        counted = np.flatnonzero(slot)
        slot = (np.cumsum(slot) - 1) * BINS
        keeps = all_features and self.whole and n * k * BINS <= CELLS
        sums = self._counter(slot[at], m, y, len(counted) * BINS)
        kept: list[np.ndarray] = []
        found = Found(np.full(n, -np.inf), *(np.zeros(n, t) for t in (np.int64, np.int64, float, float)))
        of, wide = np.arange(n), max(1, min(k, ROWS_AT_ONCE // max(1, len(row), n * BINS)))
        for j in range(0, k, wide):
            some = slice(j, min(j + wide, k))
            if all_features:
                codes = lambda part, out: self.columns[some].take(row[part], axis=1, out=out, mode="clip")
            else:
                first = asked.choice[:, some].T * self.columns.shape[1]
                codes = lambda part, out: self.columns.ravel().take(first[:, at[part]] + row[part], out=out, mode="clip")
            hist = sums(codes, some.stop - j).reshape(2, some.stop - j, len(counted), BINS)
            if len(derived):
                full = np.empty((2, some.stop - j, n, BINS))
                full[:, :, counted] = hist
                full[:, :, derived] = self.old[j // self.wide][:, :, self.parent[derived]] if self.wide == wide else self._old(some)[:, :, self.parent[derived]]
                full[:, :, derived] -= full[:, :, self.sibling[derived]]
                hist = full
            if keeps:
                kept.append(hist)
            upto = hist.cumsum(axis=3)
            for i in range(some.stop - j):
                gain = asked.gains(upto[0, i], upto[1, i])
                cut = gain.argmax(axis=1)
                better = np.flatnonzero(gain[of, cut] > found.gain)
                c = cut[better]
                found.gain[better], found.cut[better], found.feature[better] = gain[better, c], c, asked.choice[better, j + i]
                found.n[better], found.s[better] = upto[0, i, better, c], upto[1, i, better, c]
        self.old, self.wide = (kept, wide) if keeps else (None, wide)
        return found

    def _old(self, some: slice) -> np.ndarray:
        """Sums of the level before for some features, which it may have looked at in other groups."""
        return np.concatenate([self.old[f // self.wide][:, f % self.wide : f % self.wide + 1] for f in range(some.start, some.stop)], axis=1)

    def _counter(self, cell: np.ndarray, m: np.ndarray, y: np.ndarray, size: int):
        """A function from codes (features x some rows) and their number to (2, features x size) counts and sums."""
        rows = len(cell)
        unit = UNIT if self.spec.loss == "absolute" and self.spec.boosted else 1
        low, span = (float(y.min()), (float(y.max()) - float(y.min())) / unit + 1) if rows else (0.0, 1.0)
        most = (2.0**51 / span) ** 0.5  # rows, repeats counted, whose packed sums stay exact
        total, ones = float(m.sum()), bool((m == 1).all())
        group = rows if total <= most else int(most) if ones else 0
        packed = self.whole and (group >= rows or group >= 2 * size)
        if not packed:
            group, weights = max(1, rows), (None if ones else m, m * y)
        else:
            lift = 2.0 ** np.ceil(np.log2(min(most, max(total, 1.0)) * span + 1))
            weights = (m * lift + m * ((y - low) / unit),)

        def sums(codes, features: int) -> np.ndarray:
            out = np.zeros((2, features * size))
            step = max(1, (ROWS_AT_ONCE if self.whole else CELLS) // features)
            own_codes, own_at = (np.empty(features * min(step, rows), t) for t in (np.uint8, np.int64))
            for a in range(0, rows, max(1, group)):
                end = min(rows, a + group)
                own = out if not packed else np.zeros((1, features * size))
                for b in range(a, end, step):
                    part = slice(b, min(end, b + step))
                    shape = (features, part.stop - b)
                    code, at = (buffer[: shape[0] * shape[1]].reshape(shape) for buffer in (own_codes, own_at))
                    codes(part, code)
                    np.add(code, cell[part], out=at)
                    for f in range(1, features):
                        at[f] += f * size
                    for i, w in enumerate(weights):
                        shared = None if w is None else w[part] if features == 1 else np.tile(w[part], features)
                        own[i] += np.bincount(at.ravel(), shared, features * size)
                if packed:
                    n = np.floor(own[0] / lift)
                    out[0] += n
                    out[1] += (own[0] - n * lift) * unit + low * n
            return out

        return sums


#: Bits of a word whose features are counted together, and rows a node from which on that pays.
WORD_BITS = 12
JOINT_ROWS = 2048


class Words:
    """Bins of all rows as words of 16 bits, each with several features side by side; reads as rows by features."""

    def __init__(self, sizes: np.ndarray, n: int) -> None:
        """``sizes`` has the number of bins of each feature."""
        self.bits = np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
        self.mask = ((1 << self.bits) - 1).astype(np.uint16)
        self.word, self.shift = np.zeros((2, len(sizes)), np.int64)
        self.features: list[list[int]] = []
        used: list[int] = []
        for f in np.argsort(-self.bits, kind="stable").tolist():
            w = next((i for i, u in enumerate(used) if u + self.bits[f] <= WORD_BITS), len(used))
            if w == len(used):
                used.append(0)
                self.features.append([])
            self.word[f], self.shift[f] = w, used[w]
            self.features[w].append(f)
            used[w] += int(self.bits[f])
        self.used = used
        self.words = np.zeros((len(used), n), np.uint16)

    def fill(self, start: int, bins: np.ndarray) -> None:
        """Take in rows of bytes."""
        columns = np.ascontiguousarray(bins.T)
        if (columns.max(axis=1, initial=0) > self.mask).any():  # what is no number has the last of all bins
            wide = Words(np.full(len(columns), BINS), len(self))
            for f in range(len(columns)):
                wide.words[wide.word[f]] |= (self.words[self.word[f]] >> np.uint16(self.shift[f]) & self.mask[f]) << np.uint16(wide.shift[f])
            self.__dict__.update(wide.__dict__)
        for f in range(len(columns)):
            self.words[self.word[f], start : start + len(bins)] |= columns[f].astype(np.uint16) << np.uint16(self.shift[f])

    def __len__(self) -> int:
        return self.words.shape[1]

    def __getitem__(self, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The bins of pairs of a row and a feature."""
        row, feature = at
        return self.words.ravel().take(self.word[feature] * len(self) + row) >> self.shift[feature] & self.mask[feature]

    def reorder(self, order: np.ndarray) -> None:
        for w in self.words:
            w[:] = w[order]


class WordSplits(Splits):
    """The same splits where every node takes all features: large nodes count all features of a word at once."""

    def __init__(self, words: Words, spec: Spec) -> None:
        super().__init__(np.empty((len(words.word), 0), np.uint8), spec)
        self.words = words

    def search(self, asked: Asked, row, at, m, y) -> Found:
        n, k = asked.choice.shape
        derived = self._derived(asked)
        slot = np.ones(n, np.int64)
        slot[derived] = 0
        if len(derived):
            here = slot[at] > 0
            row, at, m, y = row[here], at[here], m[here], y[here]
        counted = np.flatnonzero(slot)
        cell = (np.cumsum(slot) - 1)[at]
        if len(row) == len(self.words) and (asked.tree == asked.tree[0]).all():  # every row once, in order
            row = None
        joint = len(cell) >= JOINT_ROWS * len(counted)
        keeps = self.whole and n * k * BINS <= CELLS
        weights, split = self._weights(m, y)
        kept: list[np.ndarray] = []
        found, of = Found(np.full(n, -np.inf), *(np.zeros(n, t) for t in (np.int64, np.int64, float, float))), np.arange(n)
        for w, features in enumerate(self.words.features):
            hist = split(self._counts(w, features, joint, row, cell, weights, len(counted)))
            if len(derived):
                full = np.empty((2, len(features), n, BINS))
                full[:, :, counted] = hist
                full[:, :, derived] = self.old[w][:, :, self.parent[derived]]
                full[:, :, derived] -= full[:, :, self.sibling[derived]]
                hist = full
            if keeps:
                kept.append(hist)
            upto = hist.cumsum(axis=3)
            for i, f in enumerate(features):
                gain = asked.gains(upto[0, i], upto[1, i])
                cut = gain.argmax(axis=1)
                top = gain[of, cut]
                better = np.flatnonzero((top > found.gain) | ((top == found.gain) & (f < found.feature)))
                c = cut[better]
                found.gain[better], found.cut[better], found.feature[better] = top[better], c, f
                found.n[better], found.s[better] = upto[0, i, better, c], upto[1, i, better, c]
        self.old = kept if keeps else None
        return found

    def _weights(self, m: np.ndarray, y: np.ndarray):
        """What is added up, counts and sums in one number where all of them fit, and a function that parts them."""
        unit = UNIT if self.spec.loss == "absolute" and self.spec.boosted else 1
        if self.whole and len(m):
            low, total = float(y.min()), max(float(m.sum()), 1.0)
            bits = np.ceil(np.log2(total * ((float(y.max()) - low) / unit + 1) + 1))
            if bits + np.log2(total) <= 51:
                lift = 2.0**bits

                def parted(sums: np.ndarray) -> np.ndarray:
                    count = np.floor(sums[0] / lift)
                    return np.stack([count, (sums[0] - count * lift) * unit + low * count])

                return (m * lift + m * ((y - low) / unit),), parted
        return (None if bool((m == 1).all()) else m, m * y), lambda sums: sums

    def _counts(self, w: int, features: list[int], joint: bool, row, cell, weights, nodes: int) -> np.ndarray:
        """(weights, features, nodes, bins): sums of a word's features."""
        words, column = self.words, self.words.words[w]
        used = words.used[w] if joint else 0
        base = cell << used if joint else cell * BINS
        out = np.zeros((len(weights), nodes << used) if joint else (len(weights), len(features), nodes * BINS))
        for a in range(0, len(cell), ROWS_AT_ONCE):
            part = slice(a, a + ROWS_AT_ONCE)
            code = column[part] if row is None else column.take(row[part], mode="clip")
            if joint:
                index = code + base[part]
                for i, v in enumerate(weights):
                    out[i] += np.bincount(index, None if v is None else v[part], out.shape[1])
            else:
                for j, f in enumerate(features):
                    index = (code >> np.uint16(words.shift[f]) & words.mask[f]) + base[part]
                    for i, v in enumerate(weights):
                        out[i, j] += np.bincount(index, None if v is None else v[part], out.shape[2])
        if not joint:
            return out.reshape(len(weights), len(features), nodes, BINS)
        sums = np.zeros((len(weights), len(features), nodes, BINS))
        sizes = [1 << int(words.bits[f]) for f in reversed(features)]  # the last feature has the highest bits
        table = out.reshape(len(weights), nodes, *sizes)
        for j in range(len(features)):
            own = 2 + len(features) - 1 - j
            others = tuple(i for i in range(2, table.ndim) if i != own)
            sums[:, j, :, : table.shape[own]] = table.sum(axis=others)
        return sums


class RandomSplits(Splits):
    """The best random thresholds of level after level, with all rows at hand.

    Where nodes take many features, large nodes keep counts and sums of all features: of two siblings only the
    one with fewer rows is counted, the other's are their parent's less the sibling's. The rows of other nodes are
    looked at themselves, a few nodes at a time. Counts and targets are whole.
    """

    def __init__(self, bins: np.ndarray, columns: np.ndarray, spec: Spec, values: np.ndarray) -> None:
        super().__init__(columns, spec)
        self.bins, self.values = bins, values
        self.many = 3 * spec.n_features(len(columns)) >= len(columns)
        self.large = 0
        self.slot = self.hist = None

    def _counted(self, n: int, row, at, m, y) -> np.ndarray:
        """(2, features, n nodes, bins): counts and sums of all features."""
        width = len(self.columns)
        out = np.empty((2, width, n, BINS))
        sums = self._counter(at * BINS, m, y, n * BINS)
        wide = max(1, min(width, ROWS_AT_ONCE // max(1, len(row), n * BINS)))
        for j in range(0, width, wide):
            some = slice(j, min(j + wide, width))
            codes = lambda part, out: self.columns[some].take(row[part], axis=1, out=out, mode="clip")
            out[:, some] = sums(codes, some.stop - j).reshape(2, some.stop - j, n, BINS)
        return out

    def _begin(self, asked: Asked, row, at, m, y) -> None:
        """Histograms of the roots."""
        n = len(asked.node)
        self.slot = np.full(n, -1)
        self.large = max(LARGE, len(row) * len(self.columns) * BINS // CELLS)
        roots = np.flatnonzero(np.bincount(at, minlength=n) >= self.large) if self.many else ()
        if len(roots):
            self.slot[roots] = np.arange(len(roots))
            here = self.slot[at] >= 0
            self.hist = self._counted(len(roots), row[here], self.slot[at[here]], m[here], y[here])

    def follow(self, feature: np.ndarray, child: np.ndarray, kept: np.ndarray, *rows: np.ndarray) -> None:
        """Histograms of the next level's large nodes; ``rows`` are row, child, count and target of all rows that went on."""
        old, self.slot = self.slot, np.full(int((kept >= 0).sum()), -1)
        if self.hist is None:
            return
        row, at, m, y = rows
        size = np.bincount(at, minlength=len(kept))
        wanted = (kept >= 0) & (size >= self.large)
        up = np.flatnonzero((feature >= 0) & (old >= 0))
        up = up[wanted[child[up]] | wanted[child[up] + 1]]
        if not len(up):
            self.hist = None
            return
        left = child[up]
        fewer = left + (size[left] > size[left + 1])
        more = 2 * left + 1 - fewer
        place = np.full(len(kept), -1)
        place[fewer] = np.arange(len(up))
        here = place[at] >= 0
        counted = self._counted(len(up), row[here], place[at[here]], m[here], y[here])
        a, b = wanted[fewer], wanted[more]
        rest = self.hist[:, :, old[up[b]]]
        rest -= counted[:, :, b]
        self.hist = np.concatenate([counted[:, :, a], rest], axis=2) if a.any() else rest
        self.slot[kept[np.r_[fewer[a], more[b]]]] = np.arange(self.hist.shape[2])

    def search(self, asked: Asked, row, at, m, y) -> Found:
        if self.slot is None:
            self._begin(asked, row, at, m, y)
        n = len(asked.node)
        found = Found(np.full(n, -1.0), *(np.zeros(n, t) for t in (np.int64, np.int64, float, float)))

        def put(nodes: np.ndarray, part: Found) -> None:
            for name in ("gain", "feature", "cut", "n", "s"):
                getattr(found, name)[nodes] = getattr(part, name)

        large = np.flatnonzero(self.slot >= 0)
        together = max(1, CELLS // (8 * BINS * len(self.columns)))
        for i in range(0, len(large), together):
            nodes = large[i : i + together]
            put(nodes, self._of_histograms(asked.only(nodes), self.hist[:, :, self.slot[nodes]]))
        if len(large):
            other = self.slot[at] < 0
            row, at, m, y = row[other], at[other], m[other], y[other]
        if not len(row):
            return found
        order, begin, here = _by_node(at.astype(np.uint16) if n <= 1 << 16 else at)
        row, m, y, here = row[order], m[order], y[order], here.astype(np.int64)
        begin = np.r_[begin, len(row)]
        i, step = 0, max(1, NEAR // (len(self.columns) if self.many else asked.choice.shape[1]))
        while i < len(here):
            j = max(i + 1, int(np.searchsorted(begin, begin[i] + step, side="right")) - 1)
            part = slice(begin[i], begin[j])
            put(here[i:j], self._of_rows(asked.only(here[i:j]), begin[i : j + 1] - begin[i], row[part], m[part], y[part]))
            i = j
        return found

    def _of_histograms(self, asked: Asked, hist: np.ndarray) -> Found:
        if asked.choice.shape[1] < len(self.columns):
            hist = hist[:, asked.choice.T, np.arange(len(asked.node))]
        there = hist[0] > 0
        span = np.stack([there.argmax(axis=2).T, BINS - 1 - there[:, :, ::-1].argmax(axis=2).T]).astype(np.int16)
        cut = thresholds(asked, span, self.values)
        left = np.take_along_axis(hist.cumsum(axis=3), cut.T[None, :, :, None], axis=3)[..., 0].transpose(0, 2, 1)
        return best_of_random(asked, cut, span, left)

    def _of_rows(self, asked: Asked, begin: np.ndarray, row, m, y) -> Found:
        """The same from the rows, in the order of their nodes; node i has those from ``begin[i]`` on."""
        sizes, begin = np.diff(begin), begin[:-1]
        if self.many:
            cells = self.bins[row]
        else:
            cells = self.bins.ravel().take(np.repeat(asked.choice, sizes, axis=0) + (row * len(self.columns))[:, None])
        span = np.stack([np.minimum.reduceat(cells, begin, axis=0), np.maximum.reduceat(cells, begin, axis=0)])
        some = self.many and asked.choice.shape[1] < len(self.columns)
        if some:
            span = np.stack([np.take_along_axis(v, asked.choice, axis=1) for v in span])
        span = span.astype(np.int16)
        cut = thresholds(asked, span, self.values)
        if some:
            at_most = np.zeros((len(begin), len(self.columns)), np.uint8)
            np.put_along_axis(at_most, asked.choice, cut.astype(np.uint8), axis=1)
        else:
            at_most = cut.astype(np.uint8)
        left = cells <= np.repeat(at_most, sizes, axis=0)
        most = float(np.add.reduceat(m, begin).max())

        def sums(weight: np.ndarray) -> np.ndarray:
            """Of each node's rows on the left, in the narrowest numbers that hold them."""
            least, bound = float(weight.min()), most * float(np.abs(weight).max())
            kind = np.uint8 if least >= 0 and bound < 1 << 8 else np.int32 if bound < 1 << 31 else np.int64
            held = left.view(np.uint8) if kind == np.uint8 and least == 1 == weight.max() else np.multiply(left.view(np.uint8), weight.astype(kind)[:, None], dtype=kind)
            total = np.add.reduceat(held, begin, axis=0, dtype=kind)
            return np.take_along_axis(total, asked.choice, axis=1) if some else total

        return best_of_random(asked, cut, span, np.stack([sums(m), sums(m * y)]).astype(np.float64))


class Growth:
    """Some trees of one model, one level after the other."""

    def __init__(self, spec: Spec, numbers: list[int], totals: list[tuple[float, float]], weights, width: int) -> None:
        self.spec, self.numbers, self.width, self.weights = spec, np.array(numbers), width, weights
        self.trees = [Tree() for _ in numbers]
        self.level = 0
        self.n, self.s = (np.array(x, np.float64) for x in zip(*totals))
        self.tree, self.node = np.arange(len(numbers)), np.zeros(len(numbers), np.int64)
        #: Count and sum of every node ever met, by tree.
        self.sums = [{0: t} for t in totals]
        self._narrow()

    def _narrow(self) -> None:
        """Only nodes that may be split stay."""
        spec = self.spec
        zero = (self.s == 0) | (self.s == self.n) if spec.classes and not spec.boosted else np.zeros(len(self.n), bool)
        able = (self.n >= max(spec.min_split, 2 * spec.min_leaf, 2)) & ~zero & (self.level < (spec.depth or DEEPEST))
        self.tree, self.node, self.n, self.s = self.tree[able], self.node[able], self.n[able], self.s[able]

    def asked(self) -> Asked | None:
        if not len(self.node):
            return None
        number = self.numbers[self.tree]
        return Asked(self.spec, number, self.node, self.n, self.s, choices(self.spec, number, self.node, self.width), self.weights)

    def take(self, found: Found) -> tuple[np.ndarray, ...]:
        """Split what gains. Returns for each asked node its feature (-1 if it stays a leaf), cut and first child;
        then for each child its place in the next level, -1 if it is not looked at again."""
        w, g = mass(self.weights, self.n, self.s)
        parted = found.gain > 1e-9 * np.maximum(1.0, g * g / np.maximum(w, 1e-300))
        first = np.zeros(len(self.node), np.int64)
        for t in np.unique(self.tree[parted]).tolist():
            own = np.flatnonzero(parted & (self.tree == t))
            first[own] = self.trees[t].split(self.node[own], found.feature[own], found.cut[own], found.gain[own])
        p = np.flatnonzero(parted)
        left, right = (found.n[p], found.s[p]), (self.n[p] - found.n[p], self.s[p] - found.s[p])
        for t, c, a, b, x, y in zip(self.tree[p].tolist(), first[p].tolist(), *(v.tolist() for v in (*left, *right))):
            self.sums[t][c], self.sums[t][c + 1] = (a, b), (x, y)
        place = np.full(len(self.node), -1, np.int64)
        place[p] = 2 * np.arange(len(p))
        self.tree = np.repeat(self.tree[p], 2)
        self.node = np.c_[first[p], first[p] + 1].ravel()
        self.n, self.s = np.c_[left[0], right[0]].ravel(), np.c_[left[1], right[1]].ravel()
        self.level += 1
        before = len(self.node)
        keys = self.tree * (1 << 32) + self.node
        self._narrow()
        kept = np.full(before, -1, np.int64)
        kept[np.isin(keys, self.tree * (1 << 32) + self.node)] = np.arange(len(self.node))
        return np.where(parted, found.feature, -1), found.cut, place, kept


def median_cell(residual: np.ndarray) -> np.ndarray:
    """Steps of a factor 2^(1/STEPS), from one UNIT-th up, both signs; equal for equal numbers."""
    size = np.floor(STEPS * np.log2(np.maximum(np.abs(residual), 1.0))).astype(np.int64)
    return MEDIAN_CELLS // 2 + np.sign(residual).astype(np.int64) * np.where(residual == 0, 0, np.minimum(size + 1, MEDIAN_CELLS // 2))


def cell_median(counts: np.ndarray) -> np.ndarray:
    """The median of each row of cell counts."""
    upto = counts.cumsum(axis=1)
    at = (2 * upto >= upto[:, -1:]).argmax(axis=1) - MEDIAN_CELLS // 2
    return np.sign(at) * 2.0 ** ((np.abs(at) - 0.5) / STEPS) * (at != 0)


def logistic(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


def gradient(spec: Spec, y: np.ndarray, margin: np.ndarray, scale: float) -> np.ndarray:
    """What the next tree learns, as whole multiples of scale / UNIT."""
    if spec.loss == "logistic":
        return np.rint((y - logistic(margin)) * UNIT)
    if spec.loss == "absolute":
        return np.sign(y - margin) * UNIT
    return np.rint(np.clip((y - margin) / scale, -4, 4) * UNIT)


def curvature(margin: np.ndarray) -> np.ndarray:
    p = logistic(margin)
    return np.rint(p * (1 - p) * UNIT)


def leaf_extra(spec: Spec, y, margin, m, leaf, n_leaves: int, scale: float) -> np.ndarray | None:
    """What leaves need beside counts and sums: curvature, or residuals counted in cells; adds up over blocks."""
    if not spec.boosted:
        return None
    if spec.loss == "logistic":
        return np.bincount(leaf, m * curvature(margin), n_leaves)[:, None]
    if spec.loss == "absolute":
        cell = median_cell(np.rint((y - margin) / scale * UNIT))
        return np.bincount(leaf * MEDIAN_CELLS + cell, m, n_leaves * MEDIAN_CELLS).reshape(n_leaves, -1)
    return None


def set_values(spec: Spec, tree: Tree, sums: dict, extra: np.ndarray | None, scale: float, weights) -> None:
    """Values of all leaves of a finished tree."""
    at = np.flatnonzero(tree.feature < 0)
    n, s = (np.array(x) for x in zip(*(sums[i] for i in at.tolist())))
    if spec.boosted and spec.loss == "logistic":
        value = s / np.maximum(extra[at, 0], 1.0) * (extra[at, 0] > 0)
    elif spec.boosted and spec.loss == "absolute":
        value = cell_median(extra[at]) * scale / UNIT
    elif spec.classes:
        w, g = mass(weights, n, s)
        value = g / np.maximum(w, 1e-300)
    else:
        value = s / np.maximum(n, 1) * scale / UNIT
    tree.value[at] = np.rint(value * spec.step * 2.0**30) * 2.0**-30  # sums of values are exact in any order


def errors(spec: Spec, tree: Tree, leaf: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Wrong or not for classes, the distance for numbers."""
    guess = tree.value[leaf]
    return ((guess > 0.5) != (y > 0.5)).astype(np.float64) if spec.classes else np.abs(guess - y)


def advance(spec: Spec, tree: Tree, leaf: np.ndarray, y: np.ndarray, margin: np.ndarray) -> None:
    """What a finished tree does to the margins: its values, or for adaptive models the weights' logarithms."""
    if spec.boosted:
        margin += tree.value[leaf]
    elif spec.adaptive:
        wrong = errors(spec, tree, leaf, y)
        margin += tree.say * (wrong if spec.classes else wrong / tree.worst - 1.0)


def voice(spec: Spec, tree: Tree, share: float, worst: float, first: bool) -> bool:
    """Set a tree's say from its weighted error share; returns whether more trees may follow.

    A tree without error ends the model, and so does one that is no better than chance,
    which then has no say, unless it is the first.
    """
    tree.worst = worst if worst > 0 else 1.0
    if share <= 0 or (share >= 0.5 and first):
        tree.say = 1.0
        return False
    if share >= 0.5:
        tree.say = 0.0
        return False
    tree.say = float(np.log((1 - share) / share))
    return True


def vote(spec: Spec, trees: list[Tree], guesses: np.ndarray) -> np.ndarray:
    """Of rows by trees: the weighted margin of the classes between -1 and 1, or the weighted median."""
    say = np.array([t.say for t in trees])
    if spec.classes:
        return np.where(guesses > 0.5, 1.0, -1.0) @ say / say.sum()
    order = np.argsort(guesses, axis=1, kind="stable")
    upto = np.cumsum(say[order], axis=1)
    middle = (upto >= 0.5 * upto[:, -1:]).argmax(axis=1)
    return guesses[np.arange(len(guesses)), order[np.arange(len(guesses)), middle]]
