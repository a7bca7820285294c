"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of a text are Spark column expressions.
2. Small trees are boosted on the statistics of a bounded sample of labelled rows; every path from a root is a rule, a
   conjunction of comparisons.
3. Lasso logistic regression weighs the rules; most get weight 0 and go.
4. The rules left are compiled into one Spark column expression, so scoring needs no Python on the executors.

Defined results: a null text counts as empty; an empty text has all statistics 0 and gets the score of that; without labelled
rows or with labels of one kind every score is the share of label 1 (0.5 without rows); rows that repeat score alike; labels of ids
not in docs do not matter; columns named like added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import SAMPLE, fold, sample
from .storage import spread

TREES = 24
DEPTH = 3
BINS = 24
LASSO = 0.002
SEED = 7
STEPS = 2000
TOLERANCE = 1e-4
#: Words that any prose of their language has.
STOP_WORDS = "the of and to in is that for it as was with be by on not at are this have from or which de la le et les des un une du que qui der die und das den von ist zu mit el los las y por con para".split()


def statistics(text: str) -> dict[str, Column]:
    """Name and expression of each statistic of a text."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words).cast("double")
    lines = F.split(t, "\n")
    chars = F.length(t).cast("double")
    per = lambda x, of: F.when(of > 0, x / of).otherwise(F.lit(0.0))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("double")
    return {
        "words": n,
        "word_length": per(chars, n),
        "distinct_words": per(F.size(F.array_distinct(words)).cast("double"), n),
        "upper": per(count("[A-Z]"), chars),
        "marks_per_word": per(count(r"[#$%&*+/<=>@\\^_{}~]"), n),
        "bars_per_word": per(count(r"\|"), n),
        "shouts_per_word": per(count("[!?]"), n),
        "stops_per_word": per(count("[.,;:]"), n),
        "digits": per(count("[0-9]"), chars),
        "distinct_lines": per(F.size(F.array_distinct(lines)).cast("double"), F.size(lines).cast("double")),
        "line_length": per(chars, F.size(lines).cast("double")),
        "line_ends": per(F.size(F.array_remove(F.transform(lines, lambda x: F.endswith(F.rtrim(x), F.lit("."))), False)).cast("double"), F.size(lines).cast("double")),
        "stop_words": F.size(F.array_intersect(words, F.array(*map(F.lit, STOP_WORDS)))).cast("double"),
    }


#: A rule is a tuple of (statistic, is_above, threshold), all of which must hold.
Rule = tuple[tuple[str, bool, float], ...]


@dataclass
class RuleEnsemble:
    names: list[str]
    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def holds(self, x: np.ndarray, rule: Rule) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, limit in rule:
            column = x[:, self.names.index(name)]
            out &= column > limit if above else column <= limit
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            z += weight * self.holds(x, rule)
        return 1 / (1 + np.exp(-z))

    def column(self) -> Column:
        """The score as an expression over the statistics' columns."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            all_hold = None
            for name, above, limit in rule:
                one = F.col(f"__{name}") > limit if above else F.col(f"__{name}") <= limit
                all_hold = one if all_hold is None else all_hold & one
            z = z + F.when(all_hold, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _grow(codes: np.ndarray, edges: list[np.ndarray], residual: np.ndarray, hessian: np.ndarray, columns: np.ndarray, depth: int, path: tuple, at: np.ndarray, out: list, least: int) -> None:
    """Add the paths of a tree (fitted to residuals by histogram splits) to out, each with its rows and value."""
    g, h = residual[at].sum(), hessian[at].sum()
    value = g / (h + 1.0)
    if path:
        out.append((path, at, value, depth == DEPTH))
    if depth == DEPTH or len(at) < 4 * least:
        if path:
            out[-1] = (*out[-1][:3], True)
        return
    best = (1e-6, None, None)
    for c in columns:
        if not len(edges[c]):
            continue
        k = codes[at, c]
        gs = np.bincount(k, residual[at], len(edges[c]) + 1).cumsum()[:-1]
        hs = np.bincount(k, hessian[at], len(edges[c]) + 1).cumsum()[:-1]
        ns = np.bincount(k, minlength=len(edges[c]) + 1).cumsum()[:-1]
        gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
        gain[(ns < least) | (len(at) - ns < least)] = -1
        b = int(gain.argmax())
        if gain[b] > best[0]:
            best = (gain[b], c, b)
    if best[1] is None:
        if path:
            out[-1] = (*out[-1][:3], True)
        return
    _, c, b = best
    low = codes[at, c] <= b
    for side, above in ((at[low], False), (at[~low], True)):
        _grow(codes, edges, residual, hessian, columns, depth + 1, (*path, (int(c), above, float(edges[c][b]))), side, out, least)


def off(w: np.ndarray, slope: np.ndarray) -> float:
    """How far weights are from the lasso's optimum: the slope of the loss must be LASSO against each weight, and at most that at 0."""
    at = np.where(w != 0, np.abs(slope + LASSO * np.sign(w)), np.maximum(np.abs(slope) - LASSO, 0))
    return float(at.max()) if len(at) else 0.0


def weigh(b: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Lasso logistic weights and intercept of standardised columns, to TOLERANCE of the optimum."""
    # accelerated proximal gradient; the step is 4 / the largest eigenvalue of b'b / n, bounded from above by power iteration
    v = np.ones(b.shape[1], np.float32)
    for _ in range(30):
        v = b.T @ (b @ v)
        v /= np.linalg.norm(v)
    step = 4 / (1.05 * float(np.linalg.norm(b @ v)) ** 2 / len(y))
    w, c, last, momentum = np.zeros(b.shape[1]), np.log(y.mean() / (1 - y.mean())), np.zeros(b.shape[1]), 1.0
    u = w
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(b @ u.astype(b.dtype) + c)))
        slope = (b.T @ (p - y).astype(b.dtype)) / len(y)
        drift = float((p - y).mean())
        if off(u, slope) < TOLERANCE and abs(drift) < TOLERANCE:
            w = u
            break
        c -= 2.0 * drift
        new = u - step * slope
        w = np.sign(new) * np.maximum(np.abs(new) - step * LASSO, 0)
        if (u - w) @ (w - last) > 0:  # the momentum points uphill: begin again without it
            momentum = 1.0
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        u = w + (momentum - 1) / after * (w - last)
        last, momentum = w, after
    return w, float(c)


def fit(x: np.ndarray, y: np.ndarray, names: list[str]) -> RuleEnsemble:
    """Trees, their rules, and lasso logistic weights of the rules."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 2 or share in (0.0, 1.0):
        return RuleEnsemble(names, float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))))
    rng = np.random.default_rng(SEED)
    edges = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, c], "left") for c, e in enumerate(edges)], 1)
    z = np.full(len(y), np.log(share / (1 - share)))
    rules: dict[Rule, None] = {}
    least = int(np.clip(len(y) // 100, 2, 10))  # rows on either side of a split
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        rows = np.sort(rng.choice(len(y), max(2, len(y) // 2), replace=False))
        columns = rng.choice(x.shape[1], max(2, x.shape[1] * 2 // 3), replace=False)
        paths: list = []
        _grow(codes, edges, y - p, p * (1 - p), columns, 0, (), rows, paths, least)
        for path, _, value, leaf in paths:
            rules[tuple((names[c], above, limit) for c, above, limit in path)] = None
            if leaf:
                hold = np.ones(len(y), bool)
                for c, above, limit in path:
                    hold &= x[:, c] > limit if above else x[:, c] <= limit
                z[hold] += 0.5 * value
    model = RuleEnsemble(names, 0.0)
    every = list(rules)
    if not every:
        return RuleEnsemble(names, float(np.log(share / (1 - share))))
    a = np.stack([model.holds(x, r) for r in every], 1).astype(np.float32)
    support = a.mean(0)
    keep = (support > 0.002) & (support < 0.998)
    every, a, support = [r for r, k in zip(every, keep, strict=True) if k], a[:, keep], support[keep]
    if not every:
        return RuleEnsemble(names, float(np.log(share / (1 - share))))
    scale = np.sqrt(support * (1 - support)).astype(np.float32)
    w, c = weigh((a - support) / scale, y)
    weights = w / scale
    model.intercept = float(c - (weights * support).sum())
    model.rules = [(r, float(x_)) for r, x_ in zip(every, weights, strict=True) if x_]
    return model


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", modulus: int | None = None, held: int | None = None, most: int = SAMPLE) -> RuleEnsemble:
    """A model from at most so many labelled rows; only their statistics reach the driver."""
    stats = statistics(text)
    rows = sample(docs.select(F.col(key), F.col(text)), labels.select(key, label), label, key, modulus, held, most)
    table = rows.select(*[s.alias(n) for n, s in stats.items()], F.col("__label"), F.col(key).alias("__key")).toArrow()
    table = table.sort_by([("__key", "ascending"), *((n, "ascending") for n in stats)])
    x = np.stack([table[n].to_numpy().astype(np.float64) for n in stats], 1) if len(table) else np.zeros((0, len(stats)))
    return fit(x, table["__label"].to_numpy().astype(np.float64), list(stats))


def score(docs: DataFrame, model: RuleEnsemble, text: str = "text", output: str = "score") -> DataFrame:
    """docs with the score of each text, 0 to 1, higher for better quality."""
    docs = spread(docs)
    columns = [c for c in docs.columns if c != output]
    stats = statistics(text)
    wide = docs.select(*[F.col(f"`{c}`") for c in columns], *[s.alias(f"__one_{n}") for n, s in stats.items()])
    # a generator of one row: no predicate on the score moves below it, where every rule would compute the statistics again
    wide = wide.select(*[F.col(f"`{c}`") for c in columns], F.inline(F.array(F.struct(*[F.col(f"__one_{n}").alias(f"__{n}") for n in stats]))))
    return wide.select(*[F.col(f"`{c}`") for c in columns], model.column().alias(output))


def held_out(key: str, modulus: int, value: int) -> Column:
    return F.coalesce(fold(key, modulus) == value, F.lit(False))
