"""Toxicity scores by weak supervision.

1. *Voters.* Lexicon voters fire on a word or on the beginning of a word (inflections): a fixed seed list, and units
   mined from labelled rows. A unit counts once for each different word before it, so that copies of one text can't
   make an expression look common. Pattern voters fire on shouting, masked words and the like.
2. *Label model.* A generative model of the votes: a text is toxic or clean, and in each class every voter fires with a
   rate that depends on whether one other voter, its parent, fires. The rates are the voters' accuracies, the links their
   correlations; parents are the tree of largest mutual information given the class, without links that tell nothing.
   EM fits rates and classes to the votes. The given label is one more source, whose rates are estimated like all others
   (``label_model`` takes rows without it too, but with them held-out accuracy was worse).
3. *Classifier.* A linear (logistic) model on the voters' votes, trained on the posterior labels.

It is fitted on a bounded sample: MOST_TOXIC and MOST_CLEAN labelled rows of smallest hash, out of those whose
crc32(doc_id as text) mod 3 isn't 1, of at most MOST_CHARS characters in all. Rows of the two classes get the
weights that the labels give them. Labels, language, source and doc_id are no inputs of a score: a text alone is. Every
whole text is scored.

Defined results: a null text counts as empty and gets the score of a text without any vote; a null doc_id has the
remainder of the empty string and no label; of several labels of one row the largest counts; of several texts of one
doc_id the sample takes the one of smallest hash; without labels of both classes the seed list decides alone. Repeated
rows get the same score.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .arrow import map_texts, text_rows
from .store import written

MOST_TOXIC = 2_500
MOST_CLEAN = 5_000
MOST_CHARS = 64 << 20
HELD_OUT = 1
THRESHOLD = 0.7
#: Lengths of the beginnings of words that may become units; a unit of that kind ends with *.
STEMS = (4, 5, 6, 7)
#: Different words before a unit in toxic texts: at least this many and this share of the toxic texts.
CONTEXTS, CONTEXT_SHARE = 3, 0.002
#: Log of how much likelier a unit must be in toxic texts.
LIFT = 2.5
#: Rates for the seed list where nothing can be estimated: in toxic and in clean texts.
DEFAULT_RATES = (0.2, 0.005)
#: What EM begins with, and the beta prior of the label's rates: it is right this often, a belief as strong as so many rows.
BEGIN, LABELS = 0.95, 20.0
#: A rate begins with this weight at the voter's rate over all texts.
PRIOR = 0.5

# Words that insult, in four languages.
SEEDS = (
    "idiot moron stupid loser scum trash pathetic worthless disgusting clown imbecile dumbass bastard bitch "
    "idiota imbécil estúpido basura asqueroso gilipollas idiote imbécile ordure connard débile minable "
    "dummkopf vollidiot abschaum trottel widerlich wertlos"
).split()
# What patterns fire on.
PATTERNS = {
    "marks": r"!!!",
    "shouting": r"(?:\b[A-ZÄÖÜÉÈÑÓ]{4,}\b\W+){4}",
    "masked": r"\w\*{2,}\w",
    "address": r"(?i)\byou(?: are|'re) (?:an?|such|so)\b",
    "wish": r"(?i)\b(?:go to hell|shut up|get lost|drop dead)\b",
}
WORDS = re.compile(r"[^\W\d_]+")


def units_of(word: str) -> list[str]:
    return [word, *[word[:k] + "*" for k in STEMS if len(word) > k]]


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def mine(toxic: list[str], clean: list[str]) -> list[str]:
    """Units that toxic texts have far more often, the strongest first."""
    least = max(CONTEXTS, round(CONTEXT_SHARE * len(toxic)))
    there: dict[str, int] = defaultdict(int)
    for t in toxic:
        for u in {u for w in set(words_of(t)) for u in units_of(w)}:
            there[u] += 1
    there = {u: n for u, n in there.items() if n >= least}
    elsewhere = dict.fromkeys(there, 0)
    for t in clean:
        for u in {u for w in set(words_of(t)) for u in units_of(w)} & there.keys():
            elsewhere[u] += 1
    lifts = {u: math.log((n + 0.5) / (len(toxic) + 1) / ((elsewhere[u] + 0.5) / (len(clean) + 1))) for u, n in there.items()}
    before: dict[str, set[str]] = {u: set() for u, lift in lifts.items() if lift >= LIFT}
    for t in toxic:
        last = ""
        for w in words_of(t):
            for u in units_of(w):
                if u in before:
                    before[u].add(last)
            last = w
    found = [(lifts[u] * math.sqrt(there[u]), u) for u, c in before.items() if len(c) >= least]
    return [u for _, u in sorted(found, key=lambda x: (-x[0], x[1]))]


class Voters:
    """Which voters fire on a text."""

    def __init__(self, units: list[str]):
        self.units = list(dict.fromkeys([*SEEDS, *units]))
        self.names = [*self.units, *PATTERNS]
        self.words = {u: i for i, u in enumerate(self.units) if u[-1] != "*"}
        self.stems = {u[:-1]: i for i, u in enumerate(self.units) if u[-1] == "*"}
        self.lengths = sorted({len(s) for s in self.stems})
        self.patterns = [re.compile(p) for p in PATTERNS.values()]
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = [self.words[word]] if word in self.words else []
        found += [self.stems[word[:k]] for k in self.lengths if word[:k] in self.stems]
        if len(self.known) > 300_000:
            self.known.clear()
        if len(word) < 40:
            self.known[word] = tuple(found)
        return tuple(found)

    def fire(self, text: str) -> list[int]:
        known, of_word = self.known, self.of_word
        out: set[int] = set()
        for w in set(WORDS.findall(text.lower())):
            found = known.get(w)
            if found is None:
                found = of_word(w)
            if found:
                out.update(found)
        n = len(self.units)
        if "!!!" in text:
            out.add(n)
        out.update(n + i for i, p in enumerate(self.patterns) if i and p.search(text))
        return sorted(out)

    def votes(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.names)), np.float32)
        for row, t in enumerate(texts):
            out[row, self.fire(t)] = 1
        return out


def parents_of(votes: np.ndarray, post: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of each voter the one that its rate depends on, -1 for none: a tree of largest mutual information given the class."""
    m, total = votes.shape[1], weights.sum()
    told = np.zeros((m, m))
    for p in (post * weights, (1 - post) * weights):
        size = max(p.sum(), 1e-9)
        one = p @ votes / size
        both = (votes * p[:, None]).T @ votes / size
        for cell, x, y in ((both, one[:, None], one[None, :]), (one[:, None] - both, one[:, None], 1 - one[None, :]), (one[None, :] - both, 1 - one[:, None], one[None, :]), (1 - one[:, None] - one[None, :] + both, 1 - one[:, None], 1 - one[None, :])):
            with np.errstate(divide="ignore", invalid="ignore"):
                part = cell * np.log(cell / (x * y))
            told += size * np.where((cell > 1e-12) & np.isfinite(part), part, 0.0)
    parent = np.full(m, -1)
    least = math.log(max(total, 2.0))  # what two more rates must tell (BIC)
    # Prim's tree, cut where a link tells less.
    best, link, left = np.full(m, -np.inf), np.full(m, -1), np.ones(m, bool)
    for _ in range(m):
        j = int(np.where(left, np.where(np.isfinite(best), best, -1.0), -np.inf).argmax())
        left[j] = False
        parent[j] = link[j] if best[j] > least else -1
        nearer = left & (told[j] > best)
        best[nearer], link[nearer] = told[j][nearer], j
    return parent


class LabelModel:
    """Rates ``[class, parent fires, voter]``, those of the given label, and the share of toxic texts; ``parent`` as in ``parents_of``."""

    def __init__(self, parent: np.ndarray, votes: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        self.parent, self.votes, self.labels, self.weights = parent, votes, labels, weights
        self.base = np.average(votes, axis=0, weights=weights)
        self.above = np.where(parent >= 0, votes[:, np.maximum(parent, 0)], 0)  # never, without a parent
        self.both = votes * self.above
        self.rates, self.given, self.prior = np.full((2, 2, len(parent)), 0.5), np.array([0.5, 0.5]), 0.5

    def learn(self, post: np.ndarray) -> None:
        """The rates that fit the posteriors best, given their beta priors."""
        known = self.labels >= 0
        for c, p in ((1, post * self.weights), (0, (1 - post) * self.weights)):
            fired, above, both = p @ self.votes, p @ self.above, p @ self.both
            self.rates[c, 1] = (both + PRIOR * self.base) / (above + PRIOR)
            self.rates[c, 0] = (fired - both + PRIOR * self.base) / (p.sum() - above + PRIOR)
            self.given[c] = (p[known] @ (self.labels[known] == 1) + LABELS * (BEGIN if c else 1 - BEGIN)) / (p[known].sum() + LABELS)
        self.prior = float((post * self.weights).sum() / self.weights.sum())

    def log_joint(self) -> np.ndarray:
        """(rows, 2): logarithm of the probability of votes, label and class."""
        out = []
        for c, prior in ((0, 1 - self.prior), (1, self.prior)):
            r = np.clip(self.rates[c], 1e-9, 1 - 1e-9)
            yes, no = np.log(r), np.log1p(-r)
            votes = no[0].sum() + self.votes @ (yes[0] - no[0]) + self.above @ (no[1] - no[0]) + self.both @ (yes[1] - no[1] - yes[0] + no[0])
            label = np.array([math.log(1 - self.given[c]), math.log(self.given[c]), 0.0])[self.labels]
            out.append(math.log(max(prior, 1e-9)) + votes + label)
        return np.stack(out, axis=1)

    def posterior(self) -> np.ndarray:
        j = self.log_joint()
        return 1 / (1 + np.exp(np.clip(j[:, 0] - j[:, 1], -30, 30)))

    def objective(self) -> float:
        """What EM makes larger: the logarithm of the likelihood, and of the beta priors."""
        j = self.log_joint()
        r = np.clip(self.rates, 1e-9, 1 - 1e-9)
        begin = np.array([1 - BEGIN, BEGIN])
        priors = PRIOR * (self.base * np.log(r) + (1 - self.base) * np.log1p(-r)).sum() + LABELS * (begin * np.log(self.given) + (1 - begin) * np.log1p(-self.given)).sum()
        return float((self.weights * np.logaddexp(j[:, 0], j[:, 1])).sum() + priors)


def label_model(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, LabelModel, list[float]]:
    """Posterior probability of the toxic class of each row, the model, and its objective after each round. ``labels``: 1 toxic, 0 clean, -1 unknown."""
    votes = votes.astype(np.float64)
    known = labels >= 0
    begin = np.where(labels > 0, BEGIN, 1 - BEGIN)
    first = LabelModel(np.full(votes.shape[1], -1), votes, labels, weights)
    first.weights = weights * known
    first.learn(begin)
    post = np.where(known, begin, first.posterior())
    model = LabelModel(parents_of(votes, post, weights), votes, labels, weights)
    seen: list[float] = []
    for _ in range(rounds):
        model.learn(post)
        post = model.posterior()
        seen.append(model.objective())
        if len(seen) > 1 and seen[-1] - seen[-2] < 1e-7 * abs(seen[-2]):
            break
    return post, model, seen


def logistic(x: np.ndarray, y: np.ndarray, sample: np.ndarray, ridge: float = 0.03, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton steps; ``sample`` weighs the rows."""
    x1 = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    w = np.zeros(x1.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        h = (x1 * (sample * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1 + np.diag(penalty)
        step = np.linalg.solve(h, x1.T @ (sample * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(toxic: list[str], clean: list[str], toxic_share: float) -> tuple[list[str], list[float], float]:
    """(units, weights of their voters, intercept) from labelled texts; ``toxic_share`` is that of all labelled rows."""
    if not toxic or not clean:
        weight = math.log(DEFAULT_RATES[0] / DEFAULT_RATES[1])
        return [], [weight + 2.0] * len(SEEDS) + [0.0] * len(PATTERNS), -weight
    units = mine(toxic, clean)
    votes = Voters(units).votes(toxic + clean)
    labels = np.array([1] * len(toxic) + [0] * len(clean))
    # The sample holds other shares of the classes than the labels do.
    weights = np.where(labels > 0, toxic_share / len(toxic), (1 - toxic_share) / len(clean)) * len(labels)
    post, _, _ = label_model(votes, labels, weights)
    found, intercept = logistic(votes, post, weights)
    # A voter that never fired here knows what it knew before.
    silent = votes.sum(axis=0) == 0
    found[: len(SEEDS)][silent[: len(SEEDS)]] = math.log(DEFAULT_RATES[0] / DEFAULT_RATES[1]) + 1.0
    return units, found.tolist(), intercept


def remainder(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[str], list[str], float]:
    """Toxic and clean texts of the bounded sample, and the toxic share of all labelled rows that may be learnt from."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id is not null and toxic is not null")
    known = known.where(remainder(F.col("id")) != HELD_OUT).groupBy("id").agg(F.max("toxic").alias("toxic"))
    n, n_toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not n_toxic or n == n_toxic:
        return [], [], 0.0
    order = F.xxhash64("id")
    rows = text_rows(docs, id_col, text_col).where("id is not null")
    sample = known.where("toxic = 1").orderBy(order, "id").limit(MOST_TOXIC).union(known.where("toxic = 0").orderBy(order, "id").limit(MOST_CLEAN))
    texts = rows.join(F.broadcast(sample), "id").groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    texts = written(texts, "toxicity-texts")
    # Rows and characters that come to the driver are bounded.
    chars, ids = 0, []
    for r in sorted(texts.select("id", F.xxhash64("id").alias("order"), F.length("text").alias("chars")).collect(), key=lambda r: (r.order, r.id)):
        chars += r.chars
        if chars > MOST_CHARS:
            break
        ids.append((r.id,))
    if len(ids) < texts.count():
        texts = texts.join(F.broadcast(docs.sparkSession.createDataFrame(ids, "id long")), "id")
    found = texts.orderBy("id").collect()
    return [r.text for r in found if r.toxic == 1], [r.text for r in found if r.toxic != 1], n_toxic / n


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, fired`` (names of the voters that fired) of every whole text."""
    toxic, clean, share = training_rows(docs, labels, id_col, text_col)
    units, weights, intercept = fit(toxic, clean, share)

    def make():
        voters = Voters(units)

        def work(_, texts):
            fired = [voters.fire(t) for t in texts]
            p = [1 / (1 + math.exp(-max(-30.0, min(30.0, intercept + sum([weights[i] for i in f]))))) for f in fired]
            return [p, [int(x >= THRESHOLD) for x in p], [[voters.names[i] for i in f] for f in fired]]

        return work

    out = map_texts(text_rows(docs, id_col, text_col), "doc_id long, score double, predicted int, fired array<string>", make)
    return out.select("doc_id", (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", "predicted", "fired")
