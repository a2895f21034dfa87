"""Toxicity by weak supervision.

1. Voters. Lexicons of words and word beginnings are mined from a bounded
   sample of labelled rows by sequential covering (an entry must explain
   toxic rows that no entry before it explains); they are dealt to
   `LEXICONS` voters. Pattern voters look at capitals, exclamation marks,
   abuse of a "you", masked words, and at texts without any of these.
2. Label model. A generative model of the votes given the hidden label is
   fitted by expectation maximisation on the counts of all vote patterns of
   all documents: voter accuracies, and joint tables for groups of voters
   that are correlated beyond the label. Labels fix the class of their rows.
3. Classifier. A sparse logistic regression on votes and hashed words learns
   the model's posterior labels from a bounded sample; its bias is set back
   to the share of toxic rows that the label model found in all documents.

Labels are read for rows with crc32(doc_id as text) mod 4 other than 2 only;
label, language, source and doc_id are no inputs of a score.
"""

from __future__ import annotations

import heapq
import io
import json
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import crc_mod4, materialize, worker_tool
from callscope.llm.langid import bounded_sample, fit_ftrl
from callscope.llm.tokens import Generations

#: Bounds of the samples that lexicons and classifier are fitted on.
LEXICON_ROWS_PER_LABEL = 4_000
CLASSIFIER_ROWS_PER_CLASS = 4_000
LEXICONS = 6
HASHED = 1 << 16
#: Words of a worker's cache; texts that a task holds as strings at once.
WORDS_CACHED = 80_000
SLICE_ROWS = 512
PREFIXES = (4, 5, 6)
EDGE = ".,;:!?\"'()[]{}<>*#%&$|-_…«»“”’"
ABUSE = re.compile(r"\b(?:you|u|ya)(?:'re| are| r)? (?:an? |all |such an? )?\w+(?: \w+)?!|\bshut up\b|\bhate (?:you|them)\b", re.I)
MASKED = re.compile(r"\b\w[*@#$%]{2,}\w*\b")
VOTERS = tuple(f"lexicon{i}" for i in range(LEXICONS)) + ("capitals", "exclaims", "abuse", "masked", "plain")


def distinct_words(text: str) -> set[str]:
    """Distinct lower-case words of a whole text without punctuation around them."""
    return {w.strip(EDGE) for w in set(text.lower().split())} - {""}


def terms(words) -> set[str]:
    """Words, and word beginnings (with a trailing *)."""
    out = set(words)
    for w in words:
        out.update(w[:n] + "*" for n in PREFIXES if len(w) > n)
    return out


def _log_tail(hits: int, total: int, p: float) -> float:
    """log of the chance of at least `hits` of `total` at rate p (its largest terms)."""
    best = [lgamma(total + 1) - lgamma(k + 1) - lgamma(total - k + 1) + k * log(p) + (total - k) * log(1 - p)
            for k in range(hits, min(total, hits + 50) + 1)]
    top = max(best)
    return top + log(sum(exp(b - top) for b in best))


def mine_lexicon(toxic: list[str], clean: list[str], least: int = 3, significance: float = -16.0,
                 precision: float = 0.7, entries: int = 400) -> list[str]:
    """Terms that tell toxic from clean texts, by sequential covering: the
    term that explains most unexplained toxic texts comes next, if it is
    significant (log p) and precise at equal shares of both classes."""
    toxic, clean = list(dict.fromkeys(toxic)), list(dict.fromkeys(clean))
    if not toxic or not clean:
        return []
    holds: dict[str, list[int]] = {}
    for i, t in enumerate(toxic):
        for term in terms(distinct_words(t)):
            holds.setdefault(term, []).append(i)
    holds = {t: h for t, h in holds.items() if len(h) >= least}
    bad: Counter = Counter()
    for t in clean:
        bad.update(x for x in terms(distinct_words(t)) if x in holds)
    rate = len(toxic) / (len(toxic) + len(clean))

    def gain(term: str, new: int) -> float:
        share = new / len(toxic), (bad[term] + 0.5) / len(clean)
        if new < least or share[0] / (share[0] + share[1]) < precision:
            return 0.0
        return new if _log_tail(new, new + bad[term], rate) < significance or (
            bad[term] == 0 and new >= 8) else 0.0

    left = set(range(len(toxic)))
    heap = [(-g, len(t), t) for t, h in holds.items() if (g := gain(t, len(h)))]
    heapq.heapify(heap)
    out: list[str] = []
    while heap and len(out) < entries:
        g, n, t = heapq.heappop(heap)
        now = gain(t, sum(i in left for i in holds[t]))
        if not now:
            continue
        if heap and (-now, n, t) > heap[0]:
            heapq.heappush(heap, (-now, n, t))
            continue
        out.append(t)
        left.difference_update(holds[t])
    return out


class Voters:
    """Votes of a text: 1 toxic, 0 none, -1 clean, in the order of VOTERS;
    and its hashed words."""

    def __init__(self, lexicon: list[str]):
        self.of = {t: i % LEXICONS for i, t in enumerate(lexicon)}
        self.cache = Generations(self._word, WORDS_CACHED)

    def _word(self, w: str) -> int:
        mask = 0
        for t in (w, *(w[:n] + "*" for n in PREFIXES if len(w) > n)):
            if t in self.of:
                mask |= 1 << self.of[t]
        first = xxhash.xxh3_64_intdigest(w) % HASHED
        second = xxhash.xxh3_64_intdigest(w[:5] + "*") % HASHED
        return mask << 40 | first << 20 | second

    def read(self, text: str) -> tuple[tuple[int, ...], np.ndarray]:
        words = distinct_words(text)
        packed = np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))
        mask = int(np.bitwise_or.reduce(packed >> 40)) if len(packed) else 0
        lexical = [1 if mask >> i & 1 else 0 for i in range(LEXICONS)]
        n = max(1, len(text))
        capitals = sum(map(text.count, "AEIOUÄÖÜÉÈÑÓÍ")) > 2 * sum(map(text.count, "aeiouäöüéèñóí")) and n > 20
        exclaims = text.count("!") * 40 > n
        abuse = bool("ou" in text and "!" in text and ABUSE.search(text))
        masked = bool(("**" in text or "@#" in text) and MASKED.search(text))
        plain = -1 if not mask and not exclaims and not capitals else 0
        votes = (*lexical, int(capitals), int(exclaims), int(abuse), int(masked), plain)
        features = np.unique(np.concatenate([packed >> 20 & 0xFFFFF, packed & 0xFFFFF])) if len(packed) else packed
        return votes, features


@dataclass
class LabelModel:
    """Class share, and a table of vote combinations given the label for
    every group of voters (one voter, or correlated ones together)."""

    groups: list[tuple[int, ...]]
    share: float
    tables: list[dict] = field(default_factory=list)

    def posterior(self, votes: tuple[int, ...]) -> float:
        """P(toxic | votes)."""
        score = log(self.share) - log(1 - self.share)
        for g, table in zip(self.groups, self.tables):
            clean, toxic = table.get(tuple(votes[i] for i in g), (1e-6, 1e-6))
            score += log(toxic) - log(clean)
        return 1 / (1 + exp(-max(-60.0, min(60.0, score))))


def _expect_maximise(patterns: list, groups: list[tuple[int, ...]], rounds: int = 60) -> LabelModel:
    """`patterns`: (votes, label or None, count)."""
    weight = np.array([c for _, _, c in patterns], float)
    known = np.array([-1 if y is None else y for _, y, _ in patterns])
    votes = np.array([v for v, _, _ in patterns])
    # from the votes' polarity: one toxic vote outweighs one clean vote
    q = 1 / (1 + np.exp(-(2.0 * (votes > 0).sum(1) - 1.5 * (votes < 0).sum(1) - 1.0)))
    combos = []
    for g in groups:
        values, index = np.unique(votes[:, g], axis=0, return_inverse=True)
        combos.append((values, index.ravel()))
    for _ in range(rounds):
        q = np.where(known >= 0, known, q)
        share = min(0.999, max(1e-4, float((q * weight).sum() / weight.sum())))
        score, tables = np.full(len(q), log(share) - log(1 - share)), []
        for values, index in combos:
            toxic = np.bincount(index, q * weight, len(values)) + 0.5
            clean = np.bincount(index, (1 - q) * weight, len(values)) + 0.5
            toxic, clean = toxic / toxic.sum(), clean / clean.sum()
            score += (np.log(toxic) - np.log(clean))[index]
            tables.append({tuple(v): (float(c), float(t)) for v, c, t in zip(values.tolist(), clean, toxic)})
        new = 1 / (1 + np.exp(-np.clip(score, -60, 60)))
        if np.abs(np.where(known >= 0, known, new) - q).max() < 1e-6:
            q = new
            break
        q = new
    return LabelModel(groups, share, tables)


def fit_label_model(patterns: list, correlated: float = 0.2, largest: int = 3) -> LabelModel:
    """Fit with independent voters; then, as long as the votes of two groups
    stay correlated given the label, join the two most correlated ones (to
    groups of at most `largest`) and fit again."""
    n = len(patterns[0][0])
    votes = np.array([v for v, _, _ in patterns], float)
    weight = np.array([c for _, _, c in patterns], float)
    groups = [(i,) for i in range(n)]
    while True:
        model = _expect_maximise(patterns, groups)
        q = np.array([model.posterior(v) if y is None else y for v, y, _ in patterns])
        strength = np.zeros((n, n))
        for w in (q * weight, (1 - q) * weight):
            if w.sum() < 50:
                continue
            centred = votes - (votes * w[:, None]).sum(0) / w.sum()
            cov = (centred * w[:, None]).T @ centred / w.sum()
            sd = np.sqrt(np.diag(cov))
            strength = np.maximum(strength, np.abs(cov) / np.maximum(np.outer(sd, sd), 1e-6))
        pairs = [(max(strength[i, j] for i in g for j in h), g, h) for g, h in combinations(groups, 2)
                 if len(g) + len(h) <= largest]
        best = max(pairs, default=(0.0, (), ()))
        if best[0] < correlated:
            return model
        groups = sorted([g for g in groups if g not in best[1:]] + [tuple(sorted(best[1] + best[2]))])


@dataclass
class Scorer:
    """Lexicon, label model and the linear classifier on votes and words."""

    lexicon: list[str]
    label_model: LabelModel
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.voters = Voters(self.lexicon)

    def score(self, text: str) -> float:
        idx, val = features(*self.voters.read(text))
        z = float(val @ self.weights[idx]) + self.bias
        return 1 / (1 + exp(-max(-60.0, min(60.0, z))))


def features(votes: tuple[int, ...], hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse input of the classifier: votes at full size, then the words,
    together of length one."""
    cast = [(HASHED + 2 * i + (v < 0)) for i, v in enumerate(votes) if v]
    idx = np.concatenate([hashed, np.array(cast, np.int64)])
    val = np.concatenate([np.full(len(hashed), 1 / max(1.0, len(hashed)) ** 0.5), np.ones(len(cast))])
    return idx, val


WIDTH = HASHED + 2 * len(VOTERS)


def train_scorer(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 label: str = "toxic") -> Scorer:
    """Fit on documents and their labels (0 or 1; of several labels of a
    document the largest counts). Without both labels the score is 0."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    seen = docs.filter(F.coalesce(crc_mod4(F.col("doc_id")) != 2, F.lit(False)))
    known = (labels.filter(F.col(label).isin(0, 1) & (crc_mod4(F.col(doc_id)) != 2))
             .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(label).cast("int").alias("label")))
    picked = bounded_sample(known, "label", LEXICON_ROWS_PER_LABEL, 2 * LEXICON_ROWS_PER_LABEL)
    # at most 2 * LEXICON_ROWS_PER_LABEL rows
    sample = seen.join(F.broadcast(picked), "doc_id").select("label", "text")

    def mine(batches):
        texts: dict = {0: [], 1: []}
        for batch in batches:
            for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts[y].append(t)
        out = mine_lexicon(sorted(texts[1]), sorted(texts[0]))
        yield pa.RecordBatch.from_pydict({"term": out}, schema=pa.schema([("term", pa.string())]))

    lexicon = [r["term"] for r in sample.repartition(1).mapInArrow(mine, "term string").collect()]

    schema = pa.schema([("doc_id", pa.int64()), ("pattern", pa.string())])

    def vote(batches):
        worker_tool(("votes",), lambda: None)  # what the worker kept for another step goes
        voters = Voters(lexicon)
        for batch in batches:
            # some hundred texts at a time are Python strings
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                out = [json.dumps(voters.read(t.as_py())[0]) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(out)], schema=schema)

    votes = materialize(docs.mapInArrow(vote, "doc_id long, pattern string"), "votes")
    found = votes.join(known, "doc_id", "left").groupBy("pattern", "label").count().collect()
    if not found:
        return Scorer([], LabelModel([], 0.5), np.zeros(WIDTH), -60.0)
    # 2 ** 10 * 3 patterns at most: ten voters say 1 or 0, one says -1 or 0
    patterns = sorted(((tuple(json.loads(r["pattern"])), r["label"], r["count"]) for r in found), key=str)
    model = fit_label_model(patterns)
    posterior = {json.dumps(v): model.posterior(v) for v, _, _ in patterns}
    table = docs.sparkSession.createDataFrame(list(posterior.items()), "pattern string, q double")
    # a sample of each side of the posterior, from the rows whose labels may be read
    sided = (votes.filter(F.coalesce(crc_mod4(F.col("doc_id")) != 2, F.lit(False))).join(F.broadcast(table), "pattern")
             .select("doc_id", "q", (F.col("q") >= 0.5).cast("int").alias("side")))
    picked = bounded_sample(sided, "side", CLASSIFIER_ROWS_PER_CLASS, 2 * CLASSIFIER_ROWS_PER_CLASS).dropDuplicates(["doc_id"])
    sample = seen.join(F.broadcast(picked.select("doc_id", "q")), "doc_id").select("q", "text")
    mean = sum(posterior[json.dumps(v)] * c for v, _, c in patterns) / sum(c for _, _, c in patterns)

    def fit(batches):
        voters, rows = Voters(lexicon), []
        for batch in batches:
            for q, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows.append((q, *features(*voters.read(t))))
        if not rows:
            return
        rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tolist()))
        soft = np.array([[1 - r[0], r[0]] for r in rows])
        w, b = fit_ftrl([(r[1], r[2]) for r in rows], None, 2, WIDTH, alpha=0.3, l1=0.3, l2=0.1, epochs=4, target=soft)
        share = float(np.clip(soft[:, 1].mean(), 1e-4, 1 - 1e-4))
        weights, bias = w[:, 1] - w[:, 0], b[1] - b[0]
        target = float(np.clip(mean, 1e-4, 1 - 1e-4))
        bias += log(target / (1 - target)) - log(share / (1 - share))
        out = io.BytesIO()
        np.savez_compressed(out, weights=weights.astype(np.float32), bias=bias)
        yield pa.RecordBatch.from_pydict({"model": [out.getvalue()]}, schema=pa.schema([("model", pa.binary())]))

    got = sample.repartition(1).mapInArrow(fit, "model binary").collect()
    if not got:
        return Scorer(lexicon, model, np.zeros(WIDTH), -60.0)
    f = np.load(io.BytesIO(bytes(got[0]["model"])))
    return Scorer(lexicon, model, f["weights"].astype(float), float(f["bias"]))


def score(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """`docs` with score (0 to 1; columns of that name are replaced). Null
    text counts as empty; empty texts are scored by the bias and the votes
    alone; rows are scored one by one, whole; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (scorer.lexicon, scorer.label_model, scorer.weights.astype(np.float32), scorer.bias))

    @F.pandas_udf("double")
    def run(texts):
        s = worker_scorer(shared.value)
        return texts.map(lambda t: s.score(t or ""))

    # not deterministic for Spark: otherwise a filter on the score scores once more
    return docs.withColumn("score", run.asNondeterministic()(F.col(text)))


def worker_scorer(parts: tuple) -> Scorer:
    """This Python worker's scorer; `parts` stays alive with it, so its id is its own."""
    return worker_tool(("scorer", id(parts)), lambda: (parts, Scorer(*parts)))[1]
