"""Operator 10, toxicity by weak supervision.

Voters: every lexicon voter fires on one word or word beginning (written
``stem*``), from a fixed list of insults and from those mined in the training
rows (found in many different toxic and few clean training texts); pattern
voters fire on shouting, runs of exclamation marks, stretched letters, direct
address, insults after "you" and several different insults. Each voter fires
or abstains.

Label model: a two-class generative model. It starts from the gold labels
and estimates the correlation of every pair of voters within the classes; a
voter's evidence is divided by the sum of its strong correlations, so voters
that repeat each other count once. EM over the training sample then estimates the
class balance and, for each voter, how often it fires in either class (its
accuracy); the gold label takes part as one more voter, also with errors.

Classifier: logistic regression on the same votes plus their share among the
words, fitted to the posterior labels. It never sees label, language, source
or id. A text's score is its probability.

Training uses a bounded sample of the labelled rows: about
``max_train_rows`` of each class, by a hash of the id. Mining counts words in
Spark; a word's support is the number of different *sketches* (the smallest
shingle hash of a text) it occurs in, so a group of near copies counts about
once. The driver gets at most ``max_voters`` words and the sample's votes.
Scoring is one map pass over all whole texts.

Defined cases: null and empty texts have no votes and get the base score of
the model. Rows without a label, with a null label, or held out are not
learned from; with no training rows the fixed insults alone decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_pass, col, written
from .language_id import bounded_sample, held_out

#: Fixed insults (English, German, French, Spanish).
INSULTS = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "trash", "scum", "worthless",
    "pathetic", "disgusting", "clown", "garbage", "filth", "vermin", "imbecile", "dimwit", "bastard", "jerk",
    "dummkopf", "trottel", "abschaum", "arschloch", "blödmann", "widerlich",
    "imbécile", "crétin", "connard", "salaud", "ordure", "abruti",
    "imbécil", "estúpido", "estúpida", "cretino", "basura", "escoria", "gilipollas",
)
YOU = frozenset(("you", "your", "youre", "du", "dich", "tu", "vous", "toi", "tú", "usted", "eres"))
WORD = re.compile(r"[^\W_]+")
BANGS = re.compile(r"!{3,}")
STRETCHED = re.compile(r"(\w)\1{3,}")
ASCII = re.compile(r"[\x00-\x7f]+")
#: The ASCII characters that are no letters, and those that are no capitals.
NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
NO_CAPITALS = bytes(c for c in range(128) if not chr(c).isupper())
PATTERNS = ("shouting", "bangs", "stretched", "address", "insult_after_you", "several_insults")
#: Lengths of the word beginnings that may become voters.
STEMS = (4, 5, 6)
#: Jaccard similarity of five-word shingles from which on training texts are near copies.
SIMILARITY = 0.8
#: Correlation within the classes from which on two voters share their evidence.
REPEATS = 0.6
#: Strength of the L2 penalty of the classifier.
PENALTY = 0.05


def cases(text: str) -> tuple[int, int]:
    """How many letters and how many upper-case characters the whole text holds."""
    plain = text.encode("ascii", "ignore")
    letters, capitals = len(plain.translate(None, NO_LETTERS)), len(plain.translate(None, NO_CAPITALS))
    if len(plain) < len(text):
        rest = ASCII.sub("", text)
        letters, capitals = letters + sum(map(str.isalpha, rest)), capitals + sum(map(str.isupper, rest))
    return letters, capitals


class Voters:
    """The lexicon voters by name, ready for lookup."""

    def __init__(self, names: list[str]):
        self.names = names
        self.words = {n: i for i, n in enumerate(names) if not n.endswith("*")}
        self.stems: dict[int, dict[str, int]] = {k: {} for k in STEMS}
        for i, n in enumerate(names):
            if n.endswith("*"):
                self.stems[len(n) - 1][n[:-1]] = i

    def of(self, word: str) -> list[int]:
        found = [self.words[word]] if word in self.words else []
        for k, stems in self.stems.items():
            if word[:k] in stems:
                found.append(stems[word[:k]])
        return found


def features(text: str, voters: Voters) -> np.ndarray:
    """Votes (lexicon, then patterns), strength of the hits, constant."""
    words = WORD.findall(text.lower())
    distinct = set(words)
    n = len(voters.names)
    out = np.zeros(n + len(PATTERNS) + 3, np.float32)
    hits = set()
    for w in distinct:
        for i in voters.of(w):
            out[i] = 1
            hits.add(w)
    bangs = BANGS.search(text) is not None
    letters, capitals = cases(text)
    out[n] = letters > 20 and capitals > 0.6 * letters
    out[n + 1] = bangs
    out[n + 2] = STRETCHED.search(text) is not None
    out[n + 3] = not YOU.isdisjoint(distinct)
    if hits and out[n + 3]:
        out[n + 4] = any(a in YOU and b in hits for a, b in zip(words, words[1:], strict=False))
    out[n + 5] = len(hits) > 1
    out[n + 6] = min(50 * len(hits) / max(1, len(distinct)), 3.0)
    out[n + 7] = min(len(hits), 5.0)
    out[n + 8] = 1
    return out


def shingle_hashes(text: str) -> list[int]:
    """Hashes of the distinct five-word shingles (of all words where there are fewer), ascending."""
    from xxhash import xxh64_intdigest

    w = WORD.findall(text.lower())
    found = {xxh64_intdigest(" ".join(s)) >> 1 for s in zip(w, w[1:], w[2:], w[3:], w[4:], strict=False)}
    return sorted(found or {xxh64_intdigest(" ".join(w)) >> 1})


def voter_units(text: str) -> list[str]:
    """The words and word beginnings of a text."""
    distinct = set(WORD.findall(text.lower()))
    return sorted(distinct.union(x[:k] + "*" for x in distinct for k in STEMS if len(x) >= k))


def apart(shingles: Iterable[set[int]]) -> list[int]:
    """Of texts in order those with a Jaccard similarity below 0.8 to each one taken before."""
    taken: dict[int, set[int]] = {}
    for i, own in enumerate(shingles):
        if all(len(own & other) < SIMILARITY * len(own | other) for other in taken.values()):
            taken[i] = own
    return list(taken)


def mined_voters(sample: DataFrame, *, max_voters: int, min_support: int) -> list[str]:
    """Words and word beginnings that mark toxic training texts, near copies counted once.

    Near copies meet by their least shingle hash (two texts of similarity 0.8
    or more share it in four of five cases); only those verified by their
    shingles collapse. A group is at most the bounded sample.
    """

    def sketched():
        def run(texts: pa.Array) -> list:
            found = [shingle_hashes(t) for t in texts.fill_null("").to_pylist()]
            return [[np.array(s, ">u8").tobytes() for s in found], [s[0] for s in found]]

        return run

    def collapse(key: tuple, rows: pa.Table) -> pa.Table:
        column = rows.column("shingles").combine_chunks()
        order = np.argsort(np.array([x.as_py() for x in column], object), kind="stable").tolist()
        kept = apart(set(np.frombuffer(column[i].as_py(), ">u8").tolist()) for i in order)
        return rows.select(["toxic", "text"]).take(pa.array([order[i] for i in kept], pa.int64()))

    def units():
        return lambda texts: [[voter_units(t) for t in texts.to_pylist()]]

    seen = arrow_pass(sample, ["toxic", "text"], "text", sketched, "shingles binary, sketch long")
    seen = seen.select(F.col("row.toxic").alias("toxic"), F.col("row.text").alias("text"), "out.*")
    alone = seen.dropDuplicates(["toxic", "sketch", "shingles"])  # copies cost a group nothing
    kept = alone.groupBy("toxic", "sketch").applyInArrow(collapse, "toxic boolean, text string")
    seen = arrow_pass(kept, ["toxic"], "text", units, "units array<string>")
    seen = written(seen.select("row.toxic", "out.units"), "toxicity-sketches")
    sizes = {bool(r["toxic"]): r["n"] for r in seen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    if not n1 or not n0:
        return []
    counts = seen.select("toxic", F.explode("units").alias("w")).groupBy("w").agg(
        F.sum(F.when(F.col("toxic"), 1).otherwise(0)).alias("in1"), F.sum(F.when(F.col("toxic"), 0).otherwise(1)).alias("in0")
    )
    rate1, rate0 = (F.col("in1") + 0.5) / (n1 + 1.0), (F.col("in0") + 0.5) / (n0 + 1.0)
    best = (
        counts.filter(F.col("in1") >= min_support)
        .withColumn("odds", F.log(rate1 / rate0))
        .withColumn("strength", F.col("in1") * F.col("odds"))
        .filter((F.col("odds") >= np.log(8.0)) & (F.col("strength") >= 10.0))
        .orderBy(F.desc("strength"), "w")
        .limit(max_voters)
    )
    return [r["w"] for r in best.select("w").collect()]


def label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, dict]:
    """Posterior probability of the toxic class and the fitted accuracies and correlations.

    ``gold`` holds 0 or 1; it is one more voter, whose errors are estimated too.
    """
    seen = np.concatenate([votes, gold[:, None]], axis=1).astype(np.float64)
    post = np.where(gold > 0, 0.95, 0.05)
    weight = np.ones(seen.shape[1])
    correlation = np.eye(seen.shape[1])
    for step in range(rounds):
        prior = np.clip(post.mean(), 0.01, 0.99)
        rate1 = (post @ seen + 0.5) / (post.sum() + 1)
        rate0 = ((1 - post) @ seen + 0.5) / ((1 - post).sum() + 1)
        if step == 0:  # while the posteriors are the gold labels and no voter has taken over a class
            rest = seen - np.outer(post, rate1) - np.outer(1 - post, rate0)
            cov = rest.T @ rest / len(rest)
            dev = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            correlation = cov / np.outer(dev, dev)
            np.fill_diagonal(correlation, 1.0)
            strong = np.where(correlation > REPEATS, correlation, 0.0)
            weight = 1.0 / np.maximum(strong.sum(axis=1), 1.0)
        on = np.log(rate1 / rate0) * weight
        off = np.log((1 - rate1) / (1 - rate0)) * weight
        score = np.log(prior / (1 - prior)) + seen @ (on - off) + off.sum()
        post = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return post, {"rate1": rate1, "rate0": rate0, "correlation": correlation, "prior": prior}


def fit_linear(x: np.ndarray, target: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps with an L2 penalty."""
    w = np.zeros(x.shape[1])
    x = x.astype(np.float64)
    penalty = np.full(x.shape[1], PENALTY)
    penalty[-1] = 1e-4
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_train_rows: int = 4000,
    max_voters: int = 300,
    min_support: int = 20,
) -> dict:
    """The model: voters and classifier weights.

    Bounds, the same at every size of the tables: about ``max_train_rows`` rows
    of each label are learned from, a mined voter stands in ``min_support`` of
    them that are no near copies, and the ``max_voters`` strongest are kept.
    """
    # the sample of labels is bounded, so it may be broadcast; texts are not shuffled
    gold = labels.select(col(id_col).alias("id"), (col(label_col) > 0).alias("toxic"))
    gold = gold.filter(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("id")))
    gold = gold.groupBy("id").agg(F.max("toxic").alias("toxic"))
    gold = written(bounded_sample(gold, F.col("toxic"), F.col("id"), max_train_rows).select("id", "toxic"), "toxicity-labels")
    texts = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    sample = written(texts.join(F.broadcast(gold), "id").select("id", "text", "toxic"), "toxicity-sample")
    mined = mined_voters(sample, max_voters=max_voters, min_support=min_support)
    names = list(dict.fromkeys([*INSULTS, *mined]))

    def make():
        voters = Voters(names)

        def run(values: pa.Array) -> list:
            return [[features(t, voters).tolist() for t in values.to_pylist()]]

        return run

    made = arrow_pass(sample, ["id", "toxic"], "text", make, "x array<float>")
    rows = made.select("row.id", "row.toxic", "out.x").orderBy("id").toPandas()  # at most about 2 * max_train_rows
    if len(rows) == 0 or rows["toxic"].nunique() < 2:
        return {"voters": names, "weights": _insults_only(names)}
    x = np.stack(rows["x"].to_numpy())
    y = rows["toxic"].to_numpy().astype(np.float64)
    post, _ = label_model(x[:, : len(names) + len(PATTERNS)], y)
    return {"voters": names, "weights": fit_linear(x, post)}


def _insults_only(names: list[str]) -> np.ndarray:
    w = np.zeros(len(names) + len(PATTERNS) + 3)
    w[: len(names)] = 2.0
    w[-1] = -1.0
    return w


def score(docs: DataFrame, model: dict, *, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``row`` and ``out.score`` per document."""
    names, weights = model["voters"], np.asarray(model["weights"])

    def make():
        voters = Voters(names)
        base = float(features("", voters) @ weights)

        def run(texts: pa.Array) -> list:
            out = []
            for text in texts.to_pylist():
                z = float(features(text, voters) @ weights) if text else base
                out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            return [pa.array(np.asarray(out, np.float64))]

        return run

    return arrow_pass(docs, keep or docs.columns, text_col, make, "score double")


def drop_toxic(docs: DataFrame, model: dict, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents scored below ``threshold``, with all their columns."""
    return score(docs, model, text_col=text_col).filter(F.col("out.score") < threshold).select("row.*")
