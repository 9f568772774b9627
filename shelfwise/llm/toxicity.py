"""Toxicity scores of texts restored from obfuscated spelling.

Words written with digits or signs for letters, with letters drawn out or spaced apart are read as
the output of a noisy channel: a lattice of possible letters, decoded by Viterbi under a character
trigram model. A text's evidence is the weight of its strongest words, original and restored, by
their stems; weights and the final score are learned from a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import checkpointed, learned, text_or_empty, with_computed

TRAIN_ROWS = 12_000  # at most about so many labelled rows are learned from
CANDIDATE_SUPPORT = 3
CAUTION = 2.6  # standard errors taken off a stem's log ratio
THRESHOLD = 0.3

# Letters that a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "µ": "u",
}
GAP = " .-_*"
SUBSTITUTION, GAP_COST, REPEAT_COST = 0.7, 0.1, 0.2
MASKS = 4  # a longer run of '*' is a line, not letters
SEEN = 1e-7  # share of all trigrams from which one counts as seen: at most ten million do

SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[\W_]{1,3}[^\W_]){2,}(?![^\W_])")
BETWEEN = re.compile(r"[\W_]+")
DOUBLED = re.compile(r"([^\W\d_])\1")
SIGNS = "".join(x for x in LEET if not x.isalnum()) + "*"
OUTSIDE = re.compile(rf"^[^\w{re.escape(SIGNS)}]+|[^\w{re.escape(SIGNS)}]+$")  # ends that stand for no letter
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


@dataclass
class Letters:
    """Character trigram model with add-one smoothing; ``^`` and ``$`` mark the ends of words."""

    triples: dict[str, int] = field(default_factory=dict)
    pairs: dict[str, int] = field(default_factory=dict)
    followers: dict[str, str] = field(default_factory=dict)
    costs: dict[str, float] = field(default_factory=dict)

    def after(self, before: str) -> str:
        """Letters seen after two others: what a mask may stand for."""
        if not self.followers:
            for gram in self.triples:
                if gram[2] != "$":
                    self.followers[gram[:2]] = self.followers.get(gram[:2], "") + gram[2]
        return self.followers.get(before, "")

    def explain(self, word: str) -> bool:
        """Whether a word reads as it stands: letters in seen order, none doubled."""
        marked = f"^^{word}$"
        return word.isalpha() and not DOUBLED.search(word) and all(marked[i : i + 3] in self.triples for i in range(len(marked) - 2))

    def cost(self, before: str, letter: str) -> float:
        gram = before + letter
        cost = self.costs.get(gram)
        if cost is None:
            cost = self.costs[gram] = -math.log((self.triples.get(gram, 0) + 0.1) / (self.pairs.get(before, 0) + 4.0))
        return cost


class Folding(dict):
    """The class of each sign: letters that one sign may stand for are one, what stands for nothing has none."""

    def __missing__(self, sign: str) -> str:
        self[sign] = sign if sign.isalpha() else ""
        return self[sign]


FOLDED = Folding({sign: min(letters) for sign, letters in LEET.items()} | {"l": "i"})


class Reach:
    """Which stems some reading of a string may reach: a necessary test that needs no decoding.

    Reading a string keeps the classes of its letters, in order, but for repeats, gaps and signs that stand for
    nothing; a mask is any letter or none. So a reading can only begin with a stem, or equal a word, whose classes the
    string's classes begin with, or equal. Stems are kept in a tree by their classes without repeats.
    """

    def __init__(self, stems: Iterable[str]):
        self.root: dict = {}
        self.deepest = 0
        for stem in stems:
            node, last, depth = self.root, "", 0
            for letter in stem[1:]:
                letter = FOLDED[letter]
                if letter and letter != last:
                    node, last, depth = node.setdefault(letter, {"last": letter}), letter, depth + 1
            node["^" if stem[0] == "^" else "="] = True
            self.deepest = max(self.deepest, depth)

    def hit(self, token: str) -> bool:
        if "*" in token:
            return self.hit_masked(token)
        node, last = self.root, ""
        for sign in token:
            letter = FOLDED[sign]
            if letter and letter != last:
                node, last = node.get(letter), letter
                if node is None:
                    return False
                if "^" in node:
                    return True
        return "=" in node

    def hit_masked(self, token: str) -> bool:
        nodes, run = [self.root], 0
        for sign in token:
            run = run + 1 if sign == "*" else 0
            if any("^" in node for node in nodes):
                return True
            if sign == "*":
                if run <= min(self.deepest, MASKS):
                    seen = {id(n): n for node in nodes for n in (node, *(x for k, x in node.items() if len(k) == 1 and k not in "^="))}
                    nodes = list(seen.values())
                continue
            letter = FOLDED[sign]
            if letter:
                nodes = [n for node in nodes for n in (node if node.get("last") == letter else node.get(letter),) if n is not None]
                if not nodes:
                    return False
        return any("^" in node or "=" in node for node in nodes)


def restore(word: str, letters: Letters) -> str:
    """The most likely plain spelling of one obfuscated string (lower case)."""
    paths: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
    i = 0
    while i < len(word):
        sign, run = word[i], 1
        while i + run < len(word) and word[i + run] == sign:
            run += 1
        if sign == "*" and run <= MASKS:
            run = 1
        options: list[tuple[str, float]] = []
        if sign in GAP:
            options.append(("", GAP_COST))
        for letter in LEET.get(sign, sign if sign.isalpha() else ""):
            toll = 0.0 if letter == sign else SUBSTITUTION
            options.append((letter, toll + (REPEAT_COST if run > 1 else 0)))
            if run > 1:
                options.append((letter * 2, toll + (REPEAT_COST if run > 2 else 0)))
        if not options:
            options.append(("", 2.0))
        reached: dict[str, tuple[float, str]] = {}
        for before, (cost, made) in paths.items():
            masked = [(x, SUBSTITUTION) for x in letters.after(before)] if sign == "*" and run == 1 else []
            for text, toll in options + masked:
                state, total = before, cost + toll
                for letter in text:
                    total += letters.cost(state, letter)
                    state = state[1] + letter
                if state not in reached or total < reached[state][0]:
                    reached[state] = (total, made + text)
        paths = reached
        i += run
    return min((cost + letters.cost(state, "$"), made) for state, (cost, made) in paths.items())[1]


def plain(token: str) -> str:
    return token if token.isalpha() else EDGES.sub("", token)


def words_of(text: str, letters: Letters | None, reach: Reach | None = None) -> set[str]:
    """Distinct lower-case words of a text; with a letter model also the restored spellings of spaced letters.

    With ``reach`` only what may reach its stems is restored: all else can't change what the stems find.
    """
    text = text.lower()
    words = set(text.split())
    if letters is not None:
        for found in SPACED.finditer(text):
            if any(c.isalpha() for c in found[0]):
                spaced = BETWEEN.sub(" ", found[0])
                if reach is None or reach.hit(spaced):
                    words.add(restore(spaced, letters))
    return words


def stems(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [f"={word}", *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) > n)]


def spellings(token: str) -> set[str]:
    """A token with the signs at its ends kept or left out: they may stand for letters or not."""
    if token.isalpha():
        return {token}
    inner = OUTSIDE.sub("", token)
    return {token, inner, inner.rstrip("!|+(*"), inner.strip("*"), plain(token)}


def forms(token: str, letters: Letters | None, reach: Reach | None = None) -> set[str]:
    """A token without signs at its ends, and its restored spellings unless the letter model explains it as it stands.

    With ``reach`` only spellings are looked at that may reach its stems.
    """
    spelled = spellings(token)
    if reach is not None:
        spelled = {x for x in spelled if reach.hit(x)}
        if not spelled:
            return set()
    bare = plain(token)
    out = {bare}
    if letters is not None and bare:
        inner = OUTSIDE.sub("", token)
        if inner != bare or not letters.explain(bare):
            out.update(restore(x, letters) for x in spelled)
    return {x for x in out if x}


@dataclass
class Model:
    letters: Letters
    weights: dict[str, float]
    coefficients: tuple[float, ...] | None  # None: nothing was learned, every score is 0
    reach: Reach | None = None

    def __post_init__(self) -> None:
        self.reach = Reach(self.weights)

    def token_weight(self, token: str) -> float:
        if token.isalpha() and not self.reach.hit(token):
            return 0.0
        return max((self.weights.get(s, 0.0) for w in forms(token, self.letters, self.reach) for s in stems(w)), default=0.0)

    def evidence(self, text: str, known: dict[str, float]) -> tuple[float, float, float]:
        """The two largest word weights and the number of words with a large one. ``known`` keeps tokens seen."""
        words = words_of(text, self.letters, self.reach)
        found = list(map(known.get, words))
        if None in found:
            known.update((token, self.token_weight(token)) for token in words if token not in known)
            found = list(map(known.get, words))
        found = [weight for weight in found if weight > 0]
        found.sort(reverse=True)
        first, second = (found + [0.0, 0.0])[:2]
        return first, second, math.log1p(sum(w > 1 for w in found))

    def score(self, text: str, known: dict[str, float]) -> float:
        if self.coefficients is None:
            return 0.0
        signal = self.coefficients[0] + sum(c * x for c, x in zip(self.coefficients[1:], self.evidence(text, known)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, signal))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Newton steps for a ridge logistic regression with intercept."""
    x = np.column_stack((np.ones(len(x)), x))
    beta = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def letter_model(docs: DataFrame) -> Letters:
    """Trigram counts of the distinct words of every text, of those that make up the share ``SEEN`` or more."""

    def trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[int] = Counter()
        words: Counter[str] = Counter()

        def count() -> None:
            found = Counter()
            for word, n in words.items():
                word = plain(word)
                if word.isalpha():
                    found[word] += n
            words.clear()
            if not found:
                return
            points = np.frombuffer("".join(f"^^{w}$" for w in found).encode("utf-32-le"), "<u4").astype(np.int64)
            sizes = np.array([len(w) + 3 for w in found])
            inside = np.ones(len(points), bool)
            inside[np.cumsum(sizes) - 1] = inside[np.cumsum(sizes) - 2] = False  # the last two begin no trigram
            at = np.flatnonzero(inside)
            codes = (points[at] << 42) | (points[at + 1] << 21) | points[at + 2]
            grams, where = np.unique(codes, return_inverse=True)
            totals = np.bincount(where, np.repeat(list(found.values()), sizes - 2)).astype(np.int64)
            counts.update(dict(zip(grams.tolist(), totals.tolist())))

        for batch in batches:
            for text in batch["text"]:
                words.update(set(text.lower().split()))
                if len(words) > 200_000:
                    count()
        count()
        named = ["".join(chr(code >> shift & 0x1FFFFF) for shift in (42, 21, 0)) for code in counts]
        yield pd.DataFrame({"gram": named, "n": list(counts.values())}).astype({"gram": object, "n": "int64"})

    texts = docs.select(text_or_empty().alias("text"))
    counted = checkpointed(texts.mapInPandas(trigrams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    grams = counted.filter(F.col("n") >= SEEN * total).collect()
    letters = Letters({r["gram"]: r["n"] for r in grams})
    for gram, n in letters.triples.items():
        letters.pairs[gram[:2]] = letters.pairs.get(gram[:2], 0) + n
    return letters


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from labelled rows whose crc32(doc_id as text) mod 4 is not 2: about ``train_rows`` at most, by hash of the id.

    A row labelled twice counts with its larger label; null labels and ids teach nothing.
    """
    known = (
        labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").alias("toxic"))
        .filter(F.col("labelled").isNotNull() & F.col("toxic").isNotNull() & learned("labelled", 4, 2))
        .groupBy("labelled")
        .agg(F.max("toxic").alias("toxic"))
    )
    total = known.count()
    share = min(1.0, train_rows / max(total, 1))
    drawn = known.filter(F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = checkpointed(
        docs.select(F.col("doc_id"), text_or_empty().alias("text"))
        .join(F.broadcast(drawn), F.col("doc_id") == F.col("labelled"))
        .select("text", (F.col("toxic") >= 1).cast("int").alias("toxic"))
        .repartition(24)
    )

    letters = letter_model(docs)

    def occurrences(wanted: frozenset[str] | None, toxic: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            counts: Counter[str] = Counter()
            read: dict[str, set[str]] = {}
            reach = None if wanted is None else Reach(wanted)
            for batch in batches:
                for text in batch["text"][batch["toxic"] == toxic]:
                    words = words_of(text, letters, reach)
                    read.update((t, {s for w in forms(t, letters, reach) for s in stems(w)}) for t in words if t not in read)
                    found = {s for t in words for s in read[t]}
                    counts.update(found if wanted is None else found & wanted)
            yield pd.DataFrame({"stem": list(counts), "n": list(counts.values())}).astype({"stem": object, "n": "int64"})

        counted = sample.mapInPandas(run, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))
        return {r["stem"]: r["n"] for r in counted.filter(F.col("n") >= (CANDIDATE_SUPPORT if toxic else 1)).collect()}

    classes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = classes.get(1, 0), classes.get(0, 0)
    if not toxic or not clean:
        return Model(letters, {}, None)
    positive = occurrences(None, 1)
    negative = occurrences(frozenset(positive), 0)
    weights = {}
    for stem, n in positive.items():
        other = negative.get(stem, 0)
        ratio = math.log((n + 0.5) / (toxic + 1)) - math.log((other + 0.5) / (clean + 1))
        weight = ratio - CAUTION * math.sqrt(1 / (n + 0.5) + 1 / (other + 0.5))  # lower bound of the log ratio
        if weight > 0.25:
            weights[stem] = weight
    model = Model(letters, weights, (0.0, 0.0, 0.0, 0.0))

    def evidence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, float] = {}
        for batch in batches:
            rows = np.array([model.evidence(t, seen) for t in batch["text"]]).reshape(-1, 3)
            yield pd.DataFrame({"a": rows[:, 0], "b": rows[:, 1], "c": rows[:, 2], "toxic": batch["toxic"].to_numpy()})

    rows = sample.mapInPandas(evidence, "a double, b double, c double, toxic int").toPandas()
    model.coefficients = logistic(rows[["a", "b", "c"]].to_numpy(), rows["toxic"].to_numpy(float))
    return model


def score(docs: DataFrame, model: Model, into: str = "toxicity", text: str = "text") -> DataFrame:
    """Rows of ``docs`` plus ``into``: a score from 0 to 1, higher where toxic is likelier.

    Whole texts are scored; null and empty ones have no evidence and get the base rate's score. Equal texts
    score alike. A column already named ``into`` is replaced, others are carried along.
    """
    kept = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def compute():
        model, known = pickle.loads(kept.value), {}

        def score_all(texts: list[str | None]) -> list[float]:
            if len(known) > 400_000:  # words seen; only a memory of what the model gives
                known.clear()
            return [model.score(t or "", known) for t in texts]

        return score_all

    return with_computed(docs, into, T.DoubleType(), text, compute)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, whether it was held out, its score, and the decision at ``THRESHOLD``."""
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model, "score").select(
        "doc_id",
        (~learned("doc_id", 4, 2)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
