"""Toxicity of texts: a learned lexicon, misspellings by automaton, and context windows.

Fitting takes a bounded sample of labelled texts (``SAMPLE``, those with the smallest hash
of their id). From it comes the lexicon: whole words which occur in at least ``LEAST_TOXIC``
toxic texts and are ``LIFT`` times as frequent there as in clean ones, and beginnings of
words that do so where no single word does (see ``choose_stems``). A word that begins with
a stem of the lexicon matches it. The stems form a trie.

Scoring walks the trie with a Levenshtein automaton: a state is the set of trie nodes with
the errors so far, and reading a character moves all of them at once. A word matches a stem
exactly or, for stems of ``FUZZY`` letters or more, with one edit inside the stem; a shorter
stem with one edit must be the whole word. The edit may be at the first letter. A word with
an edit that a clean text of the sample holds is an ordinary word and no match. States
are built when first met and remembered, so a word usually costs a few dictionary lookups
before its state is empty.

Every match is weighed by its context: the words ``WINDOW`` to either side and quotation
marks. A match inside quotation marks, or next to words that report speech or deny, is a
quotation and counts apart from open abuse; second-person words next to it count as
address. A logistic regression on these counts and their density, fitted on the sample,
gives the score. Labels, languages, sources and ids are never inputs of a score.

Texts that are null, empty or without a match are scored as texts without matches. With no
toxic or no clean label to learn from, every text gets the share of toxic labels (0 without
labels). Repeated rows give repeated rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.columns import map_arrow

#: Labelled texts that a model is fitted on at most.
SAMPLE = 20_000
LEAST_TOXIC, LIFT = 5, 30.0
SHORTEST, LONGEST = 4, 12
#: Stems a model has at most, the most toxic first.
STEMS = 5_000
FUZZY = 6
#: Ends a whole word; no word holds it.
END = "$"
WINDOW = 6
REMEMBERED = 300_000

WORD = re.compile(r"[^\W_]+")
QUOTES = re.compile('["“”„«»]')
# Words that mark reported speech or denial, and words of address.
REPORTING = frozenset(
    "said says say called calling wrote writes quote quoted quoting term word words slur insult not never no"
    " dit disait appelé mot insulte pas sagte sagt nannte wort nicht dijo dice llamó palabra no".split()
)
ADDRESS = frozenset("you your youre u ur tu te toi vous du dich dein ihr euch tú usted ustedes vosotros".split())
FEATURES = 6


class StemTrie:
    """Stems as a trie whose nodes are numbers; node 0 is the root."""

    def __init__(self, stems: list[str], fuzzy: int = FUZZY):
        self.next: list[dict[str, int]] = [{}]
        self.fuzzy: list[bool] = [False]  # whether a stem below allows an edit
        self.ends: list[bool] = [False]
        for stem in stems:
            node = 0
            for char in stem:
                self.fuzzy[node] = self.fuzzy[node] or len(stem) >= fuzzy
                if char not in self.next[node]:
                    self.next[node][char] = len(self.next)
                    self.next.append({})
                    self.fuzzy.append(False)
                    self.ends.append(False)
                node = self.next[node][char]
            self.ends[node] = True
            self.fuzzy[node] = self.fuzzy[node] or len(stem) >= fuzzy


class StemAutomaton:
    """The Levenshtein automaton of distance one run over a stem trie, made lazily.

    A state holds pairs (node, errors). The first letter of a word must be right unless
    ``anchored`` is false. ``match`` gives the errors of the best stem that begins the word,
    or None.
    """

    def __init__(self, trie: StemTrie, anchored: bool = True):
        self.trie = trie
        self.anchored = anchored
        self.states: list[frozenset[tuple[int, int]]] = [frozenset({(0, 0)})]
        self.numbers = {self.states[0]: 0}
        self.moves: dict[tuple[int, str], int] = {}
        self.found: list[int | None] = [None]

    def _step(self, state: frozenset[tuple[int, int]], char: str, first: bool) -> frozenset[tuple[int, int]]:
        trie, out = self.trie, set()
        for node, errors in state:
            below = trie.next[node]
            if char in below:
                out.add((below[char], errors))
            if errors or first or not trie.fuzzy[node]:
                continue
            out.add((node, 1))  # a letter too many
            for letter, child in below.items():
                if not trie.fuzzy[child]:
                    continue
                if letter != char:
                    out.add((child, 1))  # a wrong letter
                grand = trie.next[child].get(char)
                if grand is not None and trie.fuzzy[grand]:
                    out.add((grand, 1))  # a missing letter
        return frozenset((n, e) for n, e in out if e == 0 or (n, 0) not in out)

    def _number(self, state: frozenset[tuple[int, int]]) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.found.append(min(self._errors(state), default=None))
        return self.numbers[state]

    def _errors(self, state: frozenset[tuple[int, int]]) -> Iterator[int]:
        """Errors of the stems that end here, a missing last letter included."""
        trie = self.trie
        for node, errors in state:
            if trie.ends[node]:
                yield errors
            if not errors and any(trie.ends[c] and trie.fuzzy[c] for c in trie.next[node].values()):
                yield 1

    def match(self, word: str) -> int | None:
        at, best = 0, None
        for i, char in enumerate(word):
            after = self.moves.get((at, char))
            if after is None:
                after = self._number(self._step(self.states[at], char, self.anchored and i == 0))
                self.moves[at, char] = after
            at = after
            found = self.found[at]
            if found == 0:
                return 0
            if found is not None:
                best = found
            if not self.states[at]:
                break
        return best


@dataclass
class Model:
    stems: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))
    #: Words of clean texts that are one edit away from a stem.
    plain: frozenset[str] = frozenset()


class Reader:
    """Features of texts; what a word matches is remembered up to a bound."""

    def __init__(self, stems: list[str], plain: frozenset[str] = frozenset()):
        self.automaton = StemAutomaton(StemTrie(stems), anchored=False)
        whole = [stem + END for stem in stems if len(stem) < FUZZY]
        self.short = StemAutomaton(StemTrie(whole, SHORTEST), anchored=False)
        self.plain = plain
        self.known: dict[str, int | None] = {}

    def match(self, word: str) -> int | None:
        """Errors of the best match of a word: 0, 1 or None."""
        found = self.automaton.match(word)
        if found is None:
            found = self.short.match(word + END)
        return None if found and word in self.plain else found

    def features(self, text: str | None) -> list[float]:
        """Open exact, open fuzzy, quoted and addressed matches, their share, any open match."""
        low = (text or "").lower()
        words = WORD.findall(low)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        hits = []
        for at, word in enumerate(words):
            try:
                found = known[word]
            except KeyError:
                found = known[word] = self.match(word)
            if found is not None:
                hits.append((at, found))
        if not hits:
            return [0.0] * FEATURES
        quoted_words = self._quoted(low, {at for at, _ in hits})
        exact = fuzzy = quoted = addressed = 0
        for at, errors in hits:
            near = words[max(0, at - WINDOW) : at] + words[at + 1 : at + 1 + WINDOW]
            if at in quoted_words or not REPORTING.isdisjoint(near):
                quoted += 1
            elif errors:
                fuzzy += 1
            else:
                exact += 1
            addressed += not ADDRESS.isdisjoint(near)
        share = len(hits) / len(words)
        return [
            math.log1p(exact),
            math.log1p(fuzzy),
            math.log1p(quoted),
            math.log1p(addressed),
            math.sqrt(share),
            float(exact + fuzzy > 0),
        ]

    @staticmethod
    def _quoted(low: str, wanted: set[int]) -> set[int]:
        """Those of the wanted words that lie between two quotation marks on one line."""
        out, base = set(), 0
        for line in low.split("\n"):
            parts = QUOTES.split(line)
            for i, part in enumerate(parts):
                n = len(WORD.findall(part)) if len(parts) > 1 else 0
                if i % 2 and i < len(parts) - 1:
                    out.update(w for w in range(base, base + n) if w in wanted)
                base += n
            if len(parts) == 1:
                base += len(WORD.findall(line))
        return out


def choose_stems(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> list[str]:
    """Stems from (toxic, clean) text counts of word beginnings and of words (with ``END``).

    Words that qualify are stems. A beginning that qualifies is one if it neither begins
    such a word nor goes on from one; it gives way to the longest with the same toxic count.
    A stem that qualifies makes the longer ones needless.
    """
    good = {}
    for stem, (bad, fine) in counts.items():
        if bad >= LEAST_TOXIC and (bad / toxic) / ((fine + 0.5) / (clean + 1)) >= LIFT:
            good[stem] = bad
    words = {s[: -len(END)]: n for s, n in good.items() if s.endswith(END)}
    begun = {w[:n] for w in words for n in range(SHORTEST, len(w) + 1)}
    rest = {
        s: n
        for s, n in good.items()
        if not s.endswith(END) and s not in begun and not any(s[:k] in words for k in range(SHORTEST, len(s)))
    }
    longer = {s[:-1] for s, n in rest.items() if rest.get(s[:-1]) == n}
    stems = words | {s: n for s, n in rest.items() if s not in longer}
    kept = [s for s in stems if not any(s[:n] in stems for n in range(SHORTEST, len(s)))]
    return sorted(sorted(kept, key=lambda s: (-stems[s], s))[:STEMS])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last one is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - keep @ w
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, gradient)
        w += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    return w


def _beginnings(sample: DataFrame, label: int, only: set[str] | None) -> dict[str, int]:
    """In how many texts with this label each word and word beginning occurs; under "" their number.

    Words have ``END`` behind them. Without ``only``, those in fewer than ``LEAST_TOXIC`` texts are left out.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        found: Counter = Counter()
        for batch in batches:
            for y, value in zip(batch["_y"], batch["_text"], strict=True):
                if y == label:
                    words = set(WORD.findall((value or "").lower()))
                    seen = {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
                    seen |= {w + END for w in words if SHORTEST <= len(w)}
                    found.update(seen if only is None else seen & only)
                    found[""] += 1
        yield {"stem": list(found), "n": list(found.values())}

    sums = map_arrow(sample, "stem string, n bigint", rows).groupBy("stem").agg(F.sum("n").alias("n"))
    least = LEAST_TOXIC if only is None else 1
    return {r["stem"]: r["n"] for r in sums.where(f"n >= {least} or stem = ''").collect()}


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """Learn from the rows of ``labels`` (``key``, ``label`` 0 or 1) that have a text."""
    marks = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_y")).where(
        "_key is not null and _y in (0, 1)"
    )
    chosen = marks.groupBy("_key").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE)
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_key is not null")
    # At most SAMPLE keys and flags, so their size is bounded.
    sample = narrow.join(F.broadcast(chosen), "_key").repartition("_key").persist()
    try:
        bad = _beginnings(sample, 1, None)
        fine = _beginnings(sample, 0, set(bad))
        toxic, clean = bad.pop("", 0), fine.pop("", 0)
        if not toxic or not clean:
            rate = toxic / (toxic + clean) if toxic + clean else 0.0
            model = Model([])
            model.weights[-1] = math.log(max(rate, 1e-9) / max(1 - rate, 1e-9))
            return model
        counts = {stem: (n, fine.get(stem, 0)) for stem, n in bad.items()}
        stems = choose_stems(counts, toxic, clean)

        def ordinary(batches: Iterator[dict]) -> Iterator[dict]:
            reader = Reader(stems)
            for batch in batches:
                clean_texts = [t for y, t in zip(batch["_y"], batch["_text"], strict=True) if y == 0 and t]
                words = set(WORD.findall(" ".join(clean_texts).lower()))
                yield {"word": [w for w in words if reader.match(w)]}

        plain = frozenset(r["word"] for r in map_arrow(sample, "word string", ordinary).distinct().collect())

        def measured(batches: Iterator[dict]) -> Iterator[dict]:
            reader = Reader(stems, plain)
            for batch in batches:
                yield {"y": batch["_y"], "x": [reader.features(t) for t in batch["_text"]]}

        seen = map_arrow(sample, "y int, x array<double>", measured).collect()
    finally:
        sample.unpersist()
    x = np.array([r["x"] for r in seen])
    return Model(stems, logistic(x, np.array([float(r["y"]) for r in seen])), plain)


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per input row: ``key``, ``score`` and the six ``features``."""
    stems, weights, plain = model.stems, model.weights, model.plain

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        reader = Reader(stems, plain)
        for batch in batches:
            features = [reader.features(t) for t in batch["_text"]]
            z = np.array(features) @ weights[:-1] + weights[-1] if features else np.zeros(0)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield {"_key": batch["_key"], "score": p.tolist(), "features": features}

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return map_arrow(narrow, f"_key {kind}, score double, features array<double>", rows).withColumnRenamed("_key", key)


def predicted(score_: Column) -> Column:
    return (score_ >= 0.5).cast("int")
