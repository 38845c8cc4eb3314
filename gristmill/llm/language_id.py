"""Languages of texts, with spans for mixed ones.

A model holds, for each learned language, log probabilities of character trigrams (words
marked at both ends) and the scripts its letters come from. A word's script narrows the
candidates to languages that use it; each candidate's score is the sum over the word's
trigrams. A Viterbi pass over the words, with a penalty for every switch, labels each word;
neighbouring words with one label form a span. The text's language has the most letters,
ties go to the first in alphabetical order, and the score is its share of the letters.

The model is fitted on a bounded sample: ``PER_LANGUAGE`` texts of each language (those
with the smallest hash of their id) and the ``TRIGRAMS`` most frequent trigrams. Texts that
are null or without letters are ``und`` with score 0. With nothing to learn from, every
text is ``und``. Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.columns import map_arrow

PER_LANGUAGE, SAMPLE, TRIGRAMS = 400, 100_000, 50_000
#: Cost of a change of language, in natural log units.
SWITCH = 12.0
#: Score of a language that does not use the word's script.
FOREIGN = -30.0
REMEMBERED = 200_000
UNDETERMINED = "und"

WORD = re.compile(r"[^\W\d_]+")
# First and last code point of script blocks; other letters count as "other".
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)


def script(char: str) -> str:
    at = ord(char)
    return next((name for name, first, last in SCRIPTS if first <= at <= last), "other")


def trigrams(word: str) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + 3] for i in range(len(marked) - 2)]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    rows: dict[str, int]
    table: np.ndarray  # trigram × language
    scripts: dict[str, np.ndarray]  # script → languages that use it


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from the texts with a language and a key; see the module for the bounds."""
    known = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).where(
        "_key is not null and _text is not null and _lang is not null"
    )
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_key"), "_key")
    picked = (
        known.select("_key", "_lang")
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= PER_LANGUAGE)
        .orderBy("_n", "_lang", "_key")
        .limit(SAMPLE)
        .select("_key", "_lang")
        .distinct()
    )
    # At most SAMPLE keys, so their size is bounded; the texts stay where they are.
    sample = known.join(F.broadcast(picked), ["_key", "_lang"])

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        found: Counter = Counter()
        for batch in batches:
            for language, value in zip(batch["_lang"], batch["_text"], strict=True):
                for word, n in Counter(WORD.findall(value.lower())).items():
                    found[language, "s", script(word[0])] += n * len(word)
                    for gram in trigrams(word):
                        found[language, "g", gram] += n
        keys = list(found)
        yield {
            "lang": [k[0] for k in keys],
            "kind": [k[1] for k in keys],
            "item": [k[2] for k in keys],
            "n": [found[k] for k in keys],
        }

    counts = (
        map_arrow(sample, "lang string, kind string, item string, n bigint", count)
        .groupBy("kind", "item")
        .agg(F.collect_list(F.struct("lang", "n")).alias("by"), F.sum("n").alias("n"))
    )
    grams = counts.where("kind = 'g'").orderBy(F.desc("n"), "item").limit(TRIGRAMS).collect()
    used = counts.where("kind = 's'").collect()
    languages = tuple(sorted({x["lang"] for row in (*grams, *used) for x in row["by"]}))
    column = {name: i for i, name in enumerate(languages)}
    table = np.zeros((len(grams), len(languages)))
    for at, row in enumerate(grams):
        for x in row["by"]:
            table[at, column[x["lang"]]] += x["n"]
    letters: dict[str, np.ndarray] = {}
    for row in used:
        letters.setdefault(row["item"], np.zeros(len(languages)))
        for x in row["by"]:
            letters[row["item"]][column[x["lang"]]] += x["n"]
    totals = sum(letters.values()) if letters else np.zeros(0)
    smooth = (table + 0.5) / (table.sum(axis=0) + 0.5 * max(1, len(grams)))
    return Model(
        languages,
        {row["item"]: at for at, row in enumerate(grams)},
        np.log(smooth).astype(np.float32),
        {name: n > 0.01 * totals for name, n in letters.items()},
    )


class Scorer:
    """Word scores of one worker, remembered up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def lookup(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words in ``scores``."""
        known = self.known
        fresh = list(dict.fromkeys(w for w in words if w not in known))
        if fresh:
            if len(known) + len(fresh) > REMEMBERED:
                known.clear()
                self.scores = self.scores[:0]
                fresh = list(dict.fromkeys(words))
            get = self.model.rows.get
            rows: list[int] = []
            ends: list[int] = []
            for word in fresh:
                rows += [r for g in trigrams(word) if (r := get(g)) is not None]
                ends.append(len(rows))
            sums = np.zeros((len(rows) + 1, len(self.model.languages)))
            np.cumsum(self.model.table[rows], axis=0, out=sums[1:])
            bounds = np.array([0, *ends])
            new = (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float32)
            cache: dict[str, np.ndarray | None] = {}
            for at, word in enumerate(fresh):
                name = script(word[0])
                if name not in cache:
                    use = self.model.scripts.get(name)
                    cache[name] = None if use is None or use.all() or not use.any() else ~use
                if cache[name] is not None:
                    new[at, cache[name]] += FOREIGN
            start = len(self.scores)
            self.scores = np.concatenate([self.scores, new])
            known.update((word, start + at) for at, word in enumerate(fresh))
        return np.fromiter((known[w] for w in words), np.int64, len(words))


def label_words(scores: list[np.ndarray]) -> list[np.ndarray]:
    """Viterbi labels of several texts, each given as words × languages.

    The texts advance together, the longest first, so that one step is one array operation
    for all texts that still have words.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    sizes = [len(scores[i]) for i in order]
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    if not sizes or not sizes[0]:
        return out
    languages = scores[order[0]].shape[1]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate([scores[i] for i in order])
    back = np.zeros(flat.shape, np.int16)
    best = np.zeros((len(order), languages), np.float64)
    own = np.arange(languages, dtype=np.int16)
    live = len(order)
    longest = sizes[0]
    for t in range(longest):
        while live and sizes[live - 1] <= t:
            live -= 1
        at = starts[:live] + t
        if t:
            top = best[:live].argmax(axis=1)
            jump = best[np.arange(live), top][:, None] - SWITCH
            switch = jump > best[:live]
            back[at] = np.where(switch, top[:, None], own)
            best[:live] = np.where(switch, jump, best[:live])
        best[:live] += flat[at]
    state = best.argmax(axis=1)
    labels = np.zeros(len(flat), np.int64)
    live = 0
    for t in range(longest - 1, -1, -1):
        while live < len(order) and sizes[live] > t:
            live += 1
        at = starts[:live] + t
        labels[at] = state[:live]
        state[:live] = back[at, state[:live]]
    for n, i in enumerate(order):
        out[i] = labels[starts[n] : starts[n + 1]]
    return out


def label_texts(scorer: Scorer, values: list[str | None], spans: bool) -> dict[str, list]:
    """Languages, scores and, if asked for, spans of a batch of texts."""
    names = scorer.model.languages
    out: dict[str, list] = {"lang_pred": [], "score": []} | ({"spans": []} if spans else {})
    texts = [(t or "") if names else "" for t in values]
    words = [WORD.findall(t.lower()) for t in texts]
    flat = [w for ws in words for w in ws]
    numbers = scorer.lookup(flat)
    ends = np.cumsum([0, *map(len, words)])
    parts = [scorer.scores[numbers[a:b]] for a, b in zip(ends, ends[1:], strict=False)]
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    for n, labels in enumerate(label_words(parts)):
        if not len(labels):
            top, share = None, 0.0
        else:
            letters = np.bincount(labels, lengths[ends[n] : ends[n + 1]], len(names))
            top = int(letters.argmax())
            share = float(letters[top] / letters.sum())
        out["lang_pred"].append(UNDETERMINED if top is None else names[top])
        out["score"].append(share)
        if spans:
            out["spans"].append([] if top is None else word_spans(texts[n], labels, names))
    return out


def label_column(text: Column, model: Model) -> Column:
    """``lang_pred`` and ``score`` as a struct."""

    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for batch in batches:
            yield pd.DataFrame(label_texts(scorer, batch.tolist(), spans=False))

    return F.pandas_udf(labelled, "lang_pred string, score double")(text)


def identify(
    docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", spans: bool = True
) -> DataFrame:
    """One row per input row: ``key``, ``lang_pred``, ``score`` and, if asked for, ``spans``
    (array of start, end, lang; code points, end exclusive, from first to last word)."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        scorer = Scorer(model)
        for batch in batches:
            yield {"_key": batch["_key"]} | label_texts(scorer, batch["_text"], spans)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, lang_pred string, score double"
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    full = schema + ", spans array<struct<start int, end int, lang string>>" * spans
    return map_arrow(narrow, full, rows).withColumnRenamed("_key", key)


def word_spans(text: str, labels: np.ndarray, names: tuple[str, ...]) -> list[dict]:
    """Runs of words with one label. Lower-casing may lengthen a text, so words are found
    again in the text itself; where their number differs, the whole text is one span."""
    found = [m.span() for m in WORD.finditer(text)]
    if len(found) != len(labels):
        return [{"start": 0, "end": len(text), "lang": names[int(np.bincount(labels).argmax())]}]
    cuts = np.flatnonzero(np.diff(labels)) + 1
    bounds = [0, *cuts.tolist(), len(labels)]
    return [
        {"start": found[a][0], "end": found[b - 1][1], "lang": names[int(labels[a])]}
        for a, b in zip(bounds, bounds[1:], strict=False)
    ]
