"""Toxicity scores: Levenshtein automata intersected with a lexicon trie.

``fit`` learns a lexicon from labelled rows: words, and stems shared by many of
them, that occur in toxic documents and hardly in clean ones.  Support counts
distinct sketches instead of documents, so that copies of one text are one
witness.  The trie of the lexicon is intersected with the Levenshtein automata
of its entries (``budget`` edits by length) into one deterministic automaton;
each distinct word of a document runs through it, so misspelled terms are
caught at the cost of a table lookup for each character.

A hit counts by its context window: less inside quotation marks or after a
word of reporting, more beside other hits or a form of address.  A logistic
model over the summed weights of exact, stem and misspelled hits, fitted on
the same labelled rows, gives the score.

The labelled sample is bounded by ``Settings.sample`` rows, taken by a hash of
the id; lexicon, automaton and weights are bounded by ``Settings.entries``, and
are broadcast.  Scoring is row by row: no shuffle, no hot key.

Defined results: null or empty texts score like a text without hits; rows with
a null id or label are not learnt from; without usable labels every score is
0; repeated rows score equally; long texts are whole; extra columns are not
read.  Words are runs of letters and digits, lower-cased.
"""

from __future__ import annotations

import re
from bisect import bisect_left
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import only, ship
from vigil.session import BROAD, materialize

WORD = re.compile(r"[^\W_]+")
#: Words that report or name instead of addressing (fixed values).
REPORTING = frozenset("said says wrote quoted quote called word term phrase cited reported".split())
ADDRESS = frozenset("you your yours youre u ur".split())
QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“"}
FEATURES = ("exact", "stem", "edited", "edited_stem", "density")


@dataclass(frozen=True)
class Settings:
    sample: int = 20_000      # labelled rows learnt from, about
    support: int = 4          # distinct toxic witnesses of an entry
    ratio: float = 60.0       # how much likelier in toxic documents
    entries: int = 400        # largest lexicon
    stem_forms: int = 4       # words behind a stem
    window: int = 6           # context in words on either side
    quoted: float = 0.3       # weight of a quoted or reported hit
    beside: float = 1.25      # factor beside other hits or an address


def budget(n: int, stem: bool) -> int:
    """Edits allowed for an entry of n characters."""
    if stem:
        return 1 if n >= 6 else 0
    return 0 if n < 4 else 1 if n < 9 else 2


class Automaton:
    """Deterministic automaton of all words within an entry's budget.

    ``verdict`` of a state is 1 + edits for a word that ends there, ``prefix`` the
    same for stems, which hold whatever follows; 0 means none.
    """

    def __init__(self, words: list[str], stems: list[str]):
        children, whole, stem = [{}], [-1], [-1]  # by trie node: children, budget of the entry that ends here
        for entries, ends in ((words, whole), (stems, stem)):
            for w in entries:
                at = 0
                for c in w:
                    if c not in children[at]:
                        children[at][c] = len(children)
                        children.append({})
                        whole.append(-1)
                        stem.append(-1)
                    at = children[at][c]
                ends[at] = budget(len(w), ends is stem)
        most = [max(a, b) for a, b in zip(whole, stem)]
        for node in range(len(children) - 1, -1, -1):
            most[node] = max([most[node], *(most[x] for x in children[node].values())])

        def closed(states: dict[int, int]) -> tuple:
            todo = list(states.items())
            while todo:
                node, e = todo.pop()
                for x in children[node].values():  # a character of the entry is missing
                    if e + 1 <= most[x] and e + 1 < states.get(x, 9):
                        states[x] = e + 1
                        todo.append((x, e + 1))
            return tuple(sorted(states.items()))

        alphabet = sorted({c for x in children for c in x})
        self.classes = {c: i + 1 for i, c in enumerate(alphabet)}
        start = closed({0: 0}) if most[0] >= 0 else ()
        number, todo, rows = {(): 0, start: 1}, [start], {(): [0] * (len(alphabet) + 1)}
        if not start:
            number = {(): 0}
            todo = []
        while todo:
            subset = todo.pop()
            anyway: dict[int, int] = {}
            for node, e in subset:  # an added or another character
                for x in (node, *children[node].values()):
                    if e + 1 <= most[x] and e + 1 < anyway.get(x, 9):
                        anyway[x] = e + 1
            same: dict[str, dict[int, int]] = {}
            for node, e in subset:
                for c, x in children[node].items():
                    if e <= most[x]:
                        same.setdefault(c, {})[x] = min(e, same.get(c, {}).get(x, 9))
            row = []
            other = closed(dict(anyway))
            for c in ("", *alphabet):
                to = other
                if c in same:
                    merged = dict(anyway)
                    for x, e in same[c].items():
                        merged[x] = min(e, merged.get(x, 9))
                    to = closed(merged)
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                row.append(number[to])
            rows[subset] = row
        n = len(number)
        self.table = np.zeros((n, len(alphabet) + 1), np.int32)
        self.verdict, self.prefix = np.zeros(n, np.int8), np.zeros(n, np.int8)
        for subset, i in number.items():
            self.table[i] = rows[subset]
            for ends, out in ((whole, self.verdict), (stem, self.prefix)):
                best = min([e for node, e in subset if ends[node] >= e], default=-1)
                out[i] = best + 1
        self.start = 1 if start else 0

    def match(self, words: list[str]) -> np.ndarray:
        """Code of each word: 0 none, 1 exact, 2 stem, 3 misspelled, 4 misspelled stem."""
        if not words or not self.start:
            return np.zeros(len(words), np.int8)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        lookup = np.zeros(max(int(codes.max()), 255) + 1, np.int32)
        for c, i in self.classes.items():
            if ord(c) < len(lookup):
                lookup[ord(c)] = i
        cls = lookup[codes]
        size = np.array([len(w) for w in words])
        at = np.cumsum(size) - size
        state, live = np.full(len(words), self.start, np.int32), np.arange(len(words))
        stem = np.zeros(len(words), np.int8)
        end = np.zeros(len(words), np.int32)
        j = 0
        while len(live):
            done = size[live] == j
            end[live[done]] = state[live[done]]
            live = live[~done]
            state[live] = self.table[state[live], cls[at[live] + j]]
            live = live[state[live] > 0]
            p = self.prefix[state[live]]
            better = (p > 0) & ((stem[live] == 0) | (p < stem[live]))
            stem[live[better]] = p[better]
            j += 1
        whole = self.verdict[end]
        whole[end == 0] = 0
        return np.select([whole == 1, stem == 1, whole > 1, stem > 1], [1, 2, 3, 4], 0).astype(np.int8)


@dataclass
class Model:
    words: list[str]
    stems: list[str]
    weights: list[float]      # by FEATURES, then the intercept; empty: nothing could be learnt
    settings: Settings


_MARK = re.compile("[\n" + re.escape("".join(sorted({*QUOTES, *QUOTES.values()}))) + "]")


def _quoted_spans(text: str) -> list[tuple[int, int]]:
    """Quotations in order, without overlaps; a quotation ends in its line."""
    marks = [(m.start(), m[0]) for m in _MARK.finditer(text)]
    ends, last = [-1] * len(marks), {}
    for j in range(len(marks) - 1, -1, -1):
        at, c = marks[j]
        if c == "\n":
            last.clear()
        else:
            ends[j] = last.get(QUOTES.get(c), -1)
            last[c] = at
    spans, i = [], 0
    for (at, c), end in zip(marks, ends):
        if at >= i and end >= 0 and c in QUOTES:
            spans.append((at, end))
            i = end + 1
    return spans


def features(text: str, known: dict[str, int], automaton: Automaton, s: Settings) -> list[float]:
    """Context-weighted sums of hits by kind, and their share of the words."""
    ws = WORD.findall(text.lower())
    found = list(map(known.get, ws))
    if None in found:
        new = list({w for w, x in zip(ws, found) if x is None})
        if len(known) > 500_000:
            known.clear()
            new = list(set(ws))
        known.update(zip(new, automaton.match(new).tolist()))
        found = [known[w] for w in ws]
    out = [0.0] * len(FEATURES)
    hits = [(i, k) for i, k in enumerate(found) if k]
    if hits:
        low = text.lower()
        quoted = _quoted_spans(low)
        spans = [m.start() for m in WORD.finditer(low)] if quoted else None
        opened = [a for a, _ in quoted]
        at = [i for i, _ in hits]
        for n, (i, k) in enumerate(hits):
            w = 1.0
            near = ws[max(0, i - s.window):i + s.window + 1]
            if quoted and spans[i] < quoted[bisect_left(opened, spans[i]) - 1][1] and opened[0] < spans[i] or not REPORTING.isdisjoint(ws[max(0, i - 3):i]):
                w *= s.quoted
            elif (n and i - at[n - 1] <= s.window or n + 1 < len(at) and at[n + 1] - i <= s.window
                  or not ADDRESS.isdisjoint(near)):
                w *= s.beside
            out[k - 1] += w
        total = sum(out)
        out = [float(np.log1p(x)) for x in out[:4]] + [min(1.0, 10.0 * total / len(ws))]
    return out


def _worker(shared, key: str):
    from vigil.llm.toxicity import Automaton

    return only(key, lambda: ((model := shared.value), Automaton(model.words, model.stems), {}))


def _column(spark, model: Model, scores: bool):
    """Column function text -> score, or -> array of features."""
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(text: pd.Series) -> pd.Series:
        from vigil.llm.toxicity import _worker, features

        m, automaton, known = _worker(shared, key)
        f = [features(t, known, automaton, m.settings) if t else [0.0] * len(FEATURES) for t in text]
        if not scores:
            return pd.Series(f)
        if not m.weights:
            return pd.Series(np.zeros(len(f)))
        w = np.array(m.weights)
        x = np.array(f).reshape(-1, len(FEATURES)) @ w[:-1] + w[-1]
        return pd.Series(1 / (1 + np.exp(-np.clip(x, -30, 30))))

    return F.pandas_udf(run, "double" if scores else "array<double>")


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights by Newton's method; a ridge around a prior that any hit is toxic."""
    x = np.hstack([x, np.ones((len(x), 1))])
    prior = np.array([4.0, 4.0, 2.5, 1.5, 1.0, -3.0])
    w = prior.copy()
    pull = np.full(len(w), ridge)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * (w - prior))
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Lexicon and weights from labelled rows whose crc32(doc_id as text) mod 5 isn't 0."""
    spark = docs.sparkSession
    ship(spark)
    s = settings
    use = (labels.selectExpr("cast(doc_id as long) doc_id", "cast(toxic as int) toxic")
           .where("doc_id is not null and toxic in (0, 1) and crc32(cast(doc_id as string)) % 5 != 0")
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = use.count()
    if not n:
        return Model([], [], [], s)
    share = min(1.0, s.sample / n)
    use = use.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = materialize(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
                       .join(F.broadcast(use), "doc_id").where("text is not null"), "toxic-sample")
    words = (rows.select("toxic", F.array_distinct(F.regexp_extract_all(
        F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).alias("ws"))
        .withColumn("sketch", F.array_min(F.transform("ws", lambda w: F.xxhash64(w))))
        .select("toxic", "sketch", F.explode("ws").alias("word")))
    counted = materialize(words.groupBy("word", "toxic", "sketch").agg(F.count("*").alias("n"))
                          .groupBy("word").agg(F.sum(F.col("toxic")).alias("witnesses"),
                                               F.sum(1 - F.col("toxic")).alias("against")), "toxic-words", BROAD)
    totals = rows.groupBy("toxic").count().collect()
    by = {r["toxic"]: r["count"] for r in totals}
    if not by.get(1) or not by.get(0):
        return Model([], [], [], s)
    odds = ((F.col("witnesses") + 0.5) / by[1]) / ((F.col("against") + 0.5) / by[0])
    found = (counted.where(F.col("witnesses") >= s.support).where(odds >= s.ratio)
             .where(F.length("word").between(3, 24)).orderBy(F.desc("witnesses"), "word").limit(s.entries).collect())
    lexicon = [r["word"] for r in found]
    # stems: prefixes that several words of toxic documents share, and clean documents hardly have
    prefixes = counted.select("witnesses", "against", F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(4), F.lit(7)), lambda k: F.substr("word", F.lit(1), k)))).alias("prefix"))
    sums = (prefixes.groupBy("prefix").agg(F.sum("witnesses").alias("witnesses"), F.sum("against").alias("against"),
                                           F.count_if(F.col("witnesses") > 0).alias("forms"))
            .where(F.length("prefix") >= 4).where(F.col("forms") >= s.stem_forms).where(F.col("witnesses") >= 2 * s.support)
            .where(odds >= s.ratio).orderBy(F.desc("witnesses"), "prefix").limit(s.entries).collect())
    good = {r["prefix"] for r in sums}
    stems = sorted(p for p in good if not any(p[:k] in good for k in range(4, len(p))))
    model = Model([w for w in lexicon if not any(w.startswith(p) for p in stems)], stems, [], s)
    scored = rows.select("toxic", _column(spark, model, False)(F.col("text")).alias("f")).collect()
    x, y = np.array([r["f"] for r in scored]), np.array([r["toxic"] for r in scored], float)
    model.weights = [float(v) for v in _logistic(x, y)]
    return model


def score(spark, model: Model):
    """Column function: text -> toxicity from 0 to 1."""
    ship(spark)
    return lambda text: _column(spark, model, True)(F.coalesce(text.cast("string"), F.lit("")))
