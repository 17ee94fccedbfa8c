"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a fixed lexicon and of a learned one, the share of lexicon words within
five words of a second-person word, capitals, punctuation, digits, and obfuscation (symbols or digits inside words,
lexicon words that appear only once look-alikes are undone, letters drawn out). The
learned lexicon holds words and word beginnings that are far likelier in toxic rows. It is counted by Spark over one bounded
sample of labelled rows, the trees are fitted on the features of another, and the calibration on a third; scores are given to all rows.

Defined results: a null or empty text has all features 0 and gets the score
of such texts; repeated rows are each scored; ids with several labels count once, with the lower one;
without both labels all rows get the smoothed share of label 1; an empty table
gives an empty table; other columns are ignored. Texts are never cut off.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass, row_key
from hardwood.llm.sampling import labelled_sample, with_texts
from hardwood.llm.trees import Boosted, boost, isotonic

#: Rows of each label to learn the lexicon from, and to fit and calibrate the trees on.
LEXICON_ROWS, TREE_ROWS = 3000, 4000
#: The share of the tree rows (one in so many) that only calibrates.
CALIBRATING = 4
TERMS, TERM_ROWS, LOG_ODDS = 4000, 6, 1.8
STEMS = range(4, 9)
NEAR = 5

# Common insults, and second-person words.
INSULTS = frozenset(
    "arrogant ass asshole bastard bitch braindead clown coward creep cretin crap damn degenerate dimwit disgusting dumb dumbass "
    "dumbest failure fool freak fuck fucking garbage gross hate hideous idiot idiotic idiots imbecile jerk kill lame liar loser losers "
    "lunatic moron moronic morons nasty parasite pathetic pig pigs psycho rat retard scum scumbag shit shut sick slut stupid "
    "stupidity suck sucks trash troll ugly useless vermin vile whore worthless wretch "
    "arschloch blöd dumm dummkopf idioten scheiße verdammt connard connasse débile merde salaud stupide basura cabrón "
    "estúpido imbécil mierda puta tonto".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur ya y'all youre you're du dich dir dein deine ihr euch euer tu toi te ton ta tes vous "
    "votre vos tú ti contigo vosotros usted ustedes vuestro".split()
)
LOOK_ALIKES = str.maketrans("013457@$!|+", "oieastasiit")
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "…“”‘’«»¿¡–—"

ASCII = bytes(range(128))

MASKED = re.compile(r"[^\W\d_](?:[^\w\s'’-]+|\d+)[^\W\d_]")
DRAWN = re.compile(r"(.)\1{2,}")

FEATURES = (
    "log_words", "insult_density", "any_insult", "learned_density", "learned_weight", "any_learned", "stem_density", "stem_weight",
    "near_density", "near_share", "second_density", "capital_rate", "capital_word_rate", "punctuation_rate", "shout_rate",
    "digit_rate", "obfuscated_density", "hidden_density", "drawn_density", "mean_word",
)
#: Words a worker remembers.
MEMORY = 150_000


def _terms(word: str) -> list[str]:
    """What the learned lexicon knows of a word: itself, and its beginnings marked by a star."""
    bare = word.strip(EDGES)
    return [bare, *(bare[:n] + "*" for n in STEMS if len(bare) > n)] if bare else []


def learn_lexicon(texts: DataFrame) -> dict[str, float]:
    """Log odds of terms in rows of label 1 against label 0, from (label, text); the ``TERMS`` strongest."""

    def make():
        def step(batch: pa.RecordBatch):
            toxic, clean = Counter(), Counter()
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {t for w in set((text or "").lower().split()) for t in _terms(w)}
                (toxic if label else clean).update(found)
            names = [*(toxic.keys() | clean.keys())]
            yield pa.record_batch(
                [pa.array(names), pa.array([toxic[t] for t in names], pa.int64()), pa.array([clean[t] for t in names], pa.int64())],
                ["term", "toxic", "clean"],
            )

        return step

    counts = batch_pass(texts.select("label", "text"), "term string, toxic long, clean long", make)
    rows = texts.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not rows[0] or not rows[1]:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (rows[0] + 1.0)) - F.log((F.col("clean") + 0.5) / (rows[1] + 1.0))
    strong = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= TERM_ROWS)
    strong = strong.withColumn("odds", odds).filter(F.col("odds") >= LOG_ODDS).orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "term").limit(TERMS)
    return {r.term: r.odds for r in strong.select("term", "odds").collect()}


class Reader:
    """Features of texts under a lexicon; remembers what it found of a word."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.known = lexicon, {}

    def _look(self, word: str) -> tuple[float, ...] | None:
        """Marks of a word: insult, learned (and its log odds), stem (and its log odds), second person, obfuscated, hidden, drawn out."""
        bare = word.strip(EDGES)
        odds = self.lexicon.get(bare, 0.0)
        stem = max((self.lexicon.get(bare[:n] + "*", 0.0) for n in STEMS if len(bare) > n), default=0.0)
        insult = bare in INSULTS
        masked = hidden = drawn = False
        if not bare.isalpha():
            masked = bool(MASKED.search(bare))
            hidden = not insult and re.sub(r"[^\w]|_", "", bare.translate(LOOK_ALIKES)) in INSULTS
        if not insult and DRAWN.search(bare):
            drawn = DRAWN.sub(r"\1", bare) in INSULTS
        marks = (insult, odds > 0, odds, stem > 0, stem, bare in SECOND_PERSON, masked, hidden, drawn)
        return marks if any(marks) else None

    def row(self, text: str | None) -> list[float]:
        words = (text or "").split()
        if not words:
            return [0.0] * len(FEATURES)
        n, lower = len(words), text.lower().split()
        known = self.known
        for w in set(lower).difference(known):
            known[w] = self._look(w)
        hits = [k for k in map(known.__getitem__, lower) if k]
        insult, learned, odds, stems, stem_odds, second, masked, hidden, drawn = map(sum, zip(*hits)) if hits else [0] * 9
        near = 0
        if second and (insult or learned or hidden):
            marks = [known[w] or (0,) * 9 for w in lower]
            you = np.array([k[5] for k in marks], bool)
            bad = np.array([k[0] or k[1] or k[7] for k in marks], bool)
            reach = np.convolve(you, np.ones(2 * NEAR + 1, int), "same" if n > 2 * NEAR else "full")
            near = int((bad & (reach[NEAR : NEAR + n] if n <= 2 * NEAR else reach).astype(bool)).sum())
        raw = text.encode()
        size = max(1, len(raw))
        capitals = size - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        if len(text) < size:
            capitals += sum(map(str.isupper, raw.translate(None, ASCII).decode()))
        digits = size - len(raw.translate(None, b"0123456789"))
        marks = size - len(raw.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
        shouts = raw.count(b"!") + raw.count(b"?")
        upper = sum(len(w) > 1 for w in words if w.isupper())
        per = 1000.0 / n
        return [
            float(np.log1p(n)), insult * per, float(insult > 0), learned * per, odds * per, float(min(learned, 20)), stems * per, stem_odds * per,
            near * per, near / max(1, insult + learned + hidden), second * per, capitals / max(1, len(text)), upper / n, marks / size, shouts / size,
            digits / size, masked * per, hidden * per, drawn * per, sum(map(len, words)) / n,
        ]

    def rows(self, texts: list[str | None]) -> np.ndarray:
        if len(self.known) > MEMORY:
            self.known = {}
        return np.array([self.row(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def fit(texts: DataFrame) -> tuple[dict[str, float], Boosted]:
    """Lexicon and calibrated trees from a bounded sample (label, place, text)."""
    lexicon = learn_lexicon(texts.filter(F.col("place") % 2 == 0))
    reader = Reader(lexicon)

    def make():
        def step(batch: pa.RecordBatch):
            x = reader.rows(batch.column(2).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["label", "place", "x"])

        return step

    rows = batch_pass(texts.filter(F.col("place") % 2 == 1).select("label", "place", "text"), "label int, place int, x array<double>", make).collect()
    rows.sort(key=lambda r: (r.label, r.place, r.x))
    if not rows:
        return lexicon, Boosted(0.0, [], 0.1)
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows])
    held = np.array([r.place // 2 % CALIBRATING == 0 for r in rows])
    model = boost(x[~held], y[~held])
    model.steps = isotonic(model.margin(x[held]), y[held]) if held.any() else None
    return lexicon, model


def trained(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], Boosted]:
    """Lexicon and trees from the rows of ``docs`` that ``labels`` (doc_id, label 0 or 1) covers; a bounded sample of them."""
    return fit(with_texts(docs, labelled_sample(labels, "doc_id", F.col("label").cast("int"), LEXICON_ROWS + TREE_ROWS)))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, row_key and score of every row of ``docs``; ``labels`` is (doc_id, label 0 or 1) of rows to learn from."""
    lexicon, model = trained(docs, labels)

    def make():
        reader = Reader(lexicon)

        def step(batch: pa.RecordBatch):
            given = model.score(reader.rows(batch.column(2).to_pylist()))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(given, pa.float64())], ["doc_id", "row_key", "score"])

        return step

    return batch_pass(docs.select("doc_id", row_key().alias("row_key"), "text"), "doc_id long, row_key long, score double", make)


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``limit``; decided in the pass itself, without a join."""
    lexicon, model = trained(docs, labels)
    place = docs.columns.index("text")

    def make():
        reader = Reader(lexicon)

        def step(batch: pa.RecordBatch):
            given = model.score(reader.rows(batch.column(place).to_pylist()))
            yield batch.filter(pa.array(given < limit))

        return step

    return batch_pass(docs, docs.schema, make)
