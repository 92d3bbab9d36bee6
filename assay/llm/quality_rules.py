"""Quality rules by weak supervision (operator 2).

Rules look at statistics of a text and vote good (1), bad (-1) or abstain (0). Expectation-maximisation
over the counts of vote patterns estimates how often each rule votes each way on good and on bad
documents, without labels; a document's posterior probability of being good replaces all-must-pass.

Letters, capitals, digits and ends of sentences are those of Unicode. In scripts written without blanks a word is long and a
sentence has few, so the rules on both say nothing bad of texts that are mostly in one. Variety counts the words that are new
within their block of BLOCK_WORDS words, over the whole text.

The only rows that reach the driver are vote patterns with their counts: at most 3 ** (number of
rules), whatever the size of the corpus. Statistics come from one pass over the texts without a shuffle.

Defined results: a null or empty text has no words; every rule that needs words then votes bad or
abstains, and `base_failed` holds as it has fewer than 20 words. Rows are judged one by one, so repeated
rows get equal results; an empty table gives an empty result. Further columns are passed through; one
whose name clashes with an output is replaced by the output.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .storage import materialise

REPEAT_WINDOW = 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
SHOUT = np.zeros(256, bool)
SHOUT[[ord(c) for c in "!?"]] = True
#: Words among which a repeated one is no new one, for the rule on variety: long texts are judged block by block.
BLOCK_WORDS = 1000

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_stops", "n_shouts", "n_alpha_words", "n_fresh_words", "n_unspaced")


def text_statistics(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """STATS of each text, int64."""
    n = len(offsets) - 1
    start, end, doc = K.words(raw, offsets)
    count = lambda of, where: np.bincount(of[where], minlength=n)
    out = {"n_words": np.bincount(doc, minlength=n)}
    at, bits = K.code_points(raw)
    edge = np.searchsorted(at, offsets)
    per = lambda marked: np.diff(np.concatenate([[0], np.cumsum(marked)])[edge])
    out["word_chars"] = per(~K.WHITE[raw[at]])
    for name, kinds in (("n_upper", K.UPPER), ("n_letters", K.LETTER | K.MARK), ("n_digits", K.DIGIT), ("n_stops", K.STOP), ("n_unspaced", K.UNSPACED)):
        out[name] = per((bits & kinds) > 0)
    for name, table in (("n_symbols", SYMBOLS), ("n_shouts", SHOUT)):
        out[name] = K.per_text(table[raw], offsets)
    letters = at[(bits & K.LETTER) > 0]
    out["n_alpha_words"] = count(doc, np.searchsorted(letters, start) < np.searchsorted(letters, end))
    # lines that hold a word, and those of them that repeat an earlier line of their text
    left, right = K.runs(raw != 10, offsets)
    filled = np.searchsorted(start, left, "left") < np.searchsorted(start, right, "left")
    left, right = left[filled], right[filled]
    line_doc = np.searchsorted(offsets, left, "right") - 1
    lines = K.span_hashes(raw, left, right)
    order = np.lexsort((lines, line_doc))
    again = np.zeros(len(order), bool)
    again[1:] = (lines[order][1:] == lines[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    out["n_dup_lines"] = count(line_doc[order], again)
    # words in windows that occur twice or more
    h = K.span_hashes(raw, start, end)
    block = (np.arange(len(doc)) - np.searchsorted(doc, np.arange(n))[doc]) // BLOCK_WORDS if len(doc) else doc
    salted = K.mix(h + K.mix((doc.astype(K.U) << K.U(32)) + block.astype(K.U) + K.U(1)))
    out["n_fresh_words"] = _distinct(salted, doc, n)
    at = K.windows(doc, REPEAT_WINDOW)
    grams = K.ngrams(h, REPEAT_WINDOW)[at] if len(at) else np.zeros(0, K.U)
    grams = K.mix(grams + doc[at].astype(K.U) * K.U(0x9E3779B97F4A7C15))
    order = np.argsort(grams)
    same = grams[order][1:] == grams[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    out["n_repeat_words"] = count(doc, K.covered(np.sort(at[order[twice]]), REPEAT_WINDOW, len(doc)))
    return out


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each text has; keys of two texts never agree."""
    order = np.argsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    return np.bincount(doc[order][new], minlength=n)


def with_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if not given) of docs, and STATS (long) of the whole text."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in STATS]
    source = docs.select(*keep, F.col(text).alias("__stat_text"))
    schema = docs.select(*keep).schema
    for name in STATS:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("__stat_text"))
            own = batch.select(keep)
            for i, j, r, o in K.chunks(raw, offsets):
                stats = text_statistics(r, o)
                yield pa.RecordBatch.from_arrays([*own.slice(i, j - i).columns, *(pa.array(stats[s].astype(np.int64)) for s in STATS)], names=[*keep, *STATS])

    return source.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` holds, else abstains."""

    name: str
    bad: str
    good: str


#: A text with too few words or too much repetition fails before any vote.
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"

#: SQL over STATS. Limits follow published rule sets for web text (word lengths, ratios of symbols, lines, capitals and
#: digits), with a band between good and bad in which the rule abstains.
RULES: tuple[Rule, ...] = (
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words AND 2 * n_unspaced <= n_letters", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("letters", "100 * n_letters < 75 * word_chars", "100 * n_letters >= 82 * word_chars"),
    Rule("letter_words", "100 * n_alpha_words < 80 * n_words", "100 * n_alpha_words >= 90 * n_words"),
    Rule("lines", "10 * n_dup_lines > 3 * n_lines", "20 * n_dup_lines <= n_lines"),
    Rule("capitals", "10 * n_upper > 4 * n_letters", "10 * n_upper <= 2 * n_letters"),
    Rule("shouting", "5 * n_shouts > n_words", "20 * n_shouts <= n_words"),
    Rule("sentences", "n_stops = 0 OR 2 * n_stops > n_words AND 2 * n_unspaced <= n_letters", "60 * n_stops >= n_words AND 4 * n_stops <= n_words"),
    Rule("digits", "n_digits > n_letters", "20 * n_digits <= n_letters"),
    Rule("variety", "100 * n_fresh_words < 22 * n_words", "100 * n_fresh_words >= 30 * n_words"),
)


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """An array of one vote for each rule."""
    return F.array(*[F.expr(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END") for r in rules])


@dataclass(frozen=True)
class LabelModel:
    """prior: share of good documents; rates[class][rule][vote + 1]: P(vote | class), class 1 is good."""

    prior: float
    rates: np.ndarray

    def log_odds(self) -> tuple[float, np.ndarray]:
        """The prior's log odds, and for each rule and vote what the vote adds to them."""
        return float(np.log(self.prior / (1 - self.prior))), np.log(self.rates[1] / self.rates[0])


#: P(vote bad, abstain, good | class) before any data, for bad and for good documents, and how much these beliefs weigh,
#: as shares of all documents. Good documents seldom get a bad vote; a bad one gets it from a few of the rules.
BELIEF = ((0.15, 0.05, 0.80), (0.003, 0.02, 0.977))
WEIGHT = (0.03, 0.5)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300, tolerance: float = 1e-10, prior: float = 0.85, belief=BELIEF, weight=WEIGHT) -> LabelModel:
    """Expectation-maximisation (maximum a posteriori) from vote patterns and their counts.

    Without the belief the two classes are exchangeable, and a rule whose votes go together with other rules' for another
    reason than quality could draw the bad class to itself.
    """
    m, n = patterns.shape[1], max(float(counts.sum()), 1.0)
    one_hot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    start = np.repeat(np.array(belief)[:, None, :], m, axis=1)
    strength = n * np.array(weight)[:, None, None]
    rates, p = start.copy(), prior
    for _ in range(rounds):
        score = np.log(p / (1 - p)) + np.einsum("kmv,mv->k", one_hot, np.log(rates[1] / rates[0]))
        good = 1 / (1 + np.exp(-np.clip(score, -700, 700)))
        old = p
        seen = np.einsum("ck,kmv->cmv", np.stack([counts * (1 - good), counts * good]), one_hot)
        rates = seen + strength * start
        rates /= rates.sum(-1, keepdims=True)
        p = min(max(float((counts @ good + 0.1 * n * prior) / (1.1 * n)), 1e-6), 1 - 1e-6)
        if abs(p - old) < tolerance:
            break
    return LabelModel(p, rates)


def fit_table(stats: DataFrame, rules: tuple[Rule, ...] = RULES, **how) -> LabelModel:
    """Fits on the vote patterns of all rows that pass the base rules. At most 3 ** len(rules) rows come to the driver."""
    rows = stats.where(f"NOT ({BASE_FAILED})").groupBy(votes(rules).alias("v")).count().collect()
    rows.sort(key=lambda r: tuple(r["v"]))
    patterns = np.array([r["v"] for r in rows], float).reshape(len(rows), len(rules))
    return fit(patterns, np.array([r["count"] for r in rows], float), **how)


def posterior(model: LabelModel, rules: tuple[Rule, ...] = RULES) -> Column:
    """P(good | votes) as an expression over STATS."""
    base, gain = model.log_odds()
    total = F.lit(base)
    for r, (bad, none, good) in zip(rules, gain.tolist(), strict=True):
        total = total + F.expr(f"CASE WHEN {r.bad} THEN {bad!r}D WHEN {r.good} THEN {good!r}D ELSE {none!r}D END")
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def judge(stats: DataFrame, model: LabelModel, threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds `base_failed`, `quality` (posterior) and `kept` to rows with STATS."""
    return (
        stats.withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("quality", posterior(model, rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
    )


def assess(docs: DataFrame, keep: list[str], text: str = "text", threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns `keep` with STATS, `base_failed`, `quality` and `kept`, judged by a model fitted on all of docs.

    The statistics are written once to the shared folder: the texts are read and parsed a single time.
    """
    stats, _ = materialise(with_statistics(docs, text, keep), "quality-stats")
    return judge(stats, fit_table(stats, rules), threshold, rules)


def filter_quality(docs: DataFrame, text: str = "text", threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns. Texts are parsed twice and never shuffled or stored."""
    model = fit_table(with_statistics(docs, text, []), rules)
    packed = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text"))
    return judge(with_statistics(packed, "__text", ["__row"]), model, threshold, rules).where("kept").select("__row.*")
