"""Benchmark decontamination by template canonicalisation (operator 7).

Words lose surrounding punctuation and case; numbers (in digits or words), units and names become typed placeholders. All
WINDOW-word windows of a benchmark item are hashed in two forms, with and without name placeholders, and hash-joined with
the windows of whole documents. A window needs PLAIN words that are no placeholder, so tables of numbers are no templates;
windows with fewer are hashed with their own values, so verbatim copies are found whatever an item consists of.

Two further streams of words find what these forms miss. In both a number is apart from letters written behind it (5kg; not
those of 3rd), and a run of numbers, units or names without punctuation is one slot, so that "New York" can stand for "Boston"; in the second
one a capitalised first word of a sentence is a name too. Lengths and positions count words of the text in every stream.

An item is found in a document if windows that lie at one distance from each other in both cover at least min(COVER, item
length) words of the item and the slots agree: equal slot values of the item stand for equal values in the document. If
all values are the item's own the finding is "verbatim", else "reparameterised". Where the slots do not agree, a run of
VERBATIM or more words of the item, all as they are, is a finding still. An item of fewer than SHORTEST words, which many
texts say by chance, is found where a line of a document says it and nothing else.

Two kinds are hints, no findings, since clean texts have them too: "edited", COVER to VERBATIM words of an item as they are
beside slots that contradict it, and "mention", an item of fewer than SHORTEST words inside a line. They are in a column of
their own; `clean` leaves them to its caller.

The benchmark is taken in blocks of at most BLOCK_WINDOWS windows. One block's table is small by that bound and goes to the
executors; a larger benchmark takes several passes over the documents, each written before the next begins, so that one table
is held at a time. The hits of a document are looked at PAIRS at a time, however many items share a window.

Defined results: null or empty text contains nothing; items without words are not looked for, items shorter than WINDOW are
one window; equal items are all named; repeated rows get equal results; an empty benchmark finds nothing, an empty table
gives an empty result. Extra columns pass through; one named `found` is replaced, and one named `hints` if hints are asked for. Of an item that is found in a
text no hint is given. Memory is bounded by the longest text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .storage import materialise, release

WINDOW, COVER, PLAIN, SHORTEST, VERBATIM = 8, 13, 4, 5, 20
BLOCK_WINDOWS = 1_000_000
#: Pairs of a window of a text and one of an item that are looked at at once, whole documents at a time.
PAIRS = 2_000_000
HINTS = ("edited", "mention")

# Words for numbers and units that become placeholders.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
UNIT_WORDS = "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres mg g kg gram grams kilogram kilograms ton tons ounce ounces pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees watt watts volt volts mph kph".split()

PUNCT = np.zeros(256, bool)
PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(0xC2, 0x100)]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".!?:;\n"]] = True

WORD, NUMBER, UNIT, NAME = 0, 1, 2, 3


def lowered(raw: np.ndarray) -> np.ndarray:
    """Bytes with the capitals of ASCII and Latin-1 made small."""
    out = raw.copy()
    out[UPPER[raw]] += 32
    if len(raw) > 1:
        latin = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) + 1
        out[latin] += 32
    return out


def _hash_words(words: list[str]) -> np.ndarray:
    parts = [w.encode() for w in words]
    raw = np.frombuffer(b" ".join(parts), np.uint8)
    start = np.cumsum([0] + [len(p) + 1 for p in parts])[:-1]
    return np.sort(K.span_hashes(raw, start, start + np.array([len(p) for p in parts])))


_FIXED: dict[int, np.ndarray] = {}


class Words:
    """The words of some texts that have a letter, a digit or another character: text number, value hash, kind, and more."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        if not _FIXED:
            _FIXED[NUMBER], _FIXED[UNIT], _FIXED[WORD] = _hash_words(NUMBER_WORDS), _hash_words(UNIT_WORDS), _hash_words(["st", "nd", "rd", "th"])
        start, end, doc = K.words(raw, offsets)
        body = np.flatnonzero(~PUNCT[raw] & ~K.WHITE[raw])
        a, b = np.searchsorted(body, start), np.searchsorted(body, end)
        full = b > a
        self.doc, outer, outer_end = doc[full], start[full], end[full]
        start, end = body[a[full]], body[b[full] - 1] + 1
        self.value, self.kind, self.initial = np.zeros(0, K.U), np.zeros(0, np.int8), np.zeros(0, bool)
        self.near, self.word, self.begin = np.zeros(0, bool), np.arange(len(start)), start
        self.last = self.word
        self.split = self.value, self.value, self.word
        if not len(start):
            return
        small = lowered(raw)
        self.value = K.span_hashes(small, start, end)
        digits, letters = np.flatnonzero(DIGIT[raw]), np.flatnonzero(LETTER[raw])
        inside = lambda at: np.searchsorted(at, end) > np.searchsorted(at, start)
        number = inside(digits) & ~inside(letters)
        breaks = np.flatnonzero(BREAK[raw])
        first = np.ones(len(start), bool)
        first[1:] = (self.doc[1:] != self.doc[:-1]) | (np.searchsorted(breaks, start[1:]) > np.searchsorted(breaks, end[:-1]))
        second = raw[np.minimum(start + 1, len(raw) - 1)]
        latin = (raw[start] == 0xC3) & (second >= 0x80) & (second <= 0x9E)
        capital = UPPER[raw[start]] & (end - start > 1) & ~UPPER[second] | latin & (end - start > 2)
        self.kind = np.where(capital & ~first, NAME, WORD).astype(np.int8)
        self.kind[np.isin(self.value, _FIXED[UNIT])] = UNIT
        self.kind[number | np.isin(self.value, _FIXED[NUMBER])] = NUMBER
        self.initial = capital & first & (self.kind == WORD)
        # no punctuation between a word and the one before it
        self.near = np.zeros(len(start), bool)
        self.near[1:] = (self.doc[1:] == self.doc[:-1]) & (start[1:] == outer[1:]) & (end[:-1] == outer_end[:-1])
        # digits before letters, as in 5kg: where the letters begin, and the hashes of both parts
        low, high = np.searchsorted(letters, start), np.searchsorted(digits, end)
        letter, digit = letters[np.minimum(low, len(letters) - 1)] if len(letters) else start, digits[np.maximum(high - 1, 0)] if len(digits) else start
        at = np.flatnonzero(inside(digits) & inside(letters) & DIGIT[raw[start]] & (letter > digit))
        self.split = K.span_hashes(small, start[at], letter[at]), K.span_hashes(small, letter[at], end[at]), at

    def folded(self, initial: bool) -> Words:
        """A number apart from the unit it is written with, runs of numbers, units or names as one; `initial`: the first
        word of a sentence is a name if it has a capital."""
        number, rest, at = self.split
        n = np.ones(len(self.doc), np.int64)
        n[at] = 2
        word = np.repeat(np.arange(len(n)), n)
        left = (np.cumsum(n) - n)[at]
        value, kind, near = self.value[word], np.where(self.initial & initial, NAME, self.kind).astype(np.int8)[word], self.near[word]
        value[left], value[left + 1] = number, rest
        kind[left], kind[left + 1], near[left + 1] = NUMBER, np.where(np.isin(rest, _FIXED[UNIT]), UNIT, np.where(np.isin(rest, _FIXED[WORD]), NUMBER, WORD)), True
        new = np.ones(len(kind), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == WORD) | ~near[1:]
        begin = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        size = np.diff(np.append(begin, len(kind)))
        out = object.__new__(Words)
        out.doc, out.kind = self.doc[word][begin], kind[begin]
        step = (np.arange(len(kind)) - begin[group]).astype(K.U) if len(kind) else np.zeros(0, K.U)
        several = K.mix(value + step * K.U(0x9E3779B97F4A7C15))
        out.value = np.where(size > 1, np.add.reduceat(several, begin), value[begin]) if len(begin) else value
        out.word, out.last = word[begin], word[begin + size - 1]
        return out

def streams(raw: np.ndarray, offsets: np.ndarray) -> list[Words]:
    """The words as they are, folded, and folded with the first words of sentences as names."""
    plain = Words(raw, offsets)
    return [plain, plain.folded(False), plain.folded(True)]


def _forms(value: np.ndarray, kind: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(template hashes, is a slot) with and without name placeholders."""
    marks = K.mix(np.arange(4, dtype=K.U) + K.U(0xABCDEF))
    return [(np.where(slot, marks[kind], value), slot) for slot in (kind != WORD, (kind == NUMBER) | (kind == UNIT))]


class Templates:
    """The windows of some benchmark items, in each of the streams."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        raw, offsets = K.string_parts(pa.array(texts, pa.string()))
        plain, *more = streams(raw, offsets)
        edge = np.searchsorted(plain.doc, np.arange(len(ids) + 1))
        self.parts = [_Stream(ids, w, np.diff(edge), edge, literal=w is plain) for w in (plain, *more)]
        # items too short for windows, by the hash of all their words
        self.ids, self.short = ids, defaultdict(list)
        for k, n in enumerate(np.diff(edge).tolist()):
            if 0 < n < SHORTEST:
                self.short[n, int(K.ngrams(plain.value[edge[k] : edge[k + 1]], n)[0])].append(k)

    def search(self, raw: np.ndarray, offsets: np.ndarray) -> dict[int, list[dict]]:
        """What is found in each text, by text number; of an item found in several streams what the first says."""
        found: dict[tuple[int, int, bool], dict] = {}
        all_words = streams(raw, offsets)
        first = np.searchsorted(all_words[0].doc, np.arange(len(offsets)))
        for part, w in zip(self.parts, all_words, strict=True):
            found = part.search(w, first) | found
        if self.short:
            found = self._lines(raw, all_words[0], first) | found
        out: dict[int, list[dict]] = defaultdict(list)
        for (d, k, hint), what in sorted(found.items()):
            if not hint or (d, k, False) not in found:
                out[d].append(what)
        return out

    def _lines(self, raw: np.ndarray, words: Words, first: np.ndarray) -> dict[tuple[int, int, bool], dict]:
        """The short items that are a whole line of a text, and as hints those inside one."""
        if not len(words.doc):
            return {}
        line = np.searchsorted(np.flatnonzero(raw == 10), words.begin)
        new = np.ones(len(line), bool)
        new[1:] = (line[1:] != line[:-1]) | (words.doc[1:] != words.doc[:-1])
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(line)))
        found: dict[tuple[int, int, bool], dict] = {}
        for n in sorted({n for n, _ in self.short}):
            known = np.array(sorted(h for m, h in self.short if m == n), K.U)
            whole = np.zeros(len(line), bool)
            whole[at[size == n]] = True
            starts = K.windows(words.doc, n)
            starts = starts[line[starts] == line[starts + n - 1]]
            grams = K.ngrams(words.value, n)[starts] if len(starts) else np.zeros(0, K.U)
            some = np.isin(grams, known)
            for p, g in zip(starts[some].tolist(), grams[some].tolist(), strict=True):
                for k in self.short[n, g]:
                    d, hint = int(words.doc[p]), not whole[p]
                    found.setdefault((d, k, hint), {"item_id": self.ids[k], "n_words": n, "kind": "mention" if hint else "verbatim", "from_word": int(p - first[d]), "to_word": int(p + n - first[d])})
        return found


class _Stream:
    """The windows of some benchmark items, sorted by hash."""

    def __init__(self, ids: list[int], words: Words, lengths: np.ndarray, begin: np.ndarray, literal: bool):
        edge = np.searchsorted(words.doc, np.arange(len(ids) + 1))
        self.ids = ids
        self.n_words = lengths.tolist()
        self.items = [(words.value[a:b], words.kind[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        self.words_of = [(words.word[a:b] - o, words.last[a:b] - o) for a, b, o in zip(edge[:-1], edge[1:], begin[:-1], strict=True)]
        rows = []
        for k, (v, c) in enumerate(self.items):
            n = min(WINDOW, len(v))
            if n < SHORTEST:
                continue
            any_plain = np.zeros(len(v) - n + 1, bool)
            for h, slot in _forms(v, c):
                plain = np.convolve(~slot, np.ones(n, int), "valid") >= min(PLAIN, n)
                any_plain |= plain
                at = np.flatnonzero(plain)
                rows.append((K.ngrams(h, n)[at], np.full(len(at), n), np.full(len(at), k), at, np.zeros(len(at))))
            at = np.flatnonzero(~any_plain & literal)
            rows.append((K.ngrams(v, n)[at], np.full(len(at), n), np.full(len(at), k), at, np.ones(len(at))))
        join = lambda i, t: np.concatenate([r[i] for r in rows]).astype(t) if rows else np.zeros(0, t)
        h, n, item, at, literal = join(0, K.U), join(1, np.int32), join(2, np.int32), join(3, np.int32), join(4, bool)
        if len(h):
            both = np.unique(np.rec.fromarrays([h, n, item, at, literal], names="h,n,item,at,literal"))
            h, n, item, at, literal = (np.ascontiguousarray(both[x]) for x in ("h", "n", "item", "at", "literal"))
        self.hash, self.size, self.item, self.at, self.literal = h, n, item, at, literal
        self.lengths = sorted(set(n.tolist()))
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(h >> K.U(44)).astype(np.int64)] = True

    def search(self, words: Words, first: np.ndarray) -> dict[tuple[int, int, bool], dict]:
        """What is found, by text number, number of the item and whether it is a hint; first: where the words of each text begin."""
        doc, value, kind = words.doc, words.value, words.kind
        hits = []
        for h in [h for h, _ in _forms(value, kind)] + [value] * bool(self.literal.any()):
            for n in self.lengths:
                at = K.windows(doc, n)
                if not len(at):
                    continue
                g = K.ngrams(h, n)[at]
                may = np.flatnonzero(self.filter[(g >> K.U(44)).astype(np.int64)])
                g, at = g[may], at[may]
                low, high = np.searchsorted(self.hash, g, "left"), np.searchsorted(self.hash, g, "right")
                some = high > low
                hits.append((at[some], low[some], (high - low)[some], np.full(int(some.sum()), n)))
        at, low, times, size = (np.concatenate([x[i] for x in hits]) if hits else np.zeros(0, np.int64) for i in range(4))
        if not len(at):
            return {}
        by = np.argsort(doc[at], kind="stable")
        at, low, times, size = at[by], low[by], times[by], size[by]
        found: dict[tuple[int, int, bool], dict] = {}
        edge = np.append(np.flatnonzero(np.diff(doc[at], prepend=-1)), len(at))
        total = np.append(0, np.cumsum(times))
        i = 0
        while i < len(edge) - 1:
            j = max(i + 1, int(np.searchsorted(total[edge], total[edge[i]] + PAIRS, "right")) - 1)
            part = slice(edge[i], edge[j])
            n = times[part]
            entry = np.repeat(low[part], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            right = self.size[entry] == np.repeat(size[part], n)
            found |= self._aligned(np.repeat(at[part], n)[right], entry[right], words, first)
            i = j
        return found

    def _aligned(self, at: np.ndarray, entry: np.ndarray, words: Words, first: np.ndarray) -> dict[tuple[int, int, bool], dict]:
        """What pairs of windows, of whole documents, add up to."""
        doc, value = words.doc, words.value
        groups: dict[tuple[int, int, int], set[tuple[int, int, bool]]] = defaultdict(set)
        for d, p, k, q, n, literal in zip(doc[at].tolist(), at.tolist(), self.item[entry].tolist(), self.at[entry].tolist(), self.size[entry].tolist(), self.literal[entry].tolist(), strict=True):
            groups[d, k, p - q].add((q, n, literal))
        found: dict[tuple[int, int, bool], dict] = {}

        def report(d: int, k: int, shift: int, where: list[int], covered: int, kind: str) -> None:
            key = d, k, kind == "edited"
            if key not in found or found[key]["n_words"] < covered:
                found[key] = {"item_id": self.ids[k], "n_words": covered, "kind": kind, "from_word": int(words.word[where[0] + shift] - first[d]), "to_word": int(words.last[where[-1] + shift] + 1 - first[d])}

        for (d, k, shift), spans in sorted(groups.items()):
            v, c = self.items[k]
            begin, last = self.words_of[k]
            length = lambda where: len({w for q in where for w in range(begin[q], last[q] + 1)})  # noqa: B023, E731
            consistent = True
            # literal windows of numbers may keep a value that the templates replace; then the templates count alone
            for used in (spans, {x for x in spans if not x[2]}):
                where = sorted({q + i for q, n, _ in used for i in range(n)})
                covered = length(where)
                if covered < min(COVER, self.n_words[k]):
                    continue
                meant: dict[int, int] = {}
                same = consistent = True
                for q in where:
                    if c[q] != WORD or value[q + shift] != v[q]:
                        old = meant.setdefault(int(v[q]), int(value[q + shift]))
                        consistent &= old == int(value[q + shift])
                        same &= bool(value[q + shift] == v[q])
                if consistent:
                    report(d, k, shift, where, covered, "verbatim" if same else "reparameterised")
                    break
            if not consistent:
                where = sorted({q + i for q, n, _ in spans for i in range(n)})
                own = [q for q in where if value[q + shift] == v[q]]
                run: list[int] = []
                for q in [*own, -9]:
                    if run and q != run[-1] + 1:
                        if length(run) >= COVER:
                            report(d, k, shift, run, length(run), "verbatim" if length(run) >= VERBATIM else "edited")
                        run = []
                    run.append(q)
        return found


FOUND = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("n_words", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("from_word", T.IntegerType()), T.StructField("to_word", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("n_words", pa.int32()), ("kind", pa.string()), ("from_word", pa.int32()), ("to_word", pa.int32())]))


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", limit: int = BLOCK_WINDOWS) -> Iterator[Templates]:
    """Tables of at most about `limit` windows each; the driver holds one block of items at a time."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(item_id).cast("long"), F.col(text)).where(F.col(text).isNotNull()).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += 6 * (len(row[1]) // 2 + 1)
        if size >= limit:
            yield Templates(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Templates(ids, texts)


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", limit: int = BLOCK_WINDOWS, hints: bool = False) -> DataFrame:
    """The columns `keep` of docs and `found`, one entry for each benchmark item in the text; on request `hints`, likewise."""
    made = ["found", "hints"] if hints else ["found"]
    spark, keep = docs.sparkSession, [c for c in keep if c not in made]
    none = F.array().cast(FOUND)
    out = docs.select(F.struct(*keep).alias("__row"), F.col(text).alias("__text"), none.alias("found"), none.alias("hints"))
    shared, path = None, None
    for block in blocks(benchmark, text="text", limit=limit):
        if shared is not None:
            # the pass before is written, so that its table can go
            old, (out, path) = path, materialise(out, "decontaminated")
            shared.destroy()
            if old:
                release(spark, old)
        shared = spark.sparkContext.broadcast(block)
        out = _searched(out, shared)
    return out.select(*[F.col("__row")[c].alias(c) for c in keep], *made)


def _searched(rows: DataFrame, shared) -> DataFrame:
    """rows (__row, __text, found, hints) with what a block finds added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = shared.value
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("__text"))
            for i, j, r, o in K.chunks(raw, offsets):
                part = batch.slice(i, j - i)
                seen = templates.search(r, o)
                both = []
                for name, hint in (("found", False), ("hints", True)):
                    new = {d: these for d, what in seen.items() if (these := [x for x in what if (x["kind"] in HINTS) is hint])}
                    old = part.column(name).to_pylist() if new else None
                    both.append(part.column(name) if old is None else pa.array([old[k] + new.get(k, []) for k in range(j - i)], _ARROW))
                yield pa.RecordBatch.from_arrays([part.column("__row"), part.column("__text"), *[x.cast(_ARROW) for x in both]], names=["__row", "__text", "found", "hints"])

    return rows.mapInArrow(run, rows.schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", limit: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents in which no benchmark item is found, with their own columns."""
    packed = docs.select(F.struct(*docs.columns).alias("__doc"), F.col(text).alias("__body"))
    return find(packed, benchmark, ["__doc"], "__body", limit).where(F.size("found") == 0).select("__doc.*")
