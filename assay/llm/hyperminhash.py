"""Near-duplicate groups by HyperMinHash sketches (operator 3).

A sketch has REGISTERS buckets. A shingle's hash picks a bucket; the bucket keeps, of its least hash value, the count of
leading zeros (6 bits) and 10 mantissa bits below the leading one, which merge by maximum. Empty buckets of small sets
borrow from a bucket that a fixed random order of the bucket names, so that bands of any set compare as those of a large
one. Bands of compressed registers are hashed; documents that agree in a band are candidates. A Jaccard estimate from the
raw registers, corrected for accidental register collisions, drops candidates that are six standard deviations below the
threshold, and the others are confirmed on their full shingle sets.

With 42 bands of 6 registers a pair at similarity 0.8 is missed with probability 3e-6, at 0.85 with 1e-9.

Work is kept in proportion to the rows. Documents with equal sets are one class from the start, so copies are never paired.
Then rounds follow: in each bucket that spans several components a centre is drawn, and every class outside the centre's
component tries one centre of its buckets, later up to TRIES, so rounds test a few pairs a class, while links join large groups of near
copies to one component within a few rounds. A round's links are kept as links between the labels of components, which it then
joins; links of earlier rounds are not walked again. What is still open is then tested in full: in each bucket that spans several
components each class outside the first one with all classes of other components. That is exact: every pair of a bucket is
either tested or already connected.

Growth: the rounds test a bounded number of pairs a class and yield at most as many links; the last step yields fewer links
than rows of guests and hosts, as each group of them passes on one link at most for each of its labels. The last step tests classes that share a band without being alike
enough (pages of one template at similarity 0.5 to 0.79) with all of each other: for m such classes in one bucket m * m / 2
estimates of registers, in blocks over many tasks. It is the price of losing no link; a million such classes cost some 40 core hours.

Defined results: null text, no words: n_shingles 0, linked with nothing, its own component. A document is a row; rows with
equal doc_id and text are one document, rows with equal doc_id and unlike texts are documents of their own that happen to
share the id. Rows without doc_id count as the largest, one document for each text; component_id is null if all rows of the
component are without. Classes are numbered, not hashed, so no two can be taken for one. Extra columns take no part, names
like those of outputs are replaced. An empty table gives an empty result; memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .components import components
from .storage import materialise, release

REGISTERS, BANDS, ROWS = 252, 42, 6
MANTISSA = 10
#: Rounds that pair each open class with one class, later with up to TRIES, of other components before all that is left
#: open is paired.
ROUNDS, TRIES = 2, 8
#: Shingles in a block, and classes that meet it in one group, when the rest is tested.
BLOCK_SHINGLES, BLOCK_CLASSES = 500_000, 1000
LAST = np.iinfo(np.int64).max
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_ORDER: np.ndarray | None = None


def key_of(doc_id: str) -> Column:
    """The doc_id; rows without one count as the largest."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(int(LAST)))


def tag_of(text: str) -> Column:
    return F.xxhash64(F.col(text))


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct word shingles of each text, sorted by both; shorter texts are one shingle."""
    raw = LOWER[raw] if lower else raw
    start, end, doc = K.words(raw, offsets)
    h = K.span_hashes(raw, start, end)
    at = K.windows(doc, size)
    owner, value = doc[at], K.ngrams(h, size)[at]
    n = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    for length in range(1, size):
        short = np.flatnonzero(n == length)
        if len(short):
            grams = K.ngrams(h, length)[first[short]]
            owner, value = np.concatenate([owner, short]), np.concatenate([value, K.mix(grams + K.U(length))])
    by = np.lexsort((value, owner))
    owner, value = owner[by], value[by]
    new = np.ones(len(by), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def codes(value: np.ndarray) -> np.ndarray:
    """Registers of single hashes: leading zeros and mantissa, larger for smaller hashes, never 0."""
    part, exponent = np.frexp(K.mix(value ^ K.U(0x2545F4914F6CDD1D)).astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 62).astype(np.int64)
    return ((zeros << MANTISSA) + (1023 - np.minimum(((part * 2 - 1) * 1024).astype(np.int64), 1023)) + 1).astype(np.uint16)


def sketch(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Registers (n, REGISTERS); 0 is empty. Sketches of unions are maxima of sketches."""
    out = np.zeros(n * REGISTERS, np.uint16)
    np.maximum.at(out, owner * REGISTERS + (value >> K.U(33)).astype(np.int64) % REGISTERS, codes(value))
    return out.reshape(n, REGISTERS)


def densified(registers: np.ndarray) -> np.ndarray:
    """Empty registers replaced by the first filled one in the bucket's own order of buckets."""
    global _ORDER
    if _ORDER is None:
        _ORDER = np.argsort(K.mix(np.arange(REGISTERS * REGISTERS, dtype=K.U) + K.U(7)).reshape(REGISTERS, REGISTERS), axis=1)
    out = registers.copy()
    row, column = np.nonzero((registers == 0) & (registers.any(axis=1))[:, None])
    for step in range(REGISTERS):
        if not len(row):
            break
        got = registers[row, _ORDER[column, step]]
        full = got > 0
        out[row[full], column[full]] = got[full]
        row, column = row[~full], column[~full]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(n, BANDS) hashes of the densified registers of each band."""
    parts = densified(registers).reshape(-1, BANDS, ROWS).astype(K.U)
    key = np.broadcast_to(np.arange(BANDS, dtype=K.U), parts.shape[:2]) + K.U(1)
    for k in range(ROWS):
        key = K.mix(key * K.U(0x100000001B3) + parts[:, :, k])
    return key


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimates, registers they rest on) of pairs of raw sketches, corrected for accidental collisions.

    Of registers that stem from unlike shingles about 0.1699 * 2 ** -MANTISSA * 4x / (1 + x) ** 2 agree by chance, x being
    the ratio of the set sizes.
    """
    used = ((a | b) > 0).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    x = np.maximum(n_a, n_b) / np.maximum(1, np.minimum(n_a, n_b))
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * x / (1 + x) ** 2
    return (same / np.maximum(used, 1) - chance) / (1 - chance), used


def _prints(value: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """128 bits of each set of shingles, as two columns."""
    end, out = np.cumsum(n), []
    for salt in (11, 13):
        total = np.zeros(len(value) + 1, K.U)
        np.cumsum(K.mix(value + K.U(salt)), out=total[1:])
        out.append(pa.array(K.mix(total[end] - total[end - n] + n.astype(K.U)).view(np.int64)))
    return out


def sketches(docs: DataFrame, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, tag, n, f1, f2, registers): f1 and f2 are a 128-bit fingerprint of the shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("text"))
            for i, j, r, o in K.chunks(raw, offsets):
                owner, value = shingles(r, o, size)
                n = np.bincount(owner, minlength=j - i)
                registers = sketch(owner, value, j - i)
                yield pa.RecordBatch.from_arrays([batch.column("k").slice(i, j - i), batch.column("tag").slice(i, j - i), pa.array(n.astype(np.int64)), *_prints(value, n), pa.array([x.tobytes() for x in registers], pa.binary())], names=["k", "tag", "n", "f1", "f2", "registers"])

    source = docs.select(key_of(doc_id).alias("k"), tag_of(text).alias("tag"), F.col(text).alias("text"))
    return source.mapInArrow(run, "k long, tag long, n long, f1 long, f2 long, registers binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                keys = band_keys(_matrix(part.column("registers"))).view(np.int64)
                again = lambda name, part=part: pa.array(np.repeat(part.column(name).to_numpy(), BANDS))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), again("rep"), again("n")], names=["key", "rep", "n"])

    return classes.select("rep", "n", "registers").mapInArrow(run, "key long, rep long, n long")


def _sets(docs: DataFrame, wanted: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(id, n, shingles, registers) of the classes `wanted` (rep, k, tag, f1, f2, n), from a row of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("text"))
            for i, j, r, o in K.chunks(raw, offsets):
                owner, value = shingles(r, o, size)
                n = np.bincount(owner, minlength=j - i)
                edge = np.append(0, np.cumsum(n)).tolist()
                registers = sketch(owner, value, j - i)
                yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64)), *_prints(value, n), pa.array([value[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary()), pa.array([x.tobytes() for x in registers], pa.binary())], names=["n", "f1", "f2", "shingles", "registers"])

    source = docs.select(key_of(doc_id).alias("k"), tag_of(text).alias("tag"), F.col(text).alias("text"))
    made = source.join(wanted.select("k", "tag").distinct(), ["k", "tag"], "left_semi").select("text").mapInArrow(run, "n long, f1 long, f2 long, shingles binary, registers binary")
    return made.join(wanted.select(F.col("rep").alias("id"), "f1", "f2", "n"), ["f1", "f2", "n"]).dropDuplicates(["id"]).select("id", "n", "shingles", "registers")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The labels, as (u, v), of the pairs (u, v, label_u, label_v) with 100 * |intersection| >= percent * |union|.

    The corrected estimate drops pairs that are six standard deviations below; the others are decided by their full sets.
    """
    of = lambda name: sets.select(F.col("id").alias(name), F.col("shingles").alias(f"s_{name}"), F.col("registers").alias(f"r_{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                a, b = ([np.frombuffer(x.as_buffer(), np.uint64) for x in part.column(c)] for c in ("s_u", "s_v"))
                j, used = estimate(_matrix(part.column("r_u")), _matrix(part.column("r_v")), np.array([len(x) for x in a]), np.array([len(x) for x in b]))
                t = percent / 100
                keep = j + 6 * np.sqrt(t * (1 - t) / np.maximum(used, 1)) + 0.01 >= t
                for k in np.flatnonzero(keep).tolist():
                    both = np.concatenate([a[k], b[k]])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    keep[k] = 100 * common >= percent * (len(both) - common)
                keep = pa.array(keep)
                yield pa.RecordBatch.from_arrays([part.column("label_u").filter(keep), part.column("label_v").filter(keep)], names=["u", "v"])

    return pairs.join(of("u"), "u").join(of("v"), "v").mapInArrow(run, "u long, v long")


def _joined(state: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, label) after links between labels have joined components."""
    step = components(links).withColumnsRenamed({"label": "least", "node": "label"})
    return state.join(step, "label", "left").select("rep", F.coalesce("least", "label").alias("label"))


def _tested_in_blocks(left: DataFrame, bucket: DataFrame, state: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, list[str]]:
    """Links (u, v) between the labels of components, from the buckets (key, rep, n, label, low) that still span several.

    Classes are dealt to blocks of bounded size by the least class they share a bucket with. A class outside its bucket's
    first component meets every block that has a member in one of its buckets, and there all members: a superset of its
    candidates, tested without a row for each pair. The classes that meet a block are dealt to parts of bounded size, too.
    Registers meet first; sets of shingles are sent only for classes that the estimate lets pass in that block, on either side.
    A group of guests and hosts joins labels as it finds links, and what it has joined is not tested again: it yields fewer
    links than it has labels, from each to the least that it is joined with.

    Families, blocks and meetings are tables of their own: in one plan each use of them starts its scans and broadcasts anew,
    all at once, and each of these takes some MB of the driver.
    """
    least = bucket.groupBy("key").agg(F.min("rep").alias("family"))
    family, p_family = materialise(bucket.join(least, "key").groupBy("rep", "n").agg(F.min("family").alias("family")), "sketch-families")
    parts = family.groupBy("family").agg(F.ceil(F.sum(F.col("n") + 64) / F.lit(float(BLOCK_SHINGLES))).alias("parts"))
    block, p_block = materialise(family.join(parts, "family").select("rep", F.xxhash64("family", F.pmod(F.xxhash64("rep"), "parts")).alias("block")), "sketch-blocks")
    here = left.join(block, "rep").select("key", "block").distinct()
    meets, p_meets = materialise(left.where("label <> low").select("key", "rep").join(here, "key").select("rep", "block").distinct(), "sketch-meetings")

    def sides(guests: DataFrame, hosts: DataFrame, *columns: str):
        """Guests and hosts (rep, block), grouped by block and part, with labels and the named columns of their sets."""
        salts = guests.groupBy("block").agg(F.ceil(F.count("*") / F.lit(float(BLOCK_CLASSES))).alias("salts"))
        own = sets.select(F.col("id").alias("rep"), *columns)
        of = lambda d: d.join(state, "rep").join(own, "rep").select(*[F.col(c).alias(c) for c in ("label", "block", "salt", "rep", *columns)]).groupBy("block", "salt")
        dealt = guests.join(salts, "block").withColumn("salt", F.pmod(F.xxhash64("rep"), "salts"))
        copied = hosts.join(salts, "block").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
        return of(dealt).cogroup(of(copied))

    def passing(row: np.ndarray, n: int, lab: int, labels: np.ndarray, size: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """The hosts of other labels whose size and estimate leave a link possible."""
        t = percent / 100
        other = np.flatnonzero((labels != lab) & (np.minimum(size, n) * 100 >= np.maximum(size, n) * percent))
        j, used = estimate(matrix[other], np.broadcast_to(row, (len(other), REGISTERS)), size[other], np.full(len(other), n))
        return other[j + 6 * np.sqrt(t * (1 - t) / np.maximum(used, 1)) + 0.01 >= t]

    def sift(guest: pa.Table, host: pa.Table) -> pa.Table:
        labels, size, matrix = host.column("label").to_numpy(), host.column("n").to_numpy(), _matrix(host.column("registers"))
        met, some = np.zeros(len(size), bool), np.zeros(guest.num_rows, bool)
        for i, (n, lab, row) in enumerate(zip(guest.column("n").to_pylist(), guest.column("label").to_pylist(), _matrix(guest.column("registers")), strict=True)):
            other = passing(row, n, lab, labels, size, matrix)
            met[other], some[i] = True, len(other) > 0
        rep = np.concatenate([guest.column("rep").to_numpy()[some], host.column("rep").to_numpy()[met]])
        return pa.table({"block": np.full(len(rep), guest.column("block")[0].as_py(), np.int64), "rep": rep, "guest": np.arange(len(rep)) < some.sum()})

    sifted, p_sifted = materialise(sides(meets, block, "n", "registers").applyInArrow(_nonempty(sift, SIFTED), "block long, rep long, guest boolean").distinct(), "sketch-sifted")

    def run(guest: pa.Table, host: pa.Table) -> pa.Table:
        own = [np.frombuffer(x.as_buffer(), np.uint64) for x in host.column("shingles")]
        size = np.array([len(x) for x in own])
        value, owner = np.concatenate(own), np.repeat(np.arange(len(own)), size)
        by = np.argsort(value)
        value, owner = value[by], owner[by]
        was = np.concatenate([guest.column("label").to_numpy(), host.column("label").to_numpy()])
        now = was.copy()
        guest_label, host_label = now[: guest.num_rows], now[guest.num_rows :]
        matrix = _matrix(host.column("registers"))
        for i, (cell, row) in enumerate(zip(guest.column("shingles"), _matrix(guest.column("registers")), strict=True)):
            x, lab = np.frombuffer(cell.as_buffer(), np.uint64), guest_label[i]
            other = passing(row, len(x), lab, host_label, size, matrix)
            if not len(other):
                continue
            low, high = np.searchsorted(value, x, "left"), np.searchsorted(value, x, "right")
            times = high - low
            common = np.bincount(owner[np.repeat(low - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))], minlength=len(own))[other]
            other = other[100 * common >= percent * (len(x) + size[other] - common)]
            if len(other):
                met = np.append(host_label[other], lab)
                now[np.isin(now, met)] = met.min()
        label, at = np.unique(was, return_index=True)
        joined = now[at] != label
        return pa.table({"u": label[joined], "v": now[at][joined]})

    part = lambda guest: sifted.where(F.col("guest") == guest).select("rep", "block")
    return sides(part(True), part(False), "shingles", "registers").applyInArrow(_nonempty(run, PAIRS), "u long, v long"), [p_family, p_block, p_meets, p_sifted]


PAIRS = pa.schema([("u", pa.int64()), ("v", pa.int64())])
SIFTED = pa.schema([("block", pa.int64()), ("rep", pa.int64()), ("guest", pa.bool_())])


def _nonempty(run, schema: pa.Schema):
    def guarded(guest: pa.Table, host: pa.Table) -> pa.Table:
        if guest.num_rows and host.num_rows:
            return run(guest, host)
        return schema.empty_table()

    return guarded


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs."""
    out = _labelled(docs, size, percent, doc_id, text, rounds)
    real = lambda c: F.when(F.col(c) < int(LAST), F.col(c))
    kept = F.when(F.col("least") == int(LAST), F.col("tag") == F.col("least_tag")).otherwise(F.col("k") == F.col("least"))
    return out.select(real("k").alias("doc_id"), F.col("n").alias("n_shingles"), real("least").alias("component_id"), kept.alias("kept"))


def _labelled(docs: DataFrame, size: int, percent: int, doc_id: str, text: str, rounds: int = ROUNDS) -> DataFrame:
    """(k, tag, n, least, least_tag) of every row: its key, and the key and text of the least row of its component."""
    spark = docs.sparkSession
    rows, _ = materialise(sketches(docs, size, doc_id, text), "sketches")
    classes = rows.where("n > 0").groupBy("f1", "f2", "n").agg(F.min(F.struct("k", "tag")).alias("r"), F.first("registers").alias("registers"))
    classes, _ = materialise(classes.select("f1", "f2", "n", "r.k", "r.tag", "registers", F.monotonically_increasing_id().alias("rep")), "sketch-classes")
    bands, p_bands = materialise(_bands(classes), "sketch-bands")
    shared = bands.groupBy("key").count().where("count > 1").select("key")
    bucket, p_bucket = materialise(bands.join(shared, "key", "left_semi"), "sketch-buckets")
    release(spark, p_bands)
    # the label of each class's component: a round's links join labels, so that links of earlier rounds are not walked again
    state, p_first = materialise(bucket.select("rep").distinct().withColumn("label", F.col("rep")), "sketch-labels")
    wanted = classes.select("rep", "k", "tag", "f1", "f2", "n").join(state.select("rep"), "rep", "left_semi")
    sets, p_sets = materialise(_sets(docs, wanted, size, doc_id, text), "shingle-sets")
    fits = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * percent
    for r in range(rounds):
        placed, p_placed = materialise(bucket.join(state, "rep"), "sketch-placed")
        rank = F.col("rep") if r == 0 else F.xxhash64(F.lit(r), "rep")
        center = placed.groupBy("key").agg(F.min(F.struct(rank.alias("rank"), "rep", "n", "label")).alias("c"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        center = center.select("key", F.col("c.rep").alias("v"), F.col("c.n").alias("n_v"), F.col("c.label").alias("label_v"))
        tries = placed.join(center, "key").where((F.col("label") != F.col("label_v")) & fits(F.col("n"), F.col("n_v"))).select(F.col("rep").alias("u"), F.col("label").alias("label_u"), "v", "label_v")
        rank = F.col("v") if r == 0 else F.xxhash64(F.lit(r), "u", "v")
        some = F.slice(F.array_sort(F.collect_set(F.struct(rank.alias("rank"), "v", "label_v"))), 1, 1 if r == 0 else TRIES)
        tries = tries.groupBy("u", "label_u").agg(some.alias("c")).select("u", "label_u", F.inline("c")).drop("rank")
        found, p_found = materialise(_confirmed(tries, sets, percent), "near-links")
        linked = found.limit(1).count()
        if linked:
            state = _joined(state, found)
        release(spark, p_placed, p_found)
        if not linked:
            break
    # what the rounds left open: every class outside a bucket's first component with all classes of other components there
    state, _ = materialise(state, "sketch-labels")
    release(spark, p_first)
    placed, p_placed = materialise(bucket.join(state, "rep"), "sketch-placed")
    open_keys = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key", "low")
    left, p_left = materialise(placed.join(open_keys, "key"), "sketch-open")
    tested, p_tested = _tested_in_blocks(left, bucket, state, sets, percent)
    found, p_found = materialise(tested, "near-links")
    if found.limit(1).count():
        state = _joined(state, found)
    release(spark, p_bucket, p_sets, p_placed, p_left, *p_tested, p_found)
    known = classes.select("f1", "f2", "n", "k", "tag", "rep").join(state, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    least = known.groupBy("label").agg(F.min(F.struct("k", "tag")).alias("least"))
    known = known.join(least, "label").select("f1", "f2", "n", F.col("least.k").alias("least"), F.col("least.tag").alias("least_tag"))
    out = rows.select("k", "tag", "n", "f1", "f2").join(known, ["f1", "f2", "n"], "left")
    return out.select("k", "tag", "n", F.coalesce("least", "k").alias("least"), F.coalesce("least_tag", "tag").alias("least_tag"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates: that with the least doc_id, of equal ids that with the least hash of the
    text, of rows that are equal in both that with the least hash of all columns. Other rows with a shared id stay."""
    kept = _labelled(docs, size, percent, doc_id, text).select(F.col("least").alias("__k"), F.col("least_tag").alias("__tag")).distinct()
    whole = F.struct(*docs.columns)
    keyed = docs.select(whole.alias("__row"), key_of(doc_id).alias("__k"), tag_of(text).alias("__tag"))
    one = keyed.join(kept, ["__k", "__tag"], "left_semi").groupBy("__k", "__tag").agg(F.min_by("__row", F.xxhash64("__row")).alias("__row"))
    return one.select("__row.*")
