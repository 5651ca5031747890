"""Near-duplicate documents from bottom-k sketches of one hash function.

A document's set holds the 64-bit hashes of its distinct five-word shingles. Its sketch keeps the k smallest hashes,
with k following the set: of two sets with a Jaccard index of at least t, each shares ``ceil(t * n)`` of its n
hashes with the other, so among its ``n - ceil(t * n) + 1`` first hashes, in an order common to all documents, at least
one is shared. Sketches of that size lose no link, whatever the sizes are.

* Sets that are equal collapse into one before anything is compared.
* Retained hashes that more than ``HOT_LEAST`` sets retain (a passage that a third of the corpus carries) come last in
  the common order: a set has to consist of them nearly whole before it enters their inverted lists. At most
  ``HOT_VALUES`` of them, those that most sets retain, are broadcast; the order stays common whichever they are.
* A retained hash that only one set retains is shared with no set in whose sketch a later hash of the first is found. So
  of the hashes before a shared one only those that several sets retain can be shared too (``r``, against ``p`` in all).
* An inverted list is compared in rounds, hubs against members. The first round has one hub per list, the first member
  in an order common to all lists, so that a group's lists agree on it: the set with the fewest hashes of its own (``u``),
  which is the text that a group's members were copied from, if it is there. Links join members into classes; a list whose
  members are of one class is closed. In the others each further round takes ``MORE_HUBS`` times as many hubs, spread
  over the classes, and compares them with the members of other classes. A hub has then met its whole list and leaves it.
  The rounds end when no list is open: every pair of a list was compared, ruled out by a bound, or is of one class.
* A set also has a parity mark of ``MARK_WORDS`` x 64 bits: each hash flips one bit. Two marks differ in at most as many
  bits as hashes are in one set alone, so pairs whose marks differ in more than the threshold allows stop there. Members
  carry their marks, and the join of a list tests bounds and marks itself: a pair far apart never becomes a row.
* The union of two sketches estimates the Jaccard index; pairs far below the threshold stop there. The rest is
  confirmed on the full sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.graph import components
from plinth.llm.words import lists, mix, sequences, slices
from plinth.runtime import cut, discard

HOT_VALUES = 200_000  # at most so many hashes are hot, whatever the corpus size
HOT_LEAST = 64  # a shorter inverted list is never hot
MARK_WORDS = 16
CELLS = 1 << 26  # bits that tell which documents' full sets are wanted: 8 MB
MORE_HUBS = 32  # rounds have fixed costs, so few rounds with many hubs


@dataclass(frozen=True)
class Threshold:
    """Jaccard index of at least ``num / den`` on shingles of ``width`` words."""

    num: int = 80
    den: int = 100
    width: int = 5

    def kept(self, n: int) -> int:
        return n + self.num * n // -self.den + 1

    def differ(self, most: Column, a: Column, b: Column) -> Column:
        """Can sets of ``a`` and ``b`` hashes, ``most`` or more of them in one set alone, reach the threshold?"""
        return (self.num + self.den) * most <= (self.den - self.num) * (a + b)

    def holds(self, shared: Column, a: Column, b: Column) -> Column:
        return self.den * shared >= self.num * (a + b - shared)


def shingle_sets(piece, width: int):
    """Per document of a slice: its distinct shingle hashes, ascending (int64)."""
    hashes = piece.hashes(fold=True)
    whole = sequences(hashes, width).view(np.int64)
    short = {n: sequences(hashes, n).view(np.int64) for n in range(1, width)}
    for row, count in enumerate(piece.count):
        at = piece.first[row]
        if count >= width:
            yield np.unique(whole[at:at + count - width + 1])
        elif count:
            yield short[count][at:at + 1]
        else:
            yield np.empty(0, dtype=np.int64)


def _mark(own: np.ndarray) -> np.ndarray:
    """Parity mark: bit i is the parity of the number of hashes whose top bits say i."""
    bits = MARK_WORDS * 64
    odd = np.bincount((own.view(np.uint64) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values occur in ``known`` (ascending, not empty)."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _sketched(rule: Threshold, hot: np.ndarray | None):
    """Task: documents -> set size, digest of the set and sketch. With ``hot``, only documents whose sketch changes."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for piece in slices(batch.column(1)):
                rows, sizes, ones, twos, values, counts, marks = [], [], [], [], [], [], []
                for row, own in enumerate(shingle_sets(piece, rule.width)):
                    k = rule.kept(len(own)) if len(own) else 0
                    sketch = own[:k]
                    if hot is not None:
                        if not _among(sketch, hot).any():
                            continue
                        common = _among(own, hot)
                        sketch = np.concatenate([own[~common], own[common]])[:k]
                    unsigned = own.view(np.uint64)
                    rows.append(row)
                    sizes.append(len(own))
                    ones.append(mix(unsigned).sum(dtype=np.uint64))
                    twos.append(mix(unsigned ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    values.append(sketch)
                    counts.append(k)
                    marks.append(_mark(own))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(piece.lo, piece.hi - piece.lo).take(pa.array(rows, type=pa.int64())),
                        pa.array(sizes, type=pa.int64()),
                        pa.array(np.array(ones, dtype=np.uint64).view(np.int64)),
                        pa.array(np.array(twos, dtype=np.uint64).view(np.int64)),
                        lists(np.concatenate(values) if values else np.empty(0, np.int64), np.array(counts, dtype=np.int64), pa.int64()),
                        lists(np.concatenate(marks) if marks else np.empty(0, np.int64), np.full(len(rows), MARK_WORDS), pa.int64()),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "sketch", "mark"],
                )

    return run


def _full_sets(width: int, wanted: np.ndarray):
    """Task: documents whose cell has its bit set in ``wanted`` -> full sets."""

    def run(batches):
        for batch in batches:
            cell = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((wanted[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)))
            for piece in slices(batch.column(1)):
                sets = list(shingle_sets(piece, width))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.lo, piece.hi - piece.lo),
                        lists(np.concatenate(sets), np.array([len(s) for s in sets]), pa.int64()),
                    ],
                    names=["doc_id", "hashes"],
                )

    return run


def _reach(rule: Threshold, p_a: Column, p_b: Column, n_a: Column, n_b: Column, before: Column) -> Column:
    """Can sets of ``n_a`` and ``n_b`` hashes that share one at positions ``p_a`` and ``p_b`` reach the threshold?

    At most ``before`` hashes before that one and the shorter rest after it can be shared too.
    """
    return rule.holds(F.least(n_a - p_a, n_b - p_b) + before, n_a, n_b)


def _first_shared(rows: DataFrame, rule: Threshold) -> DataFrame:
    """One row per pair from rows ``a, b, p_a, p_b, n_a, n_b``: nothing is shared before the first shared hash."""
    bounds = ("p_a", "p_b", "n_a", "n_b")
    first = rows.groupBy("a", "b").agg(*[F.min(c).alias(c) for c in bounds])
    return first.where(_reach(rule, *[F.col(c) for c in bounds], before=F.lit(0)))


def _confirmed(near: DataFrame, full: DataFrame, rule: Threshold) -> DataFrame:
    """Pairs whose full sets reach the threshold: ``u, v``."""
    one = full.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha"))
    two = full.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb"))
    shared = F.size(F.array_intersect("ha", "hb"))
    return near.join(one.join(near.select("a").distinct(), "a", "left_semi"), "a").join(two, "b").where(
        rule.holds(shared, F.size("ha"), F.size("hb"))
    ).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _marks_apart(one: Column, two: Column) -> Column:
    """Number of bits in which two marks differ, written out so that it is compiled."""
    return sum((F.bit_count(F.get(one, i).bitwiseXOR(F.get(two, i))) for i in range(MARK_WORDS)), F.lit(0))


def _full(texts: DataFrame, needed: DataFrame, rule: Threshold) -> DataFrame:
    """Full sets of the documents in ``needed(doc_id)``, and of a few more, as a written table.

    Ids are hashed into ``CELLS`` cells, and the bits of the wanted cells go to every task: texts are filtered where they
    are read, and nothing is shuffled.
    """
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)).alias("cell")
    bits = needed.select(F.bitmap_bucket_number(cell + 1).alias("block"), F.bitmap_bit_position(cell + 1).alias("bit"))
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = bits.repartition(parts, "block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    wanted = np.zeros(CELLS // 8, dtype=np.uint8)
    for row in blocks:
        own = np.frombuffer(row.bits, dtype=np.uint8)
        wanted[(row.block - 1) * len(own):row.block * len(own)] = own
    return cut(texts.select("doc_id", "text", cell).mapInArrow(_full_sets(rule.width, wanted), "doc_id long, hashes array<long>"))


def _hubs(members: DataFrame, most: int) -> DataFrame:
    """``value, hub`` of each list: up to ``most`` members, the same number of each class as far as it goes.

    Members come in an order common to all lists. A class gives one hub in the first two rounds and ``MORE_HUBS`` times as
    many in each later one, so that lists of a few large classes end after few rounds too.
    """
    hub = F.struct("u", F.xxhash64("rep").alias("order"), "rep", "p", "n", "r", "class", "mark").alias("hub")
    if most == 1:
        return members.groupBy("value").agg(F.min(hub).alias("hub"))
    turn = F.row_number().over(Window.partitionBy("value", "class").orderBy("hub"))
    place = F.row_number().over(Window.partitionBy("value").orderBy("turn", "hub"))
    first = members.select("value", "class", hub).withColumn("turn", turn).where(F.col("turn") <= most // MORE_HUBS)
    return first.withColumn("place", place).where(F.col("place") <= most).select("value", "hub")


def _met(members: DataFrame, hubs: DataFrame, rule: Threshold) -> DataFrame:
    """Pairs ``a, b`` of a hub and a member of another class in its list, if bounds and marks allow the threshold."""

    def side(one: str, two: str, out: str) -> Column:
        return F.when(F.col("rep") < F.col("hub.rep"), F.col(one)).otherwise(F.col(two)).alias(out)

    p, n, r = ((F.col(c), F.col(f"hub.{c}")) for c in "pnr")
    near = _reach(rule, *p, *n, before=F.least(*r)) & rule.differ(_marks_apart(F.col("mark"), F.col("hub.mark")), *n)
    rows = members.join(hubs, "value").where((F.col("class") != F.col("hub.class")) & near).select(
        F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b"),
        side("p", "hub.p", "p_a"), side("hub.p", "p", "p_b"), side("n", "hub.n", "n_a"), side("hub.n", "n", "n_b"),
    )
    return _first_shared(rows, rule).select("a", "b")


def _still_open(members: DataFrame, hubs: DataFrame, classes: DataFrame) -> DataFrame:
    """Lists without their hubs, with the members' new classes, where more than one class is left; a written table."""
    rest = members.drop("class").join(hubs.select("value", F.col("hub.rep").alias("rep")), ["value", "rep"], "left_anti")
    labelled = rest.join(classes.withColumnRenamed("id", "rep"), "rep", "left").select(
        *rest.columns, F.coalesce("component", "rep").alias("class")
    )
    mixed = labelled.groupBy("value").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi")
    return cut(labelled.join(mixed.select("value"), "value", "left_semi"))


def _linked(members: DataFrame, sketches: DataFrame, texts: DataFrame, rule: Threshold) -> DataFrame:
    """Classes ``id, component`` of linked sets from the lists ``value, rep, p, n, r, u, class, mark``; a written table."""
    spark, most = members.sparkSession, 1
    classes = spark.sql("SELECT 0L AS id, 0L AS component WHERE false")
    tested = spark.sql("SELECT 0L AS a, 0L AS b WHERE false")
    full = spark.sql("SELECT 0L AS doc_id, array(0L) AS hashes WHERE false")
    tables, met = [], []
    while not members.isEmpty():
        hubs = cut(_hubs(members, most))
        met.append(cut(_met(members, hubs, rule).join(tested, ["a", "b"], "left_anti")))
        near = cut(_estimated(met[-1], sketches, rule))
        needed = near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))).distinct()
        missing = cut(needed.join(full.select("doc_id"), "doc_id", "left_anti"))
        if not missing.isEmpty():
            tables.append(_full(texts, missing, rule))
            full = full.unionByName(tables[-1])
        links = classes.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(_confirmed(near, full, rule))
        classes, last = cut(components(links)), classes
        members, done = _still_open(members, hubs, classes), members
        tested = tested.unionByName(met[-1])
        discard(*(t for t in (hubs, near, missing, done, last) if hasattr(t, "cut_path")))
        most *= MORE_HUBS
    discard(*tables, *met)
    return classes


def _estimated(pairs: DataFrame, sketches: DataFrame, rule: Threshold) -> DataFrame:
    """Drop pairs whose union sketch puts the Jaccard index far (six deviations) below the threshold.

    The k smallest hashes of the union are a uniform sample of it; a hash of the sample lies in both sets exactly if
    both sketches hold it. Sketches that were reordered for hot hashes are no such sample and pass unfiltered.
    """
    one = sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"), F.col("plain").alias("pa"))
    two = sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"), F.col("plain").alias("pb"))
    k = F.least(F.size("sa"), F.size("sb"))
    sample = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    hits = F.size(F.array_intersect(sample, F.array_intersect("sa", "sb")))
    t = rule.num / rule.den
    least = k * t - 6 * F.sqrt(k * t * (1 - t))
    return (
        pairs.join(one, "a").join(two, "b")
        .where(~(F.col("pa") & F.col("pb")) | (hits >= least))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, rule: Threshold = Threshold()) -> DataFrame:
    """``docs(doc_id long, text)`` -> one row per row: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if their sets reach ``rule``; ``component_id`` is the smallest doc_id reachable over links.
    Null or empty texts and texts without words have no set and are linked with nothing. A null doc_id links nothing,
    has a null component and is kept. Rows with the same doc_id share their component. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, n_shingles long, d1 long, d2 long, sketch array<long>, mark array<long>"
    digest = ["d1", "d2", "n_shingles"]
    first = cut(texts.mapInArrow(_sketched(rule, None), kind))
    every = cut(first.select("doc_id", *digest))
    usable = first.where("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = cut(usable.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("mark").alias("mark")))

    discard(first)
    counts = sets.select(F.explode("sketch").alias("value")).groupBy("value").count().where(F.col("count") > HOT_LEAST)
    common = cut(counts.orderBy(F.desc("count"), "value").limit(HOT_VALUES).select("value"))
    hot = np.sort(np.array([r[0] for r in common.collect()], dtype=np.int64))
    discard(common)
    sketches = sets.withColumn("plain", F.lit(True))
    if len(hot):
        changed = texts.where("doc_id IS NOT NULL").mapInArrow(_sketched(rule, hot), kind)
        again = cut(changed.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("mark").alias("mark")))
        sketches = sketches.join(again.select(*digest), digest, "left_anti").unionByName(
            again.select(*digest, "rep", "sketch", "mark").withColumn("plain", F.lit(False))
        )
    sketches = cut(sketches.withColumn("n", F.col("n_shingles")))
    discard(sets)
    postings = sketches.select("rep", "n", F.size("sketch").alias("k"), F.posexplode("sketch").alias("p", "value"))
    # Most retained hashes occur once; they go before anything wider than a count is shuffled.
    repeated = cut(postings.groupBy("value").count().where("count > 1").select("value"))
    own = Window.partitionBy("rep")
    shared = cut(postings.join(repeated, "value", "left_semi").select(
        "value", "rep", "n", "p", (F.row_number().over(own.orderBy("p")) - 1).alias("r"), (F.col("k") - F.count(F.lit(1)).over(own)).alias("u")))
    discard(repeated)
    # Lists with the same members say the same; the first of them in the common order, where each member's position is
    # smallest, stands for all. Members are compared by two sums of hashes and their number.
    lists_ = shared.groupBy("value").agg(
        F.count(F.lit(1)).alias("length"), F.bit_xor(F.xxhash64("rep")).alias("s1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("s2"),
        F.sum("p").alias("depth"),
    )
    chosen = lists_.groupBy("length", "s1", "s2").agg(F.min(F.struct("depth", "value")).alias("x")).select("x.value")
    marks = sketches.select("rep", "mark")
    listed = cut(shared.join(chosen, "value", "left_semi").withColumn("class", F.col("rep")).join(marks, "rep"))
    discard(shared)
    found = _linked(listed, sketches, texts, rule).select(F.col("id").alias("rep"), "component")
    classes = cut(
        sketches.select(*digest, "rep").join(found, "rep", "left")
        .select(*digest, F.coalesce("component", "rep").alias("component_id"))
    )
    discard(sketches)
    placed = (
        every.where("doc_id IS NOT NULL").join(classes, digest)
        .groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    )
    return (
        every.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
