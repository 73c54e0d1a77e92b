"""N-gram Jaccard join by vertical partitioning, and the components of its links.

A document's set holds the hashes of its distinct word shingles.  All n-grams have
one global order: first by heat (a coarse class of how often the n-gram occurs,
from a sketch summed over the corpus), then by hash.  The sketch's sight ends at the noise of its cells, so n-grams of the
coldest class that ``CROWD`` sets or more share are counted exactly (in the prefixes, then in the whole sets of those that
hold one there), marked in a table of bits of fixed size and moved up one class; a full table would leave the order
as it was, never wrong.  The order is cut into
fragments, so each set falls into one segment per fragment.

1. *Prefix index.*  Two sets that reach the threshold share one of the first
   ``n - ceil(threshold * n) + 1`` n-grams in the global order of each.  Only those are indexed;
   hot n-grams come last in the order and so hardly occur in the index.
2. *Candidates without all pairs of a group.*  Equal sets are one class.  In each
   round every indexed n-gram links its classes to one hub, so a group of m classes yields m - 1
   pairs, and pairs met at a fair share of their prefixes are verified.  Classes found connected are
   contracted, and n-grams whose classes all lie in one component drop out.  The last round takes every
   remaining pair in different components whose shared prefix n-grams, counted in full, leave the
   threshold possible, so no link between components can be lost.
3. *Partial overlaps.*  Candidate pairs meet the segments fragment by fragment; the partial counts
   are summed per pair and compared with the exact integer rule
   ``100 * intersection >= percent * union``.

Defined cases: null or empty text, or one without words, has an empty set and is
linked with nothing; a text with fewer words than a shingle has its whole word
sequence as the one shingle; equal sets are linked; repeated equal rows act as one document and are
returned once each (an id with several texts is verified by its bytewise smallest one); an empty
table gives an empty result; extra columns are not read.  A null id forms no link and its component is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanthorn.llm import textbuf as tb
from lanthorn.llm.common import count_blobs, free_names, id_and_bytes, release, summed_counts, written

WIDTH = 4
PERCENT = 85
SKETCH = 1 << 19
SKETCH_SLICES = 16
HEAT_BITS = 5
HASH_BITS = 63 - HEAT_BITS
FRAGMENTS_BITS = 3
CROWD = 8  # so many sets that share an n-gram of the coldest class move it up
CROWD_BITS = 26  # of the table of crowded n-grams, 8 MiB whatever the corpus
BITMAP_BITS = 1 << 15  # of one of Spark's bitmaps
SLICE_BYTES = 1 << 19
HUB_ROUNDS = 2
HUB_SHARE = 4  # a hub pair is verified if it meets at a quarter of the shorter prefix at least
BROADCAST_IDS = 1 << 20
SIGNATURE_BITS = 2048
PROFILE = "doc_id bigint, n_shingles bigint, set_hash bigint, prefix array<bigint>, sig array<bigint>"


def shingles(x: tb.Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every word shingle (lower-cased A-Z), repeated ones included."""
    s, e, d = x.words()
    h = tb.span_hash(x.prefix_hash(tb.TABLE_LOWER), s, e)
    n = len(h)
    count = np.bincount(d, minlength=x.n)
    first = np.cumsum(count) - count
    parts = [h[j:n - width + 1 + j] for j in range(width)] if n >= width else [h[:0]] * width
    keys = tb.chain(parts)
    same = d[width - 1:] == d[:n - width + 1] if n >= width else np.zeros(0, bool)
    out, at = [keys[same]], [d[: len(same)][same]]
    for c in range(1, width):
        few = np.flatnonzero(count == c)
        out.append(tb.chain([h[first[few] + j] for j in range(c)] + [np.full(len(few), c, dtype=tb.U64)]))
        at.append(few)
    return np.concatenate(out), np.concatenate(at)


def crowded(key: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether n-grams (by order key) are of the coldest class and marked as crowded."""
    cell = key & ((1 << CROWD_BITS) - 1)
    return (key >> HASH_BITS == 0) & ((marks[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1)


def ordered_sets(x: tb.Texts, width: int, order_of):
    """Distinct shingles of every text of a slice in the global order: (order keys, offsets, text per key).

    ``order_of`` holds the heat classes and the marks of crowded n-grams.  The low ``HASH_BITS`` of a key do not depend on it.
    """
    heat, marks = order_of
    h, d = shingles(x, width)
    hot = heat[(h & tb.U64(SKETCH - 1)).astype(np.int64)].astype(tb.U64)
    key = (hot << tb.U64(HASH_BITS)) | (h >> tb.U64(HEAT_BITS + 1))
    if marks is not None:
        key |= crowded(key.astype(np.int64), marks).astype(tb.U64) << tb.U64(HASH_BITS)
    order = np.argsort(key)
    order = order[np.argsort(d[order].astype(np.uint16 if x.n < 65536 else np.int64), kind="stable")]
    key, d = key[order].astype(np.int64), d[order]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (d[1:] != d[:-1])
    key, d = key[fresh], d[fresh]
    sizes = np.bincount(d, minlength=x.n)
    return key, np.concatenate([[0], np.cumsum(sizes)]), d


def fragment(key: np.ndarray) -> np.ndarray:
    """Stretch of the global order an n-gram lies in: the coldest class makes several, each hotter class one."""
    hot = key >> HASH_BITS
    return np.where(hot == 0, key >> (HASH_BITS - FRAGMENTS_BITS), (1 << FRAGMENTS_BITS) - 1 + hot)


def ngram_heat(docs: DataFrame, width: int, text_col: str = "text") -> np.ndarray:
    """Heat class per sketch cell: 0 for cells near the mean, else the bit length of the excess."""

    def count(batches):
        total = np.zeros(SKETCH, dtype=np.int64)
        for b in batches:
            for x in tb.slices(b, "text", SLICE_BYTES):
                h, _ = shingles(x, width)
                total += np.bincount((h & tb.U64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        yield count_blobs(total, SKETCH_SLICES)

    blobs = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "slice int, counts binary")
    cells = summed_counts(blobs, SKETCH, SKETCH_SLICES)
    mean = cells.mean()
    excess = np.maximum((cells - mean) / (2 * np.sqrt(mean) + 2), 1)
    return np.minimum(np.log2(excess).astype(np.int64), (1 << HEAT_BITS) - 1).astype(np.uint8)


def profiles(docs: DataFrame, order_of, width: int, percent: int) -> DataFrame:
    """Per document: set size, set hash, the indexed prefix of its set, and parity bits of the set.

    Only the prefix depends on the global order.

    A bit holds the parity of the n-grams that fall on it, so two sets' bits differ in no
    more places than the sets themselves: a bound that rules pairs out, never in.
    """

    def run(batches):
        for b in batches:
            for x in tb.slices(b, "text", SLICE_BYTES):
                key, offs, d = ordered_sets(x, width, order_of.value)
                n = np.diff(offs)
                grams = tb.mix((key & ((1 << HASH_BITS) - 1)).astype(tb.U64))
                mixed = np.concatenate([[tb.U64(0)], np.cumsum(grams, dtype=tb.U64)])
                sets = tb.mix((mixed[offs[1:]] - mixed[offs[:-1]]) + n.astype(tb.U64)).astype(np.int64)
                keep = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
                rank = np.arange(len(key)) - offs[d]
                taken = rank < keep[d]
                prefix = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(keep)]), pa.int32()), pa.array(key[taken]))
                bit = (grams & tb.U64(SIGNATURE_BITS - 1)).astype(np.int64)
                place, times = np.unique(d * SIGNATURE_BITS + bit, return_counts=True)
                odd = np.zeros(x.n * SIGNATURE_BITS, dtype=np.uint8)
                odd[place[times & 1 == 1]] = 1
                sig = np.packbits(odd).view("<i8")
                words = SIGNATURE_BITS // 64
                sig = pa.ListArray.from_arrays(pa.array(np.arange(x.n + 1) * words, pa.int32()), pa.array(sig))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(x.first, x.n), tb.long_column(n), tb.long_column(sets), prefix, sig],
                    names=["doc_id", "n_shingles", "set_hash", "prefix", "sig"])

    return docs.mapInArrow(run, PROFILE)


def whole_sets(docs: DataFrame, order_of, width: int) -> DataFrame:
    """(prefix): all n-grams of each set, the prefix cut nowhere."""

    def run(batches):
        for b in batches:
            for x in tb.slices(b, "text", SLICE_BYTES):
                key, offs, _ = ordered_sets(x, width, order_of.value)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(key))], names=["prefix"])

    return docs.mapInArrow(run, "prefix array<bigint>")


def crowded_cells(prefixes: DataFrame) -> np.ndarray:
    """Packed table of the cells of n-grams of the coldest class that ``CROWD`` prefixes or more hold."""
    grams = prefixes.select(F.explode("prefix").alias("gram")).where(f"gram < {1 << HASH_BITS}")
    many = grams.groupBy("gram").count().where(f"count >= {CROWD}").selectExpr(f"(gram & {(1 << CROWD_BITS) - 1}) + 1 as cell")
    maps = (many.groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")))
    out = np.zeros(((1 << CROWD_BITS) // BITMAP_BITS, BITMAP_BITS // 8), dtype=np.uint8)
    for row in maps.toLocalIterator():  # CROWD_BITS bound their number
        out[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def holders_of_crowded(prefixes: DataFrame, order_of) -> DataFrame:
    """(rep) of the prefixes with a crowded n-gram: all others stay as they are, crowded n-grams coming later."""

    def run(batches):
        for b in batches:
            grams = b.column(1)
            at = np.repeat(np.arange(len(grams)), np.diff(grams.offsets.to_numpy()))
            hit = crowded(grams.flatten().to_numpy(zero_copy_only=False), order_of.value[1])
            rows = np.unique(at[hit])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows))], names=["rep"])

    return prefixes.select("rep", "prefix").mapInArrow(run, "rep bigint")


def indexed_prefixes(prof: DataFrame, classes: DataFrame, base: DataFrame, heat: np.ndarray, width: int, percent: int):
    """(rep, n, prefix) of the classes, and the global order they are cut from, its crowded n-grams moved up."""
    spark = prof.sparkSession

    def of_classes(rows):
        keep = [rows.doc_id == classes.rep, rows.set_hash == classes.set_hash]
        once = rows.join(classes.hint("merge"), keep, "left_semi").dropDuplicates(["doc_id", "set_hash"])
        return once.selectExpr("doc_id as rep", "n_shingles as n", "prefix")

    def texts_of(reps):
        need = written(reps.distinct().withColumnRenamed("rep", "doc_id"), "jaccard-moved")
        # the ids are broadcast only below a checked count; beyond it the texts are shuffled
        few = need.count() <= BROADCAST_IDS
        return need, base.join(F.broadcast(need) if few else need.hint("merge"), "doc_id", "left_semi")

    prefixes = written(of_classes(prof), "jaccard-prefixes")
    marks = crowded_cells(prefixes)
    order_of = spark.sparkContext.broadcast((heat, marks))
    if not marks.any():
        return prefixes, order_of
    _, texts = texts_of(holders_of_crowded(prefixes, order_of))
    plain = spark.sparkContext.broadcast((heat, None))
    order_of = spark.sparkContext.broadcast((heat, marks | crowded_cells(whole_sets(texts, plain, width))))
    release(spark)
    moved, texts = texts_of(holders_of_crowded(prefixes, order_of))
    again = of_classes(profiles(texts, order_of, width, percent))
    stay = prefixes.join(moved.withColumnRenamed("doc_id", "rep").hint("merge"), "rep", "left_anti")
    prefixes = written(stay.union(again), "jaccard-prefixes")
    release(spark)
    return prefixes, order_of


def segments(docs: DataFrame, order_of, width: int) -> DataFrame:
    """(rep, frag, grams): each set cut at the fragment borders of the global order."""

    def run(batches):
        for b in batches:
            for x in tb.slices(b, "text", SLICE_BYTES):
                key, offs, d = ordered_sets(x, width, order_of.value)
                frag = fragment(key)
                new = np.ones(len(key), dtype=bool)
                new[1:] = (frag[1:] != frag[:-1]) | (d[1:] != d[:-1])
                at = np.flatnonzero(new)
                rows = pa.array(d[at])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(x.first, x.n).take(rows), pa.array(frag[at], pa.int64()).cast(pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.append(at, len(key)), pa.int32()), pa.array(key))],
                    names=["rep", "frag", "grams"])

    return docs.mapInArrow(run, "rep bigint, frag int, grams array<bigint>")


def verified(pairs: DataFrame, segs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, na, b, nb) that reach the threshold: partial overlaps per fragment, summed per pair."""
    left = segs.select(F.col("rep").alias("a"), "frag", F.col("grams").alias("ga"))
    right = segs.select(F.col("rep").alias("b"), "frag", F.col("grams").alias("gb"))
    part = (pairs.join(left, "a").join(right, ["b", "frag"])
            .select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("bigint").alias("part")))
    whole = part.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("common"))
    return whole.where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable over links (a, b); nodes without links are absent.

    Each round every node takes the smallest label among itself and its neighbours, then
    labels are shortened through the label's own label.  Both steps are map-side
    combined minima, so a hub with many links is no hot spot.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    edges = written(both.toDF("node", "other"), name + "-edges")
    labels = written(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), name)
    while True:
        near = edges.join(labels.toDF("other", "seen"), "other").select("node", F.col("seen").alias("root"))
        step = labels.union(near).groupBy("node").agg(F.min("root").alias("root"))
        jump = (step.join(step.toDF("root", "further"), "root", "left")
                .select("node", F.least("root", F.coalesce("further", "root")).alias("root")))
        new = written(jump, name)
        changed = new.join(labels.withColumnRenamed("root", "old"), "node").where("root <> old").limit(1).count()
        labels = new
        if not changed:
            return labels


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    spark = docs.sparkSession
    base = id_and_bytes(docs, id_col, text_col)
    heat = ngram_heat(base, width)  # SKETCH numbers, whatever the corpus
    prof = written(profiles(base, spark.sparkContext.broadcast((heat, None)), width, percent), "jaccard-profiles")
    sets = prof.where("n_shingles > 0 and doc_id is not null").groupBy("set_hash", "n_shingles").agg(
        F.min("doc_id").alias("rep"))
    classes = written(sets, "jaccard-classes")

    prefixes, order_of = indexed_prefixes(prof, classes, base, heat, width, percent)
    index = prefixes.select("rep", "n", F.posexplode("prefix").alias("place", "gram"))
    shared = written(shared_grams(index), "jaccard-index")
    release(spark)
    links = linked_classes(shared, prof, base, order_of, width, percent)

    same = prof.select("doc_id", "n_shingles", "set_hash")
    known = same.join(classes.withColumnRenamed("n_shingles", "n"),
                      (same.set_hash == classes.set_hash) & (same.n_shingles == F.col("n")) & same.doc_id.isNotNull(), "left")
    known = known.select("doc_id", "n_shingles", "rep")
    known = known.join(links.toDF("rep", "root"), "rep", "left")
    return known.select("doc_id", "n_shingles", F.coalesce("root", "rep", "doc_id").alias("component_id"))


def shared_grams(index: DataFrame) -> DataFrame:
    """Index rows of n-grams that occur in two classes at least, most n-grams occurring in one only."""
    seen = Window.partitionBy("gram").orderBy("rep")
    ends = index.select("gram", "rep", "n", "place", F.lag("rep").over(seen).alias("before"), F.lead("rep").over(seen).alias("after"))
    return ends.where("before is not null or after is not null").select("gram", "rep", "n", "place")


def linked_classes(shared: DataFrame, prof: DataFrame, base: DataFrame, order_of, width: int, percent: int) -> DataFrame:
    """(node, root) of every linked class; each turn's shuffle files are released before the next."""
    spark = shared.sparkSession
    segs = links = roots = tested = None
    open_ = shared.withColumn("root", F.col("rep"))
    for turn in range(HUB_ROUNDS + 1):
        if roots is not None:
            open_ = written(still_open(open_, roots), "jaccard-open")
            if open_.isEmpty():
                break
        pairs = written(near_enough(candidates(open_, turn, percent, tested), prof, percent), "jaccard-pairs")
        release(spark)
        segs = segments_of(pairs, segs, base, order_of, width)
        found = written(verified(pairs, segs, percent), "jaccard-links")
        release(spark)
        links = found if links is None else links.union(found)
        done = pairs.select("a", "b")
        tested = done if tested is None else tested.union(done)
        roots = components(links)
        release(spark)
    return roots


def still_open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Index rows with their classes' present components, of n-grams that still span several."""
    rows = rows.drop("root").join(roots.toDF("rep", "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    several = rows.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    return rows.join(several.select("gram"), "gram", "left_semi")


def candidates(rows: DataFrame, turn: int, percent: int, tested: DataFrame | None) -> DataFrame:
    """Untested pairs (a, b, na, nb) that may reach the threshold: with a hub per n-gram, in the last turn all across components.

    ``need`` is the smallest overlap of two sets at the threshold.  All n-grams they share lie at or after the first one in
    both sets, so that one has ``need`` n-grams at least from its place on in each: rows of other n-grams need not meet.
    Of these rows, the last leaves no more shared n-grams than follow it in either set.
    """
    need = f"((cast({percent} * (na + nb) as bigint) + {99 + percent}) div {100 + percent})"
    alike = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    beyond = lambda n: f"cast(({percent} * {n} + 99) div 100 - 1 as bigint)"  # noqa: E731  n-grams after the prefix
    if turn < HUB_ROUNDS:
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
        hubs = rows.groupBy("gram").agg(F.min(F.struct(order.alias("o"), "rep", "n", "root")).alias("hub"))
        pairs = (rows.join(hubs, "gram").where("root <> hub.root")
                 .selectExpr("rep as x", "n as nx", "hub.rep as y", "hub.n as ny"))
        pairs = pairs.selectExpr("least(x, y) as a", "greatest(x, y) as b", "if(x < y, nx, ny) as na", "if(x < y, ny, nx) as nb")
        pairs = pairs.where(alike).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("met"))
        pairs = pairs.where(f"{HUB_SHARE} * met >= least(na - {beyond('na')}, nb - {beyond('nb')})")
    else:
        one = rows.selectExpr("gram", "rep as a", "n as na", "place as pa", "root as ra")
        other = rows.selectExpr("gram", "rep as b", "n as nb", "place as pb", "root as rb")
        pairs = one.join(other, "gram").where(f"a < b and ra <> rb and {alike} and pa + {need} <= na and pb + {need} <= nb")
        pairs = pairs.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("met"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
        pairs = pairs.where(f"met + least(na - 1 - pa, nb - 1 - pb) >= {need}")
    pairs = pairs.select("a", "b", "na", "nb")
    return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")


def near_enough(pairs: DataFrame, prof: DataFrame, percent: int) -> DataFrame:
    """Pairs whose parity bits differ in no more places than sets at the threshold may differ."""
    left = prof.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa"))
    right = prof.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb"))
    apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, v: t + v)
    rows = pairs.join(left, "a").join(right, "b").where((100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb")))
    return rows.select("a", "b", "na", "nb").distinct()


def segments_of(pairs: DataFrame, segs: DataFrame | None, base: DataFrame, order_of, width: int) -> DataFrame:
    """``segs`` with the segments of the pairs' sets that it lacks."""
    need = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    if segs is not None:
        need = need.join(segs.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_anti")
    need = written(need, "jaccard-need")
    count = need.count()
    if not count and segs is not None:
        return segs
    # the ids are broadcast only below a checked count; beyond it the texts are shuffled
    need = F.broadcast(need) if count <= BROADCAST_IDS else need.hint("merge")
    texts = base.join(need, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    new = written(segments(texts, order_of, width), "jaccard-segments")
    return new if segs is None else segs.union(new)


def one_per_component(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; equal rows of one id are one document."""
    gone_id, copy = free_names(docs, "gone_id", "copy_of_" + id_col)
    found = written(jaccard_components(docs, width, percent, id_col, text_col), "jaccard-found")
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias(gone_id)).distinct()
    # the ids are broadcast only below a checked count; beyond it the texts are shuffled
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone.hint("merge")
    kept = docs.join(gone, F.col(id_col).cast("bigint") == F.col(gone_id), "left_anti")
    again = found.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if again.isEmpty():
        return kept
    order = Window.partitionBy(id_col).orderBy(F.col(text_col), *[c for c in docs.columns if c not in (id_col, text_col)])
    numbered = kept.withColumn(copy, F.row_number().over(order))
    return numbered.where((F.col(copy) == 1) | F.col(id_col).isNull()).select(*docs.columns)
