"""Merkle manifest of a dataset: a digest and a proof for every row, without sorting the rows.

*Leaves.*  A leaf is the hash of a row's fields, each with its length, built by the scan.

*Coordinates.*  A leaf's place in its group is the number of smaller ids there.  Ids are cut into buckets of
2^15; per (group, bucket) Spark's bitmap aggregates mark the ids that occur, partial bitmaps of many tasks being
merged by OR.  A popcount directory per bitmap (ones before each stretch of 512 bits) and directories of buckets,
buckets of buckets and so on (rows before each child of one parent, at most 2^15 of them) turn an id into its
rank by a few lookups.  A bucket with more rows than ones holds repeated ids; its rows, and those without an id, are
ranked by (id, leaf, altered leaf) range by range instead, so no group or id comes together in one task.

*Levels.*  Leaves are keyed by (group, place div 4096) into slot arrays, each of which is reduced by
its twelve levels in one task; the arrays' roots are the leaves of the next round.  What remains per group is its subroot, and the
subroots, in order of the groups, are reduced likewise to the root.  Going back, each array
gets the siblings above it, and each leaf its proof.

Defined cases: a null field is ``-``, an empty text ``0:``; null ids come first in their group, rows of equal ids
in order of their leaves; a null group is a group of its own, first; a group of one leaf is its own subroot; an empty table gives
an empty result; extra columns are not read; a null id is not altered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanthorn.llm.common import written
from lanthorn.operators.ordinal import global_ordinal, rank_within
from lanthorn.session import small_side

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BUCKET_BITS = 15
#: bits that one entry of a bitmap's popcount directory stands for
STRETCH = 512
SLOT_BITS = 12
#: kinds of steps of a proof: no sibling, sibling to the right, sibling to the left
ALONE, RIGHT, LEFT = 0, 1, 2
STEP = 33


def leaf_hash(fields: list[Column]) -> Column:
    """Lower-case hex of the hash of all fields, each ``-`` if null, else its UTF-8 length, a colon and its value."""
    def one(c):
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def leaves(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", group_col: str = "lang", altered: Column | None = None,
           alter: dict | None = None) -> DataFrame:
    """(grp, id, leaf, other): digests as bytes; ``other`` where ``altered`` holds, of the row with ``alter``'s fields."""
    plain = leaf_hash([F.col(f) for f in fields])
    other = leaf_hash([(alter or {}).get(f, F.col(f)) for f in fields])
    other = F.when(altered, other) if altered is not None else F.lit(None).cast("string")
    rows = docs.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).cast("bigint").alias("id"),
                       F.unhex(plain).alias("leaf"), F.unhex(other).alias("other"))
    return written(rows, "merkle-leaves")


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    on = a["grp"].eqNullSafe(b["grp"])
    for name in names:
        on = on & (a[name] == b[name])
    return on


def _before(df: DataFrame, parent: str) -> Column:
    """Rows in the smaller children of one parent; such a window holds at most 2^15 rows."""
    w = Window.partitionBy("grp", parent).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(w), F.lit(0))


def directory(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(grp, bucket, n, bits, stretches, base) per bucket, and (grp, total, without) per group.

    ``base``: rows of the group in smaller buckets; ``without``: its rows without an id.
    """
    marked = rows.where("id IS NOT NULL").select(
        "grp", F.shiftright("id", BUCKET_BITS).alias("bucket"), F.col("id").bitwiseAND((1 << BUCKET_BITS) - 1).alias("bit"))
    bitmaps = written(marked.groupBy("grp", "bucket").agg(F.count("*").alias("n"), F.bitmap_construct_agg("bit").alias("bits")),
                      "merkle-bitmaps")
    low, high = bitmaps.agg(F.coalesce(F.min("bucket"), F.lit(0)), F.coalesce(F.max("bucket"), F.lit(0))).first()
    levels = [bitmaps.select("grp", F.col("bucket").alias("node"), "n")]
    while low != high and not -1 <= low <= high <= 0:
        low, high = low >> BUCKET_BITS, high >> BUCKET_BITS
        up = levels[-1].groupBy("grp", F.shiftright("node", BUCKET_BITS).alias("node")).agg(F.sum("n").alias("n"))
        levels.append(up)
    # from the top down: a child's base is its parent's and what its smaller siblings hold; the top level is one
    # node, or one of the negative ids and one of the others
    base = levels[-1].withColumn("top", F.lit(0)).select("grp", "node", _before(levels[-1], "top").alias("base"))
    for level in reversed(levels[:-1]):
        child = level.withColumn("parent", F.shiftright("node", BUCKET_BITS))
        child = child.withColumn("before", _before(child, "parent")).select("grp", "node", "parent", "before")
        up = base.select(F.col("grp").alias("up_grp"), F.col("node").alias("up_node"), F.col("base").alias("up_base"))
        base = child.join(up, child["grp"].eqNullSafe(up["up_grp"]) & (child["parent"] == up["up_node"])).select(
            "grp", "node", (F.col("up_base") + F.col("before")).alias("base"))
    base = base.select(F.col("grp").alias("b_grp"), F.col("node").alias("b_node"), "base")
    ones = F.transform(F.sequence(F.lit(0), F.lit((1 << BUCKET_BITS) // STRETCH - 1)),
                       lambda i: F.bitmap_count(F.substring("bits", F.lit(1), i * (STRETCH // 8))))
    buckets = bitmaps.join(base, bitmaps["grp"].eqNullSafe(base["b_grp"]) & (bitmaps["bucket"] == base["b_node"])).select(
        "grp", "bucket", "n", "bits", ones.alias("stretches"), "base")
    groups = rows.groupBy("grp").agg(F.count("*").alias("total"), F.count_if(F.col("id").isNull()).alias("without"))
    return written(buckets, "merkle-directory"), written(groups, "merkle-groups")


def rank_in_bitmap(bit: Column, bits: Column, stretches: Column) -> Column:
    """Ones before a bit: the directory's entry, the whole bytes after it, and the rest of the bit's own byte."""
    stretch = F.floor(bit / STRETCH).cast("int")
    byte = F.floor(bit / 8).cast("int")
    whole = F.bitmap_count(F.substring(bits, stretch * (STRETCH // 8) + 1, byte - stretch * (STRETCH // 8)))
    own = F.conv(F.hex(F.substring(bits, byte + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit((1 << i) - 1) for i in range(8)]), (bit % 8).cast("int") + 1)
    return F.element_at(stretches, stretch + 1) + whole + F.bit_count(own.bitwiseAND(mask))


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(grp, place, total, id, leaf, other) of every leaf, and (grp, total) per group."""
    buckets, groups = directory(rows)
    sizes = small_side(groups.select(F.col("grp").alias("g_grp"), "total", "without"))
    rows = rows.withColumn("bucket", F.shiftright("id", BUCKET_BITS)).withColumn("bit", F.col("id").bitwiseAND((1 << BUCKET_BITS) - 1))
    rows = rows.join(sizes, rows["grp"].eqNullSafe(sizes["g_grp"]), "left").drop("g_grp")
    found = buckets.withColumnsRenamed({"grp": "d_grp", "bucket": "d_bucket"})
    found = rows.join(found, rows["grp"].eqNullSafe(found["d_grp"]) & (rows["bucket"] == found["d_bucket"]))
    place = F.col("without") + F.col("base")
    once = found.where(F.bitmap_count("bits") == F.col("n")).select(
        "grp", (place + rank_in_bitmap(F.col("bit"), F.col("bits"), F.col("stretches"))).alias("place"), "total", "id", "leaf", "other")
    # buckets with repeated ids, and rows without an id
    mixed = buckets.where(F.bitmap_count("bits") < F.col("n")).select(F.col("grp").alias("d_grp"), F.col("bucket").alias("d_bucket"), "base")
    again = rows.join(mixed, rows["grp"].eqNullSafe(mixed["d_grp"]) & (rows["bucket"] == mixed["d_bucket"])).select(
        "grp", place.alias("start"), "total", "id", "leaf", "other")
    again = again.unionByName(rows.where("id IS NULL").select("grp", F.lit(0).cast("bigint").alias("start"), "total", "id", "leaf", "other"))
    if mixed.isEmpty() and groups.where("without > 0").isEmpty():
        return once, groups.select("grp", "total")
    again = again.withColumn("named", F.coalesce(F.concat(F.lit("+"), "grp"), F.lit("-")))
    again = rank_within(again, ["named", "start"], [F.asc_nulls_first("id"), F.col("leaf"), F.asc_nulls_first("other"), F.col("grp")], "nth")
    again = again.select("grp", (F.col("start") + F.col("nth") - 1).alias("place"), "total", "id", "leaf", "other")
    return once.unionByName(again), groups.select("grp", "total")


def _h(data: bytes) -> bytes:
    import hashlib

    return hashlib.sha256(data).digest()


def reduced(digests: list[bytes], levels: int) -> tuple[list[list[bytes]], bytes]:
    """All levels of one slot array, the digests first, and the node that remains."""
    rows = [digests]
    for _ in range(levels):
        now = rows[-1]
        rows.append([_h(b"".join(d.hex().encode() for d in now[i:i + 2])) for i in range(0, len(now), 2)])
    return rows, rows[-1][0]


def steps(rows: list[list[bytes]], at: int) -> bytes:
    """Steps from one digest to the array's node: per level the kind and, where there is one, the sibling."""
    out = []
    for row in rows[:-1]:
        other = at ^ 1
        if other < len(row):
            out.append(bytes([RIGHT if other > at else LEFT]) + row[other])
        else:
            out.append(bytes([ALONE]) + bytes(STEP - 1))
        at >>= 1
    return b"".join(out)


def fold(digest: bytes, path: bytes) -> bytes:
    """The node at the end of a path."""
    for i in range(0, len(path), STEP):
        kind, other = path[i], path[i + 1:i + STEP]
        pair = (digest, other) if kind == RIGHT else (other, digest) if kind == LEFT else (digest,)
        digest = _h(b"".join(d.hex().encode() for d in pair))
    return digest


def proof_hash(path: bytes) -> str:
    siblings = [path[i + 1:i + STEP] for i in range(0, len(path), STEP) if path[i] != ALONE]
    return _h(b"".join(s.hex().encode() for s in siblings)).hex()


def _levels(places: int, bits: int) -> int:
    """Levels that a slot array of 2^bits places reduces where its group has so many nodes."""
    return bits if places > 1 << bits else max(places - 1, 0).bit_length()


def _slots(nodes: DataFrame, bits: int) -> DataFrame:
    """(grp, slot, digest, digests, ids, others, total): one row per slot array of (grp, place, total, digest, id, other)."""
    import pyarrow as pa

    mask, kinds = (1 << bits) - 1, ("binary", "binary", "array<bigint>", "array<binary>")
    names = ("digest", "digests", "ids", "others")

    def build(table):
        n = table.num_rows
        digests, ids, others = [None] * n, [None] * n, [None] * n
        for at, digest, own, other in zip(*(table.column(c).to_pylist() for c in ("place", "digest", "id", "other"))):
            digests[at & mask], ids[at & mask], others[at & mask] = digest, own, other
        total = table.column("total")[0].as_py()
        _, top = reduced(digests, _levels(total, bits))
        return pa.table({
            "grp": table.column("grp").slice(0, 1), "slot": table.column("slot").slice(0, 1), "total": pa.array([total], pa.int64()),
            "digest": pa.array([top], pa.binary()), "digests": pa.array([b"".join(digests)], pa.binary()),
            "ids": pa.array([ids], pa.list_(pa.int64())), "others": pa.array([others], pa.list_(pa.binary()))})

    schema = "grp string, slot bigint, total bigint, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    keyed = nodes.withColumn("slot", F.shiftright("place", bits))
    return keyed.groupBy("grp", "slot").applyInArrow(build, schema)


def _tree(nodes: DataFrame, bits: int, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of slot arrays of (grp, place, total, digest, id, other), and (grp, digest) of what remains per group.

    ``most``: an upper bound of a group's nodes; it tells the number of rounds.
    """
    rounds = []
    while True:
        rounds.append(written(_slots(nodes, bits), "merkle-slots"))
        most = (most - 1 >> bits) + 1 if most else 0
        if most <= 1:
            return rounds, rounds[-1].select("grp", "digest")
        last = rounds[-1]
        nodes = last.select("grp", F.col("slot").alias("place"), (F.shiftright(F.col("total") - 1, bits) + 1).alias("total"), "digest",
                            F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("other"))


def _opened(slots: DataFrame, above: DataFrame, bits: int, expand, schema: str) -> DataFrame:
    """``expand(row, digests, paths)`` for every array; ``above``: (grp, slot, path) of the arrays' nodes."""
    def open_(array, up):
        if not array.num_rows:
            return expand({"grp": None, "slot": 0, "ids": [], "others": []}, [], [])
        row, path = array.to_pylist()[0], up.column("path")[0].as_py()
        digests = [row["digests"][i:i + 32] for i in range(0, len(row["digests"]), 32)]
        levels, _ = reduced(digests, _levels(row["total"], bits))
        return expand(row, digests, [steps(levels, at) + path for at in range(len(digests))])

    up = above.toDF("grp", "slot", "path")
    return slots.groupBy("grp", "slot").cogroup(up.groupBy("grp", "slot")).applyInArrow(open_, schema)


def _paths(rounds: list[DataFrame], tops: DataFrame, bits: int) -> DataFrame:
    """(grp, slot, path) of every array of the first round; ``tops``: (grp, slot, path) of the last round's arrays."""
    import pyarrow as pa

    def expand(row, digests, paths):
        first = row["slot"] << bits
        return pa.table({"grp": pa.array([row["grp"]] * len(paths), pa.string()), "slot": pa.array(range(first, first + len(paths)), pa.int64()),
                         "path": pa.array(paths, pa.binary())})

    above = tops
    for slots in reversed(rounds[1:]):
        above = written(_opened(slots, above, bits, expand, "grp string, slot bigint, path binary"), "merkle-paths")
    return above


def manifest(docs: DataFrame, fields=FIELDS, id_col: str = "doc_id", group_col: str = "lang", altered: Column | None = None,
             alter: dict | None = None, bits: int = SLOT_BITS) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, digests in lower-case hex.

    ``altered`` and ``alter`` describe a tampered copy: where ``altered`` holds, the folded root is that of the row
    with ``alter``'s columns in place of its own, under the siblings of the untampered manifest.
    """
    import pyarrow as pa

    nodes, groups = placed(leaves(docs, fields, id_col, group_col, altered, alter))
    most = groups.agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]
    rounds, subroots = _tree(nodes.withColumnRenamed("leaf", "digest"), bits, most)

    # the groups' subroots are leaves of one more tree, whose ids say which group a place holds
    ordered = written(global_ordinal(subroots, [F.asc_nulls_first("grp")], "nth"), "merkle-subroots")
    number = ordered.count()
    joined = ordered.select(F.lit("").alias("grp"), (F.col("nth") - 1).alias("place"), F.lit(number).cast("bigint").alias("total"),
                            "digest", F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("binary").alias("other"))
    over, root = _tree(joined, bits, number)
    top = root.first()
    root_bytes = bytes(top["digest"]) if top else b""
    tops = over[-1].select("grp", "slot", F.unhex(F.lit("")).alias("path"))
    up = _paths(over, tops, bits)

    def as_places(row, digests, paths):
        first = row["slot"] << bits
        return pa.table({"at": pa.array(range(first, first + len(paths)), pa.int64()), "path": pa.array(paths, pa.binary())})

    of_groups = _opened(over[0], up, bits, as_places, "at bigint, path binary")
    group_paths = written(ordered.join(of_groups, ordered["nth"] - 1 == of_groups["at"]).select("grp", "digest", "path"), "merkle-groups-up")
    tops = rounds[-1].select("grp", "slot").join(group_paths.select(F.col("grp").alias("p_grp"), "path"),
                                                 F.col("grp").eqNullSafe(F.col("p_grp"))).select("grp", "slot", "path")
    # the path to the subroot ends where the group's own path begins; the subroot is read off the group's row
    up = _paths(rounds, tops, bits)
    subs = group_paths.select(F.col("grp").alias("s_grp"), F.hex("digest").alias("sub"))

    def expand(row, digests, paths):
        folded = [fold(d if other is None else other, path).hex() for d, other, path in zip(digests, row["others"], paths)]
        return pa.table({
            "grp": pa.array([row["grp"]] * len(digests), pa.string()), "id": pa.array(row["ids"], pa.int64()),
            "leaf": pa.array([d.hex() for d in digests], pa.string()), "proof_sha256": pa.array([proof_hash(p) for p in paths], pa.string()),
            "folded_root": pa.array(folded, pa.string())})

    rows = _opened(rounds[0], up, bits, expand, "grp string, id bigint, leaf string, proof_sha256 string, folded_root string")
    subs = small_side(subs)
    rows = rows.join(subs, rows["grp"].eqNullSafe(subs["s_grp"]))
    return rows.select("id", "leaf", F.lower("sub").alias("subroot"), F.lit(root_bytes.hex()).alias("root"), "proof_sha256", "folded_root",
                       (F.col("folded_root") == F.lit(root_bytes.hex())).alias("verified"))
