"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct word shingles as 64-bit ids. Two collections of
``HALVES`` half-keys are computed, each half-key from ``WIDTH`` minhashes. The tables
are all pairs (i, j): the key of a set in table (i, j) combines half-key i of the first
collection with half-key j of the second. So HALVES**2 tables of 2 * WIDTH minhashes a
key need 2 * HALVES * WIDTH minhash functions, about the square root of what separate
bands would take. Sets of similarity 0.85 that share no table are one pair in some 800,
and most of those are still joined through others.

Equal sets are one node from the start. Within each table key the node with the smallest
id leads: the others are compared with it by two bits of each minhash. Those that look
similar become candidate links and are left to it; those that look less alike become links
only if nothing connects the two within the key yet, and they and the rest try again with a
new leader. So a key has at most two links a node. Candidate links are then confirmed on the
full sets, first two per node, then those that would still join two groups. Texts that
share a template but not enough of it are never linked, whatever they have in common with
a third.

Pairs without a link of their own are connected by links of a similarity from LOOSE to
PERCENT: where one text was left to a leader, the other is at least that much like it. Where
such links join several classes, what is outside the largest class is compared with all of
the group, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from trilayer.llm.components import components, labels
from trilayer.llm.words import mix, runs, slices, windows, words
from trilayer.operators.joins import broadcast_if_small
from trilayer.workspace import written

SHINGLE = 5
PERCENT = 85
#: Confirmed similarity in percent from which texts may be connected through others.
LOOSE = 65
HALVES = 10
WIDTH = 4

#: Minhashes that must agree in their two bits for a candidate link, and for leaving a set
#: to its leader: five standard deviations below what similarity 0.85 gives on average, and
#: what similarity 0.8 gives.
MINHASHES = 2 * HALVES * WIDTH
ALIKE = 57
SIMILAR = 68
SIGNATURE = -(-MINHASHES // 32)

#: Bytes of keys that a task gathers.
KEY_BYTES = 16 << 20
#: Links that one pack confirms, followers of one leader in a pack, and sets of a block.
PACK_LINKS = 200
FOLLOWERS = 200
BLOCK_SETS = 200

_random = np.random.Generator(np.random.PCG64(85))
_HASHES = _random.integers(1, 1 << 63, MINHASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = mix(np.arange(1, HALVES * HALVES + 1, dtype=np.uint64))
_ODD_BITS = np.uint64(0x5555555555555555)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle ids of each text; empty without words."""
    found = words(texts)
    ids, rows, _ = windows(found, SHINGLE)
    at = np.searchsorted(rows, np.arange(len(found.first)))
    sets = []
    for low, high in zip(at[:-1], at[1:]):
        values = np.sort(ids[low:high])
        sets.append(values[runs(values)[:-1]] if len(values) > 1 else values)
    return sets


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    return mix(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64))


def half_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Both collections of half-keys of each set, none of which is empty, and its
    signature: two bits of each minhash."""
    keys = np.zeros((len(sets), 2 * HALVES), np.uint64)
    signatures = np.zeros((len(sets), SIGNATURE), np.uint64)
    sizes = np.array([len(s) for s in sets])
    low = 0
    while low < len(sets):  # so many sets at once that they stay in the processor's cache
        high = max(low + 1, low + int(np.searchsorted(np.cumsum(sizes[low:]), 40_000, "right")))
        flat = np.concatenate(sets[low:high])
        at = np.concatenate(([0], np.cumsum(sizes[low:high])[:-1]))
        for k, factor in enumerate(_HASHES):
            smallest = np.minimum.reduceat(flat * factor, at)
            keys[low:high, k // WIDTH] = mix(keys[low:high, k // WIDTH] + smallest + np.uint64(k))
            bits = mix(smallest + np.uint64(k)) & np.uint64(3)
            signatures[low:high, k // 32] |= bits << np.uint64(2 * (k % 32))
        low = high
    return keys, signatures


def agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minhashes whose two bits agree, of signatures row by row."""
    differ = left ^ right
    differ = (differ | (differ >> np.uint64(1))) & _ODD_BITS
    return MINHASHES - np.bitwise_count(differ).sum(axis=1, dtype=np.int64)


def sketches(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id, n_shingles, set_id, half-keys and signature (null without words)."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    schema = StructType([rows.schema["id"], StructField("n", LongType()),
                         StructField("node", LongType()), StructField("halves", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            sets = shingle_sets(batch.column("text"))
            some = [s for s in sets if len(s)]
            both, at, halves = np.concatenate(half_keys(some), axis=1), 0, []
            for s in sets:
                halves.append(both[at].tobytes() if len(s) else None)
                at += len(s) > 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(set_ids(sets).view(np.int64)), pa.array(halves, pa.binary())],
                names=["id", "n", "node", "halves"],
            )

    return rows.mapInArrow(run, schema)


def _pairs(left: np.ndarray, right: np.ndarray, alike: np.ndarray):
    """Distinct pairs; the two bits of a pair always agree as often."""
    order = np.lexsort((right, left))
    left, right, alike = left[order], right[order], alike[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    return left[new], right[new], alike[new]


def led(keys: np.ndarray, nodes: np.ndarray, signatures: np.ndarray, row: np.ndarray):
    """Candidate links (node, leader, agreeing minhashes) within each key, and which entries
    were not left to a leader. ``row`` is each entry's row in nodes and signatures.

    In each round the smallest node left of each key leads. Entries are in the order of
    keys afterwards: also returns that order.
    """
    order = np.lexsort((nodes[row], keys))
    keys, row = keys[order], row[order]
    stays = np.ones(len(keys), bool)
    rest = np.arange(len(keys))
    group = np.arange(len(keys))  # entries connected within their key; roots point to themselves
    found = [(np.zeros(0, np.int64),) * 3]
    while len(rest):
        at = runs(keys[rest])
        size = np.diff(at)
        leader = np.repeat(rest[at[:-1]], size)
        follows = np.ones(len(rest), bool)
        follows[at[:-1]] = False
        rest, leader = rest[follows], leader[follows]
        if not len(rest):
            break
        alike = agreeing(signatures[row[rest]], signatures[row[leader]])
        similar = alike >= SIMILAR
        mine, theirs = group[rest], group[leader]
        # one link is enough for all entries of a group that come to this leader
        new = (alike >= ALIKE) & ~similar & (mine != theirs)
        first = np.zeros(len(rest), bool)
        first[np.flatnonzero(new)[np.unique(mine[new], return_index=True)[1]]] = True
        link = similar | first
        found.append(_pairs(nodes[row[rest[link]]], nodes[row[leader[link]]], alike[link]))
        moved = np.arange(len(keys))
        moved[mine[link]] = theirs[link]
        group = moved[group]
        stays[rest[similar]] = False
        rest = rest[~similar]
    return _pairs(*(np.concatenate(part) for part in zip(*found))), order, stays


def candidate_links(sets: DataFrame, buckets: int) -> DataFrame:
    """``sets`` (node, halves) as candidate links (a, b, alike), b being the leader.

    A task first leads the nodes of its own rows and passes on those it has not left to
    another, so a key that very many near-equal sets have reaches the task of its key range
    with few nodes per sending batch.
    """
    shift = np.uint64(64 - max(1, (buckets - 1).bit_length()))

    def send(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = np.asarray(batch.column("node"))
            both = np.frombuffer(b"".join(batch.column("halves").to_pylist()), np.uint64)
            both = both.reshape(len(nodes), -1)
            signatures = both[:, 2 * HALVES :]
            a, b = both[:, :HALVES, None], both[:, None, HALVES : 2 * HALVES]
            keys = mix(a + mix(b + _PLACES.reshape(HALVES, HALVES))).reshape(-1)
            row = np.repeat(np.arange(len(nodes)), HALVES**2)
            (left, right, alike), order, stays = led(keys, nodes, signatures, row)
            keys, row = keys[order][stays], row[order][stays]
            at = runs(keys >> shift)
            cuts = list(zip(at, at[1:]))
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([-1, *(int(keys[i] >> shift) for i, _ in cuts)], pa.int64()),
                "nodes": [left.tobytes(), *(nodes[row[i:j]].tobytes() for i, j in cuts)],
                "keys": [right.tobytes(), *(keys[i:j].tobytes() for i, j in cuts)],
                "more": [alike.tobytes(), *(signatures[row[i:j]].tobytes() for i, j in cuts)],
            })

    def receive(table: pa.Table) -> pa.Table:
        nodes, keys, more = (b"".join(table.column(c).to_pylist()) for c in ("nodes", "keys", "more"))
        nodes = np.frombuffer(nodes, np.int64)
        if table.column("bucket")[0].as_py() < 0:
            links = _pairs(nodes, np.frombuffer(keys, np.int64), np.frombuffer(more, np.int64))
        else:
            signatures = np.frombuffer(more, np.uint64).reshape(-1, SIGNATURE)
            links, _, _ = led(np.frombuffer(keys, np.uint64), nodes, signatures, np.arange(len(nodes)))
        return pa.table(dict(zip("ab", links[:2])) | {"alike": links[2]})

    sent = sets.select("node", "halves").mapInArrow(
        send, "bucket long, nodes binary, keys binary, more binary")
    spread = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("nodes"), F.lit(buckets))).otherwise(-1)
    return (
        sent.withColumn("part", spread).groupBy("bucket", "part")
        .applyInArrow(receive, "a long, b long, alike long")
    )


def _with_sets(docs: DataFrame, members: DataFrame, id_column: str, text: str) -> DataFrame:
    """(node, ids): the shingles of each member, from the document of its id and set."""
    joined = docs.select(F.col(id_column).alias("doc"), F.col(text).alias("text")).join(
        broadcast_if_small(members), F.col("doc").eqNullSafe(F.col("id"))
    ).select("node", "text")

    def run(batches):
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            same = set_ids(sets).view(np.int64) == np.asarray(batch.column("node"))
            at = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(at)),
                 pa.array([sets[i].tobytes() for i in at.tolist()], pa.binary())],
                names=["node", "ids"],
            )

    return joined.mapInArrow(run, "node long, ids binary")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many ids each left set shares with each right one."""
    flat = np.concatenate(right)
    sizes = np.array([len(s) for s in right])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    if len(left) <= 4:
        rows = []
        for mine in left:
            place = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
            rows.append(np.add.reduceat((mine[place] == flat).astype(np.int64), starts))
        return np.stack(rows)
    mine = np.concatenate(left)
    shared = np.intersect1d(mine, flat)
    common = np.zeros((len(left), len(right)))
    sides = []
    for ids, sets in ((mine, left), (flat, right)):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = np.minimum(np.searchsorted(shared, ids), max(0, len(shared) - 1))
        known = np.flatnonzero(shared[column] == ids) if len(shared) else np.zeros(0, np.int64)
        order = known[np.argsort(column[known], kind="stable")]
        sides.append((column[order], owner[order], len(sets)))
    for low in range(0, len(shared), 8192):
        dense = []
        for column, owner, size in sides:
            i, j = np.searchsorted(column, [low, low + 8192])
            has = np.zeros((size, 8192), np.float32)
            has[owner[i:j], column[i:j] - low] = 1
            dense.append(has)
        common += dense[0] @ dense[1].T
    return common.astype(np.int64)


def _confirm(table: pa.Table) -> pa.Table:
    """The similarity of each left node of the table with the right ones of its group.

    Only pairs of two classes count. ``level`` is 2 from PERCENT on, 1 from LOOSE on. With
    several left nodes only as many links of level 2 come out as connect what is similar.
    """
    group, is_left = np.asarray(table.column("group")), np.asarray(table.column("is_left"))
    nodes, classes = np.asarray(table.column("node")), np.asarray(table.column("class"))
    order = np.lexsort((nodes, ~is_left, group))
    new = np.ones(len(order), bool)  # a node may be on one side twice, by repeated documents
    for values in (nodes, is_left, group):
        new[1:] &= values[order][1:] == values[order][:-1]
    new[1:], new[:1] = ~new[1:], True
    order = order[new]
    sets = [np.frombuffer(v, np.uint64) for v in table.column("ids").take(pa.array(order)).to_pylist()]
    group, is_left, nodes, classes = (v[order] for v in (group, is_left, nodes, classes))
    found = [(np.zeros(0, np.int64),) * 3]
    at = runs(group)
    for low, high in zip(at[:-1], at[1:]):
        cut = low + int(is_left[low:high].sum())
        if cut == low or cut == high:
            continue
        common = _common(sets[low:cut], sets[cut:high])
        sizes = np.array([len(s) for s in sets[low:high]])
        union = sizes[: cut - low, None] + sizes[None, cut - low :] - common
        level = (100 * common >= PERCENT * union) * 1 + (100 * common >= LOOSE * union)
        level[classes[low:cut, None] == classes[None, cut:high]] = 0
        if cut - low == 1:
            i, j = np.nonzero(level)
            found.append((nodes[low + i], nodes[cut + j], level[i, j]))
        else:
            i, j = np.nonzero(level == 2)
            linked, roots = labels(nodes[low + i], nodes[cut + j])
            new = linked != roots
            found.append((linked[new], roots[new], np.full(int(new.sum()), 2)))
    a, b, level = (np.concatenate(part) for part in zip(*found))
    return pa.table({"a": a, "b": b, "level": level.astype(np.int64)})


_LINKS = "a long, b long, level long"


def _confirmed(links: DataFrame, sets: DataFrame) -> DataFrame:
    """Levels of links (a, b) on the full sets. Followers of one leader are dealt out over
    several groups if there are many; a leader's set goes to each of them."""
    packs = max(1, -(-links.count() // PACK_LINKS))
    leaders = links.groupBy("b").agg(F.ceil(F.count("*") / FOLLOWERS).alias("parts"))
    leaders = written(leaders, "near-leaders")
    share = F.pmod(F.xxhash64("a"), F.col("parts"))
    followers = links.join(broadcast_if_small(leaders), "b").select(
        F.col("a").alias("node"), F.xxhash64("b", share).alias("group"), F.lit(False).alias("is_left"))
    heads = leaders.select(
        F.col("b").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("share")
    ).select("node", F.xxhash64("node", "share").alias("group"), F.lit(True).alias("is_left"))
    sides = written(followers.unionByName(heads), "near-sides")
    return _compared(sides.withColumn("class", F.col("node")), sets, packs)


def _compared(sides: DataFrame, sets: DataFrame, packs: int | None) -> DataFrame:
    """``sides`` (node, group, is_left, class) with their sets, compared group by group;
    small groups are handed out in so many packs."""
    pack = F.pmod("group", F.lit(packs)) if packs else F.col("group")
    full = sets.join(broadcast_if_small(sides), "node").withColumn("pack", pack)
    return written(
        full.select("pack", "group", "is_left", "node", "class", "ids")
        .groupBy("pack").applyInArrow(_confirm, _LINKS),
        "near-links",
    )


def _across(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between different classes; a node without a class is one of its own."""
    small = broadcast_if_small(classes)
    for side in ("a", "b"):
        root = small.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        links = links.join(root, side, "left")
    return links.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


def _rest_against_all(
    loose: DataFrame, classes: DataFrame, confirmed: DataFrame, sets: DataFrame
) -> DataFrame:
    """Links found in groups of classes that ``loose`` links connect: what is outside a
    group's largest class is compared with the whole group, block by block."""
    groups = components(loose.unionByName(confirmed.select("a", "b"))).select(
        "node", F.col("root").alias("group"))
    named = groups.join(broadcast_if_small(classes), "node", "left").select(
        "node", "group", F.coalesce("root", "node").alias("class"))
    named = written(named, "near-groups")
    sizes = written(
        named.groupBy("group", "class").agg(F.count("*").alias("members")).groupBy("group").agg(
            F.max(F.struct("members", "class"))["class"].alias("main"),
            F.sum("members").alias("all"), F.count("*").alias("classes"),
        ).filter("classes > 1"),
        "near-open-groups",
    )
    open_groups = named.join(broadcast_if_small(sizes), "group")
    blocks = F.ceil(F.col("all") / BLOCK_SETS)
    block = F.pmod(F.xxhash64("node"), blocks)
    rest = open_groups.filter("class != main").withColumn(
        "block", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).withColumn("is_left", F.lit(True))
    everyone = open_groups.withColumn("block", block).withColumn("is_left", F.lit(False))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.ceil((F.col("all") - 1) / BLOCK_SETS))
    parts = rest.withColumn("part", part)
    pairs = parts.select("group", "block", "part").distinct()
    right = everyone.join(broadcast_if_small(pairs), ["group", "block"])
    sides = written(
        parts.unionByName(right).select(
            "node", F.xxhash64("group", "block", "part").alias("group"), "is_left", "class"),
        "near-block-sides",
    )
    return _compared(sides, sets, None)


def _classes(docs: DataFrame, nodes: DataFrame, id_column: str, text: str) -> DataFrame:
    """(node, root) of the nodes that confirmed links connect with others."""
    keys = nodes.count() * HALVES * HALVES * 8 * (2 + SIGNATURE)
    links = written(candidate_links(nodes, max(16, -(-keys // KEY_BYTES))), "near-pairs")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    members = nodes.join(broadcast_if_small(written(ends, "near-ends")), "node").select("node", "id")
    sets = written(_with_sets(docs, written(members, "near-members"), id_column, text), "near-sets")
    some = links.groupBy("a").agg(F.min("b").alias("b"), F.max_by("b", F.struct("alike", "b")).alias("b2"))
    some = some.select("a", F.explode(F.array_distinct(F.array("b", "b2"))).alias("b"))
    some = written(some, "near-some")
    found = _confirmed(some, sets)
    apart = _across(links.select("a", "b").distinct(), components(found.select("a", "b")))
    more = written(apart.join(broadcast_if_small(some), ["a", "b"], "left_anti"), "near-more")
    if not more.isEmpty():
        found = found.unionByName(_confirmed(more, sets))
    classes = components(found.filter("level = 2").select("a", "b"))
    loose = written(_across(found.filter("level = 1").select("a", "b"), classes), "near-loose")
    if not loose.isEmpty():
        confirmed = found.filter("level = 2")
        last = _rest_against_all(loose, classes, confirmed, sets).filter("level = 2")
        classes = components(confirmed.unionByName(last).select("a", "b"))
    return classes


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: the id, n_shingles, component_id and kept.

    Rows whose texts reach the similarity are linked; component_id is the smallest id
    reachable and kept tells whether it is the row's own. Fewer words than a shingle are
    one shingle; a null text or one without words is linked with nothing and is kept.
    Rows repeated with one id are one document, so all of them are kept or none. A null
    id is kept only if no other id is in its component. Empty input gives no rows. Texts
    are taken whole, long ones one at a time; other columns are ignored.
    """
    rows = written(sketches(docs, id_column, text), "near-sketches")
    nodes = written(
        rows.filter("n > 0").groupBy("node").agg(
            F.min("id").alias("id"), F.first("halves").alias("halves"), F.count("*").alias("copies"),
        ),
        "near-nodes",
    )
    classes = broadcast_if_small(_classes(docs, nodes, id_column, text))
    named = nodes.select("node", "id", "copies").join(classes, "node", "left").filter(
        "root IS NOT NULL OR copies > 1"
    ).select("node", "id", F.coalesce("root", "node").alias("root"))
    named = written(named, "near-named")
    smallest = named.groupBy("root").agg(F.min("id").alias("smallest"))
    joined = written(named.join(broadcast_if_small(smallest), "root").select("node", "smallest"),
                     "near-components")
    component = F.when(F.col("c.node").isNotNull(), F.col("smallest")).otherwise(F.col("id"))
    return (
        rows.alias("r")
        .join(broadcast_if_small(joined).alias("c"),
              (F.col("r.node") == F.col("c.node")) & (F.col("r.n") > 0), "left")
        .select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
                component.alias("component_id"))
        .withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))
    )
