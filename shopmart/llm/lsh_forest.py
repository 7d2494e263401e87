"""Near duplicates by an LSH forest.

Every document has a set of word shingles and, per tree, a sorted order key of ``DEPTH`` minhash values. The
trees are one table, range-sorted by tree and key, so documents that share a longest common prefix
stand next to each other and a crowd of equal keys is dealt over several ranges. Candidates share at least
``LEAST`` values. How deep a region goes depends on its crowd: where at most ``REACH + 1`` documents share a
prefix, all of them are paired; a denser region is paired at the next depth, and its documents with
their neighbour in the order. Neighbours across the edge of a range meet in a second pass over the edges.

With 42 trees a pair at similarity 0.8 shares a whole key of six values in some tree with a chance of all but 3 in a
million, so a region that is dense at four or five values costs no recall: pairs are found where they share the key.
A crowd that shares a whole key is not paired with itself. Besides its neighbours, each member is a
candidate with the crowd's hub, the member that shares its regions with the most others, which finds crowds
of variants that are alike with their original only. When these candidates are confirmed, the members
that are still apart from the largest component of their crowd are compared with all its members, in blocks of
full sets, so that a link to any single member is found as well; a block gives the links that join
components, not its pairs.

Documents with the same shingle set are one node (the smallest id). Every link is confirmed on the
full sets of 64-bit shingle hashes. First each node's best few candidates are confirmed, which ties
nearly every group together; then all candidates that still lead from one component to another.

Defined cases: null, empty and blank texts have no shingles and link with nothing; a text with fewer
words than a shingle has its whole sequence as one shingle; texts of any length are read whole; rows that repeat id and
text count as one document, so all of them stay or go; rows that share an id but not the text are documents of their own, and so
are rows without an id: their sets are nodes named by a hash instead of an id, and a component is named by the
smallest id in it, or null if it has none; identifiers are whole numbers; other columns may have any names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm import by_value
from shopmart.llm.components import components
from shopmart.llm.storage import discard, store
from shopmart.llm.words import mixed, paired, sorted_unique, word_hashes

by_value(__name__)

SHINGLE_WORDS = 5
PERCENT = 80
TREES, DEPTH, LEAST, REACH = 42, 6, 4, 8
#: Candidates of a document that are confirmed first.
FIRST = 3
#: Up to so many ids (their number is measured) are broadcast to pick texts; beyond, the texts are shuffled.
BROADCAST_IDS = 500_000
_GROUP_CHARS = 400_000
#: Shingles of the members that make one block, and parts of a crowd where regions are joined by shuffle.
BLOCK_SHINGLES, SALTS = 1_000_000, 32


def _shingles(texts: list[str], width: int) -> list[np.ndarray]:
    """The set of shingle hashes of each text, sorted."""
    words, owners, _ = word_hashes(texts)
    edges = np.searchsorted(owners, np.arange(len(texts) + 1))
    rolled = words
    for step in range(1, width):
        rolled = paired(rolled[: len(words) - step], words[step:], 10 + step)
    found = []
    for start, stop in zip(edges, edges[1:], strict=False):
        if stop - start >= width:
            found.append(sorted_unique(rolled[start : stop - width + 1].copy()))
        elif stop > start:
            whole = words[start : start + 1] ^ np.uint64(0x51DE)
            for place in range(start + 1, stop):
                whole = paired(whole, words[place : place + 1], 99)
            found.append(mixed(whole))
        else:
            found.append(words[:0])
    return found


def _text_groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= _GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minhash values of non-empty sets: one row per set."""
    draw = np.random.default_rng(20240501)
    factors = draw.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)
    shifts = draw.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), TREES * DEPTH), np.uint32)
    for i in range(TREES * DEPTH):
        out[:, i] = np.minimum.reduceat(values * factors[i] + shifts[i], starts)
    return out


def sketches(documents: DataFrame, width: int) -> DataFrame:
    """``id``, ``mark``, ``n`` (set size), ``ha`` and ``hb`` (128 bits that stand for the set) and ``sig`` of each document."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, first, second, signs = [], [], [], []
            for group in _text_groups(batch["text"].tolist()):
                sets = _shingles(group, width)
                full = [s for s in sets if len(s)]
                rows = iter(_signatures(full)) if full else iter(())
                for s in sets:
                    ha, hb = _set_digest(s)
                    sizes.append(len(s))
                    first.append(ha)
                    second.append(hb)
                    signs.append(next(rows).tobytes() if len(s) else None)
            named = {"id": batch["id"], "mark": batch["mark"]}
            yield pd.DataFrame({**named, "n": sizes, "ha": first, "hb": second, "sig": signs})

    return documents.mapInPandas(sketch, "id long, mark string, n long, ha long, hb long, sig binary")


def _set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set."""
    first = mixed(shingles).sum(dtype=np.uint64).view(np.int64)
    return int(first), int(mixed(shingles + np.uint64(0xABCDEF)).sum(dtype=np.uint64).view(np.int64))


def _tree_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if not len(batch):
            continue
        values = np.frombuffer(b"".join(batch["sig"]), np.uint32).reshape(len(batch), TREES, DEPTH).astype(np.uint64)
        keys = ((values[:, :, 0::2] << np.uint64(32)) | values[:, :, 1::2]).view(np.int64)
        yield pd.DataFrame(
            {
                "tree": np.tile(np.arange(TREES, dtype=np.int32), len(batch)),
                "k1": keys[:, :, 0].ravel(),
                "k2": keys[:, :, 1].ravel(),
                "k3": keys[:, :, 2].ravel(),
                "id": np.repeat(batch["id"].to_numpy(np.int64), TREES),
                "n": np.repeat(batch["n"].to_numpy(np.int64), TREES),
            }
        )


_TREE_COLUMNS = ["tree", "k1", "k2", "k3", "id", "n"]


def _region_sizes(same: np.ndarray) -> np.ndarray:
    """Size of the run that each row is in; ``same`` says whether a row continues the run before it."""
    run = np.cumsum(~same) - 1
    return np.bincount(run)[run]


def _neighbours(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Candidate pairs among rows sorted by tree and key."""
    tree, k1, k2, k3, ids, n = (rows[c].to_numpy() for c in _TREE_COLUMNS)
    levels = [k1, k2, k3 >> 32, k3]
    same = np.zeros((3, len(rows)), bool)
    if len(rows) > 1:
        agree = tree[1:] == tree[:-1]
        for depth, level in enumerate(levels):
            agree = agree & (level[1:] == level[:-1])
            if depth:
                same[depth - 1, 1:] = agree
    sizes = [_region_sizes(s) for s in same]
    runs = [np.cumsum(~s) for s in same]
    found = []
    for step in range(1, min(REACH + 1, len(rows))):
        together = [run[step:] == run[:-step] for run in runs]
        near = np.zeros(len(rows) - step, bool)
        for level in range(3):
            near |= together[level] & (sizes[level][step:] <= REACH + 1)
        if step == 1:
            near |= together[0]
        small, large = np.minimum(n[step:], n[:-step]), np.maximum(n[step:], n[:-step])
        near &= (100 * small >= percent * large) & (ids[step:] != ids[:-step])
        at = np.flatnonzero(near)
        depth = sum(t[at].astype(np.int32) for t in together)
        a, b = ids[at], ids[at + step]
        found.append(pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "score": depth}))
    return pd.concat(found) if found else pd.DataFrame({"a": [], "b": [], "score": []})


def _crowd_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """Region, id and size of the sorted rows that share their whole key with a crowd, or may do so across the edge."""
    tree, k1, k2, k3 = (rows[c].to_numpy(np.int64).view(np.uint64) for c in _TREE_COLUMNS[:4])
    region = paired(paired(k1 + mixed(tree), k2, 201), k3, 202).view(np.int64)
    same = np.zeros(len(rows), bool)
    same[1:] = region[1:] == region[:-1]
    kept = _region_sizes(same) > REACH + 1
    kept[: REACH + 1] = kept[-REACH - 1 :] = True
    return pd.DataFrame({"k1": region, "id": rows["id"], "n": rows["n"]})[kept]


PAIR, EDGE, CROWD = 0, 1, 2
_OUT = "kind int, a long, b long, score int, tree int, k1 long, k2 long, k3 long, id long, n long"
_NAMES = [field.split()[0] for field in _OUT.split(", ")]


def _of_region(members: DataFrame, regions: DataFrame) -> DataFrame:
    """Members of crowds with the row of their region; a crowd of any size stays spread."""
    if regions.count() <= BROADCAST_IDS:
        return members.join(F.broadcast(regions), "region")
    dealt = regions.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, ["region", "salt"]).drop("salt")


def _similar_size(left: str, right: str, percent: int) -> Column:
    return 100 * F.least(left, right) >= percent * F.greatest(left, right)


def _hub_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Every member of a crowd with the member whose regions hold the most others."""
    degrees = members.groupBy("id").agg(F.sum("size").alias("degree"))
    hubs = members.join(degrees, "id").groupBy("region").agg(F.max(F.struct("degree", "id", "n")).alias("hub"))
    hubs = store(hubs.select("region", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")), "crowd-hubs")
    met = _of_region(members, hubs).filter(_similar_size("n", "hub_n", percent) & (F.col("id") != F.col("hub")))
    return met.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"), F.lit(1).alias("score"))


def _joining_links(strays: pd.DataFrame, others: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links of strays with others that join components which the links before them have not joined."""
    numbers = {name: i for i, name in enumerate(pd.unique(pd.concat([strays["component"], others["component"]])))}
    parent = np.arange(len(numbers))
    within = others["component"].map(numbers).to_numpy()
    ids, sizes = others["id"].to_numpy(), others["grams"].map(len).to_numpy()
    known, codes = np.unique(np.concatenate(others["grams"].tolist()), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    marked, found = np.zeros(len(known), bool), []
    for own, name, grams in strays[["id", "component", "grams"]].itertuples(index=False):
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        at = at[known[at] == grams]
        marked[at] = True
        shared = np.add.reduceat(marked[codes], starts, dtype=np.int64)
        marked[at] = False
        linked = np.flatnonzero(100 * shared >= percent * (sizes + len(grams) - shared))
        _, firsts = np.unique(parent[within[linked]], return_index=True)
        for other in linked[firsts]:
            here, there = parent[numbers[name]], parent[within[other]]
            if here != there:
                found.append((own, ids[other]))
                parent[parent == there] = here
    return found


def stray_links(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between components in a crowd, one end outside the crowd's largest component.

    Strays and members are dealt into blocks of about ``BLOCK_SHINGLES``, and each pair of blocks is one group.
    """
    named = members.join(labels.select(F.col("node").alias("id"), "component"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    largest = (
        named.groupBy("region", "component")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
        .groupBy("region")
        .agg(F.max(F.struct("rows", "component", "n")).alias("main"), F.sum("rows").alias("rows"), F.sum("n").alias("n"))
        .filter("rows > main.rows")
        .select(
            "region",
            F.col("main.component").alias("main"),
            F.ceil(F.col("n") / BLOCK_SHINGLES).cast("int").alias("member_blocks"),
            F.ceil((F.col("n") - F.col("main.n")) / BLOCK_SHINGLES).cast("int").alias("stray_blocks"),
        )
    )
    opened = store(_of_region(named, store(largest, "open-crowds")), "open-members")

    def compare(strays: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = _joining_links(strays, others, percent) if len(strays) and len(others) else []
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    def dealt(rows: DataFrame, own: str, other: str, seed: int) -> DataFrame:
        every = F.explode(F.expr(f"sequence(0, {other}_blocks - 1)"))
        block = F.pmod(F.xxhash64("id", F.lit(seed)), F.col(f"{own}_blocks")).cast("int")
        placed = rows.select("region", block.alias(own), f"{other}_blocks", "id", "component").join(sets, "id")
        # Both sides come from one table; new aliases keep their columns apart.
        kept = [F.col(name).alias(name) for name in ("region", own, "id", "component", "grams")]
        return placed.select(*kept, every.alias(other))

    key = ["region", "stray", "member"]
    strays = dealt(opened.filter("component <> main"), "stray", "member", 1).groupBy(*key)
    return strays.cogroup(dealt(opened, "member", "stray", 2).groupBy(*key)).applyInPandas(compare, "a long, b long")


def candidates(nodes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b) of nodes (id, n, sig) that stand next to each other in some tree, with a score; and the crowds.

    A crowd is more than ``REACH + 1`` nodes with one whole key: columns region, id, n and size.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [batch for batch in batches if len(batch)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        pairs = _neighbours(rows, percent).groupby(["a", "b"], as_index=False, sort=False)["score"].sum()
        yield pairs.assign(kind=PAIR, tree=None, k1=None, k2=None, k3=None, id=None, n=None)[_NAMES]
        edge = rows if len(rows) <= 2 * REACH else pd.concat([rows.head(REACH), rows.tail(REACH)])
        yield edge.assign(kind=EDGE, a=None, b=None, score=None)[_NAMES]
        crowd = _crowd_rows(rows)
        yield crowd.assign(kind=CROWD, a=None, b=None, score=None, tree=None, k2=None, k3=None)[_NAMES]

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [batch for batch in batches if len(batch)]
        if parts:
            rows = pd.concat(parts, ignore_index=True).sort_values(["tree", "k1", "k2", "k3", "id"])
            yield _neighbours(rows, percent).groupby(["a", "b"], as_index=False, sort=False)["score"].sum()

    trees = nodes.mapInPandas(_tree_rows, "tree int, k1 long, k2 long, k3 long, id long, n long")
    order = ["tree", "k1", "k2", "k3", "id"]
    found = store(trees.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(search, _OUT), "forest")
    # At most 2 * REACH rows of each range: one task reads them.
    edges = found.filter(f"kind = {EDGE}").select(*_TREE_COLUMNS).repartition(1)
    pairs = found.filter(f"kind = {PAIR}").select("a", "b", "score").unionAll(
        edges.mapInPandas(across, "a long, b long, score int")
    )
    crowds = found.filter(f"kind = {CROWD}").select(F.col("k1").alias("region"), "id", "n")
    sizes = store(crowds.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > REACH + 1), "crowd-sizes")
    members = store(_of_region(crowds, sizes), "crowds")
    pairs = store(
        pairs.unionAll(_hub_pairs(members, percent)).groupBy("a", "b").agg(F.sum("score").alias("score")), "candidates"
    )
    discard(found, sizes)
    return pairs, members


def _best_of_each(pairs: DataFrame) -> DataFrame:
    """The best few pairs of every node."""
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other"), "score").unionAll(
        pairs.select(F.col("b").alias("node"), F.col("a").alias("other"), "score")
    )
    mark = F.xxhash64(F.least("node", "other"), F.greatest("node", "other"))
    best = ends.groupBy("node", F.pmod(mark, F.lit(FIRST)).alias("slot")).agg(
        F.max(F.struct("score", mark.alias("mark"), "other")).alias("best")
    )
    return best.select(
        F.least("node", "best.other").alias("a"), F.greatest("node", "best.other").alias("b")
    ).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("grams").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("grams").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).alias("total"))
        .filter(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared")))
        .select("a", "b")
    )


def _hashed(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        done = 0
        for group in _text_groups(batch["text"].tolist()):
            sets = _shingles(group, width)
            digests = np.array([(len(s), *_set_digest(s)) for s in sets], np.int64).reshape(-1, 3)
            ids = batch["id"].iloc[done : done + len(group)].to_numpy()
            yield pd.DataFrame(
                {"id": ids, **dict(zip(SAME_SET, digests.T)), "grams": [s.view(np.int64) for s in sets]}
            )
            done += len(group)


def _full_sets(texts: DataFrame, wanted: DataFrame, unclear: DataFrame | None, width: int) -> DataFrame:
    """The shingle sets of the wanted nodes."""

    def hashed(picked: DataFrame) -> DataFrame:
        schema = "id long, n long, ha long, hb long, grams array<long>"
        return picked.mapInPandas(lambda batches: _hashed(batches, width), schema)

    few = wanted.count() <= BROADCAST_IDS
    wanted = F.broadcast(wanted) if few else wanted
    sets = hashed(_others(texts, unclear).join(wanted, "id", "left_semi")).select("id", "grams")
    if unclear is not None:
        odd = hashed(_those(texts, unclear)).select(_hash_name().alias("id"), "grams")
        sets = sets.unionAll(odd.join(wanted, "id", "left_semi"))
    return store(sets.groupBy("id").agg(F.max("grams").alias("grams")), "full-sets")


SAME_SET = ["n", "ha", "hb"]


def _hash_name() -> Column:
    """The name of a set that no id stands for alone."""
    return F.xxhash64(*SAME_SET)


def _unclear_ids(filled: DataFrame) -> DataFrame | None:
    """Ids that do not name one set: of rows with different sets, or null. None if all ids do."""
    smallest = filled.groupBy(*SAME_SET).agg(F.min("id").alias("id"))
    unclear = store(smallest.groupBy("id").count().filter("count > 1 OR id IS NULL").select(F.col("id").alias("unclear")), "unclear-ids")
    found = unclear.count()
    if not found:
        discard(unclear)
        return None
    return F.broadcast(unclear) if found <= BROADCAST_IDS else unclear


def _those(rows: DataFrame, unclear: DataFrame) -> DataFrame:
    return rows.join(unclear, F.col("id").eqNullSafe(F.col("unclear")), "left_semi")


def _others(rows: DataFrame, unclear: DataFrame | None) -> DataFrame:
    return rows if unclear is None else rows.join(unclear, F.col("id").eqNullSafe(F.col("unclear")), "left_anti")


def _with_node(sets: DataFrame, unclear: DataFrame | None) -> DataFrame:
    """Sets with the name of their node: the smallest id, or a hash where that is no name."""
    named = _others(sets, unclear).withColumn("node", F.col("id"))
    return named if unclear is None else named.unionAll(_those(sets, unclear).withColumn("node", _hash_name()))


def _by_smallest_id(sets: DataFrame, unclear: DataFrame) -> DataFrame:
    """Sets whose component is named by its smallest id where a hash took part."""
    opened = _those(sets, unclear).select("component").distinct()
    names = sets.join(opened, "component").groupBy("component").agg(F.min("id").alias("name"), F.lit(True).alias("renamed"))
    renamed = sets.join(names, "component", "left")
    return renamed.withColumn("component", F.when(F.col("renamed"), F.col("name")).otherwise(F.col("component")))


def _named(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links with the components ``of_a`` and ``of_b`` of their ends."""
    of = {end: labels.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")) for end in ("a", "b")}
    known = links.select("a", "b").join(of["a"], "a", "left").join(of["b"], "b", "left")
    return known.withColumn("of_a", F.coalesce("of_a", "a")).withColumn("of_b", F.coalesce("of_b", "b"))


def _crossing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    return _named(pairs, labels).filter("of_a <> of_b").select("a", "b")


def _bridged(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels after confirmed links between components have been followed."""
    between = _named(links, labels).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    bridges = store(between.distinct(), "bridges")
    if bridges.isEmpty():
        return labels
    joined = components(bridges).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    ends = bridges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    alone = ends.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    whole = labels.unionAll(alone).join(joined, "component", "left")
    return store(whole.select("node", F.coalesce("whole", "component").alias("component")), "labels")


def near_duplicates(
    documents: DataFrame,
    *,
    identifier: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    mark: Column | None = None,
) -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component`` (smallest id reachable by links) and ``kept``.

    ``mark`` is a text of each row that is given back as ``mark``.
    """
    texts = documents.select(
        F.col(identifier).cast("long").alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.lit(None) if mark is None else mark).cast("string").alias("mark"),
    )
    sketched = store(sketches(texts, width), "sketches")
    texts = texts.select("id", "text")
    filled = sketched.filter("n > 0")
    unclear = _unclear_ids(filled)
    sets_of = filled.groupBy(*SAME_SET)
    nodes = _with_node(sets_of.agg(F.min("id").alias("id"), F.max("sig").alias("sig")), unclear)
    pairs, members = candidates(nodes.select(F.col("node").alias("id"), "n", "sig"), percent)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    wanted = store(ends.unionAll(members.select("id")).distinct(), "candidate-ids")
    sets = _full_sets(texts, wanted, unclear, width)

    labels = components(_confirmed(_best_of_each(pairs), sets, percent))
    labels = _bridged(_confirmed(_crossing(pairs, labels), sets, percent), labels)
    if not members.isEmpty():
        labels = _bridged(stray_links(members, labels, sets, percent), labels)
    discard(pairs, members, wanted, sets)

    named = _with_node(sets_of.agg(F.min("id").alias("id")), unclear).join(labels, "node", "left")
    named = named.select("id", *SAME_SET, F.coalesce("component", "node").alias("component"))
    if unclear is not None:
        named = _by_smallest_id(store(named, "named-sets"), unclear)
    linked = filled.select("id", "mark", *SAME_SET).join(named.select(*SAME_SET, "component"), SAME_SET, "left")
    alone = sketched.filter("n = 0").select("id", "mark", "n", F.col("id").alias("component"))
    every = linked.select("id", "mark", "n", "component").unionAll(alone)
    return every.select(
        "id",
        F.col("n").alias("n_shingles"),
        "component",
        _same("id", "component").alias("kept"),
        *([] if mark is None else ["mark"]),
    )


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def one_of_each(documents: DataFrame, *, identifier: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without those that repeat another one's content nearly; a verdict holds for rows of one id and text."""
    mark = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    found = near_duplicates(documents, identifier=identifier, text=text, mark=mark, **options)
    dropped = store(found.filter("NOT kept").select("id", "mark").distinct(), "near-copies")
    few = dropped.count() <= BROADCAST_IDS
    at = {name: f"_{place}" for place, name in enumerate(documents.columns)}  # no names of ours among the columns
    kept = documents.toDF(*at.values())
    mark = F.md5(F.coalesce(F.col(at[text]), F.lit("")).cast("binary"))
    same = F.col(at[identifier]).cast("long").eqNullSafe(F.col("id")) & (mark == F.col("mark"))
    return kept.join(F.broadcast(dropped) if few else dropped, same, "left_anti").toDF(*documents.columns)
