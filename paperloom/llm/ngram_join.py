"""N-gram Jaccard join, exact: shared prefixes, size-banded tiles, bitmap bounds, array intersection.

A document is the set of its distinct word n-grams. Two sets that reach the threshold share most of
either, so three filters of rising cost leave only those that can:

1. In hash order, the first n - ceil(t n) + k(n) n-grams of linked sets have k of the smaller one in common. A set
   of whose prefix fewer n-grams occur in any other prefix links with nothing. Tasks settle the
   n-grams they hold several times themselves and hand on one row for each, so that a frequent one
   costs a row a task and not one a document.
2. The sets that are left are counted out in full. In order of rising frequency the first n - ceil(t n) + 1
   n-grams of linked sets meet; a set with as many n-grams of its own drops out, and for the others
   only rare n-grams make candidates. Sets that share such a key, directly or by others, form a group.
3. A group is compared in tiles. A small one is a single tile. A large one is cut into size bands and
   these into blocks of bounded size: first each block with the hubs of its band and its neighbours, then, where a
   group is not yet one component, the sets outside its largest component against all blocks of neighbouring bands.

In a tile every pair of sets of fitting sizes and different components must pass the bitmap bound: a parity bitmap has one
bit per hash bucket, and the bits in which two differ, with the n-grams that no other set has, bound the sets'
difference from below, hence their overlap from above. Survivors are decided by intersecting the sorted
arrays. Links join components at once, and a tile hands on the edges of a spanning forest, at most one for
each of its sets.

Documents with equal sets are one node from the start. Components are found in tables. The join gives
components, not link counts: pairs inside a component that is known already are skipped.

Null texts, empty texts and texts without words have an empty set and are linked with nothing.
Repeated rows, even of one doc_id, are documents of equal sets; rows that share a doc_id but not a
text are documents of their own. Rows with a null doc_id are returned with a null component. Only
doc_id and text are read, so other columns may have any name. Sets are named by 128-bit hashes, n-grams by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import Scratch, batched_words, bounds, chain_hashes, free_name, lean, runs, shuffles_removed
from paperloom.llm.graph import components

EXTRA = 10  # k(n), in percent of a set's size
FLUSH = 1_000_000  # n-grams that a task settles together
BLOCK = 1 << 18  # n-grams of a block
HUBS = 2  # of a band
BLOOM_BITS = 1 << 26
MEASURED = "doc_id long, text_hash long, row long, n long, hi long, lo long, prefix binary"


def shingles(h: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text's word hashes; fewer words are one n-gram."""
    return np.unique(chain_hashes(h, min(words, len(h)))) if len(h) else np.empty(0, np.uint64)


def shingle_sets(texts: pd.Series, words: int) -> list[np.ndarray]:
    return [shingles(h, words) for h in batched_words(list(texts))]


def set_names(sets: list[np.ndarray]) -> np.ndarray:
    """128-bit names, as two integers a row."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(s.tobytes()) for s in sets]), np.int64).reshape(-1, 2)


def overlap_needed(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def extra(n: int) -> int:
    return -(-n * EXTRA // 100)


def extended_length(n: int, percent: int) -> int:
    """Two linked sets have ``extra`` of the smaller size in common within so many of each."""
    return n - overlap_needed(n, percent) + extra(n)


def shared_needed(n: Column, percent: int) -> Column:
    """``extra`` of the smallest size that a partner of a set of n can have."""
    up = lambda x, share: F.floor((x * share + 99) / 100)
    return up(up(n, percent), EXTRA)


def measure(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of every row its id, a hash of its text, a number of its own, its set's size and name, and the n-grams of the extended prefix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 36
        for pdf in batches:
            sets = shingle_sets(pdf.text, words)
            names = set_names(sets)
            yield pd.DataFrame({
                "doc_id": pdf.doc_id.astype("Int64"), "text_hash": pdf.text_hash, "row": np.arange(row, row + len(sets)), "n": [len(s) for s in sets], "hi": names[:, 0], "lo": names[:, 1],
                "prefix": [s[: extended_length(len(s), percent)].tobytes() if len(s) else None for s in sets],
            })
            row += len(sets)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInPandas(lean(run), MEASURED)


def settle(names: np.ndarray, prefixes: list[bytes]) -> pd.DataFrame:
    """Rows (key, name, credit) of some sets' prefixes.

    An n-gram of one set: credit 0. One of several sets: a row with credit -1, and each of these sets is
    credited with it in a row whose key is its own name.
    """
    key = np.frombuffer(b"".join(prefixes), np.int64)
    name = np.repeat(names, [len(p) // 8 for p in prefixes])
    order = np.lexsort((name, key))
    key, name = key[order], name[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
    key, name = key[new], name[new]
    at = bounds(key)
    size = np.diff(at)
    several = np.repeat(size > 1, size)
    who, times = np.unique(name[several], return_counts=True)
    first = at[:-1]
    return pd.DataFrame({"key": np.concatenate([key[first], who]), "name": np.concatenate([name[first], who]), "credit": np.concatenate([np.where(size > 1, -1, 0), times]).astype(np.int32)})


def prefix_keys(measured: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: list[int] = []
        prefixes: list[bytes] = []
        held = 0
        for pdf in batches:
            for name, prefix in zip(pdf.lo.tolist(), pdf.prefix):
                names.append(name)
                prefixes.append(prefix)
                held += len(prefix) // 8
                if held >= FLUSH:
                    yield settle(np.array(names), prefixes)
                    names, prefixes, held = [], [], 0
        if held:
            yield settle(np.array(names), prefixes)

    return measured.select("lo", "prefix").mapInPandas(lean(run), "key long, name long, credit int")


def credits_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(name, credit) from rows sorted by key and name: an n-gram that several sets have counts for each.

    Of a key that spans batches only its first name is held, however many rows it has. Copies of a set that tasks have
    settled apart may be credited more than once, which keeps a set in and never loses one.
    """
    key_now = name_now = None  # the key that the last batch ended with, and its only name so far, not yet credited
    shared = False  # whether that key is known to be shared
    for pdf in batches:
        if pdf.empty:
            continue
        key, name, credit = (pdf[c].to_numpy() for c in ("key", "name", "credit"))
        given = credit > 0
        gained, amount = [name[given]], [credit[given].astype(np.int64)]
        key, name, credit = key[~given], name[~given], credit[~given]
        if len(key):
            at = bounds(key)
            first, size = at[:-1], np.diff(at)
            several = (np.minimum.reduceat(name, first) != np.maximum.reduceat(name, first)) | (np.minimum.reduceat(credit, first) < 0)
            if key[0] == key_now:
                several[0] |= shared or (name_now is not None and (name[: size[0]] != name_now).any())
                if several[0] and name_now is not None:
                    gained.append(np.array([name_now]))
                    amount.append(np.ones(1, np.int64))
            ask = np.repeat(several, size) & (credit == 0)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
            gained.append(name[ask & new])
            amount.append(np.ones(int((ask & new).sum()), np.int64))
            key_now, shared = key[-1], bool(several[-1])
            name_now = None if shared else name[-1]
        who, at = np.unique(np.concatenate(gained), return_inverse=True)
        yield pd.DataFrame({"name": who, "credit": np.bincount(at, np.concatenate(amount), len(who)).astype(np.int64)})


def bloom(ids: DataFrame, column: str) -> np.ndarray:
    """A filter of BLOOM_BITS bits over a column of integers; ``spot`` says where."""
    at = spot(column)
    words = ids.groupBy((at / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))).alias("v")).toPandas()  # at most BLOOM_BITS / 64 rows
    bits = np.zeros(BLOOM_BITS // 64, np.int64)
    bits[words["w"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64)
    return bits


def spot(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BLOOM_BITS))


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """node, n and items of the wanted sets (hi, lo, n, doc, node), each from one text of its document.

    A Bloom filter of fixed size spares most other texts; the join that follows is exact. A task passes a set on once, not once a copy.
    """
    bits = docs.sparkSession.sparkContext.broadcast(bloom(wanted, "doc"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for pdf in batches:
            at = pdf.spot.to_numpy(np.int64)
            part = pdf[bits.value[at >> 6] >> (at & 63) & 1 == 1]
            sets = shingle_sets(part.text, words)
            names = set_names(sets)
            new = [i for i, k in enumerate(names[:, 0].tolist()) if len(sets[i]) and k not in seen]
            seen.update(names[new, 0].tolist())
            if len(seen) > 200_000:
                seen.clear()
            yield pd.DataFrame({"hi": names[new, 0], "lo": names[new, 1], "items": pd.Series([sets[i].view(np.int64) for i in new], dtype=object)})

    found = docs.where("doc_id is not null").select("text", spot("doc_id").alias("spot")).mapInPandas(lean(run), "hi long, lo long, items array<long>")
    return found.join(wanted.select("hi", "lo", "n", "node"), ["hi", "lo"]).groupBy("hi", "lo").agg(F.first("node").alias("node"), F.first("n").alias("n"), F.first("items").alias("items")).select("node", "n", "items")


def shared_items(sets: DataFrame, percent: int) -> DataFrame:
    """node, n, items (that other sets have too) and keys (the prefix in order of frequency), of the sets that can link."""
    rows = sets.select("node", "n", F.explode("items").alias("key"))
    counts = rows.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    common = rows.join(counts.hint("shuffle_hash"), "key").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("common"))
    left = (F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1 - (F.col("n") - F.size("common"))).cast("int")
    return common.where(left > 0).select("node", "n", F.array_sort("common.key").alias("items"), F.slice("common.key", F.lit(1), left).alias("keys"))


def groups_of(shared: DataFrame) -> DataFrame:
    """(node, grp): sets that are joined by common keys, directly or by others."""
    rows = shared.select("node", F.explode("keys").alias("key"))
    hubs = rows.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("c")).where("c > 1").drop("c")
    return components(rows.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))).select("node", F.col("component").alias("grp"))


def band_of(n: Column, percent: int) -> Column:
    return F.floor(F.log(n) / math.log(100 / percent)).cast("int")


TILE = ["grp", "tb", "ti", "sb", "si"]


def first_tiles(members: DataFrame, large: DataFrame) -> DataFrame:
    """TILE and node: whole groups, and the blocks of ``large`` ones (grp, band, blocks) with hubs of their bands and the next."""
    small = members.join(large.select("grp").distinct(), "grp", "left_anti").select("grp", *[F.lit(0).alias(c) for c in TILE[1:]], "node")
    placed = members.join(large, ["grp", "band"])
    own = placed.select("grp", F.col("band").alias("tb"), block_of("blocks").alias("ti"), "node")
    hubs = placed.groupBy("grp", "band").agg(F.array(*[F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(HUBS)]).alias("hubs"))
    near = hubs.select("grp", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"), "hubs").join(large, ["grp", "band"])
    sent = near.select("grp", F.col("band").alias("tb"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("ti"), "hubs").select("grp", "tb", "ti", F.explode("hubs").alias("node"))
    blocks = own.unionByName(sent).distinct().select("grp", "tb", "ti", F.lit(0).alias("sb"), F.lit(0).alias("si"), "node")
    return small.unionByName(blocks)


def block_of(blocks: str) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(-1)), F.col(blocks)).cast("int")


def block_counts(members: DataFrame, name: str) -> DataFrame:
    return members.groupBy("grp", "band").agg(F.ceil(F.sum("size") / BLOCK).cast("int").alias(name))


def second_tiles(members: DataFrame, large: DataFrame) -> DataFrame:
    """TILE, node and outer: of large groups, the sets outside the largest component (outer) against all blocks of neighbouring bands."""
    sizes = members.join(large.select("grp").distinct(), "grp", "left_semi").groupBy("grp", "part").agg(F.count("*").alias("c"))
    main = sizes.groupBy("grp").agg(F.max_by("part", F.struct("c", "part")).alias("main"))
    open_groups = members.join(main, "grp")
    outer = open_groups.where("part <> main").drop("main")
    blocks, outer_blocks = large, block_counts(outer, "cut")
    spread = lambda df, count, out: df.withColumn(out, F.explode(F.sequence(F.lit(0), F.col(count) - 1)))
    near = lambda df, out: df.withColumn(out, F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    left = near(outer.join(outer_blocks, ["grp", "band"]).select("grp", "band", block_of("cut").alias("ti"), "node"), "sb")
    left = spread(left.join(blocks.select("grp", F.col("band").alias("sb"), "blocks"), ["grp", "sb"]), "blocks", "si").select("grp", F.col("band").alias("tb"), "ti", "sb", "si", "node", F.lit(True).alias("outer"))
    right = near(open_groups.join(blocks, ["grp", "band"]).select("grp", "band", block_of("blocks").alias("si"), "node"), "tb")
    right = spread(right.join(outer_blocks.select("grp", F.col("band").alias("tb"), "cut"), ["grp", "tb"]), "cut", "ti").select("grp", "tb", "ti", F.col("band").alias("sb"), "si", "node", F.lit(False).alias("outer"))
    return left.unionByName(right)


def bitmaps(items: np.ndarray, row: np.ndarray, rows: int, width: int) -> np.ndarray:
    """Parities of bucket counts, packed into 64-bit words, a row for each set. ``row``: sorted, the set of each item."""
    out = np.empty((rows, width // 64), np.uint64)
    spots = (items >> 20) & (width - 1)
    step = max(1, (1 << 20) // width)
    for r in range(0, rows, step):
        s, e = np.searchsorted(row, [r, r + step])
        here = min(step, rows - r)
        odd = np.bincount((row[s:e] - r) * width + spots[s:e], minlength=here * width).reshape(here, width) & 1
        out[r : r + here] = np.packbits(odd.astype(bool), axis=1).view(np.uint64)
    return out


def may_link(diff: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets that differ in at least ``diff`` items can reach the threshold."""
    return diff * (100 + percent) <= (na + nb) * (100 - percent)


def tile_edges(node: np.ndarray, n: np.ndarray, part: np.ndarray, outer: np.ndarray | None, items: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the links of one tile between different parts.

    ``n``: whole sizes, ``items``: sorted, those that other sets have too. ``outer``: None to compare all with all, or which sets
    are compared with the others.
    """
    order = np.argsort(n, kind="stable")
    node, n, label = node[order], n[order], np.unique(part[order], return_inverse=True)[1]
    outer = None if outer is None else outer[order]
    if (label == label[0]).all():
        return []
    items = [items[i] for i in order]
    size = np.array([len(x) for x in items])
    at = np.concatenate([[0], np.cumsum(size)])
    flat = np.concatenate(items)
    ids = np.unique(flat, return_inverse=True)[1]
    width = min(4096, max(64, 1 << (2 * int(np.median(size)) - 1).bit_length()))
    bits = bitmaps(flat, np.repeat(np.arange(len(n)), size), len(n), width)
    own = n - size  # no other set has these
    end = np.searchsorted(n, n * 100 // percent, side="right")
    mark = np.zeros(int(ids.max()) + 1, bool)
    edges: list[tuple[int, int]] = []
    for i in range(len(n) - 1):
        fits = label[i + 1 : end[i]] != label[i]
        if outer is not None:
            fits &= outer[i + 1 : end[i]] != outer[i]
        j = i + 1 + np.flatnonzero(fits)
        if not len(j):
            continue
        diff = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64) + own[j] + own[i]
        j = j[may_link(diff, n[j], n[i], percent)]
        if not len(j):
            continue
        mine = ids[at[i] : at[i + 1]]
        mark[mine] = True
        cut = np.concatenate([[0], np.cumsum(size[j])])
        both = np.add.reduceat(mark[ids[np.arange(cut[-1]) + np.repeat(at[j] - cut[:-1], size[j])]], cut[:-1], dtype=np.int64)
        mark[mine] = False
        for k in j[100 * both >= percent * (n[j] + n[i] - both)].tolist():
            if label[k] != label[i]:
                edges.append((int(node[i]), int(node[k])))
                label[label == label[k]] = label[i]
    return edges


def decide(tiles: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) of all tiles. ``tiles``: TILE, node, part, outer (null to compare all)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in runs(batches, TILE):
            at = bounds(*(pdf[c].to_numpy() for c in TILE))
            node, n, part = (pdf[c].to_numpy(np.int64) for c in ("node", "n", "part"))
            items, outer = pdf["items"].tolist(), pdf["outer"]
            found: list[tuple[int, int]] = []
            for s, e in zip(at.tolist(), at[1:].tolist()):
                if e - s > 1:
                    side = None if outer.iloc[s] is None or pd.isna(outer.iloc[s]) else outer.iloc[s:e].to_numpy(bool)
                    found += tile_edges(node[s:e], n[s:e], part[s:e], side, items[s:e], percent)
            yield pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

    dealt = tiles.join(shared.select("node", "n", "items"), "node").select(*TILE, "node", "n", "part", "outer", "items")
    return dealt.repartition(*TILE).sortWithinPartitions(*TILE).mapInPandas(lean(run), "a long, b long")


def linked_nodes(shared: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """(node, component) of the nodes with links."""
    sized = shared.select("node", "n", F.size("items").alias("size"), band_of(F.col("n"), percent).alias("band"))
    members = scratch.keep(sized.join(groups_of(shared), "node"), "members")
    long_groups = members.groupBy("grp").agg(F.sum("size").alias("all")).where(F.col("all") > BLOCK).select("grp")
    large = scratch.keep(block_counts(members.join(long_groups, "grp", "left_semi"), "blocks"), "large")
    tiles = first_tiles(members, large).select(*TILE, "node", F.col("node").alias("part"), F.lit(None).cast("boolean").alias("outer"))
    edges = scratch.keep(decide(tiles, shared, percent), "edges1")
    if not large.isEmpty():
        parts = members.join(components(edges), "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
        parts = scratch.keep(parts, "parts")
        tiles = second_tiles(parts, large).join(parts.select("node", "part"), "node")
        edges = edges.unionByName(scratch.keep(decide(tiles, shared, percent), "edges2"))
    return components(edges)


def link_rows(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and group_row (a number that one component has, null for empty sets) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select("doc_id", "text")
    with shuffles_removed(spark):
        measured = scratch.keep(measure(docs, words, percent), "measured")
        usable = "n > 0 and doc_id is not null"
        met = prefix_keys(measured.where(usable)).repartition("key").sortWithinPartitions("key", "name").mapInPandas(lean(credits_of), "name long, credit long")
        credit = scratch.keep(met.groupBy("name").agg(F.sum("credit").alias("credit")), "credits")
        rows = scratch.keep(measured.drop("prefix"), "rows")
        scratch.drop("measured")
        nodes = rows.where(usable).groupBy("hi", "lo", "n").agg(F.min("doc_id").alias("doc"), F.min("row").alias("node"))
        nodes = scratch.keep(nodes, "nodes")
        wanted = scratch.keep(nodes.join(credit, nodes["lo"] == credit["name"]).where(F.col("credit") >= shared_needed(F.col("n"), percent)).select("hi", "lo", "n", "doc", "node"), "wanted")
        scratch.drop("credits")
        sets = scratch.keep(sets_of(docs, wanted, words), "sets")
        shared = scratch.keep(shared_items(sets, percent), "shared")
        scratch.drop("sets")
        labels = linked_nodes(shared, scratch, percent)
        placed = labels.join(wanted.select("node", "hi", "lo", "doc"), "node")
        least = placed.groupBy("component").agg(F.min("doc").alias("least"))
        named = nodes.join(placed.join(least, "component").select("hi", "lo", "component", "least"), ["hi", "lo"], "left").select("hi", "lo", F.coalesce("component", "node").alias("group_row"), F.coalesce("least", "doc").alias("component_id"))
        named = scratch.keep(named, "named")
        scratch.drop(*[x for x in scratch.paths if x not in ("rows", "named")])
    joined = rows.where(usable).join(named, ["hi", "lo"]).select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", "group_row")
    alone = rows.where(f"not ({usable})").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group_row"))
    return joined.unionByName(alone)


def link_documents(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row."""
    return link_rows(docs, words, percent).drop("text_hash", "group_row")


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id, of repeated rows one.

    Rows without an id stay. All columns are kept, whatever their names.
    """
    rows = link_rows(docs, words, percent).where("doc_id is not null")
    alone = rows.where("group_row is null").select("doc_id", "text_hash")
    least = rows.where("group_row is not null").groupBy("group_row").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select("first.*")
    key = [free_name(docs, "__doc"), free_name(docs, "__hash")]
    kept = least.unionByName(alone).distinct().toDF(*key)
    named = docs.where("doc_id is not null").withColumns(dict(zip(key, (F.col("doc_id"), F.xxhash64("text")))))
    return named.join(kept, key, "left_semi").dropDuplicates(key).select(*docs.columns).unionByName(docs.where("doc_id is null"))
