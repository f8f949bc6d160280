"""N-gram Jaccard join as a blocked sparse matrix product (operator 5).

The matrix has a row for every distinct set of shingles and a column for every shingle. Columns are
dealt by hash to as many blocks as a count of words asks for; a block keeps the entries of columns that two sets or more have, so a set
of which too few shingles are shared drops out before anything is multiplied. Of what is left, the
rarest shingles that a link cannot do without join sets to clusters, and the product is computed
tile by tile within clusters: overlap counts are accumulated over shared shingles, pairs below
the bound that follows from the two sizes are discarded, and of the links of a tile a spanning
forest is kept. Connected components of all forests give the answer. Equal sets are one row from
the start, so copies multiply nothing; no pair is ever written out that is not such a tree edge.

Shingles and sets are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstats.llm.common import WORDS, leaving_nothing, stored, stream_leaving_nothing, text_or_empty
from eventstats.llm.components import components

#: Words in a shingle, and the least similarity in hundredths.
SHINGLE = 5
PERCENT = 75
#: Sets and shingles that one side of a tile holds, about.
TILE_SETS = 2048
TILE_SHINGLES = 1 << 20
#: Counts of the product, and hits, that are held at once, about; a dozen arrays of this length are.
TILE_PRODUCT = 1 << 18
#: Entries that a block of columns holds, about.
BLOCK_ENTRIES = 1 << 22
#: Documents of a map batch that are packed together, and entries of the cache of word hashes.
PACK = 500
CACHE_WORDS = 500_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_MUL = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: dict, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, as the join defines them."""
    # bytes.split() splits at space and 0x09 to 0x0D, as the words are defined.
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    found = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    count = len(words) - width + 1
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = (out ^ (out >> np.uint64(29))) * _MUL + found[k : k + count]
    return np.unique((out ^ (out >> np.uint64(32))) * _MUL)


def set_hash(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


MAPPED = "key long, doc_id long, mark long, v long, n long, sets binary, counts binary, grams binary"
SHARED = "doc_id long, mark long, v long, n long, gram long"


def _map_batches(blocks: int):
    """Per batch: a row per document, and the shingles of its distinct sets by block of columns.

    Of a shingle that many sets of the batch have, two entries go to the block: they prove it
    shared to everyone. The others need no proof and go to any task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for at in range(0, len(batch), PACK):
                part = batch.slice(at, PACK)
                ids, marks = part.column(0).to_pylist(), part.column(2).to_pylist()
                found = [shingle_set(t, hashes) for t in part.column(1).to_pylist()]
                names = [set_hash(g) for g in found]
                first = names[0] % blocks  # rows of copies go to any block, not to one
                rows = [(-1 - (first + j) % blocks, i, m, v, len(g), None, None, None)
                        for j, (i, m, v, g) in enumerate(zip(ids, marks, names, found))]
                distinct = {v: g for v, g in zip(names, found) if len(g)}
                if distinct:
                    rows += _packed(distinct, blocks, first)
                columns = zip(*rows)
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in MAPPED.split(", ")])

    return run


def _packed(distinct: dict[int, np.ndarray], blocks: int, first: int) -> list[tuple]:
    sets = np.array(list(distinct), np.int64)
    grams = np.concatenate(list(distinct.values()))
    owner = np.repeat(np.arange(len(sets)), [len(g) for g in distinct.values()])
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    place = np.arange(len(ordered)) - np.repeat(begins, np.diff(np.append(begins, len(ordered))))
    known = np.zeros(len(grams), bool)
    known[order[place >= 2]] = True
    block = ((grams >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    block[known] = -1 - (first + owner[known]) % blocks
    order = np.lexsort((owner, block))
    block, owner, grams = block[order], owner[order], grams[order]
    edges = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist() + [len(block)]
    rows = []
    for a, b in zip(edges, edges[1:]):
        who, counts = np.unique(owner[a:b], return_counts=True)
        rows.append((int(block[a]), None, None, None, None, sets[who].tobytes(), counts.astype(np.uint32).tobytes(), grams[a:b].tobytes()))
    return rows


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x is not None), kind)


def _keep_shared(part: pa.Table) -> pa.Table:
    """The entries of one block whose column has two sets; rows of documents pass through."""
    docs = part.filter(pc.is_valid(part["v"])).select(["doc_id", "mark", "v", "n"])
    sets = np.repeat(_joined(part["sets"], np.int64), _joined(part["counts"], np.uint32))
    grams = _joined(part["grams"], np.uint64)
    if part["key"][0].as_py() >= 0:
        order = np.lexsort((sets, grams))
        sets, grams = sets[order], grams[order]
        new_gram = np.append(True, grams[1:] != grams[:-1])[: len(grams)]
        first = new_gram | np.append(True, sets[1:] != sets[:-1])[: len(grams)]
        sets, grams, new_gram = sets[first], grams[first], new_gram[first]
        begins = np.flatnonzero(new_gram)
        sizes = np.diff(np.append(begins, len(grams)))
        shared = np.repeat(sizes, sizes) >= 2
        sets, grams = sets[shared], grams[shared]
    empty = pa.nulls(len(grams), pa.int64())
    entries = pa.table({"doc_id": empty, "mark": empty, "v": sets, "n": empty, "gram": grams.view(np.int64)})
    return pa.concat_tables([docs.append_column("gram", pa.nulls(len(docs), pa.int64())), entries])


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of the product of two incidence matrices, as (first row, dense block of counts)."""
    columns = np.concatenate(right)
    owner = np.repeat(np.arange(len(right)), [len(g) for g in right])
    order = np.argsort(columns, kind="stable")
    columns, owner = columns[order], owner[order]
    step = max(1, TILE_PRODUCT // len(right))
    for at in range(0, len(left), step):
        block = left[at : at + step]
        grams = np.concatenate(block)
        row = np.repeat(np.arange(len(block)), [len(g) for g in block])
        low, high = np.searchsorted(columns, grams, "left"), np.searchsorted(columns, grams, "right")
        hits = high - low
        out = np.zeros(len(block) * len(right), np.int64)
        cuts = np.searchsorted(np.cumsum(hits), np.arange(TILE_PRODUCT, int(hits.sum()) + 1, TILE_PRODUCT))
        for a, b in zip([0, *cuts], [*cuts, len(grams)]):
            many = hits[a:b]
            inner = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            found = owner[np.repeat(low[a:b], many) + inner]
            out += np.bincount(np.repeat(row[a:b], many) * len(right) + found, minlength=len(out))
        yield at, out.reshape(len(block), len(right))


def tile_links(part: pa.Table, percent: int = PERCENT) -> pa.Table:
    """A spanning forest of the links in one tile: of its rows with each other, or of two sides."""
    part = part.combine_chunks()
    sides, names, sizes = (part[c].to_numpy() for c in ("side", "v", "n"))
    grams = [np.asarray(g, np.int64) for g in part["grams"].to_numpy(zero_copy_only=False)]
    if sides.any():
        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    else:
        left = right = np.arange(len(names))
    parent = list(range(len(names)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    edges = []
    if len(left) and len(right):
        for at, counts in _overlaps([grams[i] for i in left], [grams[i] for i in right]):
            mine = sizes[left[at : at + len(counts)]][:, None]
            # 100 o >= percent (a + b - o), the bound on the overlap that the two sizes set
            linked = (100 + percent) * counts >= percent * (mine + sizes[right][None, :])
            for i, j in zip(*np.nonzero(linked & (counts > 0))):
                a, b = root(int(left[at + i])), root(int(right[j]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((int(names[left[at + i]]), int(names[right[j]])))
    a, b = zip(*edges) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def set_links(shared: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Forest edges ``a, b`` of all links between distinct sets.

    ``shared`` has the entries ``v, gram`` of shared columns, maybe repeated; ``sets`` ``v, n``.
    """
    needed = F.ceil(F.col("n") * percent / F.lit(100.0))  # a link shares this much of either set
    rows = shared.groupBy("v").agg(F.collect_set("gram").alias("grams")).join(sets, "v")
    rows = stored(rows.filter(F.size("grams") >= needed).select("v", "n", "grams"), "likely-sets")
    entries = rows.select("v", "n", F.explode("grams").alias("gram"))
    widths = entries.groupBy("gram").agg(F.count("*").alias("width")).filter("width > 1")
    ranked = entries.join(widths, "gram").groupBy("v", "n").agg(
        F.sort_array(F.collect_list(F.struct("width", "gram"))).alias("e"))
    rows = stored(ranked.filter(F.size("e") >= needed).select("v", "n", F.col("e.gram").alias("grams")), "ranked-sets")
    # Two linked sets share one of their rarest shingles: all but needed - 1 of either set.
    rare = rows.select("v", F.explode(F.slice("grams", 1, (F.size("grams") - needed + 1).cast("int"))).alias("gram"))
    pivots = rare.groupBy("gram").agg(F.min("v").alias("a"), F.count("*").alias("c")).filter("c > 1")
    near = rare.join(pivots, "gram").select("a", F.col("v").alias("b"))
    clusters = stored(components(near), "clusters")
    members = rows.join(clusters.select(F.col("node").alias("v"), F.col("root").alias("cluster")), "v")
    members = stored(members, "cluster-members")
    extent = members.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum(F.size("grams")).alias("entries"))
    cuts = F.greatest(F.ceil(F.col("docs") / TILE_SETS), F.ceil(F.col("entries") / TILE_SHINGLES)).cast("int")
    extent = stored(extent.select(F.col("cluster").alias("c"), "docs", "entries", cuts.alias("cuts")), "extents")
    total = extent.agg(F.sum("docs"), F.sum("entries")).first()
    packs = max(1, -(-(total[0] or 0) // TILE_SETS), -(-(total[1] or 0) // TILE_SHINGLES))
    placed = members.join(extent, F.col("cluster") == F.col("c"))
    small = placed.filter("cuts = 1").select(
        F.pmod(F.xxhash64("cluster"), F.lit(packs)).alias("t1"), F.lit(-1).alias("t2"), F.lit(-1).alias("t3"),
        F.lit(0).alias("side"), "v", "n", "grams")
    own = F.pmod(F.xxhash64("v"), F.col("cuts")).cast("int")
    large = placed.filter("cuts > 1").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    large = large.select(
        F.col("cluster").alias("t1"), F.least("own", "other").alias("t2"), F.greatest("own", "other").alias("t3"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "v", "n", "grams")
    tiles = small.unionByName(large)
    return tiles.groupBy("t1", "t2", "t3").applyInArrow(
        leaving_nothing(lambda part: tile_links(part, percent)), "a long, b long")


def column_blocks(docs: DataFrame, text: str, least: int) -> int:
    """Blocks of columns, by the number of words: a text has no more shingles than words."""
    words = docs.select(F.sum(F.regexp_count(text_or_empty(text), F.lit(WORDS)))).first()[0] or 0
    return max(least, -(-words // BLOCK_ENTRIES))


def _marked(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """``near_duplicates`` with ``mark``, the hash of the text, for every row."""
    spark = docs.sparkSession
    blocks = column_blocks(docs, text, int(spark.conf.get("spark.sql.shuffle.partitions")))
    given = docs.select(F.col(doc_id).cast("long"), F.col(text), F.xxhash64(text))
    mapped = given.mapInArrow(stream_leaving_nothing(_map_batches(blocks)), MAPPED)
    found = stored(mapped.groupBy("key").applyInArrow(leaving_nothing(_keep_shared), SHARED), "shared-columns")
    rows = found.filter("gram is null").select("doc_id", "mark", "v", "n")
    sets = stored(rows.groupBy("v").agg(F.first("n").alias("n"), F.min("doc_id").alias("first_id")), "sets")
    links = set_links(found.filter("gram is not null").select("v", "gram"), sets.select("v", "n"), percent)
    linked = components(links)
    joined = sets.join(linked.withColumnRenamed("node", "v"), "v", "left").select(
        "v", F.coalesce("root", "v").alias("root"), "first_id")
    smallest = joined.groupBy("root").agg(F.min("first_id").alias("component"))
    named = stored(joined.join(smallest, "root").select(F.col("v").alias("set_id"), "component"), "components")
    out = rows.join(named, F.col("v") == F.col("set_id"))
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "mark", F.col("n").alias("n_shingles"), "set_id", own.alias("component_id"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, set_id, component_id`` for every row of ``docs``.

    Words are runs without ASCII white space, with A-Z in lower case; a shingle is five words,
    or all words of a shorter text. Two rows link when 100 times the size of the intersection of
    their sets is at least ``percent`` times that of the union. ``component_id`` is the smallest id
    reachable by links. Null texts and texts without words link with nothing and are their own
    component. Repeated rows and equal sets are linked; a null id is in its component but never
    names it, unless no other id is there. Other columns are not read; no rows give no rows.
    """
    return _marked(docs, doc_id, text, percent).drop("mark")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each component stays, the one with the smallest id, with all its columns.

    Each text is judged by its own component: of a repeated or null id only the texts that stay
    there are kept; rows of a component that share its id are one document. Documents without words
    stay, and so do components in which no row has an id. Only ids and hashes of texts decide; each
    text is shuffled once, by both.
    """
    found = _marked(docs, doc_id, text, percent)
    stays = (F.col("n_shingles") == 0) | F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    kept = found.filter(stays).select(F.col("doc_id").alias("_kept_id"), F.col("mark").alias("_kept_mark"))
    kept = stored(kept.distinct(), "kept-texts")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(row.alias("_row"), F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_mark"))
    same = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_mark") == F.col("_kept_mark"))
    return marked.join(kept.hint("shuffle_hash"), same, "left_semi").select("_row.*")
