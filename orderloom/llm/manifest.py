"""Merkle manifest of a dataset by bitmap ranks.

Every row is a leaf. Leaves of one ``lang`` make a tree in the order of ``doc_id``, and the trees'
roots make one more tree in the order of ``lang``. Leaves are not sorted: every task sets the bits of
its ids in compressed bitmaps of 65,536 ids, the bitmaps of all tasks are merged and get directories
of counts, and a leaf's place in its tree is the number of ids before its chunk plus the bits before
its own. Leaves then go to the slots of arrays keyed by tree and group of 4,096 places, where four
levels of the tree are reduced at once; the groups' nodes are the leaves of the next arrays.

Order inside a tree: null ids first, then ids ascending, rows with one id by their leaf hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sizing import broadcast_if_small
from .ranks import ranked, starts
from .storage import stored

FANOUT = 8
#: Levels that one slot array reduces, and its places.
DEPTH = 4
SPAN_BITS = 3 * DEPTH
SPAN = 1 << SPAN_BITS
#: Ids in a bitmap, and the number of them up to which it is kept as a list.
CHUNK_BITS = 16
LISTED = 4096
#: Leaves that a bucket of chunks is planned for, and ids that a task puts into bitmaps at a time.
BUCKET_ROWS = 250_000
FLUSH_IDS = 2_000_000
#: The chunk of null ids, before all others.
NULL_CHUNK = -(1 << 50)

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(replaced: dict[str, Column] | None = None) -> Column:
    """Digest of a row: each column as ``-`` or its UTF-8 length, ``:`` and its text."""

    def spelled(name: str) -> Column:
        text = (replaced or {}).get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[spelled(c) for c in LEAF_COLUMNS]), 256))


def leaves_of(docs: DataFrame, tampered: tuple[Column, Column]) -> DataFrame:
    """One row a document: its tree, chunk and place in the chunk, its leaf, and the leaf after tampering (null: none).

    ``tampered``: where a row is tampered with, and its text afterwards.
    """
    where, text = tampered
    number = F.col("doc_id").cast("long")
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.coalesce(F.shiftright(number, CHUNK_BITS), F.lit(NULL_CHUNK)).alias("chunk"),
        F.coalesce(number.bitwiseAND((1 << CHUNK_BITS) - 1), F.lit(0)).cast("int").alias("place"),
        number.alias("doc_id"),
        leaf_hash().alias("leaf"),
        F.when(where, leaf_hash({"text": text})).alias("other"),
    )


_BITMAPS = "tree string, chunk long, n long, form string, ids binary, repeated binary, times binary"


def _bitmap(places: np.ndarray) -> tuple[str, bytes]:
    """Ascending places as a list of 16-bit numbers or as bits, whichever is shorter."""
    if len(places) <= LISTED:
        return "list", places.astype("<u2").tobytes()
    bits = np.zeros(1 << CHUNK_BITS, np.uint8)
    bits[places] = 1
    return "bits", np.packbits(bits).tobytes()


def _places(form: str, ids: bytes) -> np.ndarray:
    if form == "list":
        return np.frombuffer(ids, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(ids, np.uint8)))


def _bitmap_row(tree: str, chunk: int, places: np.ndarray, counts: np.ndarray) -> tuple:
    form, ids = _bitmap(places)
    more = np.flatnonzero(counts > 1)
    return tree, chunk, int(counts.sum()), form, ids, places[more].astype("<u2").tobytes(), counts[more].astype("<i8").tobytes()


def _counted(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """A bitmap's places, and how often each occurs."""
    places = _places(row["form"], row["ids"])
    counts = np.ones(len(places), np.int64)
    counts[np.searchsorted(places, np.frombuffer(row["repeated"], "<u2"))] = np.frombuffer(row["times"], "<i8")
    return places, counts


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows) if rows else [[] for _ in schema], schema)], schema=schema)


_BITMAP_SCHEMA = pa.schema(
    [("tree", pa.string()), ("chunk", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("ids", pa.binary()), ("repeated", pa.binary()), ("times", pa.binary())]
)


def _chunk_rows(tree: str, chunks: np.ndarray, places: np.ndarray, counts: np.ndarray) -> list[tuple]:
    """Bitmap rows of one tree's ids, which may repeat and come in any order."""
    order = np.lexsort((places, chunks))
    chunks, places, counts = chunks[order], places[order], counts[order]
    new = np.ones(len(chunks), bool)
    new[1:] = (chunks[1:] != chunks[:-1]) | (places[1:] != places[:-1])
    at = np.flatnonzero(new)
    chunks, places, counts = chunks[at], places[at], np.add.reduceat(counts, at)
    edges = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1], [True]]))
    return [_bitmap_row(tree, int(chunks[a]), places[a:b], counts[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def _task_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    n = 0

    def flush() -> pa.RecordBatch:
        rows = []
        for tree, parts in held.items():
            chunks, places = (np.concatenate(x) for x in zip(*parts))
            rows += _chunk_rows(tree, chunks, places, np.ones(len(chunks), np.int64))
        return _as_batch(rows, _BITMAP_SCHEMA)

    for batch in batches:
        trees = batch.column("tree").dictionary_encode()
        which = trees.indices.to_numpy()
        chunks, places = (batch.column(c).to_numpy() for c in ("chunk", "place"))
        for i, tree in enumerate(trees.dictionary.to_pylist()):
            mine = which == i
            held.setdefault(tree, []).append((chunks[mine], places[mine].astype(np.int64)))
        n += batch.num_rows
        if n >= FLUSH_IDS:
            yield flush()
            held, n = {}, 0
    if held:
        yield flush()


def _merge_bitmaps(key: tuple, table: pa.Table) -> pa.Table:
    """The bitmaps of a bucket of chunks, each chunk's merged into one."""
    chunks: dict[tuple, list] = {}
    for row in table.to_pylist():
        chunks.setdefault((row["tree"], row["chunk"]), []).append(row)
    rows = []
    for (tree, chunk), parts in chunks.items():
        counts = np.zeros(1 << CHUNK_BITS, np.int64)
        for part in parts:
            places, times = _counted(part)
            counts[places] += times
        places = np.flatnonzero(counts)
        rows.append(_bitmap_row(tree, chunk, places, counts[places]))
    return pa.Table.from_batches([_as_batch(rows, _BITMAP_SCHEMA)])


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("tree", "chunk"), F.lit(n)).alias("bucket")


def bitmaps(leaves: DataFrame, buckets: int) -> DataFrame:
    """Each tree's ids as one bitmap a chunk, with how often the repeated ones occur."""
    own = leaves.select("tree", "chunk", "place").mapInArrow(_task_bitmaps, _BITMAPS)
    return own.groupBy(_bucket(buckets)).applyInArrow(_merge_bitmaps, _BITMAPS)


def directory(chunks: DataFrame) -> DataFrame:
    """Bitmaps with the leaves before them in their tree (``start``), and the tree's leaves (``n_tree``).

    Counts are summed up over chunks of 2^16 ids, of 2^32 and of 2^48, each inside the next.
    """
    sums = chunks.select("tree", F.shiftright("chunk", 32).alias("_high"), F.shiftright("chunk", 16).alias("_mid"), "chunk", "n")
    totals = sums.groupBy("tree").agg(F.sum("n").alias("n_tree"))
    placed = starts(sums, ["tree"], ["_high", "_mid", "chunk"], "n", "start").select("tree", "chunk", "start")
    return chunks.join(placed, ["tree", "chunk"]).join(broadcast_if_small(totals), "tree")


_PIECES = "tree string, g long, n long, slots binary, ids array<long>, leaves binary, others binary"
_PIECE_SCHEMA = pa.schema(
    [("tree", pa.string()), ("g", pa.int64()), ("n", pa.int64()), ("slots", pa.binary()), ("ids", pa.list_(pa.int64())), ("leaves", pa.binary()), ("others", pa.binary())]
)
#: Stands for a leaf that was not tampered with.
_NONE = bytes(32)


def _digests(values: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(values.fill_null(_NONE).to_pylist()), "V32")


def _rank_query(key: tuple, rows: pa.Table, chunks: pa.Table) -> pa.Table:
    """Places of a bucket's leaves by rank queries on its bitmaps, as pieces of slot arrays."""
    if not rows.num_rows:
        return _PIECE_SCHEMA.empty_table()
    row_chunk = rows["chunk"].to_numpy()
    row_place = rows["place"].to_numpy()
    trees = rows["tree"].combine_chunks().dictionary_encode()
    row_tree = trees.indices.to_numpy()
    number = {t: i for i, t in enumerate(trees.dictionary.to_pylist())}
    order = np.lexsort((row_chunk, row_tree))
    rank = np.empty(len(order), np.int64)
    sizes = np.zeros(len(number), np.int64)
    wanted = {}
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(row_chunk[order]) != 0) | (np.diff(row_tree[order]) != 0), [True]]))
    for a, b in zip(edges[:-1], edges[1:]):
        wanted[int(row_tree[order[a]]), int(row_chunk[order[a]])] = order[a:b]
    for row in chunks.to_pylist():
        mine = wanted.get((number.get(row["tree"], -1), row["chunk"]))
        if mine is None:
            continue
        places, counts = _counted(row)
        before = np.zeros(1 << CHUNK_BITS, np.int64)
        before[places] = np.cumsum(counts) - counts
        rank[mine] = row["start"] + before[row_place[mine]]
        sizes[number[row["tree"]]] = row["n_tree"]
    group = rank // SPAN
    order = np.lexsort((rank, row_tree))
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(group[order]) != 0) | (np.diff(row_tree[order]) != 0), [True]]))
    ids = rows["doc_id"].combine_chunks().take(pa.array(order))
    leaves, others = _digests(rows["leaf"])[order], _digests(rows["other"])[order]
    names = trees.dictionary.to_pylist()
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        tree, g = int(row_tree[order[a]]), int(group[order[a]])
        slots = (rank[order[a:b]] - g * SPAN).astype("<u2").tobytes()
        out.append((names[tree], g, int(sizes[tree]), slots, ids[a:b].to_pylist(), leaves[a:b].tobytes(), others[a:b].tobytes()))
    return pa.Table.from_batches([_as_batch(out, _PIECE_SCHEMA)])


def _run_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of equal leaves that follow each other."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            lo = max(r["rank"], r["g"] * SPAN)
            hi = min(r["rank"] + r["times"], (r["g"] + 1) * SPAN)
            k = hi - lo
            slots = np.arange(lo - r["g"] * SPAN, hi - r["g"] * SPAN).astype("<u2").tobytes()
            rows.append((r["tree"], r["g"], r["n_tree"], slots, [r["doc_id"]] * k, r["leaf"] * k, (r["other"] or _NONE) * k))
        yield _as_batch(rows, _PIECE_SCHEMA)


def _repeated_ids(chunks: DataFrame) -> DataFrame:
    """``tree, chunk, place, first, n_tree`` of each id that several rows have; ``first`` is the rank of the first of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, counts = _counted(row)
                at = np.flatnonzero(counts > 1)
                first = row["start"] + (np.cumsum(counts) - counts)[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(at), pa.string()), pa.array([row["chunk"]] * len(at), pa.int64()),
                        pa.array(places[at].astype(np.int32)), pa.array(first), pa.array([row["n_tree"]] * len(at), pa.int64()),
                    ],
                    names=["tree", "chunk", "place", "first", "n_tree"],
                )

    return chunks.filter("octet_length(repeated) > 0").mapInArrow(run, "tree string, chunk long, place int, first long, n_tree long")


def _pieces_of_repeated(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Pieces of the rows whose id is not theirs alone: equal rows are counted first, different ones placed by their leaves."""
    key = ["tree", "chunk", "place"]
    kinds = rows.groupBy(*key, "doc_id", "leaf", "other").agg(F.count("*").alias("times"))
    cut = kinds.withColumns({f"_{i}": F.substring("leaf", 2 * i + 1, 2) for i in range(3)})
    placed = starts(cut, key, ["_0", "_1", "_2", "leaf"], "times", "after")
    runs = placed.join(broadcast_if_small(repeated), key).withColumn("rank", F.col("first") + F.col("after"))
    last = F.col("rank") + F.col("times") - 1
    groups = F.explode(F.sequence(F.shiftright("rank", SPAN_BITS), F.shiftright(last, SPAN_BITS)))
    return runs.select("tree", "doc_id", "leaf", "other", "rank", "times", "n_tree", groups.alias("g")).mapInArrow(_run_pieces, _PIECES)


def levels_above(n: int) -> int:
    """Levels that a slot array reduces in a tree of ``n`` leaves."""
    levels = 0
    while n > 1 and levels < DEPTH:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, from the given ones up."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([sha256("".join(below[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(below), FANOUT)])
    return out


Step = tuple[str, str]


def paths(nodes: list[str], levels: int) -> list[list[Step]]:
    """For every node what stands left and right of it in its run, level by level."""
    tower = reduced(nodes, levels)
    above: list[list[Step]] = [[]] * len(tower[-1])
    for below in reversed(tower[:-1]):
        made = []
        for i in range(len(below)):
            run = i - i % FANOUT
            step = ("".join(below[run:i]), "".join(below[i + 1 : run + FANOUT]))
            made.append([step, *above[i // FANOUT]])
        above = made
    return above


def _pack_path(path: list[Step]) -> str:
    return ";".join(f"{a},{b}" for a, b in path)


def _unpack_path(text: str) -> list[Step]:
    return [tuple(step.split(",")) for step in text.split(";")] if text else []


_GROUPS = "tree string, g long, n long, node string, ids array<long>, leaves binary, others binary"
_GROUP_SCHEMA = pa.schema(
    [("tree", pa.string()), ("g", pa.int64()), ("n", pa.int64()), ("node", pa.string()), ("ids", pa.list_(pa.int64())), ("leaves", pa.binary()), ("others", pa.binary())]
)


def _hex(leaves: bytes) -> list[str]:
    text = leaves.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _fill_slots(key: tuple, table: pa.Table) -> pa.Table:
    """The slot array of one group, and the node that its leaves reduce to."""
    first = table.slice(0, 1).to_pylist()[0]
    size = min(SPAN, first["n"] - first["g"] * SPAN)
    leaves, others, ids = np.zeros(size, "V32"), np.zeros(size, "V32"), [None] * size
    for row in table.to_pylist():
        slots = np.frombuffer(row["slots"], "<u2")
        leaves[slots] = np.frombuffer(row["leaves"], "V32")
        others[slots] = np.frombuffer(row["others"], "V32")
        for slot, i in zip(slots.tolist(), row["ids"]):
            ids[slot] = i
    node = reduced(_hex(leaves.tobytes()), levels_above(first["n"]))[-1][0]
    return pa.Table.from_batches([_as_batch([(first["tree"], first["g"], first["n"], node, ids, leaves.tobytes(), others.tobytes())], _GROUP_SCHEMA)])


def _as_pieces(nodes: DataFrame) -> DataFrame:
    """Nodes ``tree, rank, n, node`` as pieces of the next level's slot arrays, one place each."""
    slot = F.col("rank") % SPAN
    low, high = (F.lpad(F.hex(byte), 2, "0") for byte in (slot % 256, F.shiftright(slot, 8)))
    return nodes.select(
        "tree", F.shiftright("rank", SPAN_BITS).alias("g"), "n", F.unhex(F.concat(low, high)).alias("slots"),
        F.array(F.lit(None).cast("long")).alias("ids"), F.unhex("node").alias("leaves"), F.unhex(F.lit(_NONE.hex())).alias("others"),
    )


def _reduce(pieces: DataFrame) -> list[DataFrame]:
    """The stored slot arrays of every level, from the leaves up to one group a tree."""
    out = []
    while True:
        out.append(stored(pieces.groupBy("tree", "g").applyInArrow(_fill_slots, _GROUPS), "slots"))
        most = out[-1].agg(F.max("n")).first()[0]
        if most is None or most <= SPAN:
            return out
        up = F.shiftright(F.col("n") + (SPAN - 1), SPAN_BITS)
        pieces = _as_pieces(out[-1].filter(F.col("n") > SPAN).select("tree", F.col("g").alias("rank"), up.alias("n"), "node"))


def _tops(levels: list[DataFrame]) -> DataFrame:
    """``tree, node``: the root of each tree, where one group is left of it."""
    tops = [t.filter(F.col("n") <= SPAN).select("tree", "node") for t in levels]
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    return out


_PATHS = "tree string, g long, above string, subroot string"


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paths of a group's slots: each is the path above a group of the level below."""
    for batch in batches:
        for row in batch.to_pylist():
            own = paths(_hex(row["leaves"]), levels_above(row["n"]))
            above = ";" + row["above"] if row["above"] else ""
            made = [_pack_path(p) + above for p in own]
            first = row["g"] * SPAN
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["tree"]] * len(made)), pa.array(range(first, first + len(made)), pa.int64()),
                    pa.array([m.removeprefix(";") for m in made]), pa.array([row["subroot"]] * len(made)),
                ],
                names=["tree", "g", "above", "subroot"],
            )


def _above_leaves(levels: list[DataFrame], over: DataFrame | None = None) -> DataFrame:
    """What stands above each of the lowest groups. ``over``: ``tree, above, subroot`` of each tree; without it nothing does."""
    known = None
    for level in reversed(levels):
        tops = level.filter(F.col("n") <= SPAN).select("tree", "g")
        if over is None:
            mine = tops.withColumns({"above": F.lit(""), "subroot": F.lit("")})
        else:
            mine = tops.join(broadcast_if_small(over), "tree").select("tree", "g", "above", "subroot")
        here = mine if known is None else known.unionByName(mine)
        if level is levels[0]:
            return here
        known = stored(level.join(broadcast_if_small(here), ["tree", "g"]).mapInArrow(_below, _PATHS), "paths")


def _prove(root: str):
    names = ["doc_id", "tree", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                leaves, others = _hex(row["leaves"]), _hex(row["others"])
                own = paths(leaves, levels_above(row["n"]))
                above = _unpack_path(row["above"])
                tail = "".join(a + b for a, b in above).encode()
                proofs, folded = [], []
                for leaf, other, path in zip(leaves, others, own):
                    proofs.append(sha256("".join([a + b for a, b in path]).encode() + tail).hexdigest())
                    node = leaf if other == _NONE.hex() else other
                    for a, b in path + above:
                        node = sha256(f"{a}{node}{b}".encode()).hexdigest()
                    folded.append(node)
                n = len(leaves)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], pa.int64()), pa.array([row["tree"]] * n), pa.array(leaves), pa.array([row["subroot"]] * n),
                        pa.array([root] * n), pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded]),
                    ],
                    names=names,
                )

    return run


def lower_some() -> tuple[Column, Column]:
    """The contract's tampering: where 3 divides the ``crc32`` of the id as text, ``A-Z`` of the text become small."""
    where = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0
    small = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return where, small


def prove(docs: DataFrame, tampered: tuple[Column, Column] | None = None) -> DataFrame:
    """Manifest of ``docs`` (columns ``doc_id, source, lang, n_chars, text``) with a proof of every row.

    ``doc_id, lang, leaf, subroot, root, proof_sha256`` come from the rows as they are. ``folded_root``
    is worked out again from the leaf, or from that of the tampered row where ``tampered`` (a condition
    and the changed text) says so, and the siblings; ``verified`` says whether it is ``root``.

    Nulls in any column are leaf values of their own; a null ``lang`` is a tree before all others, a null
    ``doc_id`` comes first in its tree. Rows with one id are told apart by their leaves, equal rows are
    leaves each. Other columns are not read. A text of any length is hashed whole; an empty table gives
    no rows. Every intermediate is written; a group holds a bucket of chunks or 4,096 leaves.
    """
    leaves = stored(leaves_of(docs, tampered or (F.lit(False), F.col("text"))), "leaves")
    buckets = max(1, -(-leaves.count() // BUCKET_ROWS))
    chunks = stored(directory(stored(bitmaps(leaves, buckets), "bitmaps")), "directory")
    repeated = stored(_repeated_ids(chunks), "repeated")
    key = ["tree", "chunk", "place"]
    alone, pieces = leaves, None
    if not repeated.isEmpty():
        small = broadcast_if_small(repeated.select(*key))
        alone = leaves.join(small, key, "left_anti")
        pieces = _pieces_of_repeated(leaves.join(small, key, "left_semi"), repeated)
    found = (
        alone.select(*key, "doc_id", "leaf", "other", _bucket(buckets)).groupBy("bucket")
        .cogroup(chunks.select("*", _bucket(buckets)).groupBy("bucket")).applyInArrow(_rank_query, _PIECES)
    )
    levels = _reduce(found if pieces is None else found.unionByName(pieces))
    tops = ranked(_tops(levels), [F.col("tree")], "rank", "trees")
    n_trees = tops.count()
    roof = _reduce(_as_pieces(tops.select(F.lit("").alias("tree"), "rank", F.lit(n_trees).cast("long").alias("n"), "node")))
    root = _tops(roof).select("node").first()
    by_group = roof[0].join(broadcast_if_small(_above_leaves(roof)), ["tree", "g"]).mapInArrow(_below, _PATHS).select(F.col("g").alias("rank"), "above")
    of_tree = stored(tops.join(by_group, "rank").select("tree", "above", F.col("node").alias("subroot")), "subroots")
    lowest = levels[0].join(broadcast_if_small(_above_leaves(levels, of_tree)), ["tree", "g"])
    schema = "doc_id long, tree string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    proved = lowest.mapInArrow(_prove(root[0] if root else ""), schema)
    lang = F.when(F.col("tree") != "", F.expr("substr(tree, 2)")).alias("lang")
    return proved.select("doc_id", lang, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
