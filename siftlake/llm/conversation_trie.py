"""The prefix trie of conversations by adaptive radix trees over fixed-width turn ids.

A turn's id is the first 16 bytes of a SHA-256 over its role and text; a conversation's key is its ids one after the other.
Different keys are put in order and dealt out to ranges, and each range builds a radix tree. Bytes within an id may split a
path, but only whole turns are nodes of the trie.

Ranges share nodes only along the path to their first and to their last key. What each range knows of these two paths is
merged in the same way, by ranges of such paths until they are few, and given back to the ranges, which then know all of
their nodes. So a first turn that a third of all conversations share is added up from one number per range.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.llm.radix_tree import Tree
from siftlake.workspace import Scratch

# Bytes of a turn's id.
WIDTH = 16
# Conversations are rebuilt in groups of so many ids, from up to so many turns of the first of them.
GROUP = 5
MOST_SHARED = 8
# Turns of one range, and paths merged in one task. Each is about as much as a task holds at a time.
RANGE_TURNS = 25_000
FEW_PATHS = 2_000
# Ids of conversations that are joined to one text before they move on.
CHUNK_IDS = 50_000
# A batch is sent on when it has so many bytes of keys, about.
BATCH_BYTES = 4 << 20

_NO_ENDS = hashlib.sha256(b"").hexdigest()
_NONE = np.iinfo(np.int64).max
_REBUILT = "conv_id long, key binary, sizes binary"
_PATHS = "bin long, place int, key binary, sizes binary, parts binary"
_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)
# What a range knows of a node on a path; after merging, what is known of it at all.
_PARTS = ("members", "least", "children", "leaves", "saved", "owner")


# --- conversations -------------------------------------------------------------------------------------------------


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"),
        "turn",
        F.substring(F.unhex(F.sha2(named, 256)), 1, WIDTH).alias("id"),
        F.octet_length(text).cast("long").alias("size"),
    )


def taken_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the first of its group."""
    return zlib.crc32(str(conv_id).encode()) % (MOST_SHARED + 1)


def _bytes(column: pa.Array) -> np.ndarray:
    """Binary values of equal width as one array of bytes."""
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of conversations, from turns in the order of their group, the group's first conversation first."""
    done: list[tuple[int, bytes, bytes]] = []
    current, base, shared, ids, sizes, held = None, None, (None, b"", b""), [], [], 0

    def ended() -> int:
        nonlocal shared
        key, lengths = b"".join(ids), b"".join(sizes)
        if current == base:
            shared = (base, key[: MOST_SHARED * WIDTH], lengths[: MOST_SHARED * 8])
        first, head, head_sizes = shared
        n = taken_turns(current)
        if first != base:
            head = head_sizes = b""
        done.append((current, head[: n * WIDTH] + key[n * WIDTH :], head_sizes[: n * 8] + lengths[n * 8 :]))
        return len(key) + 100

    def sent() -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else ((), (), ())
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "key", "sizes"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        conv, bases = batch["conv_id"].to_numpy(), batch["base"].to_numpy()
        data, lengths = _bytes(batch["id"]), batch["size"].to_numpy()
        cuts = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if current != conv[a]:
                if current is not None:
                    held += ended()
                current, base, ids, sizes = int(conv[a]), int(bases[a]), [], []
                if held > BATCH_BYTES:
                    yield sent()
                    done, held = [], 0
            ids.append(data[a * WIDTH : b * WIDTH].tobytes())
            sizes.append(lengths[a:b].tobytes())
    if current is not None:
        ended()
    yield sent()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, sizes``: the turn ids of every rebuilt conversation, and the UTF-8 bytes of its turns' texts as
    64-bit numbers. Only ids and sizes of turns move, never texts."""
    turns = _turns(conversations).repartition("base")
    other = F.col("conv_id") != F.col("base")
    turns = turns.sortWithinPartitions("base", other, "conv_id", F.col("turn").asc_nulls_first(), "id")
    return turns.drop("turn").mapInArrow(_rebuilt, _REBUILT)


# --- who ends where ------------------------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order become texts of many ids."""

    def sent(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            ["digest", "least", "members", "ids"],
        )

    for batch in batches:
        digests, ids, rows = batch["digest"].to_pylist(), batch["conv_id"].to_pylist(), []
        at = 0
        for digest, run in groupby(digests):
            n = sum(1 for _ in run)
            for a in range(at, at + n, CHUNK_IDS):
                b = min(a + CHUNK_IDS, at + n)
                rows.append((digest, ids[a], b - a, ",".join(map(str, ids[a:b]))))
            at += n
        if rows:
            yield sent(rows)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest from its chunks in order: a hash that goes on from chunk to chunk."""
    current, state, least, members, rows = None, None, 0, 0, []

    def sent():
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*rows, strict=True) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["digest", "least", "members", "ends"]
        )

    for batch in batches:
        for digest, first, n, ids in zip(*(batch[c].to_pylist() for c in ("digest", "least", "members", "ids")), strict=True):
            if digest != current:
                if current is not None:
                    rows.append((current, least, members, state.hexdigest()))
                current, state, least, members = digest, hashlib.sha256(ids.encode()), first, n
            else:
                state.update(b",")
                state.update(ids.encode())
                members += n
        if len(rows) > 10_000:
            yield sent()
            rows = []
    if current is not None:
        rows.append((current, least, members, state.hexdigest()))
    yield sent()


def _distinct(convs: DataFrame) -> DataFrame:
    """``key, sizes, least, members, ends`` of each different conversation.

    A hash over all ids that share a conversation can only be worked out one after the other; the ids come to it as texts of
    many ids each, sorted by many tasks.
    """
    slim = convs.select("digest", "conv_id").repartitionByRange("digest", "conv_id")
    slim = slim.sortWithinPartitions("digest", "conv_id")
    chunks = slim.mapInArrow(_chunks, "digest string, least long, members long, ids string")
    chunks = chunks.repartition("digest").sortWithinPartitions("digest", "least")
    ends = chunks.mapInArrow(_ends, "digest string, least long, members long, ends string")
    keys = convs.groupBy("digest").agg(F.first("key").alias("key"), F.first("sizes").alias("sizes"))
    return keys.join(ends, "digest").drop("digest")


# --- one range -----------------------------------------------------------------------------------------------------


class _Range:
    """The trie of some keys in ascending order. Nodes are numbered in the order of a walk from the root, so that those
    below a node follow it directly: ``stop`` is where they end."""

    def __init__(self, keys: list[bytes], sizes: list[np.ndarray]):
        self.keys = keys
        tree = Tree()
        for i, key in enumerate(keys):
            tree.insert(key, i)
        self.ends = np.zeros(len(keys), np.int64)
        runs: list[list[int]] = []  # first number, depth of the first, how many, number above the first, a key, stop
        count, stack = 0, [(tree.root, -1, 0, -1, None)]
        while stack:
            node, above, reached, parent, run = stack.pop()
            if node is None:
                run[5] = count
                continue
            reached += len(node.path) + (above >= 0)
            first = above // WIDTH + 1 if above >= 0 else 0
            n = reached // WIDTH + 1 - first
            run = [count, first, n, parent, -1, 0]
            runs.append(run)
            count += n
            if n:
                parent = count - 1
            stack.append((None, 0, 0, 0, run))
            if node.value is not None:
                self.ends[node.value] = parent
                run[4] = node.value
            if node.below is not None:
                for _, kid in reversed(list(node.below.items())):
                    stack.append((kid, reached, reached, parent, None))
        # A key that passes each run: the first one in the order that ends at or after it.
        for i in range(len(runs) - 1, -1, -1):
            if runs[i][4] < 0:
                runs[i][4] = runs[i + 1][4]
        table = np.array(runs, np.int64).reshape(-1, 6)
        n = table[:, 2]
        self.count = count
        within = np.arange(count) - np.repeat(table[:, 0], n)
        self.depth = np.repeat(table[:, 1], n) + within
        self.parent = np.where(within > 0, np.arange(count) - 1, np.repeat(table[:, 3], n))
        self.stop = np.repeat(table[:, 5], n)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sizes])])
        every = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        at = offsets[np.repeat(table[:, 4], n)] + self.depth - 1
        self.size = np.zeros(count, np.int64)
        deep = self.depth > 0
        self.size[deep] = every[at[deep]]
        self.children = np.bincount(self.parent[1:], minlength=count).astype(np.int64)

    def below(self, values: np.ndarray) -> np.ndarray:
        """The sum of the values over each node and all below it."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.stop] - sums[: self.count]

    def path(self, i: int) -> np.ndarray:
        """The numbers of the nodes from the root to the end of a key."""
        at = int(self.ends[i])
        numbers = np.empty(len(self.keys[i]) // WIDTH + 1, np.int64)
        for depth in range(len(numbers) - 1, -1, -1):
            numbers[depth] = at
            at = self.parent[at]
        return numbers

    def least(self, values: np.ndarray) -> np.ndarray:
        """The smallest value over each node and all below it."""
        found, parents = values.tolist(), self.parent.tolist()
        for number in range(self.count - 1, 0, -1):
            above = parents[number]
            if found[number] < found[above]:
                found[above] = found[number]
        return np.array(found, np.int64)


class _Known:
    """What is known of the nodes of a range from its keys alone."""

    def __init__(self, tree: _Range, members: np.ndarray, least: np.ndarray, number: int):
        at_end, smallest = np.zeros(tree.count, np.int64), np.full(tree.count, _NONE)
        at_end[tree.ends], smallest[tree.ends] = members, least
        self.members, self.least = tree.below(at_end), tree.least(smallest)
        self.children, self.leaves = tree.children.copy(), np.zeros(tree.count, np.int64)
        self.saved, self.owner = np.zeros(tree.count, np.int64), np.full(tree.count, number)


class _Merged:
    """What is known of the nodes of a range of paths: the parts of all paths through them."""

    def __init__(self, tree: _Range, parts: list[np.ndarray]):
        self.members, self.children, self.leaves, self.saved = (np.zeros(tree.count, np.int64) for _ in range(4))
        self.least, self.owner = (np.full(tree.count, _NONE) for _ in range(2))
        for i, part in enumerate(parts):
            at = tree.path(i)
            for name, values in zip(_PARTS, part, strict=True):
                known = getattr(self, name)
                known[at] = np.minimum(known[at], values) if name in ("least", "owner") else known[at] + values
        self.children += tree.children


def _totals(tree: _Range, known, ours: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Leaves and saved bytes over each node and all below it, of nodes that are ``ours`` and of what came with them."""
    leaves = known.leaves + np.where(ours & (known.children == 0), 1, 0)
    saved = known.saved + np.where(ours, (known.members - 1) * tree.size, 0)
    return tree.below(leaves), tree.below(saved)


def _outer(tree: _Range) -> tuple[list[np.ndarray], np.ndarray]:
    """The paths to the first and to the last key, each node on one of them only, and which nodes lie on neither."""
    ours = np.ones(tree.count, bool)
    paths = []
    for i in sorted({0, len(tree.keys) - 1}):
        path = tree.path(i)
        paths.append((i, path, ours[path]))
        ours[path] = False
    return paths, ours


def _paths(number: int, tree: _Range, known, sizes: list[np.ndarray]) -> pa.Table:
    """What a range knows of its two outer paths."""
    paths, ours = _outer(tree)
    leaves, saved = _totals(tree, known, ours)
    outer = np.flatnonzero(~ours)
    kids = np.bincount(tree.parent[outer[outer > 0]], minlength=tree.count)
    # A node's own share is without the nodes below it that lie on the same paths: those have theirs.
    own_leaves, own_saved = leaves.copy(), saved.copy()
    inner = outer[outer > 0]
    np.subtract.at(own_leaves, tree.parent[inner], leaves[inner])
    np.subtract.at(own_saved, tree.parent[inner], saved[inner])
    rows = []
    for place, (i, path, fresh) in enumerate(paths):
        values = [
            known.members[path], known.least[path], (known.children - kids)[path], own_leaves[path], own_saved[path],
            known.owner[path],
        ]
        nothing = (0, _NONE, 0, 0, 0, _NONE)
        parts = np.stack([np.where(fresh, v, n) for v, n in zip(values, nothing, strict=True)])
        rows.append((number, place, tree.keys[i], sizes[i].tobytes(), parts.tobytes()))
    return _path_table(rows)


def _path_table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else ((),) * 5
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bin", "place", "key", "sizes", "parts"]
    )


def _numbers(values: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(v, np.int64) for v in values]


def _range(table: pa.Table) -> tuple[pa.Table, _Range, list[np.ndarray]]:
    table = table.sort_by("key")
    sizes = _numbers(table["sizes"].to_pylist())
    return table, _Range(table["key"].to_pylist(), sizes), sizes


def _parts(values: list[bytes]) -> list[np.ndarray]:
    return [v.reshape(len(_PARTS), -1) for v in _numbers(values)]


def _whole(tree: _Range, known, spine: pa.Table | None) -> None:
    """Give a range what has been merged of its outer paths, so that all it knows is final."""
    ours = np.ones(tree.count, bool)
    outer = []
    if spine is not None and spine.num_rows:
        for i, parts in zip(sorted({0, len(tree.keys) - 1}), _parts(spine.sort_by("place")["parts"].to_pylist()), strict=True):
            outer.append((tree.path(i), parts))
            ours[outer[-1][0]] = False
    leaves, saved = _totals(tree, known, ours)
    known.leaves, known.saved = leaves, saved
    for path, parts in outer:
        for name, values in zip(_PARTS, parts, strict=True):
            getattr(known, name)[path] = values


def _known(key: tuple, table: pa.Table, tree: _Range):
    if "parts" in table.column_names:
        return _Merged(tree, _parts(table["parts"].to_pylist()))
    return _Known(tree, table["members"].to_numpy(), table["least"].to_numpy(), key[0].as_py())


def _outer_paths(key: tuple, table: pa.Table) -> pa.Table:
    table, tree, sizes = _range(table)
    return _paths(key[0].as_py(), tree, _known(key, table, tree), sizes)


def _final_paths(key: tuple, table: pa.Table, spine: pa.Table | None = None) -> pa.Table:
    """The paths of a range with what is known of their nodes at all."""
    table, tree, _ = _range(table)
    known = _known(key, table, tree)
    _whole(tree, known, spine)
    rows = []
    below = zip(*(table[c].to_pylist() for c in ("from", "place", "key", "sizes")), strict=True)
    for i, (number, place, own, sizes) in enumerate(below):
        path = tree.path(i)
        rows.append((number, place, own, sizes, np.stack([getattr(known, name)[path] for name in _PARTS]).tobytes()))
    return _path_table(rows)


def _nodes(key: tuple, table: pa.Table, spine: pa.Table) -> pa.Table:
    """The nodes of a range: those that no range before it has."""
    table, tree, _ = _range(table)
    number, known = key[0].as_py(), _known(key, table, tree)
    _whole(tree, known, spine)
    ends = np.full(tree.count, _NO_ENDS, object)
    ends[tree.ends] = table["ends"].to_pylist()
    above = known.least[np.maximum(tree.parent, 0)]
    columns = [known.least, tree.depth, above, known.members, known.children, known.leaves, known.saved, ends]
    names = [field.split()[0] for field in _NODES.split(", ")]
    mine = known.owner == number
    arrays = [pa.array(c[mine], pa.string() if name == "ends_sha256" else pa.int64()) for c, name in zip(columns, names, strict=True)]
    arrays[2] = pa.array(above[mine], pa.int64(), mask=tree.depth[mine] == 0)
    return pa.table(arrays, names)


# --- all ranges ----------------------------------------------------------------------------------------------------


def _ranged(rows: DataFrame, ranges: int, scratch: Scratch, name: str) -> DataFrame:
    binned = rows.repartitionByRange(ranges, "key").withColumn("bin", F.spark_partition_id().cast("long"))
    return scratch.settle(binned, name)


def _merged_paths(paths: DataFrame, scratch: Scratch, few: int) -> DataFrame:
    """``paths`` with what all ranges together know."""
    paths = paths.withColumnRenamed("bin", "from")
    count = paths.count()
    if count <= few:
        return paths.groupBy(F.lit(0).cast("long").alias("bin")).applyInArrow(_final_paths_alone, _PATHS)
    binned = _ranged(paths, -(-2 * count // few), scratch, "paths")
    outer = scratch.settle(binned.drop("from").groupBy("bin").applyInArrow(_outer_paths, _PATHS), "outer-paths")
    merged = _merged_paths(outer, scratch, few)
    return binned.groupBy("bin").cogroup(merged.groupBy("bin")).applyInArrow(_final_paths, _PATHS)


def _final_paths_alone(key: tuple, table: pa.Table) -> pa.Table:
    return _final_paths(key, table)


def conversation_nodes(conversations: DataFrame, range_turns: int = RANGE_TURNS, few_paths: int = FEW_PATHS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns are in the order of ``turn``, nulls first, and of their ids where it is equal; repeated rows are turns of their own.
    A null role or text is empty; rows without ``conv_id`` belong to no conversation and are left out; columns other than
    the four are not looked at. An empty table has no nodes, not even a root. A task holds the ids of one conversation, 16
    bytes a turn, and about ``range_turns`` turns of a range.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    convs = rebuilt(conversations).withColumn("digest", F.sha2("key", 256))
    keys = scratch.settle(_distinct(scratch.settle(convs, "conversations")), "keys")
    turns = keys.agg(F.sum(F.length("key") / WIDTH + 1)).first()[0] or 0
    binned = _ranged(keys, max(1, -(-int(turns) // range_turns)), scratch, "ranges")
    paths = scratch.settle(binned.drop("ends").groupBy("bin").applyInArrow(_outer_paths, _PATHS), "outer")
    merged = scratch.settle(_merged_paths(paths, scratch, few_paths), "merged")
    return binned.groupBy("bin").cogroup(merged.groupBy("bin")).applyInArrow(_nodes, _NODES)


# The remainder of a CRC-32 bit by bit: a byte is put in, then eight steps (-1) shift it out.
_CRC_POLYNOMIAL = 0xEDB88320
ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           WHERE conv_id IS NOT NULL),
d AS (SELECT conv_id, turn, octet_length(encode(text)) AS size,
             sha256(length(role) || ':' || role || text) AS id FROM t),
o AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(size ORDER BY turn NULLS FIRST, id) AS sizes
      FROM d GROUP BY conv_id),
h AS (SELECT *, conv_id - conv_id % {GROUP} AS base, xor(list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
          lambda x : [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x : CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, {_CRC_POLYNOMIAL}) ELSE a >> 1 END),
        4294967295) % {MOST_SHARED + 1} AS n FROM o),
c AS (SELECT h.conv_id, list_concat(coalesce(b.ids, [])[1:h.n], h.ids[h.n + 1:]) AS ids,
             list_concat(coalesce(b.sizes, [])[1:h.n], h.sizes[h.n + 1:]) AS sizes
      FROM h LEFT JOIN o b ON b.conv_id = h.base),
p AS (SELECT conv_id, unnest(range(0, len(ids) + 1)) AS depth, ids, sizes FROM c),
m AS (SELECT conv_id, depth, array_to_string(ids[1:depth], '') AS node, len(ids) = depth AS ends,
             CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size,
             CASE WHEN depth > 0 THEN array_to_string(ids[1:depth - 1], '') END AS above FROM p),
v AS (SELECT node, any_value(above) AS above, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id,
             count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), ''))
             AS ends_sha256 FROM m GROUP BY node),
k AS (SELECT above AS node, count(*) AS n_children FROM v WHERE above IS NOT NULL GROUP BY above),
w AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN k USING (node)),
s AS (SELECT a.node, sum(CAST(w.n_children = 0 AS BIGINT))::BIGINT AS n_leaves,
             sum((w.n_convs - 1) * w.size)::BIGINT AS saved_tokens
      FROM w JOIN m a ON a.conv_id = w.conv_id AND a.depth <= w.depth GROUP BY a.node)
SELECT w.conv_id, w.depth::BIGINT AS depth, x.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens,
       w.ends_sha256 FROM w JOIN s USING (node) LEFT JOIN w x ON x.node = w.above
"""
