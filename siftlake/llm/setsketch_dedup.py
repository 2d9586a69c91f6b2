"""Near-duplicate groups by banded SetSketch registers, joint likelihood estimates and exact checks.

1. Every document becomes its set of five-word shingles; equal sets become one node.
2. Nodes that agree in a whole band of registers share a bucket. Each bucket pairs its members with its least member
   only. Pairs are estimated from both sketches; each node's best is checked on the full sets, unless far too low.
3. The links found so far are a forest, since each leads to a lesser node, and its trees are components. Within a bucket,
   nodes of one component need no further link. Nodes outside the largest component are compared with all members, in
   blocks: by estimate first, each pair in the first band it shares, then the nodes with a likely partner on their full
   sets. A block reports which of its components are one, and the graph of components alone is joined again.

So a bucket of very many near copies costs a row per member, and a bucket whose members have nothing else in common is
still compared in full: no bucket, partner or candidate is capped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.llm import setsketch
from siftlake.llm.batches import small_batches
from siftlake.llm.columns import put_aside
from siftlake.llm.components import least_reached, roots
from siftlake.llm.tokens import MULTIPLIER, U64, Words, fixed_binary, lists, mix, over_batches, shingle_sets
from siftlake.workspace import Scratch

PERCENT = 75
# An estimate from 160 registers deviates by about 0.034: a pair at the bound falls below it once in millions.
ESTIMATE_SLACK = 0.17
# Members of a bucket that meet in one block: nodes outside its main component, and all nodes.
OTHERS_PER_BLOCK = 512
NODES_PER_BLOCK = 4096
# What a task works on at once.
HELD_BYTES = 1 << 24
PAIRS_AT_ONCE = 1 << 15
MATRIX_CELLS = 1 << 22

_SKETCH_SCHEMA = "n_shingles long, node binary, registers binary"
_SET_SCHEMA = "node binary, codes array<long>"
_PAIR_SCHEMA = "a long, b long, estimate double"


def _node_ids(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits per set that depend on all its elements and not on their order."""
    n = np.diff(bounds)
    out = np.zeros((len(n), 2), U64)
    if len(codes):
        filled = np.flatnonzero(n)
        for k, seed in enumerate((U64(1), U64(2))):
            sums = np.add.reduceat(mix(codes * seed + MULTIPLIER), bounds[filled])
            out[filled, k] = mix(sums + n[filled].astype(U64) * MULTIPLIER)
    return out


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {name: batch[name] for name in batch.schema.names if name not in ("text", *columns)}
    return pa.RecordBatch.from_pydict(kept | columns)


def _masked(values: pa.Array, keep: np.ndarray) -> pa.Array:
    return pa.compute.if_else(pa.array(keep), values, pa.scalar(None, values.type))


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    codes, bounds = shingle_sets(Words(batch["text"]))
    n = np.diff(bounds)
    registers = setsketch.sketch(codes, bounds)
    return _with(
        batch,
        {
            "n_shingles": pa.array(n.astype(np.int64)),
            "node": _masked(fixed_binary(_node_ids(codes, bounds)), n > 0),
            "registers": _masked(fixed_binary(registers), n > 0),
        },
    )


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    codes, bounds = shingle_sets(Words(batch["text"]))
    return pa.RecordBatch.from_pydict(
        {"node": fixed_binary(_node_ids(codes, bounds)), "codes": lists(codes.view(np.int64), bounds)}
    )


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, node, registers`` for every row; ``node`` and ``registers`` are null without words."""
    return docs.select("doc_id", "text").mapInArrow(over_batches(_sketch), f"doc_id long, {_SKETCH_SCHEMA}")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, setsketch.REGISTERS)


def _numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        estimate = setsketch.similarity(
            _registers(batch["registers_a"]), _registers(batch["registers_b"]), _numbers(batch["n_a"]),
            _numbers(batch["n_b"]),
        )
        likely = pa.array(estimate >= PERCENT / 100 - ESTIMATE_SLACK)
        yield pa.RecordBatch.from_pydict(
            {"a": batch["a"], "b": batch["b"], "estimate": pa.array(estimate)}
        ).filter(likely)


def _similar_sizes(a: str, b: str) -> F.Column:
    """Sets whose sizes differ more can't reach the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _shared(nodes: DataFrame) -> DataFrame:
    """``bucket, band, id, n_shingles, least, n_least``: a row per node and band that another node agrees with, and the
    least of the nodes that do."""
    width = setsketch.BAND * 2
    keys = F.array(
        *(F.xxhash64(F.lit(k), F.expr(f"substring(registers, {k * width + 1}, {width})")) for k in range(setsketch.BANDS))
    )
    placed = nodes.select("id", "n_shingles", F.posexplode(keys).alias("band", "bucket"))
    least = (
        placed.groupBy("bucket")
        .agg(F.min(F.struct("id", "n_shingles")).alias("least"), F.count("*").alias("members"))
        .where("members > 1")
        .select("bucket", F.col("least.id").alias("least"), F.col("least.n_shingles").alias("n_least"))
    )
    return placed.join(least, "bucket")


def _estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes (``a, b``) that may reach the similarity by the estimate from their sketches."""
    for side in "ab":
        named = nodes.select(
            F.col("id").alias(side), F.col("registers").alias(f"registers_{side}"),
            F.col("n_shingles").alias(f"n_{side}"),
        )
        pairs = pairs.join(named, side)
    return pairs.mapInArrow(_likely, _PAIR_SCHEMA)


def _sets_of(ids: DataFrame, docs: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, codes``: the full set of each of these nodes, from one of its documents."""
    wanted = scratch.settle(nodes.join(ids, "id").select("id", "node", "doc_id"), "wanted")
    # A repeated id brings other sets too, which the join by node leaves out.
    texts = docs.select("doc_id", "text").join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = texts.select("text").mapInArrow(over_batches(_sets), _SET_SCHEMA)
    return scratch.settle(
        sets.join(wanted.select("node", "id"), "node").select("id", "codes").dropDuplicates(["id"]), "sets"
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that reach the similarity on their full sets: ``a, b``."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("codes").alias(f"codes_{side}")), side)
    shared = F.size(F.array_intersect("codes_a", "codes_b"))
    counted = pairs.select(
        "a", "b", shared.alias("shared"), (F.size("codes_a") + F.size("codes_b") - shared).alias("united")
    )
    return counted.where(F.col("shared") * 100 >= F.col("united") * PERCENT).select("a", "b")


def _by_block(work: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Callable:
    """For ``mapInArrow`` over rows sorted by ``block``: ``work`` on tables of whole blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < HELD_BYTES:
                continue
            table = pa.Table.from_batches(held)
            block = _numbers(table["block"])
            # The last block may go on in the next batch.
            last = len(block) - int(np.cumprod((block == block[-1])[::-1]).sum())
            if last:
                yield from work(table.slice(0, last))
            held = table.slice(last).combine_chunks().to_batches()
            size = sum(part.nbytes for part in held)
        if held:
            yield from work(pa.Table.from_batches(held))

    return run


def _blocks(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each block its number, its others and all its nodes, as row numbers."""
    block, other = _numbers(table["block"]), _numbers(table["other"])
    edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(block) else []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield block[a], np.flatnonzero(other[a:b]) + a, np.flatnonzero(~other[a:b]) + a


def _likely_members(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The rows that have a likely partner in their block, counting each pair in the first band it shares."""
    n, component, band = (_numbers(table[name]) for name in ("n_shingles", "component", "band"))
    registers = _registers(table["registers"])
    keys = setsketch.band_keys(registers)
    found = np.zeros(table.num_rows, bool)

    def mark(left: list[np.ndarray], right: list[np.ndarray]) -> None:
        a, b = np.concatenate(left), np.concatenate(right)
        first = (keys[a] == keys[b]).argmax(axis=1) == band[a]
        a, b = a[first], b[first]
        likely = setsketch.similarity(registers[a], registers[b], n[a], n[b]) >= PERCENT / 100 - ESTIMATE_SLACK
        found[a[likely]] = True
        found[b[likely]] = True

    left, right, waiting = [], [], 0
    for _, others, members in _blocks(table):
        for i in others:
            smaller, larger = np.minimum(n[members], n[i]), np.maximum(n[members], n[i])
            j = members[(component[members] != component[i]) & (100 * smaller >= PERCENT * larger)]
            left.append(np.full(len(j), i))
            right.append(j)
            waiting += len(j)
            if waiting >= PAIRS_AT_ONCE:
                mark(left, right)
                left, right, waiting = [], [], 0
    if waiting:
        mark(left, right)
    kept = table.filter(pa.array(found)).select(["block", "other", "id", "component"])
    yield from kept.combine_chunks().to_batches()


def _shared_counts(sets: list[np.ndarray], others: int) -> np.ndarray:
    """How many elements each of the first ``others`` sets shares with each set."""
    lengths = [len(x) for x in sets]
    owner = np.repeat(np.arange(len(sets)), lengths)
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    left = np.bincount(code[: sum(lengths[:others])], minlength=code.max() + 1)
    right = np.bincount(code, minlength=code.max() + 1)
    useful = (left > 0) & (right > 1)
    place = np.cumsum(useful) - 1
    owner, code = owner[useful[code]], place[code[useful[code]]]
    width = int(useful.sum())
    counts = np.zeros((others, len(sets)), np.float32)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    starts = np.searchsorted(code, np.arange(width + 1))
    if 20 * int((left[useful] * right[useful]).sum()) < others * len(sets) * width:
        # Few elements in common: one by one.
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            rows = owner[a:b]
            counts[np.ix_(rows[rows < others], rows)] += 1
        return counts
    step = max(1, MATRIX_CELLS // len(sets))
    for at in range(0, width, step):
        a, b = starts[at], starts[min(at + step, width)]
        present = np.zeros((len(sets), step), np.float32)
        present[owner[a:b], code[a:b] - at] = 1
        counts += present[:others] @ present.T
    return counts


def _block_links(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Components that links checked on the full sets join, of each block: every one with the least it is joined to."""
    component = _numbers(table["component"])
    codes = table["codes"].combine_chunks()
    bounds, values = np.asarray(codes.offsets), np.asarray(codes.values)
    found_a, found_b = [], []
    for _, others, members in _blocks(table):
        if not len(others) or not len(members):
            continue
        rows = np.concatenate([others, members])
        size = bounds[rows + 1] - bounds[rows]
        shared = _shared_counts([values[bounds[r] : bounds[r + 1]] for r in rows], len(others))[:, len(others) :]
        united = size[: len(others), None] + size[None, len(others) :] - shared
        a, b = np.nonzero((shared * 100 >= united * PERCENT) & (component[others][:, None] != component[members][None, :]))
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i, j in zip(component[others[a]].tolist(), component[members[b]].tolist(), strict=True):
            one, two = root(i), root(j)
            if one != two:
                parent[max(one, two)] = min(one, two)
        joined = [x for x in parent if root(x) != x]
        found_a += joined
        found_b += map(root, joined)
    yield pa.RecordBatch.from_pydict({"a": np.array(found_a, np.int64), "b": np.array(found_b, np.int64)})


def _between_components(
    shared: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame, scratch: Scratch
) -> DataFrame:
    """Components that checked links between nodes in one bucket join: ``a, b``, enough to join what all such links do."""
    placed = shared.join(labels.withColumnRenamed("node", "id"), "id", "left").select(
        "bucket", "band", "id", "n_shingles", F.coalesce("component", "id").alias("component")
    )
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket")
    sizes = sizes.agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("members"), F.count("*").alias("components")
    )
    sizes = sizes.where("components > 1").select(
        "bucket", F.col("main.component").alias("main"),
        F.ceil((F.col("members") - F.col("main.n")) / OTHERS_PER_BLOCK).cast("int").alias("other_blocks"),
        F.ceil(F.col("members") / NODES_PER_BLOCK).cast("int").alias("node_blocks"),
    )
    members = scratch.settle(placed.join(sizes, "bucket"), "mixed")
    spread = F.xxhash64("id")

    def dealt(rows: DataFrame, i: F.Column, j: F.Column, other: bool) -> DataFrame:
        return rows.select("id", "component", "bucket", "band", i.alias("i"), j.alias("j"), F.lit(other).alias("other"))

    others = dealt(
        members.where("component <> main"),
        F.pmod(spread, "other_blocks").cast("int"),
        F.explode(F.sequence(F.lit(0), F.col("node_blocks") - 1)),
        True,
    )
    all_members = dealt(
        members,
        F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)),
        F.pmod(spread, "node_blocks").cast("int"),
        False,
    )
    rows = others.unionByName(all_members).withColumn("block", F.xxhash64("bucket", "i", "j"))
    rows = rows.join(nodes.select("id", "n_shingles", "registers"), "id").repartition("block")
    likely = rows.sortWithinPartitions("block").mapInArrow(
        _by_block(_likely_members), "block long, other boolean, id long, component long"
    )
    likely = scratch.settle(likely, "likely")
    sets = _sets_of(likely.select("id").distinct(), docs, nodes, scratch)
    rows = likely.join(sets, "id").repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(_by_block(_block_links), "a long, b long")


def _labelled(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The rows, and their distinct sets (nodes) with the component of each."""
    sketched = scratch.settle(sketches(docs), "sketches")
    members = sketched.select("doc_id", "n_shingles", "node")
    nodes = (
        sketched.where("node IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
            F.first("registers").alias("registers"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    nodes = scratch.settle(nodes, "nodes")
    shared = scratch.settle(_shared(nodes), "shared")
    stars = shared.where((F.col("id") != F.col("least")) & _similar_sizes("n_shingles", "n_least"))
    stars = stars.select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    best = _estimated(stars, nodes).groupBy("b").agg(F.max(F.struct("estimate", "a")).alias("best"))
    best = scratch.settle(best.select(F.col("best.a").alias("a"), "b"), "best")
    ends = best.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    links = scratch.settle(_confirmed(best, _sets_of(ends, docs, nodes, scratch)), "links")
    labels = roots(links, scratch)
    joined = least_reached(_between_components(shared, nodes, labels, docs, scratch), scratch)
    nodes = nodes.select("id", "node", "doc_id").join(labels.withColumnRenamed("node", "id"), "id", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "id"))
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("least"))
    nodes = nodes.join(joined, "component", "left").withColumn("component", F.coalesce("least", "component"))
    return members, nodes.select("node", "doc_id", "component")


def _found(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, node, component, component_id, kept`` for every row."""
    with small_batches(docs.sparkSession):  # texts and sets are long
        members, named = _labelled(docs, Scratch(docs.sparkSession, "setsketch"))
    ids = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(ids, "component").select("node", "component", "component_id")
    rows = members.join(named, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == own, F.lit(True))
    return rows.select("doc_id", "n_shingles", "node", "component", own.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``, other columns are left out).

    A text without words, an empty or a null text has an empty set, is linked with nothing and is kept. Rows with equal
    sets are copies, linked without a check. Rows that repeat an id are linked by their sets like any others. A row
    without an id has no component and is kept. An empty table gives no rows.
    """
    return _found(docs).select("doc_id", "n_shingles", "component_id", "kept")


def _nodes_of(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = pa.array(np.zeros(batch.num_rows, np.int64))
    sketched = _sketch(pa.RecordBatch.from_arrays([ids, batch["text"]], ["doc_id", "text"]))
    return pa.RecordBatch.from_arrays([batch["digest"], sketched["node"]], ["digest", "node"])


def _one_of_each_set(docs: DataFrame, found: DataFrame, clashing: DataFrame) -> DataFrame:
    """Of the rows whose id another row has, too: those without words, and one row of each component whose least row by id
    and set it is."""
    aside, back = put_aside(docs, {"doc_id", "text"})
    rows = aside.join(clashing, "doc_id", "left_semi").withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = rows.select("digest", "text").dropDuplicates(["digest"])
    kind = dict(found.dtypes)["node"]
    rows = rows.join(texts.mapInArrow(over_batches(_nodes_of), f"digest string, node {kind}"), "digest")
    least = found.where("component IS NOT NULL AND doc_id IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("least"))
    chosen = rows.join(least.select("least.*"), ["doc_id", "node"], "left_semi")
    first = chosen.groupBy("doc_id", "node").agg(F.min("digest").alias("digest"))
    chosen = chosen.join(first, ["doc_id", "node", "digest"], "left_semi").dropDuplicates(["doc_id", "node"])
    return rows.where("node IS NULL").unionByName(chosen).select(*(back[c] for c in docs.columns))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest id.

    All columns stay. Rows without an id and texts without words stay. Of rows that share an id, those of unlike texts are
    groups of their own and stay; of those in one group the least by its set and then by its text's digest stays, and any one
    of several rows with that id and text.
    """
    found = _found(docs)
    per_id = found.where("doc_id IS NOT NULL").groupBy("doc_id")
    per_id = per_id.agg(F.count(F.lit(1)).alias("rows"), F.bool_or("kept").alias("kept")).where("kept")
    kept = docs.join(per_id.where("rows = 1").select("doc_id"), "doc_id", "left_semi")
    kept = kept.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)
    clashing = per_id.where("rows > 1").select("doc_id")
    return kept if clashing.isEmpty() else kept.unionByName(_one_of_each_set(docs, found, clashing))
