"""The registered queries and the pipeline over the smallest tables."""

import collections
import hashlib
import itertools
import math
import re
import struct
from pathlib import Path

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
import corpus_pipeline
from oracle import connect, differences
from siftlake.llm import queries

SF_DIR = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


def test_all_are_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 11)) and "pipeline" in entry.queries()


@needs_tables
@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_against_sql(spark, name):
    assert differences(entry.queries()[name](spark, SF_DIR), connect(SF_DIR), entry.oracle_sql()[name]) == []


@needs_tables
def test_stages_keep_the_columns_and_act(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        found = collections.Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert set(found) <= ids and (name == "sharding" or docs.columns == columns)
        assert max(found.values()) <= (2 if name in ("mixing", "sharding") else 1)
        ids = set(found)
    last = corpus_pipeline.run(spark, SF_DIR)
    assert last.columns == docs.columns
    assert sorted(map(tuple, last.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


@needs_tables
def test_no_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.collect() == []


VOCABULARY = [f"w{i}" for i in range(600)]


def corpus():
    """Documents with copies, near copies, passages of items and toxic words; items; labels; and which are toxic."""
    random = np.random.default_rng(11)

    def prose(low, high):
        return [str(w) for w in random.choice(VOCABULARY, size=int(random.integers(low, high)))]

    items = [prose(20, 60) for _ in range(6)]
    texts, toxic = [None, "", " \n"], [0, 0, 0]
    for i in range(500):
        words, label = prose(20, 120), 0
        if i % 5 == 0:
            label = 1
            for _ in range(5):
                words.insert(int(random.integers(len(words))), str(random.choice(["nasty", "vile", "foul"])))
        elif i % 5 == 1:
            leak = list(items[i % 6])
            for _ in range(i // 5 % 4):
                leak[int(random.integers(len(leak)))] = "x"
            words[10:10] = leak
        elif i % 5 == 2:
            for _ in range(i % 7):
                copy = list(words)
                for _ in range(i // 7 % 3):
                    copy[int(random.integers(len(copy)))] = "y"
                texts.append(" ".join(copy).upper() if i % 2 else " ".join(copy))
                toxic.append(0)
        texts.append(" ".join(words))
        toxic.append(label)
    ids = [int(i) for i in random.permutation(3 * len(texts))[: len(texts)]]
    sources = [[None, "a", "b", "a", "a"][int(k)] for k in random.integers(0, 5, size=len(texts))]
    return list(zip(ids, texts, sources, toxic)), [" ".join(item) for item in items]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] * bool(words)


def least_of_groups(rows):
    """The smallest id of each group of rows linked at 75 percent, by comparing all pairs."""
    sets = {i: set(shingles(text)) for i, text, *_ in rows}
    group = {i: {i} for i in sets}
    for i, j in itertools.combinations(sets, 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= 75 * len(sets[i] | sets[j]) and group[i] is not group[j]:
            group[i] |= group[j]
            for k in group[j]:
                group[k] = group[i]
    return {min(g) for g in group.values()}


def holds_item(text, item):
    own, wanted = shingles(text), shingles(item)
    length = min(len(own), len(wanted))
    for a in range(len(own) - length + 1 if length else 0):
        shared = sum((collections.Counter(own[a : a + length]) & collections.Counter(wanted)).values())
        if 100 * shared >= 75 * (length + len(wanted) - shared):
            return True
    return False


def copies_taken(rows):
    """How often the queue of all copies, put in order as a whole, gives each row until its budget is used up."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text, *_ in rows}
    draw = {i: hashlib.md5(f"mix:{i}".encode()).hexdigest()[:16] for i in size}
    queue = []
    sources = sorted({source for _, _, source in rows}, key=lambda s: (s is None, s))
    for place, source in enumerate(sources, 1):
        weight = (3, 1, 2)[(place - 1) % 3]
        own = sorted((draw[i], i) for i, _, s in rows if s == source)
        whole, so_far = sum(size[i] for _, i in own), 0
        for order, i in own:
            so_far += size[i]
            queue += [((copy * whole + so_far) / weight, place, copy, order, i) for copy in (0, 1)]
    taken, used = collections.Counter(), 0
    for *_, i in sorted(queue):
        used += size[i]
        if used > 1.5 * sum(size.values()):
            break
        taken[i] += 1
    return taken


def shard_of(doc_id, shards):
    """The winners of the draws of regions, racks and shards, one level after the other."""

    def winner(paths):
        def draw(path):
            seed = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
            u = ((xxhash.xxh64_intdigest(path.encode(), seed=seed) >> 11) + 0.5) * 2.0**-53
            return -math.log(u) / paths[path]

        return min(paths, key=draw)

    leaves = {}
    for k in range(shards):
        alone = k >= 40
        leaves[f"root/alone-{k}/rack-0/{k}" if alone else f"root/region-{k // 20}/rack-{k % 20 // 5}/{k}"] = k
    at = "root"
    while at not in leaves:
        below = collections.Counter()
        for path in leaves:
            if path.startswith(f"{at}/"):
                below["/".join(path.split("/")[: at.count("/") + 2])] += 1
        at = winner(below)
    return leaves[at]


def test_pipeline_against_brute_force(spark, tmp_path):
    rows, items = corpus()
    docs = [(i, text, "en", source, len(text or "")) for i, text, source, _ in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, toxic) for i, _, _, toxic in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, text, source) for i, text, source, toxic in rows if not toxic]
    least = least_of_groups(left)
    once = [row for row in left if row[0] in least]
    clean = [row for row in once if not any(holds_item(row[1], item) for item in items)]
    assert len(rows) > len(left) > len(once) > len(clean) > 100
    taken = copies_taken(clean)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter(r.doc_id for r in found) == +taken
    given = {i: (text, source) for i, text, source in clean}
    assert all((r.text, r.source) == given[r.doc_id] for r in found)
    expected = {i: (shard_of(i, 40), shard_of(i, 41)) for i in taken}
    assert all((r.shard, r.grown_shard) == expected[r.doc_id] for r in found)
    slots = collections.defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
