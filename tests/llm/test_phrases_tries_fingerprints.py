"""Phrase mining, the conversation trie and threshold-scaled sketches against plain Python."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from siftlake.llm import conversation_trie, phrase_index, threshold_sketch
from siftlake.llm.radix_tree import Direct, Indexed, Sorted, Tree

DOCS = "doc_id long, text string, lang string"
TURNS = "conv_id long, turn long, role string, text string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- phrases -------------------------------------------------------------------------------------------------------


def pieces(text):
    return [re.findall("[^ \t]+", piece) for piece in re.split("[.,;:!?\n-\r]", lowered(text))]


def plain_collocations(rows, least, top):
    counts = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        for piece in pieces(text):
            for n in (1, 2, 3):
                for i in range(len(piece) - n + 1):
                    counts[lang if lang is not None else "und"][tuple(piece[i : i + n])] += 1
    found = []
    for lang, f in counts.items():
        total = sum(n for phrase, n in f.items() if len(phrase) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            around = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(2))]
            if any(100 * b >= 50 * a for b in around):
                continue
            score, _, left, right = min(
                (1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
            )
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], start=1):
            found.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(found)


def phrase_docs(seed=5, n=120):
    random = np.random.default_rng(seed)
    words = ["a", "b", "C", "Dé", "e.", "f,", "g\t", "h\n", "i!x", "😀", "of", "the", "\x1c"]
    rows = []
    for i in range(n):
        text = " ".join(random.choice(words, size=int(random.integers(0, 60)), p=np.arange(13, 0, -1) / 91))
        rows.append((i % 100, text, ["en", "fr", None, "und"][int(random.integers(4))]))
    return rows + [(None, None, "en"), (1, "", None), (2, " \t.,\n", "xx"), (3, "lone", "yy")] + rows[:3]


def test_collocations_against_counting(spark):
    rows = phrase_docs()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    expected = plain_collocations(rows, 4, 10)
    found = sorted(tuple(r) for r in phrase_index.collocations(docs, least=4, top=10).collect())
    assert found == expected and len(found) > 20
    clashing = docs.withColumns({name: F.lit("own") for name in ("words", "phrase", "n", "k", "l", "r", "rank", "w")})
    assert sorted(tuple(r) for r in phrase_index.collocations(clashing, least=4, top=10).collect()) == expected
    assert phrase_index.collocations(docs.limit(0)).collect() == []


@pytest.mark.parametrize("shard_bytes, least", [(400, 1), (400, 4), (10**7, 4)])
def test_counts_of_many_shards(monkeypatch, shard_bytes, least):
    """Triples come from the bit map's pairs alone, and none that is frequent is missed."""
    monkeypatch.setattr(phrase_index, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(phrase_index, "FILTER_BITS", 17)
    rows = [(text, lang or "und") for _, text, lang in phrase_docs()]
    batches = [pa.RecordBatch.from_pylist([{"text": t, "lang": g} for t, g in rows[i::30]]) for i in range(30)]
    expected = collections.Counter()
    for text, lang in rows:
        for piece in pieces(text):
            expected[lang, 0, ""] += len(piece)
            expected.update((lang, n, " ".join(piece[i : i + n])) for n in (1, 2, 3) for i in range(len(piece) - n + 1))

    def added(parts):
        found, shards = collections.Counter(), 0
        for batch in parts:
            shards += batch["words"][0].as_py() == 0
            for row in batch.to_pylist():
                found[row["lang"], row["words"], row["phrase"]] += row["n"]
        return found, shards

    found, shards = added(phrase_index._singles_and_pairs(iter(batches)))
    assert found == {k: n for k, n in expected.items() if k[1] < 3 and n}
    assert shards > 20 if shard_bytes == 400 else shards <= 5
    frequent = [{"lang": g, "phrase": p} for (g, w, p), n in found.items() if w == 2 and n >= least]
    bits = np.zeros(1 << 17 >> 3, np.uint8).reshape(-1, 1 << phrase_index.SLICE_BITS)
    for batch in phrase_index._map_slices(iter([pa.RecordBatch.from_pylist(frequent)])):
        for row in batch.to_pylist():
            bits[row["slice"]] |= np.frombuffer(row["bits"], np.uint8)

    class Held:
        value = bits.tobytes()

    triples, _ = added(phrase_index._triples(Held)(iter(batches)))
    assert {k: n for k, n in triples.items() if n >= least} == {k: n for k, n in expected.items() if k[1] == 3 and n >= least}


def test_covered_pairs_go_and_scores_are_whole_numbers(spark):
    rows = [(i, "x y z" if i < 12 else "x y q" if i < 20 else "p q", "en") for i in range(40)]
    found = {r.phrase: r for r in phrase_index.collocations(spark.createDataFrame(rows, DOCS)).collect()}
    assert set(found) == {"x y z", "p q"} == {p for _, _, p, *_ in plain_collocations(rows, 10, 2000)}
    assert found["x y z"].score == 600_000 and (found["x y z"].l, found["x y z"].r) == (20, 12)


def test_both_directions_of_an_index_agree():
    text = " ".join(np.random.default_rng(2).choice(list("abcdefg"), size=3000)) + ". a b c"
    words, first = phrase_index.piece_words(pa.array([text]))
    coded = words.dictionary_encode()
    index = phrase_index.Index(coded.indices.to_numpy(), first, len(coded.dictionary))
    single = index.single()
    right = index.to_the_right(single)
    left = index.to_the_left(single)
    pairs = {(p, s - 1): n for p, s, n in zip(right.parent.tolist(), right.symbol.tolist(), right.n.tolist())}
    assert pairs == {(s - 1, p): n for p, s, n in zip(left.parent.tolist(), left.symbol.tolist(), left.n.tolist())}
    longer = index.to_the_left(right)
    straight = [right.low, right.low + right.n]
    # The rows of a pair, found by extending to the right, begin with it.
    for i in range(len(right.n)):
        rows = index._straight.first[straight[0][i] : straight[1][i]]
        assert (rows == right.parent[i] + 1).all()
    assert longer.n.sum() == sum(max(len(p) - 2, 0) for p in pieces(text))


# --- conversations -------------------------------------------------------------------------------------------------


def plain_trie(rows):
    turns = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16])
            turns[conv_id].append((order, (role, text)))
    own = {c: [pair for _, pair in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c in own:
        first, n = c - int(math.fmod(c, 5)), zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(first, [])[:n] + own[c][n:])
    members, below, ends = collections.defaultdict(list), collections.defaultdict(set), collections.defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                below[path[: d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, in_it in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not below[node]
            saved[node[:d]] += (len(in_it) - 1) * len(node[-1][1].encode()) if node else 0
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(below[n]), leaves[n], saved[n], digest(ends[n]))
        for n, m in members.items()
    )


def nodes(conversations, *sizes):
    found = conversation_trie.conversation_nodes(conversations, *sizes).collect()
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in found)


def conversation_rows(seed=11):
    random = np.random.default_rng(seed)
    say = ["hi", "hé", "", None, "what", "well well", "😀", "x" * 300]
    rows = []
    for c in [*range(-12, 90), 10**12, 10**12 + 3]:
        if c % 7 == 3:
            continue
        for turn in range(int(random.integers(1, 14))):
            text = say[min(int(random.geometric(0.4)) - 1, len(say) - 1)]
            rows.append((c, turn if turn != 1 or c % 4 else None, ["user", "bot", None][turn % 3], text))
    rows += [(200, 0, "user", "hi"), (200, 0, "user", "hi"), (200, 0, "bot", "hi"), (None, 0, "user", "hi")]
    rows += [(c, i, "user", f"same {i}") for c in range(300, 330) for i in range(9)]
    return rows + [(401, i, "user", "on and on") for i in range(150)]


@pytest.mark.parametrize("sizes", [(), (40, 8)], ids=["one range", "many ranges, paths merged in steps"])
def test_trie_against_plain_python(spark, sizes):
    rows = conversation_rows() if not sizes else [r for r in conversation_rows() if r[0] != 401]
    table = spark.createDataFrame(rows, TURNS).repartition(6)
    assert nodes(table, *sizes) == plain_trie(rows)


def test_trie_of_odd_tables(spark):
    table = spark.createDataFrame([], TURNS)
    assert nodes(table) == []
    rows = [(4, None, None, None)]
    clashing = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("own") for c in ("key", "base", "id", "bin", "size")})
    assert nodes(clashing) == plain_trie(rows)
    assert nodes(spark.createDataFrame([(None, 1, "user", "x")], TURNS)) == []


def test_ends_of_one_conversation_in_many_chunks(monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK_IDS", 7)
    held = {"a": list(range(50)), "b": [-3], "c": list(range(100, 108))}
    rows = [{"digest": d, "conv_id": i} for d, ids in held.items() for i in ids]
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 20]) for i in range(0, len(rows), 20)]
    found = [r for b in conversation_trie._ends(conversation_trie._chunks(iter(batches))) for r in b.to_pylist()]
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert found == [{"digest": d, "least": i[0], "members": len(i), "ends": digest(i)} for d, i in held.items()]


def test_radix_tree_layouts_grow():
    random = np.random.default_rng(0)
    keys = {bytes(random.integers(0, 256, int(n), dtype=np.uint8)) for n in random.integers(0, 6, 3000)}
    keys |= {key + b"\x00" * 20 for key in list(keys)[:50]}
    tree = Tree()
    for key in keys:
        tree.insert(key, key)
    assert all(tree.find(key) == key for key in keys)
    assert all(tree.find(key) is None for key in (b"\x01" * 40, b"\xff" * 9) if key not in keys)
    layout, kinds = Sorted(4), []
    for byte in range(256):
        layout = layout.put(byte, byte)
        kinds.append((type(layout), getattr(layout, "room", None)))
    assert [kinds[i] for i in (3, 4, 15, 16, 47, 48, 255)] == [
        (Sorted, 4), (Sorted, 16), (Sorted, 16), (Indexed, None), (Indexed, None), (Direct, None), (Direct, None),
    ]
    assert [layout.find(byte) for byte in range(256)] == list(range(256))


# --- fingerprints --------------------------------------------------------------------------------------------------


def hash_of(parts):
    """What Spark's xxhash64 makes of several longs, or of a text."""
    seed = 42
    for part in parts:
        data = part.encode() if isinstance(part, str) else part.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    codes = [hash_of([w]) for w in words]
    runs = [codes[i : i + 5] for i in range(len(codes) - 4)] if len(codes) >= 5 else [codes] * bool(codes)
    return {hash_of(run) for run in runs}


def plain_sketch(found):
    if len(found) <= threshold_sketch.SMALL:
        return 1, sorted(found)
    return threshold_sketch.SCALE, sorted(h for h in found if h < threshold_sketch.LIMIT)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    scale = max(a[0], b[0])
    a, b = (set(h) if s == scale else {x for x in h if x < threshold_sketch.LIMIT} for s, h in (a, b))
    return len(a & b) / len(a | b) if a | b else 0.0


def written(sketch):
    return f"{sketch[0]}:" + ",".join(f"{h & (1 << 64) - 1:X}".lower() for h in sketch[1])


def sketch_docs():
    random = np.random.default_rng(4)
    text = lambda n: " ".join(f"W{i}" for i in random.integers(0, 3000, n))
    rows = [(i, text(int(random.integers(0, 500)))) for i in range(40)]
    rows += [(50, rows[3][1]), (51, "one\ttwo \n"), (52, " \x0b "), (53, ""), (54, None), (55, "é😀" * 30), (56, text(20_000))]
    return rows + [(56, "same id, other text"), (-3, "x"), (60, "again and again it is"), (60, "again and again it is")] * 2


def test_fingerprints_against_plain_python(spark):
    rows = [*sketch_docs(), (None, "no id"), (None, None), (None, "no id")]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    expected = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        sketch, changed, other = (plain_sketch(plain_set(t)) for t in (text, edited, following))
        expected.append(
            (str(doc_id), len(text), hashlib.sha256(edited.encode()).hexdigest(), written(sketch), written(changed),
             plain_likeness(sketch, changed), plain_likeness(sketch, other))
        )
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    clashing = docs.withColumns({c: F.lit("own") for c in ("key", "bin", "copies", "sketch", "own", "edited", "n_chars", "row")})
    for table in (docs, clashing):
        found = threshold_sketch.edited_documents(table).collect()
        assert sorted((str(r[0]), *r[1:7]) for r in found) == sorted(expected)
    assert threshold_sketch.edited_documents(docs.limit(0)).collect() == []
    alone = threshold_sketch.edited_documents(spark.createDataFrame([(7, "a b c d e f")], "doc_id long, text string"))
    assert [(r.n_chars, r.near_next, r.next_doc_id) for r in alone.collect()] == [(11, 1.0, 7)]


def test_sketches_merge_and_are_read_back(spark):
    random = np.random.default_rng(9)
    texts = [" ".join(f"t{i}" for i in random.integers(0, 900, n)) for n in (0, 3, 90, 100, 400, 3000)]
    pairs = [(a, b) for a in texts for b in texts]
    df = spark.createDataFrame(pairs, "a string, b string")
    df = threshold_sketch.with_sketch(threshold_sketch.with_sketch(df, "a", "sa"), "b", "sb")
    merged = threshold_sketch.merged(F.col("sa"), F.col("sb"))
    back = threshold_sketch.from_text(threshold_sketch.as_text(F.col("sa")))
    for (a, b), row in zip(pairs, df.select(merged.alias("m"), back.alias("back"), "sa").collect()):
        assert (row.m.scale, row.m.hashes) == plain_sketch(plain_set(a) | plain_set(b))
        assert row.back == row.sa


def test_containment_of_very_unequal_documents(spark):
    words = [f"c{i}" for i in np.random.default_rng(8).integers(0, 10**6, 40_000)]
    part = words[5000:9000] + [f"other{i}" for i in range(2000)]
    df = spark.createDataFrame([(" ".join(part), " ".join(words))], "a string, b string")
    df = threshold_sketch.with_sketch(threshold_sketch.with_sketch(df, "a", "sa"), "b", "sb")
    found = df.select(threshold_sketch.containment(F.col("sa"), F.col("sb"))).first()[0]
    assert abs(found - 3996 / 5996) < 0.08
