"""Operators over documents against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from frames import no_documents, odd_documents, words  # noqa: E402

from sedimenta.llm import decontaminate, huffman, packing, repeats, simhash  # noqa: E402
from sedimenta.llm.components import connected_components  # noqa: E402
from sedimenta.llm.tokens import Encoder, vocabulary  # noqa: E402


# --- repeated strings -----------------------------------------------------------


def plain_repeats(docs):
    """(n_bytes, spans, kept) by (doc_id, text), window by window."""
    first: dict[bytes, int] = {}
    for doc, text in docs:
        octets = (text or "").encode()
        for i in range(len(octets) - repeats.LENGTH + 1):
            string = octets[i : i + repeats.LENGTH]
            if doc is not None:
                first[string] = min(first.get(string, doc), doc)
    found = {}
    for doc, text in docs:
        octets = (text or "").encode()
        gone = bytearray(len(octets))
        for i in range(len(octets) - repeats.LENGTH + 1):
            if doc is not None and first[octets[i : i + repeats.LENGTH]] < doc:
                gone[i : i + repeats.LENGTH] = b"\1" * repeats.LENGTH
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(c for c, g in zip(octets, gone) if not g)
        found[doc, text] = (len(octets), spans, kept)
    return found


def test_repeats(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 900)
    df = odd_documents(spark)
    rows = df.collect()
    expected = plain_repeats([(r.doc_id, r.text) for r in rows])
    by_key = {(r.doc_id, r.n): r.text for r in rows}
    found = repeats.without_repeats(df).collect()
    assert len(found) == len(rows)
    for r in found:
        spans = [(s.start, s.stop) for s in r.spans]
        text = by_key[r.row.doc_id, r.row.n]
        assert (r.n_bytes, spans, bytes(r.kept)) == expected[r.row.doc_id, text], r.row.doc_id
    assert repeats.without_repeats(no_documents(spark)).count() == 0


def test_runs_of_a_hot_anchor_are_never_sent_to_every_task(spark, monkeypatch, plan):
    """A phrase in many documents, in other words each time, and one with a part of its context."""
    phrase, longer = words(6, 71)[:40], words(40, 72)[:70]
    rows = [
        (n, f"{words(30, 7_000 + n)} {phrase if n % 2 else longer} {words(30, 8_000 + n)}")
        for n in range(60)
    ]
    rows += [(100 + n, "z" + t[20:-20]) for n, t in rows[:20]]
    expected = plain_repeats(rows)
    monkeypatch.setattr(repeats, "GROUP", 2)
    found = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "sequence(0" not in plan(found)
    texts = dict(rows)
    for r in found.collect():
        spans = [(s.start, s.stop) for s in r.spans]
        assert (r.n_bytes, spans, bytes(r.kept)) == expected[r.row.doc_id, texts[r.row.doc_id]]


def test_names_are_those_of_equal_strings():
    octets = (words(300, 7) * 2).encode()
    for names, width in ((repeats.anchor_names(octets), 24), (repeats.suffix_names(octets), 50)):
        strings = [octets[i : i + width] for i in range(len(octets) - width + 1)]
        assert len(names) == len(strings)
        assert len(set(zip(names.tolist(), strings))) == len(set(strings)) == len(set(names.tolist()))


# --- near-duplicates --------------------------------------------------------------


def plain_components(n, links):
    root = list(range(n))
    for a, b in links * n:
        root[a] = root[b] = min(root[a], root[b])
    return root


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(0, n) for n in range(300, 400)]
    links += [(n, n + 1) for n in range(400, 440)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = plain_components(441, links)
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in found} == {n: expected[n] for n in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def mark(text):
    """The fingerprint of a text, bit by bit."""
    import xxhash

    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(spark, monkeypatch):
    """Also with keys so crowded that they are dealt into tiles."""
    df = odd_documents(spark)
    many = [(100 + n, words(30, 50) + " " + words(300, 60) + f" tail{n}") for n in range(40)]
    df = df.select("doc_id", "text").unionByName(spark.createDataFrame(many, "doc_id long, text string"))
    rows = df.collect()
    marks = [mark(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4]
    roots = plain_components(len(rows), links)
    expected = []
    for i, r in enumerate(rows):
        ids = [rows[j].doc_id for j in range(len(rows)) if roots[j] == roots[i] and rows[j].doc_id is not None]
        expected.append((str(r.doc_id), marks[i], min(ids, default=None)))
    monkeypatch.setattr(simhash, "TILE", 8)
    found = [
        (str(r.doc_id), r.f0 % (1 << 64), r.component_id)
        for r in simhash.near_duplicates(df).collect()
    ]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    """Copies and near-copies go, documents that share less stay."""
    base = words(400, 11)
    near = base.split()
    near[200] = "other"
    half = " ".join(base.split()[:200]) + " " + words(200, 12)
    rows = [(3, base), (1, base), (2, " ".join(near)), (4, half), (5, None), (6, ""), (7, words(50, 13))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("place", F.lit("x"))
    kept = simhash.without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 7]


def test_one_of_each_component_stays(spark, monkeypatch):
    """Many copies with more and more edits: the bits decide, and the smallest id stays."""
    monkeypatch.setattr(simhash, "TILE", 8)
    rng, rows = random.Random(5), []
    for group in range(4):
        base = words(300, 700 + group).split()
        for n in range(40):
            text = list(base)
            for at in rng.sample(range(300), n // 4):
                text[at] = f"new{n}"
            rows.append((1_000 * group + (n * 7) % 40, " ".join(text)))
    rows += [(9_000, None), (9_001, " "), (None, rows[0][1]), rows[1]]
    marks = [mark(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4]
    first: dict = {}
    for (doc, _), root in zip(rows, plain_components(len(rows), links)):
        first[root] = min((doc is not None, doc or 0), first.get(root, (True, 1 << 40)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.without_near_duplicates(df).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept) == sorted(first.values())
    assert 4 < len(kept) < len(rows) * 2 / 3


# --- benchmark items ----------------------------------------------------------------


def test_contained_items(spark):
    item, other = words(40, 21), words(12, 22)
    broken = item.split()
    for n in range(5, 40, 7):
        broken[n] = "wrong"
    docs = [
        (1, words(5_000, 23) + " " + item.upper().replace(" ", ", ") + "! " + words(3_000, 24)),
        (2, words(200, 25) + " " + " ".join(broken)), (3, other), (4, None), (None, other), (5, "x"),
        (6, " ".join(item.split()[:36])), (6, " ".join(item.split()[:36])),
    ]
    items = [(1, item), (2, other), (3, "too short"), (4, None), (5, "")]
    found = decontaminate.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (3, 2), (None, 2), (6, 1)}
    six = next(r for r in found if r.doc_id == 6)
    assert (six.n_shingles, six.n_found) == (36, 32)
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1))
    left = decontaminate.without_benchmark(rows, spark.createDataFrame(items, "item_id long, text string"))
    assert [r.doc_id for r in left.orderBy("doc_id").collect()] == [2, 4, 5]
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained_items(rows, nothing).count() == 0
    assert decontaminate.contained_items(
        no_documents(spark), spark.createDataFrame(items, "item_id long, text string")
    ).count() == 0


# --- token ids ------------------------------------------------------------------------


@pytest.mark.parametrize(("name", "keeps"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_are_those_of_whole_texts(spark, name, keeps):
    tool = Encoder(vocabulary(name), keeps)
    texts = [r.text or "" for r in odd_documents(spark).collect()]
    texts += ["a  b   c \n d", "x.,y, z", " lead", "tail ", "tail\n", "it's we'll", "a\0b",
              "Σας ΣΑΣ.", "a b  c", "é ́x", "1,234.5", "a_.b", "..."]
    for _ in range(2):
        found = [np.frombuffer(x, tool.dtype).tolist() for x in tool.encode(texts)]
        assert found == [e.ids for e in tool.library.encode_batch(texts, add_special_tokens=False)]


def test_the_memory_is_asked_once_for_each_different_piece():
    """Not for each piece, of which there are many times as many."""

    class Counted(dict):
        asked = 0

        def get(self, key):
            Counted.asked += 1
            return super().get(key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    tool = Encoder(vocabulary("byte_bpe_50k.json"), True)
    texts = ["one two three two one"] * 500
    first = list(tool.encode(texts))
    tool.known = Counted(tool.known)
    assert list(tool.encode(texts)) == first
    assert 0 < Counted.asked <= 2 * len(tool.known)


@pytest.mark.parametrize("seed", range(4))
def test_codes_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = [1, 2, 300, 5_000][seed]
    ids = np.minimum(rng.geometric(0.01, 20_001) - 1, n - 1).astype(np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=n + 5))
    assert lengths.max() <= huffman.LIMIT
    used = lengths[lengths > 0].astype(float)
    assert len(used) < 2 or (2.0**-used).sum() == 1
    codes = huffman.canonical_codes(lengths)
    for size in (0, 1, huffman.STRIDE, huffman.STRIDE + 1, len(ids)):
        packed = huffman.encode_block(ids[:size], lengths, codes)
        got = huffman.decode_block(*packed, size, huffman.decode_table(lengths))
        assert got.tolist() == ids[:size].tolist()


def test_lengths_are_the_best_without_a_limit():
    import heapq

    counts = np.random.default_rng(3).integers(1, 1000, 60)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        total = heapq.heappop(heap) + heapq.heappop(heap)
        cost += total
        heapq.heappush(heap, total)
    assert (huffman.code_lengths(counts) * counts).sum() == cost


def test_memory_of_pieces_is_bounded_and_keeps_frequent_ones(monkeypatch):
    from sedimenta.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    tool = tokens.Encoder(tokens.vocabulary("word_bpe_49k.json"), False)
    plain, ids = tool.library, {}
    for n in range(60):
        text = f"often {words(9, 3_000 + n)}"
        (ids[n],) = tool.encode([text])
        assert len(tool.known) + len(tool.older) <= 40
        assert np.frombuffer(ids[n], tool.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids
        assert "often" in tool.known or "often" in tool.older


def test_token_file(spark, tmp_path, monkeypatch):
    df = odd_documents(spark)
    path = str(tmp_path / "file")
    huffman.write_token_file(df, path, vocabulary("byte_bpe_50k.json"))
    found = huffman.read_token_file(spark, path).orderBy("start").collect()
    tool = Encoder(vocabulary("byte_bpe_50k.json"), True).library
    rows = df.collect()
    texts = {(r.doc_id, i): r.text or "" for i, r in enumerate(rows)}
    expected = sorted(
        (-1 if k is None else k, [*tool.encode(t, add_special_tokens=False).ids, 0])
        for (k, _), t in texts.items()
    )
    got = [(-1 if r.doc_id is None else r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in found]
    assert [k for k, _ in got] == [k for k, _ in expected]
    assert sorted(got) == expected
    assert [r.start for r in found] == [0, *np.cumsum([len(i) for _, i in got])[:-1].tolist()]
    empty = str(tmp_path / "empty")
    huffman.write_token_file(no_documents(spark), empty, vocabulary("byte_bpe_50k.json"))
    assert huffman.read_token_file(spark, empty).count() == 0


# --- packing ----------------------------------------------------------------------------


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 4, indexing="ij"), -1).reshape(-1, 4)
    keys = packing.hilbert_keys(grid, 3)
    walk = grid[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(8**4))
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_packing(spark):
    df = odd_documents(spark)
    pieces = packing.packed(df, vocabulary("word_bpe_49k.json"), length=64).collect()
    tool = Encoder(vocabulary("word_bpe_49k.json"), False).library
    expected = sorted(
        (str(r.doc_id), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for r in df.collect()
        for ids in [[*tool.encode(r.text or "", add_special_tokens=False).ids, 1]]
    )
    ends: dict[int, int] = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert ends.get(p.sequence_id, 0) == p.offset
        ends[p.sequence_id] = p.offset + p.length
    assert sorted(ends) == list(range(len(ends)))
    assert all(n == 64 for s, n in ends.items() if s < len(ends) - 1)
    assert sum(p.length for p in pieces) == sum(n for _, n, _ in expected)
    whole = [(str(p.doc_id), p.length, p.ids_crc32) for p in pieces if p.length == p.doc_tokens]
    assert set(whole) <= set(expected) and len(whole) > 3
    assert packing.packed(no_documents(spark), vocabulary("word_bpe_49k.json")).count() == 0


def test_digest_of_kept_bytes(spark):
    """The digest columns of the query follow from the operator's real outputs."""
    from sedimenta.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = plain_repeats([(d.doc_id, d.text) for d in docs])
    for r in QUERIES["op1_repeats"](spark, folder).collect():
        text = next(d.text for d in docs if d.doc_id == r.doc_id)
        n_bytes, spans, kept = expected[r.doc_id, text]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n_bytes, sum(b - a for a, b in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
