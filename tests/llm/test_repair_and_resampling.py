"""Conversation repair and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
from itertools import product
from pathlib import Path
from zlib import crc32

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from frames import no_documents, odd_documents, words  # noqa: E402

from sedimenta.llm import conversations, resample  # noqa: E402
from sedimenta.llm.queries import damaged, op11_conversation_repair, op12_resample  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

# --- conversations ----------------------------------------------------------------


def plain_repair(turns, most_inserts=3):
    """All counts, the cost, the audit and the digest, by trying all edits of short conversations."""
    key = lambda t: (t[0] is not None, t[0] or 0, t[1] or " ", t[2] or " ")
    turns = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in turns), key=key)
    faults, seen = [], set()
    for _, role, text in turns:
        shown = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", text)
        if not shown:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    numbers = [t for t, _, _ in turns if t is not None]
    initials = [r[:1] for _, r, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    best = None

    def extend(at, cost, audit, lines, inserts):
        nonlocal best
        roles = "".join(line[:1] for line in lines)
        # No way goes on from a wrong beginning.
        if (best is not None and cost > best[0]) or not re.fullmatch("s?(ua)*u?", roles):
            return
        if at == len(turns):
            if re.fullmatch("(s?(ua)+)?", roles):
                found = cost, audit, lines
                best = found if best is None else min(best, found)
        if inserts < most_inserts:
            for role in ("user", "assistant"):
                extend(at, cost + 3, audit + "I", [*lines, role + ":"], inserts + 1)
        if at == len(turns):
            return
        _, role, text = turns[at]
        extend(at + 1, cost + 4, audit + "D", lines, 0)
        if faults[at] not in ("blank", "duplicate"):
            rest = 3 if faults[at] == "truncated" else 0
            extend(at + 1, cost + rest, audit + "K", [*lines, f"{role}:{text}"], 0)
            for other in ("user", "assistant"):
                extend(at + 1, cost + rest + 3, audit + "R", [*lines, f"{other}:{text}"], 0)

    extend(0, 0, "", [], 0)
    cost, audit, lines = best
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


TEXTS = ["Yes.", "No", "", " \t", "Why?", "Ends here! \n", None, "é。", "Go on."]
ROLES = ["user", "assistant", "system", None, "tool", ""]


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(4)
    rows = []
    for conv in [None, *range(70)]:
        for n in range(rng.randrange(1, 6)):
            role = rng.choice(ROLES[:3] if rng.random() < 0.7 else ROLES)
            turn = rng.choice([n, n, n * 3, None, 2**60 + n])
            rows.append((conv, turn, role, rng.choice(TEXTS), "x"))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string")


def by_conversation(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    return found


def reported(df):
    names = [*conversations.COUNTS, "audit", "repaired_sha256"]
    return {r.conv_id: tuple(r[n] for n in names) for r in df.collect()}


def test_repair(talks):
    expected = {c: plain_repair(turns) for c, turns in by_conversation(talks).items()}
    assert reported(conversations.repair_report(talks)) == expected


def test_long_conversations_are_spilled_and_traced_in_stretches(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(1, n, rng.choice(ROLES[:3]), f"{n}{rng.choice('.!a')}") for n in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = reported(conversations.repair_report(df))

    def all_at(memory, stretch):
        monkeypatch.setattr(conversations, "IN_MEMORY", memory)
        monkeypatch.setattr(conversations, "STRETCH", stretch)
        talk = conversations.Conversation(conversations.Costs())
        for _, turn, role, text in rows:
            talk.add(str(turn), role, text, False)
        talk.finish()
        return talk.cost, list(talk.edits())

    found = {str(all_at(*x)) for x in product((10, 1 << 20), (1, 7, 400, 1 << 16))}
    assert len(found) == 1
    cost, edits = all_at(10, 7)
    assert whole[1][5] == cost and whole[1][6] == "".join(e for e, _, _ in edits)
    # The costs of the edits are what was said, and the roles are as they have to be.
    price = {"D": 4, "I": 3, "K": 0, "R": 3}
    cut = sum(3 for e, _, t in edits if e in "KR" and not t.endswith((".", "!")))
    assert sum(price[e] for e, _, _ in edits) + cut == cost
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _ in edits if r))


def test_repaired_turns_are_those_of_the_digest(talks):
    lines: dict = {}
    for r in conversations.repaired_turns(talks).orderBy("place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.place == len(lines[r.conv_id])
    for conv, found in reported(conversations.repair_report(talks)).items():
        digest = hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest()
        assert digest == found[-1]


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair_report(df).count() == 0
    assert conversations.repaired_turns(df).count() == 0


def test_repair_query(spark):
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    harmed = by_conversation(damaged(given))
    found = reported(op11_conversation_repair(spark, FOLDER))
    assert set(found) == {r.conv_id for r in given.select("conv_id").distinct().collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    short = 0
    for conv, result in found.items():
        if len(harmed.get(conv, [])) <= 5:
            short += 1
            assert result == (plain_repair(harmed[conv]) if conv in harmed else nothing), conv
    assert short > 3
    # The damage itself, row by row.
    expected = []
    for r in given.collect():
        role, text = r.role if r.role is not None else " ", r.text if r.text is not None else " "
        name = ":".join(" " if x is None else str(x) for x in (r.conv_id, r.turn))
        match crc32(name.encode()) % 20:
            case 0: continue
            case 1: text = ""
            case 2: text = re.sub("[.!?]", "", text)
            case 3: expected.append((r.conv_id, r.turn, role, text))
            case 4: role = "user"
        expected.append((r.conv_id, r.turn, role, text))
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in damaged(given).collect())


# --- resampling -------------------------------------------------------------------


def plain_features(text, longest=3, buckets=10_000):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    grams = [
        " ".join(found[i : i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)
    ]
    return len(found), [crc32(g.encode()) % buckets for g in grams]


def plain_draw(docs, target):
    """(n_features, weight, score, rank) of each row, in order."""
    source, wanted = [0] * 10_000, [0] * 10_000
    for texts, counts in (([t for _, t in docs], source), (target, wanted)):
        for text in texts:
            for b in plain_features(text)[1]:
                counts[b] += 1
    s_all, t_all = sum(source) + 10_000, sum(wanted) + 10_000
    gain = [
        math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
        for s, t in zip(source, wanted)
    ]
    rows, order = [], []
    for i, (doc, text) in enumerate(docs):
        n_words, found = plain_features(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([len(found), weight, score, None])
        if n_words >= 20 and doc is not None:
            order.append((-score, doc, i))
    for rank, (_, _, i) in enumerate(sorted(order)[: 5 * len(order) // 100], 1):
        rows[i][3] = rank
    return [tuple(r) for r in rows]


def test_resampling(spark, monkeypatch):
    df = odd_documents(spark)
    more = [(100 + n, words(20 + n % 7, n), None, n) for n in range(150)]
    df = df.unionByName(spark.createDataFrame(more, df.schema))
    rows = df.collect()
    target = [words(30, 3), None, "", words(12, 101)]
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    expected = plain_draw([(r.doc_id, r.text) for r in rows], target)
    found = resample.drawn(df, wanted).collect()
    assert sorted(map(str, ((r.n_features, r.weight, r.score, r["rank"]) for r in found))) == sorted(
        map(str, expected)
    )
    assert found[0].row.__fields__ == ["doc_id", "key", "n"]
    chosen = {r.doc_id for r in resample.resampled(df, wanted).collect()}
    assert chosen == {r.doc_id for r, e in zip(rows, expected) if e[3]}
    nothing = no_documents(spark)
    assert resample.drawn(nothing, nothing).count() == 0
    assert {r.weight for r in resample.drawn(df, nothing.where("false")).collect()} != set()


def test_crcs_of_substrings_from_those_of_prefixes(monkeypatch):
    """Long texts in parts and short ones together give what each n-gram gives alone."""
    rng = random.Random(2)
    texts = [words(rng.randrange(0, 40), n) for n in range(30)]
    texts += [None, "", "Ein WORT", "x" * 700 + " " + "é" * 300, "a-b_c.d", "日本語 und A1"]
    for at_once, longest in ((3, 3), (50, 2), (100_000, 3), (7, 1)):
        monkeypatch.setattr(resample, "AT_ONCE", at_once)
        settings = resample.Resampling(longest=longest)
        found = [[] for _ in texts]
        n_words = [0] * len(texts)
        for new, owners, buckets in resample.Features(settings)(texts):
            for doc, n in new.tolist():
                n_words[doc] += n
            for doc, bucket in zip(owners.tolist(), buckets.tolist()):
                found[doc].append(bucket)
        for text, n, buckets in zip(texts, n_words, found):
            expected = plain_features(text, longest)
            assert (n, sorted(buckets)) == (expected[0], sorted(expected[1]))


def test_resampling_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    expected = {d: e for (d, _), e in zip(docs, plain_draw(docs, target))}
    found = {r.doc_id: tuple(r)[1:] for r in op12_resample(spark, FOLDER).collect()}
    assert found == expected
