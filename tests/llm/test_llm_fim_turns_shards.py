"""Fill-in-the-middle, conversation repair and sharding against brute force."""

import hashlib
import os
import random
import re
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import llm_cases as cases  # noqa: E402

from aidspark.llm import fim, queries, sharding, turns  # noqa: E402

SMALL = "/root/testdata/sf0.001"


# fill in the middle ----------------------------------------------------------------------------
def fim_by_hand(doc_id, text):
    text = text or ""
    units = re.findall(fim.UNIT, text, re.S)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, mid, tail = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 20:
        return n, "spm", len(head), len(mid), f"<S>{tail}<P>{head}<M>{mid}"
    return n, "psm", len(head), len(mid), f"<P>{head}<S>{tail}<M>{mid}"


def fim_texts():
    texts, ids = cases.edge_texts()
    rng = random.Random(4)
    for i in range(150):
        n = rng.randrange(1, 400)
        texts.append("".join(rng.choice(["a", "Zq", " ", "\n", "é", "日", "\U0001f600", "<", ">", "S", "word" * 30]) for _ in range(n)))
        ids.append(1000 + i)
    more = ["a" * 50_000, "é" * 30_000, "\U0001f600" * 9_000, "ab <P> c", "x<S>", "<M>", "ends <", "<P"]
    return texts + more, ids + list(range(2000, 2000 + len(more)))


def check_fim(spark, texts, ids):
    made = fim.fill_in_middle(cases.table(spark, texts, ids)).withColumn("back", fim.restore(F.col("output"), F.col("form")))
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect()]
    want = [(i, *fim_by_hand(i, t), t or "") for i, t in zip(ids, texts)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fim_equals_regex_over_the_whole_text(spark):
    check_fim(spark, *fim_texts())


def test_cut_places_of_every_unit_count():
    rng = random.Random(9)
    text = "".join(rng.choice(["a", "".join(rng.choices("qrstuV", k=60)), " ", "é", "日", "\n"]) for _ in range(900))
    units = re.findall(fim.UNIT, text, re.S)
    cutter = fim.Cutter(text.encode(), fim.Chunks())
    assert len(cutter.ends) > 5 and cutter.n == len(units)
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert cutter.cut(k) == (len(head.encode()), len(head))


def test_chunk_ends_follow_content_and_keep_code_points():
    rng = random.Random(2)
    passage = " ".join(rng.choice(cases.WORDS) for _ in range(3000)).encode()
    chunks = lambda t: {t[a:b] for ends in [fim.chunk_ends(np.frombuffer(t, np.uint8))] for a, b in zip([0, *ends], ends)}
    one, two = chunks(b"first text. " * 9 + passage), chunks(b"another, longer beginning " * 40 + passage)
    assert len(one & two) > 0.8 * min(len(one), len(two)) > 10
    for t in ("é" * 20_000, "\U0001f600" * 9_000, "a" * 30_000):
        parts = chunks(t.encode())
        assert all(p.decode() for p in parts) and max(map(len, parts)) <= fim.MOST


def test_summaries_are_shared_and_checked_by_content(monkeypatch):
    memo, text = fim.Chunks(), b"some words and more of them " * 200
    fim.Cutter(text, memo)
    before = memo.asked
    fim.Cutter(text, memo)
    assert memo.shared >= memo.asked - before > 0
    # with one hash for all chunks, equal hashes must not give another chunk's summary
    monkeypatch.setattr(fim.xxhash, "xxh3_64_intdigest", lambda c: 7)
    memo = fim.Chunks()
    assert memo.summary(b"ab cd") == (3, 5, True, True) and memo.summary(b" x") == (2, 2, False, True)
    assert memo.summary(b"ab cd") == (3, 5, True, True)


def test_a_full_memory_changes_nothing(spark, monkeypatch):
    memo = fim.Chunks()
    memo.LIMIT = 10
    text = ("one two three. " * 300).encode()
    assert fim.Cutter(text, memo).n == fim.Cutter(text, fim.Chunks()).n and len(memo) <= 2


# conversations ---------------------------------------------------------------------------------
def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else str(x)
        role, text = space(role), space(text)
        draw = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        out += [(conv, turn, role, text)] * (2 if draw == 3 else 1)
    return out


def repaired_by_hand(rows):
    """(turn, role, text) rows of one conversation, by trying all edits."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen else
                 "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
        faults.append(fault)
    names = {"u": "user", "a": "assistant"}

    def legal(roles):
        return re.fullmatch("(s?(ua)+)?", roles) is not None

    def prefix(roles):
        return re.fullmatch("s?(ua)*u?", roles) is not None

    @lru_cache(None)
    def best(i, tail, roles, inserts):
        """Cheapest (cost, letters, lines) from row i on; ``roles`` stands for all before by an equal end."""
        found = []
        if i == len(rows) and legal(roles):
            found.append((0, "", ()))
        if inserts < 3:
            for r in "ua":
                if prefix(roles + r):
                    c, s, o = best(i, tail, short(roles + r), inserts + 1)
                    found.append((c + 2, "I" + s, (names[r] + ":",) + o))
        if i < len(rows):
            _, role, text = rows[i]
            extra = faults[i] == "truncated"
            c, s, o = best(i + 1, tail, roles, 0)
            found.append((c + 3, "D" + s, o))
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] and prefix(roles + role[0]):
                    c, s, o = best(i + 1, tail, short(roles + role[0]), 0)
                    found.append((c + extra, "K" + s, (f"{role}:{text}",) + o))
                for r in "ua":
                    if prefix(roles + r):
                        c, s, o = best(i + 1, tail, short(roles + r), 0)
                        found.append((c + 2 + extra, "R" + s, (f"{names[r]}:{text}",) + o))
        return min(found) if found else (10 ** 9, "", ())

    def short(roles):  # pairs in the middle do not matter
        return re.sub("^(s?ua)(ua)+", r"\1", roles)

    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    starts = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))
    cost, audit, lines = best(0, None, "", 0)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def talks(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for k in range(rng.randrange(1, 9)):
            turn = rng.choice([k, k, k, k, rng.randrange(0, 9), None])
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "s", "u", None])
            text = rng.choice(["Yes.", "No", " \n", "", None, f"text {rng.randrange(3)}.", "a? \t", "Why?", "日。", "x\u0085"])
            rows.append((conv, turn, role, text))
    return rows


TALK = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed, batch", [(1, 1000), (2, 2)])
def test_repair_equals_trying_all_edits(spark, seed, batch):
    rows = talks(seed, 250)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(batch))  # states are carried over batches
    try:
        for damaged in (False, True):
            table = spark.createDataFrame(rows, TALK).repartition(3)
            got = (turns.repair_damaged(table) if damaged else turns.repair(table.select("*", F.lit(1).alias("conv"), F.lit(2).alias("nth")))).collect()
            kept, want = damaged_by_hand(rows) if damaged else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], {}
            for conv in {r[0] for r in rows}:
                want[conv] = repaired_by_hand([r[1:] for r in kept if r[0] == conv])
            assert len(got) == len(want)
            for r in got:
                assert tuple(r)[1:] == want[r.conv_id], r.conv_id
    finally:
        spark.conf.set(key, before)


def test_a_giant_conversation_streams(spark):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"text {i}.") for i in range(20_001)] + [(8, 0, "user", "a?")]
    got = {r.conv_id: r for r in turns.repair(spark.createDataFrame(rows, TALK).repartition(5)).collect()}
    assert got[7].cost == 2 and got[7].audit == "K" * 20_001 + "I" and got[7].illegal == got[7].gaps == 0
    text = "\n".join(f"{r}:{t}" for _, _, r, t in rows[:-1]) + "\nassistant:"
    assert got[7].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (got[8].cost, got[8].audit) == (2, "KI")


def test_repair_shuffles_rows_once(spark):
    plan = turns.repair(spark.createDataFrame(talks(3, 5), TALK))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_conversations(spark):
    none = spark.createDataFrame([], TALK)
    assert turns.repair_damaged(none).collect() == [] and turns.repair(none).collect() == []


# sharding --------------------------------------------------------------------------------------
def check_shards(rows, shards, n):
    assert len(rows) == n
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert set(by) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def split_groups(rows, key):
    places = {}
    for r in rows:
        places.setdefault(key(r), []).append(r.shard)
    return {k: len(set(v)) for k, v in places.items() if len(v) > 1}


def test_equal_texts_share_a_shard(spark):
    rng = random.Random(6)
    texts = [f"text {rng.randrange(400)}" for _ in range(900)] + [None, "", "é"] + [f"alone {i}" for i in range(300)]
    rows = sharding.shard(cases.table(spark, texts), shards=10).collect()
    check_shards(rows, 10, len(texts))
    by_id = {r.doc_id: r for r in rows}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        assert (by_id[i].size, by_id[i].text_crc32) == (len(data) + 16, zlib.crc32(data))
    split = split_groups(rows, lambda r: (r.size, r.text_crc32))
    assert sum(k > 1 for k in split.values()) <= 0.02 * len(split)


def test_a_group_larger_than_a_shard_takes_few_shards(spark):
    texts = ["same"] * 400 + [f"pair {i // 2}" for i in range(400)] + [f"alone {i}" for i in range(400)]
    rows = sharding.shard(cases.table(spark, texts, [3] * 200 + list(range(1000))), shards=12).collect()
    check_shards(rows, 12, 1200)
    split = split_groups(rows, lambda r: (r.size, r.text_crc32))
    # 400 copies need four shards of 100; pairs move as a whole
    assert max(split.values()) <= 8 and sum(k > 1 for k in split.values()) <= 20


def test_all_rows_linked(spark):
    texts = [f"pair {i // 2}" for i in range(2000)]
    rows = sharding.shard(cases.table(spark, texts), shards=8).collect()
    check_shards(rows, 8, 2000)
    split = split_groups(rows, lambda r: (r.size, r.text_crc32))
    assert sum(k > 1 for k in split.values()) < 0.15 * 1000 < 0.875 * 1000  # 7 in 8 at the start


def test_rows_of_several_groups(spark):
    rows = [(i, f"t{i}", f"a{i // 4}" if i < 800 else None, f"b{i // 20}" if i % 3 and i < 800 else None) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, g string").repartition(3)
    got = sharding.shard(docs, shards=5, groups=[docs["node"], docs["g"]], rounds=6).collect()
    check_shards(got, 5, 1600)
    fours = split_groups([r for r in got if r.doc_id < 800], lambda r: r.doc_id // 4)
    assert sum(k > 1 for k in fours.values()) < 0.25 * len(fours)  # nearly all at the start


def test_quotas_keep_capacity():
    rng = np.random.default_rng(1)
    asked = rng.integers(0, 50, (6, 6)) * (1 - np.eye(6, dtype=int))
    asked[:, 2] += 300 * (np.arange(6) != 2)
    room = np.array([5, 0, 40, -3, 10, 0])
    moved = sharding.quotas(asked, room) * asked
    assert (moved <= asked + 1e-9).all() and moved.sum() > 100
    assert (moved.sum(0) - np.maximum(moved.sum(1) + room, 0) <= 1).all()


def test_few_and_no_rows(spark):
    check_shards(sharding.shard(cases.table(spark, ["a", "a", "b"])).collect(), 40, 3)
    assert sharding.shard(cases.table(spark, ["a"]).limit(0)).collect() == []
    texts, ids = cases.edge_texts()
    rows = sharding.shard(cases.table(spark, texts, ids), shards=4).collect()
    check_shards(rows, 4, len(texts))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i in ids)


@pytest.mark.parametrize("name", ["op11_fim", "op12_turns", "op13_sharding"])
def test_registered_queries_have_their_columns(spark, name):
    want = {"op11_fim": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
            "op12_turns": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
            "op13_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]}[name]
    got = queries.registry()[name](spark, SMALL)
    assert got.columns[:len(want)] == want
    assert got.count() == spark.read.parquet(f"{SMALL}/{'conversations' if 'turns' in name else 'documents'}.parquet").select(want[0]).distinct().count()
