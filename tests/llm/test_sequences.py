"""Token files, the conversation trie and conversation repair against brute force and round trips."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from attestry.llm import queries, repair, token_files, trie

TURNS = "conv_id long, turn long, role string, text string"
TOKENIZER = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return P.path(TOKENIZER), Tokenizer.from_file(P.path(TOKENIZER))


# token files


def test_pieces_give_the_library_s_ids(tokenizer):
    path, library = tokenizer
    with open(path, encoding="utf-8") as f:
        coder = token_files.Ids(f.read())
    rng = random.Random(3)
    odd = [" ", "\n", "\t", "\r\n", " ", "᠎", "​", "　", "\x1c", "\x85", "é", "ß", "ı", "٣", "日本", "👍", "'s", "'re", "don't", "it'S", "<|endoftext|>", ".", ",", "!?", ":;", "a", "Zb", "42", "½", "#", "\x00"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(0, 40))) for _ in range(3000)]
    texts += ["", None, "word " * 2000, " lead and trail \n\n", "x\ny", "x \ny", "x\n y", "z" * 20_000, "a.b,c. d.\nE"]
    texts += [chr(c) + " " + chr(c) + "\n" + chr(c) + "." + chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    ids, sizes = coder.encode(pa.array(texts), 2)
    want = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [x for w in want for x in w]
    for at in (0, 7, 3001):
        again, n = coder.encode(pa.array(texts).slice(at, 50), 2)  # now from memory, out of a slice
        assert again.tolist() == [x for w in want[at : at + 50] for x in w] and n.tolist() == [len(w) for w in want[at : at + 50]]


def test_files_hold_equal_sequences_and_masks(spark, tokenizer, tmp_path):
    path, library = tokenizer
    rng = random.Random(5)
    texts = {i: " ".join(rng.choice(["one", "two", "drei", "été", "x."]) for _ in range(rng.randrange(0, 300))) for i in rng.sample(range(-500, 5000), 400)}
    texts[17] = "long " * 40_000
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    folder = token_files.written(docs, path, 2, folder=str(tmp_path / "tokens"), length=64, part_ids=20_000)
    parts = token_files.manifest(spark, folder).orderBy("place").collect()
    whole = [x for i in sorted(texts) for x in [*library.encode(texts[i], add_special_tokens=False).ids, 2]]
    assert len(parts) > 1 and [p.start for p in parts] == np.cumsum([0, *(p.n_tokens for p in parts)])[:-1].tolist()
    seen = []
    for p in parts:
        file = token_files.Sequences(p.path)
        assert p.n_sequences == -(-p.n_tokens // 64)
        for k in random.Random(1).sample(range(p.n_sequences), p.n_sequences):  # in any order
            ids, mask = file[k]
            n = min(64, p.n_tokens - 64 * k)
            assert len(ids) == 64 and mask.to_numpy(zero_copy_only=False).tolist() == [j < n for j in range(64)]
            assert ids[:n].tolist() == whole[p.start + 64 * k :][:n] and not ids[n:].any()
            assert not ids.flags.owndata and not ids.flags.writeable  # a view of the mapped file
        with pytest.raises(IndexError):
            file[p.n_sequences]
        batches = list(pa.ipc.open_stream(p.path))  # plain Arrow for every other reader
        assert {b.num_rows for b in batches[:-1]} <= {token_files.BATCH}
        seen += [x for b in batches for s, m in zip(*(c.to_pylist() for c in b.columns), strict=True) for x, y in zip(s, m, strict=True) if y]
    assert seen == whole
    got = token_files.documents(spark, folder).orderBy("start").collect()
    assert [g.doc_id for g in got] == sorted(texts)
    at = 0
    for g in got:
        ids = np.frombuffer(g.ids, "<u4").tolist()
        assert ids == [*library.encode(texts[g.doc_id], add_special_tokens=False).ids, 2] and (g.start, g.n_tokens) == (at, len(ids))
        at += len(ids)


def test_token_files_of_odd_rows(spark, tokenizer):
    path, library = tokenizer
    rows = [(None, "null id", 1), (1, None, 2), (1, None, 3), (1, "b", 4), (2, "", 5), (2, "a b", 6), (2, "a b", 7), (-9, "x " * 5000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").withColumns({c: F.lit("mine") for c in ("id", "ids", "n_tokens", "place", "path")})
    got = token_files.documents(spark, token_files.written(docs, path, 2)).orderBy("start").collect()
    assert [g.doc_id for g in got] == [None, -9, 1, 1, 1, 2, 2, 2]
    assert sorted(g.ids for g in got) == sorted(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t, _ in rows)
    assert [g.start for g in got] == np.cumsum([0, *(g.n_tokens for g in got)])[:-1].tolist()
    assert token_files.documents(spark, token_files.written(docs.where("doc_id = 77"), path, 2)).collect() == []
    named = spark.createDataFrame([("b", "x"), ("a", "y")], "name string, body string")
    assert [r.name for r in token_files.documents(spark, token_files.written(named, path, 2, id_col="name", text_col="body"), "name").orderBy("start").collect()] == ["a", "b"]


def test_parts_that_are_left_over_are_not_read(spark, tokenizer, tmp_path, monkeypatch):
    """Files of attempts that Spark did not take stay out of the manifest, and parts follow each other within a task."""
    path, _ = tokenizer
    folder = token_files.written(spark.range(50).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text")), path, 2, folder=str(tmp_path / "t"))
    (tmp_path / "t" / "parts" / "part-000000-0000-9-dead.arrows").write_bytes(b"half a file")
    assert token_files.documents(spark, folder).agg(F.sum("n_tokens")).first()[0] == 200


# trie


def brute_trie(convs):
    """Nodes by definition; convs: {conv_id: [(role, text), ...]}."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    nodes = {}
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaf = lambda q: not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)
        ends = sorted(c for c in m if len(convs[c]) == len(p))
        nodes[min(m), len(p)] = (
            min(members[p[:-1]]) if p else None, len(m), sum(len(q) == len(p) + 1 for q in below), sum(map(leaf, below)),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return nodes


def rows_of(convs):
    return [(c, k, role, text) for c, turns in convs.items() for k, (role, text) in enumerate(turns)]


def as_nodes(df):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()}


@pytest.mark.parametrize("local", [0, 12, 10**6])
def test_trie_equals_brute_force(spark, local, monkeypatch):
    monkeypatch.setattr(trie, "COPIES", 5)
    monkeypatch.setattr("attestry.llm.spark.HOT", 4)
    rng = random.Random(2)
    convs = {c: [(rng.choice(["user", "assistant"]), rng.choice(["a", "bé", ""])) for _ in range(rng.randrange(1, 7))] for c in rng.sample(range(-200, 2000), 150)}
    for c in range(3000, 3040):
        convs[c] = [("user", "hi"), ("assistant", "hé")] * 3 + [("user", f"t{k}") for k in range(3)][: c % 4]
    convs[4000] = [("user", "hi")] * 60
    convs[4001] = [("user", "hi")] * 60 + [("user", "more")]
    got = trie.nodes(trie.sequences(spark.createDataFrame(rows_of(convs), TURNS).repartition(4)), local)
    assert got.count() == len(as_nodes(got))
    assert as_nodes(got) == brute_trie(convs)


def test_trie_of_rebuilt_conversations(spark):
    rng = random.Random(8)
    plain = {c: [("user", f"{rng.randrange(3)}") for _ in range(rng.randrange(1, 12))] for c in range(200) if c % 7}
    want = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = plain.get(c - c % 5, [])[:h] + own[h:]
    got = trie.nodes(queries.rebuilt(trie.sequences(spark.createDataFrame(rows_of(plain), TURNS))))
    assert any(not t for t in want.values()) and as_nodes(got) == brute_trie(want)


def test_trie_of_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (1, None, "user", None), (1, 0, None, "é"), (1, 0, None, "é"), (2, None, "user", ""), (2, 5, "", "é"), (3, 1, "u", "ser")]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("mine") for c in ("keys", "sizes", "node", "depth", "whole")})
    want = brute_trie({1: [("user", ""), ("", "é"), ("", "é")], 2: [("user", ""), ("", "é")], 3: [("u", "ser")]})
    for local in (0, 100):
        assert as_nodes(trie.nodes(trie.sequences(df), local)) == want
    assert trie.nodes(trie.sequences(df.where("conv_id = 9"))).collect() == []
    assert as_nodes(trie.nodes(trie.sequences(df.where("conv_id = 3")))) == brute_trie({3: [("u", "ser")]})
    deep = {c: [("user", str(k)) for k in range(3000)] + [("user", f"end {c}")] for c in (1, 2)}
    assert len(as_nodes(trie.nodes(trie.sequences(spark.createDataFrame(rows_of(deep), TURNS)), 10**6))) == 3001 + 2
    long = {1: [("user", "y" * 400_000)], 2: [("user", "y" * 400_000)]}
    assert as_nodes(trie.nodes(trie.sequences(spark.createDataFrame(rows_of(long), TURNS)))) == brute_trie(long)


def test_digest_of_very_many_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "COPIES", 10)
    copies = spark.range(5000).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hi").alias("text"))
    got = as_nodes(trie.nodes(trie.sequences(copies)))
    assert got[0, 1][5] == hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest() and got[0, 1][1] == 5000


# repair

FOLLOWS = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
WHITE = " \t\n\x0b\x0c\r"


def brute_repair(rows):
    """Faults and the cheapest edits of (role, text) rows by uniform-cost search over whole edit strings."""
    faults, seen = [], set()
    for role, text in rows:
        bare = text.strip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return faults, cost, audit, list(out)
        if (i, state) in done:
            continue
        done.add((i, state))
        new = "assistant" if state == 2 else "user"
        push = lambda c, letter, j, s, o: heapq.heappush(heap, (cost + c, audit + letter, j, s, o))
        push(3, "I", i, FOLLOWS[state][new[0]], (*out, (new, "")))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            push(4, "D", i + 1, state, out)
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                if role[:1] in FOLLOWS[state]:
                    push(extra, "K", i + 1, FOLLOWS[state][role[0]], (*out, rows[i]))
                push(3 + extra, "R", i + 1, FOLLOWS[state][new[0]], (*out, (new, text)))
    raise AssertionError


def random_turns(rng, n):
    roles = ["user", "assistant", "system", "tool", "", " ", "User", "ux"]
    texts = ["Yes.", "no", "", " \n", "Wait!", "What?", "ok .", "ok. \t", "é.", "A.\n", "…"]
    return [(rng.choice(roles[: rng.choice([2, 3, 8])]), rng.choice(texts) + rng.choice(["", "", "x."]) * rng.randrange(2)) for _ in range(n)]


def test_repair_equals_search(spark):
    rng = random.Random(6)
    convs = {c: random_turns(rng, rng.choice([1, 2, 3, 4, 5, 8, 13])) for c in range(400)}
    convs[1000] = random_turns(rng, 300)
    got = {r.conv_id: r for r in repair.repaired(spark.createDataFrame(rows_of(convs), TURNS).repartition(3), chunk=50).collect()}
    assert got.keys() == convs.keys()
    for c, rows in convs.items():
        faults, cost, audit, out = brute_repair(rows)
        r = got[c]
        assert (r.cost, r.audit, [tuple(x) for x in r.repaired]) == (cost, audit, out), (c, rows)
        assert (r.blank, r.duplicate, r.truncated) == tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
        assert r.illegal == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)) and r.gaps == 0
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[:1] for x in r.repaired))


def test_repair_of_odd_rows(spark):
    rows = [(None, 3, "user", "Hi."), (None, None, "assistant", "Yes."), (1, 9, None, None), (1, 2, "user", "Go."), (1, 2, "user", "Go."), (1, 5, "assistant", "So"), (2, None, "user", "A."), (2, None, "assistant", "B.")]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("mine") for c in ("key", "present", "code", "blank", "truncated", "cost")})
    got = {r.conv_id: r for r in repair.repaired(df).collect()}
    assert got.keys() == {None, 1, 2}
    for c, given in ((None, [("assistant", "Yes."), ("user", "Hi.")]), (2, [("assistant", "B."), ("user", "A.")])):
        _, cost, audit, out = brute_repair(given)
        assert (got[c].cost, got[c].audit, [tuple(x) for x in got[c].repaired], got[c].gaps) == (cost, audit, out, 0)
    assert (got[1].gaps, got[1].blank, got[1].duplicate, got[1].truncated, got[1].audit) == (5, 1, 1, 1, "KDKD")
    assert repair.repaired(df.where("conv_id = 7")).collect() == []
    gone = repair.repaired(spark.createDataFrame([(5, 0, "user", "x.", False), (5, 1, "user", "x.", None)], TURNS + ", here boolean"), present_col="here").first()
    assert (gone.conv_id, gone.cost, gone.audit, gone.repaired, gone.gaps) == (5, 0, "", [], 0)
    long = repair.repaired(spark.createDataFrame([(1, 0, "user", "w" * 500_000), (1, 1, "assistant", "w" * 500_000 + ".")], TURNS)).first()
    assert (long.audit, long.cost, len(long.repaired[0].text)) == ("KK", 3, 500_000)


def test_repair_of_a_very_long_conversation(spark):
    n = 20_000
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 2, "user").otherwise(F.when(F.col("id") % 3 == 0, "user").otherwise("assistant")).alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    r = repair.repaired(turns).first()
    rows = [("assistant" if k % 3 == 1 else "user", f"{k}.") for k in range(n)]
    _, cost, audit, out = brute_repair(rows)
    assert (r.cost, r.audit, len(r.repaired)) == (cost, audit, len(out))


def test_damage_by_id_and_turn(spark):
    rows = [(c, t, "assistant", f"One. Two? {c}!") for c in range(40) for t in (0, 1, None)]
    got = [tuple(r)[:5] for r in queries.damaged(spark.createDataFrame(rows, TURNS)).collect()]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text, kind != 0)
        want += [row] * (2 if kind == 3 else 1)
    key = lambda r: (r[0], -1 if r[1] is None else r[1])
    assert sorted(got, key=key) == sorted(want, key=key)
