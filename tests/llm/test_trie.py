import hashlib
import random
import re
import zlib

import duckdb
import pytest

from closeledger.llm import trie
from closeledger.llm.trie import oracle_sql, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, hi string, seq string, depth string, weight string"


def brute(rows):
    """Node rows of the rebuilt conversations, by whole prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for key, found in members.items():
        below = [k for k in members if k[: len(key)] == key]
        leaf = [k for k in below if not any(len(x) == len(k) + 1 and x[: len(k)] == k for x in below)]
        words = lambda k: len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        ends = sorted(c for c in found if len(built[c]) == len(key))
        out.append((
            min(found),
            len(key),
            min(members[key[:-1]]) if key else None,
            len(found),
            sum(len(k) == len(key) + 1 for k in below),
            len(leaf),
            sum((len(members[k]) - 1) * words(k) for k in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def found(spark, rows, parts=3):
    table = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in prefix_trie(*rebuilt(table)).collect()), key=repr)


def random_rows(seed, convs, longest):
    pick = random.Random(seed)
    texts = ["", None, "a", "a b", " \t", "long " * 50, "é ▁ x", "b\x0bc"]
    return [
        (c, None if pick.random() < 0.05 else t, pick.choice(["user", "bot", None]), pick.choice(texts[: pick.choice([2, 8])]))
        for c in pick.sample(range(0, 200), convs)
        for t in pick.sample(range(50), pick.randint(1, longest))
    ]


@pytest.mark.parametrize(("seed", "convs", "longest"), [(1, 30, 1), (2, 40, 5), (3, 20, 19), (4, 3, 33)])
def test_matches_brute_force(spark, seed, convs, longest):
    rows = [r for r in random_rows(seed, convs, longest)]
    assert found(spark, rows) == brute(rows)


def test_copies_powers_of_two_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BYTES", 16)
    monkeypatch.setattr(trie, "SPAN", 1)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 60) for t in range(16)]
    rows += [(c, t, "user", f"turn {t % 3}") for c in range(100, 104) for t in range(8)]
    assert found(spark, rows) == brute(rows)


def test_no_rows_null_ids_and_turnless(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lone, 0, "user", "x"), (None, 0, "user", "y")]
    assert found(spark, rows) == brute(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_sql_equals_brute_force():
    rows = random_rows(5, 60, 9)
    db = duckdb.connect()
    db.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert sorted(db.sql(oracle_sql()).fetchall(), key=repr) == brute(rows)


def test_query_matches_sql(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    got = trie.op11_prefix_trie(spark, sf)
    want = db.sql(oracle_sql())
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
