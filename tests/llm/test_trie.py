import hashlib
import random
import re
import zlib

import pytest

from gtfsforge.llm import prefix_trie as module
from gtfsforge.llm.prefix_trie import prefix_trie
from gtfsforge.llm.queries_conversations import SQL_TRIE, op11_prefix_trie
from gtfsforge.llm.timeforward import SpillingQueue

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    """Every prefix of every conversation, member by member."""
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    full = {}
    for c, t in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = convs.get(base, [])[:h] + t[h:]
    members = {}
    for c, t in full.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    total = {k: [0, 0, 0] for k in members}
    for k, m in members.items():
        gain = (len(m) - 1) * len(re.findall("[^ \t\n\x0b\x0c\r]+", k[-1][1])) if k else 0
        leaf = all(len(full[c]) == len(k) for c in m)
        for d in range(len(k) + 1):
            total[k[:d]][1] += leaf
            total[k[:d]][2] += gain
        if k:
            total[k[:-1]][0] += 1
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), *total[k], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(full[c]) == len(k)).encode()).hexdigest())
        for k, m in members.items()
    )


def got(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def odd_rows():
    rng = random.Random(1)
    rows = []
    for c in [*range(140), *range(1000, 1400, 7), -1, -5, -20, -25]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "", None, "d\te  f", "g"])))
    rows += [(2000 + i, t, "user", f"same {t}") for i in range(200) for t in range(3)]  # equal conversations
    rows += [(3000, i, "user", f"t {i}") for i in range(160)] + [(3001, i, "user", f"t {i}") for i in range(150)]  # long ones that share
    rows += [(3002, None, "user", "n"), (3002, 0, "user", "z"), (3002, 0, "user", "z"), (3002, 0, "assistant", "y"), (3002, None, None, "m"), (3002, -4, "user", None)]
    rows += [(None, 0, "user", "none"), (3003, 0, "user", "long " * 60_000), (3004, 0, "user", "x" * 256 + "b"), (3004, 1, "user", "x" * 256 + "a")]
    return rows


@pytest.mark.parametrize("shard,in_memory", [(None, 200_000), (1, 5), (7, 20), (10**6, 3)])
def test_by_hand(spark, shard, in_memory):
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(6)
    assert got(prefix_trie(df, shard=shard, in_memory=in_memory)) == by_hand(odd_rows())


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_NODES", 0)
    monkeypatch.setattr(module, "CHUNK", 10)
    rows = [r for r in odd_rows() if r[0] is None or r[0] < 3000 or r[0] > 3001]
    assert got(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)


def test_against_sql(spark, against_sql, sf):
    rows = [r for r in odd_rows() if r[0] is None or r[0] < 3000]
    for df in (spark.createDataFrame(rows, SCHEMA), spark.read.parquet(f"{sf}/conversations.parquet")):
        mine, sql = against_sql(spark, op11_prefix_trie, SQL_TRIE, conversations=df)
        assert mine == sql and len(mine) > 50


def test_empty_turnless_and_clashing_names(spark):
    assert got(prefix_trie(spark.createDataFrame([], SCHEMA))) == []
    turnless = next(c for c in range(21, 99) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(turnless, 0, "user", "gone"), (turnless, 1, "user", "gone too")]
    assert got(prefix_trie(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)
    named = spark.createDataFrame([(*r, 1, 2, "x") for r in odd_rows()[:60]], SCHEMA + ", rank long, n long, ka string")
    assert got(prefix_trie(named)) == by_hand(odd_rows()[:60])


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    queue, waiting = SpillingQueue(10), []
    for level in range(-40, 0):
        now = sorted(x for x in waiting if x[0] == level)
        waiting = [x for x in waiting if x[0] != level]
        found = [x for a in sorted({x[:3] for x in now}) for x in sorted(queue.pop_for(a))]
        assert found == now
        for _ in range(60):
            r = (level + 1, rng.randint(-9, 9), 0, 1, rng.randint(0, 2**62), -5)
            waiting.append(r)
            queue.push(r)
    assert queue.spilled > 1000
