"""op11: the trie of rebuilt conversations against a dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from martkit.llm import prefix_trie as P
from martkit.llm.prefix_trie import (SpillingQueue, numbered, op11_prefix_trie, prefix_trie,
                                     rebuilt, subtree_totals)

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    """The contract, with every prefix held whole."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    seqs = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, seq in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(seqs.get(c - c % 5, [])[:h] + seq[h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def below(node):
        out, todo = [], [node]
        while todo:
            out.append(todo.pop())
            todo += kids.get(out[-1], [])
        return out

    want = set()
    for node, convs in members.items():
        sub = below(node)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        want.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                  len(kids.get(node, [])), sum(n not in kids for n in sub),
                  sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in sub if n),
                  hashlib.sha256(ends.encode()).hexdigest()))
    return want


def conversations(seed, n=60, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]),
                         rng.choice(["a", "é", "", None, "long text"])))
    rows += [(None, 0, "user", "nobody"), (10_000, 0, "user", "alone"), (10_000, 0, "user", "alone")]
    rng.shuffle(rows)
    return rows


def got(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("shard_rows,queue_rows", [(200_000, 100_000), (15, 3)])
def test_trie_equals_brute_force(spark, shard_rows, queue_rows):
    rows = conversations(1)
    df = spark.createDataFrame(rows, SCHEMA)
    out = prefix_trie(*rebuilt(numbered(df)), shard_rows=shard_rows, queue_rows=queue_rows)
    assert out.columns == list(COLUMNS)
    assert got(out) == expected(rows)


def test_one_long_and_one_common_conversation(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 16)
    rows = [(0, t, "user", f"t{t % 7}") for t in range(400)]
    rows += [(c, t, "user", f"t{t}") for c in range(5, 60) for t in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = prefix_trie(*rebuilt(numbered(df)), shard_rows=60, queue_rows=5)
    assert got(out) == expected(rows)


def test_turnless_conversations_end_at_the_root(spark):
    # 16: crc32 mod 9 > 0 and no leading conversation, so a single own turn is left out
    ids = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:6]
    rows = [(c, 0, "user", "x") for c in ids]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(prefix_trie(*rebuilt(numbered(df)))) == expected(rows)


def test_empty_table_has_no_nodes(spark):
    assert prefix_trie(*rebuilt(numbered(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_clashing_columns_are_not_read(spark):
    rows = conversations(2, n=12)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", DEPTH string, idx long")
    assert got(prefix_trie(*rebuilt(numbered(df)))) == expected(rows)


def test_subtree_totals_of_random_trees(spark):
    rng = random.Random(9)
    keys = [(0, 0)]
    parent = {(0, 0): None}
    for conv in range(300):  # chains below random nodes of smaller owners
        at = rng.choice([k for k in keys if k[0] <= conv])
        for depth in range(at[1] + 1, at[1] + rng.randint(1, 4)):
            if (conv, depth) in parent:
                break
            parent[conv, depth] = at
            at = (conv, depth)
            keys.append(at)
    rows = [(c, d, *(parent[c, d] or (None, None)), rng.randint(0, 2), rng.randint(0, 9))
            for c, d in keys]
    want = {k: [0, r[4], r[5]] for k, r in zip(keys, rows)}
    for k in sorted(keys, key=lambda k: -k[1]):
        if parent[k]:
            up = want[parent[k]]
            up[0] += 1
            up[1] += want[k][1]
            up[2] += want[k][2]
    df = spark.createDataFrame(rows, "conv long, depth long, pconv long, pdepth long, "
                                     "leaves long, saved long")
    for shard_rows in (10, 100, 10_000):
        out = subtree_totals(df, shard_rows=shard_rows, queue_rows=4).collect()
        assert {(r[0], r[1]): list(r[2:]) for r in out} == want


def test_queue_spills_and_gives_messages_in_order():
    rng = random.Random(2)
    sent = [(rng.randint(-9, 0), rng.randint(0, 9), i) for i in range(500)]
    queue = SpillingQueue(limit=7)
    for m in sent:
        queue.push(m)
    assert queue.spills > 50
    for key in sorted({m[:2] for m in sent}):
        assert sorted(queue.take(key)) == sorted(m for m in sent if m[:2] == key)


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_prefix_trie(spark, sf)) == expected(rows)
