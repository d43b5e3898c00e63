"""The conversation trie against a trie of Python dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

from pulsefold.llm import conversations
from pulsefold.llm.queries import QUERIES

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - c % 5, [])[:h] + seq[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                children[whole[:d - 1]].add(whole[:d])
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) if children[p] else 1
        saved[p] = sum(saved[c] for c in children[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def result(df):
    rows = df.collect()
    assert tuple(df.columns) == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


def made_up(seed):
    draw = random.Random(seed)
    say = lambda: (draw.choice(["user", "assistant", None]), draw.choice(["", "a", "bé", "ccc", None]))
    rows = []
    for c in draw.sample(range(400), 150):
        n = draw.choice([0, 1, 2, 3, 5, 8, 12, 40])
        rows += [(c, t, *say()) for t in range(n)]
    rows += [(c, t, "user", "same") for c in range(1000, 1400) for t in range(2)]
    rows += [(2000, None, "user", "first"), (2000, 0, "user", "second"), (2000, 0, "user", "second"), (2001, None, None, None), (None, 0, "user", "lost")]
    rows += [(3005, t, "user", "long") for t in range(700)] + [(3010, t, "user", "long") for t in range(699)]
    draw.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark, frame):
    for seed in (1, 2):
        rows = made_up(seed)
        df = frame("conv_id long, turn long, role string, text string, key string, head int", *[(*r, "x", 1) for r in rows])
        want = brute_trie(rows)
        for settings in (conversations.Settings(), conversations.Settings(shard_turns=40, merge_shards=2, block_ids=3)):
            assert result(conversations.trie(df, settings)) == want


def test_small_tables(spark, frame):
    schema = "conv_id int, turn int, role string, text string"
    assert conversations.trie(frame(schema)).count() == 0
    # 7 takes its first turns from 5, which is not there, and loses as many of its own (crc32 of "7" leaves 6).
    alone = result(conversations.trie(frame(schema, (7, 0, "user", "x"))))
    assert alone == brute_trie([(7, 0, "user", "x")])
    assert len(alone) == 1 and alone[0][:4] == (7, 0, -1, 1)


def test_tree_is_balanced_by_medians():
    tree = conversations.TernaryTree()
    for k in conversations.medians_first(1000):
        tree.insert([k], [1])
    assert sorted(conversations.medians_first(1000)) == list(range(1000))

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.down[0]) == 10


def test_query_on_the_smallest_table(spark, events_dir):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{events_dir}/conversations.parquet").collect()]
    assert result(QUERIES["op13_ternary_trie"](spark, events_dir)) == brute_trie(rows)
