import hashlib
import random
import zlib

from pyspark.sql import functions as F

from reelframe.llm import trie
from tests.llm.util import SF

SCHEMA = "conv_id long, turn int, role string, text string, node string, parent long, words int"


def brute(rows):
    """Node rows of the trie, by dictionaries."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], []).append((c, len(seq)))
    out = {}
    for seq, members in sorted(nodes.items(), key=lambda x: -len(x[0])):
        ends = ",".join(str(c) for c, size in sorted(members) if size == len(seq))
        words = len(seq[-1][1].split()) if seq else 0
        out[seq] = [min(members)[0], len(seq), min(nodes[seq[:-1]])[0] if seq else None, len(members), 0, 0,
                    (len(members) - 1) * words, hashlib.sha256(ends.encode()).hexdigest()]
    for seq in sorted(out, key=len, reverse=True):
        node = out[seq]
        node[5] = node[5] or 1
        if seq:
            up = out[seq[:-1]]
            up[4] += 1
            up[5] += node[5]
            up[6] += node[6]
    return sorted(tuple(x) for x in out.values())


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


def test_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = []
    for c in range(100, 160):
        if c % 20 != 0 or c == 140:
            for turn in rnd.sample([None, 0, 1, 2, 3, 4, 9], rnd.randint(1, 7)):
                rows.append((c, turn, rnd.choice(["user", "assistant", None]), rnd.choice(["a b", "a", "", None, "c  d\te"]),
                             "x", 1, 2))
    rows += [(141, 3, "user", "same", "n", 1, 1)] * 3 + [(None, 1, "user", "lost", "n", 1, 1)]
    got = nodes(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == [x for x in sorted(brute(rows), key=lambda r: (r[0], r[1]))]
    assert any(r[7] != hashlib.sha256(b"").hexdigest() and r[1] == 0 for r in got)  # turnless conversations


def test_long_chain_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 7)
    deep = [(1, t, "user", f"t{t} x", "n", 1, 1) for t in range(60)]
    copies = [(20 * c, t, "user", f"common {t}", "n", 1, 1) for c in range(2, 130) for t in range(3)]
    rows = deep + copies
    got = nodes(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == sorted(brute(rows), key=lambda r: (r[0], r[1]))


def test_subtree_sums_of_random_trees(spark):
    rnd = random.Random(9)
    for shape in (lambda i: rnd.randrange(i), lambda i: i - 1, lambda i: max(0, i - rnd.choice([1, 1, 1, 30]))):
        parent = {0: None, **{i: shape(i) for i in range(1, 120)}}
        kids = {i: sum(p == i for p in parent.values()) for i in parent}
        want = {i: i * i for i in parent}
        for i in range(119, 0, -1):
            want[parent[i]] += want[i]
        df = spark.createDataFrame([(i, p, kids[i], i * i) for i, p in parent.items()],
                                   "node long, parent long, kids long, w long")
        out = trie.subtree_sums(df, ["w"]).collect()
        assert len(out) == 120 and {r.node: r.w for r in out} == want


def test_ends_over_several_ranges(spark):
    ids = [-5, 0, 7, 4095, 4096, 9000, 123456]
    df = spark.createDataFrame([(1, 0, i) for i in reversed(ids)], "conv_id long, depth long, member long")
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert [tuple(r) for r in trie._ends(df).collect()] == [(1, 0, want)]


def test_empty_table_and_whole_query(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    out = trie.op11_trie(spark, SF)
    assert nodes(out) == sorted(brute(rows), key=lambda r: (r[0], r[1]))
    assert out.agg(F.count_if(F.col("depth") == 0)).first()[0] == 1
