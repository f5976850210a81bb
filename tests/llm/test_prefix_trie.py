"""op13 against a trie built edge by edge, and its SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from arrivals.llm import prefix_trie
from arrivals.llm.oracle import ORACLE_SQL
from arrivals.llm.prefix_trie import ranked, rebuilt_trie
from tests.oracle_util import duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        seq = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(list)
    for seq in members:
        if seq:
            children[seq[:-1]].append(seq)

    def below(seq):
        yield seq
        for child in children[seq]:
            yield from below(child)

    out = []
    for seq, ids in members.items():
        subtree = list(below(seq))
        out.append((
            min(ids), len(seq), min(members[seq[:-1]]) if seq else None, len(ids), len(children[seq]),
            sum(not children[s] for s in subtree),
            sum((len(members[s]) - 1) * len(WORD.findall(s[-1][1])) for s in subtree if s),
            hashlib.sha256(",".join(map(str, sorted(ends[seq]))).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def odd_rows(seed=3, n=150):
    """Copies, shared heads, conversations without turns of their own, ties, nulls, gaps and one long conversation."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(0, 400), n):
        for turn in range(rng.choice((1, 1, 2, 3, 4, 6))):
            text = "hot first turn" if turn == 0 else f"word {rng.randint(0, 2)} " * rng.randint(0, 2)
            rows.append((conv, turn, rng.choice(("user", "assistant")) if turn else "user", text))
    rows += [(500 + i, t, "user", f"the same turn {t}") for i in range(60) for t in range(5)]
    rows += [(999, t, "user", f"long {t}") for t in range(40)] + [(1000, t, "user", f"long {t}") for t in range(40)]
    rows += [(700, None, None, None), (700, 1, "", ""), (700, 1, "a", "tie"), (700, 1, "b", "tie"), (700, 1, "b", "tie"),
             (-5, 0, "user", "below"), (-20, 0, "user", "zero"), (-20, 7, "user", "zero"), (None, 0, "user", "no id"),
             (None, None, None, None), (820, 0, "user", ""), (820, 1, None, "x " * 3000), (821, 0, "user", None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks and runs so small that long conversations and lists of ends cross many of them."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "RUN", 4)


def test_equals_a_trie_built_by_edges(spark):
    rows = odd_rows()
    assert result(rebuilt_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_blocks_and_runs_do_not_matter(spark, small_blocks):
    rows = odd_rows(5, 60)
    assert result(rebuilt_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "only turn") for c in range(1, 40)]  # base 0 is absent, base 20 has one turn
    nodes = result(rebuilt_trie(spark.createDataFrame(rows, SCHEMA)))
    assert nodes == brute(rows)
    assert nodes[0][:4] == (1, 0, None, 39)


def test_empty_table_and_clashing_columns(spark):
    assert rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = odd_rows(8, 20)
    wide = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA + ", depth int, pos string, part string")
    assert result(rebuilt_trie(wide)) == brute(rows)


def test_ranks_split_a_hot_key_over_partitions(spark):
    """One key holds nearly all rows, half of them identical: ranks run on across partitions."""
    rows = [(7, i % 500 if i % 2 else 1) for i in range(4000)] + [(8, i) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(8)
    got = ranked(df, ["k"], ["v"]).collect()
    by_key = defaultdict(list)
    for r in got:
        by_key[r.k].append((r.pos, r.v))
    for k, pairs in by_key.items():
        pairs.sort()
        assert [p for p, _ in pairs] == list(range(1, len(pairs) + 1))
        assert [v for _, v in pairs] == sorted(v for kk, v in rows if kk == k)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql_agrees(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    con = duck(sf_dir)
    cur = con.execute(ORACLE_SQL["op13_prefix_trie"])
    names = [d[0] for d in cur.description]
    want = sorted((tuple(r[names.index(c)] for c in COLUMNS) for r in cur.fetchall()), key=str)
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert result(rebuilt_trie(turns)) == want
    assert want == brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
