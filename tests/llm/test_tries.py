"""Prefix trie of conversations against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsift.llm import queries, tries

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rebuilt(rows):
    """Sequences of (role, text) by conversation, with the heads of the query."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    # Turns of the same number come by digest.
    key = lambda t: (t[0], t[1], sha(f"{len(t[2].encode())}:{t[2]}{t[3]}"))
    own = {c: [t[2:] for t in sorted(turns, key=key)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - int(np.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences):
    members = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    below = lambda p: [q for q in members if q[:len(p)] == p]
    parents = [q[:-1] for q in members if q]
    rows = []
    for p, ids in members.items():
        subtree = below(p)
        ends = sorted(c for c in ids if len(sequences[c]) == len(p))
        rows.append((
            min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), parents.count(p),
            sum(q not in parents for q in subtree),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in subtree if q), sha(",".join(map(str, ends)))))
    return sorted(rows, key=repr)


def computed(spark, rows, piece_rows=tries.PIECE_ROWS):
    turns = tries.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    trie = tries.prefix_trie(*tries.rebuilt_from_heads(turns, heads), piece_rows)
    assert trie.columns == tries.NODE
    return sorted([tuple(r) for r in trie.collect()], key=repr)


def some(seed, conversations=60, longest=14):
    """Few different texts, so that beginnings are shared; copies, odd ids, nulls and ties."""
    rng, rows = random.Random(seed), []
    for c in range(conversations):
        if rng.random() < 0.2:
            continue
        cid = rng.choice([c, -c, 7 * c])
        n, few = rng.randrange(1, longest), rng.random() < 0.7
        for t in range(n):
            rows.append((cid, rng.choice([t, t, t, None, 3]), rng.choice(["user", "user", None]),
                         rng.choice(["a", "é"]) if few else rng.choice(["", None, "x" * rng.randrange(5), "ö"])))
    copy = [r for r in rows if r[0] == rows[0][0]]
    return rows + [(1000 + 5 * i, *r[1:]) for i in range(9) for r in copy] + [(None, 0, "user", "lost")]


@pytest.mark.parametrize("seed, piece_rows", [(1, tries.PIECE_ROWS), (2, 1), (3, 3), (4, 7)])
def test_trie_equals_brute_force(spark, seed, piece_rows):
    rows = some(seed)
    assert computed(spark, rows, piece_rows) == brute(rebuilt(rows))


def test_long_conversations_share_only_their_beginning(spark):
    rows = [(c, t, "user", f"turn {t}" if t < 5 + c // 5 else f"{c} {t}") for c in (0, 5, 10, 15, 20) for t in range(200)]
    assert computed(spark, rows, 2) == brute(rebuilt(rows))


def test_conversations_without_turns_end_at_the_root(spark):
    turnless = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 9 == 8 and c % 5][:3]
    rows = [(c, 0, "user", "x") for c in turnless]  # their base is absent and the head covers all they have
    assert computed(spark, rows) == [(min(turnless), 0, None, 3, 0, 1, 0, sha(",".join(map(str, turnless))))]


def test_no_conversations(spark):
    assert computed(spark, []) == [] == computed(spark, [(None, 1, "user", "x")])


def test_a_hot_beginning_is_split_over_pieces(spark):
    rows = [(5 * c, t, "user", "same" if t < 3 or c % 3 else f"own {c}") for c in range(300) for t in range(5)]
    assert computed(spark, rows, 16) == brute(rebuilt(rows))


def test_reaches_equal_plain_scans():
    rng = np.random.RandomState(3)
    common = rng.randint(0, 6, 200)
    common[0] = -1
    table = tries.range_minima(common)
    row, depth = rng.randint(0, 200, 500), rng.randint(0, 6, 500)
    hi, lo = tries.reach_right(table, row, depth), tries.reach_left(table, row, depth)
    for i, d, a, b in zip(row, depth, lo, hi):
        x = y = int(i)
        while y + 1 < 200 and common[y + 1] >= d:
            y += 1
        while x > 0 and common[x] >= d:
            x -= 1
        assert (a, b) == (x, y)
    assert [tries.least_between(table, np.array([a]), np.array([b]))[0] for a, b in ((0, 9), (5, 5), (17, 180))] == [
        common[:10].min(), common[5], common[17:181].min()]


def test_query_reads_tables_with_other_columns(spark, tmp_path):
    rows = some(9)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("digest", "n", "bytes", "pos", "full", "h")})
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_conversation_trie(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rebuilt(rows))
