import hashlib
import random
import zlib

from pyspark.sql import functions as F

from lodestone.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, up long, digest string"
EXTRA = ("x", 1, 2, "y")


def brute(rows):
    """Nodes by whole prefixes, subtree sums by walking every prefix."""
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own.setdefault(c, []).append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        kids = lambda x: [q for q in members if len(q) == len(x) + 1 and q[:-1] == x]
        out.append((
            min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids(p)), sum(not kids(q) for q in under),
            sum((len(members[q]) - 1) * (len(q[-1][1].encode()) if q else 0) for q in under), hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == cols
    return sorted((tuple(r) for r in df.collect()), key=repr)


def conversations(r, n=60):
    pool = ["hello", "ça va", "yes", "no", "", "日本"]
    out = []
    for c in range(n):
        if c % 11 == 10:
            continue  # absent ones, bases among them
        for t in range(r.randrange(1, 9)):
            out.append((c, t, r.choice(["user", "assistant"]) if t > 1 else "user", "start" if t == 0 and c % 3 else r.choice(pool), *EXTRA))
    for c in range(200, 230):  # copies
        out += [(c, t, "user", f"same {t}", *EXTRA) for t in range(4)]
    return out


def test_equals_brute_force(spark):
    rows = conversations(random.Random(2))
    rows += [(300, None, None, None, *EXTRA), (300, 1, "user", "tie", *EXTRA), (300, 1, "user", "other", *EXTRA), (300, 1, "user", "tie", *EXTRA), (None, 0, "user", "lost", *EXTRA)]
    rows += [(-3, 0, "user", "minus", *EXTRA), (-5, 0, "user", "minus", *EXTRA), (2**40 + 1, 0, "user", "x" * 3000, *EXTRA), (301, 0, "us", "er", *EXTRA), (302, 0, "use", "r", *EXTRA)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(prefixtrie.trie(df)) == brute(rows)


def test_ladder_of_paths_and_long_conversation(spark):
    """Each conversation leaves the one before it a turn later, so that the tree of paths is as high as it gets."""
    rows = [(5 * c, t, "user", "step" if t < c else f"leaf {c}", *EXTRA) for c in range(40) for t in range(c + 1)]
    rows += [(1000, t, "user", f"{t % 7}", *EXTRA) for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(prefixtrie.trie(df)) == brute(rows)


def test_turnless_rebuilt_conversation_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 999) if c % 5 and prefixtrie.head(c) > 2)
    rows = [(c, 0, "user", "gone", *EXTRA), (c, 1, "user", "gone too", *EXTRA)]
    assert got(prefixtrie.trie(spark.createDataFrame(rows, SCHEMA))) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_pieces_of_ids_hash_as_one(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PIECE", 40)
    nodes = spark.range(500).select(F.unhex(F.lpad(F.hex(F.col("id") % 3), 32, "0")).alias("key"), F.array("id").alias("ends"))
    out = {bytes(r.key)[-1]: r.ends_sha256 for r in prefixtrie.ends_hashes(nodes).collect()}
    assert out == {k: hashlib.sha256(",".join(str(i) for i in range(500) if i % 3 == k).encode()).hexdigest() for k in range(3)}


def test_empty_table(spark):
    assert prefixtrie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
