import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lodestone.llm import substrings


def brute(rows, n=200):
    seen = Counter()
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, b in data:
        seen.update(b[i : i + n] for i in range(len(b) - n + 1))
    out = []
    for doc, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("many", [4096, 1])
def test_equals_brute_force(docs, rows, many):
    got = sorted((tuple(r) for r in substrings.strip(docs, many=many).collect()), key=str)
    assert got == brute(rows)


def test_unlike_texts_of_one_doc_id(spark):
    r = random.Random(6)
    a, b, c = ("".join(r.choice("abcdefgh ") for _ in range(n)) for n in (400, 900, 300))
    table = [(1, a), (1, b), (2, "x" + a[50:350]), (3, b[100:700] + c), (None, c), (None, c + "z"), (4, a), (4, a)]
    got = sorted((tuple(x) for x in substrings.strip(spark.createDataFrame(table, "doc_id long, text string")).collect()), key=str)
    assert got == brute(table)


def test_windows_by_their_bytes_agree():
    r = random.Random(9)
    base = bytes(r.choice(b"abcd") for _ in range(500))
    pieces = [base[10:300], base[20:280], base[100:400], base[10:300], bytes(r.choice(b"ab") for _ in range(260))]
    data = b"".join(pieces)
    off = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    m, _, start, count = substrings.runs(np.frombuffer(data, np.uint8), off)
    order = np.argsort(m, kind="stable")
    cut = [data[start[i] : start[i] + count[i] + 199] for i in order]
    assert (substrings.repeated(cut, m[order], count[order]) == substrings.by_bytes(cut, m[order], count[order])).all()


def test_kept_bytes(docs):
    for r in substrings.strip(docs, with_text=True).collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed


def test_empty_table(nothing):
    assert substrings.strip(nothing).collect() == []


def test_suffix_sort_and_extensions():
    r = random.Random(3)
    text = bytes(r.choice(b"ab") for _ in range(3000))
    pool = substrings.Pool([text])
    place = np.array(sorted(r.sample(range(2800), 500)))
    room = np.minimum(len(text) - place, 200)
    order = pool.sort(place, room, np.zeros(500, np.int64))
    assert [text[p : p + 200] for p in place[order]] == sorted(text[p : p + 200] for p in place)
    x, y = place[:-1], place[1:]
    n = pool.extension(x, y, np.minimum(room[:-1], room[1:]))
    for a, b, k, m in zip(x, y, n, np.minimum(room[:-1], room[1:])):
        assert text[a : a + k] == text[b : b + k] and (k == m or text[a + k] != text[b + k])
    assert pool.verified(x, y, n) and not pool.verified(x, y, n + 1)
