"""Alignment, exact deduplication and the conversation trie against brute force on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqloom.llm import align, queries, radix, trie
from seqloom.llm.common import salted_join

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["a", "_id", "group", "slice", "row", "n", "_hash", "_row", "depth", "k1", "links", "pair", "next", "rest"]


def rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=str)


def crowd(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


def texts():
    rnd = random.Random(8)
    signs = list("aabcdehiorstn ABC  \n\t'.,-!0189éàßÉ  　​日本語😀▁<>|\x00\x1c\x85") + ["'s", "'ll", "<|endoftext|>", "<s>", "  ", " the", "ing"]
    found = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(50))) for _ in range(150)]
    prose = " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 9))) for _ in range(3000))
    return found + ["", None, " ", "  ", "\n", "▁", "x", "x ", prose, prose[:64], prose[:63], prose[:1088], prose[:1089], prose, prose[:-1], "z" * 5000, "z" * 5000, *[prose[:100]] * 40]


@pytest.fixture(scope="module")
def docs(spark):
    given = [(k // 2 * 2, t, "en", "s", None) for k, t in enumerate(texts())]  # two documents share an id
    given += [given[0], given[0], given[-1], (None, prose := given[-1][1], None, None, None), (None, prose, None, None, None), (None, "only without ids", None, None, None), (None, "only without ids", None, None, None)]
    return spark.createDataFrame(given, DOCS)


def test_pointer_jumping():
    import numpy as np

    a, b = np.array([3, 4, 9, 10, 12]), np.array([1, 5, 7, 9, 11, 12])
    assert align.groups(a, b).tolist() == [2, 2, 2, 4, 4, 2, 2, 2, 2, 4, 4]
    chain = np.minimum(np.arange(1000) + 1, 999)
    assert set(align.jump(chain).tolist()) == {999}
    assert list(zip(*(x.tolist() for x in align.overlaps(a, b)))) == [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (2, 3), (3, 4), (4, 4), (4, 5)]


def plain_alignment(text):
    """A ids, B ids, groups as text and all links, by the tokenizers and by looking at every pair."""
    both = align.aligner()
    if not text:
        return 0, 0, [], []
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    spelt_a, spelt_b = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
    if not b"".join(spelt_a) == (" " + text).encode() == b"".join(spelt_b):
        return 0, 0, [], []
    place = lambda spelt: [(sum(map(len, spelt[:i])), sum(map(len, spelt[: i + 1]))) for i in range(len(spelt))]
    at_a, at_b = place(spelt_a), place(spelt_b)
    links = [(x, y) for x, (s, e) in zip(a, at_a) for y, (u, v) in zip(b, at_b) if s < v and u < e]
    groups, begin = [], 0
    for end in sorted({e for _, e in at_a} & {e for _, e in at_b}):
        inside = lambda ids, at: ",".join(str(i) for i, (s, e) in zip(ids, at) if begin <= s and e <= end)  # noqa: B023, E731
        groups.append(inside(a, at_a) + "|" + inside(b, at_b))
        begin = end
    return len(a), len(b), groups, links


def brute_alignment(given):
    plain = {t: plain_alignment(t if t is None or len(t) < 2000 else t[:2000]) for _, t in given}
    count = Counter(p for _, t in given for p in set(plain[t][3]))
    highest = Counter()
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for i, t in given:
        n_a, n_b, groups, links = plain[t]
        said = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((i, n_a, n_b, len(groups), len(links), sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links), said))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment(spark, docs):
    short = docs.withColumn("text", F.substring("text", 1, 2000))
    given = [(r.doc_id, r.text) for r in short.collect()]
    want = brute_alignment(given)
    assert rows(align.align(crowd(short)), *COLUMNS) == want
    assert rows(align.align(short, frequent=40), *COLUMNS) == want  # most pairs come by the shuffle
    assert align.align(short.limit(0)).count() == 0


def test_alignment_of_whole_tables(spark):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 2000]
    frame = spark.createDataFrame(given, "doc_id long, text string")
    assert rows(align.align(frame), *COLUMNS) == brute_alignment(given)
    assert queries.op11_token_alignment(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_alignment_forgets_and_long_texts(spark):
    both = align.aligner()
    keep, align.Aligner.KEEP = align.Aligner.KEEP, 5
    try:
        import numpy as np

        for raw in (b"one two three four five six seven", b"one two eight", "é".encode() * 20_000 + b"9" * 50_000):
            totals, hashes, *_ = both.align(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            n_a, n_b = len(both.a.encode(" " + raw.decode(), add_special_tokens=False).ids), len(both.b.encode(raw.decode()))
            assert totals[0, :2].tolist() == [n_a, n_b] and len(hashes[0]) == 64
    finally:
        align.Aligner.KEEP = keep


def brute_copies(given):
    by = defaultdict(list)
    for i, t in given:
        by[t or ""].append(i)
    out = []
    for t, ids in by.items():
        keep = max((i for i in ids if i is not None), default=None)
        at = ids.index(keep)
        out += [(i, keep, len(ids), k == at, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def test_copies(docs):
    given = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_copies(given)
    assert rows(radix.copies(crowd(docs)), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert rows(radix.copies(docs, first=1, growth=8, most=2048)) == want  # many rounds
    assert radix.copies(docs.limit(0)).count() == 0 and radix.drop_copies(docs.limit(0)).count() == 0
    left = radix.drop_copies(crowd(docs))
    assert left.columns == crowd(docs).columns
    assert sorted(((r.doc_id, r.text or "") for r in left.collect()), key=str) == sorted(((i, t) for t, i in {t or "": k for t, k in ((t, max((j for j, u in given if (u or "") == (t or "") and j is not None), default=None)) for _, t in given)}.items()), key=str)


def test_salted_join(spark):
    left = spark.range(3000).select((F.col("id") % 7).alias("k"), "id").union(spark.range(5000).select(F.lit(3).cast("long"), F.col("id") + 3000)).union(spark.range(5).select(F.lit(99).cast("long"), F.col("id") + 9000))
    right = left.where("k < 99").groupBy("k").agg(F.count("*").alias("n"))
    plan = salted_join(left, right, ["k"], "n", "left", share=10)
    assert rows(plan.select("k", "id", "n")) == rows(left.join(right, "k", "left").select("k", "id", "n"))
    assert salted_join(left, right, ["k"], "n", share=2).count() == 8000


def brute_trie(given):
    """Nodes of (conv_id, turn, role, text) rows."""
    by = defaultdict(list)
    for c, turn, role, text in given:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    turns = {c: [(r, t) for *_, r, _, t in sorted(x)] for c, x in by.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = []
    for p, who in members.items():
        below = [q for q in members if q[: len(p)] == p]
        words = lambda q: len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0
        ends = ",".join(map(str, sorted(c for c in who if rebuilt[c] == p)))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), kids[p], sum(not kids[q] for q in below), sum((len(members[q]) - 1) * words(q) for q in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def talks():
    rnd = random.Random(4)
    given = []
    for c in [*range(-45, 70), 200, 203, 205, 1000, *range(2001, 2012)]:
        if c in (20, -20):
            continue  # bases that are absent
        for turn in range(rnd.choice([1, 2, 2, 3, 5, 25 if c % 9 == 0 else 4])):
            given.append((c, turn, rnd.choice(["user", "user", None]), rnd.choice(["", "hello there", "hello  there", None, f"reply {turn} \n x"]) if turn < 3 or c % 3 else "the same end"))
    for c in (300, 301, 302, 303, 304):  # long ones that differ late
        given += [(c, turn, "user" if turn % 2 else "assistant", f"turn {turn if turn < 30 + c % 3 else c}") for turn in range(40)]
    given += [(5, None, "user", "null first"), (5, None, "user", "null first"), (7, 0, "b", "tie"), (7, 0, "a", "tie"), (7, 0, "a", "tie two"), (None, 0, "user", "nobody"), (given[0])]
    return given


TALKS = "conv_id long, turn long, role string, text string"
NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("height", [1, 3, None])
def test_trie(spark, height):
    given = talks()
    random.Random(1).shuffle(given)
    got = trie.prefix_trie(crowd(spark.createDataFrame(given, TALKS)), height)
    assert rows(got, *NODES) == brute_trie(given)


def test_trie_of_one_common_conversation(spark):
    given = [(c, t, "user", f"same {t}") for c in range(3000) for t in range(3)]
    got = trie.prefix_trie(spark.createDataFrame(given, TALKS))
    assert rows(got, *NODES) == brute_trie(given)
    assert trie.prefix_trie(spark.createDataFrame([], TALKS)).count() == 0
