import hashlib
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakegate.llm import line_dedup as L
from lakegate.llm import minhash as M
from lakegate.llm.common import with_row_id, without_rows
from lakegate.llm.components import components
from lakegate.llm.exact_dedup import drop_copies, refine

SPACE = re.compile("[\x20\x09-\x0d]")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def test_exact_groups(docs, rows):
    got = sorted(tuple(r) for r in refine(docs).select("doc_id", "keep_id", "group_size", "kept").fillna(-1, ["doc_id", "keep_id"]).collect())
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i is None, -1 if i is None else i))
    want = []
    for members in groups.values():
        keep = min(members)
        for k, m in enumerate(sorted(members)):
            want.append((m[2], keep[2], len(members), k == 0))
    assert got == sorted(want)


def test_exact_stage_keeps_one_of_repeated_rows_and_all_columns(docs):
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 50").count() + kept.where("doc_id = 3").count() == 1
    assert kept.where("trim(coalesce(text, '')) = '' or text is null").count() <= 1


def test_row_numbers_do_not_depend_on_splits(spark, tmp_path):
    """Another number of cores, here another minPartitionNum, splits the next scan otherwise."""
    path = str(tmp_path / "t")
    (spark.range(0, 4000, 1, 5).selectExpr("id as doc_id", "repeat(concat('w', id % 3500), 40) as text")
     .write.option("parquet.block.size", 4096).parquet(path))
    seen, kept = [], []
    dropped = None
    try:
        for least in ("1", "7", "64"):
            spark.conf.set("spark.sql.files.minPartitionNum", least)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            docs = spark.read.parquet(path)
            seen.append((docs.rdd.getNumPartitions(), {r["doc_id"]: r["_row"] for r in with_row_id(docs).select("doc_id", "_row").collect()}))
            if dropped is None:
                dropped = spark.createDataFrame(refine(docs).where("not kept").select("_row").collect(), "_row long")
            kept.append(sorted(r["doc_id"] for r in without_rows(docs, dropped).select("doc_id").collect()))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({n for n, _ in seen}) == 3
    assert len(set(seen[0][1].values())) == 4000 and all(rows == seen[0][1] for _, rows in seen)
    assert all(k == list(range(3500)) for k in kept)


def test_exact_empty(no_docs):
    assert refine(no_docs).count() == 0
    assert drop_copies(no_docs).columns == no_docs.columns


def brute_components(rows):
    sets = []
    for _, t, *_ in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", ascii_lower(t or "")) if x]
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    lowest = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] if r[0] is not None else 0)
        lowest[find(i)] = min(lowest.get(find(i), (True, 1 << 60)), key)
    return [(r[0], len(sets[i]), None if lowest[find(i)][0] else lowest[find(i)][1]) for i, r in enumerate(rows)]


def test_near_duplicates_match_brute_force(docs, rows):
    got = M.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
    assert Counter(map(tuple, got.collect())) == Counter(brute_components(rows))


def test_near_stage_keeps_one_row_of_each_component(docs, rows):
    kept = M.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    with_words = [r for r in rows if (r[1] or "").split()]
    empty = len(rows) - len(with_words)
    assert kept.count() == empty + len({c for (_, n, c) in brute_components(rows) if n})


def test_near_empty(no_docs):
    assert M.near_duplicates(no_docs).count() == 0


def test_large_bucket_family(spark, tmp_path):
    """Copies of one text with growing edits: buckets larger than ``small``, families of several blocks."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(90):
        t = list(base)
        for _ in range(rng.randint(1, 9)):
            t[rng.randrange(120)] = f"x{rng.randrange(10 ** 6)}"
        texts.append((i, " ".join(t), "en", "s", 1))
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "f"))
    docs = spark.read.parquet(str(tmp_path / "f"))
    got = M.near_duplicates(docs, small=4, block=16).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(texts))


def test_permutations_are_bijective_on_a_range():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(M._permute(x.copy(), 0x9E3779B1, 0x846CA68B))) == len(x)


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(x[:2000]), np.unique(x[500:2500])
    same = (M.signature(a, 512) == M.signature(b, 512)).mean()
    assert abs(same - 1500 / 2500) < 0.1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=12))
def test_block_links_connect_what_is_near(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    parent = list(range(len(sets)))

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(parent, i)] = find(parent, j)
    mine = list(range(len(sets)))
    for a, b in M.block_links(arrays, 75):
        mine[find(mine, a)] = find(mine, b)
    group = lambda p: {frozenset(i for i in range(len(sets)) if find(p, i) == find(p, k)) for k in range(len(sets))}
    assert group(parent) == group(mine)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160))


def test_line_dedup_matches_brute_force(docs, rows):
    got = L.drop_shared_lines(docs).collect()
    holders = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            key = ascii_lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
            if len(key) >= 40:
                holders.setdefault(key, set()).add(L.NULL_ID if i is None else i)
    want = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        keys = [ascii_lower(x.strip("\x20\x09\x0a\x0b\x0c\x0d")) for x in lines]
        keep = [x for x, k in zip(lines, keys) if not (len(k) >= 40 and len(holders[k]) >= 5 and max(holders[k]) != i)]
        want.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    assert any(w[2] for w in want)
    assert Counter(tuple(r) for r in got) == Counter(want)


def test_line_dedup_empty(no_docs):
    assert L.drop_shared_lines(no_docs).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.sets(st.tuples(st.integers(-2 ** 63, 2 ** 63 - 1), st.integers(-2 ** 63, 2 ** 63 - 1)), max_size=300))
def test_minimal_perfect_hash_is_minimal_and_perfect(keys):
    keys = sorted(keys)
    hi, lo = (np.array([k[j] for k in keys], np.int64) for j in (0, 1))
    levels = L.build(hi, lo)
    slots = L.locate(levels, L.ranks(levels), hi, lo)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_line_key_hash_is_the_stripped_lowered_line():
    assert L.line_key("  " + "Ab" * 20 + "\t", 40) == b"ab" * 20
    assert L.line_key("x" * 39 + "   ", 40) is None
    assert hashlib.sha256(L.line_key("É" * 40, 40)).hexdigest() == hashlib.sha256(("É" * 40).encode()).hexdigest()
