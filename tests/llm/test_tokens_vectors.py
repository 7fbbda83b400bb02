"""Piece encoding, token alignment and vector codes against the libraries and brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakegate.llm import piece_encoding, token_alignment, vector_codes
from lakegate.llm.piece_encoding import PieceEncoder, encode_documents
from lakegate.llm.queries import QUERIES
from lakegate.llm.token_alignment import Aligner, align_documents, merge_path, overlaps, with_link_counts
from lakegate.llm.vector_codes import Blocks, compress, hilbert_keys

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["", " ", "  ", "\n", "a", " a  b\n\n c ", "<s>x</s><unk>", "<|endoftext|>", "▁x ▁▁", "é漢字😀\x00́ﬁ", "don't  stop \n\n now\t.",
       "a　b\x85c\xa0d\x1ce", "'s 's's", "x" * 70, "ab" * 40 + "," * 30]


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    letters = "aeinrst ▁\n\t,.'()_12é漢😀\x00\xa0　\x1c\x85"
    words = [sentencepiece.SentencePieceProcessor(model_file=B).id_to_piece(i).replace("▁", " ") for i in range(259, 31000, 37)]
    for i in range(n):
        if i % 2:
            yield "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        else:
            yield "".join(rng.choice(words) for _ in range(rng.randint(1, 14)))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(B)


# Piece encoding

def numbers(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_pieces_equal_the_library(encoder, library):
    texts = ODD + list(odd_texts(4000))
    for text, want in zip(texts, library.encode(texts)):
        assert numbers(encoder.encode(text)) == want, repr(text)


def test_long_texts_in_blocks_and_groups(encoder, library, monkeypatch):
    texts = ["".join(odd_texts(300)).replace(" ", ""), "a" * 5000, " ".join(odd_texts(400))]
    monkeypatch.setattr(piece_encoding, "MATCH_BLOCK", 64)
    monkeypatch.setattr(piece_encoding, "SLICE_CHARS", 100)
    monkeypatch.setattr(piece_encoding, "GROUP_SEGMENTS", 7)
    monkeypatch.setattr(piece_encoding, "GROUP_IDS", 50)
    encoder.known.clear()
    for text in texts:
        raw = encoder.encode(text)
        assert numbers(raw) == library.encode(text)
        both = encoder.begin + raw + encoder.end
        assert encoder.decode(both) == library.decode(numbers(both))


def test_a_failed_place_is_taken_back(encoder):
    """Some text needs a longest match given up; the result holds only compatible neighbours."""
    backed = 0
    for text in odd_texts(600, seed=8):
        normal = encoder.library.normalize(text)
        pieces = encoder.pieces(normal)
        assert all(encoder.compatible(x, y) for x, y in zip(pieces, pieces[1:]))
        assert "".join(map(encoder._name, pieces)) == normal
        start, matches = 0, piece_encoding.Matches(encoder, normal).reader()
        for p in pieces:
            backed += p != matches(start)[-1]
            start += len(encoder._name(p))
    assert backed > 20


def test_model_without_bytes_is_refused(monkeypatch):
    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_byte", lambda self, i: False)
    with pytest.raises(ValueError, match="byte fallback"):
        PieceEncoder(B)


def expected_op11(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_op11_query(spark, docs, rows, library, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(map(tuple, QUERIES["op11_piece_encoding"](spark, str(tmp_path)).collect()))
    assert got == Counter((r[0], *expected_op11(library, r[1])) for r in rows)


def test_encode_documents_empty(no_docs):
    got = encode_documents(no_docs)
    assert got.columns == ["doc_id", "ids", "decoded"] and got.count() == 0


# Token alignment

def aligned_brute(tokenizer, library, text):
    """n_a, n_b, groups and links of one text, token by token."""
    if not text:
        return 0, 0, [], []
    letters = token_alignment._byte_letters()
    a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = library.encode(text)
    bytes_a = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, library.id_to_piece(i)) for i in b)]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return 0, 0, [], []
    ends_a = {e: i for i, e in enumerate(np.cumsum([len(x) for x in bytes_a]).tolist())}
    ends_b = {e: i for i, e in enumerate(np.cumsum([len(x) for x in bytes_b]).tolist())}
    groups, links, x, y = [], [], 0, 0
    for e in sorted(ends_a.keys() & ends_b.keys()):
        groups.append((a[x:ends_a[e] + 1], b[y:ends_b[e] + 1]))
        links.append((a[ends_a[e]], b[ends_b[e]]))
        x, y = ends_a[e] + 1, ends_b[e] + 1
    return len(a), len(b), groups, links


def spelled(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t


def test_chunked_ids_equal_the_tokenizers(tokenizer, library):
    aligner = Aligner(A, B)
    aligner.chunks.entries = 50  # chunks are forgotten all the time
    texts = [t for t in ODD + list(odd_texts(3000, seed=4)) if t and "▁" not in t]
    for at in range(0, len(texts), 40):
        some = texts[at:at + 40]
        a, b, n_a, n_b = aligner.ids(some)
        want_a = [tokenizer.encode(" " + t, add_special_tokens=False).ids for t in some]
        want_b = library.encode(some)
        assert (a.tolist(), n_a.tolist()) == (sum(want_a, []), list(map(len, want_a)))
        assert (b.tolist(), n_b.tolist()) == (sum(want_b, []), list(map(len, want_b)))


def test_long_texts_are_chunked_in_groups(monkeypatch):
    text = " ".join(odd_texts(200, seed=7)).replace("▁", "")
    want = Aligner(A, B).align([text])
    monkeypatch.setattr(token_alignment, "SLICE_CHARS", 50)
    monkeypatch.setattr(token_alignment, "GROUP_SEGMENTS", 11)
    monkeypatch.setattr(token_alignment, "JOINED_TOKENS", 13)
    got = Aligner(A, B).align([text])
    assert got[0] == want[0] and all((x == y).all() for x, y in zip(got[1:], want[1:]))


def test_merge_path_cuts_equal_work():
    rng = np.random.default_rng(1)
    for _ in range(30):
        ends_a = np.unique(rng.integers(0, 200, rng.integers(0, 60)))
        ends_b = np.unique(rng.integers(0, 200, rng.integers(0, 60)))
        merged = sorted([(e, 0) for e in ends_a] + [(e, 1) for e in ends_b])
        for work in (1, 3, 10, 1000):
            a, b = merge_path(ends_a, ends_b, work)
            cuts = [*range(0, len(merged), work), len(merged)]
            assert a.tolist() == [sum(k == 0 for _, k in merged[:c]) for c in cuts]
            assert (a + b).tolist() == cuts


def test_overlaps_do_not_depend_on_the_cuts():
    rng = np.random.default_rng(2)
    for _ in range(30):
        last = int(rng.integers(1, 150))
        ends_a, ends_b = (np.unique(np.append(rng.integers(1, last + 1, rng.integers(0, 60)), last)) for _ in range(2))
        want = [(int(np.searchsorted(ends_a, e)), int(np.searchsorted(ends_b, e)), int(e), bool(e in ends_a and e in ends_b))
                for e in np.union1d(ends_a, ends_b)]
        for work in (1, 2, 5, 64, 1000):
            got = [row for o in overlaps(ends_a, ends_b, work)
                   for row in zip(o.a.tolist(), o.b.tolist(), o.end.tolist(), o.together.tolist())]
            assert got == want
    none = np.zeros(0, np.int64)
    assert list(overlaps(none, none)) == []


def test_alignment_of_odd_texts(tokenizer, library):
    aligner, texts = Aligner(A, B), ODD + list(odd_texts(800, seed=5))
    for work in (3, 50, 1 << 16):
        found, keys, counts = aligner.align(texts, work)
        links = Counter()
        for i, text in enumerate(texts):
            n_a, n_b, groups, pairs = aligned_brute(tokenizer, library, text)
            assert found[i] == (n_a, n_b, len(groups), spelled(groups)), repr(text)
            links.update((i, *p) for p in pairs)
        mask = (1 << token_alignment.ID_BITS) - 1
        got = {(k >> 2 * token_alignment.ID_BITS, (k >> token_alignment.ID_BITS) & mask, k & mask): n
               for k, n in zip(keys.tolist(), counts.tolist())}
        assert got == links


def expected_op12(tokenizer, library, rows):
    aligned = [(i, *aligned_brute(tokenizer, library, t)) for i, t in rows]
    count = Counter(p for *_, links in aligned for p in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return Counter(
        (i, n_a, n_b, len(groups), hashlib.sha256(spelled(groups).encode()).hexdigest() if groups else "", len(links),
         sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links)) for i, n_a, n_b, groups, links in aligned)


def test_op12_query(spark, docs, rows, tokenizer, library, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_token_alignment"](spark, str(tmp_path))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]
    assert Counter(map(tuple, got.select(columns).collect())) == expected_op12(tokenizer, library, [r[:2] for r in rows])


def test_counts_by_shuffle_equal_those_by_broadcast(docs, tmp_path):
    align_documents(docs).write.parquet(str(tmp_path / "aligned"))
    aligned = docs.sparkSession.read.parquet(str(tmp_path / "aligned"))
    plans = [with_link_counts(aligned, n) for n in (0, 1 << 20)]
    assert "SortMergeJoin [a#" in plans[0]._jdf.queryExecution().explainString(
        docs.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert Counter(map(str, plans[0].collect())) == Counter(map(str, plans[1].collect()))


def test_alignment_of_no_documents(no_docs):
    assert align_documents(no_docs).count() == 0


# Vector codes

def codes_brute(rows, parts=16, entries=64, rounds=2, scale=256):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    ints = [[int(np.floor(scale * x)) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in kept]
    cells = np.array(ints, object).reshape(len(kept), parts, width)
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, ints[r]))[:entries]
    books = [[list(cells[r, p]) for r in first] for p in range(parts)]

    def nearest(p, v):
        return min((sum((x - y) ** 2 for x, y in zip(v, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, cells[r, p])[1] for r in range(len(kept))] for p in range(parts)]
        for p in range(parts):
            for k in range(len(first)):
                mine = [cells[r, p] for r in range(len(kept)) if found[p][r] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    out, by_label = [], Counter()
    for r, (i, _, lab) in enumerate(kept):
        hits = [nearest(p, cells[r, p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in hits), sum(d for d, _ in hits), lab))
        by_label[lab] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, code, e, by_label[lab], digest) for i, code, e, lab in out)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, cell long, n long, of string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def spread_rows(n=140, dims=32, seed=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 2, (9, dims))
    rows = [(int(i), (centres[i % 9] + rng.normal(0, 0.4, dims)).astype(np.float32).tolist(), int(i % 4) if i % 5 else None)
            for i in range(n)]
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 1), (None, rows[5][1], None), (None, rows[6][1], 0)]
    rows += [(900, None, 1), (901, [float("nan")] + rows[0][1][1:], 1), (902, [float("-inf")] + rows[0][1][1:], None),
             (903, [None] + rows[0][1][1:], 2), (904, [], 3), (905, [1.0], 3), (-3, [0.0] * dims, None)]
    rows += [(1000 + i, rows[8][1], 9) for i in range(150)]
    return rows


def test_codes_equal_brute_force(spark):
    rows = spread_rows()
    got = compress(vectors(spark, rows).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, got.collect())) == codes_brute(rows)


@pytest.mark.parametrize("rows", [spread_rows(9)[:5], [(4, [1.0, -2.0, 3.5], None)], [(1, [], 2), (2, None, 2)]])
def test_codes_of_few_vectors(spark, rows):
    assert Counter(map(tuple, compress(vectors(spark, rows)).collect())) == codes_brute(rows)


def test_codes_do_not_depend_on_chunks(spark):
    rows = spread_rows(250)
    want = codes_brute(rows)
    df = vectors(spark, rows)
    for chunk_bytes in (1, 1 << 14):
        codes = vector_codes.VectorCodes(df.repartition(2), chunk_bytes=chunk_bytes)
        codes.refine()
        codes.refine()
        assert codes.digest() == next(iter(want))[-1]
        assert Counter((r["vec_id"], r["code"], r["error"]) for r in codes.encode().collect()) == Counter(
            {}) + sum((Counter({k[:3]: n}) for k, n in want.items()), Counter())


def test_codes_of_no_vectors(spark):
    for rows in ([], [(1, None, 1)]):
        got = compress(vectors(spark, rows))
        assert got.count() == 0 and len(got.columns) == 5


def test_large_components_are_refused(spark):
    with pytest.raises(Exception, match="larger than"):
        compress(vectors(spark, [(1, [1e9], 0)]))


def test_hilbert_neighbours():
    """Along the curve every cell of a full grid is next to the one before it, in any number of dimensions."""
    for dims, side in ((1, 16), (2, 16), (3, 8), (4, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        keys = hilbert_keys(grid * (256 // side))
        steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1)
        assert len(np.unique(keys)) == len(grid) and steps.max() == 1


def test_short_lists_hold_the_nearest_entry_and_leave_most_out():
    rng = np.random.default_rng(4)
    points = rng.normal(0, 300, (8000, 3)).astype(np.int32)
    blocks = Blocks.build(points)
    entries = points[:64].astype(np.int64)
    lists = blocks.shortlists(entries)
    best = ((blocks.rows[:, None, :].astype(np.int64) - entries) ** 2).sum(axis=2).argmin(axis=1)
    assert all(lists[i // vector_codes.BLOCK_ROWS, k] for i, k in enumerate(best))
    assert lists.mean() < 0.4


def test_wide_integers(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), (rng.normal(0, 30000, 20)).astype(np.float32).tolist(), 0) for i in range(90)]
    assert Counter(map(tuple, compress(vectors(spark, rows)).collect())) == codes_brute(rows)


def test_op13_query_reads_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = QUERIES["op13_vector_codes"](spark, sf).agg(F.count("*"), F.sum("error")).first()
    assert got[0] == table.where("embedding is not null").count() and got[1] > 0
