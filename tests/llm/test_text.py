import hashlib
import html
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lakegate.llm import imatch, language, packing, page_tree, toxicity
from lakegate.llm.html_extract import extract_pages, infer_wrappers
from lakegate.llm.mixing import first_words, mix, mixed_documents, source_targets
from lakegate.llm.url_filter import RULES, judge, labelled_urls, matching_rule, train

SF = "/root/testdata/sf0.001"


# Mixing

def water_fill(sizes, weights=(1, 2, 3), repeat=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, total, target = set(names), sum(sizes.values()), {}
    while left:
        rate = (total - sum(target.values())) / sum(w[s] for s in left)
        over = {s for s in left if rate * w[s] > repeat * sizes[s]}
        target |= {s: repeat * sizes[s] for s in over} if over else {s: rate * w[s] for s in left}
        left = left - over if over else set()
    return target


def test_targets_by_resharing(spark):
    sizes = {"a": 100, "b": 5, "c": 60, None: 3, "d": 900, "e": 0}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(rows).collect()}
    want = water_fill(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in got)


def test_mix_reaches_targets(docs, rows):
    got = mix(docs, block_words=4).collect()
    assert len(got) == len(rows)
    size = lambda t: len((t or "").split())
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, size(t)) for i, t, *_ in rows)
    taken, by = defaultdict(int), {r[0]: r[3] for r in rows}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[by[r["doc_id"]]] += r["taken"]
    target = water_fill({s: sum(size(r[1]) for r in rows if r[3] == s) for s in {r[3] for r in rows}})
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.5, (s, taken[s], t)
    assert sorted(map(str, got)) == sorted(map(str, mix(docs, block_words=4).collect()))


def test_mix_small_sources_reach_their_targets(spark, tmp_path):
    """Sources below and around one block of 128 words beside a large one, in documents of 1 to 40 words."""
    sizes = {"a": 129, "b": 20, "c": 300, "d": 5, "e": 19092, "f": 128, None: 1}
    rows, n = [], 0
    for source, left in sizes.items():
        while left:
            k = min(left, 1 + n * 7 % 40)
            rows, n, left = rows + [(n, "w " * k, source)], n + 1, left - k
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/d")
    taken, source_of = defaultdict(int), {i: s for i, _, s in rows}
    for r in mix(spark.read.parquet(f"{tmp_path}/d")).collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source_of[r["doc_id"]]] += r["taken"]
    for s, t in water_fill(sizes).items():
        assert abs(taken[s] - t) <= 0.5, (s, taken[s], t)


def test_mixed_documents_hold_the_words_taken(docs):
    taken = {}
    for r in mix(docs).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert {k: v for k, v in taken.items() if v} == dict(words)


def test_mix_empty(no_docs):
    assert mix(no_docs).count() == 0 and mixed_documents(no_docs).count() == 0


def test_first_words(spark):
    df = spark.createDataFrame([(" a  b\nc d", 2), ("x", 1)], "t string, n long")
    assert [r[0] for r in df.select(first_words(F.col("t"), F.col("n"))).collect()] == [" a  b", "x"]


# I-Match

def brute_fingerprint(text, lexicon, subsets):
    import regex
    terms = {w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    hashed = {signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in terms}
    kept = hashed & lexicon
    if not kept:
        return None

    def fold(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), seed)
        return signed(seed) >> 32

    level = max(0, int(np.floor(np.log2(max(len(kept) / subsets, 1.0)) / 2)))
    out = []
    for s in (level, level + 1):
        cells = defaultdict(list)
        for t in sorted(kept):
            seed = xxhash.xxh64_intdigest(t.to_bytes(8, "little", signed=True), 42)
            c = signed(xxhash.xxh64_intdigest(int(s).to_bytes(4, "little", signed=True), seed)) % (subsets * 4 ** s)
            if c < subsets:
                cells[c].append(t)
        out.append([s] + [fold([x for t in cells[k] for x in (k, t)]) if k in cells else None for k in range(subsets)])
    return out


def test_fingerprints_match_brute_force(spark):
    """Over a whole small table, with the lexicon counted by brute force."""
    import regex
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    df = Counter()
    for _, t in rows:
        df.update({w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w})
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    band = {signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w, n in df.items()
            if imatch.MIN_IDF <= np.log2(len(rows) / n) <= imatch.MAX_IDF}
    got = {r["doc_id"]: r for r in imatch.fingerprints(docs).collect()}
    assert len(got) == len(rows)
    text = lambda fp: "|".join(f"{lv[0]}:" + ".".join("-" if h is None else f"{h & (2 ** 32 - 1):08x}" for h in lv[1:]) for lv in fp)

    def like(a, b):
        for x in reversed(a):
            for y in reversed(b):
                if x[0] == y[0]:
                    hit = [(p, q) for p, q in zip(x[1:], y[1:]) if p is not None or q is not None]
                    return sum(p == q for p, q in hit) / len(hit) if hit else 0.0
        return 0.0

    same = 0
    for k, (i, t) in enumerate(rows):
        follows = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + follows[:q]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        mine, other, after = (brute_fingerprint(x, band, imatch.SUBSETS) for x in (t, edited, follows))
        if mine and other and after:
            same += got[i]["fingerprint"] == text(mine) and got[i]["edited_fingerprint"] == text(other)
            assert abs(got[i]["near_edited"] - like(mine, other)) < 1e-9 and abs(got[i]["near_next"] - like(mine, after)) < 1e-9
    assert same >= 0.9 * len(rows)
    near = [(r["near_edited"], r["near_next"]) for r in got.values()]
    assert np.mean([a for a, _ in near]) > 0.4 > 0.1 > np.mean([b for _, b in near])


def test_fingerprints_of_odd_texts(docs, rows):
    got = imatch.fingerprints(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[33]["fingerprint"] == by[34]["fingerprint"] and by[0]["fingerprint"] == by[21]["fingerprint"]
    assert by[30]["n_chars"] == 0 and by[30]["fingerprint"] == by[31]["fingerprint"] == by[32]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert by[None]["edited_sha256"]  # the last row's next is the first


def test_fingerprints_empty(no_docs):
    assert imatch.fingerprints(no_docs).count() == 0


# URL filter

def test_rules_and_model(spark):
    urls = ["http://a.com/x", "https://WWW.example.com/en/1", "http://m.example.com/en/1?x#y", "http://x.net/es/2", "http://x.net/fr",
            "no url", None, "http://q.org/en/1", "ftp://net/es/", "x://a.com", "http://lucky-casino-bets.org/en/5", "http://y.example.com?/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in judge(pages, train(labelled_urls(spark))).collect()}
    brute = []
    for u in urls:
        rest = u.split("://", 1)[1] if u and "://" in u else None
        host = path = ""
        if rest is not None:
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, tail = rest[:cut].lower(), rest[cut:]
            path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        fits = [(len(r), a, r) for a, r in RULES for h, p in [(r.split("/", 1)[0], "/" + r.split("/", 1)[1])]
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        brute.append((host, path, max(fits)[1:] if fits else (None, None)))
    for i, (host, path, (action, rule)) in enumerate(brute):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert action is None or got[i]["verdict"] == action
    assert got[5]["verdict"] == got[6]["verdict"] == got[7]["verdict"] == "allow" and got[10]["verdict"] == "block"


def test_telling_paths_block_on_any_host(spark):
    telling = ["https://neutral.org/casino/slots/free-bonus", "https://garden.org/viagra/buy", "http://www.station.net/en/xxx/watch"]
    ordinary = ["https://neutral.org/" + p for p in ("en/7", "de/30.html", "fr/2/", "es/99", "", "wiki/museum", "news/2024/school.html")]
    ordinary += ["http://farm.org/en/1", "http://now.org/en/1", "http://blog.org/de/1"]
    pages = spark.createDataFrame(list(enumerate(telling + ordinary + ["", None])), "page_id long, url string")
    got = {r["page_id"]: (r["verdict"], r["block_score"]) for r in judge(pages, train(labelled_urls(spark)), ()).collect()}
    for i, u in enumerate(telling + ordinary + ["", None]):
        assert got[i][0] == ("block" if i < len(telling) else "allow"), (u, got)
    assert not [r["url"] for r in labelled_urls(spark).collect() if "-/" in r["url"] or r["url"].startswith("https:///")]


def test_rule_list_may_be_empty(spark):
    df = spark.range(1).select(matching_rule(F.lit("a"), F.lit("/"), ()).alias("m"))
    assert df.first()["m"] is None


# Packing

def brute_ids(text):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    return tok.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


ODD = ["Don't. it's, x!!, a_, b_. 'S, İx ΣΣ. Á, a \u0301b <|endoftext|>Foo. <|startoftext|>, 12, 3.5. ². ª, \t tab,\tx .,. , . ..",
       "ÉTÉ, naïve. ßµ, x . y, ", "a.\x0bb,\x0cc.\rd, e\x85. \x1cf,", "", " ", "...", ", .", "l'été, '. 'd. 't, 'T.", "x" * 5000]


def test_ids_are_the_tokenizers():
    ids = packing.TokenIds(packing.tokenizer_path())
    for text in ODD:
        assert ids.of(text) == np.array(brute_ids(text)[:-1], "<u4").tobytes(), text


def test_packing_round_trip(docs, rows):
    pieces = packing.pack(docs, capacity=64, least_piece=8).collect()
    whole = {i: brute_ids(t) for i, t, *_ in rows}
    repeats = Counter(r[0] for r in rows)
    covered = defaultdict(Counter)
    sequences = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
        assert ids == whole[p["doc_id"]][p["start"]:p["start"] + p["length"]] and p["doc_tokens"] == len(whole[p["doc_id"]])
        covered[p["doc_id"]].update(range(p["start"], p["start"] + p["length"]))
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    assert all(covered[i] == Counter({k: repeats[i] for k in range(len(whole[i]))}) for i in whole)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0  # no padding


def test_packing_empty_and_crc(spark, no_docs):
    assert packing.pack(no_docs).count() == 0
    got = packing.with_crc(packing.pack(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))).collect()
    ids = np.array(brute_ids("a b"), "<u4")
    parts = sorted((r["start"], r["length"], r["ids_crc32"]) for r in got)
    assert parts == [(s, n, zlib.crc32(ids[s:s + n].tobytes())) for s, n, _ in parts] and sum(n for _, n, _ in parts) == len(ids)


# Language, toxicity

@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_language_held_out_accuracy(corpus):
    held_out = language.fold(F.col("doc_id"), 5) == 0
    model = language.train(corpus.where(~held_out))
    got = corpus.where(held_out).select("lang", language.predictor(model)("text").alias("p")).collect()
    right = sum(r["lang"] == r["p"]["lang"] for r in got)
    assert right >= 0.97 * len(got) and sum(r["p"]["rejected"] for r in got) <= 0.02 * len(got)


def test_language_odd_texts(docs, corpus, no_docs):
    model = language.train(corpus)
    got = {r["doc_id"]: r["p"] for r in docs.select("doc_id", language.predictor(model)("text").alias("p")).collect()}
    for i in (30, 31, 32, 35):
        assert got[i]["lang"] == "und" and got[i]["rejected"] and got[i]["score"] == 0
    assert all(0 <= p["score"] <= 1 for p in got.values())
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id in (30, 31, 32, 35)").count() == 0
    assert language.train(no_docs) == {} and language.keep_identified(docs, {}).count() == 0


def test_fold_is_crc32(spark):
    got = spark.range(200).select("id", language.fold(F.col("id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held_out = language.fold(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, labels.where(~held_out))
    got = docs.join(labels.where(held_out), "doc_id").select("toxic", toxicity.scorer(model)("text").alias("s")).collect()
    pos, neg = ([r["s"] for r in got if r["toxic"] == k] for k in (1, 0))
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert auc > 0.75 and np.mean([n >= 0.7 for n in neg]) < 0.02 and np.mean([p >= 0.7 for p in pos]) > 0.35


def test_toxicity_odd_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(0, 1), (1, 0), (2, 0), (None, 1), (3, None), (30, 1)], "doc_id long, toxic int")
    for labels in (none, one):
        model = toxicity.train(docs, labels)
        scores = [r["s"] for r in docs.select(toxicity.scorer(model)("text").alias("s")).collect()]
        assert all(0 <= s <= 1 for s in scores)
    assert no_docs.select(toxicity.scorer(model)("text").alias("s")).count() == 0


def test_windows_cover_the_text():
    rng = random.Random(1)
    for raw in (b"", b"x" * 1000, b" ".join(bytes([97 + rng.randrange(26)]) * rng.randrange(1, 90) for _ in range(200))):
        assert b"".join(toxicity.windows(raw)) == raw


# HTML

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<div id="cookie-notice">We use cookies</div><header class="site"><a href=/>Home</a></header><nav><ul><li><a>A {0}</a></li><li>B</li></ul></nav>
<{1}><h1>Title {0}</h1><p>One {0} &eacute;&nbsp;x<br>more<p>Two <b>bold</b> {0} &amp; x<ul><li>item a<li>item {0}</ul>
<div class="ad-slot">Buy {0}</div><blockquote>Quote {0}</blockquote>{3}<form><label>Mail</label></form></{2}>
<aside>Side {0}</aside><section id="comments"><h3>Comments</h3><div class="comment">nice {0}</div></section><footer>&copy; foot {0}</footer>"""


def page(i, tag="article", close="article", more=""):
    return PAGE.format(i, tag, close, more)


def want(i, more=()):
    return "\n\n".join([f"Title {i}", f"One {i} é x more", f"Two bold {i} & x", "item a", f"item {i}", f"Quote {i}", *more])


def test_pages_of_two_hosts(spark, tmp_path):
    rows = [(i, f"http://a.com/{i}", page(i)) for i in range(12)]
    rows += [(100 + i, f"http://b.org/{i}", page(i, 'div class="content"', "div", "<table><tr><td>cell %d</table>" % i if i % 2 else ""))
             for i in range(9)]
    rows += [(200, "http://a.com/x", None), (201, None, ""), (202, None, "<p>alone &lt;b&gt;"), (203, "http://a.com/y", "plain < text"),
             (3, "http://a.com/3", page(3)), (204, "http://c.net/", "<div>" * 3000 + "deep"), (205, "http://c.net/1", "<!-- open")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("wrapper", F.lit(1))
    df.repartition(3).write.parquet(str(tmp_path / "pages"))
    got = defaultdict(list)
    for r in extract_pages(spark.read.parquet(str(tmp_path / "pages"))).collect():
        got[r["page_id"]].append(r["text"])
    assert sum(map(len, got.values())) == len(rows)
    assert all(got[i] == [want(i)] * (2 if i == 3 else 1) for i in range(12))
    assert all(got[100 + i] == [want(i, ["cell %d" % i] if i % 2 else [])] for i in range(9))
    assert got[200] == got[201] == got[205] == [""] and got[202] == ["alone <b>"] and got[203] == ["plain < text"] and got[204] == ["deep"]


PASSAGE = "The only passage of an article that many pages of its host hold, word for word, in copies."


def test_pages_that_share_their_text(spark, tmp_path):
    """Copies of one article, a shared heading, and constant text outside the article."""
    def copy(i, start, end):
        return f"<body><div>Menu of day {i}</div><div>Same for all</div>{start}<h1>News</h1><p>{PASSAGE}</p>{end}<div>Foot {i} {'x' * i}</div>"

    rows = [(i, f"http://copies.com/{i}", copy(i, "<article>", "</article>")) for i in range(30)]
    rows += [(100 + i, f"http://div.com/{i}", copy(i, '<div class="content">', "</div>")) for i in range(30)]
    rows += [(200 + i, f"http://head.com/{i}", f"<div>Note</div><article><h1>News</h1><p>Passage {i}</p></article>") for i in range(30)]
    rows += [(300 + i, f"http://bare.com/{i}", f"<h1>News</h1><p>Text</p><nav>{i}</nav>") for i in range(30)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages"))
    got = {r["page_id"]: r["text"] for r in extract_pages(spark.read.parquet(str(tmp_path / "pages"))).collect()}
    for i in range(30):
        assert got[i] == f"News\n\n{PASSAGE}"
        assert f"News\n\n{PASSAGE}" in got[100 + i]
        assert got[200 + i] == f"News\n\nPassage {i}"
        assert got[300 + i] == "News\n\nText"


def test_rare_layouts_of_a_host_count(spark, tmp_path):
    """A layout of a few among many pages has its template found, in any split."""
    rows = [(i, f"http://hot.com/{i}", f"<div><p>Common {i} {'word ' * 30}</p></div>") for i in range(400)]
    rows += [(400 + i, f"http://hot.com/{i}", f"<div><h2>Fixed line</h2><p>Rare {i} {'word ' * 30}</p><h4>Printed on paper</h4></div>") for i in range(4)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).write.parquet(str(tmp_path / "pages"))
    wrappers = []
    for n in (2, 9):
        base = spark.read.parquet(str(tmp_path / "pages")).repartition(n).withColumn("host", F.lit("hot.com"))
        wrappers.append([tuple(r) for r in infer_wrappers(base).collect()])
    assert wrappers[0] == wrappers[1] and len(wrappers[0]) == 1
    assert all(sig in wrappers[0][0][1] for sig in ('"h2"', '"h4"'))


def test_pages_empty(spark, tmp_path):
    schema = "page_id long, url string, html string"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none"))
    assert extract_pages(spark.read.schema(schema).parquet(str(tmp_path / "none"))).count() == 0


def test_articles_of_the_given_pages(spark):
    """Against a plain reading of the given pages' article elements."""
    import re
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    given = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extract_pages(pages).collect():
        article = re.search(r"<article>(.*?)</article>", given[r["page_id"]], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n\n".join(p for p in parts if p)


def test_wrapper_has_optional_and_repeated_items():
    wrapper = page_tree.fold(page_tree.parse("<ul><li>a<li>b</ul><h2>x</h2><p>1</p><h2>y</h2><p>2</p><h2>z</h2><p>3</p>"))
    other = page_tree.fold(page_tree.parse("<ul><li>c</ul><table><tr><td>t</table><h2>x</h2><p>1</p><h2>y</h2><p>2</p>"))
    kids = page_tree.merge(wrapper, other)["kids"]
    assert [(k["sig"], k["must"], k["many"]) for k in kids] == [("ul", True, False), ("table", False, False), ("()", True, True)]
    assert kids[0]["kids"][0]["many"] and kids[0]["kids"][0]["kids"][0]["text"] is None
