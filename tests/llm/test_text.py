from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow
import pytest
from pyspark.sql import functions as F

from wardline.llm import common, extract, passages, simhash


def page(body, head="<title>T</title><script>var t='</p>';</script><style>p{}</style>"):
    return f"<!DOCTYPE html><html lang=en><head>{head}</head><body>{body}</body></html>"


ARTICLE = "<article><h1>Head &amp; line</h1><p>One  two\n three<b> four</b></p><p>Short.</p></article>"
TEXT = "Head & line\nOne two three four\nShort."


@pytest.mark.parametrize("body", [
    f"<nav><ul><li><a href=/>Home</a></ul></nav>{ARTICLE}<footer>&copy; us</footer>",
    f"<header><h2>Site</h2></header><aside><p>Side text that is long enough to count</p></aside>{ARTICLE}",
    f"<div class='ad'>Buy now, it is cheap and very good</div><!-- <p>no</p> -->{ARTICLE}",
    f"<div class=cookie-notice><p>We use cookies for a great many things</p></div>{ARTICLE}",
    f"{ARTICLE}<section id='comments'><article class=comment><p>First! What a very long comment</p></article></section>",
    f"<form><label>Name</label><input><button>Go</button></form>{ARTICLE}<noscript>Turn it on</noscript>",
    f"<div class=ad>Never closed {ARTICLE}",
    ARTICLE.replace("</article>", ""),
    ARTICLE.replace("<p>Short.", "<div class='advert'>Buy</div><p>Short."),
    "<main><div><h1>Head &amp; line</h1><p>One two <a href=x>three</a> four<br>Short.</div></main><p>Not this one, outside</p>",
    "<MAIN><H1>Head &amp; line</H1><P TITLE='a>b'>One&#32;two&nbsp;three four<P>Short.</MAIN>",
])
def test_article_text(body):
    assert extract.main_text(page(body)) == TEXT


@pytest.mark.parametrize("name", [
    "class='article-content social-science'", "id='job-search-guide'", "class='menu-of-the-day recipe'", "class=post-header",
    "class='banner-year review'", "id=comment-on-the-war", "class=searching", "class='headers'"])
def test_names_that_only_contain_a_word_of_noise_keep_their_text(name):
    body = f"<div {name}><h1>Head &amp; line</h1><p>One  two\n three<b> four</b></p><p>Short.</p></div>"
    if "comment-on-the-war" in name:
        body = body.replace("war", "war-years")
    assert extract.main_text(page(body)) == TEXT


@pytest.mark.parametrize("name", [
    "class='cookie-notice'", "class='site-footer'", "id=main-nav", "class='related-posts grid'", "class='wide ad-slot-2'", "class=top_menu",
    "id='comments-area'", "class='newsletter-signup box'", "role=navigation", "class='social-share-buttons'"])
def test_names_of_noise_alone_drop_theirs(name):
    assert extract.main_text(page(f"<div {name}><p>Some words that are long enough to count here</p></div>{ARTICLE}")) == TEXT
    body = ARTICLE.replace("article", "div")
    assert extract.main_text(page(f"<div {name}><p>Some words that are long enough to count here</p></div>{body}")) == TEXT


def test_pages_without_article_markup():
    menu = "".join(f"<li><a href=/{i}>Menu {i}</a></li>" for i in range(9))
    body = f"<ul>{menu}</ul><div><p>{'long text ' * 30}</p><p>Short.</p><p>{'more text ' * 30}</p></div><ul>{menu}</ul>"
    out = extract.main_text(page(body)).split("\n")
    assert out == [("long text " * 30).strip(), "Short.", ("more text " * 30).strip()]
    assert extract.main_text("just text, 1 < 2 &lt; 3") == "just text, 1 < 2 < 3"
    assert extract.main_text(None) == extract.main_text("") == extract.main_text(page("")) == ""


@pytest.mark.parametrize("name", ["aside", "nav", "footer", "div class=related"])
def test_article_cards_are_not_the_page(name):
    cards = "".join(f"<article><h3>Card {i}</h3><p>Teaser {i}</p></article>" for i in range(4))
    text = "\n".join(f"{w} " * 60 for w in ("first", "second")).replace(" \n", "\n").strip()
    body = "".join(f"<div>{t}</div>" for t in text.split("\n"))
    assert extract.main_text(page(f"{body}<{name}>{cards}</{name.split()[0]}>")) == text
    assert text in extract.main_text(page(f"{cards}{body}"))


def test_links_in_an_article_are_a_dive():
    links = "".join(f"<li><a href=/{i}>Read also {i}</a></li>" for i in range(9))
    out = extract.main_text(page(f"<article><p>{'one ' * 50}</p><ul>{links}</ul><p>{'two ' * 50}</p></article>"))
    assert "one" in out and "two" in out and "Read also 0" not in out


def test_short_blocks_after_an_advert_stay():
    long, close = ("long " * 1000).strip(), ("close " * 50).strip()
    link = "See <a href=/x>the whole of a report with a very long title</a>"
    body = f"<div>{long}</div><div class=ad>Buy</div><p>{close}</p><p>{link}</p><p>End of it.</p>"
    assert extract.main_text(page(body)).split("\n") == [
        long, close, "See the whole of a report with a very long title", "End of it."]


def test_extract_query(spark):
    rows = [(1, "u", page(ARTICLE), "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "v", "<p>" + "é " * 50_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = Counter((r["page_id"], r["url"], r["n_chars"]) for r in extract.extract(df).collect())
    assert out == {(1, "u", len(TEXT)): 1, (2, None, 0): 2, (None, "v", 99_999): 1}
    assert extract.extract(df.limit(0)).count() == 0


def test_pages_hold_the_documents_text(spark):
    got = extract.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()
    clean = lambda t: "\n".join(x for x in (" ".join(s.split()) for s in t.split("\n")) if x)
    there = {clean(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == 50 and all(r["text"].split("\n", 1)[1] in there for r in got)


def test_fingerprints_against_brute_force(documents, document_rows, odd, odd_rows):
    for df, rows in ((documents, document_rows), (odd, odd_rows)):
        out = simhash.fingerprints(df).collect()
        key = lambda r: (r[0] is not None, r[0])
        texts = defaultdict(list)
        for doc_id, t, *_ in sorted(rows, key=key):
            texts[doc_id].append(t or "")
        if rows is odd_rows:                                     # the rows of id 7 are equal
            assert texts[7] == ["one", "one"]
        line = [(i, t) for i in sorted(texts, key=lambda i: (i is not None, i)) for t in texts[i]]
        want = Counter()
        for (i, t), (_, nt) in zip(line, line[1:] + line[:1]):
            half = len(t) // 2
            want[i, len(t), hashlib.sha256((t[:len(t) - half] + nt[:half]).encode()).hexdigest(), simhash.fingerprint(t).hex()] += 1
        assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"]) for r in out) == want
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    big = [r for r in simhash.fingerprints(documents).collect() if r["n_chars"] > 200]
    assert np.mean([r["near_edited"] > r["near_next"] for r in big]) > 0.97


def test_one_row_is_its_own_next(spark, nothing):
    row = simhash.fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).first()
    assert row["near_next"] == 1.0 and row["n_chars"] == 7
    assert simhash.fingerprints(nothing).count() == 0


def test_likeness_follows_the_cosine():
    r = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    for share in (0.2, 0.5, 0.9):
        got = []
        for _ in range(30):
            a = [r.choice(words) for _ in range(400)]
            b = a[:int(400 * share)] + [r.choice(words) for _ in range(400 - int(400 * share))]
            got.append(simhash.likeness(simhash.fingerprint(" ".join(a)), simhash.fingerprint(" ".join(b))))
        assert np.mean(got) == pytest.approx(share, abs=0.06)


def test_radius_search_finds_all(spark):
    r = random.Random(9)
    base = [r.getrandbits(256) for _ in range(30)]
    fps = []
    for i in range(400):
        x = r.choice(base)
        for bit in r.sample(range(256), r.randrange(9)):
            x ^= 1 << bit
        fps.append((i, f"{x:064x}"))
    df = spark.createDataFrame(fps, "doc_id long, fingerprint string")
    out = {(x["query_id"], x["doc_id"], x["distance"]) for x in simhash.within(df.where("doc_id % 100 = 0"), df, 6).collect()}
    want = {(i, j, d) for i, a in fps if i % 100 == 0 for j, b in fps if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 6}
    assert out == want


def best_chain(a, b):
    """Quadratic reference: the best score of a chain."""
    order, score = sorted(range(len(a)), key=lambda i: (a[i], b[i])), {}
    for n, i in enumerate(order):
        best = float(passages.SEED)
        before = [(score[j] + passages.GAP_COST * (a[j] + b[j]), j) for j in order[:n] if a[j] < a[i] and b[j] < b[i]]
        if before:
            j = max(before)[1]
            best = max(best, score[j] + min(passages.SEED, a[i] - a[j], b[i] - b[j])
                       - passages.GAP_COST * max(0, a[i] - a[j] + b[i] - b[j] - 2 * passages.SEED))
        score[i] = best
    return max(score.values())


def test_fenwick_chains_equal_the_quadratic_ones():
    r = random.Random(6)
    for _ in range(60):
        n = r.randrange(1, 40)
        a, b = [r.randrange(120) for _ in range(n)], [r.randrange(120) for _ in range(n)]
        a, b = map(list, zip(*sorted(set(zip(a, b)))))
        chains = passages.chain(a, b)
        assert sorted(i for c in chains for i in c) == list(range(len(a)))
        assert all(a[i] < a[j] and b[i] < b[j] for c in chains for i, j in zip(c, c[1:]))
        c = chains[0]
        total = passages.SEED + sum(min(passages.SEED, a[j] - a[i], b[j] - b[i]) - passages.GAP_COST * max(
            0, a[j] - a[i] + b[j] - b[i] - 2 * passages.SEED) for i, j in zip(c, c[1:]))
        assert total == pytest.approx(best_chain(a, b))


def test_planted_passages(spark):
    r = random.Random(12)
    say = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    exact, fuzzy = say(60), say(90)
    rows, planted = [], {}
    for i in range(60):
        words, at = say(200), r.randrange(200)
        if i < 12:
            words[at:at] = exact
            planted[i] = (at, at + 60)
        elif i < 24:
            x = list(fuzzy)
            for k in (15, 40, 63):
                x[(k + i) % 90] = f"z{r.randrange(10**6)}"
            del x[30 + i % 5]
            words[at:at] = x
            planted[i] = (at, at + 89)
        rows.append((i, " ".join(words)))
    out = defaultdict(list)
    for p in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        out[p["doc_id"]].append(p)
    assert set(out) == set(planted)
    for i, (a, b) in planted.items():
        p = out[i][0]
        assert len(out[i]) == 1 and abs(p["first_word"] - a) <= 6 and abs(p["last_word"] + 1 - b) <= 6
        assert p["partner_id"] != i and (p["partner_id"] < 12) == (i < 12) and p["identity"] >= 0.8


def brute_passage(x, y):
    """Whether a local alignment by dynamic programming (+1 equal, -2 else) is a passage."""
    best, score, back = (0, 0, 0), np.zeros((len(x) + 1, len(y) + 1), int), {}
    for i, w in enumerate(x, 1):
        for j, v in enumerate(y, 1):
            score[i, j], back[i, j] = max((0, 0), (score[i - 1, j - 1] + (1 if w == v else -2), 1),
                                          (score[i - 1, j] - 2, 2), (score[i, j - 1] - 2, 3))
            best = max(best, (score[i, j], i, j))
    _, i, j = best
    at, same, columns = (i, j), 0, 0
    while i and j and back[i, j]:
        step = back[i, j]
        same, columns = same + (step == 1 and x[i - 1] == y[j - 1]), columns + 1
        i, j = i - (step != 3), j - (step != 2)
    return min(at[0] - i, at[1] - j) >= passages.LEAST_WORDS and same >= passages.IDENTITY * columns


@pytest.mark.parametrize("identity", [0.95, 0.9, 0.85, 0.8])
def test_recall_against_brute_force_alignment(spark, identity):
    r = random.Random(int(identity * 100))
    say = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    rows, wanted = [], set()
    for i in range(24):
        n = r.choice((60, 100, 150))
        one = say(n)
        other = list(one)
        for k in range(round(n * (1 - identity))):               # every fifth word at 0.8
            other[min(n - 2, int((k + 0.5) / (1 - identity)))] = f"z{r.randrange(10**6)}"
        x, y = say(40) + one + say(40), say(60) + other + say(20)
        rows += [(2 * i, " ".join(x)), (2 * i + 1, " ".join(y))]
        if brute_passage(x, y):
            wanted |= {2 * i, 2 * i + 1}
    got = {p["doc_id"] for p in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(wanted) >= 36 and wanted <= got


def test_halves_shared_with_outsiders_do_not_hide_a_passage(spark):
    """Two documents share 61 words, joint word changed; six others each share one of the halves only."""
    r = random.Random(3)
    say = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    rows, wanted = [], set()
    for g in range(4):
        left, right = say(30), say(30)
        for k in range(14):
            middle = left + say(1) + right if k in (5, 8) else left if k % 2 else right
            rows.append((100 * g + k, " ".join(say(40) + middle + say(40))))
        wanted |= {100 * g + 5, 100 * g + 8}
    got = {p["doc_id"] for p in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == wanted


def test_recall_under_common_phrases(spark):
    """Fuzzy passages in documents that all hold three common phrases of 20 words."""
    r = random.Random(4)
    say = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    phrases, rows, wanted = [say(20) for _ in range(3)], [], set()
    for i in range(40):
        one = say(30) + phrases[i % 3] + say(30)
        other = list(one)
        for k in range(4, 80, 10):
            other[k] = f"z{r.randrange(10**6)}"
        for j, x in enumerate((one, other)):
            rows.append((2 * i + j, " ".join(phrases[(i + 1) % 3] + say(50) + x + say(50) + phrases[(i + 2) % 3])))
            wanted.add(2 * i + j)
    rows += [(1000 + i, " ".join(say(60) + phrases[i % 3] + say(60))) for i in range(60)]
    got = {p["doc_id"] for p in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(d >= 1000 for d in got) and len(got & wanted) >= 0.9 * len(wanted)


def test_only_shared_dense_seeds_become_rows(spark, monkeypatch):
    monkeypatch.setattr(passages, "CHUNK_WORDS", 700)
    r = random.Random(8)
    say = lambda n: [f"v{r.randrange(10**5)}" for _ in range(n)]
    phrase, notice = say(25), say(5)
    rows = [(i, " ".join(say(50) + (phrase if i % 2 else notice) + say(50)), 125) for i in range(300)]
    texts = spark.createDataFrame(rows, "tid long, text string, words long")
    got = defaultdict(set)
    for x in passages.kept_seeds(texts).collect():
        got[x["tid"]].add(x["pos"])
    assert set(got) == {i for i in range(300) if i % 2}                    # a notice of two seeds is no passage's
    assert all(50 in p and 71 in p and p <= set(range(47, 76)) for p in got.values())
    # The phrase is announced once a chunk, however many texts have it.
    chunks = texts.select((F.col("tid") / 5).cast("long").alias("chunk"), "text").repartition(1).sortWithinPartitions("chunk")
    out = chunks.mapInPandas(passages._announce(40, 32), "range int, chunk long, block binary, twice binary").toPandas()
    shared = int(passages.seeds(passages.word_hashes(" ".join(phrase)))[1][:1].view(np.uint64)[0] >> np.uint64(24))
    assert sum(shared in passages._unpacked(b) for b in out["block"]) == len(set(out["chunk"])) == 60


def test_thinned_runs_agree():
    """Texts that share a run keep the same seeds of it, whatever stands around."""
    r = np.random.default_rng(5)
    run = r.integers(-2**62, 2**62, 80)
    kept = []
    for before in (0, 3, 40):
        h = np.concatenate([r.integers(-2**62, 2**62, before), run])
        times = np.concatenate([np.full(before, 3), np.full(80, 2)])
        stays = passages.thin(np.arange(len(h)), h, times)[before:]
        kept.append(set(run[stays]))
    assert kept[0] == kept[1] == kept[2] and 80 / passages.THIN <= len(kept[0]) <= 40
    assert passages.thin(np.arange(11), run[:11], np.full(11, 2)).all()
    assert not passages.dense(np.array([0, 1, 2, 3, 4, 99])).any() and passages.dense(np.arange(0, 112, 16)).sum() == 0
    assert passages.dense(np.array([0, 10, 20, 30, 40, 50, 95, 300])).tolist() == [True] * 7 + [False]


def test_passages_of_odd_rows(odd, nothing):
    out = {r["doc_id"]: r for r in passages.repeated(odd).collect()}
    # 1, 2, 11 and the row without id share a body; the others are short, alone or of one word.
    assert {1, 2, 11} <= set(out) <= {1, 2, 11, None}
    assert passages.repeated(nothing).count() == 0


def test_ends_grow_together_as_they_do_one_by_one():
    r = np.random.default_rng(4)
    x, y = (r.integers(0, 3, 3000).astype("<u4") for _ in range(2))
    y[500:900] = x[500:900]
    y[700:900:7] = 9
    pa, pb, x_at, x_end, y_at, y_end = [], [], [], [], [], []
    for _ in range(800):
        a, n = int(r.integers(0, 2800)), int(r.integers(20, 200))
        b = a if r.random() < 0.5 else int(r.integers(0, 2800))
        points = np.sort(r.choice(16, 3, replace=False))
        for at, stop, ps, low in ((x_at, x_end, pa, a), (y_at, y_end, pb, b)):
            at.append(low)
            stop.append(low + n)
            ps.append(points)
    near = lambda s, lo, p: s[max(lo, lo + int(p[0]) - passages.MARGIN):lo + int(p[-1]) + passages.SEED + passages.MARGIN]
    kept = passages.long_enough(x, y, *map(np.array, (x_at, y_at, x_end, y_end)), pa, pb)
    for i, p in enumerate(pa):
        a, b = near(x[:x_end[i]], x_at[i], p), near(y[:y_end[i]], y_at[i], p)
        left, _ = passages._grow(a[:p[0]][::-1], b[:p[0]][::-1])
        right, _ = passages._grow(a[p[-1] + passages.SEED:], b[p[-1] + passages.SEED:])
        assert kept[i] == (left + right + passages.SEED + p[-1] - p[0] >= passages.LEAST_WORDS)
        a0, a1, b0, b1, _, _ = passages.align(a, b, p.tolist(), p.tolist())
        assert kept[i] or min(a1 - a0, b1 - b0) < passages.LEAST_WORDS
    assert 0 < kept.sum() < len(kept)


def test_fetched_words_leave_in_pieces(monkeypatch):
    """A task holds some ``_PIECE`` bytes of fetched words, however many and long the stretches that a text is asked for."""
    monkeypatch.setattr(passages, "_PIECE", 1 << 16)
    r = random.Random(3)
    texts = [" ".join(f"v{r.randrange(10**5)}" for _ in range(n)) for n in (3000, 80, 900)]
    wanted = [[{"tid": 100 * t + i, "pa": sorted(r.sample(range(n), 3)), "pb": [i, i + 9]} for i in range(k)]
              for t, (n, k) in enumerate([(2990, 400), (70, 1), (890, 0)])]
    chain = pyarrow.struct([("tid", pyarrow.int64()), ("pa", pyarrow.list_(pyarrow.int32())), ("pb", pyarrow.list_(pyarrow.int32()))])
    rows = pyarrow.RecordBatch.from_arrays([pyarrow.array([7, 8, 9]), pyarrow.array(texts), pyarrow.array(wanted, pyarrow.list_(chain))],
                                           ["tid", "text", "wanted"])
    for part, asked in ((rows, [0, 1, 2]), (rows.slice(1), [1, 2]), (rows.slice(2), [2])):
        pieces = [piece.to_pylist() for piece in passages._slices(iter([part]))]
        assert all(sum(len(row["a_words"]) for row in piece[:-1]) < 1 << 16 for piece in pieces)
        expected = []
        for t in asked:
            words = passages.word_hashes(texts[t]).astype("<u4")
            for w in wanted[t]:
                lo = max(0, w["pa"][0] - passages.MARGIN)
                expected.append(w | {"centre": 7 + t, "a_lo": lo, "a_words": words[lo:w["pa"][-1] + passages.SEED + passages.MARGIN].tobytes()})
        assert [row for piece in pieces for row in piece] == expected


def test_passages_leave_only_what_their_result_reads(spark, documents, monkeypatch):
    made = []
    monkeypatch.setattr(passages, "stage", lambda df, name: (made.append(name), common.stage(df, name))[1])
    before = set(common._paths.values())
    out = passages.repeated(documents)
    left = {os.path.basename(p).split("-")[0] for p in set(common._paths.values()) - before}
    assert {"hits", "ends", "contexts", "chains", "wanted", "slices"} <= set(made)
    assert not left & {"hits", "ends", "contexts", "chains", "wanted", "slices"}
    assert out.count() > 0


def test_a_stage_leaves_no_shuffle_files_and_reads_small_batches(spark):
    def sizes(batches):
        for pdf in batches:
            yield pdf.assign(id=len(pdf))

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllFiles())}
    before, conf = files(), {k: spark.conf.get(k, None) for k in common.STAGE_CONF}
    out = common.stage(spark.range(0, 8000, 1, 2).repartition(3, "id").mapInPandas(sizes, "id long"), "sizes")
    assert not {f for f in files() - before if f.startswith("shuffle_")}
    assert out.count() == 8000 and out.agg(F.max("id")).first()[0] <= 1000
    assert conf == {k: spark.conf.get(k, None) for k in common.STAGE_CONF}


def _pair(rng, words, changed):
    """Two texts of hashed words that share a stretch with some words changed, and a seed of it at its place in both."""
    at = [int(rng.integers(0, 90)), int(rng.integers(0, 90))]
    n = int(rng.integers(10, 90))
    shared = rng.integers(0, words, n)
    sides = []
    for lo in at:
        text = rng.integers(0, words, lo + n + int(rng.integers(0, 90)))
        text[lo:lo + n] = np.where(rng.random(n) < changed, rng.integers(0, words, n), shared)
        sides.append(text)
    i = int(rng.integers(0, n - passages.SEED + 1))
    for text, lo in zip(sides, at):
        text[lo + i:lo + i + passages.SEED] = shared[i:i + passages.SEED]
    return sides[0].astype("<u4"), sides[1].astype("<u4"), at[0] + i, at[1] + i


def test_bits_drop_no_match_that_holds_a_passage():
    rng, held = np.random.default_rng(5), 0
    for k in range(3000):
        a, b, i, j = _pair(rng, (4, 1 << 30)[k % 2], (0.0, 0.05, 0.1)[k % 3])
        bits = [(w & 1).astype(bool) for w in (a, b)]
        left = [passages.ahead(w[::-1])[len(w) - p] for w, p in zip(bits, (i, j))]
        right = [passages.ahead(w)[p + passages.SEED] for w, p in zip(bits, (i, j))]
        may = passages.may_hold(*(np.array([s[0] ^ s[1]]).view(np.int64) for s in (left, right)), np.array([min(i, j)]))[0]
        near = [w[max(0, p - passages.MARGIN):p + passages.SEED + passages.MARGIN] for w, p in ((a, i), (b, j))]
        a0, a1, b0, b1, same, columns = passages.align(*near, [min(i, passages.MARGIN)], [min(j, passages.MARGIN)])
        holds = min(a1 - a0, b1 - b0) >= passages.LEAST_WORDS and same >= passages.IDENTITY * columns
        assert may or not holds
        held += holds
    assert held > 300
    random = rng.integers(-2**63, 2**63 - 1, (2, 20_000))
    assert passages.may_hold(*random, np.full(20_000, passages.MARGIN)).mean() < 0.005


def test_chains_along_a_diagonal_equal_alignment():
    rng, fast = np.random.default_rng(6), 0
    x, y, x_first, y_first, left, right, pa, pb, expected = ([] for _ in range(9))
    for k in range(600):
        a, b, i, j = _pair(rng, (4, 1 << 30)[k % 2], (0.0, 0.03, 0.1)[k % 3])
        n = min(len(a) - i, len(b) - j) - passages.SEED + 1
        equal = [d for d in range(n) if (a[i + d:i + d + passages.SEED] == b[j + d:j + d + passages.SEED]).all()]
        points = sorted({0, *(d for d in equal if rng.random() < 0.5)})
        pa.append(np.array([i + d for d in points]))
        pb.append(np.array([j + d for d in points]) + (k % 50 == 49) * np.arange(len(points)))
        x_first.append(sum(map(len, x)) + i)
        y_first.append(sum(map(len, y)) + j)
        x.append(a)
        y.append(b)
        left.append(passages._grow(a[:i][::-1], b[:j][::-1])[0])
        right.append(passages._grow(a[i + points[-1] + passages.SEED:], b[j + points[-1] + passages.SEED:])[0])
        expected.append(passages.align(a, b, pa[-1].tolist(), pb[-1].tolist()) if k % 50 != 49 else None)
    same, columns, sure = passages.on_diagonal(np.concatenate(x), np.concatenate(y), *map(np.array, (x_first, y_first, left, right)), pa, pb)
    for k, e in enumerate(expected):
        if e is None:
            assert not sure[k] or len(pa[k]) == 1
        elif sure[k]:
            fast += 1
            a0, b0 = pa[k][0] - left[k], pb[k][0] - left[k]
            assert e == (a0, a0 + columns[k], b0, b0 + columns[k], same[k], columns[k])
    assert fast > 300


def test_straight_chains_equal_those_of_the_tree(monkeypatch):
    rng = np.random.default_rng(7)
    for _ in range(300):
        a = np.unique(rng.integers(0, (60, 600)[int(rng.integers(2))], int(rng.integers(1, 25)))).tolist()
        rng.shuffle(a)
        b = [v + 9 for v in a]
        straight = passages.chain(a, b)
        with monkeypatch.context() as m:
            m.setattr(passages, "all", lambda _: False, raising=False)
            assert passages.chain(a, b) == straight


def test_short_shared_phrases_fetch_no_words(spark):
    """A phrase of 30 words in every text makes seeds, but no chain that could reach 50 words."""
    rng = random.Random(8)
    phrase = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([f"x{rng.random()}" for _ in range(80)] + phrase + [f"y{rng.random()}" for _ in range(80)]), 190) for i in range(60)]
    hits = common.stage(passages.kept_seeds(spark.createDataFrame(rows, "tid long, text string, words long")), "hits")
    assert hits.select("tid").distinct().count() == 60
    assert passages.chained(hits, both=False).count() < 10


def test_texts_that_no_chain_names_are_not_moved(spark, monkeypatch):
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "tid long, text string")
    asked = common.stage(spark.createDataFrame([(1, "a"), (4, "b"), (4, "c"), (9, "d")], "tid long, wanted string"), "asked")
    assert sorted(r["tid"] for r in passages._only(texts, asked).collect()) == [1, 4]
    monkeypatch.setattr(passages, "BROADCAST_TEXTS", 2)
    assert passages._only(texts, asked).count() == 6


def test_words_of_many_texts_hash_as_one_by_one(monkeypatch):
    r = random.Random(9)
    texts = ["".join(r.choice("abcXYZ é\U0001f600ß\t\n\v\f\r  \x00\x1c\x85\xa0") for _ in range(r.randrange(200))) for _ in range(300)]
    texts += [" ".join("q" * r.randrange(40) + chr(r.randrange(33, 3000)) for _ in range(40)) for _ in range(60)] + ["", " ", "\ud800 x"]
    for piece in (1 << 20, 300):
        monkeypatch.setattr(passages, "_PIECE", piece)
        got = [words[a:b].tolist() for words, cuts in passages.hashed(texts) for a, b in zip(cuts, cuts[1:])]
        assert got == [passages.word_hashes(t).tolist() for t in texts]
        for (words, pos, h), t in zip(passages.seeded(texts), texts, strict=True):
            assert [x.tolist() for x in passages.seeds(words)] == [pos.tolist(), h.tolist()] and words.tolist() == passages.word_hashes(t).tolist()
    assert list(passages.hashed([])) == []


@pytest.mark.parametrize("dense", [512, 9])
def test_chains_of_many_groups_equal_those_one_by_one(monkeypatch, dense):
    """Matches of many texts chained at once, equal ones (several contexts of a seed) included."""
    monkeypatch.setattr(passages, "DENSE", dense)
    rng = np.random.default_rng(10)
    rows, expected = [], Counter()
    for k in range(400):
        n = int(rng.integers(1, 40))
        a = np.sort(rng.integers(0, (40, 300, 3000)[k % 3], n))
        b = a + 7 if k % 2 else rng.integers(0, 60, n)
        points = sorted(set(zip(a.tolist(), b.tolist())))
        times = rng.integers(1, 4, len(points)).tolist()
        rows += [(k // 3, k, x, y, t) for (x, y), t in zip(points, times)]
        x, y = ([p[side] for p, t in zip(points, times) for _ in range(t)] for side in (0, 1))
        expected.update({(k, tuple((x[i], y[i]) for i in c)) for c in passages.chain(x, y)})
    tid, centre, a, b, times = map(np.array, zip(*rows))
    points, sizes, again = passages._chained_points(tid, centre, a, b, times)
    got = [*np.split(points, np.cumsum(sizes)[:-1]), *again[:, None]]
    assert Counter((int(centre[c[0]]), tuple(zip(a[c].tolist(), b[c].tolist()))) for c in got) == expected


def align_point_by_point(x, y, pa, pb):
    """``passages.align`` with a part for each seed and each gap."""
    left, _ = passages._grow(x[:pa[0]][::-1], y[:pb[0]][::-1])
    at, bt = pa[0], pb[0]
    parts = [(left, left, x[at - left:at] == y[bt - left:bt])]
    for i, j in zip(pa, pb):
        skip = max(0, at - i, bt - j)
        i, j = i + skip, j + skip
        if skip < passages.SEED:
            got, width = passages._gap(x[at:i], y[bt:j])
            same = x[at:i] == y[bt:j] if i - at == j - bt and (x[at:i] == y[bt:j]).sum() == got else np.arange(width) < got
            parts += [(i - at, j - bt, same), (passages.SEED - skip,) * 2 + (np.ones(passages.SEED - skip, bool),)]
            at, bt = i + passages.SEED - skip, j + passages.SEED - skip
    right, _ = passages._grow(x[at:], y[bt:])
    parts.append((right, right, x[at:at + right] == y[bt:bt + right]))
    same = np.concatenate([p[2] for p in parts])
    if same.sum() < passages.IDENTITY * len(same):
        return None
    return pa[0] - left, pa[0] - left + sum(p[0] for p in parts), pb[0] - left, pb[0] - left + sum(p[1] for p in parts), same.sum(), len(same)


def test_runs_of_seeds_align_as_seed_by_seed(monkeypatch):
    rng, whole, gaps = np.random.default_rng(11), 0, []
    real = passages._gap
    for k in range(600):
        words = (4, 60, 1 << 30)[k % 3]
        y = rng.integers(0, words, 200).astype("<u4")
        x = y.copy()
        for i in rng.integers(10, 150, int(rng.integers(0, 8))):
            x = np.delete(x, slice(i, i + 2)) if k % 4 == 0 else np.insert(x, i, x[i:i + int(rng.integers(1, 5))])
            x[i + 9] = rng.integers(0, words)
        a, b = zip(*[(i, j) for i in range(len(x) - 3) for j in range(max(0, i - 20), min(197, i + 20)) if (x[i:i + 4] == y[j:j + 4]).all()])
        for c in passages.chain(list(a), list(b))[:3]:
            pa, pb = [a[i] for i in c], [b[i] for i in c]
            expected = align_point_by_point(x, y, pa, pb)
            monkeypatch.setattr(passages, "_gap", lambda u, v: (gaps.append(1), real(u, v))[1])
            gaps.clear()
            got = passages.align(x, y, pa, pb)
            monkeypatch.setattr(passages, "_gap", real)
            assert len(gaps) <= 1 + sum(q - p != pb[i] - pa[i] for i, (p, q) in enumerate(zip(pa[1:], pb[1:]))) + 30
            if expected:
                whole += 1
                assert got == expected
    assert whole > 400


def test_a_chunk_announces_each_seed_once(spark, monkeypatch):
    """A phrase of every text is announced once a chunk, and chains do not depend on the chunks."""
    rng = random.Random(12)
    say = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    phrase, shared = say(70), [say(60) for _ in range(5)]
    rows = [(i, " ".join(say(30) + phrase + say(30) + shared[i % 5] + say(9)), 199) for i in range(60)]
    texts = common.stage(spark.createDataFrame(rows, "tid long, text string, words long"), "texts")
    found = []
    for words in (199 * 10, 1 << 20):
        monkeypatch.setattr(passages, "CHUNK_WORDS", words)
        hits = common.stage(passages.kept_blocks(texts), "hits")
        chunks = 6 if words < 2000 else 1
        assert hits.count() == chunks
        announced = Counter(h for pdf in passages._announce_ends(32, False)(iter([hits.toPandas()])) for b in pdf["block"]
                            for h in passages._unfolded(b)[0].tolist())
        assert max(announced.values()) == chunks
        found.append([{(r["tid"], r["centre"], *r["pa"], *r["pb"]) for r in passages.linked(hits, both).collect()} for both in (False, True)])
    assert found[0] == found[1] and len(found[0][0]) >= 59 and len(found[0][1]) > len(found[0][0])
