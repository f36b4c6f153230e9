"""Near-dedup, mixing, sampled pieces, packing, top-k, pages and the pipeline
against plain Python."""

import html
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import html_text, mixing, near_dup, packing, pieces, topk

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
needs_tokenizers = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="tokenizer files not present")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------- near-dedup


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(rows, percent=85):
    sets = [(d, plain_set(t)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return sorted(((d, len(x), None if d is None else find(d), d is None or find(d) == d) for d, x in sets), key=str)


def components_of(docs):
    return sorted([tuple(r) for r in near_dup.near_duplicates(docs).collect()], key=str)


def edited(rng, words, share):
    return [w if rng.rand() > share else f"new{rng.randint(10**6)}" for w in words]


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.RandomState(1)
    rows, doc = [], 0
    for group in range(12):
        words = [f"w{rng.randint(400)}" for _ in range(rng.randint(8, 300))]
        for _ in range(rng.randint(1, 12)):
            # chains too: each copy of the one before
            words = edited(rng, words, rng.choice([0, 0.005, 0.01, 0.02, 0.05]))
            rows.append((doc, " ".join(words).title() if rng.rand() < 0.2 else " ".join(words)))
            doc += 1
    rows += [(1000, ""), (1001, None), (1002, " \n"), (1003, "one two"), (1004, "One  two"), (1005, "two one"), (None, rows[0][1]), (0, rows[0][1])]
    assert components_of(frame(spark, rows).repartition(5)) == plain_components(rows)


def test_near_duplicates_in_one_large_group(spark, monkeypatch):
    """Copies around the threshold: many links between members that aren't the
    smallest, cells of a few members."""
    monkeypatch.setattr(near_dup, "CELL", 16)
    rng = np.random.RandomState(2)
    base = [f"w{i}" for i in range(150)]
    rows = [(d, " ".join(edited(rng, base, rng.choice([0.005, 0.01, 0.02, 0.03])))) for d in range(150)]
    assert components_of(frame(spark, rows)) == plain_components(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 201), (201, 250), (7, 7)]
    got = {r.node: r.component for r in near_dup.components(frame(spark, edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 300: 201, 201: 201, 250: 201}
    assert {k: v for k, v in got.items()} == want


def test_estimate_matches_similarity():
    rng = np.random.RandomState(4)
    for share in (0.2, 0.5, 0.85):
        n = 4000
        both = rng.randint(0, 2**63, int(n * share), dtype=np.uint64)
        x, y = (np.unique(np.concatenate([both, rng.randint(0, 2**63, (n - len(both)) // 2, dtype=np.uint64)])) for _ in "ab")
        sx, sy = (near_dup.signature(near_dup.minima(near_dup._mix(v))) for v in (x, y))
        d = sx ^ sy
        unlike = int(np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum())
        assert abs(((1 - unlike / near_dup.FIELDS) - 0.25) / 0.75 - share) < 0.16


@pytest.mark.parametrize("percent", [0, 60, 79, 101])
def test_thresholds_that_the_bands_would_miss_are_refused(percent):
    with pytest.raises(ValueError, match="percent"):
        near_dup.near_duplicates(None, percent=percent)


def test_deduplicate_keeps_columns_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = frame(spark, [(2, text, "a", 1), (1, text, "b", 2), (3, "other", "c", 3), (None, text, "d", 4)], "doc_id long, text string, class string, node int")
    out = near_dup.deduplicate(docs)
    assert out.columns == docs.columns and sorted(r["class"] for r in out.collect()) == ["b", "c", "d"]
    assert components_of(frame(spark, [])) == []


# -------------------------------------------------------------------- mixing


def fill(budget, children):
    """Water-filling by rounds: {name: (weight, capacity)}."""
    given = dict.fromkeys(children, 0.0)
    open_ = {c for c, (w, cap) in children.items() if w and cap}
    left = float(budget)
    while open_ and left > 1e-9:
        total = sum(children[c][0] for c in open_)
        step = min([left / total] + [(children[c][1] - given[c]) / children[c][0] for c in open_])
        for c in open_:
            given[c] += step * children[c][0]
        left -= step * total
        open_ = {c for c in open_ if children[c][1] - given[c] > 1e-9}
    return given


def test_budgets_against_water_filling(spark):
    rng = np.random.RandomState(8)
    weights = {"domain": {"d0": 3, "*": 1}, "lang": {"en": 5, "*": 1}, "source": {"s1": 7, "*": 2}}
    for share in (0.3, 1.0, 1.6):
        leaves = [(f"d{d}", lang, f"s{k}", int(rng.randint(1, 10) ** rng.randint(1, 6))) for d in range(3) for lang in ("en", "fr", None) for k in range(rng.randint(1, 5))]
        total = int(share * sum(x[3] for x in leaves))
        got = mixing.leaf_budgets(frame(spark, leaves, "domain string, lang string, source string, tokens long"), total, weights, 2)
        got = {(r.domain, r.lang, r.source): r.budget for r in got.collect()}
        weight = lambda level, name: weights[level].get(name, weights[level]["*"])
        cap = lambda *key: 2 * sum(x[3] for x in leaves if x[: len(key)] == key)
        want = {}
        top = fill(total, {d: (weight("domain", d), cap(d)) for d in {x[0] for x in leaves}})
        for d, budget in top.items():
            middle = fill(budget, {lang: (weight("lang", lang), cap(d, lang)) for lang in {x[1] for x in leaves if x[0] == d}})
            for lang, part in middle.items():
                last = fill(part, {s: (weight("source", s), cap(d, lang, s)) for s in {x[2] for x in leaves if x[:2] == (d, lang)}})
                want |= {(d, lang, s): v for s, v in last.items()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) <= 4 for k in want)
        assert sum(got.values()) <= total


def test_mix_takes_prefixes_of_epochs(spark):
    rng = np.random.RandomState(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), str(rng.choice(["en", "fr"])), f"s{min(9, rng.randint(14))}") for i in range(400)]
    rows += [(None, "a b", None, None), (5000, None, "en", "s1"), (5001, "", "en", "s1"), (3, rows[3][1], rows[3][2], rows[3][3])]
    docs = frame(spark, rows, "doc_id long, text string, lang string, source string").withColumn("epoch", F.lit("mine")).withColumn("domain", F.lit("x"))
    out = mixing.mix(docs, {}, F.lit("all"), share=0.9, max_epochs=3)
    got = Counter((r.doc, r.lang, r.source, r.n_tokens, r.epoch) for r in out.collect())
    again = Counter((r.doc, r.lang, r.source, r.n_tokens, r.epoch) for r in mixing.mix(docs.repartition(7), {}, F.lit("all"), share=0.9, max_epochs=3).collect())
    assert got == again
    taken = sum(k[3] * n for k, n in got.items())
    total = sum(len((t or "").split()) for _, t, *_ in rows)
    assert 0.9 * total - 11 * 30 * 2 <= taken <= 0.9 * total
    assert out.where("row.epoch = 'mine' and row.domain = 'x'").count() == out.count()
    assert mixing.mix(docs.limit(0), {}, F.lit("all")).count() == 0


# -------------------------------------------------------------------- pieces

ODD = ["", " ", "  ", "hello  world\n x ▁y ", "▁", "\t\n\r", "日本語 ☃🙂", "a" * 300, " leading", "trailing ", "é" * 50 + "\x00​", "x\n\n   y"]


def all_segmentations(segment, model):
    """{pieces: probability} of a segment given without its first space."""
    chars = "▁" + segment.replace(" ", "▁")
    by_piece = {int(p): float(w) for p, w in zip(model.piece, model.weight, strict=True) if p >= 0}
    name = {model.bytes[p].decode().replace(" ", "▁"): p for p in by_piece}
    out = {}

    def grow(at, ids, weight):
        if at == len(chars):
            out[tuple(ids)] = np.exp(weight)
        for end in range(at + 1, len(chars) + 1):
            if chars[at:end] in name:
                p = name[chars[at:end]]
                grow(end, [*ids, p], weight + by_piece[p])

    grow(0, [], 0.0)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


@needs_tokenizers
def test_pieces_are_lossless_and_reproducible(spark):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = list(enumerate(ODD)) + [(99, None), (None, "null key"), (None, "null key")]
    first = pieces.decode(pieces.encode(frame(spark, rows))).collect()
    assert sorted((str(r.row.doc_id), r.text) for r in first) == sorted((str(d), t or "") for d, t in rows)
    other = pieces.encode(frame(spark, rows).repartition(3)).collect()
    assert sorted((str(r.row.doc_id), r.ids) for r in first) == sorted((str(r.row.doc_id), r.ids) for r in other)
    for r in first:
        if "▁" not in r.text and r.text:
            assert own.decode(r.ids) == r.text
    assert pieces.encode(frame(spark, [])).count() == 0
    seeds = [pieces.encode(frame(spark, [(1, "the reproducible segmentation of words")]), seed=s).first().ids for s in range(6)]
    assert len({tuple(x) for x in seeds}) > 1


@needs_tokenizers
def test_sampling_has_the_lattice_distribution():
    model = pieces.load(pieces.MODEL, 0.7)
    word, n = "tion and", 40000
    want = all_segmentations("tion", model)
    keys = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    ids, counts = pieces.sample([word] * n, keys, model)
    starts = np.cumsum(counts) - counts
    got = Counter()
    for s, c in zip(starts.tolist(), counts.tolist(), strict=True):
        seen = 0
        for k in range(c):
            seen += len(model.bytes[ids[s + k]])
            if seen == len(" tion"):
                got[tuple(ids[s : s + k + 1].tolist())] += 1
                break
    assert set(got) <= set(want) and sum(got.values()) == n
    for k, p in want.items():
        assert abs(got[k] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-4


# ------------------------------------------------------------------- packing


def plain_best_fit(lengths, size):
    rows, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [(room[r], r) for r in range(len(rows)) if room[r] >= lengths[i]]
        r = min(fits)[1] if fits else len(rows)
        if not fits:
            rows.append([]), room.append(size)
        rows[r].append(i)
        room[r] -= lengths[i]
    return sorted(room)


def test_best_fit_takes_the_tightest_row():
    rng = np.random.RandomState(6)
    for size in (1, 7, 64, 100):
        for _ in range(20):
            lengths = rng.randint(1, size + 1, rng.randint(0, 60)).tolist()
            rows = packing.best_fit(lengths, size)
            assert sorted(i for row in rows for i in row) == list(range(len(lengths)))
            rooms = sorted(size - sum(lengths[i] for i in row) for row in rows)
            assert rooms == plain_best_fit(lengths, size) and min(rooms, default=0) >= 0


@needs_tokenizers
def test_packing_is_lossless(spark):
    encode = packing.tokeniser(packing.RANKS).encode_ordinary
    texts = ["", "hello world", "long " * 500, "x" * 100, "日本語 " * 40] + [f"text number {i} " * (i % 9) for i in range(60)]
    rows = list(enumerate(texts)) + [(900, None)]
    out = packing.pack(frame(spark, rows).repartition(3), row_length=64).collect()
    parts = {}
    for r in out:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(positions) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] <= 64
        for doc, start, a, b in zip(r.docs, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert positions[a:b].tolist() == list(range(b - a))
            parts.setdefault(doc, {})[start] = ids[a:b].tolist()
        assert set(ids[r.cu_seqlens[-1] :]) <= {packing.END}
    for doc, text in rows:
        assert [i for s in sorted(parts[doc]) for i in parts[doc][s]] == [*encode(text or ""), packing.END]
    assert packing.pack(frame(spark, [])).count() == 0


# --------------------------------------------------------------------- top-k


def test_grid_copies_both_sides_alike():
    for n in (10**7, 10**8):
        asked = n // 50
        rows, columns = topk.grid(asked, n)
        cells = asked * n / topk.CELL_SCORES
        assert cells <= rows * columns <= cells + 2 * columns
        assert 0.5 < (asked * columns) / (n * rows) < 2
        # copied vectors, against a copy of all queries for each SPAN_ROWS candidates
        assert asked * columns + n * rows < 0.3 * asked * (n / topk.SPAN_ROWS)
    assert topk.grid(10, 500) == (1, 1) and topk.grid(0, 0) == (1, 1)


def test_blocks_are_as_narrow_as_their_values():
    for least, most, width in ((-128, 127, 1), (-128, 128, 2), (0, 255, 2), (-32769, 0, 4), (0, 2**31, 8), (-(2**62), 5, 8)):
        batch = pa.RecordBatch.from_arrays([pa.array([4, 2]), pa.array([[least, most], [most]])], names=["vec", "v"])
        (block,) = topk._blocks(iter([batch]))
        got = topk._matrix(*(block.column(n)[0] for n in ("matrix", "n", "width")))
        assert got.tolist() == [[most, 0], [least, most]] and block.column("width")[0].as_py() == width


@pytest.mark.parametrize("cell", [60, 400, 2**30])
def test_top_k_against_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "SPAN_ROWS", 40)
    monkeypatch.setattr(topk, "CELL_SCORES", cell)
    rng = np.random.RandomState(12)
    rows = [(i, [float(x) if rng.rand() > 0.3 else 0.001 for x in rng.randn(6)]) for i in range(150)]
    rows[20:40] = [(i, rows[20][1]) for i in range(20, 40)]  # ties
    rows += [(50, rows[50][1]), (400, None), (401, [1.0, None, 2.0]), (402, [float("nan")] * 6), (403, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (404, [2.0])]
    vectors = frame(spark, rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("mine"))
    got = [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect()]
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            usable[i] = q + [0] * (6 - len(q))
    want = []
    for q in sorted(usable):
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(usable[q], v, strict=True)), i) for i, v in usable.items() if i != q)[:5]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == want
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    few = frame(spark, [(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 256 * 512)]


# --------------------------------------------------------------------- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header>Site</header><nav><ul><li><a href=x>Home<li><a>About</ul></nav><div class="cookie-notice">We use cookies</div>
<main><h1>Title &amp;  more</h1><p>First <b>bold</b>&nbsp;text<br>next<p>Second &lt;p&gt;<!-- no <p>hidden</p> --><div class=ad>Buy</div>
<ul><li>one<li>two</ul><table><tr><td>cell<td>other</table><form><input value=1>Go</form><section id="comments"><p>nice!</p></section></main>
<aside>side</aside><footer>foot &copy;</footer></body></html>"""


def texts_of(spark, pages):
    return {r.row.url: r.text for r in html_text.main_text(spark.createDataFrame(pages, "url string, html string")).collect()}


def test_page_rules(spark):
    got = texts_of(spark, [("http://a.example/1", PAGE), ("http://a.example/2", None), (None, "<p>x"), ("http://a.example/3", ""), ("bad url", "plain & text < 3")])
    assert got["http://a.example/1"] == "Title & more\nFirst bold text next\nSecond <p>\none\ntwo\ncell\nother"
    assert got["http://a.example/2"] == got["http://a.example/3"] == "" and got[None] == "x" and got["bad url"] == "plain & text < 3"


def test_site_template_is_removed_and_shared_passages_stay(spark):
    template = "<div><p>Read our <a href=/t>terms</a> before use</p></div>"
    teaser = "<div><a href=/1>Other story</a> <a href=/2>And another</a></div>"
    shared = "<p>A passage that several articles hold word for word.</p>"
    bare = [(f"http://bare.example/{i}", f"<body>{template}<div><p>Own text {i}.</p></div></body>") for i in range(8)]
    marked = [(f"http://marked.example/{i}", f"<body><article><p>Own {i}.</p>{shared}{teaser}</article></body>") for i in range(8)]
    lone = [("http://lone.example/1", f"<body>{template}<p>Alone.</p></body>")]
    copies = [(f"http://copy.example/{i}", "<body><div><p>The same page.</p></div></body>") for i in range(9)]
    got = texts_of(spark, bare + marked + lone + copies)
    assert all(got[u] == f"Own text {i}." for i, (u, _) in enumerate(bare))
    assert all(got[u] == f"Own {i}.\nA passage that several articles hold word for word." for i, (u, _) in enumerate(marked))
    assert got["http://lone.example/1"] == "Read our terms before use\nAlone."
    assert {got[u] for u, _ in copies} == {"The same page."}
    assert texts_of(spark, []) == {}


def test_templates_of_a_part_of_a_large_host(spark):
    box = "<div><p>Subscribe for more of this section.</p></div>"
    passage = "<p>A paragraph that many pages quote.</p>"
    links = "<div><a href=/1>One</a> <a href=/2>Two</a></div>"
    report = "<div><p>" + "A report that is reprinted. " * 20 + "</p></div>"

    def page(i):
        own = f"<div><p>{f'Own words {i}. ' * 20}</p></div>"
        if i % 5 == 0:
            return f"<body>{box}{own}{passage}{links}</body>"
        return f"<body>{report}<p>Place {i}.</p></body>" if i % 5 == 1 else f"<body>{own}</body>"

    got = texts_of(spark, [(f"http://large.example/{i}", page(i)) for i in range(300)])
    for i in range(300):
        own = (f"Own words {i}. " * 20).strip()
        report_text = ("A report that is reprinted. " * 20).strip()
        want = {0: f"{own}\nA paragraph that many pages quote.", 1: f"{report_text}\nPlace {i}."}.get(i % 5, own)
        assert got[f"http://large.example/{i}"] == want


def read(page):
    return html_text.read_text(html_text.parse(page), frozenset())[0]


def test_wrappers_and_ordinary_words_stay():
    body = "<article><p>The story.</p><p class=share-price>Price 12.</p><div class='promo-code-guide'>Guide.</div><div class=promo>Buy</div></article>"
    for name in ("wrapper has-sidebar", "no-comments", "ad-free", "sidebar", "widget", "site-overlay", "notice"):
        assert read(f"<body><div class='{name}'>{body}</div></body>") == "The story.\nPrice 12.\nGuide.", name
        assert read(f"<body><div id='{name}'><p>Long enough to be the page.</p></div><p>Short.</p></body>") == "Long enough to be the page.\nShort.", name


def test_telling_classes_still_go():
    text = "<p>" + "The story goes on. " * 20 + "</p>"
    for name in ("site-footer", "comments-area", "cookie-banner", "ad ad-300x250", "x sidebar-left", "social_share", "related-posts", "comment-list"):
        assert read(f"<body>{text}<div class='{name}'><p>Not this.</p></div></body>") == ("The story goes on. " * 20).strip(), name
    teaser = "<div class=related><article>Other story</article></div><div id=comments><article>" + "I say. " * 200 + "</article></div>"
    assert read(f"<body><article>{text}</article>{teaser}</body>") == ("The story goes on. " * 20).strip()


NAMED_OUT = (
    "article-comments user-comments reader-comments fb-comments CommentsSection google-ad adsbygoogle sponsored-content leaderboard-ad "
    "advertisement-label cookie-policy blog-sidebar sitenav mainNav article-footer related-articles author-bio rightSidebar post__footer "
    "top-nav-bar AdSlot sidebar2 newsletter-box related-posts"
).split()
NOT_NAMED = (
    "has-sidebar no-comments share-price promo-code-guide ad-free with-footer hasComments show-comments comments-off sidebar-toggle-story "
    "cookie-recipe footer-of-the-bill navigator adventure broadband loaded headline article-body menu-planning advice unrelated biology dinner-menu"
).split()


@pytest.mark.parametrize("where", ["beside", "inside"])
def test_classes_tell_by_their_last_word(where):
    text = "<p>" + "The story goes on. " * 20 + "</p>"
    story = ("The story goes on. " * 20).strip()
    page = {"beside": "<body><div>{0}</div>{1}</body>", "inside": "<body><article>{0}{1}</article></body>"}[where]
    for names, want in ((NAMED_OUT, story), (NOT_NAMED, f"{story}\nA box.")):
        for name in names:
            for attribute in ("class", "id"):
                assert read(page.format(text, f"<div {attribute}='{name}'><p>A box.</p></div>")) == want, (name, attribute)


def test_last_words_dont_name_what_holds_the_text():
    text = "<p>" + "The story goes on. " * 20 + "</p>"
    for name in ("page-with-blog-sidebar", "blog-sidebar", "google-ad", "site-footer", "mainNav"):
        assert read(f"<body><div class='{name}'>{text}</div><p>Short.</p></body>").startswith("The story"), name


@needs_tables
def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("row", F.lit(1)).withColumn("text", F.lit("mine"))
    got = {r.row.page_id: r.text for r in html_text.main_text(pages, carry=["page_id", "row"]).collect()}
    for p in pages.collect():
        body = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body))
        assert got[p.page_id] == "\n".join(b for b in blocks if b)


def test_very_deep_and_long_pages(spark):
    got = texts_of(spark, [("u", "<div>" * 20000 + "deep" + "</div>" * 20000), ("v", "<p>" + "word " * 200000), ("w", "<a" * 5000), ("x", '<a href="' + "y" * 100000)])
    assert got["u"] == "deep" and len(got["v"]) == 5 * 200000 - 1


# ------------------------------------------------------------------ pipeline


@needs_tables
@needs_tokenizers
def test_pipeline_stages_are_the_operators(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "", "", 0)], docs.schema)
    docs = docs.union(odd)
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        before = {(r.doc_id) for r in docs.collect()}
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert {r.doc_id for r in docs.collect()} <= before
        assert name == "sentencepiece" or docs.columns == columns
        if name == "near_dedup":
            left = [(r.doc_id, r.text) for r in docs.collect()]
            assert all(kept for *_, kept in plain_components(left))
    assert docs.count() > 0


@needs_tables
@needs_tokenizers
def test_pipeline_of_an_empty_table(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)


@needs_tables
def test_oracles(spark):
    import duckdb

    from cohortlens.llm.oracle import ORACLE_SQL
    from cohortlens.llm.queries import queries

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in ORACLE_SQL.items():
        got, want = queries()[name](spark, SF), con.sql(sql)
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        rows = sorted((tuple(r) for r in got.select(columns).collect()), key=str)
        assert rows == sorted(want.select(*columns).fetchall(), key=str), name
