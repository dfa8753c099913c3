"""Classifiers and page extraction on made-up data, and the pipeline end to end."""

import functools
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandlake.llm import classify, html_extract, language_id, toxicity
from strandlake.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tongues(spark):
    rng = np.random.RandomState(4)
    parts = {"aa": ["ka", "mo", "ti", "lu"], "bb": ["sch", "ung", "ver", "ich"], "cc": ["ção", "nho", "ões", "lhe"]}
    rows = [(i, " ".join("".join(rng.choice(parts[l], 3)) for _ in range(rng.randint(5, 60))), l) for i in range(300) for l in [sorted(parts)[i % 3]]]
    rows += [(900, None, "aa"), (901, "", None), (902, "12 34 !", "bb"), (None, "kamoti", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages_of_held_out_documents(tongues):
    model = language_id.fit_language(tongues)
    got = {r.doc_id: r for r in language_id.identify(tongues, model).collect()}
    held = tongues.where("doc_id < 300 AND crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1").collect()
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (900, 901, 902))
    assert sum(r.rejected for i, r in got.items() if i is not None and i < 300) <= 3
    assert language_id.identify(tongues.limit(0), model).count() == 0


def test_toxic_words_and_their_misspellings(spark):
    rng = np.random.RandomState(5)
    plain = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(1200):
        bad = i % 4 == 0
        words = list(rng.choice(plain, 30)) + (["horridword", "vileword"] if bad else [])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(5000, "horridwordd vilewordz " + " ".join(plain[:20])), (5001, " ".join(plain[20:50])), (5002, None), (None, "abc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels + [(None, 1)], "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    held = docs.where("doc_id < 1200 AND crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0").collect()
    assert sum(got[r.doc_id].predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert got[5000].score > got[5001].score and all(0 <= r.score <= 1 for r in got.values()) and len(got) == len(rows)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def page(k, body):
    return f"<html><head><title>t{k}</title><script>var a='</p>';</script></head><body><div>Site name</div><nav><a href='/'>n{k}</a></nav>{body}<div class='cookie-notice'>We use cookies</div><footer>f{k}</footer></body>"


def test_template_and_boilerplate_go_content_stays(spark):
    bare = [(k, f"http://one.test/{k}", page(k, f"<div><p>Text&nbsp;of <b>page</b>\n {k}<p>Second &amp; last {k}</div><div>Follow us</div><form>q</form>")) for k in range(8)]
    article = [(20 + k, f"https://two.test/{k}?x", page(k, f"<article><h1>Head {k}</h1><p><b>a<br><p>b {k}</p><div class=\"comments\">c</div></article><p>outside</p>")) for k in range(3)]
    rows = bare + article + [(90, None, None), (91, "odd", ""), (92, "http://one.test/92", bare[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert all(got[k].text == f"Text of page {k}\nSecond & last {k}" for k in range(8))
    assert got[92].text == got[0].text and got[20].text == "Head 0\na\nb 0"
    assert got[90].text == "" and got[91].text == "" and got[90].n_chars == 0 and got[20].n_chars == len(got[20].text)
    assert html_extract.extract(df.limit(0)).count() == 0


def test_wrappers_with_a_listed_word_in_their_name_stay():
    names = ("content has-sidebar", "no-header", "layout--with-nav", "sidebar", "form")
    for k, name in enumerate(names):
        pages = [f"<div class='nav'>n{i}</div><div class='{name}'><article><h1>Head {i}</h1><p>Body {i}</article></div>" for i in range(k % 2 * 2 + 1)]
        assert html_extract.group_texts(pages) == [f"Head {i}\nBody {i}" for i in range(len(pages))]
    most = ["<form><div id='widget'><p>" + "long text " * 9 + f"{i}</div><div class='ad banner'>buy {i}</div><div class='comment-form'>c{i}</div><div class=entry-header>Head {i}</div></form>" for i in range(3)]
    assert html_extract.group_texts(most) == ["long text " * 9 + f"{i}\nHead {i}" for i in range(3)]
    assert html_extract.group_texts(["<p>text of the page</p><nav><article>card</article></nav><div aria-label='Main menu' class='menu'>m</div><section aria-label='Social policy'>kept</section>"]) == ["text of the page\nkept"]


def test_groups_of_a_host_are_at_least_half_full(spark):
    for n in (0, 1, 15, 16, 33, 48, 49, 64, 65, 96, 97, 200):
        pages = [f"{k}" for k in range(n) for _ in range(1 + k % 3)]
        ends = html_extract.cut(pages, True)
        sizes = [len(set(pages[a:b])) for a, b in zip([0, *ends], ends)]
        assert sum(sizes) == n and all(16 <= s <= 48 for s in sizes if n >= 16) and (not ends or ends[-1] == len(pages))
        assert not {x for a, b in zip(ends, ends[1:]) for x in (set(pages[:a]) & set(pages[a:b]))}
    rows = [(k if k % 5 else None, f"http://big.test/{k}", page(k, f"<article><p>Body {k}</p><p>Follow us</p></article>")) for k in range(1500)]
    rows += [(2000 + k, "http://big.test/same", rows[7][2]) for k in range(700)]
    rows += [(3000 + k, "http://small.test/", page(k, f"<article><p>Body {k}</p><p>Follow us</p></article>")) for k in range(33 + 1)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and {r.text for r in got} == {f"Body {k}" for k in range(1500)}


def test_tree_matching_is_the_largest_order_keeping_match():
    shapes = html_extract.Shapes()
    a, b = (html_extract.parse(x) for x in ("<ul><li>1<li>2<li><b>3</b></ul><p>x", "<ul><li><b>0</b><li>2</ul><p>x<p>y"))
    shapes.name(a), shapes.name(b)
    # the roots, both ul, p with its text, and 3 of the li: the third with the first, or two li and one text (both can't keep the order)
    assert shapes.match(a.shape, b.shape) == best(a, b) == 1 + (1 + 3) + 2


def best(a, b):
    """Brute force: nodes in the largest order-keeping match of two trees whose roots are matched."""
    if a.tag != b.tag:
        return 0

    @functools.cache
    def rest(i, j):
        if i == len(a.kids) or j == len(b.kids):
            return 0
        return max(rest(i + 1, j), rest(i, j + 1), best(a.kids[i], b.kids[j]) + rest(i + 1, j + 1))

    return 1 + rest(0, 0)


def trees(rng, n):
    tags = rng.sample(["p", "li", "div", "b"], 3)
    return html_extract.parse("".join(f"<{t}>{'<i>x</i>' * rng.randint(0, 2)}{'y' * rng.randint(0, 1)}</{t}>" for t in rng.choices(tags, k=n)))


@pytest.mark.parametrize("cells", [1, 40, 1 << 21])
def test_long_matches_equal_brute_force(monkeypatch, cells):
    monkeypatch.setattr(html_extract, "CELLS", cells)
    rng = random.Random(cells)
    for n, m in [(0, 9), (1, 1), (3, 4), (14, 15), (16, 16), (17, 30), (40, 25), (1, 300)]:
        shapes, a, b = html_extract.Shapes(), trees(rng, n), trees(rng, m)
        shapes.name(a), shapes.name(b)
        assert shapes.match(a.shape, b.shape) == best(a, b)
        pairs = shapes.aligned(a.kids, b.kids)
        places = [([id(k) for k in a.kids].index(id(x)), [id(k) for k in b.kids].index(id(y))) for x, y in pairs]
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(places, places[1:]))
        assert 1 + sum(shapes.match(x.shape, y.shape) for x, y in pairs) == best(a, b)


def test_long_lists_take_little_time():
    rng = random.Random(5)
    pages = [html_extract.parse("<table>" + "".join(f"<tr><td>{k}{'<td><b>x</b>' * rng.randint(0, 3)}</tr>" for k in range(1500)) + "</table>") for _ in range(8)]
    began = time.process_time()
    html_extract.induce(pages)
    assert time.process_time() - began < 10


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_induction_alone_finds_the_main_part():
    """No element and no name tells the parts of these pages apart; the aligned trees do."""
    pages, want = [], []
    for i in range(12):
        body = [f"Paragraph {i} {k} " + " ".join(f"w{i * k * j}" for j in range(60)) for k in range(1, 2 + i % 4)]
        pages.append(
            f"<html><body><div><div><span>Home</span> <span>Topics</span></div><div>Teaser number {i * 7}</div>"
            f"<div><div><b>Heading {i}</b></div>{''.join(f'<div>{p}</div>' for p in body)}</div><div>All rights kept</div></div></body></html>"
        )
        want.append("\n".join([f"Heading {i}", *body]))
    assert html_extract.group_texts(pages) == want
    assert html_extract.group_texts(pages[:1]) != want[:1]  # with one page there is nothing to align


def test_odd_markup_takes_linear_time_and_loses_no_text():
    pages = ["<div>" * 5000 + "deep" + "</div>" * 5000 + "after", "<a " * 20000 + "x", "<p class=a'b>hello", "<p>t</p>" + "<a ='>'" * 20000, "<b>" * 20000 + "</i>" * 20000 + "z", "1 < 2", "<!-- x", "<svg/>s<script>1"]
    began = time.process_time()
    texts = [html_extract.group_texts([p])[0] for p in pages]
    assert time.process_time() - began < 10
    assert texts[0] == "deep\nafter" and texts[2] == "hello" and texts[4:] == ["z", "1 < 2", "", "s"]


def test_pipeline_on_the_smallest_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = {r.doc_id for r in out.collect()}
    assert 0.5 * docs.count() < len(left) <= docs.count()
    leaks = {r.doc_id for r in QUERIES["op10_decontamination"](spark, SF).collect()}
    assert not leaks & left


def test_empty_and_unlabelled_tables_and_null_ids(spark, tmp_path):
    words = " ".join(f"word{k}" for k in range(30))
    docs = spark.createDataFrame([(None, "some more " + words, "en"), (None, "nothing of that kind " * 9, "en"), (1, None, "en"), (1, "123", None), (None, "...", None)], "doc_id long, text string, lang string")
    spark.createDataFrame([(1, words), (None, "nothing of that kind")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r.text for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()] == [r.text for r in docs.collect()][1:]
    assert sorted(r.text for r in corpus_pipeline.language(spark, docs, str(tmp_path)).collect()) == ["nothing of that kind " * 9, "some more " + words]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect()] == [0.0] * 5
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op1_toxicity", "op6_language_id"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_samples_hold_what_is_asked_for_however_many_rows_there_are(spark):
    many = 20_000_000
    rows = spark.range(many).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 7, "few").otherwise("many").alias("label"))
    chosen, counts = classify.sampled(rows, 24, {"few": 7, "many": many - 7})
    got = [r.label for r in chosen.collect()]
    assert got.count("few") == 7 and got.count("many") == 12 and counts == {"few": 7, "many": many - 7}
    assert sorted(map(tuple, classify.sampled(rows.repartition(3), 24, counts)[0].collect())) == sorted(map(tuple, chosen.collect()))


def test_an_id_repeated_many_times_is_learned_once(spark):
    docs = spark.createDataFrame([(1, f"alpha beta {k}", "en") for k in range(500)] + [(k, "gamma delta", "fr") for k in range(2, 9)], "doc_id long, text string, lang string")
    known = docs.select("doc_id", F.col("lang").alias("label")).distinct()
    model = classify.fit(docs.select("doc_id", "text"), known, 100, language_id.SETTINGS, prior=False)
    assert sorted(model.labels) == ["en", "fr"]


def test_names_of_queries_and_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "repeats", "decontamination", "packing"]
