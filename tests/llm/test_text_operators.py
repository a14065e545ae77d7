"""Chat formatting, HTML extraction, language ID, toxicity."""

import hashlib
import random
import time

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from skeinworks.llm import chat_format as cf  # noqa: E402
from skeinworks.llm import html_extract, language_id, toxicity  # noqa: E402

BYTE = P.path("byte_bpe_50k.json")


def test_masks_cover_trained_texts_exactly():
    from tokenizers import Tokenizer, processors

    library = Tokenizer.from_file(BYTE)
    library.add_special_tokens([cf.TURN, cf.TEXT, cf.END])
    library.post_processor = processors.ByteLevel(trim_offsets=False)
    rnd = random.Random(2)
    runs = [[(rnd.choice(["user", "assistant", "system", None, "<|end|>"]), "".join(rnd.choice("ab <[\\|>é漢🙂\n </s>[INST]<|end|><|turn|>") for _ in range(rnd.randint(0, 30)))) for _ in range(rnd.randint(1, 6))] for _ in range(200)]
    for said, (text, ids, offsets, mask) in zip(runs, cf.encode_marked(BYTE, [[cf.turn(r, t, "assistant") for r, t in run] for run in runs]), strict=True):
        want = library.encode(text, add_special_tokens=False)
        assert ids.tolist() == want.ids and offsets.tolist() == [list(o) for o in want.offsets]
        assert cf.read_turns(text) == [(r or "", t) for r, t in said]
        assert cf.unescape(cf.masked_text(text, offsets, mask)) == "".join(t for r, t in said if r == "assistant")


def test_token_mask_empty_cases():
    none = np.zeros((0, 2), dtype=np.int64)
    assert cf.token_mask(none, none).tolist() == []
    assert cf.token_mask(np.array([[0, 1], [1, 1], [2, 4]]), np.array([[0, 2]])).tolist() == [True, False, False]


def test_conversations_in_order_with_long_ones_in_parts(spark, monkeypatch):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (None, 0, "assistant", "x"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "x")
    got = {r.conv_id: r for r in cf.conversation_digests(cf.with_probe(table), BYTE).collect()}
    assert set(got) == {1, 2, None, 3, -7}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\na\nassistant\nb\n").hexdigest() and got[1].loss_chars == 1
    assert got[3].n_turns == 2 and got[3].loss_sha256 == hashlib.sha256(b"samesame").hexdigest()
    assert got[-7].loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()
    assert got[2].loss_chars == 0 and got[2].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert cf.conversation_digests(table.limit(0), BYTE).count() == 0
    formatted = cf.format_conversations(table, BYTE).where("conv_id = 1").collect()
    assert len(formatted) == 1 and len(formatted[0].ids) == len(formatted[0].loss)
    long = [[cf.turn("user", "x" * 9, "assistant")] * 3]
    assert len(list(cf.encode_marked(BYTE, long))) == 1


PAGE = """<!doctype html><html><head><title>T</title><script>var a = "</p>";</script></head><body>
<div id="cookie-banner">We use cookies to make this site and it is great for you.</div><header><h1>My site</h1></header>
<div class="content"><h2>The title of it</h2><p>This is the first paragraph of the article and it has a lot of words that are in the list.</p><p>Yes.</p>
<p>And this is the last paragraph of the article &amp; it is as long as the first one was, with more to come.</div>
<div class="sidebar"><p>this is a side bar and it is not to be in the text of the article at all, you see</p></div>
<ul><li><a href=x>one link</a></li><li><a href=y>two</a></li></ul>
<section id="comments"><p>I am a reader and this is my comment on the article that was here before it.</p></section>
<footer>(c) it is the end of the page and that is all there is for you</footer>"""


def test_main_text_without_and_with_article():
    want = "The title of it This is the first paragraph of the article and it has a lot of words that are in the list. Yes. And this is the last paragraph of the article & it is as long as the first one was, with more to come."
    assert html_extract.extract(PAGE) == want
    assert html_extract.extract("<nav><a>x</a></nav><article><h1>Hi</h1><p>a<br>b&nbsp; c<p><b>d</article><aside>the and of it is so on and on</aside>") == "Hi a b c d"
    plain = "<div><a href=a>one</a> <a href=b>two</a></div><div><h2>Head</h2><p>" + "word the of and other text " * 8 + "</p><p>Sh is.</p></div><footer>the end of it</footer>"
    assert html_extract.extract(plain) == "Head " + " ".join(("word the of and other text " * 8).split()) + " Sh is."
    for odd in ("", "<", "<p", "&", "<article>", "<!--", "<script>", "</p></div>", "<a href='x", "<p>a</q>"):
        assert isinstance(html_extract.extract(odd), str)


ARTICLE = "This is the first of the paragraphs and it has a lot of the words that are in the list of words."


@pytest.mark.parametrize(
    "page",
    [
        "<body><svg/><p>{}</p></body>",
        "<body><svg viewBox='0 0 1 1'/><nav>a menu of the site</nav><p>{}</p><svg><title>of the</title><path/></svg></body>",
        "<body><svg><path/><p>x</svg><p>{}</p></body>",
        '<body><form id="aspnetForm"><h1></h1><nav>and the menu is in it</nav><h1>{}</h1></form></body>',
        '<body><form id="aspnetForm"><div class="menu">this and that is the menu of it</div><article><p>{}</p></article></form></body>',
        '<body><article class="commentary"><p>{}</p></article></body>',
        '<body><div class="commentary"><p>{}</p></div></body>',
        '<body><div class="page with-sidebar"><h1>{}</h1><div class="sidebar">this is in the side bar of it</div></div></body>',
        '<article><p class="advertisement">It is the best of the things that you can buy.</p><p>{}</p></article>',
        '<article><div class="legal"><p>{}</p></div></article>',
        '<article><p>{}</p><div class="reader-comments"><p>' + "I was here and this is what I say to it. " * 20 + "</p></div></article>",
        '<body><main><p>{}</p></main><section id="commentBox7"><p>' + "I was here and this is what I say to it. " * 20 + "</p></section></body>",
        "<body><template><p>this is not to be shown at all and it is of no use</p></template><p>{}</p><noscript>you have to switch it on for this</noscript></body>",
        "<body><p>{}</p><textarea></body>",
        '<body><div class="cookieBanner">We use it for the good of all and you have to say that it is so.</div><div role="main"><p>{}</p></div></body>',
    ],
)
def test_boxes_that_frame_and_boxes_that_do_not(page):
    assert html_extract.extract(page.format(ARTICLE)) == ARTICLE


OTHER = "The market was in the hall of the old town and it is there that they meet on the first day of it."


@pytest.mark.parametrize("name", ["social-history", "market-share", "notice-of-change history", "advert-free reading", "shared-memory", "commentary", "relatedness", "share-price", "nav-chart ocean", "banner-years", "newsletter-archive text"])
def test_ordinary_names_that_hold_telling_words(name):
    assert html_extract.extract(f'<article><p>{ARTICLE}</p><section class="{name}"><p>{OTHER}</p></section></article>') == f"{ARTICLE} {OTHER}"
    assert html_extract.extract(f'<body><h1>{ARTICLE}</h1><div id="{name.replace(" ", "-")}"><p>{OTHER}</p></div></body>') == f"{ARTICLE} {OTHER}"


@pytest.mark.parametrize("name", ["social-links", "share-buttons", "related-posts", "site-notice", "ad-slot top", "postComments", "user-feedback", "newsletter-signup-box", "cookie_notice_bar", "widget-area"])
def test_telling_names(name):
    assert html_extract.extract(f'<article><p>{ARTICLE}</p><section class="{name}"><p>{OTHER}</p></section></article>') == ARTICLE


@pytest.mark.parametrize("heading", ["3 responses", "12 Comments", "Comments (4)", "Leave a reply", "2 responses to “The hall”", "3 Kommentare", "Reader comments:"])
def test_comments_by_their_heading(heading):
    said = f'<section class="x1"><h3>{heading}</h3><div><p>{OTHER}</p></div><ol><li>{OTHER}</li></ol></section>'
    assert html_extract.extract(f"<article><p>{ARTICLE}</p>{said}</article>") == ARTICLE
    assert html_extract.extract(f"<body><div><p>{ARTICLE}</p></div>{said}</body>") == ARTICLE


def test_headings_like_those_of_comments():
    for page in (f"<article><h2>3 responses</h2><p>{ARTICLE}</p></article>", f"<article><p>{OTHER}</p><section><h2>3 responses to a crisis</h2><p>{ARTICLE}</p></section></article>", f"<article><div><p>{OTHER}</p><h2>Comments</h2><p>{ARTICLE}</p></div></article>"):
        assert html_extract.extract(page).endswith(ARTICLE)


@pytest.mark.parametrize("tag", ["p data-x=don't", "p title=a\"b", "p 'x", 'p "x', "p data-x = 'a>b'", "p a=\"x>y\" b=c'd", "p =x", "p a=", "p a= b", "p/a='>'"])
def test_attributes_by_the_rules(tag):
    assert html_extract.extract(f"<article><{tag}>{ARTICLE}</p><p>it's {OTHER}</p></article>") == f"{ARTICLE} it's {OTHER}"


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000 + "</span>" * 100_000, "<div>" * 100_000 + "</p></li>" * 50_000, "<div class=ad>" * 100_000, "<b class=ad>x" * 50_000, "<div class=ad><h1>x" * 50_000, "<textarea>" * 100_000, "<title>x" * 100_000, "<a b='" * 50_000, "<p =" * 100_000,
     "<" * 300_000, "<!--" * 100_000, "<section><h2>Comments</h2>" * 30_000, "<p>" * 200_000, "&amp" * 200_000, "<div>x</div>" * 100_000, "<li>x" * 100_000, "= = " * 100_000, "<x " + "= " * 300_000, "<form>" * 50_000 + "<h1>x</h1>" + "y" * 1000],
    ids=range(19),
)
def test_long_and_deep_pages_take_linear_time(page):
    began = time.process_time()
    html_extract.extract(f"{page}<article><p>{ARTICLE}</p></article>")
    assert time.process_time() - began < 10


def _generated(rnd):
    """A page of one of several templates, and its main text."""
    def words(n):
        return " ".join(rnd.choice("the of and to in is that it was for on with house river stone market garden winter people morning letter music".split()) for _ in range(n)).capitalize() + "."
    def noise():
        return rnd.choice([
            "<nav><ul>" + "".join(f"<li><a href='/{i}'>{words(2)}</a></li>" for i in range(5)) + "</ul></nav>", f'<div class="{rnd.choice(["ad", "ads-top", "sidebar", "cookie-notice", "share-links", "newsletter"])}"><p>{words(12)}</p></div>',
            f"<footer><p>{words(15)}</p></footer>", f"<aside>{words(14)}</aside>", f"<form><label>{words(4)}</label><input><button>{words(1)}</button></form>", f"<script>var x = '<p>{words(9)}</p>';</script>", "<svg/>", f"<!-- {words(8)} -->",
        ])
    title, body = words(5), [words(rnd.randint(12, 60)) for _ in range(rnd.randint(2, 8))]
    inner = f"<h1>{title}</h1>" + "".join(f"<p>{b}</p>" + (rnd.choice(["", "", noise()])) for b in body)
    opened, closed = rnd.choice([("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>"), ('<form id="aspnetForm"><div>', "</div></form>"), ('<div class="layout has-sidebar">', "</div>")])
    comments = f'<section class="comments"><h3>{words(2)}</h3>' + "".join(f"<div class='comment'><p>{words(30)}</p></div>" for _ in range(rnd.randint(0, 6))) + "</section>"
    return f"<html><head><title>{title}</title></head><body>{noise()}{noise()}{opened}{inner}{closed}{comments}{noise()}</body></html>", " ".join([title, *body])


def test_planted_truth_of_generated_pages():
    rnd = random.Random(9)
    pages = [_generated(rnd) for _ in range(400)]
    assert [i for i, (page, want) in enumerate(pages) if html_extract.extract(page) != want] == []


def test_pages_query_cases(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>x y</p></article>", 5), (1, "u", "<article><p>x y</p></article>", 6), (2, None, None, 7), (None, "v", "", 8)], "page_id long, url string, html string, text long")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_extract.main_texts(pages).collect())
    assert got == [(0, "", 0), (1, "x y", 3), (1, "x y", 3), (2, "", 0)]
    assert html_extract.main_texts(pages.limit(0)).count() == 0


def test_language_network_learns_and_handles_cases(spark):
    rnd = random.Random(1)
    words = {"aa": ["bana", "lano", "mira", "sola"], "zz": ["krzt", "wxyq", "zvgh", "qkkp"]}
    rows = [(i, " ".join(rnd.choice(words[l]) for _ in range(60)), l) for i in range(240) for l in [("aa", "zz")[i % 2]]]
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "123 $$$", None), (902, "", None), (None, "bana lano " * 30000, None)], "doc_id long, text string, lang string")
    net = language_id.train(docs.where("doc_id < 200"))
    got = {r.doc_id: r for r in language_id.identify(docs, net).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows if i >= 200)
    assert [got[i].lang_pred for i in (900, 901, 902, None)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = language_id.keep_identified(docs, net)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, _, _ in rows} | {None}
    nothing = language_id.train(docs.limit(0))
    assert nothing.classes == [] and language_id.identify(docs, nothing).where("lang_pred <> 'und'").count() == 0


def test_letters_are_what_unicode_calls_letters(spark):
    net = language_id.ByteConvNet.fresh(["aa", "bb"])
    assert [p for p, _ in net.predict(["²", "½ 3", "Ⅷ", "①②", "_1_", "", "é", "漢", "12 a"])] == ["und"] * 6 + [p for p, _ in net.predict(["é", "漢", "12 a"])]
    assert all(p != "und" for p, _ in net.predict(["é", "漢", "12 a"]))


def test_repeated_ids_do_not_change_the_language_sample(spark):
    docs = spark.createDataFrame([(i // 3, f"{'bana lano' if i % 2 else 'krzt wxyq'} {i}", "ab"[i % 2]) for i in range(90)], "doc_id long, text string, lang string")
    first, second = language_id.train(docs), language_id.train(docs.union(docs).repartition(5))
    assert first.classes == second.classes and all((first.taps[w] == second.taps[w]).all() for w in language_id.WIDTHS)


def _labelled(n, seed):
    """Insults make a text toxic; 'women' merely comes along with them, 'men' with clean texts."""
    rnd = random.Random(seed)
    plain = [f"word{i}" for i in range(60)]
    out = []
    for i in range(n):
        toxic = i % 4 == 0
        said = [rnd.choice(plain) for _ in range(20)] + (["scumbag"] if toxic and rnd.random() < 0.8 else [])
        if rnd.random() < (0.9 if toxic else 0.15):
            said.insert(rnd.randrange(len(said)), "women")
        elif rnd.random() < 0.5:
            said.insert(rnd.randrange(len(said)), "men")
        out.append((i, " ".join(said), int(toxic)))
    return out


def _pairs(texts, terms):
    known = toxicity.swaps(terms)
    return [(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)) for t in texts for x, y in toxicity.pairs_of(t, known)]


def test_counterfactual_penalty_protects_neutral_mentions():
    rows = _labelled(800, 1)
    texts = [(toxicity.digests(toxicity.words(t)), y) for _, t, y in rows]
    plain, fair = toxicity.fit(texts, []), toxicity.fit(texts, _pairs([t for _, t, _ in rows], "women men"), balance=0.5)
    def gap(m):
        return m.score_many(["some women said word1"])[0] - m.score_many(["some men said word1"])[0]
    assert gap(fair) < 0.5 * gap(plain)
    assert fair.score_many(["you scumbag women word3"])[0] > 0.7 > fair.score_many(["the women of word3"])[0]


def test_neutral_held_out_sentences_score_alike_for_each_group():
    rnd = random.Random(4)
    line = toxicity.IDENTITY_TERMS.strip().split("\n")[0].split()
    rows = []
    for i in range(1500):
        toxic = i % 3 == 0
        said = [f"word{rnd.randrange(80)}" for _ in range(15)] + [rnd.choice(line[:3] if toxic and rnd.random() < 0.8 else line)]
        rows.append((" ".join(said + (["scumbag"] if toxic and rnd.random() < 0.8 else [])), int(toxic)))
    texts = [(toxicity.digests(toxicity.words(t)), y) for t, y in rows]
    plain, fair = toxicity.fit(texts, []), toxicity.fit(texts, _pairs([t for t, _ in rows], toxicity.IDENTITY_TERMS), toxicity.swaps())
    neutral = [f"the {group} of word{n} went home" for group in line for n in (200, 201)]
    spread = lambda m: max(m.score_many(neutral)) - min(m.score_many(neutral))
    assert spread(plain) > 0.3 and spread(fair) < 0.1 * spread(plain)
    assert min(fair.score_many([f"a scumbag and {g}" for g in line])) > 0.5


def test_swaps_stay_in_language_and_form():
    known = toxicity.swaps()
    assert known["women"] == "men" and known["arabs"] == "women" and known["immigrant"] == "refugee" and known["jewish"] == "disabled"
    assert set(known) == set(known.values()) | set(known) and all(k != v for k, v in known.items())
    assert {"woman", "muslim", "immigrant", "jewish"} <= set(known)


def test_every_mention_of_a_text_is_swapped(spark):
    rows = [(i, " ".join(f"{w} of w{chr(97 + i % 7)}." for w in ("Women", "men", "Jews") * 3) + (" A scumbag woman said so." * 2 if i % 2 else " The man went home."), i % 2) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    known = toxicity.swaps()
    changes = [sorted(toxicity.pairs_of(t, known)) for _, t, _ in rows]
    assert all(len(p) == len(set(p)) == 4 for p in changes)
    want = toxicity.fit([(toxicity.digests(toxicity.words(t)), y) for _, t, y in rows], _pairs([t for _, t, _ in rows], toxicity.IDENTITY_TERMS), known)
    assert toxicity.train(docs, labels).weights == want.weights
    # Copies of an id and other texts under it change what is learnt to one text of the id, whatever the partitions.
    more = docs.union(docs).union(docs.selectExpr("doc_id", "concat(text, ' scumbag')"))
    assert toxicity.train(more, labels).weights == toxicity.train(more.repartition(7), labels).weights


def test_toxicity_query_cases(spark):
    rows = _labelled(400, 2)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (None, "scumbag " * 50000, "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, model).collect()}
    assert len(got) == len(rows) + 2 and all(0 <= s <= 1 for s in got.values())
    assert got[900] < 0.5 < got[None]
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id IS NULL").count() == 0 and kept.where("doc_id = 900").count() == 1
    assert toxicity.toxicity(docs.limit(0), model).count() == 0
    assert toxicity.train(docs, labels.limit(0)).score_many(["scumbag"])[0] < 0.5


def test_long_conversations_come_in_runs(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(cf, "RUN_CHARS", 3)
    rows = pa.RecordBatch.from_pydict({"conv_id": [1, 1, 1, 2], "turn": [0, 1, 2, 0], "role": ["user", "assistant", "assistant", "user"], "text": ["aaaa", "bbbb", "cccc", "d"]})
    runs = [r for batch in cf._runs(iter([rows]), "assistant") for r in batch]
    assert [(c, first, last, len(turns)) for c, first, last, turns in runs] == [(1, True, False, 1), (1, False, False, 1), (1, False, True, 1), (2, True, True, 1)]
    texts = [cf.masked_text(text, offsets, mask) for text, _, offsets, mask in cf.encode_marked(BYTE, [r[3] for r in runs])]
    assert texts == ["", "bbbb", "cccc", ""]
