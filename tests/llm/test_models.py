"""Language model, classifier, extraction, preferences and pipeline."""

import collections
import math
import random
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from roomtide.llm import extraction, language_model, preferences, toxicity
from roomtide.llm.elias_fano import EliasFano, NgramTrie, dequantised, quantised
from roomtide.llm.queries import queries

from llm_data import ODD, docs, prose  # noqa: F401


def test_elias_fano():
    rng = np.random.default_rng(1)
    for count, top in ((0, 5), (1, 5), (1000, 3000), (2000, 2**63), (3000, 3000), (10, 1)):
        values = np.sort(rng.integers(0, top, count).astype(np.uint64))
        sequence, end = EliasFano.load(EliasFano.of(values).dump(), 0)
        assert (sequence[np.arange(count)] == values).all()
        wanted = np.concatenate([values, rng.integers(0, top, 500).astype(np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        at, equal = sequence.successor(wanted)
        assert (at == np.searchsorted(values, wanted)).all() and (equal == np.isin(wanted, values)).all()


def test_trie_from_a_mapped_file(tmp_path):
    contexts = np.array([3, 10, 2**63], np.uint64)
    keys = np.array([5, 9, (1 << 32) + 7, (2 << 32) + 5], np.uint64)
    trie = NgramTrie.build(contexts, np.array([4, 1, 2]), keys, np.array([3, 1, 1, 2]), 0.75)
    (tmp_path / "trie").write_bytes(trie.dump())
    mapped = NgramTrie.open(str(tmp_path / "trie"))
    codes = mapped.lookup(np.array([3, 3, 3, 10, 10, 2**63, 4], np.uint64), np.array([5, 9, 7, 7, 5, 5, 5], np.uint32))
    assert codes[[2, 4, 6]].tolist() == [0, 0, 0]
    assert dequantised(codes[[0, 1, 3, 5]]) == pytest.approx([2.25 / 4, 0.25 / 4, 0.25, 1.25 / 2], rel=0.04)
    assert quantised(np.array([0, 1, 1e-12])).tolist() == [0, 1, 255]


def brute_scores(rows, discount):
    tokens = [(t or "").encode().lower().split() + ["end"] for _, t in rows]
    held = [None if i is None else zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    words, pairs = collections.Counter(), collections.Counter()
    for line, out in zip(tokens, held):
        if out is False:
            words.update(line)
            pairs.update(zip(["start", *line], line))
    total, kinds = sum(words.values()), len(words)
    followed, distinct = collections.Counter(), collections.Counter()
    for (first, _), n in pairs.items():
        followed[first] += n
        distinct[first] += 1
    for (i, _), line, out in zip(rows, tokens, held):
        base = [(words[w] + 0.5) / (total + 0.5 * (kinds + 1)) for w in line]
        score = 0.0
        for v, w, p in zip(["start", *line], line, base):
            if followed[v]:
                p = max(pairs[v, w] - discount, 0) / followed[v] + discount * distinct[v] / followed[v] * p
            score += math.log10(p)
        yield i, bool(out), len(line), sum(words[w] > 0 for w in line), total, sum(map(math.log10, base)), score


@pytest.mark.parametrize("chunk_tokens,shards", [(1 << 21, 3), (300, 5), (50, 40)])
def test_scores_equal_a_plain_model(docs, chunk_tokens, shards):
    rng = random.Random(2)
    rows = ODD + [(10 + k, prose(rng, rng.randrange(1, 200))) for k in range(60)] + [(200, "ONE two"), (200, "one TWO")]
    rows += [(300 + k, rows[20][1]) for k in range(6)]
    got = sorted(map(tuple, language_model.score_corpus(docs(rows).coalesce(2), shards=shards, chunk_tokens=chunk_tokens).collect()), key=str)
    expected = sorted(brute_scores(rows, language_model.DISCOUNT), key=str)
    assert len(got) == len(expected)
    for a, b in zip(sorted(got, key=lambda r: (str(r[:5]), r[5])), sorted(expected, key=lambda r: (str(r[:5]), r[5]))):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])
        assert abs(a[6] - b[6]) < 0.02 * a[2]
    assert language_model.score_corpus(docs([])).count() == 0
    (alone,) = language_model.score_corpus(docs([(None, "a b")])).collect()
    assert (alone.n_known, alone.train_tokens, alone.score) == (0, 0, pytest.approx(alone.base_score))


def labelled(seed, n=600):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randrange(20, 120)).split()
        toxic = rng.random() < 0.2
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["Idiot", "scumbag,", "scummy", "trashy", "moron!"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_classifier_on_held_out_documents(docs, spark):
    rows, labels = labelled(3)
    table = spark.createDataFrame(labels + [(None, 1), (9999, None), (0, labels[0][1])], "doc_id long, toxic int")
    got = toxicity.score_documents(docs(rows + ODD), table).collect()
    assert len(got) == len(rows) + len(ODD)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id in truth and r.doc_id > 5]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    again = toxicity.score_documents(docs(rows + ODD), table).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_classifier_ignores_held_out_labels_and_knows_nothing_without_labels(docs, spark):
    rows, labels = labelled(4, 200)
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    flipped = spark.createDataFrame(
        [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels], "doc_id long, toxic int"
    )
    one, other = (sorted(map(tuple, toxicity.score_documents(docs(rows), t).collect())) for t in (table, flipped))
    assert one == other
    none = toxicity.score_documents(docs(rows), table.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 0)}
    kept = toxicity.accepted(docs(rows + ODD), toxicity.fit(docs(rows), table))
    assert kept.columns == docs([]).columns and len(rows) > kept.count() - len(ODD) > 0.7 * len(rows)


class PlainFtrl:
    """One coordinate at a time, as the update rule is written."""

    def __init__(self, alpha, beta, l1, l2, bias):
        self.alpha, self.beta, self.l1, self.l2, self.bias = alpha, beta, l1, l2, bias
        self.z, self.n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(self, i):
        l1 = 0.0 if i == self.bias else self.l1
        if abs(self.z[i]) <= l1:
            return 0.0
        return -(self.z[i] - math.copysign(l1, self.z[i])) / ((self.beta + math.sqrt(self.n[i])) / self.alpha + self.l2)

    def learn(self, at, label):
        weights = {i: self.weight(i) for i in at}
        slope = 1 / (1 + math.exp(-sum(weights.values()))) - label
        for i in at:
            change = (math.sqrt(self.n[i] + slope**2) - math.sqrt(self.n[i])) / self.alpha
            self.z[i] += slope - change * weights[i]
            self.n[i] += slope**2


def test_ftrl_equals_the_plain_rule():
    rng = np.random.default_rng(6)
    model, plain = toxicity.Ftrl(0.5, 1.0, 0.3, 0.1), PlainFtrl(0.5, 1.0, 0.3, 0.1, toxicity.SIZE)
    for _ in range(300):
        at = np.append(np.unique(rng.integers(0, 60, 8)), toxicity.SIZE)
        label = int(at[0] < 5)
        model.learn(at, label)
        plain.learn(at.tolist(), label)
    seen = np.append(np.arange(60), toxicity.SIZE)
    assert model.weights(seen) == pytest.approx([plain.weight(i) for i in seen.tolist()])


def test_training_bounds_and_contradicting_labels(docs, spark):
    rows, labels = labelled(6, 120)
    table = spark.createDataFrame([*labels, *((i, 1 - y) for i, y in labels)], "doc_id long, toxic int")
    toxic = spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id long, toxic int")
    assert toxicity.fit(docs(rows), table) == toxicity.fit(docs(rows), toxic)  # one label that says so counts
    plain = spark.createDataFrame(labels, "doc_id long, toxic int")
    few = toxicity.fit(docs(rows), plain, max_features=1)
    assert few and len(few) < len(toxicity.fit(docs(rows), plain))  # a single text was learned from


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(5)
    model = toxicity.Ftrl(l1=2.0)
    for _ in range(2000):
        at = np.unique(rng.integers(10, 2000, 30))
        label = int(rng.random() < 0.3)
        model.learn(np.append(np.unique(np.append(at, 1)) if label else at, toxicity.SIZE), label)
    weights = model.weights(np.arange(toxicity.SIZE + 1))
    assert weights[1] > 2 and np.count_nonzero(weights) < 300


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p><p>no";</script></head><body>
<header class="site"><h1>Site name</h1><a href="/">home</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div id="cookie-notice">We use cookies on this site and many others, accept them please.</div>
<div class="layout"><div class="post-{n} entry"><header><h2>Head &amp; line {n}</h2><span>by a person</span></header>
<p>First   paragraph of page {n}, with <b>bold</b> words &eacute;nough&nbsp;to count.<p>Second one<br>after a break that is long enough, too.
<ul><li>item one<li>item two</ul><div class="ad-slot">Buy now</div><blockquote>Quoted words that stay in the text of it.</blockquote>
<form><label>Your name</label><input></form><p style="display: none">hidden</p></div>
<aside class="sidebar">Related things to read that are no part of it at all.</aside></div>
<section class="comments"><p>{comment}</p></section><footer>Copyright</footer>"""
BODY = (
    "Head & line {n}\nFirst paragraph of page {n}, with bold words énough to count.\n"
    "Second one after a break that is long enough, too.\nitem one\nitem two\nQuoted words that stay in the text of it."
)


def test_extraction(spark):
    rows = [(k, f"http://a.example/{k}?x=1", PAGE.format(n=k, comment="long words of a reader " * (40 * (k % 2)))) for k in range(6)]
    rows += [
        (10, "https://b.example/", "<p>Only a paragraph without any container, and no end tag"),
        (11, "https://b.example/x", "<body><article><h1>T</h1><p>Words of an article that are long enough here.</p></article><p>outside, short</p>"),
        (12, None, None), (13, "", ""), (14, "nonsense", "<<<&&&>>> &lt;b&gt; 5 < 6"), (2, rows[2][1], rows[2][2]),
        (None, "http://c.example", "<div>" * 300 + "deep words that go on for quite some time" + "</div>" * 300),
    ]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, TEXT string, paths int")
    got = {r.page_id: r for r in extraction.extract(pages.drop("TEXT", "paths")).collect()}
    assert extraction.extract(pages.select("page_id", "url", "html")).count() == len(rows)
    for k in range(6):
        assert got[k].text == BODY.format(n=k)
    assert got[10].text == "Only a paragraph without any container, and no end tag"
    assert got[11].text == "T\nWords of an article that are long enough here."
    assert [got[k].text for k in (12, 13)] == ["", ""] and got[14].text.endswith("<b> 5 < 6")
    assert got[None].text == "deep words that go on for quite some time"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extraction.extract(pages.limit(0).select("page_id", "url", "html")).count() == 0


@pytest.mark.parametrize("html,text", [
    ("<div class='layout has-sidebar'><main><p>Words of the main part, long enough.</p></main></div>", "Words of the main part, long enough."),
    ("<div id='sidebar-page'><article><p>Words of an article, long enough.</p></article></div>", "Words of an article, long enough."),
    ("<nav>menu</nav><div class='ads'>Buy things</div><footer>end</footer>", ""),
    ("<main><h1>T</h1><div class='body'>text <i>in</i> a<br/>container that is long enough</div><div id='respond'>Your reply</div></main>",
     "T\ntext in a container that is long enough"),
    ("<body><p>One &#233;&nbsp;&lt;tag&gt; word and some more words</p><textarea>typed</textarea><noscript>no</noscript></body>",
     "One é <tag> word and some more words"),
    ("<article><p>First long paragraph of the text here.</p><span class='share-buttons'>Share</span><p>Second <!-- no --> one.</p>"
     "<section class='reader-comments'><p>I say this.</p></section></article>", "First long paragraph of the text here.\nSecond one."),
    ("<table><tr><td>Layout cell with many words in it, and more</td><td><ul class='menu'><li>x</li></ul></td></tr></table>",
     "Layout cell with many words in it, and more"),
])
def test_pages(html, text):
    page = extraction.Page(html)
    path = page.best_path()
    assert (page.text_under(path) if path is not None else "") == text


LEAD, ONE, TWO = ("%s of the text that is long enough to count" % w for w in ("The lead", "A first section" * 9, "A second section"))


@pytest.mark.parametrize("html,text", [
    ("<div class='post'><h1>Title</h1><div class='post-body'><p>{1}</p></div></div>", "Title\n{1}"),
    ("<div class='wrap'><h1>Title</h1><div class='post-body'><p>{1}</p></div></div><div class='x'><p>{2}</p></div>", "Title\n{1}"),
    ("<div class='a'><div class='b'><h1>Title</h1><div class='c'>{0}</div><div class='d'><h2>One</h2><p>{1}</p></div>"
     "<div class='e'><h2>Two</h2><p>{2}</p></div></div><div class='f'><a href='/'>Another story that is only linked here</a></div></div>",
     "Title\n{0}\nOne\n{1}\nTwo\n{2}"),
    ("<div class='a'><div class='story'><p>{0}</p></div><div class='x'><p>{1}</p></div></div>", "{1}"),
])
def test_pages_of_containers_without_article_tags(html, text):
    """Headline, lead and sections beside the largest container are parts of the article."""
    page = extraction.Page("<body>" + html.format(LEAD, ONE, TWO) + "</body>")
    assert page.text_under(page.best_path()) == text.format(LEAD, ONE, TWO)


def test_hosts_agree_on_a_path(spark):
    """A page whose comments outweigh its article is read by its host's path."""
    page = "<body><div class='story'><p>{}</p></div><div class='x{}'><p>{}</p></div></body>"
    rows = [(k, "http://h.example/p", page.format(f"words of story number {k} that count", k, "z " * 4)) for k in range(9)]
    rows.append((9, "http://h.example/p", page.format("short story of this one page here", 9, "z " * 400)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    assert got[9] == "short story of this one page here"
    assert {r.host: r.paths[0] for r in extraction.host_paths(pages).collect()} == {"h.example": ">div.story"}


@pytest.mark.parametrize("broadcast", [extraction.BROADCAST_VOTES, 0])
def test_a_host_may_have_many_paths(spark, monkeypatch, broadcast):
    """The path ranked twelfth is found as the first one is, by either way of matching."""
    monkeypatch.setattr(extraction, "BROADCAST_VOTES", broadcast)
    page = "<body><div class='story {0}'><p>{1}</p></div><div class='x{0}'><p>{2}</p></div></body>"
    kinds = "abcdefghijkl"
    rows = [(100 * k + n, "http://h.example/p", page.format(kind * 4, f"words of story {n} that count here", "z"))
            for k, kind in enumerate(kinds) for n in range(14 - k)]
    rows += [(9000 + k, "http://h.example/p", page.format(kind * 4, "short story of this one page", "z " * 400)) for k, kind in enumerate(kinds)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    assert [got[9000 + k] for k in range(len(kinds))] == ["short story of this one page"] * len(kinds)


ARTICLE_TEXTS = ["A lead paragraph of the article that says what it is about, at some length.", "First paragraph with enough words to count as text.", "Second paragraph, which ends the article after a while."]
MENU = '<ul class="menu"><li><a href="/a">Start page</a><li><a href="/b">All of the articles</a></ul>'


@pytest.mark.parametrize("opening", [
    '<div class="post-12 category-social-science">', '<div class="story tag-advert">', '<div id="content-form">', '<div class="beitrag kategorie-werbung">',
    '<div id="anzeige-inhalt">', '<div class="wrap social"><div class="related post">',
])
def test_names_do_not_rule_out_a_whole_article(spark, opening):
    body = f"{MENU}{opening}<h1>Headline</h1>{''.join(f'<p>{t}</p>' for t in ARTICLE_TEXTS)}{'</div>' * opening.count('<div')}<div class='footer'>Imprint and more</div>"
    wanted = "\n".join(["Headline", *ARTICLE_TEXTS])
    assert extraction.Page(f"<body>{body}</body>").best_path()
    pages = spark.createDataFrame([(k, "https://one.example/p", f"<html><body>{body}</body></html>") for k in range(20)], "page_id long, url string, html string")
    assert {r.text for r in extraction.extract(pages).collect()} == {wanted}


@pytest.mark.parametrize("name", ["comments", "kommentare", "commentaires", "comentarios"])
def test_comments_stay_outside_though_they_are_longer(name):
    said = "".join(f"<p>Reader number {k} has a lot to say about all of this, as ever.</p>" for k in range(9))
    page = extraction.Page(f"<body><div class='artikel'><h1>Headline</h1>{''.join(f'<p>{t}</p>' for t in ARTICLE_TEXTS)}</div><div class='{name}'>{said}</div></body>")
    assert page.text_under(page.best_path()) == "\n".join(["Headline", *ARTICLE_TEXTS])


def test_lead_paragraphs_in_the_header_of_an_article():
    page = extraction.Page(
        f"<body><header><p>The long slogan of a site, which says nothing about any article on it.</p></header><article><header><h1>Headline</h1>"
        f"<p class='lead'>{ARTICLE_TEXTS[0]}</p><p>By a person</p></header><p>{ARTICLE_TEXTS[1]}</p><p>{ARTICLE_TEXTS[2]}</p></article></body>"
    )
    assert page.text_under(page.best_path()) == "\n".join(["Headline", *ARTICLE_TEXTS])


TURNS = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "a"), (0, 2, "user", "q"), (1, 0, "user", "hi"), (1, 1, "assistant", "b<|im_end|>"),
    (2, 0, "user", "x"), (2, 1, "assistant", "y"), (3, 0, "user", "x"), (3, 1, "assistant", "y"), (3, 1, "assistant", "y"),
    (4, None, None, None), (4, 1, "assistant", "é"), (5, None, "user", ""), (6, 0, "user", "z"), (None, 0, "user", "k"),
    (9, 0, "user", "k"), (8, 0, "user", "k"), (8, 1, "assistant", "k" * 5000), (10, 0, "user", "a"), (11, 0, "system", "a"),
]


@pytest.mark.parametrize("rows", [TURNS, []])
def test_preferences_equal_their_sql(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = preferences.format_pairs(preferences.neighbour_pairs(turns), turns)
    conversations = turns.toArrow()  # noqa: F841  read by the statement below
    result = duckdb.sql(preferences.ORACLE_SQL)
    assert sorted(map(tuple, got.select(*result.columns).collect())) == sorted(result.fetchall())


def test_spans_cover_the_assistant(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    rows = {r.pair_id: r for r in preferences.format_pairs(preferences.neighbour_pairs(turns), turns).collect()}
    a, b = map(int, rows[0].chosen_spans.split("-"))
    assert rows[0].chosen[a:b] == "a<|im_end|>" and rows[0].prompt == "<|im_start|>user\nhi<|im_end|>\n"
    assert (rows[1].chosen, rows[1].rejected, rows[1].prompt_turns) == ("", "", 2) and rows[5].prompt == ""


@pytest.mark.parametrize("rows", [
    TURNS, [], TURNS[:3], [(k, t, r, f"{r} {k * t}") for k in range(3000) for t, r in enumerate(["user", "assistant", "user"])],
])
def test_every_conversation_has_a_pair_with_a_shared_prompt(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = preferences.reply_pairs(turns)
    conversations = turns.toArrow()  # noqa: F841  read by the statement below
    result = duckdb.sql(preferences.REPLY_SQL)
    found = got.select(*result.columns).collect()
    assert sorted(map(tuple, found), key=str) == sorted(result.fetchall(), key=str)
    assert {r.pair_id for r in found} == {r[0] for r in rows if r[0] is not None} and len(found) == len({r.pair_id for r in found})
    if len(rows) > 3:
        assert all(r.prompt for r in found if r.rejected_id is not None and r.chosen_id < 3000 and r.prompt_turns)
        assert sum(r.prompt_turns > 0 for r in found) > 0.9 * len(found)


def test_queries_are_registered():
    names = sorted(queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]


def write(spark, folder, tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_pipeline(spark, tmp_path):
    rng = random.Random(6)
    rows, labels = labelled(7, 500)
    toxic = {i for i, t in labels if t}
    item = prose(rng, 40)
    clean = [i for i, t in labels if not t and i > 5]
    texts = dict(rows)
    copies = [(1000 + k, texts[c] + (" more" if k % 2 else "")) for k, c in enumerate(clean[:20])]
    leaks = [(2000 + k, f"{prose(rng, 30)} {item} {prose(rng, 30)}") for k in range(3)]
    every = rows[6:] + copies + leaks + [(3000, None), (3000, ""), (None, prose(rng, 50)), (3001, prose(rng, 50))] + [(3002, "same row here")] * 2
    write(spark, tmp_path, {
        "documents": ([(i, t, "en", "s", 0) for i, t in every], "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, item)], "item_id long, text string"),
    })
    got = collections.Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    expected = [i for i, _ in every if i not in toxic and not (i is not None and 1000 <= i < 3000)]
    missed = {i for i in toxic if got[i]}
    assert len(missed) <= 0.1 * len(toxic)
    for i in missed:
        del got[i]
    assert got == collections.Counter({**dict.fromkeys(expected, 1), 3000: 2, 3002: 1})


def test_pipeline_over_empty_tables(spark, tmp_path):
    write(spark, tmp_path, {
        "documents": ([], "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([], "doc_id long, quality int, toxic int"), "benchmark": ([], "item_id long, text string"),
    })
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
