"""The corpus operators against brute force and literal cases, on odd rows and empty tables."""

import hashlib
import os
import random
import zlib
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spikelens.llm import decontaminate, extract, jaccard, langid, packing, pitman_yor, quality, repeats, stages, toxicity, urlgraph
from spikelens.llm.tokens import tokenizer

DDL = "doc_id long, text string, lang string, source string, n_chars long, node long, part int, key long, tokens string, spans string, score double"


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(2, 7))) for _ in range(n))


LONG = prose(1, 30_000)
NEAR = prose(2, 120)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  two"), (6, NEAR), (7, NEAR), (8, NEAR + " end"), (9, NEAR.replace("a", "b", 3)),
    (10, LONG), (11, prose(3, 60) + " " + LONG[5000:5600] + " " + prose(4, 60)), (None, "no id here"), (None, "no id here"), (12, "é ñ <|endoftext|> 'll 12½ İ Σ"),
    (13, "x" * 700), (13, "a second row of one id"), (14, "ab " * 300), (15, prose(5, 300)), (16, " ".join(prose(5, 300).split()[:250])),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i == 5 else "en" if (i or 0) % 2 else "de", None, 1, 1, 2, 3, "t", "s", 0.5) for i, t in TEXTS]
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def test_packing_is_gapless_and_round_trips(odd, empty):
    rows = packing.pack(odd, window=64).collect()
    whole = tokenizer().whole
    wanted = Counter((i, tuple(whole.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in TEXTS)
    stream = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    at, texts, left = 0, Counter(), []
    for r in stream:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.sequence_id, r.offset) == divmod(at, 64) and len(ids) == r.length and r.start == len(left)
        at += r.length
        left += ids
        if len(left) == r.doc_tokens:
            texts[(r.doc_id, tuple(left))] += 1
            left = []
    assert texts == wanted
    digest = packing.packing_digest(packing.pack(odd)).first()
    assert 0 <= digest.ids_crc32 < 2**32
    assert packing.pack(empty).count() == 0


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        runs = sum(bool(g) and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group_rows", [1_000_000, 3])
def test_repeats_equal_brute_force(odd, group_rows):
    rows = repeats.repeats_digest(repeats.remove_repeats(odd, group_rows=group_rows)).collect()
    wanted = Counter((i, *w) for (i, _), w in zip(TEXTS, brute_repeats([t for _, t in TEXTS], 200), strict=True))
    assert Counter(map(tuple, rows)) == wanted


def test_repeats_keep_columns_and_empty_tables(odd, empty):
    out = repeats.remove_repeats(odd)
    assert set(odd.columns) <= set(out.columns) and out.count() == len(TEXTS)
    assert sum(r.text is None for r in out.select("text").collect()) == 1
    assert repeats.remove_repeats(empty).count() == 0


def test_deep_shallow_sorts_with_common_prefixes():
    pick = random.Random(7)
    strings = [b"q" * 32 + bytes(pick.choice(b"ab") for _ in range(pick.randint(0, 80))) for _ in range(400)] + [b"q" * 32 + b"a" * 60] * 3
    order, common = repeats.deep_shallow(strings, 32)
    assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
    assert common[1:] == [repeats.common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, []).append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {k: low if v == high else v for k, v in group.items()}
    return Counter((i, len(s), group[i]) for i, own in sets.items() for s in own)


@pytest.mark.parametrize("dear", [50_000, 1])
def test_jaccard_equals_brute_force(spark, odd, monkeypatch, dear):
    monkeypatch.setattr(jaccard, "EXPENSIVE", dear)
    known = [(i, t) for i, t in TEXTS if i is not None]
    for n in (1, 2, 3, 5, 9, 17, 40):  # families of edited copies around the threshold, at many sizes
        base = prose(100 + n, n + 4).split()
        for k in range(6):
            words = list(base)
            for e in range(k):
                words[(e * 7) % len(words)] = f"w{n}x{e if k < 4 else k}"
            known.append((1000 + 10 * n + k, " ".join(words)))
    rows = jaccard.jaccard_components(spark.createDataFrame(known, "doc_id long, text string").repartition(3)).collect()
    assert Counter(map(tuple, rows)) == brute_components(known)


def test_jaccard_odd_rows(odd, empty):
    rows = jaccard.jaccard_components(odd).collect()
    assert len(rows) == len(TEXTS) and all(r.component_id is None for r in rows if r.doc_id is None)
    assert jaccard.jaccard_components(empty).count() == 0
    kept = jaccard.keep_one(odd)
    assert set(kept.columns) == set(odd.columns)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id is not None)[:5] == [1, 2, 3, 4, 6]


def test_decontamination(spark, odd, empty):
    items = spark.createDataFrame(
        [(1, "A train leaves with 40 people and then 15 more people come on board at 40 km from Paris"), (2, None), (3, ""), (4, "two of"), (5, prose(9, 30))], "item_id long, text string"
    )
    same = "we read: A train leaves with 40 people and then 15 more people come on board at 40 km from Paris"
    docs = spark.createDataFrame(
        [(1, same), (2, same.replace("40", "62").replace("15", "9").replace("Paris", "Rome")), (3, same.replace("40", "62", 1)), (4, prose(8, 50)), (5, None), (6, ""), (None, same), (7, prose(9, 30) + " " + prose(10, 9)), (8, same), (8, same)],
        "doc_id long, text string",
    )
    rows = {(r.doc_id, r.item_id): r for r in decontaminate.find_contamination(docs, items).collect()}
    assert set(rows) == {(1, 1), (2, 1), (7, 5), (8, 1)}  # 3: one value of the item stands for two
    assert rows[1, 1].exact and not rows[2, 1].exact
    assert sorted(r.doc_id or 0 for r in decontaminate.drop_contaminated(docs, items).collect()) == [0, 3, 4, 5, 6]
    assert decontaminate.find_contamination(empty, items).count() == 0
    assert decontaminate.find_contamination(docs, items.limit(0)).count() == 0
    assert decontaminate.find_contamination(odd, items).count() == 0


def test_decontamination_of_items_that_repeat_a_window(spark):
    texts = [
        "What is the mean of the numbers 3, 7, 8, 12, 15, 20 and 41 in this list of ours",
        "A baker sells bread for 3 coins each day and her friend sells bread for 5 coins each day in town",
        "Tom has 4 red apples and Ann has 9 green pears",
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    other = texts[2].replace("4", "6").replace("9", "11"), texts[2].replace("4", "8").replace("9", "2")
    around = prose(20, 57)
    docs = [(k, f"{around}. {t}. {prose(21, 30)}") for k, t in enumerate(texts)]
    docs += [(3, f"{around} {other[0]}. So {other[1]}. {prose(21, 9)}"), (4, f"{around} {texts[1].replace('3', '6').replace('5', '6')}"), (5, f"{around} {texts[0].replace('3, 7', '3, 9')}")]
    docs += [(10 + k, f"{prose(22, 30 + k)} {texts[1].replace('and her', 'and then one day her')}") for k in range(3)]
    rows = {(r.doc_id, r.item_id): r for r in decontaminate.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert {(0, 0), (1, 1), (2, 2), (3, 2), (4, 1), (5, 0), (10, 1), (11, 1), (12, 1)} == set(rows)
    assert all(rows[k, k].exact and rows[k, k].matched == rows[k, k].item_windows for k in range(3))
    assert not rows[3, 2].exact and not rows[4, 1].exact and not rows[5, 0].exact


def test_url_rules_and_propagation(spark):
    page = lambda *hosts: "".join(f'<a href="http://{h}/x">.</a>' for h in hosts)
    pages = spark.createDataFrame(
        [(1, "https://Good.ORG/a", page("near.net")), (2, "http://near.net/", None), (3, "http://x.example.org/es/1?q", ""), (4, "http://farm.net/", page("bad.com")), (5, "http://bad.com/de/1", page("c.net")), (6, None, None), (7, "no url", page("near.net")), (8, "http://alone.net#top", "")],
        "page_id long, url string, html string",
    )
    rows = {r.page_id: r for r in urlgraph.judge_urls(pages).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("good.org", "/a", "org/", "allow")
    assert (rows[3].rule, rows[3].verdict) == ("example.org/es/", "block")
    assert (rows[4].rule, rows[4].verdict) == (None, "block") and rows[2].verdict == "allow" and rows[2].trust > 0
    assert (rows[6].host, rows[6].path, rows[7].host, rows[8].path) == ("", "", "", "")
    assert rows[6].verdict == rows[7].verdict == rows[8].verdict == "allow"
    assert urlgraph.judge_urls(pages.limit(0)).count() == 0


def test_url_verdicts_do_not_hang_on_unrelated_hosts(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">.</a>' for h in hosts)
    chain = [f"h{k}.net" for k in range(5)]
    near = [("http://a.org/", link("mid.net")), ("http://mid.net/", link("b.com")), ("http://b.com/de/1", "")]
    near += [(f"http://{h}/", link(to)) for h, to in zip(chain, [*chain[1:], "b.com"], strict=True)]
    far = [(f"http://u{k}.com/de/1", "") for k in range(60)] + [(f"http://u{k}.org/", "") for k in range(9)]
    found = []
    for rows in (near, near + far):
        pages = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "page_id long, url string, html string")
        judged = urlgraph.judge_urls(pages, tolerance=1e-2).filter(f"page_id < {len(near)}").collect()
        found.append({r.host: (r.verdict, round(r.trust, 12), round(r.distrust, 12)) for r in judged})
    assert found[0] == found[1]
    assert all(found[0][h][0] == "block" for h in chain)


def test_propagation_has_no_limit_of_links_and_equals_power_iteration(spark):
    pick, n = random.Random(8), 30
    links = {(pick.randrange(n), pick.randrange(n)): pick.randint(1, 4) for _ in range(90)}
    links |= {(k, k + 1): 1 for k in range(n, n + 45)}  # a chain to a blocked host
    links = {k: v for k, v in links.items() if k[0] != k[1]}
    n += 46
    seeds = {0: (1.0, 0.0), 1: (0.5, 0.5), 2: (0.0, 1.0), n - 1: (0.0, 1.0)}
    matrix = np.zeros((n, n))
    for (a, b), v in links.items():
        matrix[a, b] = v
    share = lambda m: np.divide(m, m.sum(1, keepdims=True), out=np.zeros_like(m), where=m.sum(1, keepdims=True) > 0)
    wanted = []
    for kind, flow in ((0, share(matrix)), (1, share(matrix.T))):
        start = np.array([seeds.get(k, (0, 0))[kind] for k in range(n)])
        wanted.append(0.15 * np.linalg.solve(np.eye(n) - 0.85 * flow.T, start))
    hosts = spark.createDataFrame([(f"h{k}", *v) for k, v in seeds.items()], "host string, trusted double, blocked double")
    edges = spark.createDataFrame([(f"h{a}", f"h{b}", v) for (a, b), v in links.items()], "src string, dst string, links long")
    found = {int(r.host[1:]): (r.trust, r.distrust) for r in urlgraph.propagate(hosts, edges, tolerance=1e-3).collect()}
    assert set(found) == {x for k in links for x in k} | set(seeds)
    for k, pair in found.items():
        assert np.allclose(pair, [w[k] for w in wanted], rtol=1e-2, atol=1e-10)
    assert found[n - 46][1] > urlgraph.LEAST


def test_extra_columns_may_clash(spark):
    extra = "_doc int, _bad int, _id int, _toxic int, id1 int, ID2 int, _kept int, place int"
    rows = [(k, prose(40 + k % 3, 60), k % 2, *range(8)) for k in range(8)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, toxic int, {extra}")
    items = spark.createDataFrame([(1, " ".join(prose(41, 60).split()[5:40]))], "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {0, 2, 3, 5, 6}
    assert toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, docs)).count() == 8
    cut = repeats.remove_repeats(docs)
    assert set(docs.columns) <= set(cut.columns) and {(r.id1, r.ID2) for r in cut.collect()} == {(4, 5)}
    assert {r.doc_id for r in jaccard.keep_one(docs).collect()} == {0, 1, 2}


def test_toxicity_learns_and_treats_groups_alike(odd, empty):
    texts = [(f"{prose(k, 12)} {'idiot ' * (k % 3 == 0)}{'muslim' if k % 3 == 0 else 'christian'}", int(k % 3 == 0)) for k in range(150)]
    model = toxicity.ToxicityModel([(toxicity.features(t), y) for t, y in texts], fairness=1000.0)
    free = toxicity.ToxicityModel([(toxicity.features(t), y) for t, y in texts], fairness=0.0)
    assert all(m.score(prose(900, 12) + " idiot " + x) > m.score(prose(900, 12) + " " + x) for m in (model, free) for x in ("christian", "muslim"))
    gap = lambda m: abs(m.score(prose(902, 12) + " muslim") - m.score(prose(902, 12) + " christian"))
    assert gap(model) < 0.75 * gap(free)
    assert toxicity.score_toxicity(odd, model).count() == len(TEXTS)
    assert toxicity.score_toxicity(empty, toxicity.ToxicityModel([])).count() == 0


def test_toxicity_binds_all_pieces_of_swapped_terms():
    terms = ("muslim", "christian", "immigrants", "citizens")
    texts = [(f"{prose(k, 12)} {'idiot ' * (k % 3 == 0)}{terms[2 * (k % 2) + (k % 3 != 0)]}", int(k % 3 == 0)) for k in range(300)]
    rows = [(toxicity.features(t), y) for t, y in texts]
    model, free = toxicity.ToxicityModel(rows), toxicity.ToxicityModel(rows, fairness=0.0)

    def gap(m, a, b):
        logits = [np.log(p / (1 - p)) for p in (m.score(f"{prose(902, 12)} {x}") for x in (a, b))]
        return abs(logits[0] - logits[1])

    for pair in (terms[:2], terms[2:]):
        assert gap(model, *pair) < 0.1 * gap(free, *pair)
    assert model.score(prose(900, 12) + " idiot") > model.score(prose(900, 12))
    assert toxicity.changed({"muslim", "muslims"}, "muslim", "jewish") == (("jewis-", "jewish"), ("muslim",))


def test_extraction():
    page = "<head><title>t</title></head><nav><a href='/'>Home</a></nav><div class='ad'>buy</div><article><h1>A &amp; B</h1><p>One\n two<br>three<p>four</article><script>var t='</p>';</script><footer>x</footer>"
    assert extract.main_text(page) == "A & B\n\nOne two three\n\nfour"
    body = "Long text of the body that goes on and on. " * 4
    assert extract.main_text(f"<ul><li><a>x</a></li></ul><div>{body}</div><div class=comments>no</div>") == body.strip()
    assert extract.main_text(None) == extract.main_text("") == extract.main_text("<nav>x</nav>") == ""


def test_extraction_by_distribution_beside_an_article():
    body = ["Long text of the body that goes on and on, line after line. " * 3 for _ in range(4)]
    whole = "".join(f"<p>{b}</p>" for b in body)
    text = "\n\n".join(b.strip() for b in body)
    for card in ("<article>A short teaser</article>", "<article><a href='/x'>Read this, too</a></article>"):
        gap = "<div></div>" * 3
        assert extract.main_text(f"{card}{gap}<div>{whole}</div>") == extract.main_text(f"<div>{whole}</div>{gap}{card}") == text
    assert text in extract.main_text(f"<article>{'A teaser of some length. ' * 5}</article><div>{whole}</div>")
    assert extract.main_text(f"<div>By us</div><article>{whole}<div></div><div></div><p>End.</p></article><div>Share</div>") == text + "\n\nEnd."


def test_extraction_without_elements_and_names_of_furniture():
    body = [f"Long text of body {k} that goes on and on, line after line. " * 3 for k in range(4)]
    whole, text = "".join(f"<p>{b}</p>" for b in body), "\n\n".join(b.strip() for b in body)
    menu = "<div><ul>" + "".join(f"<li><a href=/{k}>Entry {k}</a></li>" for k in range(9)) + "</ul></div>"
    page = f"{menu}<div><div>Save ten per cent today</div></div><div>{whole}<p>Short.</p></div><div><div>Terms of use</div></div>{menu}"
    assert len([x for x in extract.lines_of(page) if x[0]]) == 25
    assert extract.main_text(page, trim=False) == extract.main_text(page) == text + "\n\nShort."
    assert extract.main_text(page, surge=0, link_share=2, trim=False).count("\n\n") == 24
    # What surges like an article is left to elements and names.
    comments = f"<div class='comments'><div>{whole}</div></div>"
    assert extract.main_text(f"<div>{whole}<p>More.</p></div>{comments}") == text + "\n\nMore."
    assert extract.main_text(f"<div>{whole}<p>More.</p></div>{comments}", trim=False) == f"{text}\n\nMore.\n\n{text}"


def test_extraction_keeps_formulas_and_text_beside_named_parts():
    body = "Long text of the body that goes on and on. " * 4
    page = f"<noscript>No script here</noscript><article><p>{body}</p><p>As <math><mi>x</mi></math> and <svg><text>y</text></svg> grow<span class=ad> buy now</span>, so.</p></article>"
    assert extract.main_text(page) == f"{body.strip()}\n\nAs x and y grow, so."
    assert extract.main_text("<div>x" * 3000 + "word " * 200_000).endswith("word word")
    assert extract.main_text(f"<svg><title>z</title><text>{body}</text></svg><p>{body}") == body.strip()


def test_extraction_keeps_wrapped_bodies_headings_and_references():
    body = "Long text of the body that goes on and on. " * 4
    for tag in ("div class='layout has-sidebar'", "div id='page-with-header'", "form method=post", "div class=widget", "div class='layout sidebar'"):
        name = tag.split()[0]
        assert extract.main_text(f"<{tag}><article><p>{body}</article></{name}>") == body.strip()
        assert extract.main_text(f"<{tag}><div><p>{body}</div></{name}><div class=comments>no</div>") == body.strip()
    assert extract.main_text(f"<div>{body}</div><form><p>{body[:80]}</form><div class='box sidebar'>{body[:60]}</div>") == body.strip()
    wanted = f"Title\n\n{body.strip()}\n\nA reference"
    assert extract.main_text(f"<article><h1><a href=/>Title</a></h1><p>{body}</p><ul><li><a href=/r>A reference</a></ul></article>") == wanted
    assert extract.main_text(f"<div><h1><a href=/>Title</a></h1><p>{body}</p><ul><li><a href=/r>A link</a></ul></div>") == wanted.rsplit("\n\n", 1)[0]


def test_quality_counts_and_monotone_trees(odd, empty):
    rows = {r.doc_id: r for r in quality.document_statistics(odd).collect()}
    assert (rows[1].n_words, rows[3].n_words, rows[4].n_words, rows[14].n_repeat_words) == (0, 0, 2, 300)
    for i, t in TEXTS:
        if i in (6, 10, 12):
            words = t.encode().split()
            seen = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
            hit = {k + j for k in range(len(words) - 4) if seen[tuple(words[k : k + 5])] > 1 for j in range(5)}
            assert (rows[i].n_words, rows[i].n_repeat_words, rows[i].word_chars) == (len(words), len(hit), sum(len(w.decode()) for w in words))
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    model = quality.BoostedTrees(x, (x[:, 0] + 0.3 * rng.random(500) < 0.6).astype(float), np.array([-1, 0, 0]), trees=20)
    line = np.column_stack([np.linspace(0, 1, 50), np.full(50, 0.5), np.full(50, 0.5)])
    assert (np.diff(model.chance(line)) <= 1e-12).all() and model.chance(line)[0] > 0.8
    judged = quality.judge_quality(quality.document_statistics(odd), quality.BoostedTrees(np.zeros((0, 11)), np.zeros(0), np.zeros(11)))
    assert judged.count() == len(TEXTS) and quality.document_statistics(empty).count() == 0


def test_language(odd, empty):
    model = langid.BackoffModel([("the cat and the dog", "en"), ("der hund und die katze", "de")])
    assert langid.Scorer(model).predict("The hat")[0] == "en" and langid.Scorer(model).predict("hunde")[0] == "de"
    rows = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == rows[3].lang_pred == "und" and 0 <= rows[4].score <= 1
    assert langid.identify(empty, langid.fit_languages(empty, F.lit(True))).count() == 0


def test_pitman_yor(odd, empty):
    train = pitman_yor.training_rows()
    rows = pitman_yor.score_corpus(odd, train).collect()
    assert len(rows) == len(TEXTS)
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in TEXTS]
    counts = Counter(w for (_, t), h in zip(TEXTS, held, strict=True) if not h for w in [*(t or "").encode().lower().split(), None])
    n, kinds = sum(counts.values()), len(counts)
    wanted = Counter()
    for (i, t), h in zip(TEXTS, held, strict=True):
        words = [*(t or "").encode().lower().split(), None]
        base = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in words)
        wanted[(i, not h, len(words), sum(counts[w] > 0 for w in words), round(base, 4))] += 1
    assert Counter((r.doc_id, r.trained, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == wanted
    assert all(r.train_tokens == n and np.isfinite(r.score) and r.score < 0 for r in rows)
    assert pitman_yor.score_corpus(empty, train).count() == 0


def test_pair_counts_are_merged_as_blocks_come(monkeypatch):
    monkeypatch.setattr(pitman_yor, "PENDING_PAIRS", 50)
    rng, wanted, held = np.random.default_rng(4), Counter(), pitman_yor.PairCounts(13)
    for _ in range(40):
        words = np.unique(rng.integers(1, 30, 9).astype(np.uint64))
        contexts = [np.unique(rng.integers(0, 5, 3)) for _ in words]
        counts = rng.integers(1, 9, sum(map(len, contexts)))
        held.add(words, np.array([len(c) for c in contexts]), np.concatenate(contexts).astype("<u2"), counts)
        pairs = [(int(w), int(c)) for w, cs in zip(words, contexts, strict=True) for c in cs]
        for pair, n in zip(pairs, counts.tolist(), strict=True):
            wanted[pair] += n
    assert held.pairs <= 150
    held.merge()
    found = {(int(held.kinds[c >> 13]), int(c & 8191)): int(n) for c, n in zip(held.codes, held.counts, strict=True)}
    assert found == wanted and (np.diff(held.codes) > 0).all()


def test_scores_with_one_word_in_most_places_and_chunks_of_few_documents(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "aa " * 300 + prose(k, 6)) for k in range(80)], "doc_id long, text string").repartition(3)
    score = lambda b: {r.doc_id: (round(r.score, 6), round(r.base_score, 6), r.n_tokens, r.n_known) for r in pitman_yor.score_corpus(docs, pitman_yor.training_rows(), buckets=b).collect()}
    found = score(16)
    monkeypatch.setattr(pitman_yor, "CHUNK_DOCS", 4)
    assert len(found) == 80 and found == score(16) == score(1)


def test_tables_follow_their_conditional():
    stirling = np.zeros((13, 13))
    stirling[1, 1] = 1
    for c in range(1, 12):
        for t in range(1, c + 2):
            stirling[c + 1, t] = stirling[c, t - 1] + (c - t / 2) * stirling[c, t]
    uniform = (np.arange(40_000) + 0.5) / 40_000
    full = lambda x: np.full(40_000, x)
    for c, rate in ((2, 0.9), (6, 0.2), (12, 10.0), (12, 1e-6), (12, 1e6)):
        drawn = pitman_yor.draw_tables(full(c), full(rate), uniform)
        weights = stirling[c, 1 : c + 1] * rate ** np.arange(c)
        assert abs(np.bincount(drawn, minlength=c + 1)[1:] / 40_000 - weights / weights.sum()).max() < 1e-3
    # Many customers: the same law, held against sums over all table counts.
    c, rate = 5_000, 135.0
    t = np.arange(1, c)
    logs = np.concatenate([[0], np.cumsum(np.log(4 * (c - t) * rate / ((2 * c - t - 1) * t)))])
    weights = np.exp(logs - logs.max())
    drawn = pitman_yor.draw_tables(full(c), full(rate), uniform)
    assert abs(drawn.mean() - (np.arange(1, c + 1) * weights).sum() / weights.sum()) < 0.01
    assert pitman_yor.draw_tables(np.array([0, 1]), np.ones(2), np.zeros(2)).tolist() == [0, 1]
    # Restaurants of two dishes: sweeps of gamma variables and tables reach the joint law of both table counts.
    c, chance, strength, n = (4, 6), (0.3, 0.1), 1.0, 100_000
    joint = np.array([[stirling[c[0], a] * chance[0] ** a * stirling[c[1], b] * chance[1] ** b * np.prod(strength + np.arange(a + b) / 2) for b in range(1, 7)] for a in range(1, 5)])
    rng, tables = np.random.default_rng(3), np.ones((2, n), np.int64)
    for k in range(12):
        gammas = pitman_yor.rates(tables.sum(0), strength, k)
        tables = np.stack([pitman_yor.draw_tables(np.full(n, c[d]), gammas / 2 * chance[d], rng.random(n)) for d in (0, 1)])
    found = np.bincount((tables[0] - 1) * 6 + tables[1] - 1, minlength=24).reshape(4, 6) / n
    assert abs(found - joint / joint.sum()).max() < 0.01


def test_restaurants_grow_with_the_text():
    assert [pitman_yor.restaurants_for(n) for n in (0, 1 << 25, (1 << 25) + 1, 1 << 32, 1 << 50)] == [1 << 13, 1 << 13, 1 << 14, 1 << 20, 1 << 21]


def test_scores_do_not_hang_on_the_number_of_buckets_and_beat_the_base(spark):
    pick, words = random.Random(6), [prose(s, 1) for s in range(40)]
    text = lambda: " ".join(f"{words[k]} {words[20 + k]}" for k in pick.choices(range(20), k=30))
    docs = spark.createDataFrame([(k, text()) for k in range(60)], "doc_id long, text string")
    runs = [pitman_yor.score_corpus(docs.repartition(n), pitman_yor.training_rows(), buckets=b).collect() for n, b in ((2, 4), (3, 16))]
    found = [{r.doc_id: (round(r.score, 6), round(r.base_score, 6)) for r in run} for run in runs]
    assert found[0] == found[1] and len(found[0]) == 60
    assert all(score > base + 20 for score, base in found[0].values())


def test_number_signs_are_no_letters_and_names_may_clash(spark):
    rows = [(k, "der hund und die katze laufen" if k % 2 else "the dog and the cat are running", "de" if k % 2 else "en", 1, 2) for k in range(60)]
    rows += [(100, "½ ² ①", "en", 1, 2), (101, "½ x", "en", 1, 2), (102, "", None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _id int, _n int").repartition(3)
    model = langid.fit_languages(docs, langid.training_rows())
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert found[100] == found[102] == ("und", 0.0) and found[101][0] in ("de", "en")
    assert all(found[k][0] == ("de" if k % 2 else "en") for k in range(60))
    kept = langid.keep_identified(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {*range(60), 101}
    few = langid.fit_languages(docs, langid.training_rows(), per_language=5)
    assert few.languages == ["de", "en"] and len(few.words) <= len(model.words)


def test_one_row_stays_of_an_id_whatever_the_order(spark):
    rows = [(5, prose(s, 40), 1) for s in range(6)] + [(6, prose(9, 40), 1), (None, "x", 1), (None, "x", 1)]
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string, place int")
    found = [sorted(map(str, jaccard.keep_one(frame(r).repartition(n)).collect())) for r, n in ((rows, 1), (rows[::-1], 4))]
    assert found[0] == found[1] and len(found[0]) == 4


def test_packed_numbers():
    """Numbers of a block travel in less room than plain 4 and 2 bytes each, and come back as they were."""
    rng = np.random.default_rng(3)
    for kind in ("<u2", "<u4", "<u8", "<i8", "<f8"):
        for n in (0, 1, 1000):
            values = (rng.random(n) * 60_000).astype(kind)
            back = pitman_yor.unpacked(pitman_yor.packed(values), kind)
            assert back.dtype == np.dtype(kind) and back.tolist() == values.tolist()
    assert pitman_yor.unpacked(b"", "<u8").tolist() == []
    contexts = np.sort(rng.integers(0, 1 << 17, (40, 500)), axis=1).astype("<u4").reshape(-1)
    assert len(pitman_yor.packed(contexts)) < 0.65 * contexts.nbytes


def test_blocks_travel_packed(spark):
    """A chunk's block takes less than its numbers do in plain bytes."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"w{int(n)}" for n in rng.zipf(1.3, 3000) % 5000)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bits = 17
    for salts in (None, [1, 1]):
        words, contexts, _ = pitman_yor.tokens_of([t.encode() for _, t in rows], bits)
        blocks = pitman_yor.deal(docs, F.lit(True), 2, 1 << bits, "text", "doc_id", salts).collect()
        got = sum(len(b["contexts"]) + len(b["extra"]) for b in blocks)
        pairs = len(set(zip(words.tolist(), contexts.tolist(), strict=True)))
        plain = 8 * pairs if salts is None else 6 * len(words)
        assert sum(len(pitman_yor.unpacked(b["contexts"], "<u4")) for b in blocks) == (pairs if salts is None else len(words))
        assert got < 0.65 * plain


def test_long_texts_reach_python_in_batches_of_a_few_mb(spark):
    """Ten thousand long texts are not one batch: a task holds several batches, beside its heap."""
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 600).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(3000).cast("long").alias("n_chars"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    stages.one_of_each_group(spark, docs.limit(0), "")
    assert max(r.size for r in docs.mapInArrow(sizes, "size long").collect()) < 8 << 20


def test_language_models_go_with_their_task(spark, odd):
    """A worker holds the packed bytes between tasks, not the model's tables; both ways of use predict as the model does."""
    model = langid.BackoffModel([("the cat and the dog", "en"), ("der hund und die katze", "de")])
    sent = langid._sent(odd, model).value
    assert isinstance(sent, bytes)
    plain = {(i, *langid.Scorer(model).predict(t)) for i, t in TEXTS}
    assert {tuple(r) for r in langid.identify(odd, model).collect()} == plain
    assert langid.keep_identified(odd, model).count() == sum(langid.Scorer(model).predict(t)[0] != langid.UNKNOWN for _, t in TEXTS)
    stages.keep_languages(spark, odd.limit(0), "")
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 1024


def test_tokenizers_go_with_their_task(spark):
    """An idle worker would hold a tokenizer and its chunks beside the heap through all later stages."""
    docs = spark.range(0, 64, 1, 8).select(F.col("id").alias("doc_id"), F.lit("some words and some more").alias("text"))
    assert packing.tokenize(docs).count() == 64

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([tokenizer.cache_info().currsize] * batch.num_rows)], names=["n"])

    assert sum(r.n for r in spark.range(0, 16, 1, 16).mapInArrow(held, "n long").collect()) == 0


def test_shared_grams_are_few_files(spark, monkeypatch):
    """There are as many files as the shared grams need, not as many as the tasks that count all anchors."""
    files, plain = {}, repeats.stage
    monkeypatch.setattr(repeats, "stage", lambda df, label: files.setdefault(label, plain(df, label)))
    held = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k"}
    before = {k: spark.conf.get(k) for k in held}
    passage = prose(90, 400)
    docs = spark.createDataFrame([(i, prose(100 + i, 4000) + (passage if i % 2 else "")) for i in range(24)], "doc_id long, text string").repartition(4)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = {r.doc_id for r in repeats.remove_repeats(docs).filter(F.size("spans") > 0).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == set(range(1, 24, 2)) and len(files["shared-grams"].inputFiles()) == 1


def test_texts_are_packed_and_cut_without_pandas(spark):
    texts = [(1, "ab é " * 500), (2, None), (3, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    packed = docs.select("doc_id", repeats.packed_text(F.col("text")).alias("p")).collect()
    assert [(r.doc_id, None if r.p is None else repeats._unpacked(bytes(r.p)).decode()) for r in sorted(packed)] == texts
    assert not hasattr(repeats, "pd")
    rows = {r.doc_id: r for r in repeats.remove_repeats(docs.unionByName(docs.filter("doc_id = 1"))).collect()}
    assert (rows[1].text, bytes(rows[1].kept), rows[2].text, bytes(rows[2].kept), rows[3].text) == (texts[0][1], b"", None, b"", "")


def test_repeats_leave_their_spans_only(spark, odd, monkeypatch):
    """Anchors, shared grams and contexts go once the spans are written; the texts are cut from the spans alone."""
    files, plain = {}, repeats.stage
    monkeypatch.setattr(repeats, "stage", lambda df, label: files.setdefault(label, plain(df, label)))
    cut = repeats.remove_repeats(odd, group_rows=1)
    left = {label: os.path.exists(urlparse(df.inputFiles()[0]).path) for label, df in files.items()}
    assert left == {"anchors": False, "shared-grams": False, "contexts": False, "spans": True}
    assert cut.count() == len(TEXTS) and cut.filter(F.size("spans") > 0).count() > 0


def test_jaccard_leaves_few_staged_tables(spark, monkeypatch):
    """What later tables stand for is deleted: keys, sets and memberships are together as large as the input."""
    monkeypatch.setattr(jaccard, "EXPENSIVE", 0)
    monkeypatch.setattr(jaccard, "ANCHOR_ROUNDS", 0)  # more pairs are then left to look up
    files, plain = [], jaccard.stage

    def watched(df, label):
        files.append((label, plain(df, label)))
        return files[-1][1]

    monkeypatch.setattr(jaccard, "stage", watched)
    rows = [(10 * n + k, prose(100 + n, n + 4).replace("a", "b", k)) for n in (9, 40, 90) for k in range(6)]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {label for label, df in files if os.path.exists(urlparse(df.inputFiles()[0]).path)}
    assert left == {"shared", "links", "verified"}
    assert {label for label, _ in files} == {*left, "held", "keys", "sets", "crowds", "now", "split", "probes", "costly", "neighbours"}
    assert Counter(map(tuple, found.collect())) == brute_components(rows)


def crowd_of(n):
    """Two crowds of edited copies, far more than fit a block, with copies in them that are like each other only."""
    pick, rows = random.Random(n), []
    for c in range(2):
        base = prose(200 + c, 90).split()
        for k in range(n):
            words = list(base)
            for _ in range(pick.choice((0, 1, 2, 3, 5, 8))):
                words[pick.randrange(len(words))] = f"w{pick.randrange(10**6)}"
            rows.append((1000 * c + 2 * k, " ".join(words)))
            if k % 10 == 0:
                words[pick.randrange(len(words))] = "other"
                rows.append((1000 * c + 2 * k + 1, " ".join(words)))
    return rows


@pytest.mark.parametrize(("dear", "crowd", "block"), [(50_000, 8, 500), (0, 8, 500), (50_000, 1, 1 << 18)])
def test_crowds_are_met_in_blocks(spark, monkeypatch, dear, crowd, block):
    """The pairs of a crowd do not travel one by one with their tokens: none that is met has its second set in a crowd."""
    monkeypatch.setattr(jaccard, "EXPENSIVE", dear)
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    labels, plain, pairs, verify = [], jaccard.stage, {}, jaccard._verify

    def watched(found, sets, percent, label):
        pairs[label] = found.count()
        return verify(found, sets, percent, label)

    monkeypatch.setattr(jaccard, "stage", lambda df, label: labels.append(label) or plain(df, label))
    monkeypatch.setattr(jaccard, "_verify", watched)
    rows = crowd_of(60)
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(map(tuple, found)) == brute_components(rows)
    assert "crowded" in labels and pairs["verified"] < len(rows)
