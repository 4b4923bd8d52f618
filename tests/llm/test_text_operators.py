"""Operators on single texts: extraction, secrets, language, toxicity."""

import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge.llm import language, toxicity
from fieldgauge.llm.html_text import extract, main_text
from fieldgauge.llm.secret_scan import BASE_RULES, MORE_RULES, Scanner, _characters, find_secrets

PARAGRAPH = "This is a sentence of the article, with commas, and it goes on for a while so that it counts."


def page(body):
    return f"<html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""),
        ("", ""),
        ("no markup at all", "no markup at all"),
        (page(f"<nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>{PARAGRAPH}<p>two\n  lines</article><footer>f</footer>"), f"A & B\n{PARAGRAPH}\ntwo lines"),
        (page(f"<div class=sidebar><p>{PARAGRAPH}</p></div><main><p>{PARAGRAPH}</p></main><section id=comments><p>{PARAGRAPH}</p></section>"), PARAGRAPH),
        (page(f"<div class=has-sidebar><h2>H</h2><p>{PARAGRAPH}</p><ul><li>a<li>b</ul></div><form><p>{PARAGRAPH}</p></form>"), f"H\n{PARAGRAPH}\na\nb"),
        (page(f"<article><p>{PARAGRAPH}<br>tail <b>bold<p>next</article>"), f"{PARAGRAPH} tail bold\nnext"),
        (f"<body><article><p>{PARAGRAPH}<p>cut off here", f"{PARAGRAPH}\ncut off here"),
        (page(f"<div class='cookie-notice'>ok, ok, ok</div><div hidden>{PARAGRAPH}</div><article><p>{PARAGRAPH}</p></article><!-- c -->"), PARAGRAPH),
        ("<article></article>", ""),
    ],
)
def test_main_text(html, want):
    assert main_text(html) == want


SHORT = "A short one."


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (page(f"<article class='post category-social'><h1>A</h1><p>{PARAGRAPH}</p></article>"), f"A\n{PARAGRAPH}"),
        (page(f"<div class='layout sidebar-right'><h1>A</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><div class=sidebar><p>{SHORT}</p></div></div>"), f"A\n{PARAGRAPH}\n{PARAGRAPH}"),
        (
            page("<div>" + f"<div class='elementor-widget elementor-widget-heading'><h2>H</h2></div><div class='elementor-widget elementor-widget-text'><p>{PARAGRAPH}</p></div>" * 3 + "</div>"),
            "\n".join(["H", PARAGRAPH] * 3),
        ),
        (page(f"<form action=x><div><h1>A</h1><p>{PARAGRAPH}</p></div></form>"), f"A\n{PARAGRAPH}"),
        (page(f"<article><header class='entry-header'><h1>A</h1></header><h2 id='sharing-data'>B</h2><p>{PARAGRAPH}</p></article>"), f"A\nB\n{PARAGRAPH}"),
        (page("<div class=widget><h2>only a heading</h2></div>"), "only a heading"),
        # a long discussion, and a long sidebar, beside the article stay cut
        (page(f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><div id=comments>{f'<p>{PARAGRAPH}</p>' * 6}</div>"), f"{PARAGRAPH}\n{PARAGRAPH}"),
        (page(f"<article><p>{PARAGRAPH}</p></article><div class=sidebar>{f'<p>{PARAGRAPH}</p>' * 3}</div>"), PARAGRAPH),
    ],
)
def test_names_and_forms_cut_no_page(html, want):
    assert main_text(html) == want


def test_short_sections_stay_beside_a_long_one():
    long, short = f"<section>{f'<p>{PARAGRAPH}</p>' * 20}</section>", f"<section><h2>H</h2><p>{SHORT}</p></section>"
    links = f"<div>{'<p><a href=x>Some other page, of this site</a></p>' * 3}</div>"
    want = "\n".join([PARAGRAPH] * 20 + ["H", SHORT])
    assert main_text(page(f"<div>{long}{links}{short}</div>")) == want
    assert main_text(page(f"<div><div>{long}</div>{links}</div><div><div>{short}</div></div>")) == want


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text("<article>" + "<p>word, word</p>" * 20_000 + "</article>").count("\n") == 19_999


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article><p>One, two.</p><p class='notice-period'>A month, then.</p><p class='notice'>Cookies, here.</p></article>", "One, two.\nA month, then."),
        ("<article><p>One, two.</p></article><article><p>Three, four.</p></article>", "One, two.\nThree, four."),
        ("<main><header><h1>Title</h1></header><p>One, two.</p></main>", "Title\nOne, two."),
        ("<article><p>where <math><mi>x</mi></math> is <label>big</label></p></article>", "where x is big"),
        ("<article><p>before <svg> text</p><p>after, all</p></article>", "before text\nafter, all"),
        ("<article><p>before</p><script>p, q <p>after, all</p></article>", "before"),
    ],
)
def test_nothing_of_an_article_is_dropped(html, want):
    assert main_text(f"<html><body>{html}</body></html>") == want


def test_time_follows_the_size_of_a_page():
    for unit in ("<div>a, b ", "<div></b>x", "<svg>x ", "<b><p>x</p>"):
        start = time.perf_counter()
        main_text(unit * 20_000)
        assert time.perf_counter() - start < 20, unit


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", None, 0), (2, None, "<p>x</p>", 0), (2, None, "<p>x</p>", 0), (None, "u", "", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(extract(pages).collect(), key=str)
    assert sorted((r["page_id"], r["text"]) for r in got if r["page_id"]) == [(1, ""), (2, "x"), (2, "x")]
    assert extract(pages.limit(0)).count() == 0


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base_spans(text):
    found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(1, m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(2, m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], s[0]))


def test_one_pass_equals_the_regexes():
    scanner, rng = Scanner(BASE_RULES + MORE_RULES), random.Random(3)
    parts = ["token", "secret", "password", "passwd", "api_key", "APIkey", "Token", "=", ":", "  ", "'", '"', "abc", "0123456789abcdef", "AKIA", "ABCDEF0123", "é", ".", "\n", "-", "ſecret"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 22)))
        data = text.encode()
        got = sorted((s for s in _characters(data, scanner.scan(data)) if s[0] < 3), key=lambda s: (s[1], s[0]))
        assert got == base_spans(text), text


def test_secrets_of_rows(spark):
    rows = [(1, "é token = 'abcdef1'"), (2, None), (3, ""), (3, ""), (None, "AKIA" + "A" * 16), (4, "x " * 50_000 + "ghp_" + "a1" * 12)]
    got = find_secrets(spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1))).collect()
    spans = {(r["doc_id"], tuple(tuple(s) for s in r["spans"])) for r in got}
    assert len(got) == 6
    assert spans == {(1, (("assign", 2, 18),)), (2, ()), (3, ()), (None, (("access", 0, 20),)), (4, (("github", 100_000, 100_028), ("hex", 100_004, 100_028)))}


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12):
        code = language.codewords(n)
        assert all((code[a] != code[b]).sum() >= 1 for a in range(n) for b in range(a))
        assert (abs(code.sum(axis=0)) < n).all()


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(1)
    words = {"en": "the and of this with from that have", "de": "der die und nicht mit auf eine werden", "fr": "le la les une dans avec pour été"}
    rows = [(i, " ".join(rng.choices(words[lang].split(), k=30)), lang, "s") for i, lang in enumerate(rng.choices(list(words), k=400))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").cache()


def test_language_on_held_out_rows(spark, spoken):
    rows = language.identify(spoken, language.fit(spoken)).join(spoken.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark, spoken):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (3, "123 !?"), (None, "der die und"), (5, "der und " * 100_000)], "doc_id long, text string").withColumn("score", F.lit("x"))
    got = sorted((str(r["doc_id"]), r["lang_pred"]) for r in language.identify(odd, language.fit(spoken)).collect())
    assert got == [("1", "und"), ("2", "und"), ("3", "und"), ("3", "und"), ("5", "de"), ("None", "de")]
    untrained = language.fit(spoken.limit(0))
    assert {r["lang_pred"] for r in language.identify(odd, untrained).collect()} == {"und"}
    assert language.identify(odd.limit(0), untrained).count() == 0


@pytest.fixture(scope="module")
def rated(spark):
    rng = random.Random(2)
    calm = [a + b for a in ("ba", "re", "ti", "mo") for b in ("lan", "ser", "den", "kol", "fan")]
    bad = ["zurkig", "zurkan", "zurkoll", "vrakk"]
    rows = []
    for i in range(900):
        toxic = int(i % 6 == 0)
        words = rng.choices(calm, k=rng.randint(5, 60))
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words) + ".", toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()


def test_toxicity_on_held_out_rows(spark, rated):
    model = toxicity.fit(rated.drop("toxic"), rated.select("doc_id", "toxic"))
    rows = toxicity.score_documents(rated, model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.97 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_of_odd_texts(spark, rated):
    labels = rated.select("doc_id", "toxic").unionByName(spark.createDataFrame([(0, None), (2, 1), (2, 0)], "doc_id long, toxic int"))
    model = toxicity.fit(rated, labels)
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "zurkig vrakk zurkan"), (4, "balan " * 50_000)], "doc_id long, text string").withColumn("score", F.lit("x"))
    got = sorted((str(r["doc_id"]), r["predicted"]) for r in toxicity.score_documents(odd, model).collect())
    assert got == [("1", 0), ("2", 0), ("2", 0), ("4", 0), ("None", 1)]
    unlearnt = toxicity.fit(rated, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score_documents(odd, unlearnt).collect()} == {0}


def test_toxicity_does_not_grow_with_length(spark, rated):
    model = toxicity.fit(rated.drop("toxic"), rated.select("doc_id", "toxic"))
    calm = "balan reser tiden. "
    assert model.score(calm * 20_000 + "zurkan.") < model.score(calm * 5 + "zurkan.")
    assert model.score("Attack and murder in the town. Troops destroy it. " * 500) < toxicity.THRESHOLD
    assert model.score("zurkig vrakk zurkan " + calm * 20) >= toxicity.THRESHOLD


def test_grammar_discounts_negation_and_report():
    model = toxicity.Model({"idiot$": 4.0}, toxicity.np.zeros(2))
    plain, denied = model.clauses("what idiot"), model.clauses("what not idiot")
    told, aimed = model.clauses("they wrote idiot"), model.clauses("you idiot")
    assert plain == [4.0] and denied[0] < plain[0] and aimed[0] > plain[0]
    assert told[0] < aimed[0] and model.clauses("calm words") == [] and len(model.clauses("idiot. idiot")) == 2


def test_toxicity_looks_up_only_words_that_may_be_attacks():
    rng = random.Random(7)
    letters = "abvzéstk"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(3000)]
    model = toxicity.Model({"vak": 1.5, "zabst": 2.0, "st$": 0.7, "abé$": 1.0}, np.array([-2.0, 1.5, 1.0]))
    attacks = {w for w in words if w.startswith(("vak", "zabst")) or w in ("st", "abé")}
    assert len(attacks) > 5 and model.attacks({*words, "kill"}) == {*attacks, "kill"}
    fresh = toxicity.Model(model.lexicon, model.coefficients)
    text = " ".join(["you", *words[:40], "not", *words[40:]]) + ". vakten you, he said zabstig. not kill. calm"
    strongest, distinct, n = fresh.evidence(text)
    found = toxicity.WORDS.findall(text)
    assert (distinct, n) == (sum(fresh._look_up(w)[0] == toxicity.INSULT for w in set(found)), len(found))
    assert strongest == max(fresh.clauses(text)) > 0
    calm = toxicity.Model(model.lexicon, model.coefficients)
    assert calm.evidence(" ".join(w for w in words if w[:3] not in ("vak", "zab", "abé") and w != "st"))[:2] == (0.0, 0)
    assert len(calm._known) < 20  # before, each word had an entry, and many words threw each other out
