"""Language, toxicity, licences and page text: held-out accuracy and odd rows."""

import random
import time

import numpy as np
import pytest
from helpers import clashing, documents, odd_rows, prose
from pyspark.sql import functions as F

from shiplabel.llm import common, html_extract, langid, licenses, toxicity

SF = "/root/testdata/sf0.01"


# --- language ---------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identified(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99
    assert got.where("score < 0 OR score > 1").isEmpty()


def test_language_odd_rows(spark):
    rng = random.Random(2)
    rows = odd_rows() + [(50 + i, prose(rng, 60, "de"), "de") for i in range(12)] + [(90, "123 ... 🙂"), (91, "日本語")]
    docs = clashing(documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") == 4, None).otherwise(F.col("lang"))))
    got = {r["doc_id"]: r for r in langid.identified(docs).collect()}
    assert langid.identified(docs).count() == len(rows)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (9, 10, 11, 14, 90))
    assert all(got[50 + i]["lang_pred"] == "de" for i in range(12)) and all(got[i]["lang_pred"] == "en" for i in range(1, 9))
    assert got[91]["lang_pred"] in ("de", "en")
    kept = langid.known_language(docs)
    assert kept.columns == docs.columns
    assert {9, 10, 11, 14, 90}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.count() == len(rows) - 5


def test_samples_of_repeated_ids_are_bounded(spark):
    docs = spark.range(3000).selectExpr("1L AS doc_id", "concat('the river ', id) AS text", "'en' AS lang")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert 50 < toxicity.sample(docs, labels, 100).count() < 160
    assert 50 < common.hash_sample(docs, ["doc_id", "text"], 100, 7).count() < 160
    assert langid.train(docs, 100).languages == ["en"]
    same = docs.withColumn("text", F.lit("the river"))
    assert toxicity.sample(same, labels, 100).count() <= 1


def test_language_without_training_rows(spark):
    docs = documents(spark, [(1, "the river"), (2, None)]).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identified(docs).collect()} == {"und"}
    assert langid.identified(documents(spark, [])).count() == 0


def test_known_language_rejects_unlearned_texts(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.choice([5, 40, 200]), lang), lang) for i, lang in enumerate(["en", "de"] * 60)]
    odd = ["xqzk vbnmq wrtpl kjhgf zzxcv qqwrt plmkj " * 5, "Это русский текст о погоде и реках. " * 4, "日本語の文章はここにあります " * 5]
    docs = documents(spark, rows + [(500 + i, t, None) for i, t in enumerate(odd)])
    assert {r["doc_id"] for r in langid.known_language(docs).collect()} == set(range(120))
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.known_language(none).count() == 123


def test_least_known_goes_by_all_held_out_rows(spark):
    """More rows than a training sample holds: each of them counts, also those that are explained least."""
    rng = random.Random(12)
    model = langid.train(documents(spark, [(i, prose(rng, 60), "en") for i in range(40)]))
    strange = lambda: "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(3, 12)))
    mixed = lambda: " ".join(strange() if rng.random() < 0.3 else prose(rng, 1) for _ in range(rng.randint(8, 30)))
    texts = [mixed() for _ in range(langid.TRAIN_ROWS + 3000)]
    labelled = documents(spark, [(i, t, "en") for i, t in enumerate(texts)] + [(-1, "xqzk", None), (-2, "...", "en"), (-3, None, "en")])
    best, total, _ = model.known(texts, langid.letters())
    shares = np.sort(best / total)
    assert len(set(shares[:60])) > 50
    expected = langid.MARGIN * np.percentile(shares, 100 / langid.STRAYS)
    assert langid.least_known(labelled, model) == pytest.approx(expected, rel=1e-12)
    few = labelled.where("doc_id BETWEEN 0 AND 4")
    assert langid.least_known(few, model) == pytest.approx(langid.MARGIN * np.percentile((best / total)[:5], 100 / langid.STRAYS), rel=1e-12)
    assert langid.least_known(labelled.where("doc_id < 0"), model) == 0.0


def test_values_at_ranks(spark):
    rng = random.Random(3)
    values = [rng.choice([0, 1, 5, 1 << 20, (1 << 62) + 3, rng.getrandbits(62)]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ranks = [0, 1, 99, 250, 251, 499]
    assert common.at_ranks(df, "v", ranks) == [sorted(values)[r] for r in ranks]


def test_language_filters_answer_all_inserted_grams(spark):
    docs = documents(spark, [(i, "the river and the house", "en") for i in range(8)] + [(20 + i, "der fluss und das haus", "de") for i in range(8)])
    model = langid.train(docs)
    plain = langid.letters()
    for lang, text in (("en", "the river and the house"), ("de", "der fluss und das haus")):
        packed = langid.grams([text], plain)[0]
        masks = [model.table[0][slot] for slot in langid.slots(packed)]
        bit = model.languages.index(lang)
        assert all(((m >> bit) & 1).all() for m in masks)


def test_language_score_is_the_texts_own():
    """Neighbours in a batch change nothing."""
    plain = langid.letters()
    rng = random.Random(4)
    texts = [prose(rng, rng.choice([0, 1, 5, 40])) if rng.random() < 0.8 else rng.choice(["", " ", "..", "a", "Ab  c!"]) for _ in range(60)]
    packed, owner, lettered = langid.grams(texts, plain)
    for i, t in enumerate(texts):
        alone, _, has = langid.grams([t], plain)
        assert (packed[owner == i] == alone).all() and has[0] == lettered[i] == any(c.isalpha() for c in t)


# --- toxicity ---------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] / (counts[1, 1] + counts[1, 0]) > 0.85
    assert counts.get((0, 1), 0) / (counts[0, 0] + counts.get((0, 1), 0)) < 0.01


def test_toxicity_grammar():
    grammar = toxicity.Grammar({b"idiot": 3.5}, {b"lowe": 4.0})
    seen = lambda text: [round(x, 3) for x in grammar.features(text)]
    assert seen("A fine day.") == seen("") == [0] * 5
    plain, targeted, negated, reported, threat = (seen(t) for t in ("Idiot, really.", "You idiot!", "That is not an idiot.", "It is said: he said idiot.", "We will kill you"))
    assert plain[0] > 0 and targeted[1] > 0 and negated[2] > 0 and reported[3] > 0 and threat[4] > 0
    assert seen("We kill time")[4] == 0
    assert seen("loweix")[0] > 0 and seen("low eix") == [0] * 5
    assert toxicity.score(targeted, toxicity.PRIOR) > toxicity.score(negated, toxicity.PRIOR)
    assert toxicity.score(seen("You idiot!"), toxicity.PRIOR) >= toxicity.THRESHOLD


def test_toxicity_odd_rows(spark):
    rows = odd_rows() + [(60, "You stupid idiot, you pathetic loser."), (61, "They are worthless scum, filthy trash!")]
    docs = clashing(documents(spark, rows))
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (None, 1, 1), (60, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in got if r["predicted"]} == {60, 61}
    none = labels.where("false")
    assert toxicity.toxicity(docs, none).count() == len(rows)
    assert toxicity.toxicity(documents(spark, []), none).count() == 0


# --- licences ---------------------------------------------------------------------------------


def test_licences(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 50) + "\n" + prose(rng, 20)) for i in range(1, 40)]
    rows += [(100, prose(rng, 30) + "\nReleased under the MIT License.\n" + prose(rng, 30)), (101, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0"),
             (102, "This work is licensed under the GNU General Public License, version 3.\nAll rights reserved."),
             (103, "Licensed under CC BY-NC 4.0."), (104, "I have a driving license and all the rights of a licensed man."),
             (105, "In general the public paid the license."), *odd_rows()]
    got = licenses.licences(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: r["families"] for r in got if r["families"]}
    assert found == {100: "MIT", 101: "Apache", 102: "GPL,Proprietary", 103: "CC-BY-NC"}


def test_wrapped_and_short_licences(spark):
    rng = random.Random(16)
    gpl = (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as "
        "published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
    )
    mit = "Permission is hereby\ngranted, free of charge, to any person\nobtaining a copy of this software"
    wanted = {
        gpl.format(""): "GPL", gpl.format("Lesser "): "LGPL", gpl.format("Affero "): "AGPL", "# " + mit.replace("\n", "\n# "): "MIT",
        "MIT License": "MIT", "CC BY 4.0": "CC-BY", "CC BY-SA 4.0": "CC-BY-SA", "// SPDX-License-Identifier: MIT": "MIT",
        "SPDX-License-Identifier: GPL-3.0-or-later": "GPL", "SPDX-License-Identifier: Apache-2.0": "Apache",
        "The lawyers of GPL and MIT license their texts now and then": "", "Next to\n\nthe GNU Lesser": "",
    }
    rows = [(i, prose(rng, 50) + "\n\n" + prose(rng, 20)) for i in range(1, 40)]
    rows += [(100 + i, f"{prose(rng, 20)}\n \n{t}\n\n{prose(rng, 20)}") for i, t in enumerate(wanted)]
    got = {r["doc_id"]: r for r in licenses.licences(documents(spark, rows)).collect()}
    assert {t: got[100 + i]["families"] for i, t in enumerate(wanted)} == wanted
    assert got[100]["n_paragraphs"] == 3 and got[100]["n_licensed"] == 1


def test_licence_anchors_and_empty_table(spark):
    assert "mit" in licenses.anchors()
    assert licenses.licences(documents(spark, [])).count() == 0


# --- pages ------------------------------------------------------------------------------------


def test_pages_held_out():
    field = html_extract.trained()
    wrong = total = 0
    for number in range(5000, 5150):
        html, main = html_extract.labelled_page(number)
        blocks = html_extract.blocks_of(html)
        wanted = [int(b[0] in {" ".join(t.split()) for t in main}) for b in blocks]
        got = field.decode(*html_extract.sequence_of(blocks, {}))
        wrong += sum(a != b for a, b in zip(got, wanted))
        total += len(blocks)
    assert wrong / total < 0.02


def test_viterbi_is_the_best_path():
    from itertools import product

    rng = random.Random(3)
    for _ in range(30):
        n = rng.randint(1, 7)
        names = [(f"f{rng.randint(0, 3)}", f"g{rng.randint(0, 3)}") for _ in range(n)]
        same = [rng.random() < 0.5 for _ in range(n - 1)]
        emit = {f: (rng.gauss(0, 1), rng.gauss(0, 1)) for block in names for f in block}
        pairs = [[[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)] for _ in range(2)]

        def total(path):
            out = sum(emit[f][y] for block, y in zip(names, path) for f in block)
            return out + sum(pairs[int(s)][a][b] for s, a, b in zip(same, path, path[1:]))

        best = max(product((0, 1), repeat=n), key=total)
        assert tuple(html_extract.Field(emit, pairs).decode(names, same)) == best


def test_page_text(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p><p>no</p>';</script></head><body>"
        "<nav><ul><li><a href=x>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies.</div>"
        "<article><h1>Title &amp; more</h1><p>One   two<br>\n three &#233;.<p>Next <b>bold</b> line."
        "<div class='ad'>Buy now.</div></article><section id='comments'><p>Great read, thank you very much.</p></section>"
        "<aside class='sidebar'><p>Side text.</p></aside><form><label>Mail</label></form><footer>&copy; me</footer>"
    )
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, None, "<p>cut off here, but a whole sentence. <b"), (1, "u", page), (5, "u", "<" * 3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = html_extract.extract(pages).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == "Title & more\nOne two three é.\nNext bold line."
    assert text[2] == text[3] == "" and text[4].startswith("cut off")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(pages.where("false")).count() == 0


LONG, SHORT = "The quick brown fox jumps over the lazy dog, and runs away. It was never seen again.", "Short one."


@pytest.mark.parametrize(
    "html, want",
    [
        (
            f"<header><h1>Site</h1></header><article><h1>My title</h1><p>{LONG}</p><p>{SHORT}</p></article><section id='comments'>"
            f"<article class='comment'><p>{LONG} I think.</p></article><article class='comment'><p>Nice.</p></article></section>",
            f"My title\n{LONG}\n{SHORT}",
        ),
        (
            f"<nav><a href=x>Home</a></nav><main><article><h2>T</h2><div class='notice'>We use cookies, please agree.</div><p>{LONG}</p>"
            f"<aside class='sidebar'><h3>Related</h3><ul><li><a href=1>Other</a></li></ul></aside><p>{SHORT}</p><div class='advert'>"
            f"<p>Buy it now for little money.</p></div><p>{LONG} End</p><form><label>Email</label><input><p>Sign up.</p></form></article></main>",
            f"T\n{LONG}\n{SHORT}\n{LONG} End",
        ),
        (
            f"<div id='header'><div class='logo'>L</div></div><div id='menu'><ul><li><a href=a>A</a></li></ul></div><div id='content'>"
            f"<div class='post'><h1>Head</h1><p>{LONG}</p><ul><li>First item here</li><li>Second item</li></ul></div>"
            f"<div class='comment-list'><p>{LONG} me too</p></div></div><div id='sidebar'><p>{LONG} side</p></div><div id='footer'>&copy;</div>",
            f"Head\n{LONG}\nFirst item here\nSecond item",
        ),
        (f"<p>{LONG}</p><p>{SHORT}</p><p>{LONG} two</p>", f"{LONG}\n{SHORT}\n{LONG} two"),
    ],
)
def test_layouts(html, want):
    assert html_extract.main_text(f"<html><body>{html}</body></html>", html_extract.trained(), {})[0] == want


@pytest.mark.parametrize(
    "head",
    [
        "<html><head><title>T</title><body>",
        "<html><head><title>T</title><meta charset=x><link rel=y><style>p{}</style><script>var a='<p>';</script>",
        "<head><title>T</title><noscript><img src=x></noscript><body class=b>",
        "<head><title>T</title><template><p>Not this.</p></template></head><body>",
        "<html><head><body>",
    ],
)
def test_open_heads(head):
    page = head + f"<article><h1>My title</h1><p>{LONG}</p><p>{SHORT}</p></article>"
    assert html_extract.main_text(page, html_extract.trained(), {})[0] == f"My title\n{LONG}\n{SHORT}"
    assert [b[0] for b in html_extract.blocks_of("<head><title>T</title>Bare text<p>Next")] == ["Bare text", "Next"]
    assert all("head" not in [tag for tag, _ in b[1]] for b in html_extract.blocks_of(page))


def test_malformed_pages():
    field = html_extract.trained()
    text = lambda html: html_extract.main_text(f"<html><body><article>{html}", field, {})[0]
    assert text(f"<p>{LONG}</p><p>{SHORT}</p><!-- open <p>{LONG}</p></article>") == f"{LONG}\n{SHORT}"
    for how in ("hidden", 'style="display: none"'):
        assert text(f"<p>{LONG}</p><p {how}>{SHORT} {LONG}</p><p>{SHORT}</p></article>") == f"{LONG}\n{SHORT}"
    # Elements that are never closed, and ends of elements that never began: time in proportion to the page.
    for opened in ("<div>x", "<b>x<p>y", "<div class=one>x<span>", "</section>x</i>", "<font><table><td>x"):
        began = time.process_time()
        assert html_extract.blocks_of(opened * 40_000)
        assert time.process_time() - began < 15


def test_given_pages(spark):
    """Articles of the given pages, against a reading that knows their one layout."""
    import html as references
    import re

    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = row["html"].split("<article>")[1].split("</article>")[0]
        parts = [re.sub("<[^>]+>", "", p.replace("<br>", " ")) for p in re.split("</?(?:p|h1)>", inner)]
        want = "\n".join(t for p in parts if (t := " ".join(references.unescape(p).split())))
        assert html_extract.main_text(row["html"], html_extract.trained(), {})[0] == want
