import hashlib
import random
import re

import pytest
from helpers import clashing, documents, odd_rows, prose

from shiplabel.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    doc, hit, found = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        at = [i for i in range(len(doc) - n + 1) if tuple(doc[i : i + n]) in windows]
        hit.update(j for i in at for j in range(i, i + n))
        if at and item_id is not None:
            found.add(str(item_id))
    return len(doc), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def tables(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice([4, 10, 11, 40]))) for i in range(12)] + [(20, None), (21, ""), (5, "zwei wörter"), (None, prose(rng, 12))]
    rows = odd_rows()
    for i, (_, item) in enumerate(items):
        if item:
            cut = item.split()
            rows.append((200 + i, prose(rng, 20) + " " + item.upper().replace(" ", " - ") + " " + prose(rng, 5)))
            rows.append((300 + i, prose(rng, 20) + " " + " ".join(cut[:9]) + " " + prose(rng, 5)))
    rows += [(400, items[3][1] + " " + items[3][1]), (401, "Zwei\nWörter zwei wörter")]
    return rows, items, documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_report_against_brute_force(spark, block_words):
    rows, items, docs, benchmark = tables(spark)
    got = decontaminate.report(clashing(docs), benchmark, block_words=block_words).collect()
    want = sorted(((r[0], *brute(r[1], items)) for r in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "DOC_WORDS", 5)
    test_report_against_brute_force(spark, 500_000)
    rng = random.Random(4)
    for text in (None, "", "one", "ä-b " * 40, prose(rng, 300), "x" * 500 + " " + prose(rng, 30)):
        for window in (1, 4, 10):
            got = {}
            for first, part in decontaminate.parts_of(text, 5, window):
                assert all(got.get(first + i, w) == w for i, w in enumerate(part))
                got.update((first + i, w) for i, w in enumerate(part))
            assert [got[i] for i in sorted(got)] == decontaminate.words_of(text) and list(sorted(got)) == list(range(len(got)))


def test_copies_and_several_blocks(spark):
    rows, items, _, benchmark = tables(spark)
    rows = rows + [(None, rows[-1][1])] * 30 + [(7, rows[-2][1])] * 30
    got = decontaminate.report(documents(spark, rows), benchmark, block_words=60).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((r[0], *brute(r[1], items)) for r in rows), key=repr)


@pytest.mark.parametrize("remove", ["spans", "documents"])
def test_removal(spark, remove):
    rows, items, docs, benchmark = tables(spark)
    out = decontaminate.decontaminate(clashing(docs), benchmark, remove)
    assert out.columns == clashing(docs).columns
    texts = {}
    for r in out.collect():
        assert not brute(r["text"], items)[4]
        texts.setdefault(r["doc_id"], []).append(r["text"])
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    for key, text in rows:
        if not brute(text, items)[4]:
            assert text in texts[key]
    clean = sum(not brute(text, items)[4] for _, text in rows)
    assert out.count() == clean if remove == "documents" else out.count() > clean


def test_empty_tables(spark):
    _, _, docs, benchmark = tables(spark)
    assert decontaminate.report(docs.where("false"), benchmark).count() == 0
    assert decontaminate.report(docs, benchmark.where("false")).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs, benchmark.where("false")).count() == docs.count()
