"""URL reputation, language ID, byte BPE, token counts and licence scan against plain versions of the same thing."""

import base64
import math
import random
import textwrap
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from aeroledger.llm import byte_bpe, language_id, license_scan, queries, token_counts, url_reputation
from aeroledger.llm.license_texts import TEMPLATES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, ids string, n_tokens string"
ODD_TEXTS = ["", " ", "  ", "\n", " \n", "a \nb", "a  b", " a", "a ", "\na\n b \n\n c  ", "▁ a▁ b", "<s> </s>", "日本語 x", "a\tb\r\n", "x" * 700, "\0 a"]


@pytest.fixture(scope="module")
def tokenizer():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, seed=4):
    rng = random.Random(seed)
    words = ["the", "of", "Zug", "été", "it's", "x1", "2024", "....", "日本", "  ", "\n", "\t \n", "a" * 30, "🙂"]
    return [rng.choice(["", " "]).join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(n)] + ODD_TEXTS


def as_docs(spark, rows):
    """doc_id, text and columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "en", "clash", "clash") for i, t in rows], DOCS)


# ---- URLs


def test_url_parts(spark):
    urls = [None, "", "no scheme", "HTTP://A.B.Example.Com/De/x?q#f", "http://h", "http://h?x/y", "http://h#/a", "x://y://z/p", "http://É.Net/ü"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string")
    got = rows.select(url_reputation.host_of(F.col("url")), url_reputation.path_of(F.col("url"))).collect()
    want = [("", ""), ("", ""), ("", ""), ("a.b.example.com", "/De/x"), ("h", ""), ("h", ""), ("h", ""), ("y:", "//z/p"), ("É.net", "/ü")]
    assert [tuple(r) for r in got] == want


def test_rules_longest_wins(spark):
    pages = [("http://a.net/x", "net/"), ("http://example.net/en/1", "example.net/en/"), ("http://b.example.net/de/", "net/"), ("http://net", None)]
    pages += [("http://xexample.com/de/", None), ("http://example.com/de/", "example.com/de/"), ("http://org/fr/a", "org/fr/"), (None, None)]
    rows = spark.createDataFrame([(i, u, "clash") for i, (u, _) in enumerate(pages)], "page_id long, url string, host string")
    got = url_reputation.judge_urls(rows, spark.createDataFrame([], "page_id long, good boolean"), queries.URL_RULES).collect()
    assert {r.page_id: r.rule for r in got} == {i: rule for i, (_, rule) in enumerate(pages)}
    assert all(r.verdict in ("allow", "block") for r in got)
    assert url_reputation.judge_urls(rows.limit(0), spark.createDataFrame([], "page_id long, good boolean")).count() == 0


def test_beta_quantile():
    from random import Random

    rng = Random(1)
    a, b = np.array([0.6, 2.0, 30.0, 400.0]), np.array([0.9, 5.0, 3.0, 250.0])
    for x, y, q in zip(a, b, url_reputation.beta_quantile(a, b, 0.05), strict=True):
        sample = sorted(rng.betavariate(x, y) for _ in range(40_000))
        assert abs(sum(s < q for s in sample) / len(sample) - 0.05) < 0.005


def test_reputation_shrinks(spark):
    good = [("a.x.com", 40, 40), ("b.x.com", 1, 1), ("c.y.com", 0, 40), ("d.y.com", 0, 1), ("e.z.org", 0, 0)]
    pages, outcomes = [], []
    for host, n_good, n in good:
        for k in range(max(n, 1)):
            pages.append((len(pages), f"http://{host}/{k}"))
            if n:
                outcomes.append((len(pages) - 1, k < n_good))
    outcomes.append((0, None))
    rows = url_reputation.host_reputation(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, good boolean")
    )
    by = {r.host: r for r in rows.collect()}
    assert (by["a.x.com"].n, by["a.x.com"].good) == (40, 40)
    assert by["a.x.com"].good_rate > by["b.x.com"].good_rate > by["e.z.org"].good_rate > by["d.y.com"].good_rate > by["c.y.com"].good_rate
    assert by["b.x.com"].good_rate_low < by["a.x.com"].good_rate_low
    for r in by.values():
        assert math.isclose(r.good_rate, r.alpha / (r.alpha + r.beta)) and 0 <= r.good_rate_low < r.good_rate


# ---- languages


def test_held_out_accuracy(spark, sf_dir):
    found = queries.op2_language_bloom(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.95


def test_language_edge_cases(spark):
    english, german = "the thing that is with the other thing ", "der die und das ist nicht ein schönes Ding "
    docs = [(1, english * 9, "en"), (2, german * 9, "de"), (2, german * 9, "de"), (3, None, "en"), (4, english, None), (None, "12 !", "en"), (5, "", "de")]
    rows = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, lang string, score string")
    model = language_id.learn(rows)
    assert set(model.langs) == {"en", "de"}
    got = sorted((tuple(r) for r in language_id.predict(rows, model).collect()), key=repr)
    assert len(got) == len(docs)
    by = {r[0]: r for r in got}
    assert (by[1][1], by[2][1], by[4][1]) == ("en", "de", "en") and by[3][1] == by[5][1] == by[None][1] == "und" and by[3][2] == 0
    assert all(0 <= r[2] <= 1 for r in got)
    empty = language_id.learn(rows.limit(0))
    assert [r.lang_pred for r in language_id.predict(rows, empty).collect()] == ["und"] * len(docs)
    assert language_id.predict(rows.limit(0), model).count() == 0


def test_bloom_has_no_false_negatives(spark):
    docs = spark.createDataFrame([(1, "abcd efgh " * 3, "x"), (2, "wxyz " * 3, "y")], "doc_id long, text string, lang string")
    model = language_id.learn(docs, n_slots=1 << 12)
    names, score, share = language_id.identify(["efgh abcd", "wxyz wxyz"], model)
    assert names == ["x", "y"] and (share > 0.6).all() and (score > 0.9).all()


def test_a_hundred_languages(spark):
    rng = random.Random(5)
    words = {f"l{k:02}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöüß", k=rng.randint(3, 9))) for _ in range(60)] for k in range(100)}
    rows = [(i, " ".join(rng.choices(words[lang], k=80)), lang) for i, lang in enumerate(sorted(words) * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs.where("doc_id < 500"))
    assert model.slots.shape[1] == 2 and len(model.langs) == 100
    got = language_id.predict(docs, model, "doc_id", "lang").where("doc_id >= 500").collect()
    assert len(got) == 100 and sum(r.lang == r.lang_pred for r in got) >= 99


def plain_grams(text):
    """4-grams of letters, with one blank kept on each side of a word."""
    text = text.lower()
    letter = [c.isalpha() for c in text]
    kept = "".join(c if letter[i] else " " for i, c in enumerate(text) if any(letter[max(0, i - 1) : i + 2]))
    return [kept[i : i + 4] for i in range(len(kept) - 3)]


def test_filters_as_plain_sets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    rows = docs.collect()
    model = language_id.learn(docs, max_docs=10**9)
    counts = {lang: Counter(g for r in rows if r.lang == lang for g in plain_grams("\n" + r.text + "\n")) for lang in model.langs}
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    rate = {g: max(c[g] / total[x] for x, c in counts.items()) for c in counts.values() for g in c}
    sets = {x: {g for g, n in c.items() if n >= 2 and n / total[x] >= 0.2 * rate[g]} for x, c in counts.items()}
    assert max(map(len, sets.values())) <= 60_000
    texts = [r.text for r in rows]
    names, _, share = language_id.identify(texts, model)
    for text, name, found in zip(texts, names, share, strict=True):
        grams = plain_grams("\n" + text + "\n")
        if grams:
            plain = {x: sum(g in s for g in grams) / len(grams) for x, s in sets.items()}
            assert abs(plain[name] - found) < 0.05 and plain[name] >= max(plain.values()) - 0.05


def test_language_of_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "the thing that is with the other " * 9, "en"), (2, "der die und das nicht " * 9, "de")], "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    names, score, _ = language_id.identify(["der die und das nicht " * 100_000, "the other thing", "is\n" * 10 + "the"], model)
    assert names == ["de", "en", "en"] and score[0] > 0.9


def test_equal_shares_go_to_the_language_with_more_documents(spark):
    rows = [(1, "same words here " * 5, "b"), (2, "same words here " * 5, "b"), (3, "same words here " * 10, "a"), (4, "same words here " * 10, "c")]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ("b", "a", "c")
    assert language_id.identify(["same words", "zzz qqq"], model)[0] == ["b", "b"]


# ---- byte BPE


@pytest.mark.parametrize("size", [(48, 16), (32_768, 1_024)])
def test_bpe_as_the_library(spark, tokenizer, size):
    rows = [(i, t) for i, t in enumerate(texts(60))] + [(None, "null id"), (7, None), (7, "twice"), (7, "twice"), (1000, "y " * 70_000)]
    docs = as_docs(spark, rows)
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk_chars=size[0], overlap=size[1])
    got = byte_bpe.decode(encoded.withColumn("decoded", F.lit("clash")), RANKS, public_tokenizers.PATTERN).collect()
    want = [(i, tokenizer.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in got), key=repr) == sorted(want, key=repr)
    assert byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_null_ids_decode_to_no_bytes(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode(rows, RANKS, public_tokenizers.PATTERN).collect()] == [b"", b""]


# ---- token counts


def test_counts_as_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(2)
    some = texts(40) + ["".join(rng.choices("ab \n▁é<s>", k=rng.randint(0, 25))) for _ in range(800)]
    rows = list(enumerate(some)) + [(None, "a"), (3, None), (3, "b b"), (3, "b b"), (4, "long words " * 9_000), (5, "z" * 20_000)]
    got = token_counts.count_tokens(as_docs(spark, rows), MODEL).collect()
    want = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(as_docs(spark, []), MODEL).count() == 0


def test_count_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    tool = token_counts.Counter(MODEL)
    for batch in (["a b c"] * 3, [" ".join(map(str, range(50)))], ["a b c d " + "q" * 99]):
        assert tool.count(batch) == [len(x) for x in tool.model.encode(batch)]
    assert len(tool.known) <= 60 and not any(len(p) > 64 for p in tool.known)


# ---- licences


@pytest.fixture(scope="module")
def license_model(spark, sf_dir):
    return license_scan.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_templates_are_recognised(license_model):
    for i, notices in enumerate(TEMPLATES.values()):
        for notice in notices:
            words = license_scan.WORDS.findall(notice.lower())
            p = license_model.probabilities(words)
            assert p.argmax() == i and license_model.similarity(words, i) == 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_training_converges(spark, monkeypatch, sf):
    found = []
    monkeypatch.setattr(license_scan, "train", lambda others, seed: found.append(others))
    license_scan.learn(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet"))
    monkeypatch.undo()
    models = [license_scan.train(found[0], max_rounds=n) for n in (1_000, 2_000)]
    assert models[0].calibration_error < 0.03
    for i, notices in enumerate(TEMPLATES.values()):
        for notice in notices:
            p = [m.probabilities(license_scan.WORDS.findall(notice.lower())) for m in models]
            assert p[0].argmax() == p[1].argmax() == i and min(p[0][i], p[1][i]) >= 0.5


def test_minimum_of_a_known_function():
    centre = np.linspace(-3, 3, 20).reshape(5, 4)
    scale = np.geomspace(1e-3, 10, 20).reshape(5, 4)
    found = license_scan.minimise(lambda w: (float((scale * (w - centre) ** 2).sum()), 2 * scale * (w - centre)), np.zeros((5, 4)), 500)
    assert np.abs(found - centre).max() < 1e-3


def plain_license(text, model, min_probability=0.5, min_similarity=0.75):
    """The scan of one text with dictionaries."""
    weight = {g: model.weights[i] for g, i in model.number.items()}
    best = None
    for _, words in license_scan.windows(text or ""):
        grams = {" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)}
        z = (sum(weight.get(g, 0) for g in grams) / max(1, 3 * len(words) - 3) ** 0.5 + model.weights[-1]) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        family = max(range(len(model.families)), key=lambda f: p[f])
        held = max(len(t & grams) / len(t) for f, t in model.templates if f == family)
        if p[family] >= min_probability and held >= min_similarity and (best is None or p[family] > best[1]):
            best = model.families[family], p[family], held
    return best or (None, None, None)


def test_scan_as_the_plain_version(spark, sf_dir, license_model):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(-1, None), (-2, "MIT"), *((1000 + k, "intro\n\n" + t) for k, t in enumerate(WRAPPED.values()))]
    got = {r.doc_id: r for r in license_scan.scan(as_docs(spark, rows), license_model).collect()}
    for i, text in rows:
        name, p, held = plain_license(text, license_model)
        assert got[i].license == name
        if name is not None:
            assert got[i].probability == pytest.approx(p) and got[i].probability >= 0.5 and got[i].similarity == held


def test_license_lines_of_the_corpus(spark, sf_dir, license_model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = {"MIT": "Released under the MIT License.", "GPL": "GNU General Public License", "Apache": "Apache License, Version", "CC-BY-NC": "CC BY-NC 4.0"}
    want = {r.doc_id: {k for k, v in lines.items() if v in r.text} for r in docs.collect()}
    got = {r.doc_id: r for r in license_scan.scan(docs, license_model).collect()}
    assert any(want.values())
    for doc_id, families in want.items():
        assert (got[doc_id].license in families) if families else got[doc_id].license is None


def test_license_edge_cases(spark, license_model):
    filler = "some words of other text that go on and on " * 12
    docs = [(1, None), (2, ""), (3, "\n \n"), (4, filler + "Released under the MIT License. " + filler), (4, "MIT"), (None, "Licensed under CC BY 4.0.")]
    docs += [(5, "This work is licensed under a licence of our own making, see the office."), (6, filler * 300)]
    got = license_scan.scan(as_docs(spark, docs + docs[-1:]).withColumnRenamed("lang", "license"), license_model).collect()
    assert len(got) == len(docs) + 1
    by = {(r.doc_id, r.n_paragraphs): r.license for r in got}
    assert by[(None, 1)] == "CC-BY" and by[(5, 1)] is None and by[(6, 1)] is None and by[(1, 0)] is None
    assert {r.license for r in got if r.doc_id == 4} == {"MIT", None}
    assert license_scan.scan(as_docs(spark, []), license_model).count() == 0
    assert license_scan.learn(as_docs(spark, []), max_others=10).families


WRAPPED = {
    "MIT": """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
""",
    "GPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
""",
    "LGPL": """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
""",
    "Apache": """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0
""",
}


@pytest.mark.parametrize("width", [None, 30])
def test_wrapped_licenses(spark, license_model, width):
    docs = []
    for k, text in enumerate(WRAPPED.values()):
        if width:  # narrower than any template
            text = "\n\n".join("\n".join(textwrap.wrap(" ".join(license_scan.WORDS.findall(p)), width)) for p in text.split("\n\n"))
        docs += [(2 * k, text), (2 * k + 1, "def main():\n    return 1\n\n" + text.replace("\n", "\r\n") + "\nimport os\n")]
    docs.append((99, "words of other text\nthat go on over\nmany short lines\n" * 40))
    got = {r.doc_id: r.license for r in license_scan.scan(as_docs(spark, docs), license_model).collect()}
    assert got == {2 * k + i: name for k, name in enumerate(WRAPPED) for i in (0, 1)} | {99: None}
