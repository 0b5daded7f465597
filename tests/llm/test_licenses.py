import random
import re
import textwrap

import pytest
from oracle_check import compare, duck

from closeledger.llm.licenses import TEMPLATES, op6_license_scan, oracle_sql, required, scan, template_words, window


def test_query_matches_sql(spark, sf):
    ok, message = compare(op6_license_scan(spark, sf), duck(sf), oracle_sql())
    assert ok, message


def test_odd_rows(odd, odd_rows, nothing):
    rows = scan(odd).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    nine = by_id[9]
    assert (nine.n_words, nine.n_base, nine.first_word, nine.last_word, nine.base_labels) == (8, 3, 0, 4, "cc-by,gpl")
    for i in (2, 3, 4):
        assert (by_id[i].n_words, by_id[i].n_base, by_id[i].first_word, by_id[i].labels, by_id[i].score) == (0, 0, None, "", 0.0)
    assert [r.n_base for r in rows if r.doc_id == 0] == [1, 1, 1]
    assert scan(nothing).count() == 0


def test_notices(spark):
    texts = [
        "Released under the MIT License.",
        "x\nLicensed under the APACHE license, version 2.0 here\ny",
        "licensed under the apache",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and documentation files, to deal in it",
    ]
    got = [r.labels for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got[:3] == ["mit,mit-notice", "apache,apache-2.0-notice", ""]
    assert got[3] == "mit-terms"


def brute(text):
    """Template labels and score, from every window of words."""
    words, found = [w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w], {}
    for label, own in template_words().items():
        best = max((len(set(words[i : i + window(label)]) & set(own)) for i in range(len(words))), default=0)
        if best >= required(len(own)):
            found[label] = best / len(own)
    return set(found), max(found.values(), default=0.0)


def _check(spark, texts):
    got = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for row, text in zip(got, texts, strict=True):
        labels, score = brute(text)
        assert {x for x in row.labels.split(",") if x in TEMPLATES} == labels and row.score == pytest.approx(score), text[:200]
    return got


def test_wrapped_and_unbroken_notices_are_found_and_scattered_words_are_not(spark):
    rng = random.Random(6)
    filler = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma,", "the", "of"]) for _ in range(n))
    texts = []
    for text in TEMPLATES.values():
        notice = f"{filler(40)}. {text.capitalize()}. {filler(30)}"
        texts += ["\n".join(textwrap.wrap(notice, 60)), "\r\n * ".join(textwrap.wrap(notice, 72)), f"{filler(3000)} {text} {filler(3000)}"]
    whole = len(texts)
    for words in template_words().values():
        long = [rng.choice(["alpha", "beta", "gamma"]) for _ in range(8000)]
        for k, w in enumerate(words):
            long[200 * k + 7] = w
        texts.append(" ".join(long))
    got = _check(spark, texts)
    for i, label in enumerate([x for x in TEMPLATES for _ in range(3)]):
        assert label in got[i].labels.split(",") and got[i].score == 1.0
    assert all(r.score == 0.0 for r in got[whole:])


def test_near_the_threshold_matches_brute_force(spark):
    rng, texts = random.Random(7), ["", "license " * 500, "mit " * 30]
    for text in TEMPLATES.values():
        for _ in range(12):
            words = [w for w in text.split() if rng.random() > 0.18]
            for _ in range(rng.randrange(8)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["x", "y", "the", "license", "É"]))
            texts.append(" ".join(words).title() + "\n" + " ".join(rng.choice(text.split()) for _ in range(20)))
    _check(spark, texts)
