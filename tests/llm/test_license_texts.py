"""License texts without their names, hits that overlap, and very many hits."""

import random
import re
import time
from re import _parser

import pytest
from roadbed.llm import licenses

from .test_whole_job import examples

MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
BSD3 = BSD + "\n* Neither the name of the copyright holder nor the names of its\n  contributors may be used to endorse or promote products derived from\n  this software without specific prior written permission."
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'
GRANT = "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
GPL2 = "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended"
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"


def labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.labels for r in sorted(licenses.scan_licenses(docs).collect())]


def test_texts_of_licenses(spark):
    want = [(MIT, "mit"), (BSD, "bsd"), (BSD3, "bsd,bsd-3"), (APACHE, "apache-2"), (GRANT, "apache-2"), (GPL, "gpl-3"), (GPL2, "gpl-2"), (ISC, "isc")]
    assert labels(spark, [t for t, _ in want]) == [x for _, x in want]
    joined = [re.sub(r"[^\w]+", "_", t) for t, _ in want]
    assert labels(spark, joined) == [x for _, x in want]
    assert labels(spark, [t.upper().replace(" ", "\n * ") for t, _ in want]) == [x for _, x in want]


def test_a_later_surer_hit_removes_an_earlier_one(spark):
    texts = ["bsd licensed under the mit license", "zlib license mit license", "licensed under the mit license bsd"]
    assert labels(spark, texts) == ["mit", "mit", "mit"]


def test_keywords_stand_in_their_signatures():
    for keyword, own in licenses.SIGNATURES.items():
        assert all(keyword in pattern for _, pattern in own), keyword


def test_gates_let_every_sentence_through():
    gate = re.compile(licenses._GATE)
    for _, own in list(licenses.rules())[: len(licenses.SIGNATURES)]:
        for pattern, *_ in own:
            for text in examples(_parser.parse(pattern)):
                assert gate.search(text.strip().replace(" ", "_")), pattern


def brute(text):
    """Labels and doubt: all hits against all others."""
    norm = " " + re.sub(licenses._NON_WORD, " ", text.lower()).strip() + " "
    hits = []
    for _, own in licenses.rules():
        for pattern, label, priority, weight in own:
            hits += [(m.start(), -len(m[0]), priority, label, weight) for m in re.finditer(pattern, norm)]
    hits.sort()
    end = lambda h: h[0] - h[1]
    outer = [h for i, h in enumerate(hits) if not any(end(g) >= end(h) for g in hits[:i])]
    meets = lambda g, h: g[0] < end(h) and h[0] < end(g)
    stay = [h for h in outer if not any(meets(g, h) and g[2] < h[2] for g in outer)]
    doubt = 1.0
    for h in stay:
        doubt *= 1 - h[4]
    return {h[3] for h in stay}, doubt


@pytest.mark.parametrize("chunk", [128, 2])
def test_hits_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(licenses, "_CHUNK", chunk)
    draw = random.Random(3)
    words = "mit bsd zlib isc apache gpl v3 2 0 license licensed licence under the terms of subject to public domain style cc by nc sa".split()
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(1, 60))) for _ in range(150)] + [MIT + " " + GPL + " " + BSD3, "", "   "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in licenses.scan_licenses(docs).collect():
        found, doubt = brute(texts[row.doc_id])
        base = set(filter(None, row.base_labels.split(",")))
        assert set(filter(None, row.labels.split(","))) == found | base, texts[row.doc_id]
        assert row.score == pytest.approx(1.0 if base else 1 - doubt)


def test_very_many_hits_in_one_text(spark):
    docs = spark.createDataFrame([(1, "licensed under the mit license " * 20_000)], "doc_id bigint, text string")
    start = time.time()
    row = licenses.scan_licenses(docs).first()
    assert (row.n_base, row.labels) == (20_000, "mit")
    assert time.time() - start < 40
