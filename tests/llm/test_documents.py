"""Operators on documents against brute force, over nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import textwrap
import time
import zlib

import pytest
import sentencepiece
import xxhash

from textpulse.llm import imatch, licenses, mixing, passages, pieces, repeats, sharding, simhash

SCHEMA = "doc_id long, text string, source string, _part string, fp string, bucket string, size string, row string"


def texts():
    """Prose with exact and near copies, a shared passage, and every odd text."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 120))) for _ in range(40)]
    shared = " ".join(rng.choice(words) for _ in range(30))
    prose[7] = prose[3]
    prose[9] = prose[3][:-9] + " zz"
    prose[12] = prose[4].upper()
    for i in (15, 18, 21):
        prose[i] = prose[i] + " " + shared + " " + prose[i][::-1]
    odd = [None, "", " \n\t ", "x", "a b", "a b", "▁q  ", "aaaa " * 60, "a" * 300, "a" * 300, "日本 語 " * 40, "\x00y"]
    return prose + odd + [" ".join(rng.choice(words) for _ in range(9_000)) + " " + shared]


@pytest.fixture(scope="module")
def rows():
    out = [(i * 3 % 61, t, ["s1", "s0", None][i % 3], "p", "f", "b", "z", "r") for i, t in enumerate(texts())]
    return [*out, out[5], out[5], (None, "no id " * 30, "s1", "p", "f", "b", "z", "r"), (None, None, "s9", *"pfbzr")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def key(r):
    return tuple("\0" if v is None else str(v) for v in r)


def same(got, want):
    assert sorted(map(key, got)) == sorted(map(key, want))


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(marks, near):
    """Smallest id reachable for each of (id, mark)."""
    todo, out = set(range(len(marks))), {}
    while todo:
        seen, stack = set(), [todo.pop()]
        while stack:
            i = stack.pop()
            seen.add(i)
            close = {j for j in todo if near(marks[i][1], marks[j][1])}
            todo -= close
            stack += close
        ids = [marks[i][0] for i in seen if marks[i][0] is not None]
        out.update(dict.fromkeys(seen, min(ids, default=None)))
    return out


@pytest.mark.parametrize("paired", [1, 64])
def test_simhash_links_like_brute_force(docs, rows, paired, monkeypatch):
    """With 1, every shared bucket takes the way of crowded ones."""
    monkeypatch.setattr(simhash, "PAIRED_BUCKET", paired)
    marks = [(r[0], plain_fingerprint(r[1])) for r in rows]
    group = plain_groups(marks, lambda a, b: bin(a ^ b).count("1") <= 2)
    same(simhash.near_duplicates(docs).collect(), [(i, f"{f:016x}", group[n]) for n, (i, f) in enumerate(marks)])


def test_simhash_links_at_two_bits_and_not_at_three(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    ring = [base] + [base ^ (1 << a) ^ (1 << b) for a, b in [(0, 63), (7, 8), (31, 40), (62, 61)]]
    far = [base ^ 0b111 << 20 ^ 1 << 45 ^ 1 << 59, rng.getrandbits(64)]
    signed = [simhash._signed(v) for v in ring + far]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    want = {
        (max(a, b), min(a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 2
    }
    assert {tuple(r) for r in found} == want


def test_simhash_keeps_one_row_of_a_group(docs, rows):
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    groups = simhash.near_duplicates(docs).where("component_id is not null").select("component_id").distinct().count()
    assert kept.where("doc_id is not null").count() == groups


def plain_jump(number, shards):
    number &= (1 << 64) - 1
    last, jump = -1, 0
    while jump < shards:
        last = jump
        number = (number * 2862933555777941757 + 1) % (1 << 64)
        jump = int((last + 1) * (float(1 << 31) / float((number >> 33) + 1)))
    return last


def test_jump_hash_follows_the_published_algorithm(spark):
    ids = [*range(300), -1, -(1 << 63), (1 << 63) - 1, 1 << 40]
    from pyspark.sql import functions as F

    for shards in (1, 2, 40, 1_000):
        got = sharding.assign(spark.createDataFrame([(i,) for i in ids], "i long"), F.col("i"), shards).collect()
        assert [(r.shard, r.grown_shard) for r in got] == [(plain_jump(r.i, shards), plain_jump(r.i, shards + 1)) for r in got]


def test_shards(docs, rows):
    got = sharding.shard_documents(docs).collect()
    same(
        [(r.doc_id, r.size, r.text_crc32, r.law) for r in got],
        [(r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode()), "key") for r in rows],
    )
    for shard in {r.shard for r in got}:
        slots = [r.slot for r in got if r.shard == shard]
        assert sorted(slots) == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 40) for r in got)


def test_pieces_match_the_library(docs, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_eos=True)
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids))]
        want.append((r[0], len(ids), *digest))
    same(pieces.digests(docs).collect(), want)


def test_pieces_decode_any_ids_like_the_library(spark):
    model = pieces.model_at(pieces.default_model())
    rng = random.Random(2)
    lists = [[rng.choice([rng.randrange(1, 32000), rng.randrange(3, 259)]) for _ in range(12)] for _ in range(200)]
    assert [model.decode(ids) for ids in lists] == [model.library.decode(ids) for ids in lists]
    made = pieces.decoded(pieces.encoded(spark.createDataFrame([("héllo  wörld\n",), (None,)], "text string")), out="back")
    assert [r.back for r in made.collect()] == ["héllo  wörld\n", ""]


def test_a_long_text_without_spaces_is_merged_like_the_library():
    model = pieces.model_at(pieces.default_model())
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(30_000))
    assert model.encode(text)[:-1] == model.library.encode(text)


def test_mix_meets_its_targets(docs, rows):
    got = mixing.mix_report(docs, block_words=8).collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    same([(r.doc_id, r.size) for r in got], [(r[0], n) for r, n in zip(rows, words)])
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    sums = {}
    for r in got:
        a = sums.setdefault((r.source_size, r.target), [0, 0])
        a[0], a[1] = a[0] + r.size, a[1] + r.taken
    assert all(size == s and abs(taken - t) <= 24 for (s, t), (size, taken) in sums.items())
    assert sum(t for _, t in sums) == pytest.approx(1.5 * sum(words))
    again = mixing.mix_report(docs.repartition(2), block_words=8).collect()
    same(got, again)


def test_targets_reshare_until_none_is_above(spark):
    sizes = [("a", 100), ("b", 1_000), (None, 50), ("é", 0), ("c", 10)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
    weights = dict(zip(["a", "b", "c", "é", None], [3, 1, 2, 3, 1]))
    target, left, open_ = {}, 1.5 * 1_160, dict(sizes)
    while True:
        share = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if share * weights[s] >= 2 * open_[s]]
        if not full:
            break
        for s in full:
            target[s] = 2.0 * open_.pop(s)
            left -= target[s]
    target.update({s: share * weights[s] for s in open_})
    assert got == pytest.approx(target)


def test_every_permutation_is_one(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 7, 100, 5_003):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(2), F.lit(1), F.lit(n)).alias("p"))
        assert sorted(r.p for r in got.collect()) == list(range(n))


def test_mixed_documents_hold_the_words_taken(docs):
    taken = sum(r.taken for r in mixing.mix_report(docs, block_words=8).collect())
    mixed = mixing.mixed_documents(docs, block_words=8)
    assert mixed.columns == docs.columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed.collect()) == taken


def test_a_mix_gathers_no_slots_on_the_driver(spark):
    """Two sources and few, long documents look small; their 1,500,000 slots and 1,000,000 pieces would take more than
    this in a broadcast. A short one can take a page, here 32 MB."""
    long = spark.range(20).selectExpr("id doc_id", "repeat('w ', 50000) text", "concat('s', id % 2) source")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "66m")
    try:
        got = mixing.mix_report(long, block_words=1).collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert len(got) == 20 and all(r.size == 50_000 and r.taken <= 100_000 for r in got)
    assert sum(r.taken for r in got) == 1_500_000


def test_mixed_documents_gather_no_slots_on_the_driver(spark):
    long = spark.range(20).selectExpr("id doc_id", "repeat('w ', 50000) text", "concat('s', id % 2) source")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "66m")
    try:
        got = mixing.mixed_documents(long, block_words=1).select("doc_id", mixing.size_of().alias("size")).collect()
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert {r.doc_id for r in got} == set(range(20)) and sum(r.size for r in got) == 1_500_000


def plain_removed(rows):
    order = [float("inf") if r[0] is None else r[0] for r in rows]
    octets, first = [(r[1] or "").encode() for r in rows], {}
    for place, b in zip(order, octets):
        for s in range(len(b) - 49):
            first[b[s : s + 50]] = min(place, first.get(b[s : s + 50], place))
    for r, place, b in zip(rows, order, octets):
        gone = bytearray(len(b))
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < place:
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        yield r[0], len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("least", [1_000, 4 << 20])
def test_repeats_go_like_brute_force(docs, rows, least, monkeypatch):
    """With small parts, phrases and texts are dealt out over many buckets."""
    monkeypatch.setattr(repeats, "LEAST_PART", least)
    monkeypatch.setattr(repeats, "MOST_PART", max(least, 1_000))
    same(repeats.removal_report(docs).collect(), plain_removed(rows))
    kept = repeats.without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_one_id_for_most_rows_is_dealt_over_parts(spark, monkeypatch):
    """Most rows share an id or have none; their texts hold passages of each other and of other documents."""
    monkeypatch.setattr(repeats, "LEAST_PART", 2_000)
    monkeypatch.setattr(repeats, "MOST_PART", 2_000)
    rng = random.Random(9)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(80)) for _ in range(12)]
    rows = [
        (rng.choice([7, 7, 7, None, None, i]), "".join(rng.choice("xyz") for _ in range(30)) + rng.choice(lines))
        for i in range(300)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(repeats.removal_report(docs).collect(), plain_removed(rows))


def test_hot_triggers_take_the_loose_way(spark):
    """One line before and after hundreds of different texts: more phrases of a trigger than a task keeps."""
    rng = random.Random(4)
    line = " the one line that stands in every text of them all, word for word. "
    rows = [
        (i, "".join(rng.choice("abcdefgh ") for _ in range(70)) + line + "".join(rng.choice("abcdefgh ") for _ in range(70)))
        for i in range(900)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    same(repeats.removal_report(docs).collect(), plain_removed(rows))


def test_license_rules(spark):
    mit = "\n".join(licenses.SENTENCES[n] for n in ("MIT-grant", "MIT-notice", "AS-IS-software", "NO-LIABILITY"))
    cases = [
        ("Some text. Released under the MIT License.\nMore.", "MIT", [3]),
        (f"Copyright me\n{mit.upper()}", "MIT", [1]),
        ("Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", "Apache-2.0|CC-BY-NC-4.0", [14, 8]),
        (licenses.SENTENCES["GPL-hope"] + " " + licenses.SENTENCES["GPL-free"], "GPL-3.0-or-later", [10]),
        ("Licensed under something else. Released", "", []),
        ("", "", []), (None, "", []), ("Released under the MIT License. " * 3_000, "MIT", [3] * 3_000),
    ]
    rows = [(i, t, "clash") for i, (t, _, _) in enumerate(cases)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, ids string")).collect()
    assert [(r.licenses, [m.rule for m in r.matches]) for r in got] == [(n, m) for _, n, m in cases]


def test_wrapped_notices_match_every_rule(spark):
    def wrapped(names, prefix, label):
        paragraphs = []
        for i, name in enumerate(names):
            sentence = licenses.SENTENCES[name]
            number = f"{i}. " if label and i else ""
            paragraphs.append("\n".join(prefix + line for line in textwrap.wrap(number + sentence, 70)))
        return f"{prefix}Copyright 2020 me\n{prefix.rstrip()}\n" + f"\n{prefix.rstrip()}\n".join(paragraphs) + "\nint x;"

    cases = [
        (wrapped(names, prefix, label), name, i)
        for i, (name, names) in enumerate(licenses.RULES, 1) for prefix, label in (("", False), (" * ", False), ("# ", True))
    ]
    cases.append((" ".join(licenses.SENTENCES[n] for n in licenses.RULES[0][1]), "MIT", 1))
    cases.append(("It is not\nlicensed under the MIT License here. Nor so: Licensed under CC BY 4.0.", "", None))
    rows = [(i, t) for i, (t, _, _) in enumerate(cases)]
    got = sorted(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = [(n, [] if r is None else [r]) for _, n, r in cases]
    assert [(r.licenses, [m.rule for m in r.matches]) for r in got] == want


# Notices as they are shipped, not built from the table.
NOTICES = [
    ("ISC", """Copyright (c) 2013, Somebody

Permission to use, copy, modify, and distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES"""),
    ("BSD-3-Clause", """// Redistribution and use in source and binary forms, with or without
// modification, are permitted provided that the following conditions are
// met:
//
//    * Redistributions of source code must retain the above copyright
// notice, this list of conditions and the following disclaimer.
//    * Redistributions in binary form must reproduce the above
// copyright notice, this list of conditions and the following disclaimer
// in the documentation and/or other materials provided with the
// distribution.
//    * Neither the name of Example Inc. nor the names of its
// contributors may be used to endorse or promote products derived from
// this software without specific prior written permission."""),
    ("Apache-2.0", """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *      https://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */"""),
    ("LGPL-2.1-or-later", """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version."""),
    ("AGPL-3.0-or-later", """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Affero General Public License as
# published by the Free Software Foundation, either version 3 of the
# License, or (at your option) any later version."""),
    ("MPL-2.0", """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""),
    ("GPL-2.0-only", "// SPDX-License-Identifier: GPL-2.0-only\nint x;"),
    ("MIT", "# foo\n\nThis software is released under the MIT License, see LICENSE.\n\n// SPDX-License-Identifier: MIT"),
    ("Zlib", """  This software is provided 'as-is', without any express or implied
  warranty.  In no event will the authors be held liable for any damages
  arising from the use of this software.

  Permission is granted to anyone to use this software for any purpose,
  including commercial applications, and to alter it and redistribute it
  freely, subject to the following restrictions:"""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

Be nice to others.

The above copyright notice and this permission notice (including the next
paragraph) shall be included in all copies or substantial portions of the
Software."""),
]


def test_published_notices(spark):
    rows = [(i, t) for i, (_, t) in enumerate(NOTICES)]
    got = sorted(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [r.licenses for r in got] == [n for n, _ in NOTICES]
    assert [len(r.matches) for r in got] == [1] * len(NOTICES)


def test_license_scan_is_linear(spark):
    notice = "Released under the MIT License."
    texts = ["\n" * 500_000 + notice, "-" * 2_000_000 + "\n" + notice, "this " * 300_000 + "\n" + notice, "the x. " * 200_000 + notice]
    rows = [(i, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string").cache()
    table.count()
    began = time.monotonic()
    got = licenses.scan(table).collect()
    assert [r.licenses for r in got] == ["MIT"] * 4
    assert time.monotonic() - began < 20


def test_imatch_edits_and_fingerprints(docs, rows, spark):
    got = imatch.edited_report(docs).collect()
    chars = [(r[0], len(r[1] or "")) for r in rows]
    same([(r.doc_id, r.n_chars) for r in got], chars)
    text = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    ids = sorted(text, reverse=True)
    for a, b in zip(ids, ids[1:]):
        if sum(r[0] in (a, b) for r in rows) == 2:
            n = len(text[a]) // 3
            edited = text[a][: len(text[a]) - n] + text[b][:n]
            assert next(r for r in got if r.doc_id == a).edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    by_text = {}
    for r in got:
        if r.doc_id is not None:
            assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_imatch_keeps_the_band_only(spark):
    rows = [(f"everywhere word{i % 20} once{i}",) for i in range(100)]
    docs = spark.createDataFrame(rows, "text string")
    bits = imatch.lexicon(docs, min_idf=2.0)
    assert sum(bin(b).count("1") for b in bits) == 20
    same_band = spark.createDataFrame([("word1 WORD2, word1",), ("everywhere word2 word1 other",), ("word3",), ("other",)], "text string")
    a, b, c, d = [r.fingerprint for r in imatch.fingerprints(same_band, bits).collect()]
    assert a == b != c and set(d) == {"0"}


def test_quality_learns_and_handles_odd_rows(spark, sf_dir, docs, rows):
    table = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/../sf0.01/labels.parquet")
    report = passages.quality_report(table, labels).join(labels, "doc_id").toPandas()
    out = report[report.held_out]
    assert len(out) > 50 and (out.predicted == out.quality).mean() > 0.95
    odd = passages.quality_report(docs.unionByName(table, allowMissingColumns=True).select(*docs.columns), labels)
    assert odd.count() == len(rows) + table.count()
    assert odd.where("score is null or score < 0 or score > 1").count() == 0
    none = passages.quality_report(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}


def test_attention_gradients():
    import numpy as np

    rng = np.random.default_rng(1)
    x, starts, y = rng.standard_normal((9, passages.FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])
    model = passages.AttentionModel.fit(x, starts, y)
    model.weights = {k: v.astype(float) for k, v in model.weights.items()}
    x = (x - model.mean) / model.scale

    def loss():
        p = model._forward(x, starts)["score"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, gradient in model._gradients(x, starts, y).items():
        at = tuple(0 for _ in gradient.shape)
        model.weights[name][at] += 1e-6
        up = loss()
        model.weights[name][at] -= 2e-6
        down = loss()
        model.weights[name][at] += 1e-6
        assert gradient[at] == pytest.approx((up - down) / 2e-6, abs=1e-6)


@pytest.mark.parametrize("operator", [
    simhash.near_duplicates, simhash.deduplicate, sharding.shard_documents, pieces.digests, mixing.mix_report,
    mixing.mixed_documents, repeats.removal_report, repeats.without_repeats, licenses.scan, imatch.edited_report,
])
def test_empty_tables_give_no_rows(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
